import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from tests_support import docs, edges, frame, prose  # noqa: F401

from callspark.llm import lexical_search as ls


def plain_terms(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in text).split(" ")


def plain(rows, items, k=20):
    """The ranking of every item by scoring every document."""
    found = [(r[0], Counter(t for t in plain_terms(r[1]) if t)) for r in rows]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    some, total = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item_id, text in dict.fromkeys(items):
        scores = []
        for doc_id, c, n in found:
            m = 75 + (25 * n * some) // total
            score = sum(
                math.floor(1000 * math.log((2 * some + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in plain_terms(text) if t and c[t]
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, rows, items, k=20, **more):
    table = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, term string, rank int")
    found = ls.search(ls.build(frame(spark, rows)), table, k, **more)
    return sorted((tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_treap_keeps_points_and_order():
    rng = np.random.default_rng(3)
    for _ in range(60):
        width, terms = int(rng.integers(1, 90)), int(rng.integers(1, 300))
        points = {(r, int(rng.integers(width))) for r in range(terms)} | {(int(rng.integers(terms)), int(rng.integers(width))) for _ in range(300)}
        rows, columns = np.array(sorted(points)).T
        impacts = rng.integers(1, 30, len(rows))
        treap = ls.Treap.loaded(*ls.Treap.built(rows, columns, impacts).stored())
        wanted = np.unique(rng.integers(0, terms, 7))
        weights = rng.integers(1, 6, len(wanted))
        weight_of, scores = dict(zip(wanted.tolist(), weights.tolist(), strict=True)), Counter()
        for r, c, i in zip(rows.tolist(), columns.tolist(), impacts.tolist(), strict=True):
            if r in weight_of:
                scores[c] += weight_of[r] * i
        ids = rng.permutation(width).tolist()
        for front in (1, 4, 256):
            best = ls.Best(6)
            treap.best(wanted, weights, best, ids, front)
            assert sorted((-s, i) for s, i in best.heap) == sorted((-s, ids[c]) for c, s in scores.items())[:6]


def test_bounds_leave_most_ranges_closed():
    """One term is held by a few documents, the other by all: few cells are opened."""
    width = 4096
    rows = np.concatenate((np.zeros(width, np.int64), np.full(20, 3000)))
    columns = np.concatenate((np.arange(width), np.arange(0, 4000, 200)))
    treap = ls.Treap.built(rows, columns, np.full(len(rows), 100))

    class Counting(ls.Best):
        __slots__ = ("added",)

        def add(self, score, doc_id):
            self.added = getattr(self, "added", 0) + 1
            super().add(score, doc_id)

    best = Counting(20)
    treap.best(np.array([0, 3000]), np.array([1, 50]), best, list(range(width)))
    assert sorted(i for _, i in best.heap) == list(range(0, 4000, 200)) and best.added < 100


def test_equals_scoring_of_every_document(spark, edges, monkeypatch):
    rng = random.Random(7)
    rows = edges + [(100 + i, prose(rng, rng.randrange(1, 120), 60)) for i in range(300)]
    rows += [(500, "One ONE one two"), (500, "one three"), (501, "One ONE one two"), (502, "é_ü 1a2b-c"), (None, "w1 w2 w3"), (None, "w1 w2 w3")]
    items = [(1, "w1 w2 w3 W4 w1"), (2, "one"), (3, None), (4, " .,"), (5, "missing words"), (None, "w7 w8"), (1, "w9"), (1, "w9"), (6, "é ü b"), (7, prose(rng, 500, 80))]
    want = plain(rows, items)
    assert searched(spark, rows, items) == want
    assert searched(spark, rows, items, pack=5) == want  # several packs
    monkeypatch.setattr(ls, "DOCUMENTS", 16)
    assert searched(spark, rows, items, k=3) == plain(rows, items, 3)


def test_copies_tie_by_id(spark):
    rows = [(i, "same words here") for i in range(900, 0, -1)] + [(2000 + i, f"other text {i}") for i in range(900)]
    assert [r[2] for r in sorted(searched(spark, rows, [(1, "same words")]), key=lambda r: r[1])] == list(range(1, 21))


def test_empty_tables(spark):
    assert searched(spark, [], [(1, "word")]) == []
    assert searched(spark, [(1, "word")], []) == []
    assert searched(spark, [(1, None), (2, "")], [(1, "word")]) == []


def test_string_ids_and_frequencies(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "z")], "doc_id string, text string")
    items = spark.createDataFrame([("i", "x")], "item_id string, text string")
    index = ls.build(docs)
    assert (index.documents, index.total) == (4, 7)
    assert [r.doc_id for r in ls.search(index, items).orderBy("rank").collect()] == ["a", "b", None]
    weight = ls.weighted_items(index, items).first()
    assert weight.weight == math.floor(1000 * math.log(10 / 7))
    assert index.blocks.select(F.sum(F.size("terms"))).first()[0] >= 3
