import hashlib
import random
import re
from collections import Counter

import pytest
from tests_support import docs, edges, plan_has_no_python  # noqa: F401

from callspark.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, items):
    windows = []
    for i, t in items:
        w = words(t)
        k = min(10, len(w))
        windows += [(tuple(w[s : s + k]), i) for s in range(len(w) - k + 1)] if w else []
    out = []
    for d, t, *_ in rows:
        w, hit, found = words(t), set(), set()
        for window, i in windows:
            for s in range(len(w) - len(window) + 1):
                if w[s] == window[0] and tuple(w[s : s + len(window)]) == window:
                    hit.update(range(s, s + len(window)))
                    found.add(str(i))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


@pytest.fixture(scope="module")
def case(edges):
    rng = random.Random(19)
    vocabulary = [f"t{i}" for i in range(60)] + ["É", "é", "x1"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 40)))) for i in range(2, 30)]
    items += [(100, None), (101, ""), (102, " ... "), (103, "zebra"), (104, "nowhere-else to be found"), (3, "the id three again and some more words to make ten of it"), (None, "an item that has no id")]
    rows = [r for r in edges if r[1] is None or len(r[1]) < 10_000]
    for d in range(100, 180):
        parts = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 120))]
        _, text = rng.choice(items)
        if text and rng.random() < 0.7:
            w = words(text)
            a = rng.randrange(len(w)) if w else 0
            parts[3:3] = [x.upper() if x.isascii() else x for x in w[a : a + rng.randrange(5, 30)]] * rng.randrange(1, 3)
        rows.append((d, rng.choice([" ", ", ", "-", "\n"]).join(parts)))
    rows += [(300, "zebra"), (300, "zebra zebra"), (None, "zebra"), (301, " ".join(w for w in words(items[0][1]) * 300))]
    return rows, items


def test_report(spark, docs, case):
    rows, items = case
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items if i is not None], "item_id long, text string, term int")
    out = decontaminate.report(docs(rows), benchmark)
    got = Counter(tuple(r) for r in out.collect())
    assert got == brute(rows, [x for x in items if x[0] is not None])
    plan_has_no_python(out)
    kept = decontaminate.clean(docs(rows), benchmark)
    assert kept.columns == docs(rows).columns
    want = Counter(d for (d, *_, bad), n in got.items() for _ in range(n) if not bad)
    assert Counter(r["doc_id"] for r in kept.collect()) == want


def test_a_vocabulary_in_blocks(spark, docs, case):
    rows, items = case
    benchmark = spark.createDataFrame([(i, t) for i, t in items if i is not None], "item_id long, text string")
    whole, cut = decontaminate.build(docs(rows), benchmark), decontaminate.build(docs(rows), benchmark, at_once=7)
    assert sorted(map(str, whole.postings.collect())) == sorted(map(str, cut.postings.collect()))


def test_empty_tables(spark, docs, case):
    rows, items = case
    benchmark = spark.createDataFrame([(i, t) for i, t in items], "item_id long, text string")
    assert decontaminate.report(docs(rows).limit(0), benchmark).collect() == []
    none = decontaminate.report(docs(rows), benchmark.limit(0)).collect()
    assert len(none) == len(rows) and not any(r["contaminated"] for r in none)


def test_proximity(spark, docs):
    items = spark.createDataFrame([(1, "rare common gem"), (2, "common absent")], "item_id long, text string")
    rows = [(1, "rare x gem common"), (2, "rare " + "x " * 30 + "gem common"), (3, "gem common"), (4, "common " * 50 + "gem rare")]
    index = decontaminate.build(docs(rows), items)
    got = sorted((r["item_id"], r["doc_id"]) for r in decontaminate.proximity_matches(index, items, 3, 10).select("item_id", "doc_id").distinct().collect())
    assert got == [(1, 1), (1, 4)]


def test_items_with_null_and_repeated_ids(spark, docs, case):
    rows, items = case
    passage = "one two three four five six seven eight nine ten"
    items = items + [(7, f"{passage} eleven twelve"), (7, "absent1 " * 30), (8, passage.upper()), (8, passage.upper()), (None, "a second item that has no id at all in its row")]
    rows = rows + [(400, f"x {passage} y"), (401, "see: an item that has no id"), (402, "a second item that has no id at all in its row"), (403, "nothing here")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    # As in the SQL: ids name the items, those without one are one item outside the digest.
    want = Counter()
    for (d, n, hit, _, _, bad), times in brute(rows, items).items():
        named = set()
        for i, t in items:
            one = next(r for r in brute([(d, t2) for d2, t2, *_ in rows if d2 == d and len(words(t2)) == n][:1], [(i, t)]))
            named |= {i} if one[5] else set()
        digest = hashlib.sha256(",".join(sorted(str(i) for i in named if i is not None)).encode()).hexdigest()
        want[d, n, hit, len(named), digest, bad] += times
    out = decontaminate.report(docs(rows), benchmark)
    assert Counter(tuple(r) for r in out.collect()) == want
    assert {d: (k, bad) for d, _, _, k, _, bad in want if d in (400, 401, 402, 403)} == {400: (2, True), 401: (1, True), 402: (1, True), 403: (0, False)}
    left = {r["doc_id"] for r in decontaminate.clean(docs(rows), benchmark).collect()}
    assert not left & {400, 401, 402} and 403 in left


def test_proximity_of_items_with_null_and_repeated_ids(spark, docs):
    items = spark.createDataFrame([(None, "rare common gem"), (1, "red blue"), (1, "absent")], "item_id long, text string")
    rows = [(1, "rare x gem common"), (None, "gem rare common"), (2, "blue and red")]
    near = decontaminate.proximity_matches(decontaminate.build(docs(rows), items), items, 3, 10)
    assert {(r["item_id"], r["doc_id"]) for r in near.collect()} == {(None, 1), (None, None), (1, 2)}


def test_repetitive_texts_are_linear(spark, docs):
    """A very long text of one word, and of two in turn: shifts are many, the text is cut once."""
    import time

    same, turns = "so " * 100_000, "to and " * 50_000
    items = spark.createDataFrame([(1, "so " * 20), (2, "to and " * 10), (3, "to and so " * 7), (4, "so so")], "item_id long, text string")
    begin = time.time()
    rows = {r["doc_id"]: r for r in decontaminate.report(docs([(1, same), (2, turns), (3, "x " + "so " * 9), (4, "to so " * 20)]), items).collect()}
    assert time.time() - begin < 40  # with all the small jobs before; the comparison itself takes a few seconds
    assert [(rows[i]["n_words"], rows[i]["n_hit"], rows[i]["n_items"]) for i in (1, 2, 3, 4)] == [(100_000, 100_000, 2), (100_000, 100_000, 1), (10, 9, 1), (40, 0, 0)]


def test_blocks_split_a_term_of_many_windows(spark, docs):
    items = spark.createDataFrame([(i, "so be it " * 4 + f"w{i}") for i in range(60)], "item_id long, text string")
    table = docs([(1, "so be it " * 30), (2, "so be it " * 3 + "w7"), (3, "nothing")])
    index = decontaminate.build(table, items)
    whole = sorted(map(tuple, decontaminate.phrase_matches(index, table, items).collect()))
    from unittest import mock

    plain = decontaminate._lists
    with mock.patch.object(decontaminate, "_lists", lambda index, anchors: plain(index, anchors, 50)):
        assert sorted(map(tuple, decontaminate.phrase_matches(index, table, items).collect())) == whole
