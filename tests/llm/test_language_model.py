import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tests_support import docs, edges, frame, prose  # noqa: F401

from callspark.llm import language_model as lm


def tokens(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", text) if w] + [None]


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def plain(rows, prior=50.0):
    """Base score and two-word score by exact counts."""
    one, two = Counter(), Counter()
    for doc_id, text in rows:
        if not is_held_out(doc_id):
            x = tokens(text)
            one.update(x)
            two.update(zip([None] + x, x))
    total, known = sum(one.values()), len(one)
    floor = total + 0.5 * (known + 1)
    out = []
    for doc_id, text in rows:
        x = tokens(text)
        base = sum(math.log10((one[w] + 0.5) / floor) for w in x)
        score = sum(math.log10((two[v, w] + prior * (one[w] + 0.5) / floor) / (one[v] + prior)) for v, w in zip([None] + x, x))
        out.append((doc_id, is_held_out(doc_id), len(x), sum(one[w] > 0 for w in x), total, base, score))
    return out


def markov(rng, n):
    """Words that follow from the word before, so that two words tell more than one."""
    out, at = [], 0
    for _ in range(n):
        at = (at * 7 + rng.choice((1, 2, 3))) % 400
        out.append(f"w{at}")
    return " ".join(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    return [(i, markov(rng, rng.randrange(5, 300))) for i in range(400)]


def scored(spark, rows, settings=lm.Settings()):
    table = frame(spark, rows)
    return lm.score(table, lm.train(table, settings)).collect()


def compare(got, want, near):
    got = sorted((tuple(r) for r in got), key=lambda r: repr((r[0], r[5])))
    want = sorted(want, key=lambda r: repr((r[0], r[5])))
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-12, abs=1e-12)
        if near:
            assert abs(g[6] - w[6]) <= near * g[2]


def test_base_is_exact_and_score_near_exact_counts(spark, rows):
    compare(scored(spark, rows, lm.Settings(base=1.1, bits=24)), plain(rows), 0.02)
    compare(scored(spark, rows), plain(rows), 0.06)


def test_counts_that_need_more_than_two_bytes(spark, rows, monkeypatch):
    monkeypatch.setattr(lm, "MANY", 5)
    compare(scored(spark, rows, lm.Settings(base=1.1, bits=24)), plain(rows), 0.02)


def test_words_before_help_on_held_out_texts(spark, rows):
    held = [r for r in scored(spark, rows) if r.held_out]
    assert len(held) > 40 and sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)


def test_passes_change_nothing(spark, rows, monkeypatch):
    want = {r.doc_id: tuple(r) for r in scored(spark, rows)}
    three = {r.doc_id: tuple(r) for r in scored(spark, rows, lm.Settings(order=3))}
    monkeypatch.setattr(lm, "BROADCAST", 4000)
    monkeypatch.setattr(lm, "PASS", 12_000)
    table = frame(spark, rows)
    model = lm.train(table)
    assert len(lm._passes(model)) > 2
    for r in lm.score(table, model).collect():
        assert tuple(r)[:5] == want[r.doc_id][:5]
        assert r.base_score == pytest.approx(want[r.doc_id][5]) and r.score == pytest.approx(want[r.doc_id][6])
    for r in scored(spark, rows, lm.Settings(order=3)):
        assert r.score == pytest.approx(three[r.doc_id][6])
    assert any(three[i][6] != want[i][6] for i in want)


def test_edges(spark, edges, monkeypatch):
    rows = [(r[0], r[1]) for r in edges] + [(1001, "A b"), (1002, "a b"), (1003, "\x1f x"), (1004, "end"), (1005, "end")]
    compare(scored(spark, rows), plain(rows), 0)
    monkeypatch.setattr(lm, "PIECE", 64)
    compare(scored(spark, rows), plain(rows), 0)


def test_nothing_to_learn_from(spark):
    assert scored(spark, []) == []
    only = next(i for i in range(100) if is_held_out(i))
    (row,) = scored(spark, [(only, "a b c")])
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (4, 0, 0, 0.0, 0.0)


def test_filter_returns_levels():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 52, 20_000, dtype=np.uint64)) << np.uint64(1) & np.uint64((1 << 52) - 1)
    keys = np.unique(keys)
    levels = rng.geometric(0.5, len(keys))
    words = lm.filter_words(keys, levels, 12)
    row = {"segment": 0, "words": words.tobytes(), "known": b"", "times": b"", "many": b""}
    asked = lm.Filter([row]).levels(keys)
    assert (asked >= levels).all() and (asked > levels).mean() < 0.05
    others = np.unique(rng.integers(1 << 51, 1 << 52, 20_000, dtype=np.uint64) | np.uint64(1))
    assert (lm.Filter([row]).levels(others) > 0).mean() < 0.05
    counts = np.arange(1, 500)
    found = lm.count_of(60, 1.5)[lm.level(counts, 1.5)]
    assert (np.abs(found / counts - 1) <= 0.5).all()


def test_probabilities_sum_to_one():
    """Over the vocabulary and one unknown word, behind a context that was seen; levels 1 to 3 are exact counts."""
    words, follows = {"a": 3, "b": 2, "end": 1, "unknown": 0}, {"a": 2, "b": 1, "end": 0, "unknown": 0}
    p = [lm.probabilities(np.array([[3, n], [0, follows[w]]]), np.array([2]), 6, 3, lm.Settings())[1] for w, n in words.items()]
    assert sum(p) == pytest.approx(1.0) and min(p) > 0
