import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from tests_support import docs, edges, prose  # noqa: F401

from callspark.llm import repeat_removal
from callspark.llm.repeat_removal import Parser, kept_bytes

LENGTH = 50


def brute(rows):
    least = {}
    for d, t, *_ in rows:
        data = (t or "").encode()
        if d is not None:
            for i in range(len(data) - LENGTH + 1):
                s = data[i : i + LENGTH]
                least[s] = min(d, least.get(s, d))
    out = Counter()
    for d, t, *_ in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        if d is not None:
            for i in range(len(data) - LENGTH + 1):
                if least[data[i : i + LENGTH]] < d:
                    gone[i : i + LENGTH] = b"\1" * LENGTH
        runs = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        left = bytes(b for b, x in zip(data, gone, strict=True) if not x)
        out[d, len(data), sum(gone), runs, hashlib.sha256(left).hexdigest()] += 1
    return out


@pytest.fixture(scope="module")
def rows(edges):
    rng = random.Random(41)
    out = [r for r in edges if r[1] is None or len(r[1]) < 100_000]
    passages = [prose(rng, n, 50_000) for n in (8, 9, 12, 30, 200)]
    passages += ["a" * 60, "ab" * 40, "é" * 26, "x" * 49 + "y", ("z" * 49 + "q") * 3]
    for i in range(100, 220):
        parts = [prose(rng, rng.randrange(0, 40), 20) for _ in range(3)]
        parts.insert(1, rng.choice(passages)[rng.randrange(0, 20) :])
        parts.insert(3, rng.choice(passages)[: rng.randrange(30, 90)])
        out.append((i, rng.choice(["", " "]).join(parts)))
    out += [(300, out[-1][1]), (2**40, out[-2][1]), (-5, out[-3][1]), (301, out[-1][1] * 3)]
    rng.shuffle(out)
    return out


def test_equals_brute_force(docs, rows):
    got = Counter(tuple(r) for r in repeat_removal.report(docs(rows)).collect())
    assert got == brute(rows)


def test_an_id_with_several_texts(docs, rows):
    """A text loses what lesser ids have, and nothing to other texts of its own id."""
    rng = random.Random(47)
    base = prose(rng, 90, 50_000)
    more = [(1, base[:400]), (5, base[:401]), (5, base[300:366]), (5, base[:401]), (4, base[350:]), (6, base), (6, base[100:] + base), (None, base), (-3, base[-60:])]
    for every in (more, more + rows + [(i % 7 + 100, t) for i, (_, t, *_) in enumerate(rows[:60])]):
        assert Counter(tuple(r) for r in repeat_removal.report(docs(every)).collect()) == brute(every)


def test_ids_that_are_no_integers(spark):
    rng = random.Random(53)
    base = prose(rng, 60, 50_000)
    rows = [("b", base), ("a", base[20:200]), ("10", base[100:]), ("9", base[:150]), (None, base), ("b", base[:90]), ("a", base[20:200])]
    found = repeat_removal.report(spark.createDataFrame(rows, "doc_id string, text string"))
    assert Counter(tuple(r) for r in found.collect()) == brute(rows)
    assert repeat_removal.report(spark.createDataFrame([], "doc_id string, text string")).collect() == []


def test_a_text_of_several_pieces(docs, monkeypatch):
    rng = random.Random(43)
    long = prose(rng, 150_000, 10**6)  # over a million bytes
    rows = [(1, long), (2, long[400_000:700_030]), (3, long[524_230:524_290]), (4, "x" + long[524_300:524_349] + "x"), (5, long)]
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in repeat_removal.report(docs(rows)).collect()}
    assert got == {1: (0, 0), 2: (300_030, 1), 3: (60, 1), 4: (0, 0), 5: (len(long), 1)}


def test_phrases_hold_every_string_once():
    rng = random.Random(47)
    for text in [prose(rng, 300, 30).encode(), b"a" * 400, bytes(rng.randrange(2) for _ in range(3000)), b"a" * 49, b"b" * 50]:
        starts = [s for _, _, first, count in Parser().phrases(text) for f, c in zip(first, count, strict=True) for s in range(f, f + c)]
        assert starts == list(range(max(0, len(text) - LENGTH + 1)))


def test_kept_bytes():
    runs = np.array([[7, 2], [2, 1], [1, 1]])
    assert kept_bytes(b"0123456789", runs[:, 0], runs[:, 1], 2) == (b"0456", 6, 2)
    touching = np.array([[0, 1], [2, 1]])
    assert kept_bytes(b"01234", touching[:, 0], touching[:, 1], 2) == (b"4", 4, 1)
    assert kept_bytes(b"", runs[:0, 0], runs[:0, 1], 2) == (b"", 0, 0)


def test_empty(docs, rows):
    assert repeat_removal.report(docs(rows).limit(0)).collect() == []
