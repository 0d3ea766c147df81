import random
import re
from collections import Counter

import pytest
from tests_support import docs, edges, plan_has_no_python  # noqa: F401

from callspark.llm import mixing

WORD = re.compile("[^\x20\x09-\x0d]+")


def wanted(sizes):
    """Targets by repeated resharing."""
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    free, left, out = set(sizes), sum(sizes.values()), {}
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 3 * sizes[s] + 1e-9}
        if not over:
            out.update({s: left * weight[s] / total for s in free})
            break
        out.update({s: 3 * sizes[s] for s in over})
        left -= sum(3 * sizes[s] for s in over)
        free -= over
    return out


@pytest.fixture(scope="module")
def rows(edges):
    rng = random.Random(11)
    out = list(edges)
    for i in range(100, 900):
        source = rng.choice(["a", "b", "c", "d", "é", "", None, "tiny"] if i > 140 else ["big"])
        n = rng.randrange(1, 400) if source != "tiny" else 1
        out.append((i, " ".join("w" for _ in range(n)), source))
    return out


def test_targets_and_taken(docs, rows):
    mix = mixing.mixed(docs(rows))
    got = mix.collect()
    sizes, taken, target = Counter(), Counter(), {}
    for i, t, *source in rows:
        sizes[source[0] if source else "s"] += len(WORD.findall(t or ""))
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["source_size"] == sizes[r["source"]] and 0 <= r["taken"] <= 3 * r["size"]
    assert len(got) == len(rows)
    want = wanted(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= 3 * mixing.Mix().block
    again = Counter((r["doc_id"], r["size"], r["taken"]) for r in mixing.mixed(docs(rows)).collect())
    assert again == Counter((r["doc_id"], r["size"], r["taken"]) for r in got)
    plan_has_no_python(mix)


def test_quotas_are_those_of_the_highest_quotients(spark):
    rng = random.Random(13)
    goals = {f"s{i}": rng.choice([0.0, 3.0, 50.0, 400.0, 5000.0]) * rng.random() for i in range(40)}
    mix = mixing.Mix(shards=5, block=16)
    table = spark.createDataFrame([(f"={s}", s, i + 1, 1, t) for i, (s, t) in enumerate(goals.items())], "key string, source string, rank int, source_size long, target double")
    got = {(r["key"], r["shard"]): r["blocks"] for r in mixing.quotas(table, mix).collect()}
    house = round(sum(goals.values()) / 16)
    ranks = {f"={s}": i for i, s in enumerate(goals)}

    def seats(n):
        won = Counter()
        bids = sorted(((-t / (2 * k + 1), ranks[f"={s}"], k, f"={s}") for s, t in goals.items() if t > 0 for k in range(n + 1)))
        won.update(b[3] for b in bids[:n])
        return won

    before = Counter()
    for j in range(5):
        now = seats(house * (j + 1) // 5)
        assert {k: got[k, j] for k in ranks} == {k: now[k] - before[k] for k in ranks}
        before = now
    assert min(got.values()) >= 0


def test_copies(docs, rows):
    unique = [r for r in rows if r[0] is not None and r[0] >= 100]
    times = {r["doc_id"]: round(r["taken"] / r["size"] + 1e-12) if r["size"] else 0 for r in mixing.mixed(docs(unique)).collect()}
    out = mixing.copies(docs(unique))
    assert out.columns == docs(unique).columns
    got = Counter(r["doc_id"] for r in out.collect())
    exact = {i: n for i, n in times.items() if n}
    assert set(got) <= set(times) and sum(abs(got[i] - exact.get(i, 0)) for i in times) <= 0.02 * len(times)


def test_empty(docs, rows):
    assert mixing.mixed(docs(rows).limit(0)).collect() == []
    assert [r["taken"] for r in mixing.mixed(docs([(1, None), (2, "")])).collect()] == [0, 0]


def test_copies_with_null_and_repeated_ids(docs):
    rng = random.Random(37)
    unnamed = [(rng.choice([None, 1, 2]), " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(20, 60))), s) for s in "ab" for _ in range(300)]
    mixed = mixing.mixed(docs(unnamed)).collect()
    want = Counter()
    for r in mixed:
        want[r["source"], round(r["taken"] / r["size"] + 1e-12)] += 1
    got = Counter()
    for (_, _, source), n in Counter((r["doc_id"], r["text"], r["source"]) for r in mixing.copies(docs(unnamed)).collect()).items():
        got[source, n] += 1
    for key, n in want.items():
        if key[1]:
            assert abs(got[key] - n) <= 6, (key, n, got[key])
    assert sum(k * n for (_, k), n in got.items()) <= 1.03 * sum(k * n for (_, k), n in want.items())
