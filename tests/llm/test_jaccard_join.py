import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_support import docs, edges, frame, prose  # noqa: F401

from callspark.llm import jaccard_join
from callspark.llm.components import components
from callspark.llm.jaccard_join import Shingler, name_pairs, names, point, tree_pairs


def sets_of(rows):
    out = []
    for _, t, *_ in rows:
        w = (t or "").encode().lower().split()
        out.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else []))
    return out


def brute(rows):
    sets = sets_of(rows)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    out = Counter()
    for i, r in enumerate(rows):
        ids = [x for x in groups[find(i)] if x is not None] if sets[i] else [r[0]]
        out[r[0], len(sets[i]), min(ids) if ids and ids[0] is not None else None] += 1
    return out


def edited(rng, text, share):
    w = text.split()
    for _ in range(max(1, int(len(w) * share))):
        at = rng.randrange(len(w))
        w[at : at + rng.choice([0, 1])] = [f"e{rng.randrange(10**6)}"]
    return " ".join(w)


@pytest.fixture(scope="module")
def rows(edges):
    rng = random.Random(23)
    out = list(edges)
    shared = prose(rng, 60, 3000)
    at = 100
    for n in [1, 3, 4, 5, 6, 8, 9, 12, 20, 35, 60, 64, 70, 100, 130, 200, 260, 300, 520, 700, 1100, 2100]:
        for _ in range(3):
            first = prose(rng, n, 3000) + (" " + shared if rng.random() < 0.5 else "")
            out.append((at, first))
            at += 1
            for share in (0.004, 0.01, 0.02, 0.03, 0.04, 0.05):
                out.append((at, edited(rng, first, share)))
                at += 1
            out.append((at, first.upper().replace(" ", "\n \t")))
            at += 1
    rng.shuffle(out)
    return out


def test_components_equal_brute_force(docs, rows):
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.linked(docs(rows)).collect())
    want = brute(rows)
    assert got == want
    kept = jaccard_join.one_of_each(docs(rows))
    assert kept.columns == docs(rows).columns
    ids = Counter(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == Counter({i: 1 for i, _, c in want if i is not None and i == c})


def test_further_links_are_found_by_trees(docs):
    # A chain: neighbours are linked, the ends are not, and no text is the least of all names.
    rng = random.Random(29)
    words = prose(rng, 400, 10**6).split()
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        for _ in range(4):
            words[rng.randrange(400)] = f"n{rng.randrange(10**9)}"
    rng.shuffle(rows)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.linked(docs(rows)).collect())
    assert got == brute(rows)


@pytest.mark.parametrize("n", [4, 5, 9, 20, 63, 64, 100, 127, 128, 400, 511, 1000, 5000])
def test_linked_sets_share_a_name(n):
    rng = np.random.default_rng(n)
    for _ in range(60):
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        differ = len(a) // 4  # the most a linked pair can differ in
        out = rng.integers(0, differ + 1)
        b = rng.permutation(a)[out:]
        b = np.unique(np.concatenate((b, rng.integers(0, 2**64, differ - out, dtype=np.uint64))))
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= 80 * (len(a) + len(b) - shared):
            assert set(names(a).tolist()) & set(names(b).tolist())


def test_tree_equals_all_pairs():
    rng = np.random.default_rng(31)
    base = rng.integers(0, 12, (40, 64))
    points = np.concatenate([np.maximum(base + rng.integers(-1, 2, base.shape), 0) for _ in range(4)])
    sizes, labels, side = points.sum(1), rng.integers(0, 150, len(points)), rng.integers(0, 3, len(points))
    want = set()
    for i in range(len(points)):
        for j in range(i + 1, len(points)):
            bound = int(np.minimum(points[i], points[j]).sum())
            near = 5 * min(sizes[i], sizes[j]) >= 4 * max(sizes[i], sizes[j])
            if labels[i] != labels[j] and (side[i] != side[j] or side[i] == 0) and near and 9 * bound >= 4 * (sizes[i] + sizes[j]):
                want.add((i, j))
    assert set(map(tuple, tree_pairs(points, sizes, labels, side).tolist())) == want and want
    copies = np.zeros(len(points), np.int64)
    assert set(map(tuple, name_pairs(copies, points, sizes, labels, side).tolist())) == want
    groups = np.arange(len(points)) // 20
    few = {(i, j) for i, j in want if groups[i] == groups[j]}
    assert set(map(tuple, name_pairs(groups, points, sizes, labels, side).tolist())) == few


def test_points_bound_the_overlap():
    a, b = Shingler()("a b c d e f g h i j k l m"), Shingler()("a b c d e f g x i j k l m")
    assert np.minimum(point(a), point(b)).sum() >= len(np.intersect1d(a, b)) == 4


def test_components(spark):
    rng = random.Random(37)
    links = [(f"{rng.randrange(300):03}", f"{rng.randrange(300):03}") for _ in range(200)]
    links += [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    for a, b in links:
        if a != b:
            assert got.get(a, a) == find(a) and got.get(b, b) == find(b)
    assert components(spark.createDataFrame([], "a string, b string")).collect() == []


def test_empty(docs, rows):
    assert jaccard_join.linked(docs(rows).limit(0)).collect() == []


def test_one_of_each_with_null_and_repeated_ids(docs):
    rng = random.Random(41)
    one, two, three, four = (prose(rng, 60, 10**6) for _ in range(4))
    rows = [(1, one), (1, two), (1, one), (2, two + " end"), (3, three), (3, three + " end"), (None, four), (4, four + " end"), (None, "a b c d e f")]
    got = Counter((r["doc_id"], r["text"]) for r in jaccard_join.one_of_each(docs(rows)).collect())
    # Two unrelated texts of id 1 stay, one of the near copies of id 3, and the text of id 4 stands for its copy without an id.
    assert Counter(d for d, _ in got.elements()) == Counter({1: 2, 3: 1, 4: 1, None: 1})
    assert got[1, one] == got[1, two] == got[None, "a b c d e f"] == 1


def test_names_of_a_task_and_of_others(spark, monkeypatch):
    """A name is shared if two sets have it, in one task or in two."""
    from collections import defaultdict

    from callspark.llm import jaccard_join as jj

    rng = random.Random(8)
    texts = [prose(rng, rng.randrange(5, 40), 30) for _ in range(60)]
    texts += texts[:20] + [" ".join(t.split()[:-1]) for t in texts[:30]] + ["", None, "a b"]
    holders = defaultdict(set)
    for t in texts:
        found = Shingler()(t)
        if len(found) >= 4:
            for n in names(found).view(np.int64).tolist():
                holders[n].add(jj.short_of(jj.signature(found)))
    want = sorted((n, s) for n, sets in holders.items() if len(sets) > 1 for s in sets)
    table = frame(spark, list(enumerate(texts)))
    assert want
    for parts, chunk in ((1, 1 << 18), (1, 40), (16, 1 << 18)):
        monkeypatch.setattr(jj, "CHUNK", chunk)
        got = sorted(map(tuple, jj.shared_names(table.repartition(parts)).collect()))
        assert sorted(set(got)) == want and max(Counter(got).values()) <= 2


def test_pairs_leave_the_trees_once(spark, monkeypatch):
    """Sets that share many names are given out under the first; large names are cut by size and dealt."""
    from callspark.llm import jaccard_join as jj

    rng = random.Random(6)
    base = prose(rng, 150, 400).split()
    texts = []
    for i in range(70):  # a family in which many pairs are just under the threshold
        words = list(base[: 120 + i % 30])
        for at in rng.sample(range(len(words)), 2):
            words[at] = f"x{i}{at}"
        texts.append(" ".join(words))
    table = frame(spark, list(enumerate(texts)))
    rows = jj.sets(table).collect()
    place = {r.short: i for i, r in enumerate(rows)}
    points, sizes = np.array([r.point for r in rows]), np.array([r.n for r in rows])
    a, b = np.triu_indices(len(rows), 1)
    members = jj.shared_names(table).join(jj.sets(table).select("short", "n", "point"), "short").withColumn("label", F.col("short"))
    met = {(min(p), max(p)) for p in (
        (place[x], place[y]) for s in members.groupBy("name").agg(F.collect_set("short").alias("s")).collect() for x in s.s for y in s.s if x < y
    )}
    want = {(i, j) for i, j in zip(a[jj._fits(points, sizes, a, b)].tolist(), b[jj._fits(points, sizes, a, b)].tolist(), strict=True) if (i, j) in met}
    assert len(want) > 100
    for tree in (2048, 16):
        monkeypatch.setattr(jj, "TREE", tree)
        got = [tuple(sorted((place[r.a], place[r.b]))) for r in jj._searched(members).collect()]
        assert set(got) == want and len(got) == len(want)
        raw = jj._spread_out(jj._with_earlier(members.dropDuplicates(["name", "short"])))
        assert raw.count() >= members.count()
