"""N-gram Jaccard join by count vectors in an R-tree.

A document is the set of its word shingles. Shingles are hashed into groups, and the counts per
group are the document's point; two documents share at most the sum of the smaller coordinates. An
R-tree over points keeps the largest coordinate and the range of sizes of each subtree, and leaves
out subtrees in which that sum can't reach the threshold.

One tree over a corpus would be searched by every document, so documents first meet by groups.
Two linked sets differ in at most n/4 shingles of the smaller one, and each of these spoils at most
one group; when the shingles are dealt to more than that many groups, linked documents agree in
whole groups. A document therefore names n/4 + 1 of its groups by their content, the fullest first,
in an order that is the same for all; linked documents share at least one name (the prefix
principle). The number of groups depends on the class of size, so that a document near the upper
end of its class names groups for the next class as well. Small classes use single shingles.

In a few rounds one document speaks for each name, each document is compared with the speakers it
shares most names with, and the links found make components. Only where a name still joins different
components do trees look for further pairs. Every pair that
the bound lets through is verified on the texts, so that links are exact. Equal sets are one node
from the start, and copies are never compared. A set goes by a 64-bit number while pairs are looked
for, and by 128 bits where copies are brought together.

Spark partitions, shuffles and joins; Python tasks hash texts, search trees of bounded size and
compare two texts at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callspark.llm.common import sliced, written
from callspark.llm.components import components

WORDS = 5
#: Coordinates of a point.
GROUPS = 128
#: Points of a leaf, of a name that needs no tree, and of one tree; larger names get several trees.
LEAF, SMALL, TREE = 32, 32, 2048
#: Rounds in which each set is compared with a few others before trees are searched, one in the first
#: and this many in the others. Fewer rounds only leave more to the trees.
ROUNDS, SPEAKERS = 5, 4
#: Names before each of a set's names by which two sets are known to have met already.
EARLIER = 8
#: Pairs of a set and a name that a task looks at together.
CHUNK = 1 << 18

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Numbers of the shingles of texts; keeps the powers of the rolling sum between texts."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.forward = self.backward = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        size = 1 << max(16, n.bit_length())
        steps = np.ones((2, size), np.uint64)
        steps[0, 1:], steps[1, 1:] = np.uint64(_MULTIPLIER), np.uint64(_INVERSE)
        self.forward, self.backward = np.multiply.accumulate(steps, axis=1)

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted 64-bit numbers of the distinct shingles of a whole text; empty without words.

        Words lie between white space, A-Z in lower case. A text of fewer words is one shingle.
        """
        parts = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not parts:
            return np.empty(0, np.uint64)
        data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
        if len(data) > len(self.forward):
            self._grow(len(data))
        ends = np.flatnonzero(data == 32) + 1
        starts = np.concatenate(([0], ends[:-1]))
        k = min(self.words, len(parts))
        first, last = starts[: len(parts) - k + 1], ends[k - 1 :]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.forward[: len(data)], out=sums[1:])
        return np.unique(_mixed((sums[last] - sums[first]) * self.backward[first]))


def signature(found: np.ndarray) -> bytes:
    """16 bytes that stand for a set."""
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def short_of(sig: bytes) -> int:
    """The short number of a set: the first 8 bytes, less two bits that are left to the passes over names."""
    return int.from_bytes(sig[:8], "big", signed=True) & ~3


def point(found: np.ndarray) -> np.ndarray:
    return np.bincount((found >> np.uint64(57)).astype(np.int64), minlength=GROUPS).astype(np.int32)


def _class_of(n: int) -> int:
    """Classes [4, 8), [8, 16), ... by number; sets of fewer than 4 are linked to equal ones only."""
    return n.bit_length() - 3


def _names(found: np.ndarray, size_class: int, most: int) -> np.ndarray:
    """The ``most`` + 1 first names of groups for a class, the fullest groups first."""
    low = 4 << size_class
    salt = np.uint64((size_class + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
    if low < 64:
        names = _mixed(found ^ salt)
        return np.sort(names)[: most + 1]
    groups = low if low < 256 else low * 3 // 5
    number = (found >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)
    first = np.concatenate(([0], np.flatnonzero(number[1:] != number[:-1]) + 1))
    names = _mixed(np.add.reduceat(_mixed(found ^ salt), first))
    counts = np.diff(np.concatenate((first, [len(found)])))
    return names[np.lexsort((names, -counts))[: most + 1]]


def names(found: np.ndarray) -> np.ndarray:
    """All names under which a set meets those it may be linked with, itself the longer or the shorter."""
    n = len(found)
    if n < 4:
        return np.empty(0, np.uint64)
    own = _class_of(n)
    top = (8 << own) - 1
    out = [_names(found, own, min(n // 4, (n + top) // 9))]
    if 5 * n >= 4 * (top + 1):  # as the shorter of a pair of the next class
        out.append(_names(found, own + 1, n // 4))
    return np.concatenate(out)


# --- passes over the texts ----------------------------------------------------------------------


def sets(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, text_hash, n (shingles), short, sig, point."""
    source = documents.select(
        documents["doc_id"].alias("doc_id"), F.xxhash64(documents["text"]).alias("text_hash"), documents["text"].alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler()
        for batch in sliced(batches):
            found = [shingles(x.as_py()) for x in batch.column(2)]
            sigs = [signature(x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(x) for x in found], pa.int64()),
                    pa.array([short_of(s) for s in sigs], pa.int64()),
                    pa.array(sigs, pa.binary()),
                    pa.array([point(x) for x in found], pa.list_(pa.int32())),
                ],
                names=["doc_id", "text_hash", "n", "short", "sig", "point"],
            )

    kind = dict(source.dtypes)["doc_id"]
    return source.mapInArrow(run, f"doc_id {kind}, text_hash long, n long, short long, sig binary, point array<int>")


def named(documents: DataFrame) -> DataFrame:
    """(name, short) of every set, the last two bits of ``short`` its kind; a set that a task meets again gives no more rows.

    The kind tells what is known of the name from the sets a task has looked at together: 0 that this
    is the only one of them, 1 that there are others and this is the first, 2 that this is one of them.
    """

    def flush(shorts: list[int], lists: list[np.ndarray]) -> pa.RecordBatch:
        name = np.concatenate(lists)
        short = np.repeat(np.array(shorts, np.int64), np.fromiter(map(len, lists), np.int64, len(lists)))
        order = np.argsort(name, kind="stable")
        sorted_ = name[order]
        head = np.ones(len(name), bool)
        head[1:] = sorted_[1:] != sorted_[:-1]
        alone = head & np.append(head[1:], True)
        # Rows stay in the order of the sets: equal numbers behind each other shrink when they are shuffled.
        kind = np.empty(len(name), np.int64)
        kind[order] = np.where(alone, 0, np.where(head, 1, 2))
        return pa.RecordBatch.from_arrays([pa.array(name), pa.array(short | kind)], names=["name", "short"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        shingles = Shingler()
        shorts, lists, size = [], [], 0
        for batch in sliced(batches):
            for value in batch.column(0):
                found = shingles(value.as_py())
                if len(found) < 4:
                    continue
                short = short_of(signature(found))
                if short not in seen:
                    seen.add(short)
                    shorts.append(short)
                    lists.append(np.unique(names(found)).view(np.int64))
                    size += len(lists[-1])
            if size >= CHUNK:
                yield flush(shorts, lists)
                shorts, lists, size = [], [], 0
        if size:
            yield flush(shorts, lists)

    return documents.select(documents["text"].alias("text")).mapInArrow(run, "name long, short long")


def shared_names(documents: DataFrame) -> DataFrame:
    """(name, short) of the names that more than one set has.

    A name that several sets of one task have is known to be shared. Of these sets only the first takes
    part in finding out whether other tasks have it, so a name brings a row per task and no more to
    one place; the others go by a name of their own, from which theirs is won back. A row may come twice, if
    its set was the first in one task only.
    """
    kind, short = F.col("short").bitwiseAND(3), F.col("short").bitwiseAND(~3)
    own = F.xxhash64(short)
    dealt = named(documents).select(F.when(kind == 2, F.col("name").bitwiseXOR(own)).otherwise(F.col("name")).alias("place"), "short")
    same, ordered = Window.partitionBy("place"), Window.partitionBy("place").orderBy("short")
    met = dealt.select(
        "place", short.alias("short"), kind.alias("kind"), F.lag(short).over(ordered).alias("before"),
        F.min(short).over(same).alias("low"), F.max(short).over(same).alias("high"), F.max(kind).over(same).alias("known"),
    )
    known = (F.col("low") < F.col("high")) | (F.col("known") > 0)
    again = F.coalesce(F.col("before") == F.col("short"), F.lit(False))
    name = F.when(F.col("kind") == 2, F.col("place").bitwiseXOR(F.xxhash64("short"))).otherwise(F.col("place"))
    return met.filter(known & ~again).select(name.alias("name"), "short")


# --- pairs ---------------------------------------------------------------------------------------


def _least_overlap(a, b):
    """Shingles that two sets of these sizes share at least when linked: 9 * shared >= 4 * (a + b)."""
    return -((-4 * (a + b)) // 9)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs of sets (a, b, and any further columns) that are linked, compared by their texts (short, text)."""
    left = texts.select(F.col("short").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("short").alias("b"), F.col("text").alias("text_b"))
    columns = pairs.columns
    rows = pairs.join(left, "a").join(right, "b").select(*columns, "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, last, kept = Shingler(), None, np.empty(0, np.uint64)
        for batch in sliced(batches):
            linked = []
            for text_a, text_b, b in zip(batch.column("text_a"), batch.column("text_b"), batch.column("b").to_pylist(), strict=True):
                if b != last:  # neighbours often share their pivot
                    last, kept = b, shingles(text_b.as_py())
                found = shingles(text_a.as_py())
                shared = len(np.intersect1d(found, kept, assume_unique=True))
                linked.append(100 * shared >= 80 * (len(found) + len(kept) - shared))
            yield batch.select(columns).filter(pa.array(linked, pa.bool_()))

    return rows.mapInArrow(run, pairs.schema)


def _fits(points: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of rows can be linked, by their sizes and the sum of the smaller coordinates."""
    out = (5 * np.minimum(sizes[a], sizes[b]) >= 4 * np.maximum(sizes[a], sizes[b])).nonzero()[0]
    bounds = [np.minimum(points[a[c]], points[b[c]]).sum(1, dtype=np.int64) for c in np.array_split(out, max(1, len(out) >> 16))]
    return out[np.concatenate(bounds) >= _least_overlap(sizes[a[out]], sizes[b[out]])]


def _apart(labels: np.ndarray, side: np.ndarray, a, b):
    """Pairs of different components; rows of side 0 go with all, those of 1 and 2 with each other only."""
    return (labels[a] != labels[b]) & ((side[a] != side[b]) | (side[a] == 0))


def _leaves(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows of the leaves of an R-tree, bulk-loaded by halving along the size or the widest coordinate; -1 pads."""
    done, todo = [], [np.arange(len(sizes))]
    while todo:
        rows = todo.pop()
        if len(rows) <= LEAF:
            done.append(np.concatenate((rows, np.full(LEAF - len(rows), -1))))
            continue
        low, high = sizes[rows].min(), sizes[rows].max()
        if 4 * high > 5 * low:  # sizes apart this far are never linked
            order = rows[np.argsort(sizes[rows], kind="stable")]
        else:
            inside = points[rows]
            widest = int((inside.max(0) - inside.min(0)).argmax())
            order = rows[np.argsort(inside[:, widest], kind="stable")]
        todo += [order[: len(order) // 2], order[len(order) // 2 :]]
    return np.stack(done)


def tree_pairs(points: np.ndarray, sizes: np.ndarray, labels: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Pairs of rows with different labels whose bound reaches the threshold, by a join of an R-tree with itself.

    Two leaves are compared only if their boxes allow a link: the sum of the smaller of their largest
    coordinates, and their ranges of sizes. ``side`` is 0, 1 or 2: rows of 0 are paired with all; a 1
    is paired with 2 and 0 only, and so on.
    """
    points = np.concatenate((points, np.zeros((1, points.shape[1]), points.dtype)))  # row -1
    sizes, labels, side = (np.append(x, -1) for x in (sizes, labels, side))
    leaves = _leaves(points[:-1], sizes[:-1])
    real = leaves >= 0
    tops = points[leaves].max(1)
    low = np.where(real, sizes[leaves], np.iinfo(np.int64).max // 8).min(1)
    high = sizes[leaves].max(1)
    first = labels[leaves[:, 0]]
    one = (labels[leaves] == first[:, None])[:, :].all(1, where=real)
    i, j = np.triu_indices(len(leaves))
    near = (5 * high[i] >= 4 * low[j]) & (5 * high[j] >= 4 * low[i]) & ~(one[i] & one[j] & (first[i] == first[j]))
    i, j = i[near], j[near]
    found = []
    for part in np.array_split(np.arange(len(i)), max(1, len(i) >> 12)):
        fits = np.minimum(tops[i[part]], tops[j[part]]).sum(1, dtype=np.int64) >= _least_overlap(low[i[part]], low[j[part]])
        part = part[fits]
        for few in np.array_split(part, max(1, len(part) >> 5)):
            a, b = leaves[i[few]], leaves[j[few]]
            shared = np.minimum(points[a][:, :, None, :], points[b][:, None, :, :]).sum(3, dtype=np.int32)
            n, m = sizes[a][:, :, None], sizes[b][:, None, :]
            fit = (shared >= _least_overlap(n, m)) & (5 * n >= 4 * m) & (5 * m >= 4 * n) & (n > 0) & (m > 0)
            fit &= _apart(labels, side, a[:, :, None], b[:, None, :]) & ((i[few] != j[few])[:, None, None] | (a[:, :, None] < b[:, None, :]))
            at, x, y = fit.nonzero()
            found.append(np.stack((a[at, x], b[at, y]), 1))
    pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
    return np.sort(pairs, 1)


def name_pairs(
    group: np.ndarray, points: np.ndarray, sizes: np.ndarray, labels: np.ndarray, side: np.ndarray, earlier: np.ndarray | None = None
) -> np.ndarray:
    """Pairs of rows as :func:`tree_pairs` gives them for each run of equal ``group``; few rows need no tree.

    Rows that share one of their ``earlier`` names have met under it and are left out.
    """
    largest = points.max(initial=0)
    points = points.astype(np.uint8 if largest < 2**8 else np.uint16 if largest < 2**16 else np.int64)
    starts = np.concatenate(([0], np.flatnonzero(group[1:] != group[:-1]) + 1))
    counts = np.diff(np.concatenate((starts, [len(group)])))
    found = []
    for m in np.unique(counts[(counts > 1) & (counts <= SMALL)]):
        i, j = np.triu_indices(m, 1)
        for first in np.array_split(starts[counts == m], max(1, (counts == m).sum() * len(i) >> 20)):
            a, b = (first[:, None] + i).ravel(), (first[:, None] + j).ravel()
            apart = _apart(labels, side, a, b)
            a, b = a[apart], b[apart]
            fit = _fits(points, sizes, a, b)
            found.append(_first_met(np.stack((a[fit], b[fit]), 1), earlier))
    for first, m in zip(starts[counts > SMALL], counts[counts > SMALL], strict=True):
        rows = slice(first, first + m)
        found.append(_first_met(tree_pairs(points[rows], sizes[rows], labels[rows], side[rows]) + first, earlier))
    return np.concatenate(found) if found else np.empty((0, 2), np.int64)


def _first_met(pairs: np.ndarray, earlier: np.ndarray | None) -> np.ndarray:
    """The pairs of rows whose earlier names, 0 where there are fewer, have none in common."""
    if earlier is None or not len(pairs):
        return pairs
    kept = []
    for part in np.array_split(pairs, max(1, len(pairs) >> 15)):
        a, b = earlier[part[:, 0]], earlier[part[:, 1]]
        kept.append(part[~((a[:, :, None] == b[:, None, :]) & (a != 0)[:, :, None]).any((1, 2))])
    return np.concatenate(kept)


def _with_earlier(members: DataFrame) -> DataFrame:
    """Members with up to ``EARLIER`` names of the same set that come before, in the order of the names.

    Two sets meet under every name they share. If they share one of the last names before it, they have
    met there, or at one still earlier, and the first of all has no such name.
    """
    before = Window.partitionBy("short").orderBy("name").rowsBetween(-EARLIER, -1)
    return members.withColumn("earlier", F.collect_list("name").over(before))


def _spread_out(members: DataFrame) -> DataFrame:
    """Members dealt to trees: tree, side and their columns.

    A name with more than ``TREE`` rows is first cut by size: bands in which sizes differ by a
    factor of 5/4 at most meet themselves and the next, others can't be linked. What is still larger is dealt
    into chunks, and each tree holds two of them.
    """
    counts = members.groupBy("name").agg(F.count(F.lit(1)).alias("rows"))
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(1.25))).cast("int")
    bands = F.when(F.col("rows") > TREE, F.array(F.struct(band.alias("band"), F.lit(0).alias("upper")), F.struct((band - 1).alias("band"), F.lit(1).alias("upper"))))
    whole = F.array(F.struct(F.lit(0).alias("band"), F.lit(0).alias("upper")))
    cut = members.join(counts, "name").withColumn("part", F.explode(F.coalesce(bands, whole))).select(
        F.xxhash64("name", "part.band").alias("group"), F.col("part.upper").alias("upper"), "rows", "short", "label", "n", "point", "earlier"
    )
    chunks = cut.filter(F.col("rows") > TREE).groupBy("group").agg(F.ceil(F.count(F.lit(1)) / TREE).cast("int").alias("chunks"))
    dealt = cut.join(chunks, "group", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn(
        "chunk", F.pmod(F.xxhash64("short"), F.col("chunks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    return dealt.select("group", "upper", "short", "label", "n", "point", "earlier", "chunk", other).select(
        F.xxhash64("group", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("tree"),
        F.when(F.col("chunk") < F.col("other"), 1).when(F.col("chunk") > F.col("other"), 2).otherwise(F.col("upper")).cast("long").alias("side"),
        "short", "label", "n", "point", "earlier",
    )


def _searched(members: DataFrame) -> DataFrame:
    """Pairs (a, b, la, lb) of sets that a name brings together from different components and the bound lets pass.

    ``members``: name, short, label, n, point. A pair that shares many names leaves the tree of the
    first, so the pairs that go out are about as many as the different ones.
    """
    sorted_ = _spread_out(_with_earlier(members)).repartition("tree").sortWithinPartitions("tree", "short")

    def search(rows: list[np.ndarray]) -> pa.RecordBatch:
        tree, side, short, label, n, points, earlier = rows
        at = name_pairs(tree, points, n, label, side, earlier)
        pairs = np.concatenate((short[at], label[at]), 1)
        swapped = pairs[:, 0] > pairs[:, 1]
        pairs[swapped] = pairs[swapped][:, [1, 0, 3, 2]]
        pairs = np.unique(pairs, axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, i]) for i in range(4)], names=["a", "b", "la", "lb"])

    def padded(lists: pa.ListArray) -> np.ndarray:
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        out = np.zeros((len(lists), EARLIER), np.int64)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[np.repeat(np.arange(len(lists)), sizes), at] = lists.flatten().to_numpy(zero_copy_only=False)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in sliced(batches, 4000):
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            rows.append(batch.column(5).flatten().to_numpy(zero_copy_only=False).reshape(-1, GROUPS))
            rows.append(padded(batch.column(6)))
            if held:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            last = int(np.flatnonzero(np.concatenate(([True], rows[0][1:] != rows[0][:-1])))[-1])  # the unfinished tree
            if last:
                yield search([x[:last] for x in rows])
            held = [x[last:] for x in rows]
        if held:
            yield search(held)

    return sorted_.mapInArrow(run, "a long, b long, la long, lb long").distinct()


def _bounded(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs of sets (a, b, and any further columns) whose sizes and points allow a link."""
    columns = pairs.columns
    left = classes.select(F.col("short").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa"))
    right = classes.select(F.col("short").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb"))
    shared = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda s, x: s + x)
    sizes = 5 * F.least("na", "nb") >= 4 * F.greatest("na", "nb")
    rows = pairs.join(left, "a").join(right, "b")
    return rows.filter(sizes & (9 * shared >= 4 * (F.col("na") + F.col("nb")))).select(*columns)


def _against_some(members: DataFrame, classes: DataFrame, number: int, most: int) -> DataFrame:
    """Pairs (a, b, la, lb): each set and ``most`` speakers of other components that the bound lets pass.

    In each round every name is spoken for by one of its sets, the least by a hash of the round. The
    speakers of most names come first.
    """
    speaker = members.groupBy("name").agg(F.min(F.struct(F.xxhash64("short", F.lit(number)).alias("h"), "short", "label")).alias("one"))
    met = members.join(speaker, "name").filter(F.col("label") != F.col("one.label"))
    meant = met.groupBy(
        F.col("short").alias("a"), F.col("one.short").alias("b"), F.col("label").alias("la"), F.col("one.label").alias("lb")
    ).agg(F.count(F.lit(1)).alias("times"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("times"), "b"))
    return _bounded(meant, classes).withColumn("rank", rank).filter(F.col("rank") <= most).select("a", "b", "la", "lb")


def _joined(members: DataFrame, step: DataFrame) -> DataFrame:
    """Members under their new labels, as far as their names still join different ones."""
    renamed = step.select(F.col("node").alias("label"), "root")
    new = members.join(renamed, "label", "left").select("name", "short", F.coalesce("root", "label").alias("label"))
    ends = new.groupBy("name").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return new.join(ends.filter("low != high").select("name"), "name")


def _linked(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, text_hash, n_shingles, component_id, and the component's label (null without words), as ids may repeat."""
    every = written(sets(documents), "sets")
    classes = written(
        every.filter("n > 0").groupBy("sig").agg(
            F.first("short").alias("short"), F.first("n").alias("n"), F.first("point").alias("point"),
            F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "text_hash")).alias("sample"),
        ),
        "classes",
    )

    shared = written(shared_names(documents), "shared-names", let_go=True)

    # Texts of one document of each set that has company.
    wanted = shared.select("short").distinct().join(classes, "short").select(
        "short", F.col("sample.doc_id").alias("id"), F.col("sample.text_hash").alias("hash")
    )
    source = documents.select(documents["doc_id"].alias("doc_id"), documents["text"].alias("text"))
    fetched = source.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("hash")))
    texts = written(fetched.select("short", "text").dropDuplicates(["short"]), "texts", let_go=True)

    # Rounds of each set against a few others; every round is linear in the rows of shared names.
    members = shared.withColumn("label", F.col("short"))
    steps: list[DataFrame] = []
    for number in range(ROUNDS):
        tried = written(_against_some(members, classes, number, SPEAKERS if number else 1), "tried")
        links = written(verified(tried, texts), "links")
        n_links, n_tried = links.count(), tried.count()
        if not n_links:
            break
        steps.append(components(links.select(F.col("la").alias("a"), F.col("lb").alias("b"))))
        members = written(_joined(members, steps[-1]), "members")
        if 20 * n_links < n_tried:  # what is left is mostly not linked, which only the trees can tell
            break

    # Then trees, where a name still joins different components.
    pairs = written(_searched(members.join(classes.select("short", "n", "point"), "short")), "further-pairs", let_go=True)
    links = written(verified(pairs, texts), "further-links")
    steps.append(components(links.select(F.col("la").alias("a"), F.col("lb").alias("b"))))

    groups = classes.select("sig", "least", F.col("short").alias("label"))
    for step in steps:
        renamed = step.select(F.col("node").alias("label"), "root")
        groups = groups.join(renamed, "label", "left").select("sig", "least", F.coalesce("root", "label").alias("label"))
    groups = written(groups, "groups")
    least = groups.groupBy("label").agg(F.min("least").alias("component"))
    of_set = groups.join(least, "label").select("sig", "component", "label")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return every.join(of_set, "sig", "left").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), component.alias("component_id"), "label"
    )


def linked(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the least doc_id reachable by links).

    One row per input row; other columns are left out. Documents without words are linked with
    nothing. A null id is a component's id only if all ids of the component are null.
    """
    return _linked(documents).drop("text_hash", "label")


def _row_key(doc_id, text_hash):
    """Tells documents apart by id and text, those without an id by their text."""
    return F.concat(F.coalesce(F.concat(F.lit("d"), doc_id.cast("string"), F.lit(" ")), F.lit("")), F.lit("t"), text_hash)


def one_of_each(documents: DataFrame) -> DataFrame:
    """One document of each component, that of the least id, with all its columns.

    Documents without words and rows without an id whose component has none stay; a repeated row
    stays once. Of different texts with the least id of one component, that of the least hash stays;
    those of different components all stay.
    """
    rows = _linked(documents).withColumn("text_hash", F.coalesce("text_hash", F.lit(0)))
    alone = F.when(F.col("label").isNull() | F.col("doc_id").isNull(), F.col("text_hash"))
    least = rows.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id", "label", alone.alias("alone"))
    kept = least.agg(F.min("text_hash").alias("text_hash")).select(_row_key(F.col("doc_id"), F.col("text_hash")).alias("__key")).distinct()
    key = _row_key(documents["doc_id"], F.coalesce(F.xxhash64(documents["text"]), F.lit(0)))
    return documents.withColumn("__key", key).join(kept, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
