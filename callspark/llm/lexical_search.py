"""Ranked lexical search over K2-treaps.

The corpus is cut into blocks of documents. The postings of a block are points in a grid of terms
and documents, each with its impact: what the term adds to a document's score, before its weight.
The grid is stored as a K2-treap: a quadtree without its empty cells, four bits for the children
of a cell, and for every cell the largest impact in it, kept as the difference to the cell around
it. Rows of terms beyond the width of the block make further trees, one for each band of rows.

A search follows, for every term of an item, the cells in the term's row. All these paths go down
together: a candidate is a range of documents with one cell for each term, its bound is the weighted
sum of the cells' impacts, and the candidates with the highest bounds are halved first. A range that
is one document is scored exactly by its bound. Ranges whose bound is under the score of the k-th
document found so far are never opened; ranges at that score are, as ids break ties.

The first pass counts terms and documents, which impacts need; the second makes the blocks of the
searched vocabulary, whole texts, every document, without a shuffle, and writes them. Document
frequencies are sums over the blocks. Items go to the blocks in packs of bounded size, each pack
with all blocks; every task returns its best documents per item, and a ranking over these is the
result. A task holds one block and the best ``k`` documents per item.

Null and empty texts have no terms and are not found. Documents with a repeated id are ranked each
by itself; of equal scores the lesser id comes first, null ids last. Items with equal id and text are
one item, others are told apart by both. Items without terms give no rows, as do empty tables.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from callspark.llm.common import ascii_lower, sliced, written

#: Documents and bytes of text of a block at most; one longer document is a block by itself.
DOCUMENTS, BYTES = 2048, 8 << 20
#: Item terms that are searched for at once, and candidates that are halved at once.
PACK, FRONT = 100_000, 256

WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

#: What a byte becomes before words are split at spaces: letters in lower case, digits and bytes of other alphabets as they are.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_BITS = np.array([bin(i).count("1") for i in range(16)], np.int32)


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a whole text in their order."""
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split() if text else []


def terms(text: Column) -> Column:
    """The same as a column of strings."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


@dataclass(frozen=True)
class Scoring:
    """Constants of the score; all of it but the logarithm is whole numbers."""

    scale: int = 1_000_000_000
    saturation: int = 12
    length: int = 25
    weight: int = 1000

    def impacts(self, tf: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
        """What a term adds to a document of ``n`` terms in which it occurs ``tf`` times."""
        m = 100 - self.length + (self.length * n * documents) // total
        return (self.scale * tf) // (1000 * tf + self.saturation * m)

    def weights(self, df: Column, documents: int) -> Column:
        """A term's weight from the number of documents that hold it."""
        return F.floor(self.weight * F.log(F.lit(2.0 * documents + 2) / (2.0 * df + 1))).cast("long")


# --- the treap --------------------------------------------------------------------------------------


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of x with a zero between each two."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Treap:
    """Cells of a grid by depth: masks of their children, first child and largest impact."""

    def __init__(self, depth: int, children: np.ndarray, impact: np.ndarray):
        self.depth, self.children, self.impact = depth, children, impact
        # Cells stand by depth and in the order of their parents, so children follow each other.
        held = _BITS[children]
        self.first = np.cumsum(held, dtype=np.int32) - held

    @classmethod
    def built(cls, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray) -> "Treap":
        """From points, each at its own place; every row up to the last is taken, columns are at most 2^16."""
        depth = max(1, int(columns.max()).bit_length())
        wide = 1 << depth
        codes = (rows // wide).astype(np.uint64) << np.uint64(2 * depth) | _spread(rows % wide) << np.uint64(1) | _spread(columns)
        order = np.argsort(codes, kind="stable")
        codes, impacts = codes[order], impacts[order].astype(np.int32)
        levels = [(np.zeros(len(codes), np.uint8), impacts)]
        for _ in range(depth):
            parents = codes >> np.uint64(2)
            starts = np.concatenate(([0], np.flatnonzero(parents[1:] != parents[:-1]) + 1))
            masks = np.add.reduceat(np.left_shift(1, (codes & np.uint64(3)).astype(np.int64)), starts).astype(np.uint8)
            levels.append((masks, np.maximum.reduceat(levels[-1][1], starts)))
            codes = parents[starts]
        levels.reverse()
        # The roots, one per band of rows, are the first cells; their first children follow them.
        return cls(depth, np.concatenate([m for m, _ in levels]), np.concatenate([i for _, i in levels]))._rooted(len(codes))

    def _rooted(self, bands: int) -> "Treap":
        self.bands = bands
        self.first += bands
        return self

    def stored(self) -> tuple[int, int, bytes, bytes, bytes]:
        """Depth, bands, child masks two to a byte, and impacts as differences to the cell around.

        At least one cell in each has no difference to it, most of those with a single cell inside; a
        bit for each cell tells them, and the other differences follow each other.
        """
        above = np.repeat(self.impact, _BITS[self.children])
        below = np.concatenate((self.impact[: self.bands], above - self.impact[self.bands :])).astype(np.int32)
        masks = np.append(self.children, np.zeros(len(self.children) & 1, np.uint8))
        return self.depth, self.bands, (masks[::2] | masks[1::2] << 4).tobytes(), np.packbits(below != 0).tobytes(), below[below != 0].tobytes()

    @classmethod
    def loaded(cls, depth: int, bands: int, masks: bytes, differ: bytes, differences: bytes) -> "Treap":
        packed = np.frombuffer(masks, np.uint8)
        children = np.stack((packed & 15, packed >> 4), 1).ravel()
        cells = bands + int(_BITS[children].sum())  # each is a root or the child of another
        children = children[:cells]
        below = np.zeros(cells, np.int32)
        below[np.unpackbits(np.frombuffer(differ, np.uint8), count=cells).view(bool)] = np.frombuffer(differences, np.int32)
        impact = below.copy()
        begin, end = 0, bands  # the cells of one depth after the other
        for _ in range(depth):
            held = _BITS[children[begin:end]]
            following = end + int(held.sum())
            impact[end:following] = np.repeat(impact[begin:end], held) - below[end:following]
            begin, end = end, following
        return cls(depth, children, impact)._rooted(bands)

    def best(self, rows: np.ndarray, weights: np.ndarray, found: "Best", ids: list, front: int = FRONT) -> None:
        """Adds to ``found`` the documents that can be among the best for weighted rows."""
        wide = 1 << self.depth
        inside, many = rows % wide, len(rows)
        nodes = (rows // wide)[None, :]  # per candidate range and term its cell, -1 where there is none
        bounds = (self.impact[nodes] * weights).sum(1)
        depths, ranges = np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(bounds):
            least = found.least
            if len(bounds) > front:
                top = np.argpartition(-bounds, front - 1)[:front]
                rest = np.ones(len(bounds), bool)
                rest[top] = False
            else:
                top, rest = np.arange(len(bounds)), np.zeros(len(bounds), bool)
            cells, deep, where = nodes[top], depths[top], ranges[top]
            row_bit = (inside[None, :] >> (self.depth - 1 - deep)[:, None]) & 1
            masks, first = self.children[cells].astype(np.int64), self.first[cells]
            halves = []
            for half in (0, 1):
                quarter = 2 * row_bit + half
                there = (cells >= 0) & ((masks >> quarter) & 1 == 1)
                halves.append(np.where(there, first + _BITS[masks & ((1 << quarter) - 1)], -1))
            cells = np.stack(halves, 1).reshape(-1, many)
            reached = ((self.impact[cells] * (cells >= 0)) * weights).sum(1)
            deep, where = np.repeat(deep + 1, 2), (2 * where[:, None] + np.arange(2)).ravel()
            ended = (deep == self.depth) & (reached > 0) & (reached >= least)
            for score, document in zip(reached[ended].tolist(), where[ended].tolist(), strict=True):
                found.add(score, ids[document])
            least = found.least
            on = (deep < self.depth) & (reached > 0) & (reached >= least)
            rest &= bounds >= least
            nodes = np.concatenate((nodes[rest], cells[on]))
            bounds = np.concatenate((bounds[rest], reached[on]))
            depths, ranges = np.concatenate((depths[rest], deep[on])), np.concatenate((ranges[rest], where[on]))


class Best:
    """The k best documents of one item: higher scores first, then lesser ids, null ids last."""

    __slots__ = ("k", "heap")

    def __init__(self, k: int):
        self.k, self.heap = k, []

    @property
    def least(self) -> int:
        """The score that a document has to reach."""
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def add(self, score: int, doc_id) -> None:
        entry = _Key((score, doc_id))
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        elif self.heap[0] < entry:
            heapq.heapreplace(self.heap, entry)


class _Key(tuple):
    """Orders (score, id) so that the document to be given up first is the least."""

    def __lt__(self, other):
        if self[0] != other[0]:
            return self[0] < other[0]
        if self[1] is None or other[1] is None:
            return self[1] is None and other[1] is not None
        return other[1] < self[1]


# --- the index --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Index:
    """The stored blocks, the documents with a term, all their terms with repeats, and the scoring they were made for."""

    blocks: DataFrame
    documents: int
    total: int
    scoring: Scoring


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(documents["doc_id"].alias("doc_id"), documents["text"].alias("text"))


def counted(documents: DataFrame) -> tuple[int, int]:
    """The documents that have a term, and all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = total = 0
        for batch in sliced(batches):
            for text in batch.column(0):
                n = len(terms_of(text.as_py()))
                some, total = some + (n > 0), total + n
        yield pa.RecordBatch.from_pydict({"some": [some], "total": [total]})

    sums = _texts(documents).select("text").mapInArrow(run, "some long, total long").agg(F.sum("some"), F.sum("total")).first()
    return sums[0] or 0, sums[1] or 0


def build(documents: DataFrame, scoring: Scoring = Scoring()) -> Index:
    """Indexes every term of every document and stores the blocks."""
    some, total = counted(documents)
    source = _texts(documents)
    kind = source.schema["doc_id"].dataType.simpleString()

    def block(ids: list, vocabulary: dict[bytes, int], lists: list[np.ndarray], id_type: pa.DataType) -> pa.RecordBatch:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        numbers = np.concatenate(lists).astype(np.int64) * len(lists) + np.repeat(np.arange(len(lists)), sizes)
        points, tf = np.unique(numbers, return_counts=True)
        # Terms of like frequency lie together: a cell's impact is that of all its rows.
        df = np.bincount(points // len(lists), minlength=len(vocabulary))
        order = np.argsort(-df, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        rows, columns = place[points // len(lists)], points % len(lists)
        words = pa.array(list(vocabulary), pa.binary()).cast(pa.string()).take(pa.array(order))
        treap = Treap.built(rows, columns, scoring.impacts(tf, sizes[columns], some, total))
        depth, bands, *parts = treap.stored()
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        return pa.RecordBatch.from_arrays(
            [
                one(ids, id_type), pa.ListArray.from_arrays([0, len(words)], words), one(df[order], pa.int32()), pa.array([depth], pa.int32()), pa.array([bands], pa.int32()),
                *(pa.array([x], pa.binary()) for x in parts),
            ],
            names=["ids", "terms", "df", "depth", "bands", "masks", "differ", "differences"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vocabulary, lists, held = [], {}, [], 0
        id_type = pa.int64()
        for batch in sliced(batches):
            id_type = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = terms_of(text.as_py())
                if not found:
                    continue
                size = len(text.as_buffer())
                if ids and (len(ids) == DOCUMENTS or held + size > BYTES):
                    yield block(ids, vocabulary, lists, id_type)
                    ids, vocabulary, lists, held = [], {}, [], 0
                ids.append(doc_id)
                lists.append(np.fromiter((vocabulary.setdefault(t, len(vocabulary)) for t in found), np.int32, len(found)))
                held += size
        if ids:
            yield block(ids, vocabulary, lists, id_type)

    schema = f"ids array<{kind}>, terms array<string>, df array<int>, depth int, bands int, masks binary, differ binary, differences binary"
    return Index(written(source.mapInArrow(run, schema), "treaps"), some, total, scoring)


# --- search -----------------------------------------------------------------------------------------


def weighted_items(index: Index, items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct terms of each item that a document has: item_id, item_hash, term, weight times its repeats in the item."""
    rows = items.select(items[item_id].alias("item_id"), items[text].alias("text")).distinct()
    found = rows.select("item_id", F.xxhash64("text").alias("item_hash"), F.explode(terms(F.col("text"))).alias("term"))
    repeats = found.groupBy("item_id", "item_hash", "term").agg(F.count(F.lit(1)).alias("repeats"))
    held = index.blocks.select(F.explode(F.arrays_zip("terms", "df")).alias("e")).select("e.terms", "e.df").toDF("term", "df")
    df = held.join(repeats.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = index.scoring.weights(F.col("df"), index.documents) * F.col("repeats")
    return repeats.join(df, "term").select("item_id", "item_hash", "term", weight.alias("weight")).filter("weight > 0")


def search(index: Index, items: DataFrame, k: int = 20, pack: int = PACK) -> DataFrame:
    """The k highest-scoring documents of every item: item_id, item_hash, rank, doc_id, score."""
    spark = items.sparkSession
    wanted = written(weighted_items(index, items), "weighted-items")
    packs = max(1, -(-wanted.count() // pack))
    doc_kind = index.blocks.schema["ids"].dataType.elementType
    schema = StructType([wanted.schema["item_id"], wanted.schema["item_hash"]]).add("doc_id", doc_kind).add("score", "long")
    arrow = to_arrow_schema(schema)

    def searched(items_of_pack) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = {key: Best(k) for key in items_of_pack.value}
            for batch in batches:
                for i in range(batch.num_rows):
                    ids, words, _, *stored = (batch.column(c)[i].as_py() for c in range(8))
                    place = {w: at for at, w in enumerate(words)}
                    treap = Treap.loaded(*stored)
                    for key, weights in items_of_pack.value.items():
                        here = [(place[t], w) for t, w in weights.items() if t in place]
                        if here:
                            rows, weight = np.array(here, np.int64).T
                            treap.best(rows, weight, best[key], ids)
            found = [(*key, entry[1], entry[0]) for key, top in best.items() for entry in top.heap]
            yield pa.RecordBatch.from_pydict({n: [f[i] for f in found] for i, n in enumerate(arrow.names)}, arrow)

        return index.blocks.mapInArrow(run, schema)

    parts = []
    for p in range(packs):
        of_pack: dict[tuple, dict[str, int]] = {}
        rows = wanted.filter(F.pmod(F.xxhash64("item_id", "item_hash"), F.lit(packs)) == p)  # about ``pack`` rows
        for r in rows.collect():
            of_pack.setdefault((r["item_id"], r["item_hash"]), {})[r["term"]] = r["weight"]
        if of_pack:
            parts.append(searched(spark.sparkContext.broadcast(of_pack)))
    if not parts:
        parts.append(spark.createDataFrame([], schema))
    every = reduce(DataFrame.unionByName, parts)
    order = Window.partitionBy("item_id", "item_hash").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "item_hash", "rank", "doc_id", "score")
