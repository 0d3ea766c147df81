"""Removal of repeated strings by prefix-free parsing.

A rolling hash marks triggers: in every string of ``LENGTH`` bytes the ``TRIGGER``-byte substring of
the least hash, the leftmost on a tie. Consecutive strings with the same trigger make a phrase, the
bytes they cover. Equal strings have their trigger at the same place, so phrases depend on content
alone, and a document is parsed into overlapping phrases that hold each of its strings once.

The parse is shuffled by trigger and sorted by (trigger, phrase, document). That order is the
dictionary: of equal phrases all but those of the least document are repeats as wholes. A string may
still be repeated inside phrases that differ at their ends. Such phrases share a trigger and at
least half of what surrounds it; for these few, the suffixes of the dictionary phrases are brought
into order to the depth of ``LENGTH`` bytes, by a hash of that depth, and again the least document
keeps its string. Suffix order beyond that depth is never needed and never made.

Each task first settles what repeats among its own documents, so that a phrase of a third of the
corpus reaches its group once per chunk of text. Bytes are compared by 64-bit hashes.

Documents go by a number: their order is that of the ids, whatever their type, and different texts of
one id have numbers that differ in the last bits only, which comparisons leave out. So a text never
loses bytes to another text of its own id, and rows with equal id and text are treated alike. Rows
without an id have no order and stay whole, and nothing is removed for them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql import functions as F

from callspark.llm.common import sliced, written
from callspark.operators.report import numbered as numbered_rows

#: Bytes of a string that counts as a repeat, and of a trigger.
LENGTH, TRIGGER = 50, 16
#: Bytes of text that are parsed and settled at once, and starts of one array of positions.
CHUNK, PIECE = 8 << 20, 1 << 19
#: Rows sorted at once in the dictionary; longer groups are taken in pieces.
ROWS = 1 << 18

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_PLACE = np.uint64((1 << 20) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Parser:
    """Phrases of byte strings; keeps the powers of the rolling sum."""

    def __init__(self, length: int = LENGTH, trigger: int = TRIGGER):
        self.length, self.trigger = length, trigger
        steps = np.ones((2, PIECE + 2 * length), np.uint64)
        steps[0, 1:], steps[1, 1:] = np.uint64(_MULTIPLIER), np.uint64(_INVERSE)
        self.forward, self.backward = np.multiply.accumulate(steps, axis=1)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.forward[: len(data)], out=out[1:])
        return out

    def hashes(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes from ``start`` to ``end``, the same wherever they stand."""
        return _mixed((sums[end] - sums[start]) * self.backward[start] + (end - start).astype(np.uint64))

    def phrases(self, text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(trigger, phrase, first string, number of strings) of all phrases, in pieces of a long text.

        The high bytes of a phrase number are hashes of the half contexts to the left and right of
        its trigger, 0 where the text ends before. A phrase that a piece cuts in two has other
        numbers than a whole copy of it; its strings tell that they are equal.
        """
        total, k, window = len(text) - self.length + 1, self.trigger, self.length - self.trigger + 1
        half = (self.length - k) // 2
        for at in range(0, total, PIECE):
            begin = max(0, at - half)
            low, here = at - begin, min(PIECE, total - at)
            data = np.frombuffer(text, np.uint8, min(len(text) - begin, low + PIECE + self.length - 1 + half), begin)
            sums = self.sums(data)
            starts = np.arange(low, low + here + window - 1)
            grams = self.hashes(sums, starts, starts + k)
            least, size = (grams & ~_PLACE) | starts.astype(np.uint64), 1
            while 2 * size <= window:
                least, size = np.minimum(least[:-size], least[size:]), 2 * size
            if size < window:
                least = np.minimum(least[:here], least[window - size : window - size + here])
            place = (least & _PLACE).astype(np.int64)
            first = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
            last = np.concatenate((first[1:] - 1, [here - 1]))
            triggers = place[first]
            left, right = triggers - half, triggers + k + half
            to_left = self.hashes(sums, np.maximum(left, 0), triggers + k) % np.uint64(255) + np.uint64(1)
            to_right = self.hashes(sums, triggers, np.minimum(right, len(data))) % np.uint64(255) + np.uint64(1)
            to_left[left < 0] = 0
            to_right[right > len(data)] = 0
            whole = self.hashes(sums, first + low, last + low + self.length) >> np.uint64(16)
            phrase = (to_left << np.uint64(56)) | (to_right << np.uint64(48)) | whole
            yield grams[triggers - low], phrase, first + at, last - first + 1

    def strings(self, text: bytes, starts: np.ndarray) -> np.ndarray:
        """Hashes of the strings at the given starts, which are in order."""
        out = []
        for at in range(0, len(text), PIECE):
            here = starts[(starts >= at) & (starts < at + PIECE)] - at
            if len(here):
                sums = self.sums(np.frombuffer(text, np.uint8, min(len(text) - at, PIECE + self.length - 1), at))
                out.append(self.hashes(sums, here, here + self.length))
        return np.concatenate(out) if out else np.empty(0, np.uint64)


def _settled(keys: tuple[np.ndarray, ...], docs: np.ndarray, shift: int) -> np.ndarray:
    """Which rows have an equal key in a document of a lesser id among these rows."""
    order = np.lexsort((docs, *keys))
    new = np.ones(len(docs), bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    least = docs[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    out = np.empty(len(docs), bool)
    out[order] = docs[order] >> shift > least >> shift
    return out


def _longs(*columns: np.ndarray, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64)) for c in columns], names=names)


def numbered(documents: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, number, data) of every row, and how many last bits of a number tell texts of one id apart.

    Numbers are in the order of ids, null where there is no id. Integer ids that have one text each are
    their own numbers. Otherwise the different pairs of id and hash of the text are sorted in ranges and
    counted through.
    """
    rows = documents.select(documents["doc_id"].alias("doc_id"), F.coalesce(documents["text"], F.lit("")).cast("binary").alias("data"))
    whole = isinstance(rows.schema["doc_id"].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    pairs = rows.filter("doc_id IS NOT NULL").select("doc_id", F.xxhash64("data").alias("hash"))
    if whole:
        texts = pairs.groupBy("doc_id").agg((F.min("hash") < F.max("hash")).alias("several"))
        if texts.filter("several").isEmpty():
            return rows.select("doc_id", F.col("doc_id").cast("long").alias("number"), "data"), 0
    placed = written(numbered_rows(pairs.distinct(), ["doc_id", "hash"]), "numbers")
    first = placed.groupBy("doc_id").agg(F.min("row_no").alias("first"), F.count(F.lit(1)).alias("texts"))
    shift = int((first.agg(F.max("texts")).first()[0] or 1) - 1).bit_length()
    number = F.shiftleft("first", shift) + F.col("row_no") - F.col("first")
    numbers = placed.join(first, "doc_id").select(F.col("doc_id").alias("__id"), F.col("hash").alias("__hash"), number.alias("number"))
    joined = rows.join(numbers, (F.col("doc_id") == F.col("__id")) & (F.xxhash64("data") == F.col("__hash")), "left")
    return written(joined.select("doc_id", "number", "data"), "numbered"), shift


def parsed(rows: DataFrame, shift: int = 0) -> DataFrame:
    """The parse of numbered rows: trigger, phrase, number, place (256 * first string + number of strings).

    A phrase that a lesser document of the same task has is settled: it has the complement of its
    place, and a number of its own for a trigger, so that many of them do not meet.
    """
    names = ["trigger", "phrase", "number", "place"]

    def flush(found: list[tuple]) -> pa.RecordBatch:
        trigger, phrase, first, count = (np.concatenate([f[i] for f in found]) for i in range(4))
        docs = np.concatenate([np.full(len(f[0]), f[4], np.int64) for f in found])
        done = _settled((phrase, trigger), docs, shift)
        place = (first << 8) | count
        trigger = np.where(done, _mixed(docs.view(np.uint64) + place.astype(np.uint64)), trigger)
        return _longs(trigger, phrase, docs, np.where(done, ~place, place), names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, found, size = Parser(), [], 0
        for batch in sliced(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = text.as_py()
                found += [(*phrases, doc) for phrases in parser.phrases(data)]
                size += len(data)
                if size >= CHUNK and found:
                    yield flush(found)
                    found, size = [], 0
        if found:
            yield flush(found)

    long_enough = rows.filter(F.col("number").isNotNull() & (F.octet_length("data") >= LENGTH)).select("number", "data")
    return long_enough.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def looked_up(parse: DataFrame, shift: int = 0) -> DataFrame:
    """Rows (number, first, count, open) that are repeats (open null) or may hold some (open true).

    The second kind are phrases of the least document that share their trigger and a half context
    with another phrase.
    """
    sorted_ = parse.repartition("trigger").sortWithinPartitions("trigger", "phrase", "number")
    names = ["number", "first", "count", "open"]

    def shared(groups: np.ndarray, context: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Rows whose context another phrase of the trigger has as well; heads: first row of each phrase."""
        key = groups * 256 + context
        _, where, times = np.unique(key[heads], return_inverse=True, return_counts=True)
        by_phrase = (times[where] > 1) & (context[heads] > 0)
        return by_phrase[np.cumsum(heads) - 1]

    def settle(rows: list[np.ndarray], state: dict, cut: bool) -> pa.RecordBatch:
        trigger, phrase, doc, place = rows
        heads = np.ones(len(doc), bool)
        starts = heads.copy()
        starts[1:] = trigger[1:] != trigger[:-1]
        heads[1:] = starts[1:] | (phrase[1:] != phrase[:-1])
        least = doc[heads][np.cumsum(heads) - 1]
        goes_on = state.get("trigger") == trigger[0]
        if goes_on and state["phrase"] == phrase[0]:
            least[np.cumsum(heads) == 1] = state["least"]
        repeat = doc >> shift > least >> shift
        groups = np.cumsum(starts) - 1
        mixed = np.bincount(groups, heads)[groups] > 1
        bits = phrase.view(np.uint64)
        near = shared(groups, (bits >> np.uint64(56)).astype(np.int64), heads) | shared(
            groups, (bits >> np.uint64(48)).astype(np.int64) & 255, heads
        )
        keep = mixed & near
        if goes_on:  # the rest of a group that was too long to be held
            keep |= groups == 0
        if cut:
            keep |= groups == groups[-1]
        state.update(trigger=trigger[-1], phrase=phrase[-1], least=least[-1])
        out = repeat | keep
        return pa.RecordBatch.from_arrays(
            [
                pa.array(doc[out]), pa.array(place[out] >> 8), pa.array(place[out] & 255),
                pa.array(np.ones(out.sum(), bool), mask=repeat[out]),
            ],
            names=names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size, state = 0, {}
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            done = columns[3] < 0
            if done.any():
                doc, place = columns[2][done], ~columns[3][done]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc), pa.array(place >> 8), pa.array(place & 255), pa.nulls(len(doc), pa.bool_())], names=names
                )
                columns = [c[~done] for c in columns]
            if not len(columns[0]):
                continue
            held.append(columns)
            size += len(columns[0])
            if size < ROWS:
                continue
            rows = [np.concatenate([h[i] for h in held]) for i in range(4)]
            last = int(np.searchsorted(rows[0], rows[0][-1]))  # where the unfinished group begins
            cut = last == 0 or size - last > ROWS
            end = size if cut else last
            yield settle([r[:end] for r in rows], state, cut)
            held, size = ([[r[end:] for r in rows]], size - end) if end < size else ([], 0)
        if held:
            yield settle([np.concatenate([h[i] for h in held]) for i in range(4)], state, False)

    return sorted_.mapInArrow(run, "number long, first long, count long, open boolean")


def repeated_strings(numbered_: DataFrame, open_phrases: DataFrame, shift: int = 0) -> DataFrame:
    """(number, first, count) of the strings of open phrases that a document of a lesser id has."""
    wanted = open_phrases.groupBy("number").agg(F.collect_list(F.struct("first", "count")).alias("phrases"))
    rows = numbered_.join(wanted, "number").select("number", "data", "phrases")
    names = ["string", "number", "start"]

    def flush(found: list[tuple]) -> pa.RecordBatch:
        string, start = (np.concatenate([f[i] for f in found]) for i in range(2))
        docs = np.concatenate([np.full(len(f[0]), f[2], np.int64) for f in found])
        done = _settled((string,), docs, shift)
        string = np.where(done, _mixed(docs.view(np.uint64) + start.astype(np.uint64)), string)
        return _longs(string, docs, np.where(done, ~start, start), names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, found, size = Parser(), [], 0
        for batch in sliced(batches):
            for doc, data, phrases in zip(*(batch.column(i) for i in range(3)), strict=True):
                first = phrases.values.field("first").to_numpy(zero_copy_only=False)
                counts = phrases.values.field("count").to_numpy(zero_copy_only=False)
                starts = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
                starts = np.unique(starts)
                found.append((parser.strings(data.as_py(), starts), starts, doc.as_py()))
                size += len(starts)
                if size >= 4 * ROWS:
                    yield flush(found)
                    found, size = [], 0
        if found:
            yield flush(found)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = least_of_last = None
        for batch in batches:
            string, doc, start = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            done = start < 0
            repeated, first = [doc[done]], [~start[done]]
            string, doc, start = string[~done], doc[~done], start[~done]
            if len(doc):
                heads = np.ones(len(doc), bool)
                heads[1:] = string[1:] != string[:-1]
                runs = np.cumsum(heads) - 1
                least = doc[heads][runs]
                if string[0] == last:
                    least[runs == 0] = least_of_last
                repeat = doc >> shift > least >> shift
                repeated.append(doc[repeat])
                first.append(start[repeat])
                last, least_of_last = string[-1], least[-1]
            out, at = np.concatenate(repeated), np.concatenate(first)
            yield _longs(out, at, np.ones(len(out), np.int64), names=["number", "first", "count"])

    strings = rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))
    sorted_ = strings.repartition("string").sortWithinPartitions("string", "number")
    return sorted_.mapInArrow(settle, "number long, first long, count long")


def spans(rows: DataFrame, shift: int = 0) -> DataFrame:
    """Per numbered row with repeats: number and the runs of strings (first, count) that a lesser id has."""
    found = written(looked_up(parsed(rows, shift), shift), "phrases", let_go=True)
    strings = written(repeated_strings(rows, found.filter("open"), shift), "strings", let_go=True)
    every = found.filter("open IS NULL").select("number", "first", "count").unionByName(strings)
    return every.groupBy("number").agg(F.collect_list(F.struct("first", "count")).alias("runs"))


def kept_bytes(text: bytes, first: np.ndarray, count: np.ndarray, length: int = LENGTH) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed, and the maximal removed runs.

    Strings start at ``first`` and the ``count`` - 1 bytes behind it; runs that touch are one.
    """
    if not len(first):
        return text, 0, 0
    order = np.argsort(first)
    start = first[order]
    reach = np.maximum.accumulate(start + count[order] - 1 + length)
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    starts, ends = start[new], reach[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(start) - 1]))]
    pieces = [text[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(text)], strict=True)]
    return b"".join(pieces), int((ends - starts).sum()), len(starts)


def report(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    One row per input row; other columns are left out. Null and empty texts have no bytes.
    """
    rows, shift = numbered(documents)
    kind = dict(rows.dtypes)["doc_id"]
    runs = spans(rows, shift).withColumnRenamed("number", "__number")
    joined = rows.join(runs, F.col("number") == F.col("__number"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for value, found in zip(batch.column(1), batch.column(2), strict=True):
                data = value.as_py()
                first = count = np.empty(0, np.int64)
                if found.is_valid:
                    first, count = (found.values.field(f).to_numpy(zero_copy_only=False) for f in ("first", "count"))
                left, removed, n = kept_bytes(data, first, count)
                out.append((len(data), removed, n, hashlib.sha256(left).hexdigest()))
            columns = list(zip(*out, strict=True)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return joined.select("doc_id", "data", "runs").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
