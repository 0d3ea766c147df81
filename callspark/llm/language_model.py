"""Language-model scores from a log-frequency Bloom filter.

Counts of the n-grams of the training texts are quantised on a logarithmic scale: level l stands for
counts from ``base``^(l-1) up to ``base``^l. An n-gram of level l is put into a Bloom filter l times,
with the numbers 1 to l, and asked for with 1, 2, ... until the filter has it no more; what came back
last is its level. A false answer needs the filter to err at every number above the true one. The
filter holds no n-grams, only bits: ``bits`` for each entry.

Probabilities are smoothed with Dirichlet priors, from the order below upwards:
p_1 = (c(w) + 1/2) / (N + (V + 1)/2), and p_k = (c(context w) + prior * p_{k-1}) / (c(context) + prior).
Every text ends in an end token, which is also what the first word has for its context.

Training texts are counted in pieces, pieces meet by segments of the hash, and each segment sums its
keys and makes its own part of the filter, so nothing whole passes through one task. Segments are sent
to the workers in broadcasts of at most ``BROADCAST`` bytes, as many as fit ``PASS`` bytes at once. A
filter larger than that takes more passes over the texts: each fills in the levels of the n-grams of its
segments, one byte for each token and order, and the last pass computes the scores. Results do not depend
on the number of passes.

The exact counts of single words travel beside the filter, for the unsmoothed base score. N-grams are
compared by 63-bit hashes. Null and empty texts have the end token alone. Rows without an id are learnt
from. Each input row gives one row; other columns are left out, whatever their names. Without training
texts nothing is known and p_1 is 1 for every token.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callspark.llm.common import sliced, written

#: Bytes of text that are hashed at once, and tokens whose n-grams are counted at once.
PIECE, COUNTED = 1 << 20, 1 << 21
#: Segments of the hash. A segment's part of the filter is made by one task.
SEGMENT_BITS = 12
#: Bytes of one broadcast, and of all that are with the workers in one pass over the texts.
BROADCAST, PASS = 16 << 20, 192 << 20
#: Bytes of text that are scored at once.
SCORED = 2 << 20
#: Counts of single words from here on are kept apart, so that all others take two bytes.
MANY = (1 << 16) - 1

_STEP = 0x9E3779B97F4A7C15
_MULTIPLIER = np.uint64(_STEP)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_END = np.uint64(0x5851F42D4C957F2D)


@dataclass(frozen=True)
class Settings:
    """Order of the model, base of the levels, bits of the filter for each entry, and the weight of the lower order."""

    order: int = 2
    base: float = 1.5
    bits: int = 10
    prior: float = 50.0


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def held_out(doc_id: Column) -> Column:
    """Rows that are not learnt from: CRC-32 of the id as text leaves 1 modulo 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


# --- tokens and n-grams of a batch ------------------------------------------------------------------


class Hasher:
    """Hashes of the words of texts that lie one behind the other; keeps the powers for the longest word so far."""

    def __init__(self):
        self.powers = np.ones(1, np.uint64)

    def _piece(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        longest = int((ends - starts).max())
        if longest > len(self.powers):
            steps = np.full(1 << longest.bit_length(), _MULTIPLIER)
            steps[0] = 1
            self.powers = np.multiply.accumulate(steps)
        low, high = int(starts[0]), int(ends[-1])
        sizes = ends - starts
        # Each byte of a word counts with a power of its place in it; bytes between words are left out.
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        letters = _LOWER[data[low:high][at + np.repeat(starts - low, sizes)]]
        return np.add.reduceat((letters.astype(np.uint64) + np.uint64(1)) * self.powers[at], np.cumsum(sizes) - sizes)

    def tokens(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the tokens of all texts, an end token behind each, and the number of tokens of each text.

        ``offsets`` are the places in ``data`` where the texts begin, and the end of the last one.
        """
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = ~_SPACE[data]
        begins, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        filled = offsets[:-1] < offsets[1:]  # where one text ends and the next begins without a space
        first, last = offsets[:-1][filled], offsets[1:][filled] - 1
        begins[first], ends[last] = inside[first + 1], inside[last + 1]
        starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        pieces = np.searchsorted(starts, np.arange(0, len(data) + PIECE, PIECE))
        found = [self._piece(data, starts[a:b], stops[a:b]) for a, b in zip(pieces[:-1], pieces[1:], strict=True) if a < b]
        words = _mixed(np.concatenate(found)) if found else np.empty(0, np.uint64)
        before = np.searchsorted(starts, offsets[1:])
        return np.insert(words, before, _END), np.diff(before, prepend=0) + 1


def grams(tokens: np.ndarray, sizes: np.ndarray, order: int) -> list[np.ndarray]:
    """Keys of the n-grams that end at each token, from order 1 up; a text begins behind an end token.

    The last bit of a key tells single words from longer n-grams. Before the second token there is
    nothing to go back to, so longer contexts of the first tokens are shorter ones with end tokens.
    """
    begins = np.cumsum(sizes) - sizes
    place = np.arange(len(tokens)) - np.repeat(begins, sizes)
    one = np.uint64(1)
    chain, keys = tokens, [_mixed(tokens) | one]
    for k in range(1, order):
        earlier = np.full(len(tokens), _END)
        far = place >= k
        earlier[far] = tokens[np.flatnonzero(far) - k]
        chain = _mixed(chain * _MULTIPLIER + earlier)
        keys.append(chain & ~one)
    return keys


def _column(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column, null as empty."""
    texts = batch.column(i).fill_null("").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[places[0] : places[-1]], places - places[0]


# --- training ---------------------------------------------------------------------------------------


def counts(texts: DataFrame, order: int) -> DataFrame:
    """(key, n): n-grams of the texts with their counts in pieces; a key comes once per piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, size = Hasher(), [], 0

        def flush() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], names=["key", "n"])

        for batch in sliced(batches):
            found = grams(*hasher.tokens(*_column(batch, 0)), order)
            held += found
            size += len(found[0])
            if size >= COUNTED:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return texts.mapInArrow(run, "key long, n long")


def level(n: np.ndarray, base: float) -> np.ndarray:
    """1 for a count of 1, and one more for every factor of ``base``."""
    return 1 + np.floor(np.log(n) / np.log(base) + 1e-9).astype(np.int64)


def count_of(levels: int, base: float) -> np.ndarray:
    """The mean of the counts of each level up to ``levels``, 0 for level 0."""
    out = np.zeros(levels + 1)
    for i in range(1, levels + 1):
        low, high = np.ceil(base ** (i - 1) - 1e-9), np.ceil(base**i - 1e-9) - 1
        out[i] = (low + max(low, high)) / 2
    return out


def _entry(keys: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """For an entry of each key: where it goes, as a share of 2^32, and its four bits in the word there."""
    h = _mixed(keys + np.uint64(number * _STEP & (1 << 64) - 1))
    mask = np.zeros(len(keys), np.uint64)
    for shift in (0, 6, 12, 18):
        mask |= np.uint64(1) << ((h >> np.uint64(shift)) & np.uint64(63))
    return h >> np.uint64(32), mask


def filter_words(keys: np.ndarray, levels: np.ndarray, bits: int) -> np.ndarray:
    """A part of the filter: 64-bit words that hold the entries of these keys."""
    words = np.zeros(max(1, -(-int(levels.sum()) * bits // 64)), np.uint64)
    for number in range(1, int(levels.max(initial=0)) + 1):
        share, mask = _entry(keys[levels >= number], number)
        at = (share * np.uint64(len(words)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        at, mask = at[order], mask[order]
        heads = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
        words[at[heads]] |= np.bitwise_or.reduceat(mask, heads)
    return words


def segments(counted: DataFrame, settings: Settings) -> DataFrame:
    """Per segment its part of the filter, and the keys and exact counts of its single words."""
    segment = F.shiftrightunsigned("key", 64 - SEGMENT_BITS).cast("int")
    dealt = counted.withColumn("segment", segment).repartition("segment").sortWithinPartitions("key").select("key", "n")

    def part(keys: list[np.ndarray], n: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.concatenate(keys), np.concatenate(n)
        heads = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
        keys, n = keys[heads], np.add.reduceat(n, heads)
        single = (keys & np.uint64(1)) == 1
        words = filter_words(keys, level(n, settings.base), settings.bits)
        return pa.RecordBatch.from_pydict({
            "segment": pa.array([int(keys[0] >> np.uint64(64 - SEGMENT_BITS))], pa.int32()),
            "words": pa.array([words.tobytes()], pa.binary()),
            "known": pa.array([keys[single].tobytes()], pa.binary()),
            "times": pa.array([np.minimum(n[single], MANY).astype(np.uint16).tobytes()], pa.binary()),
            "many": pa.array([n[single][n[single] >= MANY].tobytes()], pa.binary()),
            "n_tokens": pa.array([int(n[single].sum())], pa.int64()),
            "n_known": pa.array([int(single.sum())], pa.int64()),
            "bytes": pa.array([words.nbytes + 10 * int(single.sum())], pa.int64()),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, current = [], [], None
        for batch in batches:
            found = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            times = batch.column(1).to_numpy(zero_copy_only=False)
            own = found >> np.uint64(64 - SEGMENT_BITS)
            edges = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                if current is not None and own[a] != current:
                    yield part(keys, n)
                    keys, n = [], []
                current = own[a]
                keys.append(found[a:b])
                n.append(times[a:b])
        if keys:
            yield part(keys, n)

    return dealt.mapInArrow(
        run, "segment int, words binary, known binary, times binary, many binary, n_tokens long, n_known long, bytes long"
    )


@dataclass(frozen=True)
class Model:
    """The stored segments, the training tokens and the distinct ones among them."""

    parts: DataFrame
    tokens: int
    distinct: int
    settings: Settings


def train(documents: DataFrame, settings: Settings = Settings()) -> Model:
    """Learns from all rows that are not held out, whole texts."""
    texts = documents.filter(~held_out(documents["doc_id"])).select(documents["text"].alias("text"))
    parts = written(segments(counts(texts, settings.order), settings), "segments", let_go=True)
    total = parts.agg(F.sum("n_tokens"), F.sum("n_known")).first()
    return Model(parts, total[0] or 0, total[1] or 0, settings)


# --- scoring ----------------------------------------------------------------------------------------


class Filter:
    """Some segments of a model, as one array of words, and the exact counts of their single words."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: r["segment"])
        size = 1 << SEGMENT_BITS
        self.sizes, self.offsets = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        parts = [np.frombuffer(r["words"], np.uint64) for r in rows]
        at = [r["segment"] for r in rows]
        self.sizes[at] = [len(p) for p in parts]
        self.offsets[at] = np.cumsum([0, *map(len, parts)])[:-1]
        self.words = np.concatenate(parts)
        # Segments are ranges of keys in order, and keys are in order inside each.
        self.known = np.concatenate([np.frombuffer(r["known"], np.uint64) for r in rows])
        self.times = np.concatenate([np.frombuffer(r["times"], np.uint16) for r in rows])
        self.limit = MANY
        self.many_at = np.flatnonzero(self.times == self.limit)
        self.many = np.concatenate([np.frombuffer(r["many"], np.int64) for r in rows])

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each key by asking for its entries one after the other; 0 for segments of other filters."""
        segment = (keys >> np.uint64(64 - SEGMENT_BITS)).astype(np.int64)
        sizes, offsets = self.sizes[segment], self.offsets[segment]
        out = np.zeros(len(keys), np.uint8)
        left, number = np.flatnonzero(sizes), 0
        while len(left) and number < 255:
            number += 1
            share, mask = _entry(keys[left], number)
            at = offsets[left] + (share * sizes[left] >> np.uint64(32)).astype(np.int64)
            left = left[(self.words[at] & mask) == mask]
            out[left] = number
        return out

    def exact(self, keys: np.ndarray) -> np.ndarray:
        """Count of each single word, 0 if it is none of these segments."""
        if not len(self.known):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
        times = self.times[at].astype(np.int64)
        full = np.flatnonzero(times == self.limit)
        times[full] = self.many[np.searchsorted(self.many_at, at[full])]
        return np.where(self.known[at] == keys, times, 0)


def probabilities(levels: np.ndarray, sizes: np.ndarray, model_tokens: int, distinct: int, settings: Settings) -> np.ndarray:
    """Smoothed probability of each token from the levels of the n-grams that end there, one row per order."""
    n = count_of(255, settings.base)[levels]
    begins = np.cumsum(sizes) - sizes
    p = (n[0] + 0.5) / (model_tokens + 0.5 * (distinct + 1))
    for k in range(1, settings.order):
        # The context of order k is the n-gram that ended one token before, or end tokens alone at the start.
        context = np.concatenate(([0.0], n[k - 1][:-1]))
        context[begins] = np.inf if k > 1 else 0.0
        if k == 1:
            context[begins] = n[0][begins + sizes - 1]  # the text's own end token
        seen = np.minimum(n[k], context)
        p = np.where(np.isinf(context), p, (seen + settings.prior * p) / (context + settings.prior))
    return np.minimum(p, 1.0)


def _passes(model: Model) -> list[list[tuple[int, int]]]:
    """Ranges of segments for each broadcast of each pass, by the stored sizes of the segments."""
    passes: list[list[tuple[int, int]]] = [[]]
    held = whole = 0
    first = None
    for r in model.parts.select("segment", "bytes").orderBy("segment").collect():  # at most 2^SEGMENT_BITS rows
        if first is not None and held + r["bytes"] > BROADCAST:
            passes[-1].append((first, r["segment"]))
            first, held = None, 0
            if whole + BROADCAST > PASS:
                passes.append([])
                whole = 0
        first = r["segment"] if first is None else first
        held, whole = held + r["bytes"], whole + r["bytes"]
    passes[-1].append((first or 0, 1 << SEGMENT_BITS))
    return passes


def score(documents: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, log10 of probabilities.

    ``base_score`` takes exact counts of single words, c + 1/2 over N + (V + 1)/2.
    """
    spark, settings, order = documents.sparkSession, model.settings, model.settings.order
    rows = documents.select(
        documents["doc_id"].alias("doc_id"), documents["text"].alias("text"),
        F.lit(None).cast("binary").alias("levels"), F.lit(0).cast("long").alias("n_known"), F.lit(0.0).alias("base"),
    )
    kind = dict(rows.dtypes)["doc_id"]
    floor = model.tokens + 0.5 * (model.distinct + 1)
    passes = _passes(model)

    def passed(source: DataFrame, sent: list, last: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hasher, filters = Hasher(), [b.value for b in sent]
            for batch in sliced(batches, size=SCORED):
                tokens, sizes = hasher.tokens(*_column(batch, 1))
                begins = np.cumsum(sizes) - sizes
                stored = b"".join(x for x in batch.column(2).to_pylist() if x is not None)
                state = np.frombuffer(stored, np.uint8).reshape(-1, order) if stored else np.zeros((len(tokens), order), np.uint8)
                state = state.T.copy()
                known, base = (batch.column(i).to_numpy(zero_copy_only=False).copy() for i in (3, 4))
                for k, keys in enumerate(grams(tokens, sizes, order)):
                    distinct, where = np.unique(keys, return_inverse=True)
                    for f in filters:
                        state[k] |= f.levels(distinct)[where]
                    if k == 0:
                        times = np.zeros(len(distinct), np.int64)
                        for f in filters:
                            times += f.exact(distinct)
                        found = (times > 0)[where]
                        known += np.add.reduceat(found.astype(np.int64), begins)
                        base += np.add.reduceat(np.where(found, np.log10(times + 0.5)[where] - np.log10(0.5), 0.0), begins)
                if not last:
                    out = [state[:, b : b + s].T.tobytes() for b, s in zip(begins.tolist(), sizes.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns[:2], pa.array(out, pa.binary()), pa.array(known), pa.array(base)], names=batch.schema.names
                    )
                    continue
                p = probabilities(state, sizes, model_tokens, model_distinct, settings)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array(sizes, pa.int64()), pa.array(known, pa.int64()),
                        pa.array(base + sizes * (np.log10(0.5) - np.log10(floor))), pa.array(np.add.reduceat(np.log10(p), begins)),
                    ],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
                )

        model_tokens, model_distinct = model.tokens, model.distinct
        if last:
            return source.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
        return source.mapInArrow(run, source.schema)

    for number, ranges in enumerate(passes):
        sent = []
        for low, high in ranges:
            part = model.parts.filter((F.col("segment") >= low) & (F.col("segment") < high)).collect()  # at most BROADCAST bytes
            if part:
                sent.append(spark.sparkContext.broadcast(Filter(part)))
        last = number == len(passes) - 1
        rows = passed(rows, sent, last)
        if not last:
            rows = written(rows, "levels")
            for b in sent:
                b.destroy()
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
