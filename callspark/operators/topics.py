"""Topics of a call: sentences matched to a taxonomy, best candidates, primary and secondary."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callspark.functions.text import let, sentences_by_stop
from callspark.operators.skew import lookup_join
from callspark.session import written

# Similarity a match must exceed, candidates kept per call, labels for no topic.
THRESHOLD = 0.4
CANDIDATES = 10
UNIDENTIFIED, NO_SECOND = "Unidentified", "None"

#: A taxonomy up to this many vector components (64 MB of doubles) is sent to the tasks whole. A larger
#: one is cut into balls, and this bounds the components of their pivots.
MAX_COMPONENTS = 8_000_000
#: A taxonomy up to this many different words of topics is sent to the tasks whole (some 100 MB there).
MAX_WORDS = 1_000_000
#: Cells of one product of sentences and topics (32 MB of doubles).
PRODUCT_CELLS = 4_000_000
#: Sentences that meet a ball of topics in one task, and topics of a ball that they meet there.
GROUP_ROWS, BALL_ROWS = 20_000, 20_000
#: Angles are compared with this much room for rounding.
ROUNDING = 1e-6
#: Calls of which a task remembers how good their best matches are.
CALLS_HELD = 100_000


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two vectors; null if one has no length."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return let(F.struct(a.alias("a"), b.alias("b")), lambda v: dot(v["a"], v["b"]) / F.nullif(
        F.sqrt(dot(v["a"], v["a"])) * F.sqrt(dot(v["b"], v["b"])), F.lit(0.0)
    ))


def mean_vectors(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Mean vector per group, component by component, so that no group is collected."""
    parts = df.select(group, F.posexplode(vector).alias("i", "x")).groupBy(group, "i").agg(F.avg("x").alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "x")))
    return parts.groupBy(group).agg(F.transform(ordered, lambda p: p["x"]).alias(vector))


def _unit(vectors) -> np.ndarray:
    matrix = np.asarray([np.asarray(v, dtype=np.float64) for v in vectors], dtype=np.float64)
    with np.errstate(invalid="ignore", divide="ignore"):
        return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


class _BestOfCall:
    """Leaves of the matches of a batch those that can be among the k best of their call.

    The least of a call's best k so far is its threshold for later batches of the task. Forgetting a
    call, when more than ``CALLS_HELD`` are known, only lets more rows through.
    """

    def __init__(self, k: int, call: str, position: str):
        self.k, self.call, self.order = k, call, [call, "cos_sim", position, "topic_num"]
        self.best: dict[object, list[float]] = {}

    def floors(self, calls: pd.Series) -> np.ndarray:
        """Per row the cosine that it has to reach."""
        return np.array([b[0] if len(b := self.best.get(c, ())) == self.k else -np.inf for c in calls])

    def __call__(self, found: pd.DataFrame) -> pd.DataFrame:
        if len(self.best) > CALLS_HELD:
            self.best.clear()
        found = found.sort_values(self.order, ascending=[True, False, True, True], kind="stable")
        found = found.groupby(self.call, dropna=False, sort=False).head(self.k)
        for call, cosines in found.groupby(self.call, dropna=False, sort=False)["cos_sim"]:
            heap = self.best.setdefault(call, [])
            for c in cosines:
                if len(heap) < self.k:
                    heapq.heappush(heap, c)
                elif c > heap[0]:
                    heapq.heapreplace(heap, c)
        return found


def _pairs(
    rows: pd.DataFrame, vector: str, keep: list[str], nums, names, units, threshold, best: _BestOfCall | None = None
) -> Iterator[pd.DataFrame]:
    """The (row, topic) pairs above the threshold; only those leave the matrix product."""
    nums, names = np.asarray(nums), np.asarray(names, dtype=object)
    step = max(1, PRODUCT_CELLS // max(1, len(names)))
    for at in range(0, len(rows), step):
        part = rows.iloc[at:at + step]
        cos = _unit(part[vector]) @ units.T
        above = cos > threshold
        if best is not None:
            above &= cos >= best.floors(part[best.call])[:, None]
        r, t = np.nonzero(above)
        found = pd.DataFrame({
            **{c: part[c].to_numpy()[r] for c in keep}, "topic_num": nums[t], "topic": names[t], "cos_sim": cos[r, t],
        })
        yield found if best is None else best(found)


def match(
    sentences: DataFrame, topics: DataFrame, threshold: float = THRESHOLD, *, id: str = "file_path",
    position: str = "position", vector: str = "embedding", max_components: int = MAX_COMPONENTS, per_call: int | None = None,
) -> DataFrame:
    """Sentence and topic pairs whose cosine is above the threshold.

    ``topics`` has topic_num, topic and the vector. A taxonomy whose size has been checked goes to
    every task, where a batch of sentences is multiplied by it; the sentences are not shuffled. A
    larger one is cut into balls around pivots, and a sentence goes to the balls that can hold a
    match (see :func:`in_reach`). With ``per_call`` only pairs leave a task that can be among so
    many best ones of their call, by cosine, position and topic. Rows without a vector match nothing.
    """
    keep = [id, position]
    schema = T.StructType([
        *sentences.select(*keep).schema.fields, T.StructField("topic_num", T.LongType()),
        T.StructField("topic", T.StringType()), T.StructField("cos_sim", T.DoubleType()),
    ])
    narrow = sentences.select(*keep, vector).filter(F.col(vector).isNotNull())
    topics = topics.select(F.col("topic_num").cast("bigint").alias("topic_num"), "topic", vector).filter(F.col(vector).isNotNull())
    size = topics.agg(
        F.sum(F.size(vector)).alias("components"), F.count(F.lit(1)).alias("topics")
    ).first()
    if (size["components"] or 0) > max_components:
        balls = cut_into_balls(topics, size["topics"], size["components"], vector, max_components)
        return _match_balls(in_reach(narrow, balls, threshold, vector), balls, threshold, keep, vector, schema, per_call)
    rows = topics.orderBy("topic_num").collect()
    nums, names = [r["topic_num"] for r in rows], [r["topic"] for r in rows]
    units = _unit([r[vector] for r in rows]) if rows else np.empty((0, 0))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = _BestOfCall(per_call, id, position) if per_call else None
        for pdf in batches:
            if names:
                yield from _pairs(pdf, vector, keep, nums, names, units, threshold, best)

    return narrow.mapInPandas(run, schema)


@dataclass(frozen=True)
class Balls:
    """Topics around pivots: the pivots' units, the greatest angle in each ball, and the topics with ball and angle."""

    pivots: np.ndarray
    radius: np.ndarray
    sizes: np.ndarray
    topics: DataFrame


def _angles(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ pivots.T, -1.0, 1.0))


def _far_apart(units: np.ndarray, wanted: int) -> np.ndarray:
    """So many of the vectors, each the furthest from those taken before."""
    chosen, nearest = [0] * min(1, len(units)), np.full(len(units), -np.inf)
    while len(chosen) < min(wanted, len(units)):
        nearest = np.maximum(nearest, units @ units[chosen[-1]])
        chosen.append(int(nearest.argmin()))
    return units[chosen]


def cut_into_balls(topics: DataFrame, count: int, components: int, vector: str = "embedding", max_components: int = MAX_COMPONENTS) -> Balls:
    """Every topic goes to the ball of its nearest pivot.

    Pivots are chosen from topics drawn by a hash, each as far from those before as can be, about the
    square root of the number of topics. Drawn ones are never more than ``max_components`` numbers
    in all; they and the radii are all that the driver and the tasks hold. Topics without length
    match nothing and are left out.
    """
    most = max(1, max_components * count // components)
    wanted = max(1, min(math.isqrt(count), most))
    drawn = topics.orderBy(F.xxhash64("topic_num", "topic"), "topic_num").limit(min(16 * wanted, most))
    units = _unit([r[vector] for r in drawn.collect()])
    units = _far_apart(np.unique(units[~np.isnan(units).any(axis=1)], axis=0), wanted)
    if not len(units):  # only pivots without length were drawn: one ball that every sentence reaches
        units = np.ones((1, components // count)) / math.sqrt(components // count)
    schema = T.StructType([*topics.schema.fields, T.StructField("ball", T.IntegerType()), T.StructField("angle", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            angles = _angles(_unit(pdf[vector]), units)
            pdf = pdf.assign(ball=angles.argmin(1).astype(np.int32), angle=angles.min(1))
            yield pdf[~np.isnan(angles).any(axis=1)]

    placed = written(topics.mapInPandas(run, schema))
    radius, sizes = np.full(len(units), -np.inf), np.zeros(len(units), np.int64)
    for r in placed.groupBy("ball").agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("n")).collect():  # a row per pivot
        radius[r["ball"]], sizes[r["ball"]] = r["radius"], r["n"]
    return Balls(units, radius, sizes, placed)


def in_reach(sentences: DataFrame, balls: Balls, threshold: float, vector: str = "embedding") -> DataFrame:
    """A copy of each sentence for every ball that can hold a topic above the threshold: its columns, ball and angle to the pivot.

    Angles obey the triangle inequality: a topic is at least as far from a sentence as the pivot is,
    less the radius of the ball. So a sentence needs no ball whose pivot is further away than the
    radius and the angle of the threshold together.
    """
    reach = balls.radius + math.acos(min(1.0, max(-1.0, threshold))) + ROUNDING
    pivots = balls.pivots
    schema = T.StructType([*sentences.schema.fields, T.StructField("ball", T.IntegerType()), T.StructField("angle", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = max(1, PRODUCT_CELLS // len(pivots))
        for pdf in batches:
            for at in range(0, len(pdf), step):
                part = pdf.iloc[at:at + step]
                angles = _angles(_unit(part[vector]), pivots)
                row, ball = np.nonzero(angles <= reach)
                yield part.iloc[row].assign(ball=ball.astype(np.int32), angle=angles[row, ball])

    return sentences.mapInPandas(run, schema)


def _match_balls(reached: DataFrame, balls: Balls, threshold: float, keep, vector, schema, per_call: int | None) -> DataFrame:
    """Sentences meet the topics of their balls, in groups and pieces of bounded size.

    A ball that many sentences reach, or that holds many topics, is dealt over several tasks. In a
    task both sides are in order of their angle to the pivot, and a sentence is compared with the
    topics whose angle is near its own only, which is the same inequality once more.
    """
    spark = reached.sparkSession
    reached = written(reached)
    counts = {r["ball"]: r["count"] for r in reached.groupBy("ball").count().collect()}  # a row per pivot
    deal = spark.createDataFrame(
        [(b, max(1, -(-n // GROUP_ROWS)), max(1, -(-int(balls.sizes[b]) // BALL_ROWS))) for b, n in counts.items()],
        "ball int, groups int, pieces int",
    )
    left = reached.join(F.broadcast(deal), "ball").select(
        *keep, vector, "ball", "angle", F.pmod(F.xxhash64(*keep), F.col("groups")).cast("int").alias("__group"),
        F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("__piece"),
    )
    right = balls.topics.join(F.broadcast(deal), "ball").select(
        "topic_num", "topic", F.col(vector), "ball", "angle", F.pmod(F.xxhash64("topic_num", "topic"), F.col("pieces")).cast("int").alias("__piece"),
        F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("__group"),
    )
    width = math.acos(min(1.0, max(-1.0, threshold))) + ROUNDING

    def run(rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        best = _BestOfCall(per_call, *keep) if per_call else None
        rows, block = rows.sort_values("angle"), block.sort_values("angle")
        found = [pd.DataFrame(columns=schema.fieldNames(), dtype=object)]
        if len(rows) and len(block):
            units, angles = _unit(block[vector]), block["angle"].to_numpy()
            step = max(1, min(1000, PRODUCT_CELLS // len(block)))
            for at in range(0, len(rows), step):
                part = rows.iloc[at:at + step]
                low, high = np.searchsorted(angles, [part["angle"].iloc[0] - width, part["angle"].iloc[-1] + width])
                near = slice(low, high)
                found += [f for f in _pairs(part, vector, keep, block["topic_num"].to_numpy()[near], block["topic"].to_numpy()[near], units[near], threshold, best) if len(f)]
        return pd.concat(found[1:] or found)

    keys = ["ball", "__group", "__piece"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, schema)


def best_matches(sentences: DataFrame, topics: DataFrame, threshold: float = THRESHOLD, k: int = CANDIDATES, **columns) -> DataFrame:
    """The k best matches of every call with their rank: :func:`match` and :func:`top_candidates` with one bound.

    ``columns`` are the keyword arguments of :func:`match`.
    """
    order = {c: columns[c] for c in ("id", "position") if c in columns}
    return top_candidates(match(sentences, topics, threshold, per_call=k, **columns), k, **order)


def _bag(df: DataFrame, keys: list[str], text: str) -> tuple[DataFrame, DataFrame]:
    """Word counts per text, and the length of each count vector."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\w+"), F.lit(0))
    counts = df.select(*keys, F.explode(words).alias("word")).groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))
    lengths = counts.groupBy(*keys).agg(F.sqrt(F.sum(F.col("n") * F.col("n")).cast("double")).alias("length"))
    return counts, lengths


def _match_in_tasks(sentences: DataFrame, weights: DataFrame, threshold: float, keys: list[str], text: str) -> DataFrame:
    entries = weights.orderBy("topic_num", "topic", "word").collect()
    topics = sorted({(r["topic_num"], r["topic"]) for r in entries})
    place = {t: i for i, t in enumerate(topics)}
    by_word: dict[str, tuple[list[int], list[float]]] = {}
    for r in entries:
        at, weight = by_word.setdefault(r["word"], ([], []))
        at.append(place[r["topic_num"], r["topic"]])
        weight.append(r["n"])
    columns = {w: (np.array(at), np.array(weight, dtype=np.float64)) for w, (at, weight) in by_word.items()}
    nums, names = [t[0] for t in topics], [t[1] for t in topics]
    squares = np.zeros(len(topics))
    for at, weight in columns.values():
        squares[at] += weight * weight
    words = F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\w+"), F.lit(0))
    narrow = sentences.select(*keys, words.alias("__words"))
    schema = T.StructType([
        *narrow.select(*keys).schema.fields, weights.schema["topic_num"], weights.schema["topic"],
        T.StructField("cos_sim", T.DoubleType()),
    ])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows, found, cosines = [], [], []
            for i, own in enumerate(pdf["__words"]):
                counts = Counter(own if own is not None else ())
                dots = np.zeros(len(topics))
                for w in counts.keys() & columns.keys():
                    at, weight = columns[w]
                    dots[at] += counts[w] * weight
                if counts:
                    cos = np.sqrt(dots * dots / (sum(n * n for n in counts.values()) * squares))
                    hits = np.flatnonzero(cos > threshold)
                    rows += [i] * len(hits)
                    found += hits.tolist()
                    cosines += cos[hits].tolist()
            if found:
                yield pd.DataFrame({
                    **{c: pdf[c].to_numpy()[rows] for c in keys}, "topic_num": np.array(nums)[found],
                    "topic": np.array(names, dtype=object)[found], "cos_sim": cosines,
                })

    return narrow.mapInPandas(run, schema)


def _prefixes(entries: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """Of each text (keys, word, n, length, df) the words that a match above the threshold needs one of.

    Words are in one order for all texts, the most frequent of the taxonomy last. If two texts share no
    word before the point where the rest of one has a length of at most the threshold, their cosine is
    at most the threshold.
    """
    rest = F.sum(F.col("n") * F.col("n")).over(Window.partitionBy(*keys).orderBy(F.desc("df"), "word"))
    bound = threshold * threshold * F.col("length") * F.col("length") * (1 - 1e-9)
    return entries.withColumn("__rest", rest).filter(F.col("__rest") > bound).select(*keys, "word")


def word_candidates(
    counts: DataFrame, lengths: DataFrame, weights: DataFrame, keys: list[str], topic: list[str], threshold: float,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Pairs of text and topic that can have a cosine above the threshold, each once.

    An inverted index of the taxonomy that holds, for every topic, only the words of its prefix; each
    text looks up the words of its own prefix alone. A word that is everywhere is in hardly any prefix.
    """
    threshold = max(0.0, threshold)
    frequency = weights.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    index = _prefixes(weights.join(frequency, "word"), topic, threshold)
    known = lookup_join(counts, frequency, ["word"], rows_per_task=rows_per_task)  # other words are in no topic
    wanted = _prefixes(known.join(lengths, keys), keys, threshold)
    return lookup_join(wanted, index, ["word"], rows_per_task=rows_per_task).select(*keys, *topic).distinct()


def match_words(
    sentences: DataFrame, taxonomy: DataFrame, threshold: float = THRESHOLD, *, id: str = "file_path",
    position: str = "position", text: str = "sentence", rows_per_task: int | None = None,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """As :func:`match`, with word counts for vectors: no model, and no pair without a shared word.

    A taxonomy whose words have been counted, and are at most ``max_words``, goes to every task, where
    the products are added up sentence by sentence; sentences are not shuffled, and only pairs above
    the threshold leave. With a larger one sentences and descriptions meet by the words that can lift
    a pair over the threshold (:func:`word_candidates`), and their cosine is computed from the word
    counts of both.

    Cosines are the root of one quotient of whole numbers, so that equal ones are equal to the last bit
    and what is still equal is decided by position and topic.
    """
    keys, topic = [id, position], ["topic_num", "topic"]
    topic_counts, topic_lengths = _bag(taxonomy, topic, "description")
    weights = topic_counts.join(topic_lengths, topic)
    size = weights.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("word") + F.length("topic")), F.lit(0))).first()
    if size[0] <= max_words and size[1] <= 16 * max_words:
        return _match_in_tasks(sentences, weights, threshold, keys, text)
    counts, lengths = (written(x) for x in _bag(sentences, keys, text))
    weights = written(weights)
    pairs = word_candidates(counts, lengths, weights, keys, topic, threshold, rows_per_task)
    # Words that both have are found by hashing; counts are looked up among the few words with more than one.
    square = F.sum(F.col("n") * F.col("n"))

    def bag(side: str) -> list[Column]:
        repeated = F.collect_list(F.when(F.col("n") > 1, F.struct("word", "n")))
        return [F.collect_list("word").alias(f"__words_{side}"), F.map_from_entries(repeated).alias(f"__repeated_{side}"), square.alias(f"__square_{side}")]

    of_text, of_topic = counts.groupBy(*keys).agg(*bag("a")), weights.groupBy(*topic).agg(*bag("b"))
    one = F.lit(1).cast("bigint")
    product = F.aggregate(
        F.array_intersect("__words_a", "__words_b"), F.lit(0).cast("bigint"),
        lambda total, w: total + F.coalesce(F.try_element_at("__repeated_a", w), one) * F.coalesce(F.try_element_at("__repeated_b", w), one),
    )
    return (
        pairs.join(of_text, keys).join(of_topic, topic)
        .withColumn("__product", product)
        .select(*keys, *topic, F.sqrt(F.col("__product") * F.col("__product") / (F.col("__square_a") * F.col("__square_b"))).alias("cos_sim"))
        .filter(F.col("cos_sim") > threshold)
    )


def top_candidates(
    matches: DataFrame, k: int = CANDIDATES, *, id: str = "file_path", position: str = "position"
) -> DataFrame:
    """The k best matches per call (rows, so a topic may repeat), with their rank.

    Spark cuts every map task to k rows per call before the shuffle.
    """
    order = Window.partitionBy(id).orderBy(F.desc("cos_sim"), position, "topic_num")
    return matches.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def assign(candidates: DataFrame, calls: DataFrame, *, id: str = "file_path") -> DataFrame:
    """Adds ``topics`` = [primary, secondary] to every call.

    The candidates are ranked again by the best cosine of each distinct topic. Per call at most
    the k candidates are gathered.
    """
    best = candidates.groupBy(id, "topic_num", "topic").agg(F.max("cos_sim").alias("cos_sim"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("cos_sim")).alias("c"), "topic_num", "topic")))
    named = best.groupBy(id).agg(F.transform(ranked, lambda r: r["topic"]).alias("__topics"))
    pick = F.array(
        F.coalesce(F.get("__topics", F.lit(0)), F.lit(UNIDENTIFIED)),
        F.coalesce(F.get("__topics", F.lit(1)), F.lit(NO_SECOND)),
    )
    return calls.join(named, id, "left").withColumn("topics", pick).drop("__topics")


def assign_topics(
    calls: DataFrame, taxonomy: DataFrame, threshold: float = THRESHOLD, k: int = CANDIDATES, *,
    id: str = "file_path", text: str = "summary",
) -> DataFrame:
    """Topics of a summary text by word overlap with the topic descriptions."""
    sentences = calls.select(id, F.posexplode(sentences_by_stop(text)).alias("position", "sentence"))
    return assign(top_candidates(match_words(sentences, taxonomy, threshold, id=id), k, id=id), calls, id=id)
