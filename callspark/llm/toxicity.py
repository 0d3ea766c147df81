"""Toxicity by a linear classifier that must not react to the group a sentence mentions.

Features are the words of a text and the beginnings of its words, each counted once. For every
labelled text that names a group, a counterfactual is made by swapping the group words; training
adds to the logistic loss the squared change of the score between a text and its counterfactual, so
that a mention alone moves nothing and insults have to carry the label.

The classifier is fitted on a bounded sample of labelled rows (``Settings.sample_positive`` and
``sample_negative``, drawn by a hash of the id) and on a bounded number of features; every text is
scored as a whole. Each sampled row counts as often as the rows of its class that it stands for, so
that a score means the same whether a table fits the sample or not. Nulls and empty texts get the
score of a text without features.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callspark.llm.common import sliced, written

#: Groups of identity terms; a term is swapped for the next one of its group.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european"), ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "locals", "foreigners"), ("old", "young", "elderly"), ("deaf", "blind", "disabled"),
)

_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
_PREFIXES = (3, 4, 5, 6)


@dataclass(frozen=True)
class Settings:
    """Bounds and weights of the training; all of them are parameters of the method."""

    sample_positive: int = 6_000
    sample_negative: int = 12_000
    features: int = 8_192
    least_documents: int = 8
    #: Least difference of a feature's shares in the two classes, in standard deviations of the feature.
    least_difference: float = 0.2
    sparsity: float = 5e-4
    fairness: float = 1.0
    rounds: int = 300
    identity_terms: tuple[tuple[str, ...], ...] = field(default=IDENTITY_TERMS)


def _swaps(groups: tuple[tuple[str, ...], ...]) -> dict[bytes, bytes]:
    return {a.encode(): b.encode() for group in groups for a, b in zip(group, group[1:] + group[:1], strict=True)}


def features_of_words(words: set[bytes]) -> set[int]:
    """Numbers of the words and of their beginnings."""
    found = {zlib.crc32(w) for w in words}
    for n in _PREFIXES:
        found.update(zlib.crc32(b"%d:" % n + w[:n]) for w in words if len(w) > n)
    return found


def words_of(text: str | None) -> set[bytes]:
    """Distinct words of the whole text, A-Z in lower case."""
    return set(_WORD.findall(text.encode("utf-8", "replace").lower())) if text else set()


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are kept from the training: CRC-32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Model:
    """Weights by feature number. One that has not seen both classes has a bias of minus infinity: every score is 0."""

    def __init__(self, bias: float, weights: dict[int, float]):
        self.bias, self.weights = bias, weights

    def score(self, words: set[bytes]) -> float:
        weights = self.weights
        total = self.bias + math.fsum(sorted(weights[f] for f in features_of_words(words) if f in weights))
        return 1 / (1 + math.exp(-total)) if total >= 0 else math.exp(total) / (1 + math.exp(total))


def _sample(documents: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """A bounded, repeatable sample of the labelled rows that may be learned from: id, text, label, rows of its class per sampled row.

    An id is one row however often it comes; of its texts that of the least hash is taken.
    """
    known = labels.select(labels["doc_id"].alias("__id"), labels["toxic"].alias("__toxic")).filter(
        F.col("__id").isNotNull() & F.col("__toxic").isin(0, 1) & ~held_out(F.col("__id"))
    )
    known = known.groupBy("__id").agg(F.max("__toxic").cast("int").alias("__toxic"))
    rows = {r["__toxic"]: r["count"] for r in known.groupBy("__toxic").count().collect()}

    def draw(toxic: int, most: int) -> DataFrame:
        drawn = known.filter(F.col("__toxic") == toxic).orderBy(F.xxhash64("__id"), "__id").limit(most)
        return drawn.withColumn("__weight", F.lit(max(1.0, rows.get(toxic, 0) / most)))

    drawn = draw(1, settings.sample_positive).unionByName(draw(0, settings.sample_negative))
    # Bounded by the two sample sizes: 24 bytes for each drawn id.
    texts = documents.select(documents["doc_id"].alias("__id"), documents["text"].alias("__text"))
    found = texts.join(F.broadcast(drawn), "__id").groupBy("__id", "__toxic", "__weight")
    one = found.agg(F.min(F.struct(F.xxhash64("__text").alias("h"), F.col("__text").alias("t"))).alias("__one"))
    return one.select("__id", F.col("__one.t").alias("__text"), "__toxic", "__weight")


def _featured(sample: DataFrame, settings: Settings) -> DataFrame:
    """Features of each sampled text, and of its counterfactual where it names a group."""
    swaps = _swaps(settings.identity_terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            own, swapped = [], []
            for value in batch.column(1):
                words = words_of(value.as_py())
                found = features_of_words(words)
                named = words & swaps.keys()
                own.append(sorted(found))
                swapped.append(sorted(features_of_words({swaps.get(w, w) for w in words})) if named else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(own, pa.list_(pa.int64())), pa.array(swapped, pa.list_(pa.int64()))],
                names=["id", "toxic", "weight", "own", "swapped"],
            )

    kind = dict(sample.dtypes)["__id"]
    return sample.mapInArrow(run, f"id {kind}, toxic int, weight double, own array<long>, swapped array<long>")


def _chosen(featured: DataFrame, settings: Settings) -> list[int]:
    """The features that tell the classes apart best, a bounded number, and those of group words.

    How far a feature tells them apart does not depend on the number of rows or on how the classes
    were sampled; only ``least_documents``, against features of chance, counts sampled rows.
    """
    totals = featured.groupBy("toxic").agg(F.count("*").alias("n"), F.sum("weight").alias("weight")).collect()
    n, weight = {r["toxic"]: r["n"] for r in totals}, {r["toxic"]: r["weight"] for r in totals}
    ones, zeros = n.get(1, 0), n.get(0, 0)
    if not ones or not zeros:
        return []
    rate = weight[1] / (weight[0] + weight[1])
    counts = featured.select("toxic", F.explode("own").alias("feature")).groupBy("feature").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")
    )
    a, b = F.col("a") / ones, F.col("b") / zeros
    mean = a * rate + b * (1 - rate)
    distance = (a - b) / F.sqrt(mean * (1 - mean) + 1e-9)
    best = (
        counts.filter(F.col("a") + F.col("b") >= settings.least_documents)
        .select("feature", F.abs(distance).alias("distance"))
        .filter(F.col("distance") >= settings.least_difference)
        .orderBy(F.desc("distance"), "feature")
        .limit(settings.features)
    )
    named = {f for group in settings.identity_terms for term in group for f in features_of_words({term.encode()})}
    return sorted({r["feature"] for r in best.collect()} | named)


def fit(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learns from at most the sampled rows; without both classes there is nothing to tell them by, and every score is 0."""
    featured = written(_featured(_sample(documents, labels, settings), settings), "toxicity-sample")
    chosen = _chosen(featured, settings)
    if not chosen:
        return Model(-math.inf, {})
    column = {f: i for i, f in enumerate(chosen)}

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            lists = [
                pa.array([None if v is None else [column[f] for f in v if f in column] for v in batch.column(i).to_pylist()], pa.list_(pa.int32()))
                for i in (3, 4)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *lists], names=["id", "toxic", "weight", "own", "swapped"])

    kind = dict(featured.dtypes)["id"]
    rows = featured.mapInArrow(narrow, f"id {kind}, toxic int, weight double, own array<int>, swapped array<int>").orderBy("id").collect()
    bias, weights = train([(r["toxic"], r["own"], r["swapped"]) for r in rows], len(chosen), settings, [r["weight"] for r in rows])
    return Model(bias, {f: float(w) for f, w in zip(chosen, weights, strict=True) if abs(w) > 1e-9})


def train(
    rows: list[tuple[int, list[int], list[int] | None]], width: int, settings: Settings, weights: list[float] | None = None
) -> tuple[float, np.ndarray]:
    """Sparse logistic regression on (label, columns, counterfactual columns), by accelerated proximal steps.

    Loss: mean logistic loss + fairness * mean over counterfactuals of (change of the linear
    score)^2 + sparsity * |w|. The last term leaves features of chance at nothing. A row counts
    ``weights`` times in both means, once without them.
    """

    def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.repeat(np.arange(len(lists)), sizes), np.fromiter((x for v in lists for x in v), np.int64, int(sizes.sum()))

    labels = np.array([r[0] for r in rows], np.float64)
    n = len(labels)
    counted = np.ones(n) if weights is None else np.array(weights, np.float64)
    share = counted / counted.sum()
    at, columns = flat([r[1] for r in rows])
    pairs = [(set(r[1]), set(r[2])) for r in rows if r[2] is not None]
    gained, gained_columns = flat([sorted(b - a) for a, b in pairs])
    lost, lost_columns = flat([sorted(a - b) for a, b in pairs])

    def change(w: np.ndarray) -> np.ndarray:
        return np.bincount(gained, w[gained_columns], len(pairs)) - np.bincount(lost, w[lost_columns], len(pairs))

    def back(push: np.ndarray) -> np.ndarray:
        return np.bincount(gained_columns, push[gained], width) - np.bincount(lost_columns, push[lost], width)

    paired = counted[[r[2] is not None for r in rows]]
    fair = 2 * settings.fairness * paired / (paired.sum() or 1.0)

    def curved(w: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
        z = 0.25 * (np.bincount(at, w[columns], n) + bias) * share
        g = np.bincount(columns, z[at], width)
        return (g + back(fair * change(w)) if pairs else g), z.sum()

    # The steepest curvature of the smooth part, by power iteration, gives the step.
    w, bias = np.ones(width), 1.0
    steepest = 1.0
    for _ in range(30):
        w, bias = curved(w, bias)
        steepest = math.sqrt(float(w @ w) + bias * bias) or 1.0
        w, bias = w / steepest, bias / steepest
    step = 0.9 / steepest

    ones = float(counted @ labels)
    w, bias = np.zeros(width), math.log((ones + 0.5) / (counted.sum() - ones + 0.5))
    ahead, ahead_bias, t = w, bias, 1.0
    for _ in range(settings.rounds):
        z = np.bincount(at, ahead[columns], n) + ahead_bias
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) * share
        g = np.bincount(columns, error[at], width)
        if pairs:
            g += back(fair * change(ahead))
        moved = ahead - step * g
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * settings.sparsity, 0)
        new_bias = ahead_bias - step * error.sum()
        after = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead_bias = new + (t - 1) / after * (new - w), new_bias + (t - 1) / after * (new_bias - bias)
        w, bias, t = new, new_bias, after
    return bias, w


def score(documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """Per document its id, whether its label was held out, the score and the decision.

    One row per input row, also for nulls, empty texts and repeated ids; other columns are left out.
    """
    source = documents.select(documents[doc_id].alias("doc_id"), documents[text].alias("text"))
    kind = dict(source.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            scores = [model.score(words_of(v.as_py())) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = source.mapInArrow(run, f"doc_id {kind}, score double")
    rejected = F.col("score") >= threshold
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", rejected.cast("int").alias("predicted"))


def without_toxic(documents: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows whose text scores under the threshold, with the columns they came with."""
    place = documents.columns.index("text")
    schema = documents.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield batch.filter(pa.array([model.score(words_of(v.as_py())) < threshold for v in batch.column(place)], pa.bool_()))

    return documents.mapInArrow(run, schema)
