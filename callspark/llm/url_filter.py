"""URL filters: rules by host and path, and boosted trees on lexical features for the rest.

The trees are Spark ML's, trained on a bounded sample of labelled URLs, and applied as one column
expression made of their splits, so that scoring is a plain projection. The counts of the suffixes
of hosts, which are features, are taken over all labelled URLs and of all suffixes. Null URLs and those without
``://`` have an empty host and path; they match no rule that names one and are scored as they are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callspark.llm.common import ascii_lower, written

FEATURES = (
    "n_url", "n_host", "n_path", "depth", "host_depth", "digit_ratio", "entropy", "n_parameters", "n_marks", "suffix_rate", "suffix_count",
)


#: Rows of 24 bytes that the table of suffixes may have to be sent to the tasks.
SENT_SUFFIXES = 250_000


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains if the path of the URL starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Settings:
    """Bounds and weights of the training."""

    sample: int = 20_000
    rounds: int = 12
    depth: int = 3
    step: float = 0.2
    threshold: float = 0.5
    seed: int = 11


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased and path of a URL; both empty for null or without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def matched(host: Column, path: Column, rules: list[Rule], value) -> Column:
    """``value(rule)`` of the longest rule that fits, the first named on a tie; null without one."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):  # the last one written is asked first
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(value(rule))).otherwise(found)
    return found


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters of a text in bits; 0 for an empty one."""
    n = F.length(text)
    characters = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    shares = F.transform(characters, lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n)
    return F.aggregate(shares, F.lit(0.0), lambda s, p: s - p * F.log2(p))


def suffix(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def lexical(urls: DataFrame, url: str, *keep: Column) -> DataFrame:
    """Lexical features of each URL beside the columns to keep; those of the suffix come later."""
    text = F.coalesce(urls[url], F.lit(""))
    host, path = host_and_path(urls[url])
    base = urls.select(*keep, text.alias("__url"), host.alias("host"), path.alias("path"))
    n = F.length("__url")
    query = F.regexp_extract("__url", r"\?([^#]*)", 1)
    return base.select(
        "*",
        n.cast("double").alias("n_url"),
        F.length("host").cast("double").alias("n_host"),
        F.length("path").cast("double").alias("n_path"),
        _count(F.col("path"), "/").cast("double").alias("depth"),
        _count(F.col("host"), ".").cast("double").alias("host_depth"),
        (_count(F.col("__url"), "0123456789") / F.greatest(n, F.lit(1))).alias("digit_ratio"),
        entropy(F.col("__url")).alias("entropy"),
        F.when(query == "", 0.0).otherwise(_count(query, "&") + 1.0).alias("n_parameters"),
        _count(F.col("__url"), "-_%@~").cast("double").alias("n_marks"),
        F.xxhash64(suffix(F.col("host"))).alias("suffix"),
    )


def with_suffixes(features: DataFrame, statistics: DataFrame, prior: float, sent: bool) -> DataFrame:
    """Adds the share of blocked URLs and the logarithm of the count of a suffix.

    ``statistics`` has one row for each labelled suffix; ``sent`` says that it is small enough for
    a broadcast. Otherwise adaptive execution splits the rows of a frequent suffix.
    """
    joined = features.join(F.broadcast(statistics) if sent else statistics, "suffix", "left")
    return joined.withColumns({
        "suffix_rate": F.coalesce("suffix_rate", F.lit(prior)),
        "suffix_count": F.coalesce("suffix_count", F.lit(0.0)),
    })


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """URLs and blocked URLs of every suffix, over all rows of (url, label)."""
    host, _ = host_and_path(F.col("url"))
    return labelled.groupBy(F.xxhash64(suffix(host)).alias("suffix")).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("blocked"))


def suffix_statistics(counts: DataFrame, prior: float) -> DataFrame:
    """Smoothed share of blocked URLs and logarithm of the count of each suffix."""
    return counts.select(
        "suffix",
        ((F.col("blocked") + 20 * prior) / (F.col("n") + 20)).alias("suffix_rate"),
        F.log1p("n").alias("suffix_count"),
    )


@dataclass(frozen=True)
class Model:
    """Trees as nested conditions over the features, and what the suffix statistics need."""

    margin: str
    prior: float
    statistics: DataFrame
    sent: bool

    def probability(self) -> Column:
        """Probability of block for a row with all features."""
        return 1 / (1 + F.exp(-2 * F.expr(self.margin)))


def _as_sql(node, names: tuple[str, ...]) -> str:
    """One tree as a CASE expression."""
    if node.getClass().getSimpleName() == "LeafNode":
        return repr(node.prediction())
    split = node.split()
    test = f"{names[split.featureIndex()]} <= {split.threshold()!r}D"
    return f"CASE WHEN {test} THEN {_as_sql(node.leftChild(), names)} ELSE {_as_sql(node.rightChild(), names)} END"


def fit(labelled: DataFrame, settings: Settings = Settings(), url: str = "url", label: str = "label") -> Model:
    """Trees on at most ``settings.sample`` rows of (url, label 0 or 1), drawn by a hash of the URL; suffixes counted over all rows.

    Without rows of both labels the model is the share of ones, smoothed.
    """
    known = labelled.filter(labelled[url].isNotNull() & labelled[label].isin(0, 1))
    known = written(known.select(known[url].alias("url"), known[label].cast("int").alias("label")), "labelled-urls")
    drawn = known.orderBy(
        F.xxhash64(F.lit(settings.seed), "url"), "url", "label"
    ).limit(settings.sample)
    sample = written(lexical(drawn, "url", F.col("label")), "url-sample")
    counts = written(suffix_counts(known), "url-suffixes")
    n, ones, suffixes = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("blocked"), F.lit(0)), F.count(F.lit(1))).first()
    prior, sent = (ones + 1) / (n + 2), suffixes <= SENT_SUFFIXES
    statistics = suffix_statistics(counts, prior)
    if sample.select("label").distinct().count() < 2:
        return Model(repr(0.5 * math.log(prior / (1 - prior))) + "D", prior, statistics, sent)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        with_suffixes(sample, statistics, prior, sent)
    ).select("features", F.col("label").cast("double").alias("label"))
    trained = GBTClassifier(
        maxIter=settings.rounds, maxDepth=settings.depth, stepSize=settings.step, seed=settings.seed, minInstancesPerNode=20
    ).fit(rows.repartition(8, F.xxhash64("features")))
    trees = [
        f"{weight!r}D * ({_as_sql(tree._java_obj.rootNode(), FEATURES)})"
        for tree, weight in zip(trained.trees, trained.treeWeights, strict=True)
    ]
    return Model(" + ".join(trees), prior, statistics, sent)


def judge(
    urls: DataFrame, model: Model, rules: list[Rule], settings: Settings = Settings(), key: str = "page_id", url: str = "url"
) -> DataFrame:
    """Per row its key, host, path, the rule that decides (or null), the verdict and the score.

    One row per input row; other columns are left out.
    """
    features = with_suffixes(lexical(urls, url, urls[key].alias("page_id")), model.statistics, model.prior, model.sent)
    host, path = F.col("host"), F.col("path")
    score = model.probability()
    learned = F.when(score >= settings.threshold, F.lit("block")).otherwise(F.lit("allow"))
    return features.select(
        "page_id",
        "host",
        "path",
        matched(host, path, rules, lambda r: r.name).alias("rule"),
        F.coalesce(matched(host, path, rules, lambda r: r.verdict), learned).alias("verdict"),
        score.alias("score"),
    )
