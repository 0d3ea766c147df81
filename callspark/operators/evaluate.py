"""Judge scores, averages, distribution statistics, thresholds, commentary."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Metrics per judged stage, the score of an unreadable answer, the pass mark.
JUDGE_METRICS = {
    "summary": (
        "accuracy", "relevance", "conciseness", "sentiment_alignment", "clarity", "overall_quality",
    ),
    "redaction": (
        "pii_coverage", "over_redaction", "consistency", "legibility_post_redaction",
        "redaction_speed", "overall_redaction_quality",
    ),
    "topics": (
        "topic_relevance", "topic_coverage", "topic_accuracy", "classification_consistency",
        "call_classification_speed", "overall_classification_quality",
    ),
    "insights": (
        "category_accuracy", "main_issue_relevance", "steps_taken_clarity",
        "sentiment_appropriateness", "urgency_detection", "follow_up_actions",
        "repeated_issues_identification", "customer_loyalty_indicators",
        "transfer_involvement_accuracy", "department_transferred_to_accuracy",
        "issue_resolution_status", "satisfaction_score_accuracy", "overall_evaluation",
    ),
}
FAILED = -1.0
PASS_MARK = 7.0
BELOW, ABOVE = "below-threshold", "above-threshold"

# --- judge answers ------------------------------------------------------------------------------


def score_schema(metrics: Iterable[str]) -> str:
    """Each metric as text, as it may be an object with a score or the bare number."""
    return ", ".join(f"`{m}` string" for m in metrics)


def _score(value: Column) -> Column:
    return F.coalesce(F.get_json_object(value, "$.score").try_cast("double"), value.try_cast("double"))


def parse_scores(df: DataFrame, response: str, metrics: Sequence[str], into: str = "eval") -> DataFrame:
    """Adds the judge's answer as a struct of ``metric.score``.

    JSON and Python quoting are both read, and a metric may hold an object with a score or the
    score alone. An answer that is not one object, or has none of the metrics, scores -1 throughout;
    a metric missing from a readable answer is null.
    """
    answer = F.from_json(response, score_schema(metrics))
    parsed = F.struct(*[F.struct(_score(answer[m]).alias("score")).alias(m) for m in metrics])
    readable = F.col(response).rlike(r"(?s)^\s*\{.*\}\s*$")
    any_score = F.coalesce(*[_score(answer[m]) for m in metrics]).isNotNull()
    failed = F.struct(*[F.struct(F.lit(FAILED).alias("score")).alias(m) for m in metrics])
    return df.withColumn(into, F.when(readable & any_score, parsed).otherwise(failed))


def expand(df: DataFrame, struct: str = "eval") -> DataFrame:
    """The fields of a struct as columns beside the others."""
    return df.select("*", f"{struct}.*")


def extract_scores(df: DataFrame, metrics: Sequence[str], struct: str = "eval") -> DataFrame:
    """One number per metric in place of the struct."""
    others = [c for c in df.columns if c != struct]
    return df.select(*others, *[F.col(f"{struct}.{m}.score").alias(m) for m in metrics])


def judge(
    df: DataFrame, template: str, columns: Mapping[str, str], predictor, metrics: Sequence[str],
    batch_size: int = 10,
) -> DataFrame:
    """Prompt, judge model, scores: one number per metric for every row.

    ``predictor`` makes a model whose ``predict`` turns a batch with a ``prompt`` column into one
    with a ``response`` column; a row it fails on scores -1.
    """
    from callspark.functions.text import render
    from callspark.operators.infer import map_predict

    prompts = df.withColumn("prompt", render(template, **columns))
    answers = map_predict(prompts, predictor, "response string", batch_size, {"response": ""})
    return extract_scores(
        parse_scores(answers.drop("prompt", "error", "processing_time"), "response", metrics), metrics
    ).drop("response")


# --- averages and counts ------------------------------------------------------------------------


def _per_metric(df: DataFrame, metrics: Sequence[str], stats: Mapping[str, object]) -> DataFrame:
    """One pass over the table, one row per metric; ``stats`` maps a name to an aggregate of a column."""
    row = df.agg(*[
        F.struct(F.lit(m).alias("metric"), *[agg(F.col(f"`{m}`")).alias(s) for s, agg in stats.items()]).alias(f"s{i}")
        for i, m in enumerate(metrics)
    ])
    return row.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(metrics))])))


def summary(df: DataFrame, metrics: Sequence[str], exclude_failed: bool = False) -> DataFrame:
    """Average per metric. The -1 of unreadable answers counts unless ``exclude_failed`` is set."""
    def average(c: Column) -> Column:
        return F.avg(F.when(c != FAILED, c)) if exclude_failed else F.avg(c)

    return _per_metric(df, metrics, {"average": average})


def threshold_flags(averages: DataFrame, thresholds: Mapping[str, float] | float = PASS_MARK) -> DataFrame:
    """Adds the threshold of each metric and whether its average is below it."""
    if isinstance(thresholds, Mapping):
        mark = F.lit(PASS_MARK)
        for metric, value in thresholds.items():
            mark = F.when(F.col("metric") == metric, F.lit(float(value))).otherwise(mark)
    else:
        mark = F.lit(float(thresholds))
    return averages.withColumn("threshold", mark).withColumn(
        "flag", F.when(F.col("average") < F.col("threshold"), BELOW).otherwise(ABOVE)
    )


def timing(df: DataFrame, seconds: str = "processing_time") -> DataFrame:
    """Number of files, and total, average, longest and shortest time."""
    c = F.col(seconds)
    return df.agg(
        F.count(c).alias("files"), F.sum(c).alias("total"), F.avg(c).alias("average"),
        F.max(c).alias("longest"), F.min(c).alias("shortest"),
    )


def sample_head(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order).limit(n)


# --- distributions ------------------------------------------------------------------------------


#: Accuracy of the sketches that bracket a quantile: a rank is off by at most one in this many.
SKETCH_ACCURACY = 10_000
#: Rows of a bracket above which it is narrowed by another sketch before its values are sorted.
BRACKET_ROWS = 5_000_000


def quantiles(
    df: DataFrame, metrics: Sequence[str], probabilities: Sequence[float], accuracy: int = SKETCH_ACCURACY,
    bracket_rows: int = BRACKET_ROWS,
) -> DataFrame:
    """Exact quantiles with linear interpolation, as (metric, probability, value); nulls do not count.

    No task sees a whole column. A sketch per metric brackets every wanted rank between two values
    that are surely below and above it; the rows under the bracket are counted, a bracket that
    still holds many rows is narrowed again as long as that helps, one that does not hold its rank
    is widened, and only the distinct values inside are put in order.
    Each of these scans sends one row of numbers to the driver.
    """
    columns = [F.col(f"`{m}`").cast("double") for m in metrics]
    columns = [F.when(~F.isnan(c), c) for c in columns]
    reach = 4.0 / accuracy
    ends = [min(max(p + side, 0.0), 1.0) for p in probabilities for side in (-reach, reach)]
    sketch = df.agg(*[
        F.struct(
            F.count(c).alias("n"), F.min(c).alias("least"), F.max(c).alias("most"),
            F.percentile_approx(c, ends, accuracy).alias("ends"),
        ).alias(f"m{i}")
        for i, c in enumerate(columns)
    ]).first()
    targets = []
    for i, metric in enumerate(metrics):
        found = sketch[f"m{i}"]
        for k, p in enumerate(probabilities if found["n"] else []):
            place = (found["n"] - 1) * p
            few = found["n"] <= accuracy
            low = found["least"] if few or p <= reach else found["ends"][2 * k]
            high = found["most"] if few or p >= 1 - reach else found["ends"][2 * k + 1]
            targets.append((columns[i], metric, float(p), place, low, high))
    schema = "metric string, probability double, value double"
    if not targets:
        return df.sparkSession.createDataFrame([], schema)

    settled: set[int] = set()
    while True:
        beside = df.agg(*[
            F.struct(
                F.count(F.when(c < low, 1)).alias("below"), F.min(F.when(c > high, c)).alias("next"),
                F.count(F.when(c.between(low, high), 1)).alias("inside"),
            ).alias(f"b{j}")
            for j, (c, *_, low, high) in enumerate(targets)
        ]).first()
        missed = []
        for j, (*kept, place, low, high) in enumerate(targets):
            found, ends = beside[f"b{j}"], sketch[f"m{metrics.index(kept[1])}"]
            under, over = int(place) < found["below"], int(place) >= found["below"] + found["inside"]
            if under or over:  # a sketch was off: take the whole side in, and do not narrow it again
                targets[j] = (*kept, place, ends["least"] if under else low, ends["most"] if over else high)
                missed.append(j)
        settled.update(missed)
        if missed:
            continue
        wide = [
            j for j, (*_, low, high) in enumerate(targets)
            if j not in settled and beside[f"b{j}"]["inside"] > max(bracket_rows, accuracy) and low < high
        ]
        if not wide:
            break
        shares = {j: (targets[j][3] - beside[f"b{j}"]["below"]) / beside[f"b{j}"]["inside"] for j in wide}
        narrowed = df.agg(*[
            F.percentile_approx(
                F.when(targets[j][0].between(*targets[j][4:]), targets[j][0]),
                [min(max(shares[j] + side, 0.0), 1.0) for side in (-reach, reach)], accuracy,
            ).alias(f"b{j}")
            for j in wide
        ]).first()
        for j in wide:
            *kept, low, high = targets[j]
            ends = (low if shares[j] <= reach else narrowed[f"b{j}"][0], high if shares[j] >= 1 - reach else narrowed[f"b{j}"][1])
            if ends == (low, high):  # many rows, few values: the distinct ones are put in order
                settled.add(j)
            targets[j] = (*kept, *ends)
    inside = F.filter(
        F.array(*[
            F.struct(F.lit(j).alias("target"), F.when(c.between(low, high), c).alias("value"))
            for j, (c, *_, low, high) in enumerate(targets)
        ]),
        lambda t: t["value"].isNotNull(),
    )
    bracketed = df.select(F.explode(inside).alias("t")).groupBy("t.target", "t.value").agg(F.count(F.lit(1)).alias("n"))
    ranks = F.array(*[
        F.struct(
            F.lit(metric).alias("metric"), F.lit(p).alias("probability"), F.lit(beside[f"b{j}"]["below"]).alias("below"), F.lit(beside[f"b{j}"]["next"]).cast("double").alias("next"),
            F.lit(int(place)).cast("bigint").alias("rank"), F.lit(place - int(place)).alias("share"),
        )
        for j, (_, metric, p, place, *_) in enumerate(targets)
    ])
    upto = Window.partitionBy("target").orderBy("value")
    placed = bracketed.withColumn("w", F.get(ranks, F.col("target"))).select(
        "w.*", "value", (F.col("w.below") + F.sum("n").over(upto)).alias("upto")
    )
    low = F.min(F.when(F.col("upto") > F.col("rank"), F.col("value")))
    high = F.min(F.when(F.col("upto") > F.col("rank") + 1, F.col("value")))
    high = F.coalesce(high, F.first("next"), low)
    return placed.groupBy("metric", "probability", "share").agg(
        (low + (high - low) * F.col("share")).alias("value")
    ).drop("share")


def _quantile_columns(df: DataFrame, metrics: Sequence[str], named: Mapping[str, float]) -> DataFrame:
    found = quantiles(df, metrics, list(named.values()))
    return found.groupBy("metric").agg(*[
        F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name) for name, p in named.items()
    ])


def moments(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Mean, median and sample standard deviation per metric; nulls do not count."""
    wide = _per_metric(df, metrics, {"mean": F.avg, "std": F.stddev_samp})
    return wide.join(_quantile_columns(df, metrics, {"median": 0.5}), "metric", "left")


def describe(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, quartiles and max per metric."""
    wide = _per_metric(
        df, metrics,
        {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max},
    )
    quartiles = _quantile_columns(df, metrics, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return wide.join(quartiles, "metric", "left").select(
        "metric", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Counts in equal bins from the minimum to the maximum, empty bins included.

    The last bin holds the maximum; if all values are equal the range is one wide, around them.
    """
    v = F.col(value).cast("double")
    limits = df.agg(F.min(v).alias("least"), F.max(v).alias("most")).first()
    if limits["least"] is None:
        return df.sparkSession.createDataFrame([], "bin bigint, low double, high double, count bigint")
    half = 0.5 if limits["least"] == limits["most"] else 0.0
    least, most = limits["least"] - half, limits["most"] + half
    counts = (
        df.filter(v.isNotNull())
        .groupBy(F.least(F.width_bucket(v, F.lit(least), F.lit(most), F.lit(bins)), F.lit(bins).cast("bigint")).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (most - least) / bins
    frame = df.sparkSession.range(1, bins + 1).select(
        F.col("id").alias("bin"), (F.lit(least) + width * (F.col("id") - 1)).alias("low"),
        (F.lit(least) + width * F.col("id")).alias("high"),
    )
    return frame.join(counts, "bin", "left").select(
        "bin", "low", "high", F.coalesce("n", F.lit(0).cast("bigint")).alias("count")
    )


# --- commentary ---------------------------------------------------------------------------------

# Per metric the statistic, its limits from the top, and the sentence of each range.
COMMENTS = {
    "Accuracy": ("mean", [
        (0.8, "Excellent accuracy with a mean score of %.2f."),
        (0.6, "Moderate accuracy with a mean score of %.2f."),
        (None, "Low accuracy with a mean score of %.2f, indicating significant room for improvement."),
    ]),
    "Relevance": ("mean", [
        (0.7, "The relevance score is strong with an average of %.2f."),
        (None, "Relevance is moderate, averaging %.2f, indicating possible mismatch in some summaries."),
    ]),
    "Conciseness": ("std", [
        (0.5, "Conciseness is consistent with low variability (std = %.2f)."),
        (None, "Conciseness shows some variability (std = %.2f), indicating inconsistency in summary length."),
    ]),
    "Sentiment Alignment": ("mean", [
        (0.75, "Strong sentiment alignment with a mean score of %.2f."),
        (None, "Sentiment alignment is moderate (mean = %.2f), suggesting room for improvement."),
    ]),
    "Clarity": ("std", [
        (1.0, "Clarity is consistent with low variability (std = %.2f), indicating stable clarity across summaries."),
        (None, "Clarity shows significant variability (std = %.2f), meaning some summaries may be unclear."),
    ]),
    "Overall Quality": ("mean", [
        (0.8, "Overall quality is excellent with a mean score of %.2f."),
        (0.6, "Overall quality is moderate with a mean score of %.2f."),
        (None, "Overall quality is poor with a mean score of %.2f, requiring significant improvement."),
    ]),
}
PLAIN_COMMENT = "Analysis for %s metric."
RANGE_COMMENT = " The scores range from %s to %s with a standard deviation of %s."


def commentary(described: DataFrame, mode: str = "reference") -> DataFrame:
    """A sentence or two on each metric of a :func:`describe` table, as (metric, comment).

    ``mode="reference"`` looks a metric up by its name with a capital first letter, so metrics of
    two words get the plain sentence; ``mode="fixed"`` looks up their title-case names. A mean is
    compared upwards (above the limit), a standard deviation downwards (below it).
    """
    if mode not in ("reference", "fixed"):
        raise ValueError(f"unknown mode: {mode}")
    @F.pandas_udf("string")
    def two_places(values: pd.Series) -> pd.Series:
        return values.map(lambda v: f"{v:.2f}")

    # Java rounds the shortest decimal form, so that 6.975 becomes 6.98; the value itself is below
    # and has to become 6.97. There is one row per metric here.
    named = {stat: two_places(F.coalesce(stat, F.lit(float("nan")))) for stat in ("mean", "std")}
    described = described.withColumns({f"{stat}_text": text for stat, text in named.items()})
    lowered = F.lower("metric")
    name = (
        F.concat(F.upper(F.substring(lowered, 1, 1)), F.substr(lowered, F.lit(2)))
        if mode == "reference" else F.initcap(F.replace(lowered, F.lit("_"), F.lit(" ")))
    )
    comment = F.format_string(PLAIN_COMMENT, name)
    for metric, (stat, ranges) in COMMENTS.items():
        value = F.col(stat)
        sentence = None
        for limit, text in reversed(ranges):
            filled = F.format_string(text.replace("%.2f", "%s"), F.col(f"{stat}_text"))
            if limit is None:
                sentence = filled
            else:
                hit = value > limit if stat == "mean" else value < limit
                sentence = F.when(hit, filled).otherwise(sentence)
        comment = F.when(name == metric, sentence).otherwise(comment)
    ends = [F.col(c).cast("double").cast("string") for c in ("min", "max")]
    return described.select(
        "metric", F.concat(comment, F.format_string(RANGE_COMMENT, *ends, F.col("std_text"))).alias("comment")
    )
