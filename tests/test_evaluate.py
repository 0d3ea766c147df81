import random
import statistics

import numpy as np
import pytest
from conftest import tuples
from pyspark.sql import functions as F

from callspark.operators import evaluate as E

METRICS = ("accuracy", "relevance")


def parsed(spark, *answers):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "id int, response string")
    scores = E.extract_scores(E.parse_scores(df, "response", METRICS), METRICS)
    return [tuple(r) for r in scores.orderBy("id").select(*METRICS).collect()]


def test_parse_scores(spark):
    assert parsed(
        spark, '{"accuracy": {"score": 8}, "relevance": {"score": 6.5}}', "{'accuracy': {'score': 8}, 'relevance': {'score': 6}}",
        '{"accuracy": {"score": 8}}', '{"accuracy": {"score": 8}, "relevance": {"score": 6}, "more": 1}',
        '{"accuracy": {"score": 8}} and more', "no idea", "", None, "{}",
    ) == [(8.0, 6.5), (8.0, 6.0), (8.0, None), (8.0, 6.0)] + [(-1.0, -1.0)] * 5


def test_failed_scores_count_unless_excluded(spark):
    df = spark.createDataFrame([(8.0, 2.0), (-1.0, -1.0)], "accuracy double, relevance double")
    assert dict(tuples(E.summary(df, METRICS))) == {"accuracy": 3.5, "relevance": 0.5}
    assert dict(tuples(E.summary(df, METRICS, exclude_failed=True))) == {"accuracy": 8.0, "relevance": 2.0}


def test_threshold_flags(spark):
    averages = spark.createDataFrame([("a", 7.0), ("b", 6.99), ("c", 8.0)], "metric string, average double")
    assert dict(tuples(E.threshold_flags(averages), "metric", "flag")) == {
        "a": E.ABOVE, "b": E.BELOW, "c": E.ABOVE
    }
    assert dict(tuples(E.threshold_flags(averages, {"c": 9}), "metric", "flag"))["c"] == E.BELOW


@pytest.mark.parametrize("values", [
    [3.0], [1.0, 2.0], [5.0] * 7, [float(i) for i in range(101)],
    [random.Random(1).random() for _ in range(5000)] + [0.5] * 3000, [None, 2.0, None, 4.0],
], ids=["one", "even", "equal", "odd", "many", "nulls"])
def test_quantiles_are_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    clean = [v for v in values if v is not None]
    expected = pytest.approx({p: float(np.quantile(clean, p)) for p in probabilities})
    for rows in (10, 10**6):
        found = E.quantiles(df, ["x"], probabilities, accuracy=20, bracket_rows=rows)
        assert {r.probability: r.value for r in found.collect()} == expected


def test_describe_and_moments(spark):
    values = [1.0, 2.0, 4.0, 4.0]
    df = spark.createDataFrame([(v, None) for v in values], "x double, `a b` double")
    row = {r.metric: r for r in E.describe(df, ["x", "a b"]).collect()}
    x = row["x"]
    assert (x["count"], x["min"], x["max"], x["p50"]) == (4, 1.0, 4.0, 3.0)
    assert x["std"] == pytest.approx(statistics.stdev(values))
    assert row["a b"]["count"] == 0 and row["a b"]["p50"] is None
    one = E.moments(spark.createDataFrame([(3.0,)], "x double"), ["x"]).first()
    assert (one["mean"], one["median"], one["std"]) == (3.0, 3.0, None)


@pytest.mark.parametrize("values", [[1.0, 2.0, 3.0, 10.0], [4.0, 4.0], [0.0, 30.0]])
def test_histogram_equals_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = E.histogram(df, "x").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=30)
    assert [r["count"] for r in got] == counts.tolist()
    assert [r.low for r in got] == pytest.approx(edges[:-1].tolist())


def test_commentary_modes(spark):
    described = spark.createDataFrame(
        [("accuracy", 7.0, 1.0, 1.0, 9.0), ("sentiment_alignment", 0.5, None, 0.5, 0.5), ("clarity", 5.0, 1.5, 2.0, 8.0)],
        "metric string, mean double, std double, min double, max double",
    )
    plain = dict(tuples(E.commentary(described)))
    assert plain["accuracy"] == (
        "Excellent accuracy with a mean score of 7.00. The scores range from 1.0 to 9.0 with a standard deviation of 1.00."
    )
    assert plain["sentiment_alignment"].startswith("Analysis for Sentiment_alignment metric. The scores range from 0.5 to 0.5")
    assert plain["sentiment_alignment"].endswith("of nan.")
    fixed = dict(tuples(E.commentary(described, "fixed")))
    assert fixed["sentiment_alignment"].startswith("Sentiment alignment is moderate (mean = 0.50)")
    assert fixed["clarity"].startswith("Clarity shows significant variability (std = 1.50)")


def test_timing_and_head(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, None)], "id int, processing_time double")
    assert tuples(E.timing(df)) == [(2, 6.0, 3.0, 4.0, 2.0)]
    assert [r.id for r in E.sample_head(df, ["id"], 2).collect()] == [1, 2]


def test_statistics_do_not_depend_on_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 101).cast("double").alias("x"))
    assert tuples(E.quantiles(df.coalesce(1), ["x"], [0.3])) == tuples(E.quantiles(df.repartition(9), ["x"], [0.3]))
