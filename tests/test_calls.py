import datetime as dt

import pytest
from conftest import plan, tuples
from pyspark.sql import functions as F

from callspark.operators import calls
from callspark.operators.skew import hot_keys, lookup_join
from callspark.plans import relational as plans

HEADER = "conversationId string, startTimestamp timestamp_ntz, billAccountNumber string, inIvrTime double, transferToAgentReason string"


def ts(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def header(spark):
    rows = [
        # exactly two calls
        ("a1", ts("2024-01-01T00:00:00"), "A", 3.0, "x"), ("a2", ts("2024-01-02T10:00:00"), "A", 3.0, "x"),
        # exactly three calls, one of them twice, on the edges of the window
        ("b1", ts("2024-01-01T00:00:00"), "B", 3.0, "x"), ("b2", ts("2024-01-31T23:59:59"), "B", 3.0, "x"),
        ("b3", ts("2024-01-15T12:00:00"), "B", 3.0, "x"), ("b3", ts("2024-01-15T12:00:00"), "B", 3.0, "x"),
        # two distinct ids in three rows
        ("c1", ts("2024-01-05T12:00:00"), "C", 3.0, "x"), ("c1", ts("2024-01-05T12:00:00"), "C", 3.0, "x"),
        ("c2", ts("2024-01-06T12:00:00"), "C", 3.0, "x"),
        # refused: no account, no reason, two seconds, outside
        ("d1", ts("2024-01-05T12:00:00"), None, 3.0, "x"), ("d2", ts("2024-01-05T12:00:00"), "D", 3.0, None),
        ("d3", ts("2024-01-05T12:00:00"), "D", 2.0, "x"), ("d4", ts("2023-12-31T23:59:59"), "D", 3.0, "x"),
        ("d5", ts("2024-02-01T00:00:00"), "D", 3.0, "x"),
    ]
    return spark.createDataFrame(rows, HEADER)


def test_agent_calls_window_and_nulls(header):
    found = calls.agent_calls(header, "2024-01-01", "2024-01-31")
    assert {r.TASK_ID for r in found.collect()} == {"a1", "a2", "b1", "b2", "b3", "c1", "c2"}


def test_frequent_callers_distinct(header):
    found = plans.frequent_callers(header, "2024-01-01", "2024-01-31", limit=None)
    assert [(r.KY_BA, r.TASK_ID, r.NumberOfCalls) for r in found.collect()] == [
        ("B", "b1", 3), ("B", "b3", 3), ("B", "b3", 3), ("B", "b2", 3)
    ]


def test_frequent_callers_counting_rows(header):
    found = calls.frequent_callers(calls.agent_calls(header, "2024-01-01", "2024-01-31"), distinct=False)
    assert {(r.KY_BA, r.NumberOfCalls) for r in found.collect()} == {("B", 4), ("C", 3)}


def test_frequent_callers_with_a_hot_account(spark):
    rows = spark.range(9000).select(
        F.col("id").cast("string").alias("TASK_ID"), F.lit(dt.date(2024, 1, 1)).alias("CALL_DATE"),
        F.lit(ts("2024-01-01T00:00:00")).alias("CALL_START_TIME"),
        F.when(F.col("id") < 3000, 0).otherwise(F.col("id")).alias("KY_BA"),
    )
    plain = calls.frequent_callers(rows)
    spread = calls.frequent_callers(rows, rows_per_task=100)
    assert plain.count() == 3000
    assert tuples(plain) == tuples(spread)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_lookup_join_equals_plain_join(spark, how):
    big = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 5).alias("v"),
    )
    small = spark.range(0, 4000, 2).union(spark.range(1, 2)).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    assert tuples(lookup_join(big, small, ["k"], how, rows_per_task=50)) == tuples(big.join(small, "k", how))


def test_lookup_join_spreads_copies(spark):
    copies = spark.range(1000, numPartitions=8).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    small = spark.createDataFrame([(1, "x")], "k int, w string")
    assert lookup_join(copies, small, ["k"], rows_per_task=10).count() == 1000
    assert [tuple(r) for r in hot_keys(copies, ["k"], 10).collect()] == [(1, 100)]


def test_plan_filters_reach_the_scan(spark, sf):
    from query_catalog.relational import agent_calls

    text = plan(agent_calls(spark, sf))
    assert "PushedFilters" in text and "GreaterThanOrEqual(o_orderdate" in text
    assert "o_orderstatus" not in text.split("ReadSchema")[1]


def test_plan_top_n_without_full_sort(spark, sf):
    from query_catalog.relational import frequent_callers_top100

    assert "TakeOrderedAndProject" in plan(frequent_callers_top100(spark, sf))


def test_plan_semi_join(spark, sf):
    from query_catalog.relational import task_segments

    assert "LeftSemi" in plan(task_segments(spark, sf))


def test_valid_date(spark):
    texts = ["2024-01-31", "2024-02-30", "2024-1-3", "31-01-2024", "2024-01-31 ", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.ok for r in rows.select("t", calls.valid_date("t").alias("ok")).collect()}
    assert got == {t: t is not None and calls.is_valid_date(t) for t in texts}
    assert got["2024-1-3"] and not got["2024-02-30"]


def test_reporting_window():
    assert calls.reporting_window("2024-06-30") == ("2023-06-30", "2024-06-29")


def test_recording_sid(spark):
    urls = [None, "", "plain", "http://x/y/", "http://x/RE1"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string")
    got = [r.s for r in df.orderBy("i").select(calls.recording_sid("url").alias("s")).collect()]
    assert got == ["", "", "plain", "", "RE1"]
    assert calls.with_recordings(df, "url").count() == 2


def test_attach_recordings_keeps_rows(spark):
    segments = spark.createDataFrame([("r1", 1), ("r1", 2), ("r2", 3), ("r3", 4)], "RecordingSID string, n int")
    manifest = spark.createDataFrame(
        [("r1", "/b"), ("r1", "/a"), ("r1", "Not Downloaded"), ("r2", "Not Downloaded")],
        "RecordingSID string, file_path string",
    )
    got = calls.attach_recordings(segments, manifest)
    assert tuples(got, "n", "file_path") == [
        (1, "/a"), (2, "/a"), (3, "Not Downloaded"), (4, "Not Downloaded")
    ]


def test_metadata_needs_the_key(spark):
    with pytest.raises(ValueError, match="callSid"):
        calls.metadata(spark.range(1), spark.range(1))


def test_call_metadata_reads_the_segments_once(spark, sf):
    from __spark_entry__ import queries

    found = plan(queries()["call_metadata"](spark, sf)).split("== Physical Plan ==")[1]
    assert found.count("/lineitem.parquet") == 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_plain_lookup_join_with_null_keys(spark, how):
    big = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, "c"), (3, "d")], "k int, x string")
    small = spark.createDataFrame([(1, 10), (2, 20), (2, 21), (None, 30)], "k int, y int")
    assert tuples(lookup_join(big, small, ["k"], how)) == tuples(big.join(small, "k", how))
