import datetime as dt

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from callspark.operators import report
from callspark.operators.insights import FIELDS
from callspark.plans import chain
from callspark.sources.stages import Stages
from callspark.sources.readers import read_csv_stage, read_table
from callspark.sources.writers import save_table, write_csv


def test_lenient_casts(spark):
    rows = [(0, "2024-01-02 03:04:05", "3.9"), (1, "soon", "many"), (2, None, None), (3, "2024-01-02", "-2.7"), (4, "", "12")]
    df = spark.createDataFrame(rows, "id int, t string, n string")
    got = {r.id: (r.t, r.n) for r in df.select("id", report.lenient_timestamp("t").alias("t"), report.lenient_int("n").alias("n")).collect()}
    assert got == {
        0: (dt.datetime(2024, 1, 2, 3, 4, 5), 3), 1: (None, 0), 2: (None, 0), 3: (dt.datetime(2024, 1, 2), -2), 4: (None, 12)
    }
    numbers = spark.createDataFrame([(2.9,), (None,)], "n double")
    assert tuples(numbers.select(report.lenient_int("n"))) == [(0,), (2,)]


def inputs(spark):
    files = spark.createDataFrame([("f1",), ("f2",), ("f3",)], "file_path string")
    stages = {
        "summary": files.withColumn("summary", F.concat(F.lit('said "hi",\n'), "file_path")),
        "topics": files.withColumn("topics", F.array(F.lit("a"), F.lit("b"))),
        "transcription": files.withColumn("transcription", F.col("file_path")),
        "insights": files.select("file_path", *[F.lit(f).alias(f) for f in FIELDS]),
    }
    strings = [s for s, _, t in report.LAYOUT if t == "string" and s not in (
        "KY_BA", "file_path", "transcription", "summary", "topics", "summary_concise", "taskId", *FIELDS)]
    times = [s for s, _, t in report.LAYOUT if t == "timestamp"]
    ints = [s for s, _, t in report.LAYOUT if t == "int"]
    metadata = spark.createDataFrame([("f1", "t1"), ("f1", "t2"), ("f2", "t1"), ("none", "t1")], "file_path string, taskId string").select(
        "*", *[F.lit(s).alias(s) for s in strings], *[F.lit("not a time").alias(c) for c in times],
        *[F.lit(None).cast("string").alias(c) for c in ints], F.lit("q").alias("IVR_Question"), F.lit(0).alias("Unnamed: 0"),
    )
    master = spark.createDataFrame([("A", "t1"), ("B", "t3")], "KY_BA string, TASK_ID string")
    return stages, metadata, master


def test_reporting_table(spark, tmp_path):
    table = chain.reporting_table(*inputs(spark))
    assert table.columns == [t for _, t, _ in report.LAYOUT]
    assert [f.dataType.simpleString() for f in table.schema] == [t for _, _, t in report.LAYOUT]
    got = tuples(table, "bill_account_key", "file_path", "topics", "summary_concise", "Main_Issue", "queueTime", "insertDate")
    assert got == [("A", f, '["a","b"]', "Summary", "Main Issue", 0, None) for f in ("f1", "f2")]
    write_csv(table, f"{tmp_path}/csv")
    back = read_csv_stage(spark, f"{tmp_path}/csv", table.schema)
    assert tuples(back) == tuples(table)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS out LOCATION '{tmp_path}/out'")
    save_table(table, "call_report", "out")
    assert read_table(spark, "out.call_report").dtypes == table.dtypes
    spark.sql("DROP TABLE out.call_report")


def test_conform_names_what_is_missing(spark):
    with pytest.raises(ValueError, match="transcription"):
        report.conform(spark.range(1))


def test_numbered_rows(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(6)
    got = tuples(report.numbered(df, ["k"]))
    assert sorted(got) == [(i, i) for i in range(1000)]


def test_align_by_position(spark):
    left = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "l int, x string")
    right = spark.createDataFrame([(30, "C"), (20, "B"), (10, "A")], "r int, y string")
    got = report.align_by_position(left, right, ["l"], ["r"])
    assert tuples(got, "x", "y") == [("a", "A"), ("b", "B"), ("c", "C")]


def chain_inputs(spark):
    _, metadata, master = inputs(spark)
    talk = "My power is out again. I am upset. We scheduled a crew. It will be fixed today! " * 8
    transcripts = spark.createDataFrame(
        [("f1", [(0.0, 1.0, talk, 0.0), (1.0, 2.0, "Call 212-555-0187.", 0.0)]), ("f2", [(0.0, 1.0, "Hi.", 0.0)])],
        "file_path string, transcription array<struct<start:double,end:double,text:string,no_speech_probability:double>>",
    )
    taxonomy = spark.createDataFrame([(0, "Outage", "power is out again"), (1, "Bill", "payment of a bill")], "topic_num int, topic string, description string")
    return transcripts, metadata, master, taxonomy


def test_whole_chain(spark, tmp_path):
    transcripts, metadata, master, taxonomy = chain_inputs(spark)
    table = chain.run_all(spark, transcripts, metadata, master, taxonomy, str(tmp_path))
    got = {r.file_path: r for r in table.collect()}
    assert set(got) == {"f1", "f2"}
    assert "555" not in got["f1"].transcription and got["f1"].Category == "POWER"
    assert got["f2"].summary == "No summary generated" and got["f2"].Category == "Not Generated"
    assert got["f1"].topics == '["Outage","None"]' and got["f2"].topics == '["Unidentified","None"]'
    for stage in chain.STAGES:
        assert Stages(spark, str(tmp_path)).read(stage).count() == 2


def test_rows_of_a_hot_file_that_no_stage_has_are_not_shuffled(spark):
    rows = [(i, "Not Downloaded") for i in range(50)] + [(i, "a.wav") for i in range(60)] + [(1, "b.wav"), (2, "c.wav"), (3, None)]
    metadata = spark.createDataFrame(rows, "taskId int, file_path string")
    stage = spark.createDataFrame([("a.wav", "s"), ("c.wav", "t")], "file_path string, summary string")
    left = report.without_unmatched(metadata, stage, "file_path", 20)
    assert sorted(left.groupBy("file_path").count().collect(), key=str) == sorted([("a.wav", 60), ("b.wav", 1), ("c.wav", 1), (None, 1)], key=str)
    assert left.join(stage, "file_path").count() == metadata.join(stage, "file_path").count() == 61
