import datetime as dt
import json

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from callspark.session import spread
from callspark.functions.text import instruction_text
from callspark.operators import report
from callspark.sources import named, readers, safe_query, writers


def test_month_paths():
    assert readers.month_paths("/r/", "nlp_result", "2023-11-20", "2024-02-01") == [
        f"/r/nlp_result/{m}/*/*/" for m in ("2023/11", "2023/12", "2024/01", "2024/02")
    ]
    assert readers.month_paths("/r", "k", "2023-11-20", "2024-02-01", "start_only") == ["/r/k/2023/11/*/*/"]
    with pytest.raises(ValueError):
        readers.month_paths("/r", "k", "2024-02-01", "2024-01-01")


def test_read_activity_log(spark, tmp_path):
    def write(day, conv, channel="TwilioVoice"):
        when = dt.datetime.combine(day, dt.time(23, 59))
        spark.createDataFrame([(conv, when, channel)], "conversationId string, timestamp timestamp_ntz, channelId string").write.parquet(
            f"{tmp_path}/audio_response/{day:%Y/%m/%d}/00-{conv}"
        )

    write(dt.date(2024, 1, 30), "jan")
    write(dt.date(2024, 1, 31), "chat", "WebChat")
    write(dt.date(2024, 3, 1), "mar")
    write(dt.date(2024, 3, 2), "late")
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError, match="2024/02"):
        readers.read_activity_log(spark, root, "audio_response", "2024-01-30", "2024-03-01")
    got = readers.read_activity_log(spark, root, "audio_response", "2024-01-30", "2024-03-01", missing="skip")
    assert {r.conversationId for r in got.collect()} == {"jan", "mar"}
    first = readers.read_activity_log(spark, root, "audio_response", "2024-01-30", "2024-03-01", months="start_only")
    assert {r.conversationId for r in first.collect()} == {"jan"}
    with pytest.raises(FileNotFoundError):
        readers.read_activity_log(spark, root, "audio_response", "2020-01-01", "2020-01-02")


def test_days_outside_the_window_are_not_read(spark, tmp_path):
    def write(folder, day):
        when = dt.datetime.combine(day, dt.time(12))
        spark.createDataFrame([(folder, when, "TwilioVoice")], "conversationId string, timestamp timestamp_ntz, channelId string").coalesce(1).write.parquet(
            f"{tmp_path}/log/{folder}"
        )

    for day in (dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 2, 2), dt.date(2024, 2, 3)):
        write(f"{day:%Y/%m/%d}/00", day)
    write("2024/02/01/13", dt.date(2024, 2, 1))
    write("2024/02/rest/00", dt.date(2024, 2, 1))  # names no day
    write("2024/02/03/13", dt.date(2024, 2, 2))  # filed a day late
    log = readers.read_activity_log(spark, str(tmp_path), "log", "2024-01-31", "2024-02-01")
    read = {"/".join(f.split("/log/")[1].split("/")[:4]) for f in log.inputFiles()}
    assert read == {"2024/01/31/00", "2024/02/01/00", "2024/02/01/13", "2024/02/rest/00"}
    assert {r.conversationId for r in log.collect()} == read
    late = readers.read_activity_log(spark, str(tmp_path), "log", "2024-02-02", "2024-02-02", late_days=1)
    assert {r.conversationId for r in late.collect()} == {"2024/02/02/00", "2024/02/03/13"}
    none = readers.read_activity_log(spark, str(tmp_path), "log", "2024-01-05", "2024-01-06")
    assert none.count() == 0 and none.columns == log.columns


def test_taxonomy_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"Billing": "bills"}\n\n{"Power": "outages", "Gas": "leaks"}\n')
    (tmp_path / "b.json").write_text('{"Other": null}\n')
    assert tuples(readers.read_taxonomy_lines(spark, f"{tmp_path}/*.json")) == [
        (0, "Billing", "bills"), (1, "Power", "outages"), (2, "Gas", "leaks"), (3, "Other", None)
    ]


def test_stage_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("f", [(0.0, 1.0, "hi", None)])], "file_path string, t array<struct<start:double,end:double,text:string,p:double>>")
    writers.write_stage(df, f"{tmp_path}/s")
    assert readers.read_stage(spark, f"{tmp_path}/s").collect() == df.collect()


def test_csv_round_trip_with_quotes_and_breaks(spark, tmp_path):
    rows = [("a", 'said "no", then\nhung up', [1, 2]), ("b", "plain", []), ("c", None, None)]
    df = spark.createDataFrame(rows, "id string, text string, list array<int>")
    writers.write_csv(df, f"{tmp_path}/c")
    back = readers.read_csv_stage(spark, f"{tmp_path}/c", "id string, text string, list string")
    assert tuples(back) == [("a", rows[0][1], "[1,2]"), ("b", "plain", "[]"), ("c", None, None)]
    inferred = readers.read_csv_stage(spark, f"{tmp_path}/c")
    assert inferred.columns == ["id", "text", "list"] and inferred.count() == 3


def test_managed_table_replaces_schema(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS reports LOCATION '{tmp_path}/reports'")
    writers.save_table(spark.range(3), "calls", "reports")
    writers.save_table(spark.range(2).withColumn("x", F.lit("y")), "calls", "reports")
    assert readers.read_table(spark, "reports.calls").columns == ["id", "x"]
    assert [r.tableName for r in readers.list_tables(spark, "reports").collect() if not r.isTemporary] == ["calls"]
    spark.sql("DROP TABLE reports.calls")


def test_taxonomy(spark, tmp_path):
    (tmp_path / "topics.json").write_text(json.dumps({"Billing": "bills, and payments", "Power": "outages"}, indent=1))
    assert tuples(readers.read_taxonomy(spark, f"{tmp_path}/topics.json")) == [
        (0, "Billing", "bills, and payments"), (1, "Power", "outages")
    ]


def test_instructions(spark, tmp_path):
    (tmp_path / "i.json").write_text('{"instruction": "Sum", "context": "c", "response": "r"}\n{"instruction": "Go", "response": "r"}\n')
    got = readers.read_instructions(spark, f"{tmp_path}/i.json").select(instruction_text("instruction", "context", "response").alias("t"))
    assert [r.t for r in got.collect()] == [
        "Instruction: Sum\\nContext: c\\nResponse: r", "Instruction: Go\\nContext: \\nResponse: r"
    ]


def test_file_manifest_does_not_read_bytes(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(b"12345")
    manifest = readers.file_manifest(spark, str(tmp_path))
    assert manifest.columns == ["path", "length", "modificationTime"]
    assert [r.length for r in manifest.collect()] == [5]
    assert "content" not in manifest._jdf.queryExecution().executedPlan().toString()


def test_ids_frame(spark):
    assert tuples(readers.ids_frame(spark, ["a", "b"], view="ids_view")) == [("a",), ("b",)]
    assert spark.table("ids_view").count() == 2


def test_names_are_checked(spark):
    df = spark.range(1).select(F.col("id").alias("taskId"), F.lit(1).alias("secret"))
    with pytest.raises(ValueError, match="secret"):
        safe_query.select(df, ["taskId", "secret"])
    with pytest.raises(ValueError, match="other"):
        safe_query.select_table(spark, "other", ["taskId"])
    assert safe_query.select(df, ["taskId"]).columns == ["taskId"]


def test_tables_of_an_approved_database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS csda LOCATION '{tmp_path}/csda'")
    spark.range(2).select(F.col("id").alias("taskId")).write.saveAsTable("csda.tasksegments")
    assert tuples(safe_query.select_table(spark, "csda.tasksegments", ["taskId"])) == [(0,), (1,)]
    for name in ("other.tasksegments", "csda.secrets", "csda.x.tasksegments", ".tasksegments"):
        with pytest.raises(ValueError):
            safe_query.select_table(spark, name, ["taskId"])
    spark.sql("DROP TABLE csda.tasksegments")


def test_two_conditions_and_odd_names(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "taskId int, `a``b c` string")
    got = safe_query.select(df, ["a`b c"], approved=["a`b c"], where=[F.col("taskId") > 0, F.col("taskId") < 2])
    assert tuples(got) == [("x",)]


def test_values_are_bound_not_spliced(spark):
    spark.createDataFrame([("x' OR '1'='1",), ("z",)], "v string").createOrReplaceTempView("bound_values")
    got = safe_query.run(spark, "SELECT v FROM bound_values WHERE v = ?", ["x' OR '1'='1"])
    assert tuples(got) == [("x' OR '1'='1",)]
    assert safe_query.run(spark, "SELECT v FROM bound_values WHERE v = :v", {"v": "z"}).count() == 1


def test_named_catalogue_file(spark, tmp_path):
    path = tmp_path / "q.json"
    path.write_text(json.dumps({"queries": [{"name": "Two", "sql": "SELECT id FROM numbers WHERE id > :low;"}]}))
    got = named.run_named(spark, "Two", {"numbers": spark.range(4)}, {"low": 1}, named.load_catalogue(str(path)))
    assert tuples(got) == [(2,), (3,)]
    with pytest.raises(KeyError):
        named.run_named(spark, "Three", {})


def test_report_save(spark, tmp_path):
    layout = report.LAYOUT
    assert len(layout) == 54
    types = [t for _, _, t in layout]
    assert (types.count("string"), types.count("timestamp"), types.count("int")) == (43, 5, 6)


def test_short_rows_are_dealt_by_their_number(spark, tmp_path):
    spark.range(1000).write.parquet(f"{tmp_path}/t")
    rows = spark.read.parquet(f"{tmp_path}/t")
    assert spread(rows, 10).rdd.getNumPartitions() == 100
    assert spread(rows, 10_000).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(rows, 10).count() == 1000 and max(map(len, spread(rows, 10).rdd.glom().collect())) <= 30
