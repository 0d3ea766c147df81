"""Sources and sinks: a given table is written to the shared folder, read through the operator and compared."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callspark.functions import redaction as R
from callspark.session import ensure_checkpoint_dir
from callspark.sources import readers, writers
from callspark.sources.stages import Stages
from query_catalog import views as v
from query_catalog.redaction import literal

QUERIES, SQL = {}, {}


def query(sql):
    def register(fn):
        QUERIES[fn.__name__] = fn
        SQL[fn.__name__] = sql
        return fn
    return register


def _folder(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stores/{uuid.uuid4().hex}/{name}"


@query("""SELECT user_id AS "conversationId", event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS "timestamp", event_type AS "channelId"
    FROM events WHERE event_type = 'click'""")
def activity_log(spark, d):
    root = _folder(spark, "log")
    events = v.table(spark, d, "events").select(
        F.col("user_id").alias("conversationId"), "event_id", F.col("ts").alias("timestamp"), F.col("event_type").alias("channelId")
    )
    first, last = events.agg(F.min("timestamp"), F.max("timestamp")).first()
    for i in range((last.date() - first.date()).days + 1):
        day = first.date() + dt.timedelta(days=i)
        rows = events.filter((F.col("timestamp") >= F.lit(day)) & (F.col("timestamp") < F.lit(day + dt.timedelta(days=1))))
        writers.write_stage(rows, f"{root}/audio_response/{day:%Y/%m/%d}/00")
    log = readers.read_activity_log(spark, root, "audio_response", str(first.date()), str(last.date()), channel="click")
    return log.withColumn("timestamp", v.ts("timestamp"))


@query("""SELECT 'listed_nation' AS name, count(*) AS n FROM nation UNION ALL SELECT 'listed_region', count(*) FROM region""")
def listed_tables(spark, d):
    own = f"listed_{uuid.uuid4().hex}"  # a warehouse may hold tables of earlier runs
    for name in ("nation", "region"):
        writers.save_table(v.table(spark, d, name), f"{own}_{name}")
    listed = readers.list_tables(spark, "default").filter(F.col("tableName").startswith(own))
    counted = [
        readers.read_table(spark, r["tableName"]).agg(
            F.lit(r["tableName"].replace(own, "listed")).alias("name"), F.count(F.lit(1)).alias("n")
        )
        for r in listed.collect()
    ]
    return reduce(DataFrame.unionByName, counted)


@query("SELECT conv_id, turn, role, text FROM conversations")
def csv_scan(spark, d):
    path = _folder(spark, "turns")
    writers.write_csv(v.table(spark, d, "conversations").select("conv_id", "turn", "role", "text"), path)
    return readers.read_csv_stage(spark, path, "conv_id bigint, turn bigint, role string, text string")


@query("""SELECT doc_id, concat('["', lang, '","', source, '"]') AS tags, concat('{"n":', n_chars, '}') AS size FROM documents""")
def csv_sink(spark, d):
    path = _folder(spark, "documents")
    nested = v.table(spark, d, "documents").select(
        "doc_id", F.array("lang", "source").alias("tags"), F.struct(F.col("n_chars").alias("n")).alias("size")
    )
    writers.write_csv(nested, path)
    return readers.read_csv_stage(spark, path, "doc_id bigint, tags string, size string")


@query("""SELECT CAST(row_number() OVER (ORDER BY item_id) - 1 AS INT) AS topic_num, concat('topic ', item_id) AS topic,
    text AS description FROM benchmark""")
def taxonomy_rows(spark, d):
    path = _folder(spark, "taxonomy")
    topic = F.concat(F.lit("topic "), "item_id")
    lines = v.table(spark, d, "benchmark").repartitionByRange("item_id").sortWithinPartitions("item_id")
    lines.select(F.to_json(F.create_map(topic, F.col("text"))).alias("value")).write.text(path)
    return readers.read_taxonomy_lines(spark, path)


@query("""SELECT concat('turn ', turn) AS instruction, role AS context, text AS response FROM conversations""")
def instruction_rows(spark, d):
    path = _folder(spark, "instructions")
    turns = v.table(spark, d, "conversations")
    turns.select(
        F.concat(F.lit("turn "), "turn").alias("instruction"), F.col("role").alias("context"), F.col("text").alias("response")
    ).write.json(path)
    return readers.read_instructions(spark, path)


@query("SELECT DISTINCT lang, true AS has_bytes FROM documents")
def file_listing(spark, d):
    path = _folder(spark, "files")
    v.table(spark, d, "documents").select("doc_id", "lang").withColumn("language", F.col("lang")).write.partitionBy("language").parquet(path)
    listed = readers.file_manifest(spark, f"{path}/*/*.parquet")
    lang = F.regexp_extract("path", r"language=([^/]+)/", 1).alias("lang")
    return listed.groupBy(lang).agg((F.min("length") > 0).alias("has_bytes"))


@query("""SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_totalprice, o_orderpriority FROM orders""")
def parquet_stage(spark, d):
    stages = Stages(spark, _folder(spark, "stages"))
    orders = v.table(spark, d, "orders")
    stages.write("orders", orders.limit(0))
    stages.write("orders", orders)  # a second run takes the place of the first
    stages.retire("orders")
    return stages.read("orders").select("o_orderkey", "o_custkey", v.day("o_orderdate").alias("day"), "o_totalprice", "o_orderpriority")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def managed_table(spark, d):
    name = f"customer_{uuid.uuid4().hex}"
    writers.save_table(v.table(spark, d, "customer").select("c_custkey"), name)
    writers.save_table(v.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal"), name)
    return readers.read_table(spark, name)


_CONFIG = {"pattern_recognizers": {
    "short_code": [{"name": "digits", "regex": r"\b\d{2}\b", "score": 0.4}, {"name": "letters", "regex": r"\b[a-z]\d\b", "score": 0.3}],
    "the_word": {"name": "the", "regex": r"\bthe\b", "score": 0.9},
}}


def _config_sql():
    expression = "text"
    for entity, regex in (("SHORT_CODE", r"\b\d{2}\b"), ("SHORT_CODE", r"\b[a-z]\d\b"), ("THE_WORD", r"\bthe\b")):
        expression = f"regexp_replace({expression}, {literal('(?i)' + regex)}, '<{entity}>', 'g')"
    return f"SELECT item_id, {expression} AS text FROM benchmark UNION ALL SELECT -conv_id * 100 - turn - 1, {expression} FROM conversations"


@query(_config_sql())
def config_recognizers(spark, d):
    items = v.table(spark, d, "benchmark").select("item_id", "text")
    turns = v.table(spark, d, "conversations").selectExpr("-conv_id * 100 - turn - 1 AS item_id", "text")
    return items.unionByName(turns).select("item_id", R.replace_all("text", R.from_config(_CONFIG)).alias("text"))
