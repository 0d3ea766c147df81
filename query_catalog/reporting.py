"""Lenient casts, alignment, the report layout, the reporting table and the whole chain."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from callspark.operators import calls, insights, report, sentiment, summarize
from callspark.plans import chain
from callspark.plans import relational as plans
from callspark.session import ensure_checkpoint_dir, written
from query_catalog import models, redaction, relational
from query_catalog import views as v

QUERIES, SQL = {}, {}


def query(sql=None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn
    return register


_TIME = """CASE o_orderstatus WHEN 'F' THEN CAST(o_orderdate AS STRING) WHEN 'O' THEN concat('on ', o_orderkey)
    ELSE NULL END"""
_NUMBER = """CASE o_orderstatus WHEN 'F' THEN concat(o_custkey, '.9') WHEN 'O' THEN CAST(o_custkey AS STRING)
    ELSE CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown' END END"""


@query(f"""WITH t AS (SELECT o_orderkey, {_TIME} AS text FROM orders)
    SELECT o_orderkey, strftime(try_cast(text AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS parsed FROM t""")
def lenient_timestamps(spark, d):
    orders = v.table(spark, d, "orders").selectExpr("o_orderkey", f"{_TIME} AS text")
    parsed = orders.select("o_orderkey", report.lenient_timestamp("text").alias("parsed"))
    return parsed.withColumn("parsed", v.ts("parsed"))


@query(f"""WITH t AS (SELECT o_orderkey, {_NUMBER} AS text FROM orders)
    SELECT o_orderkey, coalesce(CAST(trunc(try_cast(text AS DOUBLE)) AS INT), 0) AS parsed FROM t""")
def lenient_ints(spark, d):
    orders = v.table(spark, d, "orders").selectExpr("o_orderkey", f"{_NUMBER} AS text")
    return orders.select("o_orderkey", report.lenient_int("text").alias("parsed"))


@query(f"WITH {v.STAGES} SELECT * FROM stages")
def aligned_stages(spark, d):
    aligned = report.align([s for s in v.stages(spark, d).values()][:3] + [
        v.stages(spark, d)["insights"].withColumnRenamed("Summary", "summary_concise")
    ])
    return aligned.withColumn("topics", F.to_json("topics"))


@query("""WITH a AS (SELECT conv_id, turn, text, row_number() OVER (ORDER BY conv_id, turn) AS n FROM conversations),
        b AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) AS n FROM documents)
    SELECT conv_id, turn, text, doc_id, lang FROM a FULL JOIN b USING (n)""")
def aligned_by_position(spark, d):
    turns = v.table(spark, d, "conversations").select("conv_id", "turn", "text")
    documents = v.table(spark, d, "documents").select("doc_id", "lang")
    return report.align_by_position(turns, documents, ["conv_id", "turn"], ["doc_id"])


_SID, _FILES = relational._SID, relational._FILES
_METADATA = f"""{v.FREQUENT}, {v.WIDE_SEGMENTS}, {_FILES}, s AS (
    SELECT *, {_SID} AS RecordingSID FROM segments WHERE CAST(agentConnectTimestamp AS DATE) >= DATE '{v.SINCE}'
      AND taskId IN (SELECT TASK_ID FROM callers) AND {_SID} <> ''), metadata AS (
    SELECT s.*, coalesce(found, 'Not Downloaded') AS file_path FROM s LEFT JOIN files USING (RecordingSID)), assembled AS (
    SELECT CAST(callers.KY_BA AS BIGINT) AS KY_BA, metadata.*, stages.* EXCLUDE (file_path)
    FROM metadata JOIN stages USING (file_path) JOIN callers ON metadata.taskId = callers.TASK_ID)"""


def _typed(source, target, type_):
    column = f'"{source}"'
    if type_ == "timestamp":
        column = f"strftime(try_cast(CAST({column} AS VARCHAR) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')"
    elif type_ == "int":
        column = f"coalesce(CAST(trunc(try_cast({column} AS DOUBLE)) AS INT), 0)"
    else:
        column = f"CAST({column} AS VARCHAR)"
    return f'{column} AS "{target}"'


def _inputs(spark, d):
    master = calls.frequent_callers(relational._calls(spark, d)).select("KY_BA", "TASK_ID")
    intent = plans.ivr_intent(v.nlp_result(spark, d), v.transfer(spark, d), v.audio(spark, d), *v.EVENT_WINDOW)
    ids = master.select(F.col("TASK_ID").alias("taskId"))
    metadata = plans.call_metadata(v.wide_segments(spark, d), ids, v.SINCE, v.manifest(spark, d), intent)
    # Both are tables written by earlier stages.
    return written(metadata), written(master)


def _plain(df):
    return df.withColumns({c: v.ts(c) for c, t in df.dtypes if t == "timestamp"})


@query(f"""WITH {v.STAGES}, {_METADATA} SELECT KY_BA, taskId, segmentId, file_path, summary, topics, summary_concise,
        "Main Issue" FROM assembled""")
def report_assembly(spark, d):
    assembled = report.assemble(v.stages(spark, d), *_inputs(spark, d))
    return assembled.withColumn("topics", F.to_json("topics")).select(
        "KY_BA", "taskId", "segmentId", "file_path", "summary", "topics", "summary_concise", "Main Issue"
    )


@query(f"WITH {v.STAGES}, {_METADATA} SELECT {', '.join(_typed(*c) for c in report.LAYOUT)} FROM assembled")
def reporting_table(spark, d):
    return _plain(chain.reporting_table(v.stages(spark, d), *_inputs(spark, d)))


def _chain_sql():
    """Every stage as a statement over the one before, under the names the stage statements read."""
    rules = [(r.field, r.regex.removeprefix(r"\b(?:").removesuffix(r")\b"), r.value) for r in insights.RULES]
    found = models.insights_sql(rules, summarize.ACTION_WORDS, insights.PROBLEM_WORDS, insights.FOLLOW_UP_WORDS, sentiment.LEXICON)
    merged = "merged AS (SELECT doc_id AS file_path, summary AS transcription FROM chain_summary)"
    fields = ", ".join('chain_insights."Summary" AS summary_concise' if f == "Summary" else f'"{f}"' for f in insights.FIELDS)
    return f"""WITH documents AS (
        SELECT concat('call-', conv_id) AS doc_id, string_agg({redaction._sequence(redaction._replaced('text'))}, ' ' ORDER BY turn) AS text
        FROM conversations GROUP BY conv_id), chain_summary AS ({models.summary_sql(3900, 3200, 3800, 50)}),
        chain_insights AS ({found}), chain_topics AS ({models.topics_sql(0.2, merged)}), stages AS (
        SELECT concat('/audio/RE', substr(doc_id, 6), '-', line, '.wav') AS file_path, text AS transcription, chain_summary.summary,
               concat('["', "primary", '","', secondary, '"]') AS topics, {fields}
        FROM documents JOIN chain_summary USING (doc_id) JOIN chain_insights USING (doc_id)
        JOIN chain_topics ON chain_topics.file_path = doc_id, (VALUES (1), (2)) lines(line)), {_METADATA}
        SELECT {', '.join(_typed(*c) for c in report.LAYOUT)} FROM assembled"""


@query(_chain_sql())
def whole_chain(spark, d):
    metadata, master = _inputs(spark, d)
    per_file = v.transcripts(spark, d).withColumn("line", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "file_path", F.expr("concat('/audio/RE', substring(file_path, 6), '-', line, '.wav')")
    ).drop("line")
    taxonomy = v.table(spark, d, "benchmark").select(
        F.col("item_id").alias("topic_num"), F.concat(F.lit("topic "), "item_id").alias("topic"),
        F.col("text").alias("description"),
    )
    folder = f"{ensure_checkpoint_dir(spark)}/whole_chain/{uuid.uuid4().hex}"
    return _plain(chain.run_all(spark, per_file, metadata, master, taxonomy, folder, threshold=0.2))
