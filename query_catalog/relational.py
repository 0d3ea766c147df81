"""Repeat callers, voice-menu intent, call metadata, governed and named SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from callspark.operators import calls, ivr
from callspark.plans import relational as plans
from callspark.sources import named, readers, safe_query
from query_catalog import views as v

QUERIES, SQL = {}, {}


def query(sql=None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn
    return register


_CALL_COLUMNS = f"CAST(CALL_DATE AS VARCHAR) AS CALL_DATE, {v.ts_sql('CALL_START_TIME', 'CALL_START_TIME')}"


def _calls(spark, d):
    return calls.agent_calls(v.call_header(spark, d), *v.WINDOW)


def _plain(df):
    return df.withColumns({"CALL_DATE": v.day("CALL_DATE"), "CALL_START_TIME": v.ts("CALL_START_TIME")})


@query(f"WITH {v.AGENT_CALLS} SELECT TASK_ID, {_CALL_COLUMNS}, KY_BA FROM agent_calls")
def agent_calls(spark, d):
    return _plain(_calls(spark, d))


@query(f"WITH {v.FREQUENT} SELECT KY_BA, NumberOfCalls FROM frequent")
def frequent_accounts(spark, d):
    return calls.frequent_accounts(_calls(spark, d)).select("KY_BA", "NumberOfCalls")


@query(f"WITH {v.FREQUENT} SELECT KY_BA, TASK_ID, {_CALL_COLUMNS}, NumberOfCalls FROM callers")
def frequent_callers(spark, d):
    return _plain(calls.frequent_callers(_calls(spark, d)))


@query(f"""WITH {v.FREQUENT} SELECT KY_BA, TASK_ID, {_CALL_COLUMNS}, NumberOfCalls FROM (
    SELECT * FROM callers ORDER BY NumberOfCalls DESC, KY_BA, CALL_DATE, CALL_START_TIME, TASK_ID LIMIT 100)""")
def frequent_callers_top100(spark, d):
    return _plain(plans.frequent_callers(v.call_header(spark, d), *v.WINDOW, limit=100))


@query(f"""WITH {v.SEGMENTS}, calls AS (
        SELECT taskId AS TASK_ID, callSid AS KY_BA, CAST(agentConnectTimestamp AS DATE) AS CALL_DATE,
               agentConnectTimestamp AS CALL_START_TIME FROM segments), n AS (
        SELECT KY_BA, count(TASK_ID) AS NumberOfCalls FROM calls GROUP BY KY_BA HAVING count(TASK_ID) > 30)
    SELECT KY_BA, TASK_ID, {_CALL_COLUMNS}, NumberOfCalls FROM calls JOIN n USING (KY_BA)""")
def frequent_callers_counting_repeats(spark, d):
    repeated = v.segments(spark, d).select(
        F.col("taskId").alias("TASK_ID"), F.col("callSid").alias("KY_BA"),
        F.col("agentConnectTimestamp").cast("date").alias("CALL_DATE"),
        F.col("agentConnectTimestamp").alias("CALL_START_TIME"),
    )
    return _plain(calls.frequent_callers(repeated, min_calls=30, distinct=False))


@query(f"""WITH {v.FREQUENT} SELECT taskId FROM (
    SELECT DISTINCT TASK_ID AS taskId FROM callers ORDER BY taskId LIMIT 200)""")
def first_task_ids(spark, d):
    ids = calls.frequent_callers(_calls(spark, d)).withColumnRenamed("TASK_ID", "taskId")
    return ids.select("taskId").distinct().orderBy("taskId").limit(200)


@query("""WITH t AS (
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
               WHEN 'O' THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%Y-%m-9%d') END AS text
        FROM orders)
    SELECT o_orderkey, text, regexp_matches(text, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$')
           AND try_strptime(text, '%Y-%m-%d') IS NOT NULL AS valid FROM t""")
def valid_date(spark, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = (
        F.when(F.col("o_orderstatus") == "F", day)
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(F.concat(F.substring(day, 1, 8), F.lit("9"), F.substring(day, 9, 2)))
    )
    orders = v.table(spark, d, "orders").select("o_orderkey", text.alias("text"))
    return orders.withColumn("valid", calls.valid_date("text"))


@query("""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - 366 AS VARCHAR) AS window_start,
        CAST(CAST(o_orderdate AS DATE) - 1 AS VARCHAR) AS window_end FROM orders""")
def reporting_window(spark, d):
    start, end = calls.window_bounds("o_orderdate")
    return v.table(spark, d, "orders").select(
        "o_orderkey", start.cast("string").alias("window_start"), end.cast("string").alias("window_end")
    )


# --- voice-menu events --------------------------------------------------------------------------

_TS = v.ts_sql('"timestamp"', '"timestamp"')


@query(f"""WITH {v.LOGS} SELECT accountId, conversationId, {v.ts_sql('"timestamp"', '"timeStamp"')},
        recognizerResult_text AS eventMessage_recognizerResult_text,
        recognizerResult_intent_value AS eventMessage_topIntent,
        recognizerResult_intent_score AS eventMessage_topIntentScore
    FROM nlp_result WHERE {v._IN_WINDOW}""")
def approved_intent_columns(spark, d):
    log = ivr.in_window(v.nlp_result(spark, d), *v.EVENT_WINDOW, ts="timeStamp")
    return safe_query.select(log, [
        "accountId", "conversationId", "timeStamp", "eventMessage_recognizerResult_text",
        "eventMessage_topIntent", "eventMessage_topIntentScore",
    ]).withColumn("timeStamp", v.ts("timeStamp"))


@query(f"WITH {v.UNIFIED} SELECT * REPLACE ({_TS}) FROM unified")
def unified_events(spark, d):
    return v.unified(spark, d).orderBy("timestamp").withColumn("timestamp", v.ts("timestamp"))


@query(f"""WITH {v.UNIFIED} SELECT * REPLACE ({_TS}) FROM unified
    WHERE recognizerResult_intent_value <> 'didnt_understand' AND recognizerResult_text IS NOT NULL
      AND recognizerResult_text <> ' '""")
def understood_responses(spark, d):
    return ivr.understood_responses(v.unified(spark, d)).withColumn("timestamp", v.ts("timestamp"))


@query(f"WITH {v.FIRST_RESPONSE} SELECT * REPLACE ({v.ts_sql('min_timestamp', 'min_timestamp')}) FROM first_response")
def first_response(spark, d):
    return ivr.first_response(v.unified(spark, d)).withColumn("min_timestamp", v.ts("min_timestamp"))


_BEFORE = f"WITH {v.BEFORE} SELECT * REPLACE ({v.ts_sql('timeStamp', 'timeStamp')}) FROM before"


@query(_BEFORE)
def events_before_response(spark, d):
    return ivr.events_before_response(v.unified(spark, d)).withColumn("timeStamp", v.ts("timeStamp"))


@query(f"WITH {v.INTENT} SELECT * FROM intent")
def intent_per_call(spark, d):
    return plans.ivr_intent(
        v.nlp_result(spark, d), v.transfer(spark, d), v.audio(spark, d), *v.EVENT_WINDOW
    )


@query(f"""WITH {v.BEFORE}, q AS (
        SELECT conversationId, arg_max(IVR_QUESTION, (timeStamp, IVR_QUESTION)) FILTER (IVR_QUESTION IS NOT NULL) AS q
        FROM before GROUP BY conversationId)
    SELECT DISTINCT conversationId AS callSid, USER_RESPONSE AS User_Response, INTENT AS Intent,
           INTENT_SCORE AS Intent_Score, q AS IVR_Question FROM before JOIN q USING (conversationId)""")
def intent_per_call_last_asked(spark, d):
    before = ivr.events_before_response(v.unified(spark, d))
    return ivr.intent_per_call(before, ignore_null_question=True)


@query("""SELECT kind, n FROM (
    SELECT 'audio_response' AS kind, count(*) AS n FROM events WHERE event_type IN ('view', 'signup')
    UNION ALL SELECT 'nlp_result', count(*) FROM events WHERE event_type IN ('click', 'purchase')
    UNION ALL SELECT 'transfertoagent_response', count(*) FROM events WHERE event_type = 'error')""")
def log_row_counts(spark, d):
    logs = {"audio_response": v.audio, "nlp_result": v.nlp_result, "transfertoagent_response": v.transfer}
    counts = [
        log(spark, d).agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")
        for kind, log in logs.items()
    ]
    return counts[0].union(counts[1]).union(counts[2])


# --- segments, recordings, metadata -------------------------------------------------------------

_SEGMENT = f"taskId, callSid, segmentId, {v.ts_sql('agentConnectTimestamp', 'agentConnectTimestamp')}, taskURL, talkTime"


def _ids(spark, d):
    return calls.frequent_callers(_calls(spark, d)).select(F.col("TASK_ID").alias("taskId"))


def _segment_plain(df):
    return df.withColumn("agentConnectTimestamp", v.ts("agentConnectTimestamp"))


_CHOSEN = f"""{v.FREQUENT}, {v.SEGMENTS}, chosen AS (
    SELECT * FROM segments WHERE CAST(agentConnectTimestamp AS DATE) >= DATE '{v.SINCE}'
      AND taskId IN (SELECT TASK_ID FROM callers))"""


@query(f"WITH {_CHOSEN} SELECT {_SEGMENT} FROM chosen")
def task_segments(spark, d):
    return _segment_plain(calls.task_segments(v.segments(spark, d), _ids(spark, d), v.SINCE))


@query(f"""WITH {v.AGENT_CALLS}, {v.SEGMENTS}, ids AS (SELECT KY_BA AS taskId FROM agent_calls)
    SELECT {_SEGMENT} FROM segments JOIN ids USING (taskId)
    WHERE CAST(agentConnectTimestamp AS DATE) >= DATE '{v.SINCE}'""")
def task_segments_repeated_ids(spark, d):
    ids = _calls(spark, d).select(F.col("KY_BA").alias("taskId"))
    return _segment_plain(calls.task_segments_inner(v.segments(spark, d), ids, v.SINCE))


_SID = "CASE WHEN taskURL IS NULL THEN '' ELSE regexp_extract(taskURL, '([^/]*)$', 1) END"


@query(f"""WITH {v.SEGMENTS} SELECT {_SEGMENT}, {_SID} AS RecordingSID FROM segments WHERE {_SID} <> ''""")
def recordings(spark, d):
    return _segment_plain(calls.with_recordings(v.segments(spark, d)))


@query(f"WITH {v.SEGMENTS} SELECT {_SID} AS RecordingSID, count(*) AS n FROM segments GROUP BY 1")
def recording_sid_sql_function(spark, d):
    spark.sql(calls.RECORDING_SID_SQL)
    v.segments(spark, d).createOrReplaceTempView("segments")
    return spark.sql("SELECT extract_recording_sid(taskURL) AS RecordingSID, count(*) AS n FROM segments GROUP BY 1")


_FILES = f"""{v.MANIFEST}, files AS (
    SELECT RecordingSID, min(file_path) FILTER (file_path <> 'Not Downloaded') AS found
    FROM manifest GROUP BY RecordingSID)"""


@query(f"""WITH {v.SEGMENTS}, {_FILES}, s AS (SELECT *, {_SID} AS RecordingSID FROM segments WHERE {_SID} <> '')
    SELECT {_SEGMENT}, RecordingSID, coalesce(found, 'Not Downloaded') AS file_path
    FROM s LEFT JOIN files USING (RecordingSID)""")
def attach_recordings(spark, d):
    with_sid = calls.with_recordings(v.segments(spark, d))
    return _segment_plain(calls.attach_recordings(with_sid, v.manifest(spark, d)))


_METADATA = f"""{_CHOSEN}, {_FILES}, {v.INTENT}, s AS (
    SELECT *, {_SID} AS RecordingSID FROM chosen WHERE {_SID} <> ''), metadata AS (
    SELECT s.*, coalesce(found, 'Not Downloaded') AS file_path, User_Response, Intent, Intent_Score, IVR_Question
    FROM s LEFT JOIN files USING (RecordingSID) LEFT JOIN intent USING (callSid))"""


def _metadata(spark, d):
    intent = plans.ivr_intent(
        v.nlp_result(spark, d), v.transfer(spark, d), v.audio(spark, d), *v.EVENT_WINDOW
    )
    return plans.call_metadata(v.segments(spark, d), _ids(spark, d), v.SINCE, v.manifest(spark, d), intent)


@query(f"""WITH {_METADATA} SELECT {_SEGMENT}, RecordingSID, file_path, User_Response, Intent, Intent_Score,
        IVR_Question FROM metadata""")
def call_metadata(spark, d):
    return _segment_plain(_metadata(spark, d))


@query(f"""WITH {v.SEGMENTS}, {v.INTENT} SELECT {_SEGMENT}, User_Response, Intent, Intent_Score, IVR_Question
    FROM segments LEFT JOIN intent USING (callSid)""")
def metadata_with_intent(spark, d):
    intent = ivr.intent_per_call(ivr.events_before_response(v.unified(spark, d)))
    return _segment_plain(calls.metadata(v.segments(spark, d), intent))


# --- governed and named SQL ---------------------------------------------------------------------

@query(f"""WITH {v.SEGMENTS} SELECT taskId, {v.ts_sql('agentConnectTimestamp', 'agentConnectTimestamp')}, taskURL
    FROM segments WHERE CAST(agentConnectTimestamp AS DATE) >= DATE '{v.SINCE}' AND taskURL IS NOT NULL""")
def governed_select(spark, d):
    v.segments(spark, d).createOrReplaceTempView("tasksegments")
    return safe_query.select_table(
        spark, "tasksegments", ["taskId", "agentConnectTimestamp", "taskURL"],
        where=[F.col("agentConnectTimestamp").cast("date") >= F.lit(v.SINCE).cast("date"),
               F.col("taskURL").isNotNull()],
    ).withColumn("agentConnectTimestamp", v.ts("agentConnectTimestamp"))


@query(f"""WITH {v.SEGMENTS} SELECT taskId, taskURL, o_orderpriority AS INTENT
    FROM segments JOIN orders ON taskId = o_orderkey WHERE taskURL IS NOT NULL AND o_orderpriority <> '5-LOW'""")
def governed_join(spark, d):
    orders = v.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("taskId"), F.col("o_orderpriority").alias("INTENT")
    )
    return safe_query.select(
        v.segments(spark, d), ["taskId", "taskURL", "INTENT"], join=(orders, ["taskId"]),
        where=[F.col("taskURL").isNotNull(), F.col("INTENT") != "5-LOW"],
    )


@query("""SELECT o_orderpriority AS "Main Issue", count(*) AS n FROM orders GROUP BY 1""")
def column_with_space(spark, d):
    orders = v.table(spark, d, "orders").withColumnRenamed("o_orderpriority", "Main Issue")
    chosen = safe_query.select(orders, ["Main Issue"], approved=["Main Issue"])
    return chosen.groupBy(safe_query.quoted("Main Issue")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {v.SEGMENTS} SELECT {_SEGMENT} FROM segments
    WHERE CAST(agentConnectTimestamp AS DATE) >= DATE '{v.SINCE}' AND talkTime > 25""")
def bound_parameters(spark, d):
    v.segments(spark, d).createOrReplaceTempView("tasksegments")
    return _segment_plain(safe_query.run(
        spark,
        "SELECT * FROM tasksegments WHERE CAST(agentConnectTimestamp AS DATE) >= CAST(? AS DATE) AND talkTime > ?",
        [v.SINCE, 25],
    ))


def _log_views(spark, d):
    window = v.EVENT_WINDOW
    return {
        "dfIntent": ivr.prepare_intent(ivr.in_window(v.nlp_result(spark, d), *window, ts="timeStamp")),
        "dfTransferReasonFiltered": ivr.in_window(v.transfer(spark, d), *window),
        "dfAudioResponseFiltered": ivr.in_window(v.audio(spark, d), *window),
    }


@query(SQL["unified_events"])
def named_union(spark, d):
    return named.run_named(spark, "Union", _log_views(spark, d)).withColumn("timestamp", v.ts("timestamp"))


@query(_BEFORE)
def named_minimum(spark, d):
    result = named.run_named(spark, "Minimum", {"dfUnion": v.unified(spark, d)})
    return result.withColumn("timeStamp", v.ts("timeStamp"))


@query(SQL["task_segments"])
def named_filter(spark, d):
    found = {"tasksegments": v.segments(spark, d), "task_ids_temp": _ids(spark, d)}
    return _segment_plain(named.run_named(spark, "Filter", found, {"since": v.SINCE}))


@query(f"""WITH {v.INTENT} SELECT callSid AS conversationId, User_Response, Intent, Intent_Score, IVR_Question
    FROM intent""")
def named_aggregate(spark, d):
    before = ivr.events_before_response(v.unified(spark, d))
    return named.run_named(spark, "Aggregate", {"Intent": before})


@query("""SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_orderkey IN
    (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY l_returnflag""")
def catalog_scan_by_ids(spark, d):
    orders = v.table(spark, d, "orders").filter("o_orderstatus = 'F'")
    orders.select(F.col("o_orderkey").alias("taskId")).createOrReplaceTempView("task_ids_temp")
    lines = readers.read_stage(spark, f"{d}/lineitem.parquet").withColumnRenamed("l_orderkey", "taskId")
    chosen = lines.join(readers.read_table(spark, "task_ids_temp"), "taskId", "left_semi")
    return chosen.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
