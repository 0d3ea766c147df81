"""The call-analytics tables, derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callspark.session import spread


#: Tables of texts, on which the work per row is dear.
_TEXT_TABLES = ("documents", "conversations", "pages")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{d}/{name}.parquet")
    return spread(df) if name in _TEXT_TABLES else df


def ts(col: str) -> Column:
    """Timestamps are compared as text with microseconds."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(col)


def ts_sql(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"


def day(col: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd").alias(col)


# --- call header, from orders -------------------------------------------------------------------

WINDOW = ("1996-01-01", "1999-12-31")


def call_header(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("conversationId"),
        F.col("o_orderdate").alias("startTimestamp"),
        F.expr("nullif(o_custkey, 0)").alias("billAccountNumber"),
        (F.col("o_totalprice") / 100000).alias("inIvrTime"),
        F.expr("nullif(o_orderpriority, '4-NOT SPECIFIED')").alias("transferToAgentReason"),
    )


CALL_HEADER = """call_header AS (
    SELECT o_orderkey AS conversationId, o_orderdate AS startTimestamp,
           nullif(o_custkey, 0) AS billAccountNumber, o_totalprice / 100000 AS inIvrTime,
           nullif(o_orderpriority, '4-NOT SPECIFIED') AS transferToAgentReason
    FROM orders)"""

AGENT_CALLS = f"""{CALL_HEADER}, agent_calls AS (
    SELECT conversationId AS TASK_ID, CAST(startTimestamp AS DATE) AS CALL_DATE,
           startTimestamp AS CALL_START_TIME, billAccountNumber AS KY_BA
    FROM call_header
    WHERE inIvrTime > 2 AND CAST(startTimestamp AS DATE) BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}'
      AND transferToAgentReason IS NOT NULL AND billAccountNumber IS NOT NULL)"""

FREQUENT = f"""{AGENT_CALLS}, frequent AS (
    SELECT KY_BA, count(DISTINCT TASK_ID) AS NumberOfCalls FROM agent_calls
    GROUP BY KY_BA HAVING count(DISTINCT TASK_ID) > 2), callers AS (
    SELECT KY_BA, TASK_ID, CALL_DATE, CALL_START_TIME, NumberOfCalls
    FROM agent_calls JOIN frequent USING (KY_BA))"""

# --- task segments from lineitem, recordings from supplier --------------------------------------

SINCE = "1997-01-01"


def segments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("taskId"),
        F.col("l_partkey").alias("callSid"),
        F.col("l_linenumber").alias("segmentId"),
        F.col("l_shipdate").alias("agentConnectTimestamp"),
        F.expr("""CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
                       WHEN l_linenumber = 7 THEN 'https://rec.example.com/'
                       ELSE concat('https://rec.example.com/v1/RE', l_suppkey, '-', l_linenumber) END
               """).alias("taskURL"),
        F.col("l_quantity").alias("talkTime"),
    )


SEGMENTS = """segments AS (
    SELECT l_orderkey AS taskId, l_partkey AS callSid, l_linenumber AS segmentId,
           l_shipdate AS agentConnectTimestamp,
           CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
                WHEN l_linenumber = 7 THEN 'https://rec.example.com/'
                ELSE concat('https://rec.example.com/v1/RE', l_suppkey, '-', l_linenumber) END AS taskURL,
           l_quantity AS talkTime
    FROM lineitem)"""


def manifest(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "supplier")
        .withColumn("line", F.explode(F.array(F.lit(1), F.lit(2), F.lit(2))))
        .select(
            F.expr("concat('RE', s_suppkey, '-', line)").alias("RecordingSID"),
            F.expr("""CASE WHEN s_acctbal < 2000 THEN 'Not Downloaded'
                           ELSE concat('/audio/RE', s_suppkey, '-', line, '.wav') END""").alias("file_path"),
        )
    )


MANIFEST = """manifest AS (
    SELECT concat('RE', s_suppkey, '-', line) AS RecordingSID,
           CASE WHEN s_acctbal < 2000 THEN 'Not Downloaded'
                ELSE concat('/audio/RE', s_suppkey, '-', line, '.wav') END AS file_path
    FROM supplier, unnest([1, 2, 2]) AS u(line))"""

# --- activity logs from events ------------------------------------------------------------------

EVENT_WINDOW = ("2024-01-02", "2024-01-29")
_K = "CAST(get_json_object(props, '$.k') AS INT)"
_CONVERSATION = "user_id * 10 + CAST(floor((day(ts) - 1) / 7) AS BIGINT)"
_CHANNEL = "CASE WHEN value < 5 THEN 'WebChat' ELSE 'TwilioVoice' END"


def _events(spark: SparkSession, d: str, *types: str) -> DataFrame:
    return table(spark, d, "events").filter(F.col("event_type").isin(*types)).selectExpr(
        "*", f"{_K} AS k", f"{_CONVERSATION} AS conversationId", f"{_CHANNEL} AS channelId"
    )


def nlp_result(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d, "click", "purchase").selectExpr(
        "CAST(user_id AS STRING) AS accountId", "conversationId", "ts AS timeStamp", "channelId",
        """CASE WHEN k < 5 THEN ' ' WHEN k < 8 THEN NULL WHEN k < 10 THEN ''
                ELSE concat('answer ', k) END AS eventMessage_recognizerResult_text""",
        """CASE WHEN k BETWEEN 10 AND 29 THEN 'didnt_understand' WHEN k >= 95 THEN NULL
                ELSE concat('intent_', CAST(floor(k / 10) AS INT)) END AS eventMessage_topIntent""",
        "value AS eventMessage_topIntentScore",
    )


def transfer(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d, "error").selectExpr(
        "conversationId", "ts AS timestamp", "channelId", "'transfer' AS event_Name", "props AS event_Type"
    )


def audio(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d, "view", "signup").selectExpr(
        "conversationId", "ts AS timestamp", "channelId", "CAST(event_id AS STRING) AS brd_ActivityId",
        "CASE WHEN k < 20 THEN NULL ELSE concat('question ', k) END AS brd_Text",
    )


LOGS = """logs AS (
    SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k,
           user_id * 10 + CAST(floor((day(ts) - 1) / 7) AS BIGINT) AS conversationId,
           CASE WHEN value < 5 THEN 'WebChat' ELSE 'TwilioVoice' END AS channelId
    FROM events), nlp_result AS (
    SELECT CAST(user_id AS VARCHAR) AS accountId, conversationId, ts AS "timestamp", channelId,
           CASE WHEN k < 5 THEN ' ' WHEN k < 8 THEN NULL WHEN k < 10 THEN ''
                ELSE concat('answer ', k) END AS recognizerResult_text,
           CASE WHEN k BETWEEN 10 AND 29 THEN 'didnt_understand' WHEN k >= 95 THEN NULL
                ELSE concat('intent_', CAST(floor(k / 10) AS INT)) END AS recognizerResult_intent_value,
           value AS recognizerResult_intent_score
    FROM logs WHERE event_type IN ('click', 'purchase')), transfer AS (
    SELECT conversationId, ts AS "timestamp", channelId, 'transfer' AS event_Name, props AS event_Type
    FROM logs WHERE event_type = 'error'), audio AS (
    SELECT conversationId, ts AS "timestamp", channelId, CAST(event_id AS VARCHAR) AS brd_ActivityId,
           CASE WHEN k < 20 THEN NULL ELSE concat('question ', k) END AS brd_Text
    FROM logs WHERE event_type IN ('view', 'signup'))"""

_IN_WINDOW = (
    f"channelId = 'TwilioVoice' AND CAST(\"timestamp\" AS DATE) "
    f"BETWEEN DATE '{EVENT_WINDOW[0]}' AND DATE '{EVENT_WINDOW[1]}'"
)

UNIFIED = f"""{LOGS}, unified AS (
    SELECT accountId, conversationId, recognizerResult_text, recognizerResult_intent_value,
           recognizerResult_intent_score, "timestamp", NULL::VARCHAR AS event_Name,
           NULL::VARCHAR AS event_Type, NULL::VARCHAR AS brd_ActivityId, NULL::VARCHAR AS brd_Text
    FROM nlp_result WHERE {_IN_WINDOW}
    UNION ALL
    SELECT NULL, conversationId, NULL, NULL, NULL, "timestamp", event_Name, event_Type, NULL, NULL
    FROM transfer WHERE {_IN_WINDOW}
    UNION ALL
    SELECT NULL, conversationId, NULL, NULL, NULL, "timestamp", NULL, NULL, brd_ActivityId, brd_Text
    FROM audio WHERE {_IN_WINDOW})"""

FIRST_RESPONSE = f"""{UNIFIED}, first_response AS (
    SELECT conversationId, "timestamp" AS min_timestamp, recognizerResult_text,
           recognizerResult_intent_value, recognizerResult_intent_score
    FROM unified
    WHERE recognizerResult_intent_value <> 'didnt_understand' AND recognizerResult_text IS NOT NULL
      AND recognizerResult_text <> ' '
    QUALIFY row_number() OVER (PARTITION BY conversationId ORDER BY "timestamp", recognizerResult_text,
        recognizerResult_intent_value, recognizerResult_intent_score NULLS FIRST) = 1)"""

BEFORE = f"""{FIRST_RESPONSE}, before AS (
    SELECT u.conversationId, u."timestamp" AS timeStamp, f.recognizerResult_text AS USER_RESPONSE,
           f.recognizerResult_intent_value AS INTENT, f.recognizerResult_intent_score AS INTENT_SCORE,
           u.brd_Text AS IVR_QUESTION
    FROM unified u JOIN first_response f
      ON u.conversationId = f.conversationId AND f.min_timestamp > u."timestamp")"""

INTENT = f"""{BEFORE}, ranked AS (
    SELECT *, row_number() OVER (PARTITION BY conversationId ORDER BY timeStamp DESC,
                                 IVR_QUESTION DESC NULLS LAST) AS rn FROM before), intent AS (
    SELECT conversationId AS callSid, USER_RESPONSE AS User_Response, INTENT AS Intent,
           INTENT_SCORE AS Intent_Score, IVR_QUESTION AS IVR_Question
    FROM ranked WHERE rn = 1)"""


def unified(spark: SparkSession, d: str) -> DataFrame:
    from callspark.operators import ivr

    start, end = EVENT_WINDOW
    return ivr.unified_events(
        ivr.in_window(nlp_result(spark, d), start, end, ts="timeStamp"),
        ivr.in_window(transfer(spark, d), start, end),
        ivr.in_window(audio(spark, d), start, end),
    )


# --- transcripts and texts ----------------------------------------------------------------------


def transcript_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").selectExpr(
        "concat('call-', conv_id) AS file_path", "turn * 10.0D AS start", "turn * 10.0D + 9 AS end", "text",
        "0.0D AS no_speech_probability",
    )


def transcripts(spark: SparkSession, d: str) -> DataFrame:
    from callspark.operators.transcripts import conform

    return conform(transcript_rows(spark, d))


MERGED = """merged AS (
    SELECT concat('call-', conv_id) AS file_path, string_agg(text, ' ' ORDER BY turn) AS transcription
    FROM conversations GROUP BY conv_id)"""

#: A note per order that holds every kind of personal data; the same text in both dialects.
NOTE = """concat(
    CASE o_orderstatus WHEN 'F' THEN 'Mr. ' WHEN 'O' THEN 'Mrs. ' ELSE 'Miss ' END, 'Caller ', o_custkey,
    ' at (', 200 + o_custkey % 800, ') ', 100 + o_orderkey % 900, '-', lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0'),
    ' or c', o_custkey, '.x@mail.example.com, account ', 10000000 + o_orderkey, ', ssn ', 100 + o_custkey % 900, '-',
    lpad(CAST(o_custkey % 100 AS STRING), 2, '0'), '-', lpad(CAST(o_orderkey % 10000 AS STRING), 4, '0'),
    ' since ', month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate), ' and March ', day(o_orderdate), ', ',
    year(o_orderdate), ', home ', 1 + o_custkey % 99, ' Long Street, Springfield, PA ', 10000 + o_custkey % 89999,
    '. Paid $', CAST(floor(o_totalprice / 1000) AS BIGINT), ',', lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0'),
    '.50 as a payment of $', o_custkey, '. Your confirmation number is ', o_orderkey, ', ', o_custkey,
    '. Passport AB', 1000000 + o_orderkey, ', license DL ', 100000000 + o_orderkey, ', EIN ', 100000000 + o_custkey,
    '. Say one two and three foo, or nine. Ref a-', o_orderkey, '-b_c. Card ', 1000 + o_custkey % 9000, '-',
    1000 + o_orderkey % 9000, '-', 2000 + o_custkey % 8000, '-', 3000 + o_orderkey % 7000,
    '. Pay DE', lpad(CAST(o_custkey AS STRING), 20, '0'), ' or https://pay.example.com/c/', o_custkey)"""


#: A row of an order is some 20 bytes on disk, and its note 500 characters.
NOTES_PER_TASK = 50_000


def texts(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").selectExpr("concat('d', doc_id) AS text_id", "text")
    notes = spread(table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    ), NOTES_PER_TASK).selectExpr("concat('o', o_orderkey) AS text_id", f"{NOTE} AS text")
    return documents.unionByName(notes)


TEXTS = f"""texts AS (
    SELECT concat('d', doc_id) AS text_id, text FROM documents
    UNION ALL SELECT concat('o', o_orderkey), {NOTE} FROM orders)"""

#: Unicode word character for an engine whose ``\w`` is ASCII.
W = r"[\p{L}\p{M}\p{Nd}\p{Pc}]"


# --- report -------------------------------------------------------------------------------------

#: Columns of the task segments that only the report needs; the same text in both dialects.
_WIDE = {
    "callbackId": "concat('cb', l_suppkey)", "workItemId": "concat('wi', l_orderkey)",
    "taskSid": "concat('ts', l_orderkey)", "segmentSid": "concat('ss', l_linenumber)",
    "workGroupName": "l_returnflag",
    "workGroupQueueTimestamp": "CASE WHEN l_tax > 0.06 THEN 'not a time' ELSE CAST(l_shipdate AS STRING) END",
    "skillGroupName": "l_linestatus", "queueName": "concat(l_returnflag, l_linestatus)",
    "queueTime": "CASE WHEN l_discount > 0.08 THEN NULL ELSE concat(l_linenumber, '.9') END",
    "agentWrapupTimestamp": "l_shipdate", "endTimestamp": "l_shipdate", "inServiceLevel": "l_returnflag",
    "holdTime": "l_tax * 1000", "acwTime": "l_linenumber", "handleTime": "CAST(l_linenumber AS STRING)",
    "holdCount": "CASE WHEN l_linenumber > 5 THEN 'many' ELSE '2' END",
    "workerSid": "concat('ws', l_suppkey)", "workerName": "concat('Worker ', l_suppkey)",
    "workerCompany": "l_linestatus", "workerLocation": "l_returnflag", "workerManager": "l_returnflag",
    "taskType": "'voice'", "segmentConferenceYN": "'N'", "segmentInterpreterYN": "'N'",
    "segmentTransferredYN": "CASE WHEN l_linenumber > 1 THEN 'Y' ELSE 'N' END", "disconnectedBy": "'agent'",
    "callbackRequeuedYN": "'N'", "insertDate": "l_shipdate",
}


def wide_segments(spark: SparkSession, d: str) -> DataFrame:
    narrow = segments(spark, d).columns
    lines = table(spark, d, "lineitem")
    base = lines.selectExpr(
        "l_orderkey AS taskId", "l_partkey AS callSid", "l_linenumber AS segmentId",
        "l_shipdate AS agentConnectTimestamp",
        """CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
                WHEN l_linenumber = 7 THEN 'https://rec.example.com/'
                ELSE concat('https://rec.example.com/v1/RE', l_suppkey, '-', l_linenumber) END AS taskURL""",
        "l_quantity AS talkTime", *[f"{x} AS {name}" for name, x in _WIDE.items()],
    )
    return base.select(*narrow, *_WIDE)


WIDE_SEGMENTS = f"""segments AS (
    SELECT l_orderkey AS taskId, l_partkey AS callSid, l_linenumber AS segmentId,
           l_shipdate AS agentConnectTimestamp,
           CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
                WHEN l_linenumber = 7 THEN 'https://rec.example.com/'
                ELSE concat('https://rec.example.com/v1/RE', l_suppkey, '-', l_linenumber) END AS taskURL,
           l_quantity AS talkTime, {', '.join(f'{x} AS {name}' for name, x in _WIDE.items())}
    FROM lineitem)"""


def stages(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Stage outputs per recording file, drawn from the conversations."""
    from callspark.operators.insights import FIELDS

    turns = table(spark, d, "conversations")
    per_call = turns.groupBy("conv_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda t: t["text"]), " "
        ).alias("transcription"),
        F.max_by("text", "turn").alias("summary"),
        F.array(F.min_by("role", "turn"), F.max_by("role", "turn")).alias("topics"),
    )
    files = per_call.select(
        "*", F.explode(F.array(F.lit(1), F.lit(2))).alias("line")
    ).withColumn("file_path", F.expr("concat('/audio/RE', conv_id, '-', line, '.wav')"))
    return {
        "summary": files.select("file_path", "summary"),
        "topics": files.select("file_path", "topics"),
        "transcription": files.select("file_path", "transcription"),
        "insights": files.select(
            "file_path", *[F.concat(F.lit(f"{f} of "), F.col("conv_id")).alias(f) for f in FIELDS]
        ),
    }


def _stages_sql() -> str:
    from callspark.operators.insights import FIELDS

    fields = ", ".join(f"concat('{f} of ', conv_id) AS \"{'summary_concise' if f == 'Summary' else f}\"" for f in FIELDS)
    return f"""stages AS (
    SELECT concat('/audio/RE', conv_id, '-', line, '.wav') AS file_path, transcription, summary, topics, {fields}
    FROM (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS transcription, arg_max(text, turn) AS summary,
                 concat('["', arg_min(role, turn), '","', arg_max(role, turn), '"]') AS topics
          FROM conversations GROUP BY conv_id), unnest([1, 2]) AS u(line))"""


STAGES = _stages_sql()
