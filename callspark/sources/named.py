"""Statements kept by name and run over registered views."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

# The names of the statements, of their views and columns, and the values they compare with.
#: Views: dfIntent, dfTransferReasonFiltered and dfAudioResponseFiltered for Union, dfUnion for
#: Minimum, tasksegments and task_ids_temp for Filter, Intent for Aggregate. First and last are
#: decided by time, as the order of rows does not survive a shuffle.
NAMED_QUERIES = {
    "Union": """
        SELECT accountId, conversationId, recognizerResult_text, recognizerResult_intent_value,
               recognizerResult_intent_score, timestamp,
               CAST(NULL AS STRING) AS event_Name, CAST(NULL AS STRING) AS event_Type,
               CAST(NULL AS STRING) AS brd_ActivityId, CAST(NULL AS STRING) AS brd_Text
        FROM dfIntent
        UNION ALL
        SELECT NULL, conversationId, NULL, NULL, NULL, timestamp, event_Name, event_Type, NULL, NULL
        FROM dfTransferReasonFiltered
        UNION ALL
        SELECT NULL, conversationId, NULL, NULL, NULL, timestamp, NULL, NULL, brd_ActivityId, brd_Text
        FROM dfAudioResponseFiltered
        ORDER BY timestamp
    """,
    "Minimum": """
        WITH answers AS (
            SELECT conversationId,
                   min(struct(timestamp, recognizerResult_text, recognizerResult_intent_value,
                              recognizerResult_intent_score)) AS a
            FROM dfUnion
            WHERE recognizerResult_intent_value <> 'didnt_understand'
              AND recognizerResult_text IS NOT NULL AND recognizerResult_text <> ' '
            GROUP BY conversationId
        )
        SELECT e.conversationId, e.timestamp AS timeStamp, a.recognizerResult_text AS USER_RESPONSE,
               a.recognizerResult_intent_value AS INTENT, a.recognizerResult_intent_score AS INTENT_SCORE,
               e.brd_Text AS IVR_QUESTION
        FROM dfUnion e
        JOIN answers ON answers.conversationId = e.conversationId AND answers.a.timestamp > e.timestamp
        ORDER BY e.timestamp
    """,
    "Filter": """
        SELECT * FROM tasksegments
        WHERE CAST(agentConnectTimestamp AS DATE) >= CAST(:since AS DATE)
          AND taskId IN (SELECT taskId FROM task_ids_temp)
    """,
    "Aggregate": """
        SELECT conversationId,
               min(struct(timeStamp, USER_RESPONSE)).USER_RESPONSE AS User_Response,
               min(struct(timeStamp, INTENT)).INTENT AS Intent,
               min(struct(timeStamp, INTENT_SCORE)).INTENT_SCORE AS Intent_Score,
               max(struct(timeStamp, IVR_QUESTION)).IVR_QUESTION AS IVR_Question
        FROM Intent
        GROUP BY conversationId
    """,
}


def load_catalogue(path: str) -> dict[str, str]:
    """A catalogue file: ``{"queries": [{"name": ..., "sql": ...}]}``."""
    with open(path, encoding="utf-8") as f:
        return {q["name"]: q["sql"].rstrip().rstrip(";") for q in json.load(f)["queries"]}


def run_named(
    spark: SparkSession, name: str, views: dict[str, DataFrame], args: dict | None = None,
    catalogue: dict[str, str] = NAMED_QUERIES,
) -> DataFrame:
    """Registers the views and runs one statement of the catalogue with its values bound."""
    if name not in catalogue:
        raise KeyError(f"no statement named {name!r}")
    for view, df in views.items():
        df.createOrReplaceTempView(view)
    return spark.sql(catalogue[name], args=args)
