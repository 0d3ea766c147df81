"""Voice-menu events: one layout for three logs, first understood answer, intent per call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callspark.operators.skew import ROWS_PER_TASK, lookup_join

# Layout of the unified event table, and the intent that means "not understood".
EVENT_COLUMNS = [
    "accountId", "conversationId", "recognizerResult_text", "recognizerResult_intent_value",
    "recognizerResult_intent_score", "timestamp", "event_Name", "event_Type", "brd_ActivityId",
    "brd_Text",
]
NOT_UNDERSTOOD = "didnt_understand"
VOICE_CHANNEL = "TwilioVoice"


def in_window(
    log: DataFrame, start: str, end: str, *, ts: str = "timestamp", channel: str | None = VOICE_CHANNEL
) -> DataFrame:
    """Events of one channel between two days, both included."""
    day = F.col(ts).cast("date")
    kept = log.filter(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return kept.filter(F.col("channelId") == channel) if channel else kept


def prepare_intent(nlp_result: DataFrame) -> DataFrame:
    """Recognizer log under the names of the unified layout."""
    return nlp_result.select(
        "accountId",
        "conversationId",
        F.col("eventMessage_recognizerResult_text").alias("recognizerResult_text"),
        F.col("eventMessage_topIntent").alias("recognizerResult_intent_value"),
        F.col("eventMessage_topIntentScore").alias("recognizerResult_intent_score"),
        F.col("timeStamp").alias("timestamp"),
    )


def unified_events(intent: DataFrame, transfer: DataFrame, audio: DataFrame) -> DataFrame:
    """The three logs in one layout; columns a log does not have are null."""
    transfer = transfer.select("conversationId", "timestamp", "event_Name", "event_Type")
    audio = audio.select("conversationId", "timestamp", "brd_ActivityId", "brd_Text")
    return (
        prepare_intent(intent)
        .unionByName(transfer, allowMissingColumns=True)
        .unionByName(audio, allowMissingColumns=True)
        .select(*EVENT_COLUMNS)
    )


def understood() -> Column:
    """An answer the recognizer understood; an empty text passes, a single space does not."""
    return (
        (F.col("recognizerResult_intent_value") != NOT_UNDERSTOOD)
        & F.col("recognizerResult_text").isNotNull()
        & (F.col("recognizerResult_text") != " ")
    )


def understood_responses(events: DataFrame) -> DataFrame:
    return events.filter(understood())


def _first_answer() -> Column:
    """Earliest understood answer as a struct; equal times are decided by the answer itself."""
    answer = F.struct(
        F.col("timestamp").alias("min_timestamp"),
        "recognizerResult_text",
        "recognizerResult_intent_value",
        "recognizerResult_intent_score",
    )
    return F.min(F.when(understood(), answer))


def first_response(events: DataFrame) -> DataFrame:
    """First understood answer of every conversation that has one."""
    return (
        understood_responses(events)
        .groupBy("conversationId")
        .agg(_first_answer().alias("first"))
        .select("conversationId", "first.*")
    )


def events_before_response(events: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Events strictly before the first understood answer of their conversation.

    One aggregation finds the answer and counts the events of the conversation; the count tells
    the join which conversations to spread.
    """
    answers = (
        events.groupBy("conversationId")
        .agg(_first_answer().alias("first"), F.count(F.lit(1)).alias("event_rows"))
        .filter(F.col("first").isNotNull())
        .select("conversationId", "first.*", "event_rows")
    )
    narrow = events.select("conversationId", "timestamp", "brd_Text")
    return (
        lookup_join(
            narrow,
            answers.withColumnsRenamed({
                "recognizerResult_text": "USER_RESPONSE",
                "recognizerResult_intent_value": "INTENT",
                "recognizerResult_intent_score": "INTENT_SCORE",
            }),
            ["conversationId"],
            rows_column="event_rows",
            rows_per_task=rows_per_task,
        )
        .filter(F.col("min_timestamp") > F.col("timestamp"))
        .select(
            "conversationId",
            F.col("timestamp").alias("timeStamp"),
            "USER_RESPONSE",
            "INTENT",
            "INTENT_SCORE",
            F.col("brd_Text").alias("IVR_QUESTION"),
        )
    )


def intent_per_call(before: DataFrame, ignore_null_question: bool = False) -> DataFrame:
    """First answer and last question per conversation.

    The last question is the one of the latest event, null included;
    ``ignore_null_question=True`` takes the latest event that has a question.
    """
    question = F.struct("timeStamp", "IVR_QUESTION")
    if ignore_null_question:
        question = F.when(F.col("IVR_QUESTION").isNotNull(), question)
    return (
        before.groupBy("conversationId")
        .agg(
            F.min(F.struct("timeStamp", "USER_RESPONSE", "INTENT", "INTENT_SCORE")).alias("first"),
            F.max(question).alias("last"),
        )
        .select(
            F.col("conversationId").alias("callSid"),
            F.col("first.USER_RESPONSE").alias("User_Response"),
            F.col("first.INTENT").alias("Intent"),
            F.col("first.INTENT_SCORE").alias("Intent_Score"),
            F.col("last.IVR_QUESTION").alias("IVR_Question"),
        )
    )
