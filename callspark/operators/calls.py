"""Call header, repeat callers, task segments, recordings and call metadata."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callspark.operators.skew import ROWS_PER_TASK, lookup_join

NOT_DOWNLOADED = "Not Downloaded"
CALLER_ORDER = ("KY_BA", "CALL_DATE", "CALL_START_TIME", "TASK_ID")


def agent_calls(
    header: DataFrame,
    start: str,
    end: str,
    *,
    conv: str = "conversationId",
    ts: str = "startTimestamp",
    account: str = "billAccountNumber",
    ivr_time: str = "inIvrTime",
    reason: str = "transferToAgentReason",
    min_ivr: float = 2,
) -> DataFrame:
    """Calls handed to an agent between two dates, both included.

    The date test is on the timestamp cast to a date; Catalyst turns it into a timestamp range
    that reaches the Parquet scan.
    """
    day = F.col(ts).cast("date")
    return header.filter(
        (F.col(ivr_time) > min_ivr)
        & day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
        & F.col(reason).isNotNull()
        & F.col(account).isNotNull()
    ).select(
        F.col(conv).alias("TASK_ID"),
        day.alias("CALL_DATE"),
        F.col(ts).alias("CALL_START_TIME"),
        F.col(account).alias("KY_BA"),
    )


def account_counts(calls: DataFrame, distinct: bool = True) -> DataFrame:
    """Calls per account, with the number of rows in ``call_rows``.

    The distinct form counts per (account, call) first, so that an account with a large share of
    the calls is spread over its calls before it is reduced to one row.
    """
    if distinct:
        per_call = calls.groupBy("KY_BA", "TASK_ID").agg(F.count(F.lit(1)).alias("call_rows"))
        return per_call.groupBy("KY_BA").agg(
            F.count("TASK_ID").alias("NumberOfCalls"), F.sum("call_rows").alias("call_rows")
        )
    return calls.groupBy("KY_BA").agg(
        F.count("TASK_ID").alias("NumberOfCalls"), F.count(F.lit(1)).alias("call_rows")
    )


def frequent_accounts(calls: DataFrame, min_calls: int = 2, distinct: bool = True) -> DataFrame:
    """Accounts with more than ``min_calls`` calls."""
    return account_counts(calls, distinct).filter(F.col("NumberOfCalls") > min_calls)


def frequent_callers(
    calls: DataFrame,
    min_calls: int = 2,
    distinct: bool = True,
    limit: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """All calls of the frequent accounts, most frequent first.

    ``distinct=False`` counts non-null call ids instead of distinct ones. ``limit`` keeps the first
    rows of the stated order, as a top-N that needs no full sort.
    """
    accounts = frequent_accounts(calls, min_calls, distinct)
    joined = lookup_join(
        calls, accounts, ["KY_BA"], rows_column="call_rows", rows_per_task=rows_per_task
    ).select("KY_BA", "TASK_ID", "CALL_DATE", "CALL_START_TIME", "NumberOfCalls")
    ordered = joined.orderBy(F.desc("NumberOfCalls"), *CALLER_ORDER)
    return ordered.limit(limit) if limit is not None else ordered


def valid_date(col: Column | str) -> Column:
    """True where the text is a calendar date, year first; leading zeros may be missing."""
    text = F.col(col) if isinstance(col, str) else col
    shape = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")
    return F.coalesce(shape & F.try_to_timestamp(text, F.lit("yyyy-M-d")).isNotNull(), F.lit(False))


def is_valid_date(text: str) -> bool:
    """The same check for a single driver-side parameter."""
    try:
        dt.datetime.strptime(text, "%Y-%m-%d")
    except ValueError:
        return False
    return True


def window_bounds(end: Column | str, days: int = 365) -> tuple[Column, Column]:
    """First and last day of the reporting window: the day before ``end``, and ``days`` earlier."""
    day = (F.col(end) if isinstance(end, str) else end).cast("date")
    last = F.date_sub(day, 1)
    return F.date_sub(last, days), last


def reporting_window(end: str, days: int = 365) -> tuple[str, str]:
    """The same bounds for a single driver-side parameter."""
    last = dt.date.fromisoformat(end) - dt.timedelta(days=1)
    return (last - dt.timedelta(days=days)).isoformat(), last.isoformat()


def task_segments(
    segments: DataFrame, ids: DataFrame, since: str, *, key: str = "taskId",
    ts: str = "agentConnectTimestamp", rows_per_task: int | None = None,
) -> DataFrame:
    """Segments of the listed tasks connected on or after a day; repeated ids do not repeat rows."""
    recent = segments.filter(F.col(ts).cast("date") >= F.lit(since).cast("date"))
    return lookup_join(recent, ids.select(key), [key], "left_semi", rows_per_task=rows_per_task)


def task_segments_inner(
    segments: DataFrame, ids: DataFrame, since: str, *, key: str = "taskId",
    ts: str = "agentConnectTimestamp", rows_per_task: int | None = None,
) -> DataFrame:
    """As :func:`task_segments`, as an inner join: an id listed twice gives its segments twice."""
    recent = segments.filter(F.col(ts).cast("date") >= F.lit(since).cast("date"))
    return lookup_join(recent, ids.select(key), [key], rows_per_task=rows_per_task)


def recording_sid(url: Column | str) -> Column:
    """Text after the last slash; empty for a null URL."""
    return F.coalesce(F.substring_index(url, "/", -1), F.lit(""))


#: The same as a SQL function, for named statements.
RECORDING_SID_SQL = (
    "CREATE OR REPLACE TEMPORARY FUNCTION extract_recording_sid(url STRING) RETURNS STRING "
    "RETURN coalesce(substring_index(url, '/', -1), '')"
)


def with_recordings(segments: DataFrame, url: str = "taskURL") -> DataFrame:
    """Adds RecordingSID and keeps the segments that have one."""
    return segments.withColumn("RecordingSID", recording_sid(url)).filter(F.col("RecordingSID") != "")


def attach_recordings(
    segments: DataFrame, manifest: DataFrame, rows_per_task: int | None = None,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Adds the file of each recording, or the sentinel where it was not downloaded.

    The manifest is reduced to one row per recording first; a downloaded file wins over the
    sentinel, and the smallest path wins between several files.
    """
    files = manifest.groupBy("RecordingSID").agg(
        F.min(F.when(F.col("file_path") != NOT_DOWNLOADED, F.col("file_path"))).alias("file_path")
    )
    joined = lookup_join(
        segments, files, ["RecordingSID"], "left", rows_per_task=rows_per_task, count_on=count_on
    )
    return joined.withColumn("file_path", F.coalesce("file_path", F.lit(NOT_DOWNLOADED)))


def metadata(
    segments: DataFrame, intent: DataFrame, key: str = "callSid",
    rows_per_task: int | None = None, count_on: DataFrame | None = None,
) -> DataFrame:
    """Adds the intent of the call (one row per call) to its segments."""
    for side, df in (("segments", segments), ("intent", intent)):
        if key not in df.columns:
            raise ValueError(f"column {key!r} is missing from the {side} side")
    return lookup_join(segments, intent, [key], "left", rows_per_task=rows_per_task, count_on=count_on)
