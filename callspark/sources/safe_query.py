"""Selects whose names are checked against an allow-list and whose values are bound."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns, tables and databases a caller may name.
APPROVED_COLUMNS = frozenset({
    "taskId", "agentConnectTimestamp", "taskURL", "accountId", "conversationId", "timeStamp",
    "timestamp", "eventMessage_recognizerResult_text", "eventMessage_topIntent",
    "eventMessage_topIntentScore", "channelId", "event_Name", "event_Type", "brd_ActivityId",
    "brd_Text", "recognizerResult_text", "recognizerResult_intent_value",
    "recognizerResult_intent_score", "USER_RESPONSE", "INTENT", "INTENT_SCORE", "IVR_QUESTION",
    "User_Response", "Intent", "Intent_Score",
})
APPROVED_TABLES = frozenset({
    "tasksegments", "callHeader", "dfIntent", "dfAudioResponseFiltered",
    "dfTransferReasonFiltered", "dfUnion", "Intent",
})

APPROVED_DATABASES = frozenset({"csda"})


def check_names(names: Iterable[str], approved: Iterable[str]) -> None:
    """Raises if a name is not on the list."""
    allowed = set(approved)
    refused = [n for n in names if n not in allowed]
    if refused:
        raise ValueError(f"not an approved name: {', '.join(map(repr, refused))}")


def quoted(name: str) -> str:
    """A name between backticks, inner ones doubled, so that any column name can be used."""
    return "`" + name.replace("`", "``") + "`"


def select(
    source: DataFrame,
    columns: Sequence[str],
    *,
    approved: Iterable[str] = APPROVED_COLUMNS,
    join: tuple[DataFrame, Sequence[str]] | None = None,
    where: Sequence[Column] = (),
) -> DataFrame:
    """Approved columns of a table, optionally joined, under all the given conditions.

    Conditions are column expressions, so a value in them is a literal of the plan and never text.
    """
    check_names(columns, approved)
    df = source
    if join is not None:
        other, keys = join
        check_names(keys, approved)
        df = df.join(other, list(keys))
    for condition in where:
        df = df.filter(condition)
    return df.select(*[F.col(quoted(c)) for c in columns])


def select_table(
    spark: SparkSession, table: str, columns: Sequence[str], *,
    approved_tables: Iterable[str] = APPROVED_TABLES, approved_databases: Iterable[str] = APPROVED_DATABASES, **options,
) -> DataFrame:
    """:func:`select` on an approved table or view of the catalog, or on such a table of an approved database."""
    database, dot, name = table.rpartition(".")
    check_names([name], approved_tables)
    if dot:
        check_names([database], approved_databases)
    return select(spark.table(".".join(quoted(n) for n in (database, name) if n)), columns, **options)


def run(spark: SparkSession, query: str, params: Sequence | dict | None = None) -> DataFrame:
    """A statement with positional (``?``) or named (``:name``) values bound."""
    return spark.sql(query, args=params or None)
