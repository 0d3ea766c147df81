"""The reporting table: stage outputs side by side, joined to metadata and accounts, 54 typed columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callspark.operators.skew import hot_keys, lookup_join
from callspark.session import cut_lineage

# Report columns in order, as (input name, output name, type).
LAYOUT = (
    ("KY_BA", "bill_account_key", "string"),
    ("file_path", "file_path", "string"),
    ("transcription", "transcription", "string"),
    ("summary", "summary", "string"),
    ("topics", "topics", "string"),
    ("summary_concise", "summary_concise", "string"),
    ("Category", "Category", "string"),
    ("Main Issue", "Main_Issue", "string"),
    ("Steps Taken", "Steps_Taken", "string"),
    ("Sentiment", "Sentiment", "string"),
    ("Urgency", "Urgency", "string"),
    ("Follow-Up Actions", "FollowUp_Actions", "string"),
    ("Repeated Issues", "RepeatedIssues", "string"),
    ("Customer Loyalty Indicators", "CustomerLoyaltyIndicators", "string"),
    ("Transfer Involved", "TransferInvolved", "string"),
    ("Department Transferred To", "DepartmentTransferredTo", "string"),
    ("Issue Resolution Status", "IssueResolutionStatus", "string"),
    ("Satisfaction Score", "SatisfactionScore", "string"),
    ("Improvement Suggestions", "ImprovementSuggestions", "string"),
    ("taskId", "taskId", "string"),
    ("callSid", "callSid", "string"),
    ("callbackId", "callbackId", "string"),
    ("workItemId", "workItemId", "string"),
    ("taskSid", "taskSid", "string"),
    ("segmentId", "segmentId", "string"),
    ("segmentSid", "segmentSid", "string"),
    ("workGroupName", "workGroupName", "string"),
    ("workGroupQueueTimestamp", "workGroupQueueTimestamp", "timestamp"),
    ("skillGroupName", "skillGroupName", "string"),
    ("queueName", "queueName", "string"),
    ("queueTime", "queueTime", "int"),
    ("agentConnectTimestamp", "agentConnectTimestamp", "timestamp"),
    ("agentWrapupTimestamp", "agentWrapupTimestamp", "timestamp"),
    ("endTimestamp", "endTimestamp", "timestamp"),
    ("inServiceLevel", "inServiceLevel", "string"),
    ("talkTime", "talkTime", "int"),
    ("holdTime", "holdTime", "int"),
    ("acwTime", "acwTime", "int"),
    ("handleTime", "handleTime", "int"),
    ("holdCount", "holdCount", "int"),
    ("workerSid", "workerSid", "string"),
    ("workerName", "workerName", "string"),
    ("workerCompany", "workerCompany", "string"),
    ("workerLocation", "workerLocation", "string"),
    ("workerManager", "workerManager", "string"),
    ("taskType", "taskType", "string"),
    ("segmentConferenceYN", "segmentConferenceYN", "string"),
    ("segmentInterpreterYN", "segmentInterpreterYN", "string"),
    ("segmentTransferredYN", "segmentTransferredYN", "string"),
    ("disconnectedBy", "disconnectedBy", "string"),
    ("callbackRequeuedYN", "callbackRequeuedYN", "string"),
    ("taskURL", "taskURL", "string"),
    ("insertDate", "insertDate", "timestamp"),
    ("RecordingSID", "RecordingSID", "string"),
)
IVR_COLUMNS = ("User_Response", "Intent", "Intent_Score", "IVR_Question")
#: Rows of one file from which on it is looked up among the stages before the join.
HOT_ROWS = 100_000
INDEX_COLUMNS = ("Unnamed: 0.1", "Unnamed: 0")


def lenient_timestamp(col: Column | str) -> Column:
    """Text or time to a timestamp; null where it cannot be read."""
    return F.try_to_timestamp((F.col(col) if isinstance(col, str) else col).cast("string"))


def lenient_int(col: Column | str) -> Column:
    """Text or number to an int, cutting fractions; null and unreadable give 0."""
    number = (F.col(col) if isinstance(col, str) else col).try_cast("double")
    return F.coalesce(number.try_cast("int"), F.lit(0))


def _typed(col: Column, type_: str, source_type: str) -> Column:
    if type_ == "timestamp":
        return lenient_timestamp(col)
    if type_ == "int":
        return lenient_int(col)
    if source_type in ("array", "struct", "map"):
        return F.to_json(col)
    return col.cast("string")


def align(stages: list[DataFrame], key: str = "file_path", how: str = "inner", unique: bool = False) -> DataFrame:
    """Stage outputs side by side, joined by the key they all carry.

    ``how="full"`` keeps a call that a stage lacks, with nulls. ``unique=True`` first makes sure
    that no stage repeats a key, which would multiply rows.
    """
    if how not in ("inner", "full"):
        raise ValueError(f"unsupported join type: {how}")
    for number, stage in enumerate(stages if unique else ()):
        repeated = stage.groupBy(key).count().filter("count > 1").limit(1).collect()
        if repeated:
            raise ValueError(f"stage {number} has {repeated[0]['count']} rows for {key} {repeated[0][key]}")
    return reduce(lambda a, b: a.join(b, key, how), stages)


def numbered(df: DataFrame, order: list[str], into: str = "row_no") -> DataFrame:
    """Numbers the rows from 0 in a stated order without pulling them into one task.

    The rows are sorted in ranges and written to the checkpoint folder, so that the ranges are the
    same in both uses; the offsets are one row per range.
    """
    ranged = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order))
    placed = ranged.withColumn("__id", F.monotonically_increasing_id())
    placed = placed.withColumns({
        "__range": F.shiftright("__id", 33), "__at": F.col("__id").bitwiseAND((1 << 33) - 1)
    }).drop("__id")
    sizes = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    # One row per range, and the number of ranges is a setting of the session.
    return (
        placed.join(F.broadcast(offsets), "__range")
        .withColumn(into, F.col("__offset") + F.col("__at"))
        .drop("__range", "__at", "__offset")
    )


def align_by_position(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str]) -> DataFrame:
    """Rows side by side by their place in a stated order, for files without a key.

    Where one side has fewer rows its columns are null.
    """
    return numbered(left, left_order).join(numbered(right, right_order), "row_no", "full").drop("row_no")


def without_unmatched(df: DataFrame, other: DataFrame, key: str, rows: int = HOT_ROWS) -> DataFrame:
    """The rows of ``df`` but those of keys with more than ``rows`` rows that ``other`` lacks.

    An inner join drops these rows anyhow; here they go before the shuffle, which would bring all rows of
    such a key to one task. Keys are counted on the map side, and few can have so many rows.
    """
    unmatched = hot_keys(df, [key], rows).select(key).join(other.select(key), key, "left_anti")
    return df.join(F.broadcast(unmatched), key, "left_anti")


def assemble(
    stages: dict[str, DataFrame], metadata: DataFrame, master: DataFrame, rows_per_task: int | None = None
) -> DataFrame:
    """Stage outputs, call metadata and accounts in one table.

    The stages share ``file_path``. The insight ``Summary`` becomes ``summary_concise``, as Spark
    does not tell it from ``summary``. The master list gives the account of a task, and may name it
    ``taskId``, ``TASK_ID`` or ``Task_ID``.
    """
    renamed = [s.withColumnRenamed("Summary", "summary_concise") if "Summary" in s.columns else s for s in stages.values()]
    metadata = metadata.drop(*IVR_COLUMNS)
    # A file may stand for many segments, above all the sentinel of recordings not downloaded, which no stage has.
    files = align(renamed, unique=True)
    matched = without_unmatched(metadata, renamed[0], "file_path")
    calls = lookup_join(matched, files, ["file_path"], rows_per_task=rows_per_task)
    accounts = master.withColumnsRenamed({"TASK_ID": "taskId", "Task_ID": "taskId"}).select("KY_BA", "taskId")
    joined = lookup_join(calls, accounts, ["taskId"], rows_per_task=rows_per_task, count_on=metadata)
    return joined.drop(*INDEX_COLUMNS)


def conform(df: DataFrame, layout=LAYOUT) -> DataFrame:
    """The report columns in order, renamed and typed; bad times become null, bad numbers 0."""
    missing = [source for source, _, _ in layout if source not in df.columns]
    if missing:
        raise ValueError(f"report input lacks {missing}")
    return df.select(*[
        _typed(F.col(f"`{source}`"), type_, df.schema[source].dataType.typeName()).alias(target)
        for source, target, type_ in layout
    ])
