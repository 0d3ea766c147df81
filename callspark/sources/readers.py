"""Inputs: activity logs by month, stage tables, CSV, taxonomy, instructions, file lists."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIMESTAMP_NAMES = {"nlp_result": "timeStamp"}


def month_paths(root: str, kind: str, start: str, end: str, months: str = "all") -> list[str]:
    """Directories ``root/kind/YYYY/MM/*/*`` of every month the window touches.

    ``months="start_only"`` lists the month of the first day alone.
    """
    day, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    if day > last:
        raise ValueError(f"window ends before it starts: {start} .. {end}")
    if months == "start_only":
        last = day
    paths = []
    year, month = day.year, day.month
    while (year, month) <= (last.year, last.month):
        paths.append(f"{root.rstrip('/')}/{kind}/{year:04d}/{month:02d}/*/*/")
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)
    return paths


def read_activity_log(
    spark: SparkSession, root: str, kind: str, start: str, end: str, months: str = "all",
    channel: str | None = "TwilioVoice", missing: str = "fail", late_days: int = 0,
) -> DataFrame:
    """One activity log over a window of days, read from the day directories in it.

    A month without a directory is an error, as the result would look complete; with
    ``missing="skip"`` it is left out. The directories of the months are listed once, by Spark, and
    those of days outside the window are not read; directories that are not named by a day are.
    ``late_days`` reads so many more days at the end, for entries that are filed after their day. The
    day and channel filters reach the scan.
    """
    if missing not in ("fail", "skip"):
        raise ValueError(f"unknown way with missing months: {missing}")
    wanted = month_paths(root, kind, start, end, months)
    listed = {p: files for p in wanted if (files := _listed(spark, p)) is not None}
    if missing == "fail" and listed and len(listed) < len(wanted):
        raise FileNotFoundError(f"no directory for {sorted(set(wanted) - set(listed))}")
    if not listed:
        raise FileNotFoundError(f"no {kind} directory between {start} and {end} below {root}")
    upto = (dt.date.fromisoformat(end) + dt.timedelta(days=late_days)).isoformat()
    directories = [d for month, files in listed.items() for d in directories_of_days(files, month, start, upto)]
    log = spark.read.parquet(*directories) if directories else spark.read.parquet(*listed).limit(0)
    day = F.col(TIMESTAMP_NAMES.get(kind, "timestamp")).cast("date")
    log = log.filter(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return log.filter(F.col("channelId") == channel) if channel else log


def _listed(spark: SparkSession, pattern: str) -> DataFrame | None:
    """Paths of the files in the directories of a pattern, from a listing alone; none if there is no such directory."""
    try:
        return spark.read.format("binaryFile").load(pattern).select("path")
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def directories_of_days(files: DataFrame, month: str, start: str, end: str) -> list[str]:
    """The directories that hold files and whose day is in the window, or that name no day.

    ``month`` is a pattern of :func:`month_paths`; what follows the month in a path is the day. There are
    as many rows as directories.
    """
    year, number = month.rstrip("/").removesuffix("/*/*").split("/")[-2:]
    directory = F.regexp_extract("path", "^(.*)/[^/]+$", 1)
    day = F.regexp_extract("path", rf"/{year}/{number}/(\d{{1,2}})/[^/]+/[^/]+$", 1)
    found = files.select(directory.alias("directory"), F.make_date(F.lit(int(year)), F.lit(int(number)), F.expr("1")).alias("first"), day.alias("day"))
    date = F.when(F.col("day") == "", None).otherwise(F.date_add("first", F.col("day").cast("int") - 1))
    within = date.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return sorted(r["directory"] for r in found.filter(date.isNull() | within).select("directory").distinct().collect())


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """Parquet output of an earlier stage."""
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the catalog."""
    return spark.table(name)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database."""
    return spark.sql("SHOW TABLES IN IDENTIFIER(:db)", args={"db": database})


def read_csv_stage(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header; quoted text may hold quotes, commas and line breaks.

    Give the schema: without one Spark reads the files twice.
    """
    reader = spark.read.options(header=True, multiLine=True, quote='"', escape='"')
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_taxonomy_lines(spark: SparkSession, path: str) -> DataFrame:
    """A taxonomy of any size: one JSON object with one topic and its description per line, in the order of the files and lines.

    Lines are numbered by ranges, so that no task holds them all.
    """
    from callspark.operators.report import numbered

    lines = spark.read.text(path).filter(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))
    named = lines.select("file", "line", F.map_entries(F.from_json("value", "map<string,string>")).alias("e"))
    entries = named.select("file", "line", F.posexplode("e").alias("at", "pair"))
    rows = numbered(entries, ["file", "line", "at"], "topic_num")
    return rows.select(F.col("topic_num").cast("int").alias("topic_num"), F.col("pair.key").alias("topic"), F.col("pair.value").alias("description"))


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of topic name to description, as (topic_num, topic, description) rows.

    The object is read as one text; see :func:`read_taxonomy_lines` for large taxonomies.
    """
    text = spark.read.text(path, wholetext=True)
    pairs = F.from_json("value", "map<string,string>")
    return text.select(F.posexplode(pairs).alias("topic_num", "topic", "description"))


def read_instructions(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Rows of instruction, context and response."""
    schema = "instruction string, context string, response string"
    return spark.read.format(fmt).schema(schema).load(path)


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Files of a directory with size and time; the bytes are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", "modificationTime")


def ids_frame(spark: SparkSession, ids: list, name: str = "taskId", view: str | None = None) -> DataFrame:
    """A short list of ids as a one-column DataFrame, registered as a view on request."""
    df = spark.createDataFrame([(i,) for i in ids], [name])
    if view:
        df.createOrReplaceTempView(view)
    return df
