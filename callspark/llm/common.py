"""What the operators share: tables, written stages and Arrow columns."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callspark.session import ensure_checkpoint_dir

#: Words between white space, and words of letters and digits of an ASCII-lower-cased text.
SPACED_WORD = "[^\\x20\\x09-\\x0D]+"
BETWEEN_WORDS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rows and bytes a Python function works on at once. Spark bounds the bytes of an Arrow batch by itself, so the
#: session's settings stay as they are.
ARROW_ROWS, ARROW_BYTES = 500, 8 << 20


def table(spark: SparkSession, d: str, name: str, *columns: str) -> DataFrame:
    """Columns of a given table, read through Spark."""
    df = spark.read.parquet(f"{d}/{name}.parquet")
    return df.select(*columns) if columns else df


def written(df: DataFrame, name: str, let_go: bool = False) -> DataFrame:
    """Writes a stage to the shared folder and reads it again.

    The rest of the plan then starts from files that outlive executors, and the stage runs once
    however often it is used. Files stay until the folder is cleared, as a lazily read result may
    need them. ``let_go`` is for stages that shuffle much: the driver collects its garbage, and
    Spark's cleaner removes the shuffle files that no plan refers to any more, instead of holding
    them beside those of the stages that follow.
    """
    spark = df.sparkSession
    path, schema = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}", df.schema
    df.write.parquet(path)
    if let_go:
        for _ in range(2):  # the first may come before the listeners have let the finished query go
            gc.collect()
            spark.sparkContext._jvm.System.gc()
            time.sleep(0.5)
    return spark.read.schema(schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def sliced(batches: Iterator[pa.RecordBatch], rows: int = ARROW_ROWS, size: int = ARROW_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of few rows and bytes, which bounds what a Python function makes of one piece.

    A single row over ``size`` bytes is a piece by itself.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            todo = [batch.slice(at, rows)]
            while todo:
                piece = todo.pop()
                half = piece.num_rows // 2
                if half and piece.nbytes > size:
                    todo += [piece.slice(half), piece.slice(0, half)]
                else:
                    yield piece
