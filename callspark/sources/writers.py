"""Outputs: Parquet stage, CSV, managed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_stage(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet output of a stage."""
    df.write.mode(mode).parquet(path)


def flatten_for_csv(df: DataFrame) -> DataFrame:
    """Arrays, structs and maps as JSON text, which is all CSV can hold."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(*[
        F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, quoted so that :func:`readers.read_csv_stage` gives the rows back."""
    flatten_for_csv(df).write.mode(mode).options(
        header=True, quote='"', escape='"', escapeQuotes=True
    ).csv(path)


def save_table(df: DataFrame, table: str, database: str = "default") -> None:
    """Replaces a managed table, its schema included."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(f"`{database}`.`{table}`")
