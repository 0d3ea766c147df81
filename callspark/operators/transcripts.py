"""Transcripts as segments per call: building, merging, chunking, measuring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callspark.functions import text as X

SEGMENTS = "array<struct<start:double,end:double,text:string,no_speech_probability:double>>"


def conform(rows: DataFrame, key: str = "file_path") -> DataFrame:
    """Segment rows (start, end, text, no_speech_probability) to one ordered array per call.

    A call is one row of the result, so its segments do meet in one task, as one value.
    """
    missing = {"start", "end", "text"} - set(rows.columns)
    if missing:
        raise ValueError(f"segment rows lack {sorted(missing)}")
    if "no_speech_probability" not in rows.columns:
        rows = rows.withColumn("no_speech_probability", F.lit(None).cast("double"))
    segment = F.struct("start", "end", "text", "no_speech_probability")
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(segment)).cast(SEGMENTS).alias("transcription"))


def conform_array(df: DataFrame, segments: str, key: str = "file_path") -> DataFrame:
    """An array of segments from elsewhere under the standard types; null becomes an empty array."""
    empty = F.array().cast(SEGMENTS)
    return df.select(key, F.coalesce(F.col(segments).cast(SEGMENTS), empty).alias("transcription"))


def positions(df: DataFrame, segments: str = "transcription") -> DataFrame:
    """One row per segment with its position in the call."""
    others = [c for c in df.columns if c != segments]
    return df.select(*others, F.posexplode(segments).alias("position", "segment")).select(
        *others, "position", "segment.*"
    )


def merge_rows(rows: DataFrame, key: str, order: str, text: str, into: str = "transcription") -> DataFrame:
    """Texts of a call joined by one space in the stated order."""
    turns = F.array_sort(F.collect_list(F.struct(order, text)))
    return rows.groupBy(key).agg(F.array_join(F.transform(turns, lambda t: t[text]), " ").alias(into))


def with_counts(df: DataFrame, text: str = "transcription", tokenizer=None) -> DataFrame:
    """Adds word_count and token_count."""
    return df.withColumns({
        "word_count": X.word_count(text), "token_count": X.token_count(text, tokenizer)
    })


def chunk(
    df: DataFrame, text: str = "transcription", size: int = 3200, max_tokens: int = 3800, overlap: int = 50
) -> DataFrame:
    """One row per chunk with its number; a text without tokens gives none."""
    others = [c for c in df.columns if c != text]
    return df.select(
        *others, F.posexplode(X.chunks(text, size, max_tokens, overlap)).alias("chunk_no", "chunk")
    )
