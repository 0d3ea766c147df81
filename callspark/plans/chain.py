"""Report assembly and the whole chain from transcripts to the reporting table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from callspark.functions import redaction as R
from callspark.functions.text import merge_segments
from callspark.operators import insights, report, sentiment, summarize, topics
from callspark.sources.stages import Stages, fingerprint

STAGES = ("redacted", "summary", "topics", "sentiment", "insights")


def reporting_table(stages: dict[str, DataFrame], metadata: DataFrame, master: DataFrame) -> DataFrame:
    """Stage outputs, metadata and accounts as the typed report."""
    return report.conform(report.assemble(stages, metadata, master))


def run_all(
    spark: SparkSession, transcripts: DataFrame, metadata: DataFrame, master: DataFrame,
    taxonomy: DataFrame, folder: str, threshold: float = topics.THRESHOLD, resume: bool = True,
) -> DataFrame:
    """Transcripts to the reporting table; every stage is written below ``folder`` and read back.

    Written stages cut the lineage, so a lost executor costs the tasks of one stage, and they are
    versions with a commit: a run that ended goes on behind its last committed stage when it is started
    again over the same inputs. ``resume=False`` makes all stages anew. A call that a stage lacks is
    in no row of the report. ``folder`` has to be shared by all executors.
    """
    stages = Stages(spark, folder)
    base = fingerprint(transcripts)
    topical = fingerprint(base, taxonomy, threshold)

    def stage(name: str, made_from: str, make: Callable[[], DataFrame]) -> DataFrame:
        return stages.run(name, made_from, make) if resume else stages.read(name, stages.write(name, make(), made_from))

    redacted = stage("redacted", base, lambda: transcripts.select(
        "file_path", "transcription", R.redact_segments("transcription").alias("redacted")
    ))
    merged = redacted.select("file_path", merge_segments("redacted").alias("transcription"))
    summary = stage("summary", base, lambda: summarize.summarize_calls(merged))
    topic = stage("topics", topical, lambda: topics.assign_topics(
        summary.select("file_path", "summary"), taxonomy, threshold
    ).select("file_path", "topics"))
    stage("sentiment", base, lambda: sentiment.segments(redacted.select("file_path", "redacted"), "redacted"))
    found = stage("insights", base, lambda: insights.extract(merged).select("file_path", *[f"`{f}`" for f in insights.FIELDS]))
    outputs = {
        "summary": summary.select("file_path", "transcription", "summary"), "topics": topic, "insights": found,
    }
    return reporting_table(outputs, metadata, master)
