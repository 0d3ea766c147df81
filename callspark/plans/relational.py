"""Frequent callers, intent per call, call metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame

from callspark.operators import calls, ivr


def frequent_callers(header: DataFrame, start: str, end: str, *, limit: int | None = None, **options) -> DataFrame:
    """Call header to the calls of repeat callers, all or the first ``limit``; ``options`` go to :func:`calls.agent_calls`."""
    return calls.frequent_callers(calls.agent_calls(header, start, end, **options), limit=limit)


def ivr_intent(
    nlp_result: DataFrame, transfer: DataFrame, audio: DataFrame, start: str, end: str,
    channel: str | None = ivr.VOICE_CHANNEL, ignore_null_question: bool = False,
) -> DataFrame:
    """Three activity logs to one intent row per call."""
    events = ivr.unified_events(
        ivr.in_window(nlp_result, start, end, ts="timeStamp", channel=channel),
        ivr.in_window(transfer, start, end, channel=channel),
        ivr.in_window(audio, start, end, channel=channel),
    )
    return ivr.intent_per_call(ivr.events_before_response(events), ignore_null_question)


def call_metadata(
    segments: DataFrame, ids: DataFrame, since: str, manifest: DataFrame, intent: DataFrame
) -> DataFrame:
    """Segments of the selected tasks with their recording file and the intent of the call."""
    chosen = calls.with_recordings(calls.task_segments(segments, ids, since))
    filed = calls.attach_recordings(chosen, manifest)
    return calls.metadata(filed, intent)
