"""Summaries and agent actions.

The built-in scorer picks sentences by word frequency. It stands where a language model would, and
gives results that can be checked; it does not write what a model would write.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callspark.functions.text import chunks, column, sentences_by_mark

# Gates and sentinels.
MIN_WORDS = 50
MAX_TOKENS = 3900
NO_SUMMARY = "No summary generated"
NO_ACTIONS = "No actions generated"

SUMMARY_SENTENCES = 3
ACTION_WORDS = (
    "check", "checked", "update", "updated", "transfer", "transferred", "schedule", "scheduled",
    "send", "sent", "explain", "explained", "confirm", "confirmed", "credit", "credited", "set",
    "open", "opened", "call", "called", "verify", "verified", "offer", "offered", "process", "processed",
)


def extract_summary(text: str, sentences: int = SUMMARY_SENTENCES, words: int | None = None) -> str:
    """The sentences with the highest summed word frequency, in text order.

    With ``words`` the last of them are left out as long as there are more words than that; no
    sentence is cut, and the first stays.
    """
    parts, ranked = _ranked(text)
    chosen = sorted(ranked[:sentences])
    while words is not None and len(chosen) > 1 and sum(len(parts[i].split()) for i in chosen) > words:
        chosen.pop()
    return _joined(parts, chosen)


def extract_summary_and_main(text: str, sentences: int = SUMMARY_SENTENCES) -> tuple[str, str]:
    """:func:`extract_summary` with ``sentences`` and with one sentence, by one scoring of the text."""
    parts, ranked = _ranked(text)
    return _joined(parts, sorted(ranked[:sentences])), _joined(parts, ranked[:1])


def _ranked(text: str) -> tuple[list[str], list[int]]:
    """The sentences, and their places by falling score."""
    parts = [p for p in re.split(r"[.!?]\s+", text) if p.split()]
    counts = Counter(text.lower().split())
    scores = [-sum(map(counts.__getitem__, p.lower().split())) for p in parts]
    return parts, sorted(range(len(parts)), key=scores.__getitem__)


def _joined(parts: list[str], chosen: list[int]) -> str:
    return " ".join(". ".join(parts[i] for i in chosen).split())


def _scored(
    df: DataFrame, pieces: Column, combine: Callable[[list[str]], str], into: str, otherwise: str | None = None
) -> DataFrame:
    """Adds ``combine`` of an array of texts, in Arrow batches; ``otherwise`` where it is null.

    The texts of one row at a time become Python objects, so a batch of long texts takes its bytes and
    no more. The array is read twice, in the test and by the function, which keeps it a column of its own:
    Spark does not evaluate such an array inside the arguments of a Python function.
    """
    @F.arrow_udf("string")
    def run(arrays: pa.Array) -> pa.Array:
        return pa.array((None if not a.is_valid else combine(a.as_py()) for a in arrays), pa.string())

    staged = df.withColumn("__pieces", pieces)
    result = F.when(F.col("__pieces").isNull(), F.lit(otherwise)).otherwise(run("__pieces"))
    return staged.withColumn(into, result).drop("__pieces")


def summary(
    df: DataFrame, text: str = "transcription", scorer: Callable[[str], str] = extract_summary,
    min_words: int = MIN_WORDS, max_tokens: int = MAX_TOKENS, chunk: tuple[int, int, int] = (3200, 3800, 50),
    into: str = "summary",
) -> DataFrame:
    """Adds a summary; needs word_count and token_count.

    Up to ``min_words`` words give the sentinel. Above ``max_tokens`` tokens every chunk is scored
    and the parts are joined by line breaks. A call stays in its row, so nothing is shuffled.
    """
    pieces = F.when(
        F.col("word_count") > min_words,
        F.when(F.col("token_count") > max_tokens, chunks(text, *chunk)).otherwise(F.array(text)),
    )
    return _scored(df, pieces, lambda parts: "\n".join(scorer(p) for p in parts), into, NO_SUMMARY)


def halves(parts: list[str], budget: int) -> list[str]:
    """Neighbouring parts joined by spaces while under the token budget, splitting at the middle.

    A part that is over the budget alone stays as it is.
    """
    joined = " ".join(parts)
    if len(parts) <= 1 or len(joined.split()) < budget:
        return [joined]
    middle = len(parts) // 2
    return halves(parts[:middle], budget) + halves(parts[middle:], budget)


def tree(
    df: DataFrame, text: str = "transcription", scorer: Callable[[str], str] = extract_summary,
    max_tokens: int = MAX_TOKENS, chunk: tuple[int, int, int] = (3200, 3800, 50), into: str = "summary",
) -> DataFrame:
    """Adds a summary of summaries; needs token_count.

    Below ``max_tokens`` tokens the text is scored once. Otherwise its chunks are scored, as many
    neighbouring results as fit the budget are scored again together, and those parts are joined.
    """
    def combine(parts: list[str]) -> str:
        if len(parts) == 1:
            return scorer(parts[0])
        return " ".join(scorer(p) for p in halves([scorer(p) for p in parts], max_tokens))

    pieces = F.when(F.col("token_count") < max_tokens, F.array(text)).otherwise(chunks(text, *chunk))
    return _scored(df, pieces, combine, into)


def sentences_with(text: Column | str, words: Iterable[str]) -> Column:
    """Sentences that hold one of the words, joined by a full stop and a space."""
    pattern = rf"(?iU)\b(?:{'|'.join(words)})\b"
    return F.array_join(F.filter(sentences_by_mark(column(text)), lambda s: s.rlike(pattern)), ". ")


def actions(
    df: DataFrame, text: str = "transcription", words: Iterable[str] = ACTION_WORDS,
    min_words: int = MIN_WORDS, max_tokens: int | None = None, into: str = "actions_taken",
) -> DataFrame:
    """Adds the sentences that tell of an action; needs word_count and token_count.

    Up to ``min_words`` words or without such a sentence: the sentinel. ``max_tokens`` is for rules
    with a limit of their own: it gives texts from that many tokens on the sentinel as well. See
    :func:`actions_tree` for a scorer that reads long texts in parts.
    """
    found = F.nullif(sentences_with(text, words), F.lit(""))
    gate = F.col("word_count") > min_words
    if max_tokens is not None:
        gate &= F.col("token_count") < max_tokens
    return df.withColumn(into, F.coalesce(F.when(gate, found), F.lit(NO_ACTIONS)))


def extract_actions(text: str, words: Iterable[str] = ACTION_WORDS) -> str:
    """Sentences that hold one of the words, joined by a full stop and a space."""
    pattern = re.compile(rf"\b(?:{'|'.join(words)})\b", re.IGNORECASE)
    return ". ".join(s for s in re.split(r"[.!?] ", text) if pattern.search(s))


def actions_tree(
    df: DataFrame, text: str = "transcription", scorer: Callable[[str], str] = extract_actions,
    max_tokens: int = MAX_TOKENS, chunk: tuple[int, int, int] = (3200, 3800, 50), into: str = "actions_taken",
) -> DataFrame:
    """Adds the actions of texts of any length; needs token_count.

    The twin of :func:`tree`: below ``max_tokens`` tokens the text is read once, otherwise its
    chunks are read, neighbouring results are read again together as they fit, and joined.
    """
    staged = tree(df, text, scorer, max_tokens, chunk, into)
    return staged.withColumn(into, F.coalesce(F.nullif(F.trim(into), F.lit("")), F.lit(NO_ACTIONS)))


def summarize_calls(df: DataFrame, text: str = "transcription") -> DataFrame:
    """Counts, summary and actions of merged transcripts."""
    from callspark.operators.transcripts import with_counts

    return actions(summary(with_counts(df, text), text), text)
