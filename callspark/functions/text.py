"""Tokens, sentences, chunks, prompts: expressions over one text."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words and single punctuation marks, which approximates a treebank word tokenizer (it does not
#: split clitics such as "n't").
WORD = r"(?U)\w+|[^\w\s]"

# The separator of an instruction text is a backslash followed by the letter n.
INSTRUCTION_SEPARATOR = "\\n"


def column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_count(text: Column | str) -> Column:
    """Words and punctuation marks."""
    return F.regexp_count(column(text), F.lit(WORD))


def tokens(text: Column | str) -> Column:
    """Whitespace-separated tokens; an empty text has none."""
    return F.regexp_extract_all(column(text), F.lit(r"(?U)\S+"), F.lit(0))


def token_count(text: Column | str, tokenizer: Callable[[Column], Column] | None = None) -> Column:
    """Number of tokens: whitespace tokens, or whatever ``tokenizer`` (such as a pandas UDF) returns."""
    return tokenizer(column(text)) if tokenizer else F.regexp_count(column(text), F.lit(r"(?U)\S+"))


def merge_segments(segments: Column | str, field: str = "text") -> Column:
    """Texts of an array of segments, joined by one space in the order of the array."""
    return F.array_join(F.transform(segments, lambda s: s[field]), " ")


def sentences_by_stop(text: Column | str, min_words: int = 5) -> Column:
    """Parts between full stops that have at least ``min_words`` words."""
    parts = F.split(column(text), r"\.")
    return F.filter(parts, lambda s: token_count(s) >= min_words)


def sentences_by_mark(text: Column | str) -> Column:
    """Parts between a full stop, exclamation or question mark that is followed by a space."""
    return F.split(column(text), "[.!?] ")


def chunks(text: Column | str, size: int = 3200, max_tokens: int = 3800, overlap: int = 50) -> Column:
    """Chunks of ``size`` tokens, each going on for ``overlap`` tokens while more follow them.

    A chunk starts at every multiple of ``size`` and has at most ``max_tokens``, which may not be
    less than ``size``: tokens would be in no chunk.
    """
    if max_tokens < size:
        raise ValueError(f"chunks of {size} tokens do not fit {max_tokens}")

    def cut(words: Column) -> Column:
        n = F.size(words)

        def chunk(start: Column) -> Column:
            end = start + F.lit(size)
            end = F.least(end + F.when(end + overlap < n, overlap).otherwise(0), n, start + max_tokens)
            return F.array_join(F.slice(words, start + 1, end - start), " ")

        starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(size))).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(starts, chunk)

    return let(tokens(text), cut)


def render(template: str, **columns: Column | str) -> Column:
    """A ``{name}`` template filled from columns; a null value leaves its place empty."""
    parts: list[Column] = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(F.coalesce(column(columns[name]).cast("string"), F.lit("")))
    return F.concat(*parts)


def instruction_text(
    instruction: Column | str, context: Column | str, response: Column | str,
    separator: str = INSTRUCTION_SEPARATOR,
) -> Column:
    """One training text per row of instruction, context and response."""
    template = separator.join(["Instruction: {instruction}", "Context: {context}", "Response: {response}"])
    return render(template, instruction=instruction, context=context, response=response)
