"""Comparison of two transcription runs."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from math import isqrt

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callspark.functions import textmetrics as M
from callspark.operators.evaluate import describe, histogram
from callspark.session import written

METRICS = ("WER", "CER", "Levenshtein", "Precision", "Recall", "F1_Score", "BLEU")
REFERENCE, HYPOTHESIS = "transcription_medium", "transcription_large"

#: Characters from which on a pair is first looked at along its diagonals, and the share of them that may be
#: edits there: so many diagonals cost a fraction of the product of both lengths.
LONG, SHARE = 5_000, 0.03


def pair_runs(
    first: DataFrame, second: DataFrame, key: str = "file", suffixes: tuple[str, str] = ("_medium", "_large")
) -> DataFrame:
    """The two runs side by side; every column but the key gets the suffix of its run."""
    left, right = (
        run.withColumnsRenamed({c: c + suffix for c in run.columns if c != key})
        for run, suffix in zip((first, second), suffixes)
    )
    return left.join(right, key)


def _equal_ahead(a: str, b: str, i: int, j: int) -> int:
    """How many characters from the places on are equal, in steps that double and then halve."""
    most, done, step = min(len(a) - i, len(b) - j), 0, 8
    while done + step <= most and a[i + done:i + done + step] == b[j + done:j + done + step]:
        done, step = done + step, 2 * step
    while step > 1:
        step //= 2
        if done + step <= most and a[i + done:i + done + step] == b[j + done:j + done + step]:
            done += step
    return done


def edits_within(a: str, b: str, most: int) -> int | None:
    """Character edits between two texts if they are at most ``most``, else none.

    For every number of edits, how far each diagonal gets with it. The band of diagonals that can still
    end in time doubles until the distance fits, so the work grows with the edits, not with the product
    of the lengths.
    """
    if abs(len(a) - len(b)) > most:
        return None
    bound = max(16, abs(len(a) - len(b)))
    while True:
        found = _edits_in_band(a, b, min(bound, most))
        if found is not None or bound >= most:
            return found
        bound *= 2


def _edits_in_band(a: str, b: str, most: int) -> int | None:
    end = len(b) - len(a)
    reach = {0: _equal_ahead(a, b, 0, 0)}  # by diagonal (place in b less place in a): the place in a
    for edits in range(most + 1):
        if reach.get(end, -1) >= len(a):
            return edits
        left = most - edits - 1
        further = {}
        for k in range(max(-edits - 1, end - left), min(edits + 1, end + left) + 1):
            i = max(reach.get(k, -2) + 1, reach.get(k - 1, -2), reach.get(k + 1, -2) + 1)
            i = min(i, len(a), len(b) - k)
            if i >= 0 and i + k >= 0:
                further[k] = i + _equal_ahead(a, b, i, i + k)
        reach = further
    return None


def edits_between(a: Sequence, b: Sequence) -> int:
    """Edits between two texts, or two lists of words, however different they are.

    One column of the table at a time, as two integers: bits for the places where it rises and where it
    falls (Myers, Hyyrö). The shorter side gives the columns.
    """
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    places: dict = {}
    bit = 1
    for x in a:
        places[x] = places.get(x, 0) | bit
        bit <<= 1
    whole = bit - 1
    rises, falls = whole, 0
    for y in b:
        equal = places.get(y, 0)
        across = (((equal & rises) + rises) ^ rises) | equal
        equal |= falls
        up = falls | ~(across | rises)
        up = up << 1 | 1
        rises, falls = ((rises & across) << 1 | ~(equal | up)) & whole, up & equal
    return len(b) + rises.bit_count() - falls.bit_count()


def _character_edits(a: str | None, b: str | None, long: int) -> int | None:
    if a is None or b is None:
        return None
    size = max(len(a), len(b))
    if size >= long and abs(len(a) - len(b)) <= SHARE * size:
        # More edits than this take longer along the diagonals than column by column.
        near = edits_within(a, b, min(int(SHARE * size), max(16, isqrt(size) // 2)))
        if near is not None:
            return near
    return edits_between(a, b)


def _edits(long: int):
    @F.pandas_udf(T.IntegerType())
    def edits(reference: pd.Series, hypothesis: pd.Series) -> pd.Series:
        found = [_character_edits(a, b, long) for a, b in zip(reference, hypothesis, strict=True)]
        return pd.Series(found, index=reference.index, dtype="Int32")

    return edits


def levenshtein(pairs: DataFrame, reference: str = REFERENCE, hypothesis: str = HYPOTHESIS, into: str = "Levenshtein", long: int = LONG) -> DataFrame:
    """Adds the character edits between two texts of any length.

    Pairs from ``long`` characters on with few edits, such as two runs over one call, are settled along their
    diagonals: two texts of 200,000 characters with ten edits take milliseconds. All others go
    column by column, many rows at a time.
    """
    return pairs.withColumn(into, _edits(long)(reference, hypothesis))


def character_error_rate(edits: Column | str, reference: Column | str = REFERENCE) -> Column:
    """Edits per character of the reference; null for an empty reference."""
    edits, reference = (F.col(c) if isinstance(c, str) else c for c in (edits, reference))
    return edits / F.nullif(F.length(reference), F.lit(0))


def with_metrics(pairs: DataFrame, reference: str = REFERENCE, hypothesis: str = HYPOTHESIS, long: int | None = None) -> DataFrame:
    """Adds the seven metrics; each is computed from its own row, without a shuffle.

    The distances cost the product of both lengths: deal few pairs over the cores with
    :func:`callspark.session.spread` first. For texts of whole calls give ``long``, such as ``LONG``: pairs from
    that length on take the character distance of :func:`levenshtein`, which runs in Python.
    """
    sides = (reference, hypothesis)
    # The character distance is the dear part: one column, which the error rate is taken from.
    staged = pairs.withColumn("Levenshtein", M.levenshtein(*sides)) if long is None else levenshtein(pairs, *sides, long=long)
    measured = staged.withColumns({
        "WER": M.wer(*sides), "Precision": M.precision(*sides), "Recall": M.recall(*sides), "BLEU": M.bleu(*sides),
    })
    return measured.withColumns({
        "CER": character_error_rate("Levenshtein", reference), "F1_Score": M.f1("Precision", "Recall"),
    })


#: A token as Java's Unicode rules have it; Python's own white space takes in four separators more.
_TOKEN = re.compile("[^\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")

_COUNTS = "edits int, words int, r int, h int, common int, dr int, dh int, hits array<int>"


def _counted(a: str, b: str, long: int) -> tuple:
    """What :data:`_COUNTS` names: character and word edits, words, distinct words, common n-grams of each order."""
    r, h = _TOKEN.findall(a), _TOKEN.findall(b)
    dr, dh = set(r), set(h)
    hits = []
    for n in range(1, M.BLEU_ORDERS + 1):
        grams = [Counter(zip(*(words[i:] for i in range(n)))) for words in (r, h)]
        hits.append(sum(min(c, grams[1][g]) for g, c in grams[0].items() if g in grams[1]))
    return _character_edits(a, b, long), edits_between(r, h), len(r), len(h), len(dr & dh), len(dr), len(dh), hits


def measured(pairs: DataFrame, reference: str = REFERENCE, hypothesis: str = HYPOTHESIS, long: int = LONG) -> DataFrame:
    """:func:`with_metrics` for many pairs: the same seven columns in a fraction of the time.

    All whole numbers are counted in Arrow batches, and the same formulas make shares of them. A pair with a
    null text takes the built-in functions.
    """
    sides = (reference, hypothesis)

    @F.pandas_udf(_COUNTS)
    def count(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        empty = (None,) * 8
        rows = [empty if x is None or y is None else _counted(x, y, long) for x, y in zip(a, b, strict=True)]
        found = pd.DataFrame(rows, columns=[c.split()[0] for c in _COUNTS.split(", ")], index=a.index)
        return found.astype({c: "Int32" for c in found.columns[:-1]})

    def c(name: str) -> Column:
        return F.col(f"__counts.{name}")

    def share(of: str) -> Column:
        return F.when(c(of) > 0, c("common") / c(of)).when(c(of) == 0, F.lit(0.0))

    bleu = F.when(c("hits").isNotNull(), M.bleu_score([c("hits")[i] for i in range(M.BLEU_ORDERS)], c("r"), c("h")))
    return pairs.withColumn("__counts", count(*sides)).withColumns({
        "Levenshtein": F.coalesce(c("edits"), M.levenshtein(*sides)),
        "WER": F.coalesce(c("words") / F.nullif(c("r"), F.lit(0)), M.wer(*sides)),
        "Precision": F.coalesce(share("dr"), M.precision(*sides)), "Recall": F.coalesce(share("dh"), M.recall(*sides)),
        "BLEU": F.coalesce(bleu, M.bleu(*sides)),
    }).withColumns({
        "CER": character_error_rate("Levenshtein", reference), "F1_Score": M.f1("Precision", "Recall"),
    }).drop("__counts")


def sample(metrics: DataFrame, order: str = "file", n: int = 5) -> DataFrame:
    """The first rows of the report: both texts and their BLEU."""
    return metrics.orderBy(order).limit(n).select(REFERENCE, HYPOTHESIS, "BLEU")


def levenshtein_histogram(metrics: DataFrame, bins: int = 30) -> DataFrame:
    """Histogram of the character distance, which is computed once and written before it is counted."""
    return histogram(written(metrics.select("Levenshtein")), "Levenshtein", bins)


def report(metrics: DataFrame) -> DataFrame:
    """Mean, median and standard deviation of every metric, with the quartiles and the range.

    The statistics take several scans, so the numbers are written first.
    """
    numbers = metrics.select(*[F.col(m).cast("double").alias(m) for m in METRICS])
    return describe(written(numbers), METRICS)
