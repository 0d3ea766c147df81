"""Error rates and overlap of two texts; the first is the reference, the second the hypothesis."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from callspark.functions.text import column, let, tokens

BLEU_ORDERS = 4
_SURROGATES = 0xD800


def levenshtein(reference: Column | str, hypothesis: Column | str) -> Column:
    """Character edits between the texts."""
    return F.levenshtein(column(reference), column(hypothesis))


def cer(reference: Column | str, hypothesis: Column | str) -> Column:
    """Character edits per character of the reference; null for an empty reference."""
    return levenshtein(reference, hypothesis) / F.nullif(F.length(column(reference)), F.lit(0))


def _over_runs(ordered: Column, value: Callable[[Column], Column], make: Callable) -> Column:
    """``make(place, first place of the run, number of the run)`` for every place of a sorted array.

    A run is a stretch of places with the same ``value``. The work grows with the array and not
    with its square, as looking every element up in the array would.
    """
    def runs(first: Column) -> Column:
        def run(start: Column, k: Column) -> Column:
            last = F.coalesce(F.get(first, k + 1), F.size(ordered)) - 1
            return F.transform(F.sequence(start, last), lambda i: make(i, start, k))

        return F.flatten(F.transform(first, run))

    firsts = F.filter(
        F.sequence(F.lit(0), F.size(ordered) - 1),
        lambda i: (i == 0) | (value(F.get(ordered, i)) != value(F.get(ordered, i - 1))),
    )
    return F.when(F.size(ordered) > 0, let(firsts, runs))


def _as_characters(words: Column) -> Column:
    """Each word as one character, the same for equal words: its rank is the code point."""
    def character(rank: Column) -> Column:
        point = F.when(rank < _SURROGATES - 1, rank + 1).when(rank + 0x801 <= 0x10FFFF, rank + 0x801).otherwise(
            F.raise_error(F.lit("a pair of texts has more distinct words than there are characters")).cast("int")
        )
        return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")

    def ranked(ordered: Column) -> Column:
        ranks = _over_runs(
            ordered, lambda t: t["w"], lambda i, _, k: F.struct(F.get(ordered, i)["i"].alias("i"), k.alias("k"))
        )
        return F.transform(F.array_sort(ranks), lambda r: character(r["k"]))

    tagged = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    return let(F.array_sort(tagged), ranked)


def word_edits(reference: Column | str, hypothesis: Column | str) -> Column:
    """Word edits between the texts.

    Words become characters, so that the built-in character distance counts words. There are
    1,112,063 characters; a pair with more distinct words is an error, not a wrong number.
    """
    sides = F.struct(tokens(reference).alias("r"), tokens(hypothesis).alias("h"))

    def distance(s: Column) -> Column:
        n, m = F.size(s["r"]), F.size(s["h"])
        edits = let(_as_characters(F.concat(s["r"], s["h"])), lambda c: F.levenshtein(
            F.array_join(F.slice(c, F.lit(1), n), ""), F.array_join(F.slice(c, n + 1, m), "")
        ))
        return F.when((n == 0) | (m == 0), F.greatest(n, m)).otherwise(edits)

    return let(sides, distance)


def wer(reference: Column | str, hypothesis: Column | str) -> Column:
    """Word edits per word of the reference; null for an empty reference."""
    return word_edits(reference, hypothesis) / F.nullif(F.size(tokens(reference)), F.lit(0))


def common_tokens(a: Column | str, b: Column | str) -> Column:
    """Distinct tokens found in both texts."""
    return F.array_intersect(tokens(a), tokens(b))


def _share(common: Column, of: Column) -> Column:
    distinct = F.size(F.array_distinct(of))
    return F.when(distinct > 0, F.size(common) / distinct).otherwise(F.lit(0.0))


def precision(reference: Column | str, hypothesis: Column | str) -> Column:
    """Share of the distinct tokens of the first text that the second has."""
    return _share(common_tokens(reference, hypothesis), tokens(reference))


def recall(reference: Column | str, hypothesis: Column | str) -> Column:
    """Share of the distinct tokens of the second text that the first has."""
    return _share(common_tokens(reference, hypothesis), tokens(hypothesis))


def f1(precision_: Column | str, recall_: Column | str) -> Column:
    """Harmonic mean; null where both are zero."""
    p, r = column(precision_), column(recall_)
    return 2 * p * r / F.nullif(p + r, F.lit(0.0))


def _ngrams(words: Column, n: int) -> Column:
    count = F.size(words) - (n - 1)
    grams = F.transform(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.array_join(F.slice(words, i, n), " ")
    )
    return F.when(count > 0, grams).otherwise(F.array().cast("array<string>"))


def _numbered(grams: Column) -> Column:
    """Each n-gram with the number of its occurrence, so that a set intersection counts repeats."""
    numbered = let(F.array_sort(grams), lambda g: _over_runs(
        g, lambda x: x, lambda i, start, _: F.concat(F.get(g, i), F.lit(" "), i - start)
    ))
    return F.coalesce(numbered, F.array().cast("array<string>"))


def bleu_score(hits: Sequence[Column], reference: Column, hypothesis: Column) -> Column:
    """Sentence BLEU from the common n-grams of each order, from 1 on, and the words of both texts."""
    logs = F.lit(0.0)
    for n, common in enumerate(hits):
        logs = logs + _log_precision(common, hypothesis - n)
    brevity = F.when(hypothesis > reference, F.lit(1.0)).otherwise(F.exp(1 - reference / hypothesis))
    return let(logs, lambda l: F.when(l.isNotNull(), brevity * F.exp(l / BLEU_ORDERS)).otherwise(F.lit(0.0)))


def bleu(reference: Column | str, hypothesis: Column | str) -> Column:
    """Sentence BLEU over n-grams of 1 to 4 words, unsmoothed; 0 if an order has no match."""
    def score(s: Column) -> Column:
        r, h = s["r"], s["h"]
        hits = [
            F.size(F.array_intersect(_numbered(_ngrams(h, n)), _numbered(_ngrams(r, n)))) for n in range(1, BLEU_ORDERS + 1)
        ]
        return bleu_score(hits, F.size(r), F.size(h))

    return let(F.struct(tokens(reference).alias("r"), tokens(hypothesis).alias("h")), score)


def _log_precision(hits: Column, possible: Column) -> Column:
    return let(hits, lambda c: F.when(c > 0, F.log(c / possible)))
