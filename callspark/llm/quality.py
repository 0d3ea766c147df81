"""Quality rules as a bit mask per document.

Every rule is evaluated once and leaves its bit and its measurements in a ledger. Policies are
versioned sets of bits that are applied to the ledger afterwards, and ablations (how many documents
only one rule rejects) are counts over the masks, so neither reads a text again. Everything is built
of column functions; nothing is shuffled but the counts of an ablation.

Null texts have no words. Ledger and verdicts hold one row per input row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callspark.llm.common import SPACED_WORD, UPPER, written

_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Measurements first, then the rules over them; a rule's bit is its place here.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")
RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "repeated_lines": "n_lines >= 4 AND 2 * n_dup_lines > n_lines",
    "word_length": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)",
    "capitals": "n_words > 0 AND 2 * n_capitals > word_chars",
}


def bit(rule: str) -> int:
    """The bit of a rule in the mask."""
    return 1 << list(RULES).index(rule)


@dataclass(frozen=True)
class Policy:
    """A version and the rules it enforces."""

    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(bit(r) for r in self.rules)


BASE = Policy(1, ("few_words", "repeated_windows"))
STRICT = Policy(2, tuple(RULES))


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed a single time, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of ``window`` words found twice or more, the first included.

    Windows are compared by a 64-bit hash. Only a text with a repeated window is looked at closely:
    its windows are sorted by hash, equal neighbours give the places, and the places in order give
    the covered words. No step is worse than sorting.
    """
    n = F.size(words)

    def hashes(hashed: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(hashed) - (window - 1)),
            lambda i: F.xxhash64(*[F.element_at(hashed, (i + j).cast("int")) for j in range(window)]),
        )

    def places(ordered: Column) -> Column:
        # Places of windows whose hash stands beside them as well, in order of place.
        def same(i: Column, j: Column) -> Column:
            return F.get(ordered, i)["h"] == F.get(ordered, j)["h"]

        kept = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)),
        )
        return F.array_sort(F.transform(kept, lambda i: F.get(ordered, i)["i"]))

    def covered(at: Column) -> Column:
        # Each place adds its window, less what the next place covers again.
        return F.aggregate(
            at,
            F.struct(F.lit(0).alias("sum"), F.lit(-window).alias("last")),
            lambda s, p: F.struct((s["sum"] + F.least(F.lit(window), p - s["last"])).alias("sum"), p.alias("last")),
            lambda s: s["sum"],
        )

    def count(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            _once(_once(ordered, places), covered)
        )

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(n < window + 1, F.lit(0)).otherwise(_once(_once(hashed, hashes), count))


def ledger(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its id, all measurements and ``failed``, the mask of the rules it breaks.

    Other columns are left out, whatever their names.
    """
    body = F.coalesce(documents[text], F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.length(F.translate(x, _SPACES, "")) > 0)
    measured = documents.select(
        documents[doc_id].alias("doc_id"),
        F.regexp_extract_all(body, F.lit(SPACED_WORD), F.lit(0)).alias("words"),
        F.length(F.translate(body, _SPACES, "")).cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit(f"[{_SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.regexp_count(body, F.lit(f"[{UPPER}]")).cast("long").alias("n_capitals"),
        _once(lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("different"))).alias("lines"),
    ).select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.col("lines.all") - F.col("lines.different")).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.col("lines.all").cast("long").alias("n_lines"),
        "n_capitals",
    )
    failed = F.lit(0)
    for rule, test in RULES.items():
        failed = failed.bitwiseOR(F.when(F.expr(test), bit(rule)).otherwise(0))
    return measured.select("doc_id", *MEASURES, failed.alias("failed"))


def stored(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The ledger, written once: policies and ablations then read its numbers and no text."""
    return written(ledger(documents, doc_id, text), "ledger")


def verdicts(book: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """The ledger with the policy's version and ``kept``; a document breaks a policy by any of its rules."""
    return book.withColumns({
        "policy": F.lit(policy.version),
        "kept": F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0,
    })


def ablation(book: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """Per rule of a policy: documents that break it, and those that no other rule would reject.

    Masks are counted first, with at most 2^rules groups; the rest works on these counts.
    """
    masks = book.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask)).alias("failed")).agg(F.count(F.lit(1)).alias("rows"))
    names = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).alias("bit")) for r in policy.rules])
    each = masks.select("failed", "rows", F.explode(names).alias("r"))
    broken = F.col("failed").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(broken, F.col("rows")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("failed") == F.col("r.bit"), F.col("rows")).otherwise(0)).alias("n_only"),
    )
