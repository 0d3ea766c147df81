"""Personal-data patterns and the expressions that replace them.

Patterns follow Unicode rules for ``\\w``, ``\\d``, ``\\s`` and ``\\b`` and ignore case.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from callspark.functions.text import column, let


@dataclass(frozen=True)
class Recognizer:
    """A pattern for one kind of personal data.

    ``gate`` is a cheap pattern without which ``regex`` cannot match; texts that lack it skip the
    expensive one. ``trigger`` is such a pattern over the :func:`digest` of a text, which one scan
    makes for all recognizers. ``linear`` has the same matches in a form for Java that neither
    recurses nor tries the same characters again and again on long runs; if it ``leads``, its first
    group is what stands before the match, and the second is the match. ``python`` has the same
    matches in a form that Python tries at fewer places: it looks at the first character before the
    boundary in front of it.
    """

    entity: str
    regex: str
    score: float
    gate: str = r"\p{Nd}"
    trigger: str | None = None
    linear: str | None = None
    leads: bool = False
    python: str | None = None

    @property
    def java(self) -> str:
        return f"(?iU){self.linear or self.regex}"

    @property
    def group(self) -> int:
        return 2 if self.leads else 0

    @property
    def replacement(self) -> str:
        return f"$1{tag(self)}" if self.leads else tag(self)


# Entities, patterns and scores.
RECOGNIZERS = (
    Recognizer("TITLE", r"\b(?:Mr\.|Mrs\.|Miss\b)", 1.0, "(?i)m[ri]", python=r"(?=M)\b(?:Mr\.|Mrs\.|Miss\b)"),
    Recognizer("PHONE_NUMBER", r"\(?\b\d{3}\)?[-.]?\s?\d{3}[-.]?\s?\d{4}\b", 0.5, trigger=r"\p{Nd}{3}[- ]{0,3}\p{Nd}{3}[- ]{0,2}\p{Nd}{4}",
        python=r"[(\d](?:(?<=\()\b\d{3}|(?<!\w\d)(?<=\d)\d{2})\)?[-.]?\s?\d{3}[-.]?\s?\d{4}\b"),
    Recognizer(
        "EMAIL_ADDRESS",
        r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
        0.5,
        "@",
        "@",
        # An address has to begin at the first word boundary of its run of characters: from there to
        # the "@" all are taken, so if that start fails, so do all later ones. A run begins behind
        # any other character or where the last match ended, and is looked at once.
        r"(?:\G|(?<![A-Za-z0-9._%+-]))((?>\b|[.%+-]++\b|[A-Za-z0-9_]++\b))"
        r"([A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b)",
        leads=True,
    ),
    Recognizer("ACCOUNT_NUMBER", r"\b\d{8,12}\b", 0.5, trigger=r"\p{Nd}{8}", python=r"\d(?<!\w\d)\d{7,11}\b"),
    Recognizer(
        "DATE",
        r"\b(?:\d{1,2}[-/]\d{1,2}[-/]\d{2,4}|\d{2,4}[-/]\d{1,2}[-/]\d{1,2}"
        r"|\b(?:January|February|March|April|May|June|July|August|September|October|November|December)"
        r"\b\s\d{1,2},?\s\d{4})\b",
        0.5,
        trigger=r"\p{Nd}[-/]\p{Nd}| \p{Nd}{1,2} \p{Nd}{4}",
        python=r"(?=[\dJFMASOND])(?<![0-9A-Za-z])\b(?:\d{1,2}[-/]\d{1,2}[-/]\d{2,4}|\d{2,4}[-/]\d{1,2}[-/]\d{1,2}"
        r"|(?:January|February|March|April|May|June|July|August|September|October|November|December)"
        r"\b\s\d{1,2},?\s\d{4})\b",
    ),
    Recognizer(
        "ADDRESS",
        r"\b\d{1,5}\s([a-zA-Z\s]{1,})\b,?\s([a-zA-Z\s]{1,}),?\s([A-Z]{2}),?\s\d{5}\b",
        0.85,
        trigger=r"\p{Nd} \p{Nd}{5}",
        # The look-ahead asks for letters, spaces and at most three commas up to five digits, before
        # all ways to cut a long run of words are tried.
        linear=r"\b\d{1,5}\s(?=(?:[a-zA-Z\s]++,?+){1,4}+\d{5}\b)"
        r"([a-zA-Z\s]{1,})\b,?\s([a-zA-Z\s]{1,}),?\s([A-Z]{2}),?\s\d{5}\b",
        python=r"\d(?<!\w\d)\d{0,4}\s(?=(?:[a-zA-Z\s]++,?+){1,4}+\d{5}\b)"
        r"([a-zA-Z\s]{1,})\b,?\s([a-zA-Z\s]{1,}),?\s([A-Z]{2}),?\s\d{5}\b",
    ),
    Recognizer("US_SSN", r"\b\d{3}-\d{2}-\d{4}\b", 0.85, trigger=r"\p{Nd}{3}-\p{Nd}{2}-\p{Nd}{4}", python=r"\d(?<!\w\d)\d{2}-\d{2}-\d{4}\b"),
    Recognizer("US_SSN_LAST4", r"\b\d{4}\b", 0.85, trigger=r"\p{Nd}{4}", python=r"\d(?<!\w\d)\d{3}\b"),
    Recognizer("DOLLAR_AMOUNT", r"\$\s?\d+(?:,\d{3})*(?:\.\d{2})?", 0.6, trigger=r"\$ ?\p{Nd}"),
    Recognizer("BILL_AMOUNT", r"\b(?:payment|bill|amount)\s?of\s?\$\s?\d+(?:,\d{3})*(?:\.\d{2})?", 0.6, trigger=r"\$ ?\p{Nd}",
        python=r"(?=[pba])(?<![0-9A-Za-z])\b(?:payment|bill|amount)\s?of\s?\$\s?\d+(?:,\d{3})*(?:\.\d{2})?"),
    Recognizer(
        "CONFIRMATION_NUMBER",
        r"confirmation\snumber\s(?:is\s)?((?:\d+|\w+)(?:,\s?(?:\d+|\w+))*)",
        0.9,
        "(?i)confirmation",
        # Items of different lengths in a plain repeated group would be matched by recursion.
        linear=r"confirmation\snumber\s(?:is\s)?((?:\d++|\w++)(?:,\s?+(?:\d++|\w++))*+)",
    ),
    Recognizer("PASSPORT", r"\b[A-Z]{1,2}\d{7,8}\b", 0.85, trigger=r"\p{Nd}{7}"),
    Recognizer("DRIVERS_LICENSE", r"\b[A-Z]{2}\d{7,8}\b|\bDL\s?\d{8,12}\b", 0.85, trigger=r"\p{Nd}{7}"),
    Recognizer("TAX_ID", r"\bITIN\s?\d{9}\b|\bEIN\s?\d{9}\b", 0.85, trigger=r"\p{Nd}{9}"),
)

# Tag of an entity whose name differs from it.
TAGS = {"US_SSN_LAST4": "US_SSN"}

#: Order of replacement: patterns that take in more text come before those found inside them, and
#: the four-digit rule, which is found inside most numbers, comes last.
PRIORITY = (
    "URL", "EMAIL_ADDRESS", "ADDRESS", "CONFIRMATION_NUMBER", "BILL_AMOUNT", "DOLLAR_AMOUNT", "CREDIT_CARD",
    "PHONE_NUMBER", "US_SSN", "DATE", "IP_ADDRESS", "IBAN_CODE", "DRIVERS_LICENSE", "TAX_ID", "PASSPORT",
    "ACCOUNT_NUMBER", "TITLE", "US_SSN_LAST4",
)

#: Card numbers, IP addresses, bank accounts and links, off unless asked for.
COMMON_RECOGNIZERS = (
    Recognizer("CREDIT_CARD", r"\b\d{4}[- ]?\d{4}[- ]?\d{4}[- ]?\d{4}\b", 0.7, trigger=r"\p{Nd}{4}[- ]?\p{Nd}{4}"),
    Recognizer("IP_ADDRESS", r"\b(?:\d{1,3}\.){3}\d{1,3}\b", 0.7, trigger=r"\p{Nd} \p{Nd}{1,3} \p{Nd}{1,3} \p{Nd}"),
    Recognizer("IBAN_CODE", r"\b[A-Z]{2}\d{2}[A-Z0-9]{11,30}\b", 0.7),
    Recognizer("URL", r"\bhttps?://[^\s<>\"]+", 0.7, "(?i)http"),
)

# What the sequence rules put in place of a match, and the number words they hide.
JOINED_MARK = "***"
NUMBER_MARK = "[REDACTED]"
NUMBER_WORDS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "zero")

# Fixed values as well; written with possessive groups, which Java matches without recursion and
# without trying the same characters again.
#: Word characters at both ends and a joining character inside.
JOINED = r"(?U)\b(?:\w++(?:[.*\-]++\w++)++|\w+_\w+)"
DIGITS = r"(?U)\b\d+\b"
#: Each group of four digits is followed by four more, so that a last group is left.
ACCOUNT = r"(?U)\b(?:\d{4}[-\s]?(?=\d{4})){2,}+"

_NUMBER = f"(?:{'|'.join(NUMBER_WORDS)})++\\b"
#: Runs of number words; space before a following word goes with them. Possessive throughout, as
#: Java would match a plain repeated group by recursion.
SPOKEN_NUMBER = rf"(?iU)\b{_NUMBER}(?:\s*+{_NUMBER})*+(?:\s+(?=\w))?"


def tag(recognizer: Recognizer) -> str:
    return f"<{TAGS.get(recognizer.entity, recognizer.entity)}>"


def without(*entities: str, recognizers: Sequence[Recognizer] = RECOGNIZERS) -> tuple[Recognizer, ...]:
    """The recognizers less some; the four-digit rule, say, also takes years."""
    return tuple(r for r in recognizers if r.entity not in entities)


def from_config(config: dict) -> tuple[Recognizer, ...]:
    """Recognizers from a ``pattern_recognizers`` object: one or several name/regex/score each.

    A list of patterns under one key gives several recognizers with the tag of that key.
    """
    found = []
    for key, entry in config["pattern_recognizers"].items():
        entries = entry if isinstance(entry, list) else [entry]
        found += [Recognizer(key.upper(), e["regex"], float(e["score"]), gate="") for e in entries]
    return tuple(found)


def in_order(recognizers: Sequence[Recognizer]) -> list[Recognizer]:
    """Recognizers by :data:`PRIORITY`; those it does not name come first, as they are given."""
    return sorted(recognizers, key=lambda r: PRIORITY.index(r.entity) if r.entity in PRIORITY else -1)


#: What the triggers look at; every run of other characters becomes one space.
_BETWEEN = r"[^\p{Nd}@$/\-]++"


def digest(text: Column | str) -> Column:
    """A text without all that no trigger asks for: its digits, and the marks between them."""
    return F.regexp_replace(column(text), _BETWEEN, " ")


def _open(recognizer: Recognizer, text: Column, digested: Column | None) -> Column | None:
    """Whether a recognizer can match at all; none if that can't be told."""
    if recognizer.trigger and digested is not None:
        return digested.contains(recognizer.trigger) if recognizer.trigger == "@" else digested.rlike(recognizer.trigger)
    return text.rlike(recognizer.gate) if recognizer.gate else None


def matches(text: Column | str, recognizer: Recognizer, digested: Column | None = None) -> Column:
    """All matches of one recognizer, in the order of the text; ``digested`` is the text's digest, if it is at hand."""
    text = column(text)
    found = F.regexp_extract_all(text, F.lit(recognizer.java), F.lit(recognizer.group))
    able = _open(recognizer, text, digested)
    return found if able is None else F.when(able, found).otherwise(F.array().cast("array<string>"))


def match_count(text: Column | str, recognizer: Recognizer, digested: Column | None = None) -> Column:
    """Number of matches of one recognizer."""
    text = column(text)
    found = F.regexp_count(text, F.lit(recognizer.java))
    able = _open(recognizer, text, digested)
    return found if able is None else F.when(able, found).otherwise(0)


def replace_all(text: Column | str, recognizers: Sequence[Recognizer] = RECOGNIZERS) -> Column:
    """Each match replaced by its tag, recognizer by recognizer in the order of :data:`PRIORITY`.

    This is the fast path: it stays in the JVM, and where patterns overlap the earlier one wins. What
    a recognizer needs is looked up in the digest of the text as it came; tags bring nothing a
    trigger asks for.
    :func:`callspark.operators.redact.anonymize` settles overlaps by span instead.
    """
    def chain(digested: Column) -> Column:
        result = column(text)
        for r in in_order(recognizers):
            result = _changed(result, r, _open(r, column(text), digested))
        return result

    return let(digest(text), chain)


def _changed(text: Column, recognizer: Recognizer, able: Column | None) -> Column:
    def change(t: Column) -> Column:
        return F.regexp_replace(t, recognizer.java, recognizer.replacement)

    return change(text) if able is None else let(text, lambda t: F.when(able, change(t)).otherwise(t))


def replace_joined(text: Column | str) -> Column:
    """Tokens joined by dots, stars, hyphens or underscores."""
    return F.regexp_replace(column(text), JOINED, JOINED_MARK)


def replace_digits(text: Column | str) -> Column:
    """Whole numbers standing alone."""
    return F.regexp_replace(column(text), DIGITS, NUMBER_MARK)


def mask_long_numbers(text: Column | str) -> Column:
    """Groups of four digits before a last group: X for every digit but those of the last four characters."""
    def masked(match: Column) -> Column:
        head = F.length(match) - 4
        return F.concat(
            F.regexp_replace(F.substring(match, F.lit(1), head), r"(?U)\d", "X"),
            F.substring(match, head + 1, F.lit(4)),
        )

    def rebuilt(t: Column) -> Column:
        parts = F.zip_with(
            F.split(t, ACCOUNT),
            F.regexp_extract_all(t, F.lit(ACCOUNT), F.lit(0)),
            lambda gap, match: F.concat(gap, F.coalesce(masked(match), F.lit(""))),
        )
        return F.when(t.rlike(ACCOUNT), F.array_join(parts, "")).otherwise(t)

    return let(column(text), rebuilt)


def replace_spoken_numbers(text: Column | str) -> Column:
    """Runs of number words."""
    return F.regexp_replace(column(text), SPOKEN_NUMBER, NUMBER_MARK)


def sequence_rules(text: Column | str) -> Column:
    """Joined tokens, numbers, long numbers, number words, in this order.

    The joined-token rule is not run a second time after the numbers: its first run leaves no
    token it could match.
    """
    return replace_spoken_numbers(mask_long_numbers(replace_digits(replace_joined(text))))


def mask_account(account: Column | str, keep: int = 4) -> Column:
    """An account number with X for all digits but the last ``keep``."""
    return F.regexp_replace(column(account), rf"\d(?=(?:\D*\d){{{keep}}})", "X")


def mask_words(text: Column | str, words: Column | str) -> Column:
    """Whole-word occurrences of the listed words, each replaced by as many stars as it is long."""
    def mask(t: Column, word: Column) -> Column:
        literal = F.concat(F.lit("(?U)\\b\\Q"), F.replace(word, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E\\b"))
        return F.regexp_replace(t, literal, F.repeat(F.lit("*"), F.length(word)))

    return F.when(F.size(words) > 0, F.aggregate(words, column(text), mask)).otherwise(column(text))


_WORD = r"(?U)\w+"


def words(text: Column | str) -> Column:
    """The words of a text in their order, with repeats."""
    return F.regexp_extract_all(column(text), F.lit(_WORD), F.lit(0))


def mask_flagged(text: Column | str, own: Column | str, flags: Column | str) -> Column:
    """A text with stars for those of its :func:`words` whose flag is set; the work does not grow with the number of names."""
    shown = F.zip_with(own, flags, lambda w, hit: F.when(hit, F.repeat(F.lit("*"), F.length(w))).otherwise(w))
    gaps = F.split(column(text), _WORD, -1)
    return F.array_join(F.zip_with(gaps, shown, lambda gap, word: F.concat(gap, F.coalesce(word, F.lit("")))), "")


def redact_text(text: Column | str, recognizers: Sequence[Recognizer] = RECOGNIZERS) -> Column:
    """Pattern replacement followed by the sequence rules."""
    return sequence_rules(replace_all(text, recognizers))


def redact_segments(segments: Column | str, change: Callable[[Column], Column] = redact_text) -> Column:
    """The segments of a call with changed text; all other fields stay."""
    return F.transform(segments, lambda s: s.withField("text", change(s["text"])))
