"""Fourteen structured insights per call, parsed from a model's answer or drawn by rules.

The rules are a checkable default and do not aim at the answers of a model.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callspark.functions.text import column, let, token_count
from callspark.operators.sentiment import LEXICON, label_text
from callspark.operators.summarize import ACTION_WORDS, extract_summary_and_main, sentences_with

# Fields, sentinel, shortest text, value sets.
FIELDS = (
    "Summary", "Category", "Main Issue", "Steps Taken", "Sentiment", "Urgency", "Follow-Up Actions",
    "Repeated Issues", "Customer Loyalty Indicators", "Transfer Involved",
    "Department Transferred To", "Issue Resolution Status", "Satisfaction Score",
    "Improvement Suggestions",
)
NOT_GENERATED = "Not Generated"
MIN_TOKENS = 20
CATEGORIES = (
    "BILLING", "BUSINESS ACCOUNTS", "COLLECTIONS", "COMMERCIAL", "ENERGY", "ON TRACK", "POWER",
    "STANDARD OFFER", "START OR STOP OR TRANSFER SERVICE",
)


@dataclass(frozen=True)
class Rule:
    """``value`` for ``field`` if ``regex`` is found; earlier rules of a field win."""

    field: str
    regex: str
    value: str


def _rule(field: str, words: str, value: str) -> Rule:
    return Rule(field, rf"\b(?:{words})\b", value)


RULES = (
    _rule("Category", "start service|stop service|transfer service|moving", "START OR STOP OR TRANSFER SERVICE"),
    _rule("Category", "collections?|past due|overdue|disconnect", "COLLECTIONS"),
    _rule("Category", "on track|assistance program", "ON TRACK"),
    _rule("Category", "standard offer", "STANDARD OFFER"),
    _rule("Category", "business account", "BUSINESS ACCOUNTS"),
    _rule("Category", "commercial", "COMMERCIAL"),
    _rule("Category", "outage|power|meter", "POWER"),
    _rule("Category", "supplier|solar|energy", "ENERGY"),
    _rule("Category", "bill|bills|billing|payment|charge", "BILLING"),
    _rule("Urgency", "emergency|urgent|immediately|outage", "High"),
    _rule("Urgency", "soon|today|tomorrow", "Medium"),
    _rule("Repeated Issues", "again|still|second time|called before", "Yes"),
    _rule("Transfer Involved", "transfer you|transferred|connect you", "Yes"),
    _rule("Department Transferred To", "collections", "Collections"),
    _rule("Department Transferred To", "billing", "Billing"),
    _rule("Issue Resolution Status", "resolved|fixed|taken care of|all set", "Resolved"),
    _rule("Satisfaction Score", "excellent|wonderful|perfect", "5"),
    _rule("Satisfaction Score", "thank you|thanks", "4"),
    _rule("Satisfaction Score", "terrible|worst", "1"),
    _rule("Satisfaction Score", "frustrated|upset|angry", "2"),
    _rule("Customer Loyalty Indicators", "long time customer|years", "Loyal"),
    _rule("Customer Loyalty Indicators", "cancel|switch", "At risk"),
    _rule("Improvement Suggestions", "on hold|waiting", "Shorten the wait"),
)
DEFAULTS = {
    "Category": "BILLING", "Urgency": "Low", "Repeated Issues": "No", "Transfer Involved": "No",
    "Department Transferred To": "None", "Issue Resolution Status": "Unresolved", "Satisfaction Score": "3",
    "Customer Loyalty Indicators": "None", "Improvement Suggestions": "None",
}
FOLLOW_UP_WORDS = ("will", "follow", "schedule", "scheduled", "tomorrow", "later", "callback")
PROBLEM_WORDS = ("problem", "issue", "outage", "wrong", "broken", "help", "question")


def by_rules(text: Column, field: str, rules: Iterable[Rule], default: str | None) -> Column:
    """Value of the first rule of a field that is found in the text."""
    result = None
    for rule in (r for r in rules if r.field == field):
        found = text.rlike(f"(?iU){rule.regex}")
        result = F.when(found, rule.value) if result is None else result.when(found, rule.value)
    return F.lit(default) if result is None else result.otherwise(F.lit(default))


def extract(
    df: DataFrame, text: str = "transcription", rules: Sequence[Rule] = RULES, min_tokens: int = MIN_TOKENS,
    lexicon: dict = LEXICON, action_words: Iterable[str] = ACTION_WORDS,
    problem_words: Iterable[str] = PROBLEM_WORDS, follow_up_words: Iterable[str] = FOLLOW_UP_WORDS,
) -> DataFrame:
    """Adds the fourteen fields; texts below ``min_tokens`` tokens get the sentinel in all.

    The summary, and the main issue of a text without a problem word, come from the extractive
    scorer over the whole text.
    """
    body = column(text)
    none = F.lit("None")

    @F.pandas_udf("summary string, main string")
    def scored(texts: pd.Series) -> pd.DataFrame:
        both = [(None, None) if t is None else extract_summary_and_main(t) for t in texts]
        return pd.DataFrame(both, columns=["summary", "main"], index=texts.index)

    # Tokens are counted once for all fields.
    df = df.withColumns({"__scored": scored(body), "__enough": token_count(body) >= min_tokens})

    def listed(words: Iterable[str]) -> Column:
        return let(sentences_with(body, list(words)), lambda found: F.nullif(found, F.lit("")))

    fields = {
        "Summary": F.col("__scored.summary"),
        "Main Issue": F.coalesce(listed(problem_words), F.col("__scored.main")),
        "Steps Taken": F.coalesce(listed(action_words), none),
        "Sentiment": label_text(body, lexicon),
        "Follow-Up Actions": F.coalesce(listed(follow_up_words), none),
    }
    return df.withColumns({
        f: F.when(F.col("__enough"), fields.get(f, by_rules(body, f, rules, DEFAULTS.get(f)))).otherwise(F.lit(NOT_GENERATED))
        for f in FIELDS
    }).drop("__scored", "__enough")


def parse(df: DataFrame, answer: str, fields: Sequence[str] = FIELDS) -> DataFrame:
    """Adds the fields of a model's JSON answer; an unreadable answer gives the sentinel in all.

    Only strict JSON is read. A field missing from a readable answer is null.
    """
    schema = ", ".join(f"`{f}` string" for f in fields)
    parsed = F.from_json(answer, schema, {"allowSingleQuotes": "false"})
    readable = F.col(answer).rlike(r"(?s)^\s*\{.*\}\s*$") & F.coalesce(*[parsed[f] for f in fields]).isNotNull()
    return df.withColumn("__parsed", F.when(readable, parsed)).select(
        "*", *[
            F.when(F.col("__parsed").isNull(), F.lit(NOT_GENERATED)).otherwise(F.col("__parsed")[f]).alias(f)
            for f in fields
        ]
    ).drop("__parsed")


#: Python constants as JSON writes them.
_CONSTANTS = {"None": "null", "True": "true", "False": "false"}
#: Quoted strings, what lies between them, and quotes that are never closed.
_PIECES = r"""(?s)"(?:[^"\\]++|\\.)*+"|'(?:[^'\\]++|\\.)*+'|[^"']++|["']"""


def parse_literal(col: Column | str, schema: str) -> Column:
    """A list or dict written as a Python or JSON literal, under an array or map schema; else null.

    Python's constants are only translated where the text as it stands is not readable, and only
    outside quotes.
    """
    text = column(col)

    def outside(piece: Column) -> Column:
        for python, json in _CONSTANTS.items():
            piece = F.regexp_replace(piece, rf"\b{python}\b", json)
        return piece

    translated = let(
        F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0)),
        lambda pieces: F.array_join(F.transform(pieces, lambda p: F.when(p.rlike("^[\"']"), p).otherwise(outside(p))), ""),
    )
    closed = text.rlike(r"(?s)^\s*(\[.*\]|\{.*\})\s*$")
    return F.when(closed, F.coalesce(F.from_json(text, schema), F.from_json(translated, schema)))


def parse_list(col: Column | str) -> Column:
    """A list of texts written as a Python or JSON literal; null if it is neither."""
    return parse_literal(col, "array<string>")
