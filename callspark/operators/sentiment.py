"""Sentiment of segments by a word list. The scores are not those of any particular model."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callspark.functions.text import let, sentences_by_mark
from callspark.operators.skew import lookup_join

POSITIVE, NEGATIVE, NEUTRAL = "Positive", "Negative", "Neutral"
NOT_IDENTIFIED = "No Sentiment Identified"

LEXICON = {
    **dict.fromkeys((
        "good", "great", "excellent", "happy", "thank", "thanks", "pleased", "resolved", "perfect",
        "helpful", "appreciate", "wonderful", "glad", "satisfied", "love", "easy", "quick", "fixed",
    ), 1),
    **dict.fromkeys((
        "bad", "poor", "terrible", "angry", "upset", "frustrated", "problem", "issue", "wrong",
        "broken", "unhappy", "complaint", "disappointed", "worst", "hate", "slow", "late", "outage",
    ), -1),
}
_WORDS = r"(?U)\w+"


def _by_weight(lexicon: Mapping[str, float]) -> dict[float, list[str]]:
    weights: dict[float, list[str]] = {}
    for word, weight in lexicon.items():
        weights.setdefault(float(weight), []).append(word.lower())
    return weights


def score(sentence: Column, lexicon: Mapping[str, float] = LEXICON) -> Column:
    """Sum of the weights of the words of a sentence.

    The list becomes one set per weight in the plan, which is looked up by hash; a list that is a table
    goes to :func:`label_rows`.
    """
    weights = _by_weight(lexicon)

    def total(words: Column) -> Column:
        parts = [
            F.size(F.filter(words, lambda w: w.isin(listed))) * F.lit(weight)
            for weight, listed in weights.items()
        ]
        return sum(parts[1:], parts[0]) if parts else F.lit(0.0)

    return let(F.regexp_extract_all(F.lower(sentence), F.lit(_WORDS), F.lit(0)), total)


def label(total: Column) -> Column:
    return F.when(total > 0, POSITIVE).when(total < 0, NEGATIVE).otherwise(NEUTRAL)


def majority_label(labels: Column) -> Column:
    """Most frequent of the three labels in an array; the one seen first wins a tie."""
    def pick(found: Column) -> Column:
        ranked = [
            F.struct(
                (-F.size(F.filter(found, lambda x: x == name))).alias("n"),
                F.array_position(found, name).alias("first"),
                F.lit(name).alias("label"),
            )
            for name in (POSITIVE, NEGATIVE, NEUTRAL)
        ]
        return F.array_min(F.filter(F.array(*ranked), lambda r: r["first"] > 0))["label"]

    return let(labels, pick)


def label_text(text: Column, lexicon: Mapping[str, float] = LEXICON) -> Column:
    """Label of a text: the majority over its sentences."""
    return majority_label(F.transform(sentences_by_mark(text), lambda s: let(score(s, lexicon), label)))


def segments(
    df: DataFrame, column: str = "transcription", lexicon: Mapping[str, float] = LEXICON
) -> DataFrame:
    """Adds ``sentiment``: the segments of a call, each with its label.

    ``sentiment_note`` holds the sentinel for a call without segments. All work is inside the row.
    """
    labelled = F.transform(
        column, lambda s: s.withField("sentiment", label_text(s["text"], lexicon))
    )
    empty = F.col(column).isNull() | (F.size(column) == 0)
    return df.withColumns({
        "sentiment": labelled, "sentiment_note": F.when(empty, F.lit(NOT_IDENTIFIED)),
    })


def majority(rows: DataFrame, group: list[str], label_column: str, position: str) -> DataFrame:
    """Most frequent label per group; the one at the smallest position wins a tie.

    Counted per (group, label) and then reduced, so no group is collected.
    """
    counts = rows.groupBy(*group, label_column).agg(
        F.count(F.lit(1)).alias("n"), F.min(position).alias("first")
    )
    best = F.min(F.struct((-F.col("n")).alias("n"), "first", F.col(label_column).alias("label")))
    return counts.groupBy(*group).agg(best["label"].alias(label_column))


def label_rows(
    rows: DataFrame, group: list[str], text: str, lexicon: DataFrame,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Label per text with a word list (word, score) of any size.

    Words are counted per sentence before they meet the list, and the join spreads frequent ones.
    A null text is neutral.
    """
    sentences = rows.select(*group, F.posexplode_outer(sentences_by_mark(text)).alias("position", "sentence"))
    words = (
        sentences.filter("sentence IS NOT NULL").select(
            *group, "position",
            F.explode(F.regexp_extract_all(F.lower("sentence"), F.lit(_WORDS), F.lit(0))).alias("word"),
        )
        .groupBy(*group, "position", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    listed = lexicon.groupBy("word").agg(F.sum("score").alias("score"))
    sums = (
        lookup_join(words, listed, ["word"], rows_per_task=rows_per_task)
        .groupBy(*group, "position")
        .agg(F.sum(F.col("n") * F.col("score")).alias("total"))
    )
    labelled = sentences.drop("sentence").join(sums, [*group, "position"], "left").withColumn(
        "sentiment", label(F.coalesce("total", F.lit(0)))
    )
    return majority(labelled, group, "sentiment", "position")
