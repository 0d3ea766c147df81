"""Trees of texts by any predictor, one level of the tree after the other, over rows.

A long text becomes one row per chunk. All rows of a level go through the predictor together, in batches
across texts, so a model sees full batches and a long text is spread over tasks. Neighbouring results
are then joined, as many as fit the budget, and make the rows of the next level. Joining asks for the
sizes of the results alone; no task gathers the texts of a whole call but where they end as one text.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callspark.functions.text import chunks, token_count
from callspark.operators.infer import Predictor, map_predict
from callspark.operators.summarize import MAX_TOKENS, NO_ACTIONS, extract_actions, extract_summary
from callspark.session import written


class TextPredictor:
    """A function of one text as a predictor: column ``piece`` in, column ``result`` out."""

    def __init__(self, function: Callable[[str], str] = extract_summary):
        self.function = function

    def setup(self) -> None:
        pass

    def predict(self, batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"result": [self.function(t) for t in batch["piece"]]})


def runs(sizes: list[int], budget: int) -> list[int]:
    """Per part the number of the first part it is joined with.

    A run of parts that together stays under the budget is one text; one that does not is cut at its
    middle. A part over the budget stays alone.
    """
    out, todo = [0] * len(sizes), [(0, len(sizes))]
    before = [0]
    for size in sizes:
        before.append(before[-1] + size)
    while todo:
        low, high = todo.pop()
        if high - low <= 1 or before[high] - before[low] < budget:
            out[low:high] = [low] * (high - low)
        else:
            middle = low + (high - low) // 2
            todo += [(low, middle), (middle, high)]
    return out


def _run_starts(sizes: Column, budget: int) -> Column:
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def starts(lists: pd.Series) -> pd.Series:
        return lists.map(lambda s: runs(list(s), budget))

    return starts(sizes)


def pieces(df: DataFrame, key: str, text: str, max_tokens: int, chunk: tuple[int, int, int]) -> DataFrame:
    """(key, position, piece, whole): the chunks of texts from ``max_tokens`` tokens on, others as they are; needs token_count."""
    whole = F.col("token_count") < max_tokens
    return df.select(
        key, whole.alias("whole"), F.posexplode(F.when(whole, F.array(text)).otherwise(chunks(text, *chunk))).alias("position", "piece")
    ).select(key, "position", "piece", "whole")


def joined(results: DataFrame, key: str, budget: int) -> DataFrame:
    """(key, position, piece): neighbouring results (key, position, result) joined by spaces while under the budget of tokens.

    The runs are found from the number of tokens of each result; texts meet by (key, first position).
    """
    sizes = results.select(key, F.struct("position", token_count("result").alias("n")).alias("part"))
    ordered = sizes.groupBy(key).agg(F.array_sort(F.collect_list("part")).alias("parts"))
    starts = ordered.select(key, F.col("parts.position").alias("at"), _run_starts(F.col("parts.n"), budget).alias("start"))
    placed = starts.select(key, F.explode(F.arrays_zip("at", "start")).alias("p")).select(
        key, F.col("p.at").alias("position"), F.col("p.start").alias("start")
    )
    together = results.join(placed, [key, "position"]).groupBy(key, "start").agg(
        F.array_sort(F.collect_list(F.struct("position", "result"))).alias("parts")
    )
    return together.select(key, F.col("start").alias("position"), F.array_join(F.col("parts.result"), " ").alias("piece"))


def tree(
    df: DataFrame, predictor: Callable[[], Predictor], key: str, text: str = "transcription", max_tokens: int = MAX_TOKENS,
    chunk: tuple[int, int, int] = (3200, 3800, 50), into: str = "summary", batch_size: int = 10,
    fallback: Mapping[str, object] | None = None, partitions: int | None = None,
) -> DataFrame:
    """Adds a summary of summaries by any predictor; needs token_count, and a ``key`` that no two rows share.

    The predictor takes the column ``piece`` and gives ``result`` (see
    :func:`callspark.operators.infer.map_predict` for batches, failures and ``fallback``). Below ``max_tokens`` tokens
    a text is one piece and its result the summary. Otherwise its chunks are predicted, neighbouring
    results that fit together are predicted again, and these results are joined by spaces. Each level
    is written, so a lost executor repeats no prediction. A row without a key or without a text gets
    null, and a text without tokens the result for an empty piece.
    """
    def predicted(rows: DataFrame) -> DataFrame:
        return written(map_predict(rows, predictor, "result string", batch_size, fallback, partitions).drop("error", "processing_time"))

    first = predicted(pieces(df.filter(F.col(key).isNotNull() & F.col(text).isNotNull()), key, text, max_tokens, chunk))
    again = joined(first.filter(~F.col("whole")).select(key, "position", F.coalesce("result", F.lit("")).alias("result")), key, max_tokens)
    second = predicted(again)
    last = second.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("position", F.coalesce("result", F.lit("")).alias("result")))).alias("parts"))
    done = first.filter("whole").select(key, F.col("result").alias(into)).unionByName(
        last.select(key, F.array_join(F.col("parts.result"), " ").alias(into))
    )
    return df.join(done, key, "left")


def actions(df: DataFrame, predictor: Callable[[], Predictor] = lambda: TextPredictor(extract_actions), key: str = "file_path", **options) -> DataFrame:
    """Adds the actions of texts of any length by a predictor; the sentinel where it finds none. Options as for :func:`tree`."""
    into = options.pop("into", "actions_taken")
    staged = tree(df, predictor, key, into=into, **options)
    return staged.withColumn(into, F.coalesce(F.nullif(F.trim(into), F.lit("")), F.lit(NO_ACTIONS)))
