"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one key above which the key is spread over several tasks. With R rows per task a table
#: of N rows has at most N / R such keys, which bounds the broadcast list of hot keys: 10**12 rows
#: give at most 250,000 keys of some 40 bytes.
ROWS_PER_TASK = 4_000_000

_COPIES = "__copies"
_SALT = "__salt"


def hot_keys(df: DataFrame, on: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows, and the number of tasks each is spread over.

    Counts are combined on the map side, so a hot key costs one partial row per task.
    """
    counts = df.dropna(subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias("__rows"))
    return _hot(counts, on, "__rows", rows_per_task)


def _hot(counts: DataFrame, on: list[str], rows: str, rows_per_task: int) -> DataFrame:
    return counts.filter(F.col(rows) > rows_per_task).select(
        *on, F.ceil(F.col(rows) / rows_per_task).cast("int").alias(_COPIES)
    )


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    rows_column: str | None = None,
    rows_per_task: int | None = None,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Join ``big`` to ``small`` (``inner``, ``left`` or ``left_semi``) without a hot task.

    As a rule this is a plain join: adaptive execution splits the tasks of a key with many rows.
    Rows with a null key match nothing; they are left out, or dealt over all tasks for a left join.

    With ``rows_per_task`` the join does not depend on adaptive execution. Keys are counted, which
    costs a pass over ``big`` unless the counts are known. Rows of a hot key are dealt over several salts by a hash that gives the same salt when a task
    is run again; the ``small`` rows of that key are repeated once per salt. All other keys have
    the single salt 0. ``rows_column`` names a column of ``small`` that already holds the number
    of ``big`` rows per key and saves the counting pass; it is dropped from the result.
    ``count_on`` is a table to count the keys on in place of ``big``, such as the table ``big`` is
    drawn from: more rows only mean more salts, and a dear ``big`` is not computed twice.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"unsupported join type: {how}")
    if rows_per_task is None:
        return _plain(big, small.drop(rows_column) if rows_column else small, on, how)
    if rows_column:
        hot = _hot(small, on, rows_column, rows_per_task)
        rows = F.col(rows_column)
        copies = F.when(rows > rows_per_task, F.ceil(rows / rows_per_task)).otherwise(1).cast("int")
        counted = small.withColumn(_COPIES, copies).drop(rows_column)
        small = small.drop(rows_column)
    else:
        hot = hot_keys(big if count_on is None else count_on, on, rows_per_task)
        counted = small.join(hot, on, "left").withColumn(_COPIES, F.coalesce(_COPIES, F.lit(1)))

    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    spread = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in big.columns if _hashable(big, c)])
    salted = big.join(hot, on, "left").withColumn(
        _SALT,
        F.when(F.col(_COPIES).isNotNull(), F.pmod(spread, F.col(_COPIES)).cast("long"))
        .when(missing, spread)
        .otherwise(F.lit(0)),
    )
    repeated = counted.withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("long"), (F.col(_COPIES) - 1).cast("long"))))
    joined = salted.drop(_COPIES).join(repeated.drop(_COPIES), [*on, _SALT], how).drop(_SALT)
    if how == "left_semi":
        return joined.select(*big.columns)
    return joined.select(*big.columns, *[c for c in small.columns if c not in on])


def _plain(big: DataFrame, small: DataFrame, on: list[str], how: str) -> DataFrame:
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    if how != "left":
        return big.filter(~missing).join(small, on, how).select(*big.columns, *([] if how == "left_semi" else [c for c in small.columns if c not in on]))
    spread = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in big.columns if _hashable(big, c)])
    dealt = big.withColumn(_SALT, F.when(missing, spread).otherwise(F.lit(0)))
    joined = dealt.join(small.withColumn(_SALT, F.lit(0).cast("long")), [*on, _SALT], how)
    return joined.select(*big.columns, *[c for c in small.columns if c not in on])


def _hashable(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() not in ("map", "variant")
