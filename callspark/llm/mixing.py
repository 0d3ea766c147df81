"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Every source gets a target in words: its weighted share of all words, at most ``most`` times what it
has, the excess shared among the others. Blocks of equal size are then dealt to the sources by the
highest quotients target / (2k + 1), cumulatively shard by shard, which gives whole quotas per
shard. A source's documents stand on a line in an order given by the seed; the quota picks a run of
blocks that starts at a seeded block and goes around, so repeats are even to one pass.

Tables of sources stay DataFrames; they are as long as the number of sources. Documents are
shuffled without their texts, by source and a hash bucket, so that a source with most of the rows
is spread over ``buckets`` groups.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callspark.llm.common import SPACED_WORD, written


@dataclass(frozen=True)
class Mix:
    """Parameters of a mix: weights by rank of the source, repeating."""

    weights: tuple[int, ...] = (5, 2, 1)
    most: int = 3
    block: int = 16
    shards: int = 16
    seed: int = 17
    buckets: int = 1024


def _key(source: Column) -> Column:
    """A source as a text that is never null, different for null and for every text."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source))


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def sized(documents: DataFrame) -> DataFrame:
    """Id, hash of the text, source and number of words of each document; null texts have none."""
    return documents.select(
        documents["doc_id"].alias("doc_id"),
        _text_hash(documents["text"]).alias("text_hash"),
        documents["source"].alias("source"),
        F.regexp_count(F.coalesce(documents["text"], F.lit("")), F.lit(SPACED_WORD)).cast("long").alias("size"),
    ).withColumn("key", _key(F.col("source")))


def targets(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per source its words and its target in words, from a table of ``sized``.

    Sources rank by code point, null last. The targets are those of repeated resharing: ordered by
    most / weight, the first source that its share of what is left does not fill sets the level.
    """
    sums = documents.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    everyone = Window.partitionBy()
    weights = F.array(*[F.lit(w) for w in mix.weights])
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranked = sums.withColumn("rank", rank).withColumns({
        "weight": F.element_at(weights, ((F.col("rank") - 1) % len(mix.weights) + 1).cast("int")),
        "cap": F.col("source_size") * mix.most,
        "all_words": F.sum("source_size").over(everyone),
    })
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onwards = order.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("all_words") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = left / F.sum("weight").over(onwards)
    leveled = ranked.withColumn("level", level).withColumn(
        "final", F.max(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level"))).over(everyone)
    )
    return leveled.select(
        "key", "source", "rank", "source_size",
        F.least(F.col("cap").cast("double"), F.col("final") * F.col("weight")).alias("target"),
    )


def quotas(goals: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Blocks per source and shard by the highest quotients, from a table of ``targets``.

    Shard j gets what the first j + 1 shards' blocks give a source, less what the first j give;
    the method never takes a seat away when seats are added. The seats of a source differ from its
    exact share of n sources by at most share * n / 2 + 1, so only the quotients around the exact
    share are ranked, in all about five per source and shard.
    """
    everyone = Window.partitionBy()
    shared = goals.withColumns({
        "n": F.count(F.lit(1)).over(everyone),
        "all_target": F.sum("target").over(everyone),
    }).withColumn("house", F.round(F.col("all_target") / mix.block).cast("long"))
    houses = shared.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(mix.shards - 1))))
    exact = houses.withColumn(
        "seats", F.floor(F.col("house") * (F.col("shard") + 1) / mix.shards).cast("long")
    ).withColumn("share", F.when(F.col("all_target") > 0, F.col("target") / F.col("all_target")).otherwise(0.0))
    margin = F.ceil(F.col("share") * F.col("n") / 2) + 2
    sure = exact.withColumns({
        "low": F.greatest(F.lit(0), F.floor(F.col("share") * F.col("seats")) - margin).cast("long"),
        "high": (F.floor(F.col("share") * F.col("seats")) + margin).cast("long"),
    })
    of_house = Window.partitionBy("shard")
    opened = sure.withColumn("open", F.col("seats") - F.sum("low").over(of_house))
    bids = opened.withColumn("k", F.explode(F.sequence("low", "high"))).withColumn(
        "quotient", F.col("target") / (2 * F.col("k") + 1)
    )
    placed = bids.withColumn(
        "place", F.row_number().over(of_house.orderBy(F.desc("quotient"), "rank", "k"))
    )
    cumulative = placed.groupBy("key", "shard").agg(
        (F.max("low") + F.sum(F.when((F.col("place") <= F.col("open")) & (F.col("target") > 0), 1).otherwise(0))).alias("upto")
    )
    earlier = F.lag("upto", 1, 0).over(Window.partitionBy("key").orderBy("shard"))
    return cumulative.select("key", "shard", "upto", (F.col("upto") - earlier).alias("blocks"))


def _overlap(start: Column, end: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.lit(0), F.least(end, high) - F.greatest(start, low))


def mixed(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per document its words, its source's words and target, and the words the mix takes of it.

    One row per input row; other columns are left out. A source of fewer words than a block may
    miss its target by up to one block. Equal rows of an id are told apart by nothing and may trade
    their words; apart from that a run repeats exactly.
    """
    return _taken(documents, mix).drop("text_hash")


def _taken(documents: DataFrame, mix: Mix) -> DataFrame:
    """The rows of ``mixed`` with the hash of the text."""
    sizes = written(sized(documents), "sized")
    goals = written(targets(sizes, mix), "targets")
    chosen = quotas(goals, mix).groupBy("key").agg(F.sum("blocks").alias("blocks"))
    blocks = F.ceil(F.col("source_size") / mix.block).cast("long")
    quota = F.least(F.coalesce(F.col("blocks"), F.lit(0)), F.col("n_blocks") * mix.most)
    runs = (
        goals.withColumn("n_blocks", blocks)
        .join(chosen, "key", "left")
        .withColumn("quota", quota)
        .withColumns({
            "passes": F.when(F.col("n_blocks") > 0, F.floor(F.col("quota") / F.col("n_blocks"))).otherwise(0).cast("long"),
            "extra": F.when(F.col("n_blocks") > 0, F.col("quota") % F.col("n_blocks")).otherwise(0).cast("long"),
            "first": F.when(F.col("n_blocks") > 0, F.pmod(F.xxhash64(F.lit(mix.seed), "key"), "n_blocks")).otherwise(0),
        })
    )

    line = sizes.withColumn("bucket", F.pmod(F.xxhash64(F.lit(mix.seed), "doc_id", "size"), F.lit(mix.buckets)).cast("int"))
    sums = line.groupBy("key", "bucket").agg(F.sum("size").alias("words"))
    ahead = F.sum("words").over(Window.partitionBy("key").orderBy("bucket")) - F.col("words")
    starts = sums.select("key", "bucket", ahead.alias("ahead")).join(runs.drop("source"), "key")

    order = Window.partitionBy("key", "bucket").orderBy("shuffled", "doc_id", "size", "text_hash")
    placed = line.withColumn("shuffled", F.xxhash64(F.lit(mix.seed + 1), "doc_id", "size")).withColumn(
        "upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    end = F.col("ahead") + F.col("upto")
    start = end - F.col("size")
    low, run = F.col("first") * mix.block, F.col("extra") * mix.block
    around = F.col("n_blocks") * mix.block
    taken = (
        F.col("passes") * F.col("size")
        + _overlap(start, end, low, F.least(low + run, around))
        + _overlap(start, end, F.lit(0), low + run - around)
    )
    return placed.join(starts, ["key", "bucket"]).select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source", "text_hash"
    )


def copies(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix as documents: each as often as its taken words come nearest to, with all its columns.

    Documents are recognised by id, source and a hash of their text, nulls taken as values; rows
    equal in these all get the largest number among them.
    """
    taken = _taken(documents, mix).select(
        F.col("doc_id").alias("__id"),
        _key(F.col("source")).alias("__key"),
        F.col("text_hash").alias("__hash"),
        F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int").alias("__copies"),
    )
    kept = taken.filter("__copies > 0").groupBy("__id", "__key", "__hash").agg(F.max("__copies").alias("__copies"))
    same_text = _text_hash(documents["text"]) == kept["__hash"]
    joined = documents.join(
        kept, documents["doc_id"].eqNullSafe(kept["__id"]) & (_key(documents["source"]) == kept["__key"]) & same_text
    )
    repeated = joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return repeated.select(*[documents[c] for c in documents.columns])
