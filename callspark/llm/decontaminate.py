"""Benchmark decontamination over a stored positional inverted index.

The index holds a posting (term, document, position) for every word of the corpus that occurs in
the test items, and one end posting per document at the position after its last word. It is built
by one pass over the texts without a shuffle and written to the shared folder; its parts are
therefore ordered by document.

A phrase search takes from each window of an item its two rarest terms by the counts of the index,
adjusts their postings by the places of the terms in the item, and intersects the two lists: what
is left names a document, an item and the difference between their positions. These few are
compared word by word with the text. A proximity search looks for the rarest terms of an item close
to each other in any order.

Terms are 64-bit hashes of words; a hit is always confirmed on the words themselves. Documents and
items with a null or repeated id are kept apart by a hash of their text. Words of items are sent to the tasks in
blocks of at most ``TERMS_AT_ONCE`` terms; a larger vocabulary takes one pass per block.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callspark.llm.common import ascii_lower, written

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WINDOW = 10
#: 8 bytes each, and some 24 in the hash table of a task.
TERMS_AT_ONCE = 1_000_000
_END = 0
#: What tells the rows of items apart; joined with nulls as values.
ITEM = ("item_id", "item_hash")


def words(text: Column) -> Column:
    """Words of a whole text, A-Z in lower case; null has none."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def term(word: Column) -> Column:
    """Number of a word; 0 is left to the end postings."""
    hashed = F.xxhash64(word)
    return F.when(hashed == _END, F.lit(1)).otherwise(hashed)


def fingerprint(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


@dataclass(frozen=True)
class Index:
    """Postings (term, doc_id, text_hash, pos), one end posting per document, and counts of terms."""

    postings: DataFrame
    counts: DataFrame


def test_words(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Items with at least one word, each pair of id and text once: id, hash of the text and words."""
    rows = items.select(items[item_id].alias("item_id"), items[text].alias("text")).distinct()
    return rows.select("item_id", fingerprint(F.col("text")).alias("item_hash"), words(F.col("text")).alias("item_words")).filter(
        F.size("item_words") > 0
    )


def _same(a: str, b: str, *columns: str) -> Column:
    """Equal columns of two aliased tables, nulls taken as values."""
    return reduce(Column.__and__, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns])


def _blocks(rows: DataFrame, at_once: int) -> list[DataFrame]:
    """A table cut by a hash of its rows into pieces of about ``at_once`` rows, each small enough to be sent.

    Rows with the same term may be in different pieces.
    """
    n = max(1, -(-rows.count() // at_once))
    return [F.broadcast(rows if n == 1 else rows.filter(F.pmod(F.xxhash64(*rows.columns), F.lit(n)) == i)) for i in range(n)]


def build(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", at_once: int = TERMS_AT_ONCE) -> Index:
    """Builds and stores the index of all documents for the words of the items."""
    vocabulary = written(
        test_words(items).select(F.explode("item_words").alias("w")).select(term(F.col("w")).alias("term")).distinct(), "vocabulary"
    )
    tokens = documents.select(
        documents[doc_id].alias("doc_id"),
        fingerprint(documents[text]).alias("text_hash"),
        F.posexplode(F.concat(words(documents[text]), F.array(F.lit(None).cast("string")))).alias("pos", "word"),
    ).select(F.when(F.col("word").isNull(), F.lit(_END)).otherwise(term(F.col("word"))).alias("term"), "doc_id", "text_hash", "pos")
    ends = vocabulary.sparkSession.range(1).select(F.lit(_END).cast("long").alias("term"))
    parts = [tokens.join(block, "term") for block in _blocks(vocabulary.unionByName(ends), at_once)]
    postings = written(reduce(DataFrame.unionByName, parts), "postings")
    counts = written(postings.filter(F.col("term") != _END).groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term-counts")
    return Index(postings, counts)


def rarest_pairs(index: Index, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """For every window of an item its two rarest terms and their places: item_id, item_hash, o1, t1, o2, t2, low, high.

    Windows with the same two places are one row; the first of them starts at ``low``, the last at ``high``. A window with a term that no document has can't occur and is left out. An item of fewer words
    is one window.
    """
    placed = test_words(items).select(*ITEM, F.size("item_words").alias("n"), F.posexplode("item_words").alias("o", "w"))
    counted = placed.withColumn("term", term(F.col("w"))).join(index.counts.withColumnRenamed("n", "df"), "term", "left")
    length = F.least(F.lit(window), F.col("n"))
    # A word belongs to the windows that start at most length - 1 words before it.
    starts = F.sequence(F.greatest(F.lit(0), F.col("o") - length + 1), F.least(F.col("o"), F.col("n") - length))
    rows = counted.withColumn("s", F.explode(starts))
    entry = F.struct(F.coalesce("df", F.lit(0)).alias("df"), F.col("o"), F.col("term"))
    ranked = rows.groupBy(*ITEM, "s").agg(F.array_sort(F.collect_list(entry)).alias("t"))  # at most ``window`` entries
    first, second = F.get("t", F.lit(0)), F.coalesce(F.get("t", F.lit(1)), F.get("t", F.lit(0)))
    return (
        ranked.filter(first["df"] > 0)
        .groupBy(*ITEM, first["o"].alias("o1"), first["term"].alias("t1"), second["o"].alias("o2"), second["term"].alias("t2"))
        .agg(F.min("s").alias("low"), F.max("s").alias("high"))
    )


def _lists(index: Index, anchors: DataFrame, at_once: int = TERMS_AT_ONCE) -> DataFrame:
    """Postings of the anchors (term, item_id, item_hash, ...), from the index."""
    parts = [index.postings.join(block, "term") for block in _blocks(anchors, at_once)]
    return reduce(DataFrame.unionByName, parts)


def candidates(index: Index, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, item_id, item_hash, shift, low, high) where the two rarest terms of a window stand as in the item.

    ``low`` and ``high`` are the first and the last start of the windows in question.
    """
    pairs = written(rarest_pairs(index, items, window), "rarest-pairs")
    first = _lists(index, pairs.select(F.col("t1").alias("term"), *ITEM, "o1", "o2", "low", "high")).select(
        "doc_id", "text_hash", *ITEM, (F.col("pos") - F.col("o1")).alias("shift"), "o2", "low", "high"
    )
    second = _lists(index, pairs.select(F.col("t2").alias("term"), *ITEM, "o2").distinct()).select(
        "doc_id", "text_hash", *ITEM, (F.col("pos") - F.col("o2")).alias("shift"), "o2"
    )
    same = _same("a", "b", "doc_id", "text_hash", *ITEM, "shift", "o2")
    met = first.alias("a").join(second.alias("b"), same, "left_semi")
    return met.groupBy("doc_id", "text_hash", *ITEM, "shift").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def phrase_matches(index: Index, documents: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every word of a document inside an occurrence of a window of an item: doc_id, text_hash, item_id, pos.

    The candidates of a document come together first, at most one for each item and shift, so that its
    text is cut into words once; then only the words of the windows in question are compared.
    """
    found = written(candidates(index, items, window), "candidates").groupBy("doc_id", "text_hash", *ITEM).agg(
        F.collect_list(F.struct("shift", "low", "high")).alias("places")
    )
    with_words = found.alias("f").join(test_words(items).alias("i"), _same("f", "i", *ITEM))
    of_document = with_words.groupBy("f.doc_id", "f.text_hash").agg(
        F.collect_list(F.struct("f.item_id", "places", "item_words")).alias("items")
    )
    texts = documents.select(
        documents["doc_id"].alias("__id"), documents["text"].alias("__text"), fingerprint(documents["text"]).alias("__hash")
    )
    met = texts.join(of_document, F.col("__id").eqNullSafe(F.col("doc_id")) & (F.col("__hash") == F.col("text_hash")))

    def hits(doc_words: Column) -> Column:
        return F.transform("items", lambda it: F.struct(it["item_id"].alias("item_id"), _hit(doc_words, it, window).alias("pos")))

    each = met.select("doc_id", "text_hash", F.explode(F.element_at(F.transform(F.array(words(F.col("__text"))), hits), 1)).alias("hit"))
    return each.select("doc_id", "text_hash", F.col("hit.item_id").alias("item_id"), F.explode("hit.pos").alias("pos")).distinct()


def _hit(doc_words: Column, item: Column, window: int) -> Column:
    """Places of a document's words that lie in an occurrence of a window of an item, each once."""
    length = F.least(F.lit(window), F.size(item["item_words"]))

    def starts(place: Column) -> Column:
        """Starts in the document of the windows that occur at a shift."""
        return F.aggregate(
            F.sequence(place["low"], place["high"] + length - 1),
            F.struct(F.lit(0).alias("run"), F.array().cast("array<int>").alias("starts")),
            lambda s, i: _extended(s, i, place["shift"] + i, doc_words, item["item_words"], length),
            lambda s: s["starts"],
        )

    found = F.array_distinct(F.flatten(F.transform(item["places"], starts)))
    return F.array_distinct(F.flatten(F.transform(found, lambda at: F.sequence(at, at + length - 1))))


def _extended(state: Column, i: Column, at: Column, doc_words: Column, item_words: Column, length: Column) -> Column:
    """Length of the run of equal words up to place i of the item, and the starts of full windows in the document."""
    same = (at >= 0) & (F.get(doc_words, at) == F.get(item_words, i))
    run = F.when(F.coalesce(same, F.lit(False)), state["run"] + 1).otherwise(F.lit(0))
    starts = F.when(run >= length, F.array_append(state["starts"], at - length + 1)).otherwise(state["starts"])
    return F.struct(run.alias("run"), starts.alias("starts"))


def report(documents: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document its words, the words hit, the items that occur and their digest.

    Items are told by their ids here: rows with the same id are one item, those without an id are
    one item that counts and has no part in the digest.
    One row per input row, also for null texts and repeated ids; other columns are left out.
    """
    index = build(documents, items)
    hits = phrase_matches(index, documents, items, window)
    per_document = hits.groupBy("doc_id", "text_hash").agg(
        F.countDistinct("pos").alias("n_hit"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
        F.max(F.col("item_id").isNull().cast("int")).alias("unnamed"),
    )
    every = index.postings.filter(F.col("term") == _END).select("doc_id", "text_hash", F.col("pos").cast("long").alias("n_words"))
    d, h = every.alias("d"), per_document.alias("h")
    joined = d.join(h, F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.text_hash") == F.col("h.text_hash")), "left")
    items_found = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return joined.select(
        F.col("d.doc_id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        (F.size(items_found) + F.coalesce("unnamed", F.lit(0))).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_found, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean(documents: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no window of an item occurs, with all their columns."""
    hits = phrase_matches(build(documents, items), documents, items, window).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")
    ).distinct()
    return documents.join(
        hits, documents["doc_id"].eqNullSafe(F.col("__id")) & (fingerprint(documents["text"]) == F.col("__hash")), "left_anti"
    )


def proximity_matches(index: Index, items: DataFrame, terms: int = 3, within: int = 20) -> DataFrame:
    """Documents in which the rarest distinct terms of an item stand within ``within`` words: item_id, item_hash, doc_id, text_hash, pos.

    ``pos`` is the place of the rarest term. Items with fewer terms use all they have; an item with
    a term that no document has gives nothing. Lists meet by document and stretch of ``within``
    words, so a document's postings are never paired one with all.
    """
    placed = test_words(items).select(*ITEM, F.explode(F.array_distinct("item_words")).alias("w"))
    counted = placed.withColumn("term", term(F.col("w"))).join(index.counts, "term", "left")
    order = Window.partitionBy(*ITEM).orderBy(F.coalesce("n", F.lit(0)), "term")
    ranked = counted.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= terms)
    wanted = written(ranked.select(*ITEM, "term", "r"), "rarest-terms")
    lists = _lists(index, wanted).withColumn("stretch", F.floor(F.col("pos") / within))
    first = lists.filter("r = 1").select("doc_id", "text_hash", *ITEM, F.col("pos").alias("p"), "stretch")
    others = lists.filter("r > 1").select("doc_id", "text_hash", *ITEM, "r", F.col("pos").alias("q"), "stretch")
    spread = first.withColumn("stretch", F.explode(F.array(F.col("stretch") - 1, F.col("stretch"), F.col("stretch") + 1)))
    needed = wanted.groupBy(*ITEM).agg((F.count(F.lit(1)) - 1).alias("needed"))
    near = (
        spread.alias("a").join(others.alias("b"), _same("a", "b", "doc_id", "text_hash", *ITEM, "stretch"), "left")
        .select("a.*", "b.r", "b.q")
        .withColumn("near", F.when(F.abs(F.col("p") - F.col("q")) < within, F.col("r")))
        .groupBy(*ITEM, "doc_id", "text_hash", F.col("p").alias("pos"))
        .agg(F.countDistinct("near").alias("met"))
    )
    enough = near.alias("a").join(needed.alias("b"), _same("a", "b", *ITEM)).select("a.*", "needed").filter("met >= needed")
    return enough.select(*ITEM, "doc_id", "text_hash", "pos")
