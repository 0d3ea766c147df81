import pytest
from pyspark.sql import functions as F

from callspark.functions import text as X
from callspark.operators import transcripts as T


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("r")).first().r


def chunk_by_loop(words, size, most, overlap):
    """Chunks by walking through the tokens."""
    found, start = [], 0
    while start < len(words):
        end = start + size
        if end + overlap < len(words):
            end += overlap
        end = min(end, len(words), start + most)
        found.append(" ".join(words[start:end]))
        start += size
    return found


@pytest.mark.parametrize("size,most,overlap", [(5, 8, 2), (5, 6, 2), (4, 4, 1), (1, 1, 0)])
def test_chunks_equal_the_loop(spark, size, most, overlap):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in range(0, 24)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = {r.id: r.c for r in df.select("id", X.chunks("t", size, most, overlap).alias("c")).collect()}
    assert got == {i: chunk_by_loop(t.split(), size, most, overlap) for i, t in enumerate(texts)}


def test_chunks_cover_and_overlap(spark):
    words = [f"w{i}" for i in range(8000)]
    got = one(spark, X.chunks("t"), t=" ".join(words))
    assert [len(c.split()) for c in got] == [3250, 3250, 1600]
    assert got[0].split()[-50:] == got[1].split()[:50]
    assert set(" ".join(got).split()) == set(words)


def test_counts(spark):
    assert one(spark, X.word_count("t"), t="Hello, wörld! It's 5.") == 9
    assert one(spark, X.token_count("t"), t="  a\tb \n c ") == 3
    assert one(spark, X.token_count("t"), t="") == 0
    assert one(spark, X.token_count("t", lambda c: F.length(c)), t="abc") == 3


def test_sentences(spark):
    assert one(spark, X.sentences_by_stop("t"), t="one two three four five. too short. a b c d e f") == [
        "one two three four five", " a b c d e f"
    ]
    assert one(spark, X.sentences_by_mark("t"), t="Hi! How are you? Fine.") == ["Hi", "How are you", "Fine."]


def test_render(spark):
    assert one(spark, X.render("{a} & {b}{{x}}", a="a", b="b"), a="1", b=None) == "1 & {x}"
    with pytest.raises(KeyError):
        X.render("{missing}")


def test_conform_orders_segments(spark):
    rows = spark.createDataFrame(
        [("f", 5.0, 6.0, "later"), ("f", 0.0, 1.0, "first"), ("f", 2.0, 3.0, None)],
        "file_path string, start double, end double, text string",
    )
    calls = T.conform(rows)
    assert calls.select(X.merge_segments("transcription").alias("t")).first().t == "first later"
    assert [(r.position, r.text) for r in T.positions(calls).collect()] == [(0, "first"), (1, None), (2, "later")]
    with pytest.raises(ValueError, match="text"):
        T.conform(rows.drop("text"))


def test_conform_array_fills_missing(spark):
    df = spark.createDataFrame([("a", None), ("b", [])], f"file_path string, s {T.SEGMENTS}")
    assert [r.transcription for r in T.conform_array(df, "s").orderBy("file_path").collect()] == [[], []]


def test_merge_rows_in_order(spark):
    rows = spark.createDataFrame([(1, 2, "c"), (1, 0, "a"), (1, 1, "b")], "call int, turn int, text string")
    for parts in (1, 5):
        assert T.merge_rows(rows.repartition(parts), "call", "turn", "text").first().transcription == "a b c"
