import math
import random
import time
from collections import Counter

import pytest

from callspark.functions import textmetrics as M
from callspark.operators import textmetrics as T


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


def bleu(r, h):
    logs = 0.0
    for n in range(1, 5):
        grams = [Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) for w in (r, h)]
        hits = sum((grams[0] & grams[1]).values())
        if not hits:
            return 0.0
        logs += math.log(hits / sum(grams[1].values()))
    return math.exp(logs / 4) * (1.0 if len(h) > len(r) else math.exp(1 - len(r) / len(h)))


def pairs():
    rng = random.Random(7)
    words = ["é", "the", "cat", "sat", "on", "mat", "a", "x"]
    fixed = [
        ("same text here now", "same text here now"), ("", "a b"), ("a b", ""), ("", ""), ("a b c d e", "a b x d e"),
        ("p q", "r s"), ("a b c", "a b c"), ("a a a a a", "a a a a"), ("the the the cat", "the the cat the cat"),
    ]
    made = [
        (" ".join(rng.choices(words, k=rng.randrange(1, 25))), " ".join(rng.choices(words, k=rng.randrange(1, 25))))
        for _ in range(60)
    ]
    return fixed + made


@pytest.fixture(scope="module")
def results(spark):
    df = spark.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(pairs())], f"file int, {T.REFERENCE} string, {T.HYPOTHESIS} string"
    )
    return [r.asDict() for r in T.with_metrics(df).orderBy("file").collect()]


def test_all_metrics_equal_plain_loops(results):
    for row, (a, b) in zip(results, pairs()):
        x, y = a.split(), b.split()
        assert row["Levenshtein"] == edits(a, b)
        assert row["CER"] == (pytest.approx(edits(a, b) / len(a)) if a else None)
        assert row["WER"] == (pytest.approx(edits(x, y) / len(x)) if x else None)
        common = len(set(x) & set(y))
        p, r = (common / len(set(x)) if x else 0.0), (common / len(set(y)) if y else 0.0)
        assert (row["Precision"], row["Recall"]) == (pytest.approx(p), pytest.approx(r))
        assert row["F1_Score"] == (pytest.approx(2 * p * r / (p + r)) if p + r else None)
        assert row["BLEU"] == pytest.approx(bleu(x, y), abs=1e-12)


def test_word_distance_beyond_one_byte_of_words(spark):
    words = [f"w{i}" for i in range(60_000)]
    a, b = " ".join(words[:10]), " ".join(words[5:10] + ["new"])
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(M.word_edits("a", "b").alias("e")).first().e == edits(a.split(), b.split())
    many = spark.createDataFrame([(" ".join(words), "w59999")], "a string, b string")
    assert many.select(M.word_edits("a", "b").alias("e")).first().e == 59_999


def test_pair_runs_names(spark):
    one = spark.createDataFrame([("f", "x", 1.0)], "file string, transcription string, t double")
    got = T.pair_runs(one, one)
    assert got.columns == ["file", "transcription_medium", "t_medium", "transcription_large", "t_large"]


def test_metrics_need_no_shuffle(spark):
    from conftest import plan

    df = spark.createDataFrame([(1, "a", "b")], f"file int, {T.REFERENCE} string, {T.HYPOTHESIS} string")
    text = plan(T.with_metrics(df))
    assert "Exchange" not in text and "Python" not in text


def test_edits_within_equal_the_full_table():
    rng = random.Random(12)
    for _ in range(400):
        a = "".join(rng.choice("abc é") for _ in range(rng.randrange(40)))
        b = list(a)
        for _ in range(rng.randrange(8)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randrange(2)] = rng.choice(["", "x", "ab"])
        b = "".join(b) if rng.random() < 0.8 else "".join(rng.choice("abc") for _ in range(rng.randrange(30)))
        want = edits(a, b)
        for most in (0, 1, 3, 10, 100):
            assert T.edits_within(a, b, most) == (want if want <= most else None)


def test_long_texts_with_few_edits_take_no_time(spark):
    rng = random.Random(13)
    text = "".join(rng.choice("abcdefg é") for _ in range(200_000))
    other = list(text)
    for at in rng.sample(range(200_000), 10):
        other[at] = "#"
    df = spark.createDataFrame([("a", text, "".join(other)), ("b", text, text[5:]), ("c", "kitten", "sitting"), ("d", None, "x"), ("e", "", "abc")], f"file string, {T.REFERENCE} string, {T.HYPOTHESIS} string")
    assert T.edits_within(text, "".join(other), 6000) == 10
    begin = time.perf_counter()
    assert T.edits_within(text, "".join(other), 6000) == 10
    assert time.perf_counter() - begin < 1
    short = df.filter("file = 'c'")
    assert T.with_metrics(short, long=2).select(sorted(T.METRICS)).collect() == T.with_metrics(short).select(sorted(T.METRICS)).collect()
    got = {r.file: r.Levenshtein for r in T.levenshtein(df).select("file", "Levenshtein").collect()}
    assert got == {"a": 10, "b": 5, "c": 3, "d": None, "e": 3}


def test_edits_between_equal_the_full_table():
    rng = random.Random(14)
    for _ in range(1500):
        a, b = ("".join(rng.choices("abc é", k=rng.randrange(rng.choice([2, 12, 90])))) for _ in range(2))
        assert T.edits_between(a, b) == edits(a, b)
        assert T.edits_between(a.split(), b.split()) == edits(a.split(), b.split())


def test_long_texts_with_many_edits_take_no_time(spark):
    rng = random.Random(15)
    a, b = ("".join(rng.choices("abcdefg é", k=20_000)) for _ in range(2))
    begin = time.perf_counter()
    T.edits_between(a, b)
    assert time.perf_counter() - begin < 2  # 400 million places


def test_measured_equals_the_built_in_metrics(spark):
    from conftest import plan

    odd = [(None, "a b"), ("a b", None), (None, ""), ("", None), (None, None), ("a\x1cb c", "a b\x1cc"), ("a\u00a0b", "a b"), ("a\u2003b\x0bc", "a c")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs() + odd)], f"file int, {T.REFERENCE} string, {T.HYPOTHESIS} string")
    built_in, counted = T.with_metrics(df), T.measured(df)
    assert "ArrowEvalPython" in plan(counted)
    columns = ["file", *T.METRICS]
    assert dict(counted.dtypes) == dict(built_in.dtypes)
    assert counted.select(columns).orderBy("file").collect() == built_in.select(columns).orderBy("file").collect()
    assert T.levenshtein(df).select("file", "Levenshtein").orderBy("file").collect() == built_in.select("file", "Levenshtein").orderBy("file").collect()
