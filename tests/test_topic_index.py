"""Matching against large taxonomies: balls around pivots, best matches per call, prefixes of word counts."""

import math
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import plan
from pyspark.sql import functions as F

from callspark.operators import topics

DIM = 16


def clustered(rng, n, centres, spread=0.15):
    at = rng.integers(0, len(centres), n)
    return centres[at] + spread * rng.standard_normal((n, centres.shape[1]))


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, DIM))
    topic_rows, sentence_rows = clustered(rng, 300, centres), clustered(rng, 400, centres)
    topic_rows[7] = 0.0
    sentence_rows[11] = 0.0
    taxonomy = spark.createDataFrame(
        [(i, f"t{i}", v.tolist()) for i, v in enumerate(topic_rows)] + [(900, "none", None)],
        "topic_num int, topic string, embedding array<double>",
    )
    sentences = spark.createDataFrame(
        [(f"c{i % 40}", i // 40, v.tolist()) for i, v in enumerate(sentence_rows)] + [("c1", 99, None), (None, 0, sentence_rows[0].tolist())],
        "file_path string, position int, embedding array<double>",
    )
    return sentence_rows, topic_rows, sentences, taxonomy


def cosines(a, b):
    with np.errstate(invalid="ignore", divide="ignore"):
        return (a / np.linalg.norm(a, axis=1, keepdims=True)) @ (b / np.linalg.norm(b, axis=1, keepdims=True)).T


@pytest.mark.parametrize("threshold", [-0.5, 0.0, 0.4, 0.9])
def test_balls_keep_all_pairs(vectors, threshold, monkeypatch):
    rows, topic_rows, sentences, taxonomy = vectors
    cos = cosines(rows, topic_rows)
    want = {(f"c{s % 40}", s // 40, t): cos[s, t] for s, t in zip(*np.nonzero(cos > threshold), strict=True)}
    want |= {(None, 0, t): cos[0, t] for t in np.flatnonzero(cos[0] > threshold)}
    for group_rows, ball_rows in ((20_000, 20_000), (50, 7)):  # crowded balls are dealt over tasks
        monkeypatch.setattr(topics, "GROUP_ROWS", group_rows)
        monkeypatch.setattr(topics, "BALL_ROWS", ball_rows)
        got = topics.match(sentences, taxonomy, threshold, max_components=20 * DIM).collect()
        assert len(got) == len(want)
        assert {(r.file_path, r.position, r.topic_num): r.cos_sim for r in got} == pytest.approx(want)


def test_copies_shrink_with_the_threshold(vectors):
    _, _, sentences, taxonomy = vectors
    balls = topics.cut_into_balls(taxonomy.filter("embedding IS NOT NULL"), 300, 300 * DIM, max_components=150 * DIM)
    narrow = sentences.filter("embedding IS NOT NULL")
    copies = [topics.in_reach(narrow, balls, t).count() for t in (-1.0, 0.2, 0.5, 0.8, 0.95)]
    assert copies == sorted(copies, reverse=True)
    assert copies[0] == 400 * len(balls.pivots) and copies[-1] < copies[0] / 4  # the sentence without length reaches none
    assert len(balls.pivots) <= 20 and balls.sizes.sum() == 299


def test_no_product_of_groups_and_blocks(vectors):
    _, _, sentences, taxonomy = vectors
    text = plan(topics.match(sentences, taxonomy, 0.5, max_components=20 * DIM))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_only_topics_without_length(spark):
    sentences = spark.createDataFrame([("c", 0, [1.0, 0.0])], "file_path string, position int, embedding array<double>")
    taxonomy = spark.createDataFrame([(i, "z", [0.0, 0.0]) for i in range(9)], "topic_num int, topic string, embedding array<double>")
    assert topics.match(sentences, taxonomy, 0.1, max_components=4).count() == 0


@pytest.mark.parametrize("max_components", [8_000_000, 20 * DIM])
def test_best_matches_equal_ranking_of_all(vectors, max_components):
    _, _, sentences, taxonomy = vectors
    every = topics.top_candidates(topics.match(sentences, taxonomy, 0.0), 5)
    best = topics.best_matches(sentences, taxonomy, 0.0, 5, max_components=max_components)
    columns = ["file_path", "position", "topic_num", "topic", F.round("cos_sim", 9).alias("c"), "rank"]
    assert sorted(map(tuple, best.select(*columns).collect()), key=repr) == sorted(map(tuple, every.select(*columns).collect()), key=repr)


def test_few_rows_leave_python(vectors):
    _, _, sentences, taxonomy = vectors
    one_task = sentences.coalesce(1)
    left = topics.match(one_task, taxonomy, 0.0, per_call=3).groupBy("file_path").count().collect()
    assert len(left) == 41 and all(r["count"] <= 3 for r in left)  # one batch: at most three for each call
    assert topics.match(one_task, taxonomy, 0.0).count() > 20 * sum(r["count"] for r in left)


def test_thresholds_of_calls_are_fed_back():
    import pandas as pd

    best = topics._BestOfCall(2, "c", "p")
    first = best(pd.DataFrame({"c": ["a", "a", "a", "b"], "p": [0, 1, 2, 0], "topic_num": [1, 1, 1, 1], "cos_sim": [0.5, 0.9, 0.7, 0.1]}))
    assert first["cos_sim"].tolist() == [0.9, 0.7, 0.1]
    assert best.floors(pd.Series(["a", "b", "new"])).tolist() == [0.7, -np.inf, -np.inf]
    best(pd.DataFrame({"c": ["a"], "p": [5], "topic_num": [1], "cos_sim": [0.8]}))
    assert best.floors(pd.Series(["a"])).tolist() == [0.8]


# --- words ----------------------------------------------------------------------------------------


def bags(rng, n, words, length, also=""):
    return [" ".join([also] * bool(also) + [f"w{int(rng.paretovariate(0.6)) % words}" for _ in range(rng.randrange(1, length))]) for _ in range(n)]


def plain_cosine(a, b):
    x, y = Counter(a.lower().split()), Counter(b.lower().split())
    return sum(x[w] * y[w] for w in x) / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))


@pytest.mark.parametrize("threshold", [0.0, 0.3, 0.6])
def test_prefixes_keep_all_pairs(spark, threshold):
    rng = random.Random(4)
    texts, names = bags(rng, 120, 90, 12, "the"), bags(rng, 60, 70, 8, "the")
    sentences = spark.createDataFrame([("c", i, t) for i, t in enumerate(texts)], "file_path string, position int, sentence string")
    taxonomy = spark.createDataFrame([(i, f"t{i}", t) for i, t in enumerate(names)], "topic_num int, topic string, description string")
    want = {(i, j): c for i, a in enumerate(texts) for j, b in enumerate(names) if (c := plain_cosine(a, b)) > threshold}
    got = topics.match_words(sentences, taxonomy, threshold, max_words=0).collect()
    assert {(r.position, r.topic_num): r.cos_sim for r in got} == pytest.approx(want) and len(got) == len(want)


def test_a_word_that_is_everywhere_joins_few_rows(spark):
    sentences = spark.createDataFrame(
        [("c", i, f"the the call a{i} b{i} c{i} d{i} e{i}") for i in range(400)], "file_path string, position int, sentence string"
    )
    taxonomy = spark.createDataFrame(
        [(i, "t", f"the a{i} b{i} c{i} d{i} e{i} x{i} y{i}") for i in range(400)], "topic_num int, topic string, description string"
    )
    keys, topic = ["file_path", "position"], ["topic_num", "topic"]
    weights, lengths = topics._bag(taxonomy, topic, "description")
    pairs = topics.word_candidates(*topics._bag(sentences, keys, "sentence"), weights.join(lengths, topic), keys, topic, 0.5)
    assert pairs.count() == 400  # of 160,000 pairs that share a word
    found = defaultdict(list)
    for r in topics.match_words(sentences, taxonomy, 0.5, max_words=0).collect():
        found[r.position].append(r.topic_num)
    assert found == {i: [i] for i in range(400)}


@pytest.mark.parametrize("max_words", [0, 1_000_000])
def test_equal_cosines_are_equal_to_the_last_bit(spark, max_words):
    # a x, and a and y so many times over, are as near to every sentence with one a
    sentences = spark.createDataFrame(
        [(f"c{n}", 0, "a " + " ".join(f"b{i}" for i in range(n))) for n in range(2, 24)], "file_path string, position int, sentence string"
    )
    taxonomy = spark.createDataFrame(
        [(m, f"t{m}", "a " * m + f"x{m} " * m) for m in (1, 2, 3, 5, 6)],
        "topic_num int, topic string, description string",
    )
    matches = topics.match_words(sentences, taxonomy, 0.1, max_words=max_words)
    for r in matches.groupBy("file_path").agg(F.collect_set("cos_sim").alias("c"), F.count("*").alias("n")).collect():
        assert len(r.c) == 1 and r.n == 5
    assert {r.topic_num for r in topics.top_candidates(matches, 1).collect()} == {1}


def test_long_texts_meet_a_long_description_by_hashing(spark):
    words = [f"w{i}" for i in range(50_000)]
    sentences = spark.createDataFrame([("c", 0, " ".join(words + words[:7]))], "file_path string, position int, sentence string")
    taxonomy = spark.createDataFrame([(1, "t", " ".join(words[::-1] + words[:3]))], "topic_num int, topic string, description string")
    begin = time.time()
    got = topics.match_words(sentences, taxonomy, 0.5, max_words=0).collect()
    assert time.time() - begin < 15
    dot, a, b = 50_000 - 7 + 3 * 4 + 4 * 2, 50_000 + 3 * 7, 50_000 + 3 * 3
    assert [r.cos_sim for r in got] == [pytest.approx(dot / math.sqrt(a * b), abs=1e-12)]
