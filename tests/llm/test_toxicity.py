import random
import zlib

import numpy as np

from tests_support import docs, edges  # noqa: F401

from callspark.llm import toxicity
from callspark.llm.toxicity import Settings, features_of_words, train, words_of

RUDE = ["idiot", "scum", "moron"]


def labelled(rng, n):
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.2
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 60))]
        if toxic:
            words[1] = rng.choice(RUDE)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_rows(spark, docs):
    rng = random.Random(1)
    rows, labels = labelled(rng, 900)
    documents = docs(rows)
    model = toxicity.fit(documents, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    truth = {i: t for i, _, t in labels}
    got = toxicity.score(documents, model).collect()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    kept = {r["doc_id"] for r in toxicity.without_toxic(documents, model).collect()}
    assert kept == {r["doc_id"] for r in got if not r["predicted"]}
    assert toxicity.without_toxic(documents, model).columns == documents.columns


def test_group_mentions_do_not_move_the_score():
    rng = random.Random(2)
    rows = []
    swap = {b"gay": b"straight", b"straight": b"gay"}
    names = {}

    def number(features):
        return sorted(names.setdefault(f, len(names)) for f in features)

    for i in range(800):
        toxic = i % 2
        words = {f"w{rng.randrange(100)}".encode() for _ in range(8)}
        if toxic and rng.random() < 0.7:
            words.add(rng.choice(RUDE).encode())
        if rng.random() < (0.9 if toxic else 0.1):  # one group is mentioned in insults
            words.add(b"gay")
        elif rng.random() < 0.5:
            words.add(b"straight")
        own = number(features_of_words(words))
        other = number(features_of_words({swap.get(w, w) for w in words})) if words & swap.keys() else None
        rows.append((toxic, own, other))

    def gap(fairness):
        bias, w = train(rows, len(names), Settings(fairness=fairness, sparsity=1e-4))
        a = sum(w[names[f]] for f in features_of_words({b"gay"}))
        b = sum(w[names[f]] for f in features_of_words({b"straight"}))
        rude = min(sum(w[names[f]] for f in features_of_words({x.encode()})) for x in RUDE)
        return abs(a - b), rude

    (free, _), (held, rude) = gap(0.0), gap(20.0)
    assert held < 0.1 * free and rude > 1


def test_edges(spark, docs, edges):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs(edges), none)
    got = toxicity.score(docs(edges), model).collect()
    assert len(got) == len(edges) and all(r["score"] == 0.0 and r["predicted"] == 0 for r in got)
    strange = spark.createDataFrame([(1, 1, None), (None, 1, 1), (4, 0, 1), (4, 0, 1), (99, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    toxicity.score(docs(edges), toxicity.fit(docs(edges), strange)).collect()
    assert toxicity.score(docs(edges).limit(0), model).collect() == []


def test_words_and_features():
    assert words_of("Ab-c É 9") == {b"ab", b"c", "É".encode(), b"9"}
    assert words_of(None) == set()
    assert np.all([f >= 0 for f in features_of_words({b"abcdefgh"})])


def test_decisions_do_not_depend_on_how_much_of_a_class_is_sampled(spark, docs):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(4000):
        toxic = rng.random() < 0.1
        words = [f"w{rng.randrange(300)}" for _ in range(20)]
        if rng.random() < (0.7 if toxic else 0.05):
            words.append("rude")
        if rng.random() < (0.5 if toxic else 0.1):
            words.append("borderline")  # a share of about 0.25 to 0.4 is toxic
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    asked = docs([(1, "w1 w2"), (2, "w1 borderline"), (3, "w1 rude"), (4, "w1 rude borderline")])

    def scores(**settings):
        model = toxicity.fit(docs(rows), table, Settings(**settings))
        return [r["score"] for r in toxicity.score(asked, model).orderBy("doc_id").collect()]

    whole, cut = scores(), scores(sample_positive=300, sample_negative=300)
    logits = [np.log(s) - np.log1p(-s) for s in (np.array(whole), np.array(cut))]
    assert np.abs(logits[0] - logits[1]).max() < 0.7, (whole, cut)
    assert [s >= 0.3 for s in whole] == [s >= 0.3 for s in cut], (whole, cut)


def test_a_feature_is_chosen_by_its_shares_not_by_the_number_of_rows(spark):
    once = [(i % 10 == 0, [1] if i % 20 == 0 else [2] if i % 7 == 0 else []) for i in range(400)]

    def chosen(times):
        rows = [(int(t), 1.0, own) for t, own in once * times]
        featured = spark.createDataFrame(rows, "toxic int, weight double, own array<long>")
        return toxicity._chosen(featured, Settings(identity_terms=()))

    assert chosen(1) == chosen(20) == [1, 2]
    assert toxicity._chosen(spark.createDataFrame([(int(t), 1.0, own) for t, own in once], "toxic int, weight double, own array<long>"), Settings(identity_terms=(), least_difference=1.0)) == [1]


def test_without_both_classes_nothing_is_rejected(spark, docs, edges, tmp_path):
    import corpus_pipeline

    documents = docs(edges)
    ones = [(i, 0, 1) for i in range(1, 9)]
    for k, rows in enumerate(([], ones, [(i, 0, 0) for i in range(1, 9)], [(99, 1, 1), (98, 1, 0)])):
        spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{k}/labels.parquet")
        left = corpus_pipeline.toxic_documents(spark, documents, f"{tmp_path}/{k}")
        assert left.columns == documents.columns and sorted(map(str, left.collect())) == sorted(map(str, documents.collect()))
        model = toxicity.fit(documents, spark.read.parquet(f"{tmp_path}/{k}/labels.parquet"))
        assert [(r["score"], r["predicted"]) for r in toxicity.score(documents, model).collect()] == [(0.0, 0)] * len(edges)


def test_an_id_is_learned_from_once(spark, docs):
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{rng.randrange(50)}" for _ in range(9))) for i in range(60)]
    many = rows + [(8, f"again {i % 40}") for i in range(10_000)]
    labels = spark.createDataFrame([(i, 1, i % 4 // 2) for i in range(60)] * 3, "doc_id long, quality int, toxic int")
    sampled = toxicity._sample(docs(many), labels, Settings()).collect()
    assert len(sampled) == len({r["__id"] for r in sampled}) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(60))
    again = toxicity._sample(docs(many[::-1]).repartition(7), labels, Settings()).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, sampled))


def test_predicted_follows_the_score(spark, docs, edges):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 9)], "doc_id long, quality int, toxic int")
    for r in toxicity.score(docs(edges), toxicity.fit(docs(edges), labels)).collect():
        assert r["predicted"] == int(r["score"] >= 0.3)


def plain_training(rows, width, settings, steps=200_000):
    """The same loss, by small plain steps on dense matrices."""
    x, y = np.zeros((len(rows), width)), np.array([r[0] for r in rows], float)
    change = []
    for i, (_, own, swapped) in enumerate(rows):
        x[i, own] = 1
        if swapped is not None:
            d = np.zeros(width)
            d[swapped] += 1
            d[own] -= 1
            change.append(d)
    change = np.array(change)
    w, bias, step = np.zeros(width), 0.0, 0.05
    for _ in range(steps):
        error = (1 / (1 + np.exp(-(x @ w + bias))) - y) / len(rows)
        g = x.T @ error + 2 * settings.fairness * change.T @ (change @ w) / len(change)
        w, bias = w - step * g, bias - step * error.sum()
        w = np.sign(w) * np.maximum(np.abs(w) - step * settings.sparsity, 0)
    return bias, w


def test_training_equals_plain_steps():
    rng = random.Random(1)
    rows = []
    for i in range(80):
        own = sorted(rng.sample(range(12), 4))
        rows.append((int(0 in own or rng.random() < 0.2), own, sorted({(f + 1) % 12 if f > 8 else f for f in own}) if i % 3 == 0 else None))
    settings = Settings(fairness=0.5, sparsity=5e-3, rounds=4000)
    (bias, w), (plain_bias, plain_w) = train(rows, 12, settings), plain_training(rows, 12, settings)
    assert abs(bias - plain_bias) < 0.002 and np.abs(w - plain_w).max() < 0.002
