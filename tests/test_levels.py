"""Trees of texts, level by level, through a predictor."""

import random
import sys

import pandas as pd
import pytest
from conftest import plan
from pyspark import cloudpickle
from test_models import counted, tree_by_recursion

from callspark.operators import levels, summarize

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def every_third(t):
    return " ".join(t.split()[::3])


class Counting(levels.TextPredictor):
    """Tells how many rows it was given at once."""

    def predict(self, batch):
        return pd.DataFrame({"result": [f"{every_third(t)} n{len(batch)}" for t in batch["piece"]]})


class Failing(levels.TextPredictor):
    def predict(self, batch):
        if batch["piece"].str.contains("w13 ").any():
            raise ValueError("no")
        return super().predict(batch)


TEXTS = [" ".join(f"w{i}" for i in range(n)) for n in (1, 19, 20, 45, 120, 300, 2000)]


def test_runs_equal_halving():
    rng = random.Random(2)
    for _ in range(300):
        sizes = [rng.randrange(0, 9) for _ in range(rng.randrange(1, 30))]
        parts = [" ".join([f"p{i}"] * n) for i, n in enumerate(sizes)]
        starts = levels.runs(sizes, 20)
        together = [" ".join(parts[i] for i in range(len(parts)) if starts[i] == s) for s in dict.fromkeys(starts)]
        assert [t.split() for t in together] == [t.split() for t in summarize.halves(parts, 20)]


def test_tree_equals_recursion(spark):
    made = levels.tree(counted(spark, *TEXTS), lambda: levels.TextPredictor(every_third), "id", max_tokens=20, chunk=(12, 15, 2), into="s")
    assert {r.id: r.s for r in made.collect()} == {i: tree_by_recursion(t, every_third, 20, 12, 15, 2) for i, t in enumerate(TEXTS)}


def test_batches_go_across_calls(spark):
    texts = [" ".join(f"a{j}" for j in range(30)) for _ in range(40)]  # three chunks each
    df = counted(spark, *texts).coalesce(1)
    first = levels.pieces(df, "id", "transcription", 20, (12, 15, 2))
    assert first.count() == 120 and first.groupBy("id").count().filter("count != 3").isEmpty()
    made = levels.tree(df, lambda: Counting(), "id", max_tokens=20, chunk=(12, 15, 2), into="s", batch_size=16)
    seen = {w for r in made.collect() for w in r.s.split() if w.startswith("n")}
    assert "n16" in seen  # five calls and more in one batch


def test_a_long_call_is_spread_over_tasks(spark):
    df = counted(spark, " ".join(f"w{i}" for i in range(20_000)))
    made = levels.tree(df, lambda: levels.TextPredictor(every_third), "id", max_tokens=20, chunk=(12, 15, 2), into="s", partitions=6)
    assert made.first().s == tree_by_recursion(df.first().transcription, every_third, 20, 12, 15, 2)
    chunked = levels.pieces(df, "id", "transcription", 20, (12, 15, 2)).repartition(6)
    assert chunked.rdd.getNumPartitions() == 6 and chunked.count() == 1667


def test_failures_and_nulls(spark):
    df = spark.createDataFrame([(1, "w1 w13 w2"), (2, None), (None, "w5 w6"), (3, ""), (4, "w7")], "id int, transcription string")
    from callspark.functions.text import token_count

    df = df.withColumn("token_count", token_count("transcription"))
    made = levels.tree(df, lambda: Failing(every_third), "id", fallback={"result": "unreadable"}, into="s")
    assert {(r.id, r.s) for r in made.collect()} == {(1, "unreadable"), (2, None), (None, None), (3, ""), (4, "w7")}
    assert levels.tree(df.limit(0), lambda: Failing(every_third), "id", into="s").count() == 0


def test_actions_by_a_predictor(spark):
    say = "I checked it. "
    df = counted(spark, say + "w " * 500 + say, "w " * 500, "w. " * 3 + say)
    got = {r.id: r.actions_taken for r in levels.actions(df, key="id", max_tokens=100, chunk=(60, 80, 5)).collect()}
    assert got[0].count("I checked it") == 2 and got[1] == "No actions generated" and got[2] == "I checked it"
    assert got == {r.id: r.actions_taken for r in summarize.actions_tree(df, max_tokens=100, chunk=(60, 80, 5)).collect()}


@pytest.mark.parametrize("budget", [1, 5, 10**9])
def test_joined_keeps_all_words_in_order(spark, budget):
    rows = [(k, p, f"k{k}p{p} " * (p % 3)) for k in range(3) for p in range(9)]
    df = spark.createDataFrame(rows, "k int, position int, result string")
    for key, parts in levels.joined(df, "k", budget).toPandas().sort_values("position").groupby("k"):
        assert " ".join(parts["piece"]).split() == " ".join(r[2] for r in rows if r[0] == key).split()
    assert "Window" not in plan(levels.joined(df, "k", budget))
