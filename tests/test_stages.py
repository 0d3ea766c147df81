"""Versioned stages: published by a commit, resumed by the next run."""

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from callspark.plans import chain
from callspark.sources.stages import Stages, fingerprint


def test_the_last_commit_is_read(spark, tmp_path):
    stages = Stages(spark, f"{tmp_path}/s")
    assert stages.commits("x") == [] and stages.versions("x") == []
    with pytest.raises(FileNotFoundError):
        stages.read("x")
    first = stages.write("x", spark.range(3))
    held = stages.read("x")  # a reader that started before the next run
    second = stages.write("x", spark.range(5).withColumn("y", F.lit("z")))
    assert stages.versions("x") == [second, first]
    assert stages.read("x").count() == 5 and stages.read("x").columns == ["id", "y"]
    assert held.count() == 3 and stages.read("x", first).count() == 3
    with pytest.raises(FileNotFoundError):
        stages.read("x", "v-none")


def test_a_version_without_commit_is_not_read(spark, tmp_path):
    stages = Stages(spark, f"{tmp_path}/s")
    spark.range(9).write.parquet(f"{tmp_path}/s/x/v-half")  # a run that ended before its commit
    assert stages.versions("x") == []
    stages.write("x", spark.range(2))
    assert stages.read("x").count() == 2


def test_run_computes_once_per_fingerprint(spark, tmp_path):
    stages, made = Stages(spark, f"{tmp_path}/s"), []

    def make(n):
        made.append(n)
        return spark.range(n)

    assert [stages.run("x", f, lambda n=n: make(n)).count() for f, n in (("a", 1), ("a", 2), ("b", 3), ("a", 4))] == [1, 1, 3, 1]
    assert made == [1, 3]


def test_retired_versions_are_empty_and_made_again(spark, tmp_path):
    stages = Stages(spark, f"{tmp_path}/s")
    for n in (1, 2, 3):
        stages.run("x", str(n), lambda n=n: spark.range(n))
    old = stages.versions("x")[1:]
    assert stages.retire("x") == 2 and stages.retire("x") == 0
    assert stages.read("x").count() == 3 and len(stages.versions("x")) == 1
    assert all(spark.read.parquet(f"{tmp_path}/s/x/{v}").count() == 0 for v in old)
    assert stages.run("x", "1", lambda: spark.range(7)).count() == 7


def test_fingerprint_tells_rows_apart(spark):
    a = spark.createDataFrame([(1, "x", {"k": [1]}), (2, None, None)], "id int, t string, m map<string,array<int>>")
    assert fingerprint(a, 0.4) == fingerprint(a.orderBy(F.desc("id")).repartition(3), 0.4)
    others = [a.limit(1), a.union(a), a.withColumn("t", F.lit("y")), a.withColumnRenamed("t", "u"), a.drop("m")]
    assert len({fingerprint(x, 0.4) for x in [a, *others]} | {fingerprint(a, 0.5), fingerprint(a)}) == 8
    assert fingerprint(spark.range(0)) == fingerprint(spark.range(0))


def test_a_run_that_ended_between_stages_goes_on(spark, tmp_path, monkeypatch):
    from test_report import chain_inputs

    transcripts, metadata, master, taxonomy = chain_inputs(spark)
    whole = chain.run_all(spark, transcripts, metadata, master, taxonomy, f"{tmp_path}/whole", 0.1)
    done = []

    def counted(module, function, name):
        plain = getattr(module, function)
        monkeypatch.setattr(module, function, lambda *a, **k: (done.append(name), plain(*a, **k))[1])

    for module, function in ((chain.R, "redact_segments"), (chain.summarize, "summarize_calls"), (chain.topics, "assign_topics"), (chain.insights, "extract")):
        counted(module, function, function)

    def lost(*_, **__):
        raise RuntimeError("the driver went away")

    with monkeypatch.context() as broken:
        broken.setattr(chain.sentiment, "segments", lost)
        with pytest.raises(RuntimeError):
            chain.run_all(spark, transcripts, metadata, master, taxonomy, f"{tmp_path}/run", 0.1)
    assert done == ["redact_segments", "summarize_calls", "assign_topics"]
    done.clear()
    resumed = chain.run_all(spark, transcripts, metadata, master, taxonomy, f"{tmp_path}/run", 0.1)
    assert done == ["extract"] and tuples(resumed) == tuples(whole)
    done.clear()
    assert tuples(chain.run_all(spark, transcripts, metadata, master, taxonomy.limit(1), f"{tmp_path}/run", 0.1)) is not None
    assert done == ["assign_topics"]  # another taxonomy: this stage alone
    done.clear()
    assert tuples(chain.run_all(spark, transcripts, metadata, master, taxonomy, f"{tmp_path}/run", 0.1, resume=False)) == tuples(whole)
    assert len(done) == 4
