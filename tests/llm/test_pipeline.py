import pytest

import corpus_pipeline
from __spark_entry__ import queries
from callspark.llm import decontaminate, jaccard_join, toxicity


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    removed = []
    for name, stage in corpus_pipeline.STAGES[:-2]:
        out = corpus_pipeline.written(stage(spark, docs, sf), f"test-{name}")
        assert out.columns == columns
        after = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert after <= before and out.count() == len(after)
        if name == "toxicity":
            scored = toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet")))
            assert before - after == {r["doc_id"] for r in scored.filter("predicted = 1").collect()}
        elif name == "jaccard_join":
            assert after == {r["doc_id"] for r in jaccard_join.linked(docs).filter("doc_id = component_id").collect()}
        else:
            report = decontaminate.report(docs, spark.read.parquet(f"{sf}/benchmark.parquet"))
            assert before - after == {r["doc_id"] for r in report.filter("contaminated").collect()}
        removed.append(before - after)
        docs, before = out, after
    assert all(removed)


def test_run_gives_shards(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and {r["shard"] for r in rows} <= set(range(16))


def test_names():
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in queries()) == 1
    assert "pipeline" in queries()


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty(spark, sf, name):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    assert dict(corpus_pipeline.STAGES)[name](spark, docs, sf).collect() == []
