"""No query changes a setting of the session, whatever ran before it."""

from tests_support import docs, edges  # noqa: F401

from callspark.llm import fill_middle, html_text, jaccard_join, language_model, repeat_removal, secret_scan, toxicity


def settings(spark):
    return {r["key"]: r["value"] for r in spark.sql("SET").collect()}


def test_settings_stay_as_they_are(spark, docs, edges):
    few = docs([r for r in edges if r[1] is None or len(r[1]) < 1000])
    labels = spark.createDataFrame([(4, 1, 1), (7, 1, 0)], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id long, url string, html string")
    steps = [
        lambda: toxicity.score(few, toxicity.fit(few, labels)), lambda: repeat_removal.report(few), lambda: secret_scan.find(few),
        lambda: html_text.extract(pages), lambda: jaccard_join.linked(few), lambda: fill_middle.transformed(few),
        lambda: language_model.score(few, language_model.train(few)),
    ]
    before = settings(spark)
    for step in steps + steps[::-1]:
        step().collect()
        assert settings(spark) == before
