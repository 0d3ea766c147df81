import math
import re
from collections import Counter

import pandas as pd
import pytest
from conftest import plan, tuples
from pyspark.sql import functions as F

from callspark.operators import infer, insights, sentiment, summarize, topics
from callspark.operators.transcripts import SEGMENTS, with_counts


def test_map_predict_falls_back_per_row(spark):
    class Upper:
        def setup(self):
            self.ready = True

        def predict(self, batch):
            if batch["t"].str.contains("bad").any():
                raise ValueError("bad row")
            return pd.DataFrame({"u": batch["t"].str.upper()})

    df = spark.createDataFrame([(i, "bad" if i == 3 else f"t{i}") for i in range(25)], "id int, t string").coalesce(1)
    got = {r.id: r for r in infer.map_predict(df, Upper, "u string", 10, {"u": "none"}).collect()}
    assert len(got) == 25 and got[4].u == "T4" and got[4].error is None
    assert got[3].u == "none" and got[3].error == "ValueError: bad row"
    assert all(r.processing_time >= 0 for r in got.values())
    assert infer.map_predict(df, Upper, "u string", partitions=4).count() == 25
    with pytest.raises(ValueError, match="already present"):
        infer.map_predict(df, Upper, "t string")


# --- sentiment


def majority_by_loop(text):
    labels = []
    for sentence in __import__("re").split("[.!?] ", text):
        total = sum(sentiment.LEXICON.get(w, 0) for w in __import__("re").findall(r"\w+", sentence.lower()))
        labels.append("Positive" if total > 0 else "Negative" if total < 0 else "Neutral")
    return Counter(labels).most_common(1)[0][0]


SENTIMENTS = [
    "Good day. This is terrible! Great.", "This is bad. Great!", "Great! This is bad. ", "nothing here", "",
    "good bad. slow. thanks, quick", "Good. Bad. Hello. Well",
]


def test_sentiment_majority_and_ties(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(SENTIMENTS)], "id int, t string")
    got = {r.id: r.s for r in df.select("id", sentiment.label_text(F.col("t")).alias("s")).collect()}
    assert got == {i: majority_by_loop(t) for i, t in enumerate(SENTIMENTS)}
    lexicon = spark.createDataFrame(list(sentiment.LEXICON.items()), "word string, score int")
    for rows in (1, 4_000_000):
        table = sentiment.label_rows(df, ["id"], "t", lexicon, rows_per_task=rows)
        assert {r.id: r.sentiment for r in table.collect()} == got


def test_sentiment_of_an_empty_call(spark):
    df = spark.createDataFrame([("a", []), ("b", [(0.0, 1.0, "great", None)])], f"file_path string, transcription {SEGMENTS}")
    got = {r.file_path: r for r in sentiment.segments(df).collect()}
    assert got["a"].sentiment_note == "No Sentiment Identified" and got["a"].sentiment == []
    assert got["b"].sentiment_note is None and got["b"].sentiment[0].sentiment == "Positive"
    assert "Exchange" not in plan(sentiment.segments(df))


def test_majority_first_seen_wins(spark):
    rows = spark.createDataFrame([("c", "x", 2), ("c", "y", 1), ("c", "x", 4), ("c", "y", 3), ("d", "z", 0)], "c string, l string, p int")
    assert tuples(sentiment.majority(rows, ["c"], "l", "p")) == [("c", "y"), ("d", "z")]


# --- topics


@pytest.fixture(scope="module")
def taxonomy(spark):
    rows = [(i, f"t{i}", [1.0 if j == i else 0.0 for j in range(12)]) for i in range(12)]
    return spark.createDataFrame(rows, "topic_num int, topic string, embedding array<double>")


def test_match_threshold_is_strict(spark, taxonomy):
    # cosine with t0 is exactly 0.6 and with t1 exactly 0.8
    rows = [("c", 0, [0.6, 0.8] + [0.0] * 10), ("zero", 0, [0.0] * 12)]
    sentences = spark.createDataFrame(rows, "file_path string, position int, embedding array<double>")
    assert tuples(topics.match(sentences, taxonomy, 0.6), "file_path", "topic") == [("c", "t1")]
    assert tuples(topics.match(sentences, taxonomy, 0.5), "topic") == [("t0",), ("t1",)]
    assert tuples(topics.match(sentences, taxonomy, 0.5, max_components=24), "topic") == [("t0",), ("t1",)]
    empty = topics.match(sentences, taxonomy.limit(0), 0.5)
    assert empty.count() == 0 and "cos_sim" in empty.columns


def test_topic_assignment_cases(spark):
    matches = spark.createDataFrame(
        [("many", p, p % 11, f"t{p % 11}", 0.5 + p / 100) for p in range(11)] + [("one", 0, 3, "t3", 0.9)]
        + [("same", 0, 5, "t5", 0.9), ("same", 1, 5, "t5", 0.8), ("same", 2, 6, "t6", 0.7)],
        "file_path string, position int, topic_num int, topic string, cos_sim double",
    )
    top = topics.top_candidates(matches)
    assert top.filter("file_path = 'many'").count() == 10
    calls = spark.createDataFrame([("many",), ("one",), ("same",), ("no",)], "file_path string")
    got = {r.file_path: r.topics for r in topics.assign(top, calls).collect()}
    assert got == {"many": ["t10", "t9"], "one": ["t3", "None"], "same": ["t5", "t6"], "no": ["Unidentified", "None"]}
    assert "WindowGroupLimit" in plan(top)


def test_cosine_symmetric(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, -1.0]), ([1.0, 1.0], [3.0, 3.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    got = [tuple(r) for r in df.select(topics.cosine("a", "b"), topics.cosine("b", "a")).collect()]
    assert got[0] == (0.0, 0.0) and got[1] == pytest.approx((1.0, 1.0)) and got[2] == (None, None)


def test_match_words_equals_loop(spark):
    texts = {0: "the bill is too high for me", 1: "my power is out again today", 2: "zzz"}
    names = {0: "bill payment high", 1: "power outage today"}
    sentences = spark.createDataFrame([("c", i, t) for i, t in texts.items()], "file_path string, position int, sentence string")
    taxonomy = spark.createDataFrame([(i, f"t{i}", t) for i, t in names.items()], "topic_num int, topic string, description string")

    def cos(a, b):
        x, y = Counter(a.split()), Counter(b.split())
        return sum(x[w] * y[w] for w in x) / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))

    expected = {(i, j): cos(a, b) for i, a in texts.items() for j, b in names.items() if cos(a, b) > 0.1}
    for rows in (None, 1, 4_000_000):
        got = topics.match_words(sentences, taxonomy, 0.1, rows_per_task=rows, max_words=0 if rows else 1_000_000).collect()
        assert {(r.position, r.topic_num): r.cos_sim for r in got} == pytest.approx(expected)
    calls = spark.createDataFrame([("x", " ".join(texts.values())), ("y", "nothing to see here at all")], "file_path string, summary string")
    assigned = {r.file_path: r.topics for r in topics.assign_topics(calls, taxonomy, 0.1).collect()}
    assert assigned["y"] == ["Unidentified", "None"] and set(assigned["x"]) == {"t0", "t1"}


# --- summaries


def counted(spark, *texts):
    return with_counts(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, transcription string"))


def test_summary_gates(spark):
    df = counted(spark, "w " * 50, "w " * 51, "", "w " * 3899, "w " * 3900, "w " * 3901)
    got = {r.id: r.s for r in summarize.summary(df, scorer=lambda t: str(len(t.split())), into="s").collect()}
    assert got == {
        0: "No summary generated", 1: "51", 2: "No summary generated", 3: "3899", 4: "3900", 5: "3250\n701"
    }


def test_action_gates(spark):
    say = "I checked it. "
    df = counted(spark, "w " * 40 + say, "w " * 60 + say, "w. " * 60, "w " * 3896 + say, "w " * 3897 + say)
    got = {r.id: r.actions_taken for r in summarize.actions(df).collect()}
    assert got[0] == got[2] == "No actions generated"
    assert all(got[i].endswith("I checked it") for i in (1, 3, 4))
    gated = {r.id: r.actions_taken for r in summarize.actions(df, max_tokens=3900).collect()}
    assert gated == got | {4: "No actions generated"}


def test_actions_of_long_calls(spark):
    say = "I checked it. "
    df = counted(spark, say + "w " * 500 + say, "w " * 500, "w. " * 3 + say)
    got = {r.id: r.actions_taken for r in summarize.actions_tree(df, max_tokens=100, chunk=(60, 80, 5)).collect()}
    assert got[0].count("I checked it") == 2 and got[1] == "No actions generated" and got[2] == "I checked it"


def tree_by_recursion(text, scorer, budget, size, most, overlap):
    from test_text import chunk_by_loop

    def combine(parts):
        joined = " ".join(parts)
        if len(joined.split()) < budget or len(parts) == 1:
            return scorer(joined)
        middle = len(parts) // 2
        return combine(parts[:middle]) + " " + combine(parts[middle:])

    if len(text.split()) < budget:
        return scorer(text)
    return combine([scorer(c) for c in chunk_by_loop(text.split(), size, most, overlap)])


def test_tree_equals_recursion(spark):
    def scorer(t):
        return " ".join(t.split()[::3])

    texts = [" ".join(f"w{i}" for i in range(n)) for n in (1, 19, 20, 45, 120, 300)]
    got = {r.id: r.s for r in summarize.tree(counted(spark, *texts), scorer=scorer, max_tokens=20, chunk=(12, 15, 2), into="s").collect()}
    assert got == {i: tree_by_recursion(t, scorer, 20, 12, 15, 2) for i, t in enumerate(texts)}


def test_extract_summary():
    text = "a a a b. c d! a b? e f g. a"
    assert summarize.extract_summary(text) == "a a a b. a b. a"
    assert summarize.extract_summary("x " * 200) == " ".join(["x"] * 200)
    assert summarize.extract_summary(text, words=5) == "a a a b"
    assert summarize.extract_summary("x " * 200, words=5) == " ".join(["x"] * 200)
    assert summarize.extract_summary("") == ""


# --- insights


def test_insights_gate_and_rules(spark):
    filler = "hello there " * 10
    df = spark.createDataFrame([
        (0, "w " * 19), (1, "w " * 20), (2, filler + "my power is out, this is urgent. I called before. Thank you"),
    ], "id int, transcription string")
    got = {r.id: r.asDict() for r in insights.extract(df).collect()}
    assert {got[0][f] for f in insights.FIELDS} == {"Not Generated"}
    assert got[1]["Category"] == "BILLING" and got[1]["Urgency"] == "Low"
    assert (got[2]["Category"], got[2]["Urgency"], got[2]["Repeated Issues"]) == ("POWER", "High", "Yes")
    assert got[2]["Satisfaction Score"] == "4"
    assert {r.value for r in insights.RULES if r.field == "Category"} <= set(insights.CATEGORIES)


def test_insights_parse(spark):
    answers = ['{"Summary": "s", "Main Issue": "m", "Extra": 1}', "{'Summary': 's'}", '{"Summary": "s"} thanks', "", None, '{"Satisfaction Score": 4}']
    df = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "id int, a string")
    got = {r.id: r.asDict() for r in insights.parse(df, "a").collect()}
    assert (got[0]["Summary"], got[0]["Main Issue"], got[0]["Category"]) == ("s", "m", None)
    for i in (1, 2, 3, 4):
        assert {got[i][f] for f in insights.FIELDS} == {"Not Generated"}
    assert got[5]["Satisfaction Score"] == "4"


def test_parse_list(spark):
    df = spark.createDataFrame([(0, "['a', \"b\"]"), (1, '["a"]'), (2, "a, b"), (3, None)], "id int, t string")
    assert {r.id: r.x for r in df.select("id", insights.parse_list("t").alias("x")).collect()} == {
        0: ["a", "b"], 1: ["a"], 2: None, 3: None
    }


def test_parse_literal(spark):
    texts = ["[{'a': 'x', 'b': None}, {'a': 'None, really', 'b': 'y'}]", '[{"a": "x"}]', "[1", "nothing"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = {r.id: r.x for r in df.select("id", insights.parse_literal("t", "array<struct<a:string,b:string>>").alias("x")).collect()}
    assert [tuple(x) for x in got[0]] == [("x", None), ("None, really", "y")]
    assert [tuple(x) for x in got[1]] == [("x", None)] and got[2] is None and got[3] is None
    counts = df.select(insights.parse_literal(F.lit("{'a': 1, 'b': 2}"), "map<string,int>").alias("x")).first().x
    assert counts == {"a": 1, "b": 2}


def test_results_leave_before_their_batch_ends(spark):
    from pyspark.sql import types as T

    from callspark.operators import levels

    class Table:
        schema, columns = T.StructType.fromDDL("k int, piece string"), ["k", "piece"]

        def mapInPandas(self, run, schema):
            return run

    run = infer.map_predict(Table(), lambda: levels.TextPredictor(str.upper), "result string", batch_size=200)
    rows = pd.DataFrame({"k": range(2100), "piece": [f"t{i}" for i in range(2100)]})
    parts = list(run(iter([rows])))
    assert max(map(len, parts)) <= infer.ROWS_OUT + 200 and len(parts) > 2
    assert pd.concat(parts)["result"].tolist() == [f"T{i}" for i in range(2100)]


def test_scorer_takes_texts_row_by_row(spark):
    df = spark.createDataFrame([(1, "a b c. d e f", 6)], "id int, transcription string, token_count int")
    made = summarize.tree(df)
    kinds = set(re.findall(r"ArrowEvalPython \[.*\], \[.*\], (\d+)", plan(made)))
    assert kinds == {"250"}, plan(made)  # 200 would be a function of whole pandas columns
    assert {r.id: r.summary for r in made.collect()} == {1: "a b c. d e f"}


def test_summary_and_main_issue_come_from_one_scoring():
    for text in ("a b. a. a a a b. c", "", "x " * 200, "One two. two one! three? Two", ". . ."):
        both = summarize.extract_summary_and_main(text)
        assert both == (summarize.extract_summary(text), summarize.extract_summary(text, sentences=1))
