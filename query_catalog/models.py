"""Sentiment, topics, summaries, actions, insights, batch inference."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from callspark.functions.text import merge_segments
from callspark.operators import evaluate, infer, insights, levels, sentiment, summarize, topics
from callspark.operators.transcripts import with_counts
from query_catalog import views as v

QUERIES, SQL = {}, {}


def query(sql=None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn
    return register


def _words(x):
    return f"regexp_extract_all(lower({x}), '{v.W}+')"


# --- sentiment ----------------------------------------------------------------------------------

# Word weights that occur in the given texts.
_LEXICON = {
    **dict.fromkeys(("the", "and", "in", "la", "les", "der", "und", "que", "los"), 1),
    **dict.fromkeys(("of", "is", "was", "de", "des", "die", "das", "el", "para"), -1),
}


def _label_sql(words, lexicon=_LEXICON):
    positive, negative = ([w for w, x in lexicon.items() if x * side > 0] for side in (1, -1))
    return f"""CASE sign(len(list_filter({words}, lambda w: list_contains({positive}, w)))
        - len(list_filter({words}, lambda w: list_contains({negative}, w))))
        WHEN 1 THEN 'Positive' WHEN -1 THEN 'Negative' ELSE 'Neutral' END"""


def _majority_sql(table, keys, label, position):
    return f"""counts AS (SELECT {keys}, {label}, count(*) AS n, min({position}) AS first FROM {table} GROUP BY ALL),
        best AS (SELECT {keys}, {label} FROM counts
                 QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY n DESC, first, {label}) = 1)"""


@query(f"""WITH p AS (SELECT conv_id, turn, string_split_regex(text, '[.!?] ') AS s FROM conversations), w AS (
        SELECT conv_id, turn, i, {_words('s[i]')} AS words FROM p, unnest(range(1, len(s) + 1)) AS u(i)), labelled AS (
        SELECT conv_id, turn, i, {_label_sql('words')} AS sentiment FROM w),
        {_majority_sql('labelled', 'conv_id, turn', 'sentiment', 'i')}
    SELECT concat('call-', conv_id) AS file_path, turn * 10.0::DOUBLE AS start, sentiment FROM best""")
def sentiment_segments(spark, d):
    labelled = sentiment.segments(v.transcripts(spark, d), lexicon=_LEXICON)
    return labelled.select("file_path", F.explode("sentiment").alias("s")).select("file_path", "s.start", "s.sentiment")


@query(f"""WITH lexicon AS (
        SELECT word, CASE WHEN length(word) < 5 THEN 1 ELSE -2 END AS score
        FROM (SELECT DISTINCT unnest({_words('text')}) AS word FROM benchmark)), p AS (
        SELECT conv_id, turn, string_split_regex(text, '[.!?] ') AS s FROM conversations), sentences AS (
        SELECT conv_id, turn, i, {_words('s[i]')} AS words FROM p, unnest(range(1, len(s) + 1)) AS u(i)), hits AS (
        SELECT conv_id, turn, i, sum(score) AS total
        FROM (SELECT conv_id, turn, i, unnest(words) AS word FROM sentences) JOIN lexicon USING (word)
        GROUP BY conv_id, turn, i), labelled AS (
        SELECT conv_id, turn, i, CASE WHEN total > 0 THEN 'Positive' WHEN total < 0 THEN 'Negative' ELSE 'Neutral' END
               AS sentiment FROM sentences LEFT JOIN hits USING (conv_id, turn, i)),
        {_majority_sql('labelled', 'conv_id, turn', 'sentiment', 'i')} SELECT * FROM best""")
def sentiment_with_word_table(spark, d):
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)\w+"), F.lit(0))
    lexicon = v.table(spark, d, "benchmark").select(F.explode(words).alias("word")).distinct().withColumn(
        "score", F.when(F.length("word") < 5, 1).otherwise(-2)
    )
    return sentiment.label_rows(v.table(spark, d, "conversations"), ["conv_id", "turn"], "text", lexicon)


@query(f"WITH {_majority_sql('events', 'user_id', 'event_type', 'event_id')} SELECT * FROM best")
def majority_label(spark, d):
    return sentiment.majority(v.table(spark, d, "events"), ["user_id"], "event_type", "event_id")


# --- topics -------------------------------------------------------------------------------------

_VECTORS = """vectors AS (
    SELECT vec_id // 5 AS file_path, vec_id % 5 AS position, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings),
    parts AS (SELECT label, i, avg(e[i]) AS x FROM vectors, unnest(range(1, 65)) AS u(i) GROUP BY label, i), topics AS (
    SELECT label AS topic_num, concat('topic ', label) AS topic, list(x ORDER BY i) AS t FROM parts GROUP BY label),
    pairs AS (SELECT file_path, position, topic_num, topic, list_inner_product(e, t)
        / (sqrt(list_inner_product(e, e)) * sqrt(list_inner_product(t, t))) AS cos_sim FROM vectors, topics)"""


def _sentences(spark, d):
    return v.table(spark, d, "embeddings").selectExpr(
        "CAST(floor(vec_id / 5) AS BIGINT) AS file_path", "vec_id % 5 AS position", "embedding", "label"
    )


def _topics(spark, d):
    means = topics.mean_vectors(_sentences(spark, d), "label", "embedding")
    return means.select(
        F.col("label").alias("topic_num"), F.concat(F.lit("topic "), "label").alias("topic"), "embedding"
    )


def _rounded(df):
    return df.withColumn("cos_sim", F.round("cos_sim", 6)) if "cos_sim" in df.columns else df


@query(f"""WITH {_VECTORS} SELECT v.file_path, v.position, round(p.cos_sim, 6) AS cos_sim FROM vectors v
    JOIN pairs p ON p.file_path = v.file_path AND p.position = v.position AND p.topic_num = v.label""")
def cosine_to_own_topic(spark, d):
    own = _topics(spark, d).select(F.col("topic_num").alias("label"), F.col("embedding").alias("mean"))
    joined = _sentences(spark, d).join(own, "label")
    return _rounded(joined.select("file_path", "position", topics.cosine("embedding", "mean").alias("cos_sim")))


_MATCH = "SELECT file_path, position, topic_num, topic, round(cos_sim, 6) AS cos_sim FROM pairs WHERE cos_sim >"


@query(f"WITH {_VECTORS} {_MATCH} 0.4")
def topic_match(spark, d):
    return _rounded(topics.match(_sentences(spark, d), _topics(spark, d)))


@query(f"WITH {_VECTORS} {_MATCH} 0.2")
def topic_match_wide(spark, d):
    return _rounded(topics.match(_sentences(spark, d), _topics(spark, d), 0.2))


@query(f"WITH {_VECTORS} {_MATCH} 0.2")
def topic_match_in_blocks(spark, d):
    return _rounded(topics.match(_sentences(spark, d), _topics(spark, d), 0.2, max_components=128))


_TOP = f"""{_VECTORS}, top AS (
    SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY cos_sim DESC, position, topic_num) AS rank
    FROM pairs WHERE cos_sim > {{}} QUALIFY rank <= 10)"""


@query(f"""WITH {_TOP.format('0.0')} SELECT file_path, position, topic_num, topic, round(cos_sim, 6) AS cos_sim,
    CAST(rank AS INT) AS rank FROM top""")
def topic_candidates(spark, d):
    return _rounded(topics.best_matches(_sentences(spark, d), _topics(spark, d), 0.0))


_ASSIGN = """best AS (SELECT file_path, topic_num, topic, max(cos_sim) AS c FROM top GROUP BY ALL), named AS (
    SELECT file_path, list(topic ORDER BY c DESC, topic_num) AS t FROM best GROUP BY file_path)
    SELECT file_path, coalesce(t[1], 'Unidentified') AS "primary", coalesce(t[2], 'None') AS secondary
    FROM calls LEFT JOIN named USING (file_path)"""


def _split(df):
    return df.select("file_path", F.get("topics", F.lit(0)).alias("primary"), F.get("topics", F.lit(1)).alias("secondary"))


@query(f"WITH {_TOP.format('0.2')}, calls AS (SELECT DISTINCT file_path FROM vectors), {_ASSIGN}")
def topic_assignment(spark, d):
    sentences = _sentences(spark, d)
    candidates = topics.best_matches(sentences, _topics(spark, d), 0.2)
    return _split(topics.assign(candidates, sentences.select("file_path").distinct()))


def _taxonomy(spark, d):
    return v.table(spark, d, "benchmark").select(
        F.col("item_id").alias("topic_num"), F.concat(F.lit("topic "), "item_id").alias("topic"),
        F.col("text").alias("description"),
    )


def _merged(spark, d):
    return v.transcripts(spark, d).select("file_path", merge_segments("transcription").alias("transcription"))


_BAGS = rf"""{v.MERGED}, split AS (
    SELECT file_path, list_filter(string_split(transcription, '.'),
           lambda s: len(regexp_extract_all(s, '\S+')) >= 5) AS s FROM merged), sw AS (
    SELECT file_path, i - 1 AS position, w AS word, count(*) AS n FROM (
        SELECT file_path, i, unnest({_words('s[i]')}) AS w FROM split, unnest(range(1, len(s) + 1)) AS u(i))
    GROUP BY ALL), tw AS (
    SELECT topic_num, word, count(*) AS n FROM (
        SELECT item_id AS topic_num, unnest({_words('text')}) AS word FROM benchmark) GROUP BY ALL), sl AS (
    SELECT file_path, position, sqrt(sum(n * n)) AS length FROM sw GROUP BY ALL), tl AS (
    SELECT topic_num, sqrt(sum(n * n)) AS length FROM tw GROUP BY ALL), dots AS (
    SELECT file_path, position, topic_num, sum(sw.n * tw.n) AS dot FROM sw JOIN tw USING (word) GROUP BY ALL), pairs AS (
    SELECT file_path, position, topic_num, concat('topic ', topic_num) AS topic, dot / (sl.length * tl.length) AS cos_sim
    FROM dots JOIN sl USING (file_path, position) JOIN tl USING (topic_num))"""


@query(f"""WITH {_BAGS} SELECT file_path, CAST(position AS INT) AS position, topic_num, topic,
        round(cos_sim, 6) AS cos_sim FROM pairs WHERE cos_sim > 0.3""")
def topic_match_by_words(spark, d):
    from callspark.functions.text import sentences_by_stop

    sentences = _merged(spark, d).select(
        "file_path", F.posexplode(sentences_by_stop("transcription")).alias("position", "sentence")
    )
    return _rounded(topics.match_words(sentences, _taxonomy(spark, d), 0.3))


@query(f"""WITH {_BAGS} SELECT file_path, CAST(position AS INT) AS position, topic_num, topic,
        round(cos_sim, 6) AS cos_sim FROM pairs WHERE cos_sim > 0.3""")
def topic_match_by_indexed_words(spark, d):
    from callspark.functions.text import sentences_by_stop

    sentences = _merged(spark, d).select(
        "file_path", F.posexplode(sentences_by_stop("transcription")).alias("position", "sentence")
    )
    return _rounded(topics.match_words(sentences, _taxonomy(spark, d), 0.3, max_words=0))


def topics_sql(threshold, merged=v.MERGED):
    """Primary and secondary topic by word overlap of the texts of ``merged`` (file_path, transcription)."""
    return f"""WITH {_BAGS.replace(v.MERGED, merged)}, top AS (
        SELECT * FROM pairs WHERE cos_sim > {threshold}
        QUALIFY row_number() OVER (PARTITION BY file_path ORDER BY round(cos_sim, 9) DESC, position, topic_num) <= 10),
        calls AS (SELECT file_path FROM merged), {_ASSIGN.replace('max(cos_sim)', 'round(max(cos_sim), 9)')}"""


@query(topics_sql(0.4))
def topics_of_calls(spark, d):
    return _split(topics.assign_topics(_merged(spark, d), _taxonomy(spark, d), text="transcription"))


# --- summaries and actions ----------------------------------------------------------------------


def _documents(spark, d):
    return with_counts(v.table(spark, d, "documents").select("doc_id", "text"), "text")


_COUNTED = rf"""counted AS (
    SELECT doc_id, text, len(regexp_extract_all(text, '{v.W}+|[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}\s]')) AS word_count,
           regexp_extract_all(text, '\S+') AS w FROM documents)"""


def _extract_sql(source, x=""):
    """The extractive scorer over (doc_id, piece, t): ``parts`` has the three best sentences of each piece as p."""
    return rf"""{x}tf AS (
        SELECT doc_id, piece, word, count(*) AS n FROM (
            SELECT doc_id, piece, unnest(regexp_extract_all(lower(t), '\S+')) AS word FROM {source}) GROUP BY ALL), {x}split AS (
        SELECT doc_id, piece, list_filter(string_split_regex(t, '[.!?]\s+'), lambda x: regexp_matches(x, '\S')) AS s
        FROM {source}), {x}sentences AS (
        SELECT doc_id, piece, i, s[i] AS sentence FROM {x}split, unnest(range(1, len(s) + 1)) AS u(i)), {x}scored AS (
        SELECT doc_id, piece, i, sum(coalesce(n, 0)) AS score FROM (
            SELECT doc_id, piece, i, unnest(regexp_extract_all(lower(sentence), '\S+')) AS word FROM {x}sentences)
        LEFT JOIN {x}tf USING (doc_id, piece, word) GROUP BY ALL), {x}chosen AS (
        SELECT doc_id, piece, i FROM {x}scored
        QUALIFY row_number() OVER (PARTITION BY doc_id, piece ORDER BY score DESC, i) <= 3), {x}parts AS (
        SELECT doc_id, piece, array_to_string(regexp_extract_all(string_agg(sentence, '. ' ORDER BY i), '\S+'), ' ') AS p
        FROM {x}chosen JOIN {x}sentences USING (doc_id, piece, i) GROUP BY doc_id, piece)"""


def _pieces_sql(whole, size, most, overlap, gate="true"):
    """Chunks of the texts that are not ``whole``, and the others as they are."""
    return rf"""{_COUNTED}, starts AS (
        SELECT doc_id, w, unnest(range(0, len(w), {size})) AS s FROM counted WHERE {gate} AND NOT ({whole})), pieces AS (
        SELECT doc_id, s AS piece, array_to_string(w[s + 1:least(len(w), s + {most},
               s + {size} + CASE WHEN s + {size + overlap} < len(w) THEN {overlap} ELSE 0 END)], ' ') AS t FROM starts
        UNION ALL SELECT doc_id, 0, text FROM counted WHERE {gate} AND {whole})"""


def summary_sql(limit, size, most, overlap):
    return f"""WITH {_pieces_sql(f'len(w) <= {limit}', size, most, overlap, 'word_count > 50')}, {_extract_sql('pieces')}, done AS (
        SELECT doc_id, string_agg(p, chr(10) ORDER BY piece) AS summary FROM parts GROUP BY doc_id)
    SELECT doc_id, CASE WHEN word_count > 50 THEN summary ELSE 'No summary generated' END AS summary
    FROM counted LEFT JOIN done USING (doc_id)"""


def _tree_sql(budget, size, most, overlap):
    """Summaries of chunks, joined in halves while they are under the budget and summed up again."""
    split = f"hi - lo > 1 AND b.upto - a.upto >= {budget}"
    ends = "JOIN totals a ON a.doc_id = n.doc_id AND a.spot = n.lo JOIN totals b ON b.doc_id = n.doc_id AND b.spot = n.hi"
    return rf"""WITH RECURSIVE {_pieces_sql(f'len(w) < {budget}', size, most, overlap)}, {_extract_sql('pieces')}, firsts AS (
        SELECT doc_id, piece, coalesce(p, '') AS p, len(w) < {budget} AS whole,
               row_number() OVER (PARTITION BY doc_id ORDER BY piece) - 1 AS spot
        FROM pieces LEFT JOIN parts USING (doc_id, piece) JOIN counted USING (doc_id)), totals AS (
        SELECT doc_id, spot + 1 AS spot, sum(len(regexp_extract_all(p, '\S+'))) OVER (PARTITION BY doc_id ORDER BY spot) AS upto
        FROM firsts WHERE NOT whole UNION ALL SELECT DISTINCT doc_id, 0, 0 FROM firsts WHERE NOT whole), nodes AS (
        SELECT doc_id, 0::BIGINT AS lo, max(spot) AS hi FROM totals GROUP BY doc_id
        UNION ALL
        SELECT n.doc_id, CASE side WHEN 0 THEN lo ELSE lo + (hi - lo) // 2 END, CASE side WHEN 0 THEN lo + (hi - lo) // 2 ELSE hi END
        FROM nodes n {ends}, (VALUES (0), (1)) sides(side) WHERE {split}), leaves AS (
        SELECT n.doc_id, n.lo AS piece, string_agg(f.p, ' ' ORDER BY f.spot) AS t
        FROM nodes n {ends} JOIN firsts f ON f.doc_id = n.doc_id AND f.spot >= n.lo AND f.spot < n.hi
        WHERE NOT ({split}) GROUP BY n.doc_id, n.lo), {_extract_sql('leaves', 'leaf_')}, done AS (
        SELECT doc_id, string_agg(coalesce(p, ''), ' ' ORDER BY piece) AS summary
        FROM leaves LEFT JOIN leaf_parts USING (doc_id, piece) GROUP BY doc_id)
    SELECT doc_id, summary FROM done UNION ALL SELECT doc_id, p FROM firsts WHERE whole"""


@query(summary_sql(3900, 3200, 3800, 50))
def summaries(spark, d):
    return summarize.summary(_documents(spark, d), "text").select("doc_id", "summary")


@query(summary_sql(200, 64, 80, 10))
def summaries_of_chunks(spark, d):
    return summarize.summary(_documents(spark, d), "text", max_tokens=200, chunk=(64, 80, 10)).select("doc_id", "summary")


@query(_tree_sql(200, 64, 80, 10))
def summary_tree(spark, d):
    made = levels.tree(_documents(spark, d), levels.TextPredictor, "doc_id", "text", 200, (64, 80, 10), batch_size=200)
    return made.select("doc_id", "summary")


@query(_tree_sql(200, 64, 80, 10))
def summary_tree_in_rows(spark, d):
    return summarize.tree(_documents(spark, d), "text", max_tokens=200, chunk=(64, 80, 10)).select("doc_id", "summary")


_ACTION_WORDS = ("edition", "with", "from", "dans", "nicht", "para")


def _with_words(x, words):
    """Sentences that hold a whole word, by letters around it rather than a word boundary."""
    letter = v.W.replace("[", "[^", 1)
    found = f"(?i)(^|{letter})({'|'.join(words)})($|{letter})"
    return f"array_to_string(list_filter(string_split_regex({x}, '[.!?] '), lambda s: regexp_matches(s, '{found}')), '. ')"


@query(f"""WITH {_COUNTED}, found AS (SELECT *, {_with_words('text', _ACTION_WORDS)} AS a FROM counted)
    SELECT doc_id, CASE WHEN word_count > 50 AND a <> '' THEN a ELSE 'No actions generated' END
           AS actions_taken FROM found""")
def actions_taken(spark, d):
    return summarize.actions(_documents(spark, d), "text", _ACTION_WORDS).select("doc_id", "actions_taken")


# --- insights -----------------------------------------------------------------------------------

_RULE_WORDS = (
    ("Category", ("edition", "license", "licensed"), "BILLING"), ("Category", ("der", "die"), "POWER"),
    ("Category", ("les", "des"), "ENERGY"), ("Category", ("los", "del"), "COLLECTIONS"),
    ("Urgency", ("was", "dans", "mit"), "High"), ("Urgency", ("is", "est", "ist"), "Medium"),
    ("Repeated Issues", ("with", "avec", "con"), "Yes"), ("Transfer Involved", ("from", "pour", "von"), "Yes"),
    ("Department Transferred To", ("this", "dem"), "Billing"), ("Issue Resolution Status", ("that", "den"), "Resolved"),
    ("Satisfaction Score", ("are", "nicht", "es"), "5"), ("Satisfaction Score", ("by", "qui"), "1"),
    ("Customer Loyalty Indicators", ("they", "auf"), "Loyal"), ("Improvement Suggestions", ("on", "sur"), "Shorten the wait"),
)
_RULES = tuple(insights.Rule(f, rf"\b(?:{'|'.join(w)})\b", x) for f, w, x in _RULE_WORDS)
_PROBLEMS, _FOLLOW_UPS = ("was", "dans"), ("from", "mit")


def _field_sql(field, rules, actions, problems, follow_ups):
    letter = v.W.replace("[", "[^", 1)
    special = {
        "Summary": "summary",
        "Main Issue": f"coalesce(nullif({_with_words('text', problems)}, ''), main)",
        "Steps Taken": f"coalesce(nullif({_with_words('text', actions)}, ''), 'None')",
        "Sentiment": "sentiment",
        "Follow-Up Actions": f"coalesce(nullif({_with_words('text', follow_ups)}, ''), 'None')",
    }
    if field in special:
        value = special[field]
    else:
        whens = " ".join(
            f"WHEN regexp_matches(text, '(?i)(^|{letter})({w})($|{letter})') THEN '{x}'" for f, w, x in rules if f == field
        )
        value = f"CASE {whens} ELSE '{insights.DEFAULTS[field]}' END"
    return f"CASE WHEN tokens >= 20 THEN {value} ELSE 'Not Generated' END AS \"{field}\""


def insights_sql(rules, actions, problems, follow_ups, lexicon):
    """The fourteen fields of ``documents``; rules are (field, alternatives, value)."""
    return rf"""WITH split AS (SELECT doc_id, text, string_split_regex(text, '[.!?] ') AS s,
        len(regexp_extract_all(text, '\S+')) AS tokens FROM documents), w AS (
        SELECT doc_id, i, {_words('s[i]')} AS words FROM split, unnest(range(1, len(s) + 1)) AS u(i)), labelled AS (
        SELECT doc_id, i, {_label_sql('words', lexicon)} AS sentiment FROM w), {_majority_sql('labelled', 'doc_id', 'sentiment', 'i')},
        tf AS (SELECT doc_id, word, count(*) AS f FROM (
            SELECT doc_id, unnest(regexp_extract_all(lower(text), '\S+')) AS word FROM documents) GROUP BY ALL), parts AS (
        SELECT doc_id, list_filter(string_split_regex(text, '[.!?]\s+'), lambda x: regexp_matches(x, '\S')) AS p
        FROM documents), whole AS (
        SELECT doc_id, i, p[i] AS sentence FROM parts, unnest(range(1, len(p) + 1)) AS u(i)), scored AS (
        SELECT doc_id, i, sum(f) AS score FROM (
            SELECT doc_id, i, unnest(regexp_extract_all(lower(sentence), '\S+')) AS word FROM whole)
        LEFT JOIN tf USING (doc_id, word) GROUP BY ALL), chosen AS (
        SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i) AS r FROM scored), extracts AS (
        SELECT doc_id,
               array_to_string(regexp_extract_all(string_agg(sentence, '. ' ORDER BY i) FILTER (r <= 3), '\S+'), ' ') AS summary,
               array_to_string(regexp_extract_all(any_value(sentence) FILTER (r = 1), '\S+'), ' ') AS main
        FROM chosen JOIN whole USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, {', '.join(_field_sql(f, rules, actions, problems, follow_ups) for f in insights.FIELDS)}
    FROM split JOIN best USING (doc_id) LEFT JOIN extracts USING (doc_id)"""


@query(insights_sql([(f, "|".join(w), x) for f, w, x in _RULE_WORDS], _ACTION_WORDS, _PROBLEMS, _FOLLOW_UPS, _LEXICON))
def structured_insights(spark, d):
    found = insights.extract(
        v.table(spark, d, "documents").select("doc_id", "text"), "text", _RULES, lexicon=_LEXICON,
        action_words=_ACTION_WORDS, problem_words=_PROBLEMS, follow_up_words=_FOLLOW_UPS,
    )
    return found.drop("text")


_JSON_ANSWER = "concat('{', " + ", ', ', ".join(
    f"'\"{f}\": \"{f} ', doc_id, '\"'" for f in insights.FIELDS
) + ", '}')"
_ANSWER = f"""CASE WHEN toxic = 1 THEN 'Sorry, no answer.' WHEN quality = 0 THEN '{{"Summary": "only this"}}'
    ELSE {_JSON_ANSWER} END"""


@query(f"""WITH a AS (SELECT doc_id, {_ANSWER} AS answer FROM labels), j AS (
        SELECT doc_id, CASE WHEN starts_with(answer, '{{') THEN CAST(answer AS JSON) END AS j FROM a)
    SELECT doc_id, {', '.join(f'''CASE WHEN j IS NULL THEN 'Not Generated' ELSE json_extract_string(j, '$."{f}"') END
        AS "{f}"''' for f in insights.FIELDS)} FROM j""")
def parsed_insights(spark, d):
    answers = v.table(spark, d, "labels").selectExpr("doc_id", f"{_ANSWER} AS answer")
    return insights.parse(answers, "answer").drop("answer")


@query("""SELECT doc_id, CASE WHEN toxic = 1 THEN NULL WHEN quality = 0 THEN 'x, None, [True]' ELSE concat('billing ', quality) END
    AS "primary", CASE WHEN toxic = 1 OR quality = 0 THEN NULL ELSE concat('power ', doc_id) END AS secondary FROM labels""")
def parsed_topic_lists(spark, d):
    answers = v.table(spark, d, "labels").selectExpr(
        "doc_id", """CASE WHEN toxic = 1 THEN 'billing, power' WHEN quality = 0 THEN '[''x, None, [True]'',            None]'
                     ELSE concat('["billing ', quality, '", ''power ', doc_id, ''']') END AS answer"""
    ).withColumn("topics", insights.parse_list("answer"))
    return answers.select("doc_id", F.get("topics", F.lit(0)).alias("primary"), F.get("topics", F.lit(1)).alias("secondary"))


# --- batch inference ----------------------------------------------------------------------------


class Lengths:
    """A stand-in model: characters of the text; it fails on system turns."""

    def setup(self):
        self.ready = True

    def predict(self, batch: pd.DataFrame) -> pd.DataFrame:
        if (batch["role"] == "system").any():
            raise ValueError("system turn")
        return pd.DataFrame({"n_chars": batch["text"].str.len()})


@query("""SELECT conv_id, turn, CASE WHEN role = 'system' THEN -1 ELSE length(text) END AS n_chars,
    CASE WHEN role = 'system' THEN 'ValueError: system turn' END AS error FROM conversations""")
def batch_inference(spark, d):
    turns = v.table(spark, d, "conversations")
    predicted = infer.map_predict(turns, Lengths, "n_chars bigint", fallback={"n_chars": -1})
    return predicted.select("conv_id", "turn", "n_chars", "error")


#: What the stand-in judge refuses.
_REFUSED = "that"


class LengthJudge:
    """A stand-in judge: scores are drawn from the length of the prompt; it fails on one that holds a mark."""

    stage = "redaction"

    def setup(self):
        self.metrics = evaluate.JUDGE_METRICS[self.stage]

    def predict(self, batch: pd.DataFrame) -> pd.DataFrame:
        if batch["prompt"].str.contains(_REFUSED, regex=False).any():
            raise ValueError("a prompt it will not read")
        return pd.DataFrame({"response": [
            str({m: {"score": 1 + (len(p) + i) % 10} for i, m in enumerate(self.metrics)}) for p in batch["prompt"]
        ]})


class SummaryJudge(LengthJudge):
    stage = "summary"


class TopicJudge(LengthJudge):
    stage = "topics"


class InsightJudge(LengthJudge):
    stage = "insights"


def _judged_sql(stage):
    return f"WITH p AS (SELECT conv_id, turn, text, 12 + length(text) AS n FROM conversations) SELECT conv_id, turn, " + ", ".join(
        f"CASE WHEN contains(text, '{_REFUSED}') THEN -1.0 ELSE 1.0 + (n + {i}) % 10 END::DOUBLE AS {m}"
        for i, m in enumerate(evaluate.JUDGE_METRICS[stage])
    ) + " FROM p"


def _judged(spark, d, judge):
    turns = v.table(spark, d, "conversations").select("conv_id", "turn", "text")
    metrics = evaluate.JUDGE_METRICS[judge.stage]
    return evaluate.judge(turns, "Rate this:  {text}", {"text": "text"}, judge, metrics).drop("text")


@query(_judged_sql("redaction"))
def judged_redactions(spark, d):
    return _judged(spark, d, LengthJudge)


@query(_judged_sql("summary"))
def judged_summaries(spark, d):
    return _judged(spark, d, SummaryJudge)


@query(_judged_sql("topics"))
def judged_topics(spark, d):
    return _judged(spark, d, TopicJudge)


@query(_judged_sql("insights"))
def judged_insights(spark, d):
    return _judged(spark, d, InsightJudge)
