"""Text metrics of two runs, judge scores, distributions, commentary."""

from __future__ import annotations

from pyspark.sql import functions as F

from callspark.functions import textmetrics as M
from callspark.operators import evaluate as E
from callspark.operators import textmetrics as T
from callspark.session import parallelism
from query_catalog import views as v

QUERIES, SQL = {}, {}


def query(sql=None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn
    return register


# --- two runs: a turn against the next one, and a turn against an edited copy -------------------

_EDITED = "replace(replace(text, ' the ', ' '), 'ou', 'o')"


def _pairs(spark, d):
    turns = v.table(spark, d, "conversations")
    first = turns.selectExpr("concat(conv_id, '-', turn) AS file", "text AS transcription")
    second = turns.selectExpr("concat(conv_id, '-', turn - 1) AS file", "text AS transcription")
    copies = turns.selectExpr("concat(conv_id, '-', turn, '-edited') AS file", "text AS transcription")
    edited = turns.selectExpr(
        "concat(conv_id, '-', turn, '-edited') AS file", f"{_EDITED} AS transcription"
    )
    pairs = T.pair_runs(first.unionByName(copies), second.unionByName(edited))
    # A small join ends in one partition, and the distances are dear per row.
    return pairs.repartition(parallelism(spark), "file")


_PAIRS = f"""pairs AS (
    SELECT concat(a.conv_id, '-', a.turn) AS file, a.text AS m, b.text AS l
    FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn - 1
    UNION ALL
    SELECT concat(conv_id, '-', turn, '-edited'), text, {_EDITED} FROM conversations)"""

# Accented letters as single bytes, for an engine whose edit distance counts bytes.
_ACCENTS = "áàâäãéèêëíìîïóòôöõúùûüñçßÁÀÂÄÃÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇ"


def _bytes(col):
    codes = [c for c in range(1, 128) if not chr(c).isalnum() and chr(c) not in " \n.,;:!?-_'\"()"]
    table = " || ".join(f"chr({c})" for c in codes[:len(_ACCENTS)])
    return f"translate({col}, '{_ACCENTS}', {table})"


@query(f"WITH {_PAIRS} SELECT file, m AS transcription_medium, l AS transcription_large FROM pairs")
def paired_runs(spark, d):
    return _pairs(spark, d)


@query(f"""WITH {_PAIRS} SELECT file, levenshtein({_bytes('m')}, {_bytes('l')}) AS "Levenshtein",
        round(levenshtein({_bytes('m')}, {_bytes('l')}) / length(m), 6) AS "CER" FROM pairs""")
def character_error_rate(spark, d):
    edits = F.col("Levenshtein").cast("bigint").alias("Levenshtein")
    return T.levenshtein(_pairs(spark, d), long=200).select("file", edits, F.round(T.character_error_rate("Levenshtein"), 6).alias("CER"))


_WORDS = rf"""words AS (
    SELECT file, regexp_extract_all(m, '\S+') AS r, regexp_extract_all(l, '\S+') AS h FROM pairs)"""

_WER = rf"""{_PAIRS}, {_WORDS}, dp AS (
    SELECT file, 0::BIGINT AS i, range(0, len(h) + 1) AS d FROM words
    UNION ALL
    SELECT file, i, list(v ORDER BY j) AS d FROM (
        SELECT file, i, j, j + min(a - j) OVER (PARTITION BY file ORDER BY j ROWS UNBOUNDED PRECEDING) AS v FROM (
            SELECT dp.file, dp.i + 1 AS i, u.j, CASE WHEN u.j = 0 THEN dp.i + 1 ELSE
                   least(dp.d[u.j + 1] + 1, dp.d[u.j] + CASE WHEN w.r[dp.i + 1] = w.h[u.j] THEN 0 ELSE 1 END) END AS a
            FROM dp JOIN words w ON dp.file = w.file, unnest(range(0, len(w.h) + 1)) AS u(j)
            WHERE dp.i < len(w.r)))
    GROUP BY file, i), edits AS (
    SELECT file, d[len(h) + 1] AS edits, len(r) AS n FROM dp JOIN words USING (file) WHERE i = len(r))"""


@query(f"""WITH RECURSIVE {_WER} SELECT file, CAST(edits AS BIGINT) AS edits, round(edits / n, 6) AS "WER" FROM edits""")
def word_error_rate(spark, d):
    sides = (T.REFERENCE, T.HYPOTHESIS)
    return _pairs(spark, d).select(
        "file", M.word_edits(*sides).cast("bigint").alias("edits"), F.round(M.wer(*sides), 6).alias("WER")
    )


_SETS_TAIL = """sets AS (
    SELECT file, len(list_intersect(list_distinct(r), list_distinct(h))) AS c,
           len(list_distinct(r)) AS nr, len(list_distinct(h)) AS nh FROM words), pr AS (
    SELECT file, c, CASE WHEN nr > 0 THEN c / nr ELSE 0.0 END AS p, CASE WHEN nh > 0 THEN c / nh ELSE 0.0 END AS q
    FROM sets), f AS (SELECT *, 2 * p * q / nullif(p + q, 0) AS f1 FROM pr)"""
_SETS = f"{_PAIRS}, {_WORDS}, {_SETS_TAIL}"


@query(f"""WITH {_SETS} SELECT file, CAST(c AS BIGINT) AS common, round(p, 6) AS "Precision", round(q, 6) AS "Recall",
        round(f1, 6) AS "F1_Score" FROM f""")
def precision_recall_f1(spark, d):
    sides = (T.REFERENCE, T.HYPOTHESIS)
    return _pairs(spark, d).select(
        "file", F.size(M.common_tokens(*sides)).cast("bigint").alias("common"),
        M.precision(*sides).alias("p"), M.recall(*sides).alias("q"),
    ).select(
        "file", "common", F.round("p", 6).alias("Precision"), F.round("q", 6).alias("Recall"),
        F.round(M.f1("p", "q"), 6).alias("F1_Score"),
    )


_BLEU_TAIL = """sides AS (
    SELECT file, 'r' AS side, r AS w FROM words UNION ALL SELECT file, 'h', h FROM words), grams AS (
    SELECT file, side, n, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM sides, unnest([1, 2, 3, 4]) AS o(n), unnest(range(1, len(w) - n + 2)) AS u(i)), counted AS (
    SELECT file, n, g, count(*) FILTER (side = 'r') AS cr, count(*) FILTER (side = 'h') AS ch
    FROM grams GROUP BY file, n, g), orders AS (
    SELECT file, n, sum(least(cr, ch)) AS hit, sum(ch) AS total FROM counted GROUP BY file, n), score AS (
    SELECT file, count(*) FILTER (hit > 0) AS orders_hit, sum(CASE WHEN hit > 0 THEN ln(hit / total) END) / 4 AS logs
    FROM orders GROUP BY file), bleu AS (
    SELECT file, CASE WHEN orders_hit = 4 THEN exp(logs) * CASE WHEN len(h) > len(r) THEN 1.0
           ELSE exp(1 - len(r) / len(h)) END ELSE 0.0 END AS bleu
    FROM words JOIN score USING (file))"""
_BLEU = f"{_PAIRS}, {_WORDS}, {_BLEU_TAIL}"


@query(f"""WITH {_BLEU} SELECT file, round(bleu, 6) AS "BLEU" FROM bleu""")
def bleu(spark, d):
    return _pairs(spark, d).select("file", F.round(M.bleu(T.REFERENCE, T.HYPOTHESIS), 6).alias("BLEU"))


def _describe(table, columns):
    """Statistics of columns, given as name and expression."""
    def one(name, x):
        return f"""SELECT '{name}' AS metric, count({x}) AS "count", round(avg({x}), 6) AS mean,
            round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS "min", round(quantile_cont({x}, 0.25), 6) AS p25,
            round(quantile_cont({x}, 0.5), 6) AS p50, round(quantile_cont({x}, 0.75), 6) AS p75,
            round(max({x}), 6) AS "max" FROM {table}"""

    return " UNION ALL ".join(one(n, f"CAST({x} AS DOUBLE)") for n, x in columns.items())


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


_ALL = f"""{_WER}, {_BLEU_TAIL}, {_SETS_TAIL}, metrics AS (
    SELECT file, edits / n AS "WER", levenshtein({_bytes('m')}, {_bytes('l')}) / length(m) AS "CER",
           levenshtein({_bytes('m')}, {_bytes('l')}) AS "Levenshtein", p AS "Precision", q AS "Recall",
           f1 AS "F1_Score", bleu AS "BLEU"
    FROM pairs JOIN edits USING (file) JOIN f USING (file) JOIN bleu USING (file))"""


@query(f"WITH RECURSIVE {_ALL} {_describe('metrics', {m: chr(34) + m + chr(34) for m in T.METRICS})}")
def transcription_report(spark, d):
    return _rounded(T.report(T.measured(_pairs(spark, d))))


@query(f"""WITH {_PAIRS}, x AS (SELECT levenshtein({_bytes('m')}, {_bytes('l')})::DOUBLE AS x FROM pairs), lim AS (
        SELECT min(x) AS lo, max(x) AS hi FROM x), n AS (
        SELECT CAST(least(floor((x - lo) * 30 / (hi - lo)) + 1, 30) AS BIGINT) AS bin, count(*) AS c FROM x, lim GROUP BY 1)
    SELECT b AS bin, round(lo + (hi - lo) / 30 * (b - 1), 6) AS low, round(lo + (hi - lo) / 30 * b, 6) AS high,
           coalesce(c, 0) AS "count"
    FROM lim, unnest(range(1, 31)) AS u(b) LEFT JOIN n ON n.bin = b""")
def levenshtein_histogram(spark, d):
    pairs = _pairs(spark, d)
    return _rounded(T.levenshtein_histogram(T.levenshtein(pairs)))


@query(f"""WITH {_BLEU} SELECT m AS transcription_medium, l AS transcription_large, round(bleu, 6) AS "BLEU"
    FROM pairs JOIN bleu USING (file) ORDER BY file LIMIT 5""")
def transcription_sample(spark, d):
    pairs = _pairs(spark, d)
    return _rounded(T.sample(pairs.withColumn("BLEU", M.bleu(T.REFERENCE, T.HYPOTHESIS))))


# --- judge scores, from labels ------------------------------------------------------------------

_METRICS = E.JUDGE_METRICS["summary"]
_SCORES = {
    "accuracy": "5 + 3 * quality - 2 * toxic", "relevance": "1 + doc_id % 10", "conciseness": "4 + doc_id % 3",
    "sentiment_alignment": "8 - toxic", "clarity": "6 + quality", "overall_quality": "3 + 4 * quality",
}
_JSON = "concat('{', " + ", ', ', ".join(
    f"""'"{m}": {{"score": ', {x}, '}}'""" for m, x in _SCORES.items()
) + ", '}')"
_BARE = "concat('{', " + ", ', ', ".join(f"""'"{m}": ', {x}""" for m, x in _SCORES.items()) + ", '}')"
_ANSWER = f"""CASE WHEN doc_id % 11 = 0 THEN 'I cannot score this.' WHEN doc_id % 7 = 0 THEN translate({_JSON}, '"', '''')
    WHEN doc_id % 13 = 0 THEN '{{"accuracy": {{"score": 4}}}}' WHEN doc_id % 5 = 0 THEN {_BARE}
    WHEN doc_id % 3 = 0 THEN '{{"accuracy": 8, "clarity": {{"score": 7.5}}}}' ELSE {_JSON} END"""
_ANSWERS = f"answers AS (SELECT doc_id, {_ANSWER} AS response FROM labels)"
_PARSED = f"""{_ANSWERS}, parsed AS (
    SELECT doc_id, CASE WHEN starts_with(response, '{{') THEN CAST(translate(response, '''', '"') AS JSON) END AS j
    FROM answers), scores AS (SELECT doc_id, {', '.join(
        f"CASE WHEN j IS NULL THEN -1.0 ELSE CAST(coalesce(json_extract(j, '$.{m}.score'), json_extract(j, '$.{m}')) AS DOUBLE) END AS {m}" for m in _METRICS
    )} FROM parsed)"""


def _answers(spark, d):
    return v.table(spark, d, "labels").selectExpr("doc_id", f"{_ANSWER} AS response")


def _scores(spark, d):
    return E.extract_scores(E.parse_scores(_answers(spark, d), "response", _METRICS), _METRICS).drop("response")


@query(f"WITH {_PARSED} SELECT * FROM scores")
def judge_scores(spark, d):
    return _scores(spark, d)


@query(f"WITH {_PARSED} SELECT doc_id, accuracy AS accuracy_score, clarity AS clarity_score FROM scores")
def expanded_judge_answers(spark, d):
    wide = E.expand(E.parse_scores(_answers(spark, d), "response", _METRICS))
    return wide.select(
        "doc_id", F.col("accuracy.score").alias("accuracy_score"), F.col("clarity.score").alias("clarity_score")
    )


def _averages(condition=""):
    return " UNION ALL ".join(
        f"SELECT '{m}' AS metric, round(avg({m}){f' FILTER ({m} <> -1)' if condition else ''}, 6) AS average FROM scores"
        for m in _METRICS
    )


@query(f"WITH {_PARSED} {_averages()}")
def judge_averages(spark, d):
    return _rounded(E.summary(_scores(spark, d), _METRICS))


@query(f"WITH {_PARSED} {_averages('readable')}")
def judge_averages_of_readable(spark, d):
    return _rounded(E.summary(_scores(spark, d), _METRICS, exclude_failed=True))


@query(f"""WITH {_PARSED}, a AS ({_averages()}) SELECT metric, average, 7.0::DOUBLE AS threshold,
        CASE WHEN average < 7 THEN 'below-threshold' ELSE 'above-threshold' END AS flag FROM a""")
def threshold_flags(spark, d):
    return _rounded(E.threshold_flags(E.summary(_scores(spark, d), _METRICS)))


@query(f"WITH {_PARSED} {_describe('scores', {m: m for m in _METRICS})}")
def judge_score_description(spark, d):
    return _rounded(E.describe(_scores(spark, d), _METRICS))


def _commentary_sql(fixed):
    def case(metric, name):
        stat, ranges = E.COMMENTS[name]
        op = ">" if stat == "mean" else "<"
        whens = "".join(
            f" WHEN {stat} {op} {limit} THEN printf('{text}', {stat})" if limit is not None
            else f" ELSE printf('{text}', {stat})" for limit, text in ranges
        )
        return f"WHEN metric = '{metric}' THEN CASE{whens} END"

    title = {m: m.replace("_", " ").title() if fixed else m.capitalize() for m in _METRICS}
    known = " ".join(case(m, t) for m, t in title.items() if t in E.COMMENTS)
    plain = "'Analysis for ' || upper(metric[1]) || metric[2:] || ' metric.'"
    return f"""WITH {_PARSED}, x AS ({" UNION ALL ".join(
        f"SELECT '{m}' AS metric, avg({m}) AS mean, stddev_samp({m}) AS std, min({m}) AS least, max({m}) AS most FROM scores"
        for m in _METRICS)})
    SELECT metric, concat(CASE {known} ELSE {plain} END, ' The scores range from ', CAST(least AS VARCHAR), ' to ',
           CAST(most AS VARCHAR), ' with a standard deviation of ', printf('%.2f', std), '.') AS comment FROM x"""


@query(_commentary_sql(False))
def metric_commentary(spark, d):
    return E.commentary(E.describe(_scores(spark, d), _METRICS))


@query(_commentary_sql(True))
def metric_commentary_by_title(spark, d):
    return E.commentary(E.describe(_scores(spark, d), _METRICS), mode="fixed")


@query(f"WITH {_PARSED} SELECT * FROM scores ORDER BY doc_id LIMIT 20")
def first_scored_rows(spark, d):
    return E.sample_head(_scores(spark, d), ["doc_id"], 20)


# --- statistics over the large tables -----------------------------------------------------------

_PRICES = {"l_extendedprice": "l_extendedprice", "l_quantity": "l_quantity", "l_discount": "l_discount"}


@query(_describe("lineitem", _PRICES))
def describe_columns(spark, d):
    return _rounded(E.describe(v.table(spark, d, "lineitem"), list(_PRICES)))


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS metric, round(avg({c}), 6) AS mean, round(median({c}), 6) AS median, "
    f"round(stddev_samp({c}), 6) AS std FROM lineitem" for c in _PRICES
))
def mean_median_deviation(spark, d):
    return _rounded(E.moments(v.table(spark, d, "lineitem"), list(_PRICES)))


@query("""SELECT count(value) AS files, round(sum(value), 6) AS total, round(avg(value), 6) AS average,
        max(value) AS longest, min(value) AS shortest FROM events""")
def timing_statistics(spark, d):
    return _rounded(E.timing(v.table(spark, d, "events"), "value"))


@query("""WITH lim AS (SELECT min(value) AS lo, max(value) AS hi FROM events), n AS (
        SELECT CAST(least(floor((value - lo) * 30 / (hi - lo)) + 1, 30) AS BIGINT) AS bin, count(*) AS c
        FROM events, lim GROUP BY 1)
    SELECT b AS bin, round(lo + (hi - lo) / 30 * (b - 1), 6) AS low, round(lo + (hi - lo) / 30 * b, 6) AS high,
           coalesce(c, 0) AS "count" FROM lim, unnest(range(1, 31)) AS u(b) LEFT JOIN n ON n.bin = b""")
def histogram_30(spark, d):
    return _rounded(E.histogram(v.table(spark, d, "events"), "value", 30))
