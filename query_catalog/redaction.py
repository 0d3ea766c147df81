"""Every recognizer, the replacement chain, the sequence rules, masking, quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from callspark.functions import redaction as R
from callspark.operators import redact
from query_catalog import views as v

QUERIES, SQL = {}, {}


def query(sql=None, name=None):
    def register(fn):
        QUERIES[name or fn.__name__] = fn
        if sql is not None:
            SQL[name or fn.__name__] = sql
        return fn
    return register


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def pattern(recognizer: R.Recognizer) -> str:
    return literal(f"(?i){recognizer.regex}")


def _find(recognizer):
    sql = f"""WITH {v.TEXTS}, m AS (SELECT text_id, regexp_extract_all(text, {pattern(recognizer)}) AS m FROM texts)
        SELECT text_id, CAST(i - 1 AS INT) AS match_no, m[i] AS match FROM m, unnest(range(1, len(m) + 1)) AS u(i)"""

    @query(sql, f"find_{recognizer.entity.lower()}")
    def find(spark, d):
        return redact.find(v.texts(spark, d), "text", recognizer)


for _recognizer in R.RECOGNIZERS + R.COMMON_RECOGNIZERS:
    _find(_recognizer)


def _replaced(expression: str, recognizers=R.RECOGNIZERS) -> str:
    for r in R.in_order(recognizers):
        expression = f"regexp_replace({expression}, {pattern(r)}, '{R.tag(r)}', 'g')"
    return expression


def _sequence(expression: str) -> str:
    expression = rf"regexp_replace({expression}, '{v.W}+([.*\-_]+{v.W}+)+', '***', 'g')"
    expression = rf"regexp_replace({expression}, '\b\d+\b', '[REDACTED]', 'g')"
    return _spoken(expression)


def _spoken(expression: str) -> str:
    words = "|".join(R.NUMBER_WORDS)
    return rf"regexp_replace({expression}, '(?i)\b(?:(?:{words})\s*(?:\s+and\s+)?)+\b', '[REDACTED]', 'g')"


@query(f"WITH {v.TEXTS} SELECT text_id, {_replaced('text')} AS text FROM texts")
def redact_patterns(spark, d):
    return v.texts(spark, d).select("text_id", redact.replace_all("text").alias("text"))


@query(f"WITH {v.TEXTS} SELECT text_id, {_replaced('text', R.without('US_SSN_LAST4'))} AS text FROM texts")
def redact_patterns_keep_years(spark, d):
    kept = R.without("US_SSN_LAST4")
    return v.texts(spark, d).select("text_id", redact.replace_all("text", kept).alias("text"))


@query(f"WITH {v.TEXTS} SELECT text_id, {_replaced('text', R.RECOGNIZERS + R.COMMON_RECOGNIZERS)} AS text FROM texts")
def redact_patterns_extended(spark, d):
    return v.texts(spark, d).select(
        "text_id", redact.replace_all("text", R.RECOGNIZERS + R.COMMON_RECOGNIZERS).alias("text")
    )


@query(rf"WITH {v.TEXTS} SELECT text_id, regexp_replace(text, '{v.W}+([.*\-_]+{v.W}+)+', '***', 'g') AS text FROM texts")
def replace_joined(spark, d):
    return v.texts(spark, d).select("text_id", R.replace_joined("text").alias("text"))


@query(rf"WITH {v.TEXTS} SELECT text_id, regexp_replace(text, '\b\d+\b', '[REDACTED]', 'g') AS text FROM texts")
def replace_digits(spark, d):
    return v.texts(spark, d).select("text_id", R.replace_digits("text").alias("text"))


@query(f"WITH {v.TEXTS} SELECT text_id, {_spoken('text')} AS text FROM texts")
def replace_spoken_numbers(spark, d):
    return v.texts(spark, d).select("text_id", R.replace_spoken_numbers("text").alias("text"))


# The group after the match is matched along with it, and put back unchanged.
_LONG = r"'\b(?:\d{4}[-\s]?){2,}\d{4}'"


@query(rf"""WITH {v.TEXTS}, p AS (
        SELECT text_id, string_split_regex(text, {_LONG}) AS gaps, regexp_extract_all(text, {_LONG}) AS found FROM texts)
    SELECT text_id, array_to_string(list_transform(gaps, lambda g, i: g || CASE WHEN i > len(found) THEN '' ELSE
           regexp_replace(left(found[i], -8), '\d', 'X', 'g') || right(found[i], 8) END), '') AS text FROM p""")
def mask_long_numbers(spark, d):
    return v.texts(spark, d).select("text_id", R.mask_long_numbers("text").alias("text"))


@query(f"WITH {v.TEXTS} SELECT text_id, {_sequence('text')} AS text FROM texts")
def sequence_rules(spark, d):
    return v.texts(spark, d).select("text_id", R.sequence_rules("text").alias("text"))


@query(f"WITH {v.TEXTS} SELECT text_id, {_sequence(_replaced('text'))} AS text FROM texts")
def redact_text(spark, d):
    return v.texts(spark, d).select("text_id", R.sequence_rules(redact.replace_all("text")).alias("text"))


@query(r"""WITH a AS (SELECT o_orderkey, concat(lpad(CAST(o_custkey AS VARCHAR), 4, '0'), '-',
        lpad(CAST(o_orderkey AS VARCHAR), 8, '0')) AS account FROM orders)
    SELECT o_orderkey, regexp_replace(left(account, -4), '\d', 'X', 'g') || right(account, 4) AS account FROM a""")
def mask_account(spark, d):
    account = F.expr("concat(lpad(CAST(o_custkey AS STRING), 4, '0'), '-', lpad(CAST(o_orderkey AS STRING), 8, '0'))")
    return v.table(spark, d, "orders").select("o_orderkey", R.mask_account(account).alias("account"))


@query(f"""SELECT concat('call-', conv_id) AS file_path, turn * 10.0::DOUBLE AS start, text AS original,
        {_sequence(_replaced('text'))} AS redacted FROM conversations""")
def redact_segments(spark, d):
    calls = v.transcripts(spark, d).withColumn("redacted", R.redact_segments("transcription"))
    pairs = calls.select("file_path", F.explode(F.arrays_zip("transcription", "redacted")).alias("p"))
    return pairs.select(
        "file_path", F.col("p.redacted.start").alias("start"), F.col("p.transcription.text").alias("original"),
        F.col("p.redacted.text").alias("redacted"),
    )


_NAMES = rf"""names AS (
    SELECT DISTINCT name FROM (SELECT unnest(regexp_extract_all(text, '{v.W}+')) AS name FROM benchmark)), listed AS (SELECT list(name) AS all_names FROM names)"""


def _names(spark, d):
    words = F.regexp_extract_all("text", F.lit(r"(?U)\w+"), F.lit(0))
    return v.table(spark, d, "benchmark").select(F.explode(words).alias("name")).distinct()


@query(rf"""WITH {_NAMES} SELECT doc_id, array_to_string(list_transform(
        regexp_extract_all(text, '{v.W}+|[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}]+'),
        lambda t: CASE WHEN list_contains(all_names, t) THEN repeat('*', length(t)) ELSE t END), '') AS masked
    FROM documents, listed""")
def mask_listed_names(spark, d):
    documents = v.table(spark, d, "documents").select("doc_id", "text")
    return redact.mask_listed(documents, "doc_id", "text", _names(spark, d)).drop("text")


@query(rf"""WITH {_NAMES} SELECT doc_id, array_to_string(list_transform(
        regexp_extract_all(text, '{v.W}+|[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}]+'),
        lambda t: CASE WHEN list_contains(all_names, t) THEN repeat('*', length(t)) ELSE t END), '') AS masked
    FROM documents, listed""")
def mask_joined_names(spark, d):
    documents = v.table(spark, d, "documents").select("doc_id", "text")
    return redact.mask_listed(documents, "doc_id", "text", _names(spark, d), max_names=0).drop("text")


@query(rf"""SELECT conv_id, turn, array_to_string(list_transform(
        regexp_extract_all(text, '{v.W}+|[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}]+'),
        lambda t: CASE WHEN t = regexp_extract(text, '{v.W}+') THEN repeat('*', length(t)) ELSE t END), '') AS text
    FROM conversations""")
def mask_words_of_text(spark, d):
    first = F.array(F.regexp_extract("text", r"(?U)\w+", 0))
    return v.table(spark, d, "conversations").select("conv_id", "turn", R.mask_words("text", first).alias("text"))


def _detect_sql():
    one = """SELECT text_id, '{tag}' AS entity, {score}::DOUBLE AS score,
        list_sum(list_transform(gaps[1:i], lambda g: length(g))) +
        coalesce(list_sum(list_transform(found[1:i - 1], lambda f: length(f))), 0) AS start, length(found[i]) AS size
    FROM (SELECT text_id, string_split_regex(text, {p}) AS gaps, regexp_extract_all(text, {p}) AS found FROM texts),
         unnest(range(1, len(found) + 1)) AS u(i)"""
    parts = [one.format(tag=R.tag(r)[1:-1], score=r.score, p=pattern(r)) for r in R.RECOGNIZERS]
    return f"WITH {v.TEXTS}, spans AS ({' UNION ALL '.join(parts)})"


@query(f"""{_detect_sql()} SELECT text_id, entity, CAST(start AS INT) AS start, CAST(start + size AS INT) AS "end",
        score FROM spans""")
def detect_spans(spark, d):
    return redact.detect(v.texts(spark, d), "text")


_ORDER = " ".join(f"WHEN '{R.tag(r)[1:-1]}' THEN {i}" for i, r in reversed(list(enumerate(R.RECOGNIZERS))))

_KEPT = f"""{_detect_sql().replace('WITH ', 'WITH RECURSIVE ', 1)}, ranked AS (
    SELECT text_id, entity, CAST(start AS BIGINT) AS s, CAST(start + size AS BIGINT) AS e, row_number() OVER (
        PARTITION BY text_id ORDER BY size DESC, score DESC, start, CASE entity {_ORDER} END) AS rn FROM spans), greedy AS (
    SELECT DISTINCT text_id, 0::BIGINT AS rn, CAST([] AS STRUCT(s BIGINT, e BIGINT, t VARCHAR)[]) AS kept FROM ranked
    UNION ALL
    SELECT g.text_id, r.rn, CASE WHEN len(list_filter(g.kept, lambda k: k.s < r.e AND r.s < k.e)) = 0
           THEN list_append(g.kept, {{'s': r.s, 'e': r.e, 't': r.entity}}) ELSE g.kept END
    FROM greedy g JOIN ranked r ON r.text_id = g.text_id AND r.rn = g.rn + 1), final AS (
    SELECT text_id, list_sort(arg_max(kept, rn)) AS k FROM greedy GROUP BY text_id)"""


@query(f"""{_KEPT} SELECT text_id, CASE WHEN k IS NULL THEN text ELSE array_to_string(list_transform(k, lambda x, i:
        substr(text, coalesce(k[i - 1].e, 0) + 1, x.s - coalesce(k[i - 1].e, 0)) || '<' || x.t || '>'), '')
        || substr(text, k[-1].e + 1) END AS anonymized
    FROM texts LEFT JOIN final USING (text_id)""")
def anonymize_spans(spark, d):
    return redact.anonymize(v.texts(spark, d), "text").select("text_id", "anonymized")


#: Spans as a model would give them: the first word of a text, and characters 3 to 12.
_MODEL_SPANS = {"FIRST": ("0", "length(regexp_extract(text, '^[A-Za-z]+', 0))", 0.95), "MIDDLE": ("3", "12", 0.55)}

_KEPT_MODEL = _KEPT.replace(
    "ranked AS (", "all_spans AS (SELECT text_id, entity, score, start, size FROM spans UNION ALL " + " UNION ALL ".join(
        f"SELECT text_id, '{e}', {score}::DOUBLE, {a}, {b} - {a} FROM texts WHERE {b} > {a} AND {b} <= length(text)"
        for e, (a, b, score) in _MODEL_SPANS.items()
    ).replace("regexp_extract(text, '^[A-Za-z]+', 0)", "regexp_extract(text, '^[A-Za-z]+')") + "), ranked AS (", 1,
).replace("END) AS rn FROM spans)", "ELSE 100 END, entity) AS rn FROM all_spans)", 1)


@query(f"""{_KEPT_MODEL} SELECT text_id, CASE WHEN k IS NULL THEN text ELSE array_to_string(list_transform(k, lambda x, i:
        substr(text, coalesce(k[i - 1].e, 0) + 1, x.s - coalesce(k[i - 1].e, 0)) || '<' || x.t || '>'), '')
        || substr(text, k[-1].e + 1) END AS anonymized
    FROM texts LEFT JOIN final USING (text_id)""")
def anonymize_with_model_spans(spark, d):
    given = F.array(*[
        F.struct(F.lit(e).alias("entity"), F.expr(a).cast("int").alias("start"), F.expr(b).cast("int").alias("end"), F.lit(score).alias("score"))
        for e, (a, b, score) in _MODEL_SPANS.items()
    ])
    texts = v.texts(spark, d).withColumn("given", given)
    return redact.anonymize(texts, "text", spans="given").select("text_id", "anonymized")


def _quality_sql():
    def counts(column, kind):
        return ", ".join(
            f"sum(len(regexp_extract_all({column}, {pattern(r)}))) AS \"{kind}:{r.entity}\"" for r in R.RECOGNIZERS
        )

    before = " + ".join(f'"matches:{r.entity}"' for r in R.RECOGNIZERS)
    after = " + ".join(f'"residual:{r.entity}"' for r in R.RECOGNIZERS)
    return rf"""WITH {v.TEXTS}, r AS (SELECT text, {_replaced('text')} AS redacted FROM texts), totals AS (
        SELECT sum(len(regexp_extract_all(text, '\S+'))) AS tokens,
               sum(len(regexp_extract_all(redacted, '<[A-Z_]+>|\[REDACTED\]|\*{{3,}}'))) AS marks,
               {counts('text', 'matches')}, {counts('redacted', 'residual')} FROM r), wide AS (
        SELECT * , 1 - ({after})::DOUBLE / ({before}) AS coverage, marks::DOUBLE / tokens AS redacted_share FROM totals),
        wide_double AS (SELECT COLUMNS(*)::DOUBLE FROM wide)
    SELECT metric, round(value, 6) AS value FROM wide_double UNPIVOT (value FOR metric IN (COLUMNS(*)))"""


@query(_quality_sql())
def redaction_quality(spark, d):
    texts = v.texts(spark, d).withColumn("redacted", redact.replace_all("text"))
    return redact.quality(texts, "text", "redacted").withColumn("value", F.round("value", 6))


def _consistency_sql():
    found = " UNION ALL ".join(
        f"SELECT '{r.entity}' AS entity, redacted, unnest(list_distinct(regexp_extract_all(text, {pattern(r)}))) AS m FROM r"
        for r in R.RECOGNIZERS
    )
    return f"""WITH {v.TEXTS}, r AS (SELECT text, {_replaced('text')} AS redacted FROM texts), found AS ({found}),
        per_match AS (SELECT entity, m, count(*) FILTER (contains(redacted, m)) AS kept, count(*) AS texts
                      FROM found GROUP BY entity, m)
    SELECT entity, count(*) AS distinct_matches, count(*) FILTER (kept = 0 OR kept = texts) AS treated_alike
    FROM per_match GROUP BY entity"""


@query(_consistency_sql())
def redaction_consistency(spark, d):
    texts = v.texts(spark, d).withColumn("redacted", redact.replace_all("text"))
    return redact.consistency(texts, "text", "redacted")
