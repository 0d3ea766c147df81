"""The registered queries of the operators, over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callspark.llm import (
    decontaminate,
    fill_middle,
    html_text,
    jaccard_join,
    language_model,
    lexical_search,
    mixing,
    quality,
    repeat_removal,
    secret_scan,
    sharding,
    toxicity,
    url_filter,
)
from callspark.llm.common import table


def op1_html_text(spark: SparkSession, d: str) -> DataFrame:
    return html_text.extract(table(spark, d, "pages"))


def op2_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.report(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op3_sharding(spark: SparkSession, d: str) -> DataFrame:
    return sharding.shard(table(spark, d, "documents"))[0]


#: The rules of the contract.
URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


def labelled_urls(spark: SparkSession, d: str) -> DataFrame:
    """URLs of pages whose document, named by the number in the path, has labels: 1 for toxic or of low quality."""
    number = F.regexp_extract("url", r"^[^?#]*/(\d{1,18})(?:\.html|/)?(?:[?#]|$)", 1)
    pages = table(spark, d, "pages", "url").withColumn("n", number).select("url", F.expr("try_cast(n AS bigint)").alias("doc_id"))
    labels = table(spark, d, "labels", "doc_id", "quality", "toxic")
    blocked = (F.col("toxic") == 1) | (F.col("quality") == 0)
    return pages.join(labels, "doc_id").select("url", blocked.cast("int").alias("label"))


def op4_url_filter(spark: SparkSession, d: str) -> DataFrame:
    model = url_filter.fit(labelled_urls(spark, d))
    return url_filter.judge(table(spark, d, "pages", "page_id", "url"), model, URL_RULES)


def op5_secrets(spark: SparkSession, d: str) -> DataFrame:
    return secret_scan.find(table(spark, d, "documents"))


def op6_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixed(table(spark, d, "documents"))


def op7_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return jaccard_join.linked(table(spark, d, "documents"))


def op8_toxicity(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, d, "labels")))


def op9_quality_ledger(spark: SparkSession, d: str) -> DataFrame:
    book = quality.stored(table(spark, d, "documents"))
    # Both policies are read off the stored bits.
    base = F.col("failed").bitwiseAND(F.lit(quality.BASE.mask)) != 0
    return quality.verdicts(book, quality.STRICT).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "failed"
    )


def quality_ablation(spark: SparkSession, d: str) -> DataFrame:
    """Per policy and rule the documents that break it, and those that no other rule of the policy rejects."""
    book = quality.stored(table(spark, d, "documents"))
    parts = [quality.ablation(book, p).withColumn("policy", F.lit(p.version)) for p in (quality.BASE, quality.STRICT)]
    return parts[0].unionByName(parts[1])


def op10_repeat_removal(spark: SparkSession, d: str) -> DataFrame:
    return repeat_removal.report(table(spark, d, "documents"))


def op11_language_model(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents")
    return language_model.score(documents, language_model.train(documents))


def op12_lexical_search(spark: SparkSession, d: str) -> DataFrame:
    index = lexical_search.build(table(spark, d, "documents"))
    return lexical_search.search(index, table(spark, d, "benchmark")).select("item_id", "rank", "doc_id", "score")


def op13_fill_middle(spark: SparkSession, d: str) -> DataFrame:
    made = fill_middle.transformed(table(spark, d, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_decontamination": op2_decontamination,
    "op3_sharding": op3_sharding,
    "op4_url_filter": op4_url_filter,
    "op5_secrets": op5_secrets,
    "op6_mixing": op6_mixing,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_toxicity": op8_toxicity,
    "op9_quality_ledger": op9_quality_ledger,
    "quality_ablation": quality_ablation,
    "op10_repeat_removal": op10_repeat_removal,
    "op11_language_model": op11_language_model,
    "op12_lexical_search": op12_lexical_search,
    "op13_fill_middle": op13_fill_middle,
}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_LEDGER = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_SPACED} AS w FROM documents),
        lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
        line_counts AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
                  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
        windows AS (SELECT doc_id, s, array_to_string(w[s : s + 7], ' ') AS g
                    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS s FROM d)),
        again AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1),
        repeated AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
                     FROM (SELECT doc_id, unnest(range(s, s + 8)) AS p FROM again) GROUP BY doc_id),
        m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
                     CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                     CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                     coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                     coalesce(n_lines, 0) AS n_lines,
                     length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals
              FROM d LEFT JOIN line_counts USING (doc_id) LEFT JOIN repeated USING (doc_id)),
        f AS (SELECT *, CASE WHEN n_words < 20 THEN 1 ELSE 0 END
                 + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
                 + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
                 + CASE WHEN n_lines >= 4 AND 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
                 + CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words) THEN 16 ELSE 0 END
                 + CASE WHEN n_words > 0 AND 2 * n_capitals > word_chars THEN 32 ELSE 0 END AS failed
              FROM m)"""

SQL = {
    "op2_decontamination": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        sized AS (SELECT item_id, w, least(10, len(w)) AS k FROM i WHERE len(w) > 0),
        windows AS (
            SELECT DISTINCT item_id, k, array_to_string(w[s : s + k - 1], ' ') AS g
            FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM sized)),
        spots AS (
            SELECT doc_id, k, s, array_to_string(w[s : s + k - 1], ' ') AS g
            FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
                  FROM d, (SELECT DISTINCT k FROM windows))),
        found AS (SELECT doc_id, item_id, s, k FROM spots JOIN windows USING (k, g)),
        hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM found) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS all_items
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(all_items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_jaccard_join": """
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        g AS (
            SELECT DISTINCT doc_id, array_to_string(w[s : s + 4], ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS s FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
        pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
            FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
            WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reached AS (
            SELECT doc_id AS node, doc_id AS other FROM d
            UNION
            SELECT r.node, l.b FROM reached r JOIN both_ways l ON l.a = r.other)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
        FROM d LEFT JOIN n USING (doc_id)
        JOIN (SELECT node AS doc_id, min(other) AS component_id FROM reached GROUP BY node) c USING (doc_id)""",
    "op9_quality_ledger": f"""{_LEDGER}
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               failed & 3 != 0 AS base_failed, failed = 0 AS kept, failed FROM f""",
    "quality_ablation": f"""{_LEDGER},
        rules AS (SELECT * FROM (VALUES ('few_words', 1), ('repeated_windows', 2), ('symbols', 4), ('repeated_lines', 8),
                                        ('word_length', 16), ('capitals', 32)) v(rule, b)),
        policies AS (SELECT * FROM (VALUES (1, 3), (2, 63)) v(policy, mask))
        SELECT rule, count(*) FILTER (failed & b != 0) AS n_failed, count(*) FILTER (failed & mask = b) AS n_only, policy
        FROM f, rules, policies WHERE b & mask != 0 GROUP BY rule, policy""",
    "op12_lexical_search": rf"""
        WITH t AS (SELECT row_number() OVER () AS row_id, doc_id, {_TERMS} AS w FROM documents),
        d AS (SELECT row_id, doc_id, len(w) AS n, w FROM t WHERE len(w) > 0),
        totals AS (SELECT count(*) AS documents, sum(n) AS total FROM d),
        tf AS (SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(w) AS term FROM d) GROUP BY row_id, term),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        items AS (SELECT row_number() OVER () AS item_row, item_id, {_TERMS} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
        q AS (SELECT item_row, item_id, term, count(*) AS repeats
              FROM (SELECT item_row, item_id, unnest(w) AS term FROM items) GROUP BY ALL),
        scored AS (
            SELECT item_row, item_id, row_id, doc_id, CAST(sum(repeats * CAST(floor(1000 * ln((2.0 * documents + 2) / (2.0 * df + 1))) AS BIGINT)
                       * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * documents) // CAST(total AS BIGINT))))) AS BIGINT) AS score
            FROM q JOIN df USING (term) JOIN tf USING (term) JOIN d USING (row_id), totals GROUP BY ALL),
        ranked AS (
            SELECT item_id, doc_id, score,
                   CAST(row_number() OVER (PARTITION BY item_row ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank
            FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20""",
    "op13_fill_middle": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        h AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n,
                     CAST(CAST('0x' || h[1:8] AS UBIGINT) AS BIGINT) AS h1, CAST(CAST('0x' || h[9:16] AS UBIGINT) AS BIGINT) AS h2,
                     CAST(CAST('0x' || h[17:24] AS UBIGINT) AS BIGINT) AS h3, CAST(CAST('0x' || h[25:32] AS UBIGINT) AS BIGINT) AS h4 FROM t),
        c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                     CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                          WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
        p AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c)
        SELECT doc_id, n, form, CASE WHEN form != 'plain' THEN a END AS prefix_chars, CASE WHEN form != 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                                ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
               sha256(t) AS restored_sha256 FROM p""",
}
