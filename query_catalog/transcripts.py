"""Segments, merging, counts, chunks, sentences, prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from callspark.functions import text as X
from callspark.operators import transcripts as T
from query_catalog import views as v

QUERIES, SQL = {}, {}


def query(sql=None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn
    return register


def _documents(spark, d):
    return v.table(spark, d, "documents").select("doc_id", "text")


@query("""SELECT concat('call-', conv_id) AS file_path,
        CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INT) AS position,
        turn * 10.0::DOUBLE AS start, turn * 10.0::DOUBLE + 9 AS "end", text, 0.0::DOUBLE AS no_speech_probability
    FROM conversations""")
def transcript_segments(spark, d):
    return T.positions(v.transcripts(spark, d))


@query(f"WITH {v.MERGED} SELECT * FROM merged")
def transcript_merge_segments(spark, d):
    return v.transcripts(spark, d).select("file_path", X.merge_segments("transcription").alias("transcription"))


@query(f"WITH {v.MERGED} SELECT * FROM merged")
def transcript_merge_rows(spark, d):
    rows = v.table(spark, d, "conversations").withColumn("file_path", F.concat(F.lit("call-"), "conv_id"))
    return T.merge_rows(rows, "file_path", "turn", "text")


_COUNTS = rf"""counts AS (
    SELECT doc_id, len(regexp_extract_all(text, '{v.W}+|[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}\s]')) AS word_count,
           len(regexp_extract_all(text, '\S+')) AS token_count FROM documents)"""


@query(f"WITH {_COUNTS} SELECT * FROM counts")
def word_and_token_counts(spark, d):
    return T.with_counts(_documents(spark, d), "text").drop("text")


@query(f"""WITH {_COUNTS} SELECT doc_id, word_count > 50 AS long_enough, token_count < 20 AS too_short,
        token_count > 3900 AS to_split,
        CASE WHEN word_count > 50 AND token_count < 3900 THEN 'actions' ELSE 'No actions generated' END AS actions
    FROM counts""")
def length_gates(spark, d):
    counts = T.with_counts(_documents(spark, d), "text")
    words, tokens = F.col("word_count"), F.col("token_count")
    return counts.select(
        "doc_id", (words > 50).alias("long_enough"), (tokens < 20).alias("too_short"),
        (tokens > 3900).alias("to_split"),
        F.when((words > 50) & (tokens < 3900), "actions").otherwise("No actions generated").alias("actions"),
    )


def _chunk_sql(size, most, overlap):
    return rf"""WITH t AS (SELECT doc_id, regexp_extract_all(text, '\S+') AS w FROM documents), s AS (
        SELECT doc_id, w, len(w) AS n, unnest(range(0, len(w), {size})) AS s FROM t)
    SELECT doc_id, CAST(s // {size} AS INT) AS chunk_no, array_to_string(w[s + 1:least(n, s + {most},
           s + {size} + CASE WHEN s + {size + overlap} < n THEN {overlap} ELSE 0 END)], ' ') AS chunk FROM s"""


@query(_chunk_sql(3200, 3800, 50))
def chunks_default(spark, d):
    return T.chunk(_documents(spark, d), "text")


@query(_chunk_sql(64, 80, 10))
def chunks_small(spark, d):
    return T.chunk(_documents(spark, d), "text", 64, 80, 10)


@query(r"""WITH p AS (SELECT doc_id, string_split(text, '.') AS parts FROM documents), k AS (
        SELECT doc_id, list_filter(parts, lambda s: len(regexp_extract_all(s, '\S+')) >= 5) AS kept FROM p)
    SELECT doc_id, CAST(i - 1 AS INT) AS position, kept[i] AS sentence
    FROM k, unnest(range(1, len(kept) + 1)) AS u(i)""")
def sentences_by_stop(spark, d):
    return _documents(spark, d).select("doc_id", F.posexplode(X.sentences_by_stop("text")).alias("position", "sentence"))


@query("""WITH p AS (SELECT doc_id, string_split_regex(text, '[.!?] ') AS parts FROM documents)
    SELECT doc_id, CAST(i - 1 AS INT) AS position, parts[i] AS sentence FROM p, unnest(range(1, len(parts) + 1)) AS u(i)""")
def sentences_by_mark(spark, d):
    return _documents(spark, d).select("doc_id", F.posexplode(X.sentences_by_mark("text")).alias("position", "sentence"))


@query(r"""SELECT doc_id, concat('Instruction: ', source, '\nContext: ', lang, '\nResponse: ', text) AS text
    FROM documents""")
def instruction_text(spark, d):
    return v.table(spark, d, "documents").select("doc_id", X.instruction_text("source", "lang", "text").alias("text"))


@query("""SELECT conv_id, turn, concat('Summarise what ', role, ' says in turn ', turn, ': ', text, ' End.') AS prompt
    FROM conversations""")
def render_prompt(spark, d):
    template = "Summarise what {who} says in turn {turn}: {text} End."
    return v.table(spark, d, "conversations").select(
        "conv_id", "turn", X.render(template, who="role", turn="turn", text="text").alias("prompt")
    )
