"""Fixtures and small helpers of these tests; test modules import what they use."""

import random

import pytest

#: The columns of documents, and some with names that the operators use inside.
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, n long, sig string, size long, key string, pos int, score double, slot int"


def frame(spark, rows, columns=COLUMNS):
    """Rows of (doc_id, text[, source]) as documents with further columns."""
    filled = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, 1, "x", 2, "k", 3, 0.5, 4) for r in rows]
    return spark.createDataFrame(filled, columns)


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def plan_has_no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas")), plan


@pytest.fixture(scope="session")
def docs(spark):
    return lambda rows: frame(spark, rows)


@pytest.fixture(scope="session")
def edges():
    """Nulls, empty and very long texts, repeated rows, ids that repeat."""
    rng = random.Random(3)
    long = prose(rng, 30_000, 5_000)
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "word", "b"), (5, long, "b"), (5, long, "b"), (6, long, None)]
    rows += [(None, "no id at all " * 9, "a"), (None, None, None), (7, "é" * 70, "a"), (7, "é" * 70, "a"), (8, "€" * 70, "c")]
    return rows
