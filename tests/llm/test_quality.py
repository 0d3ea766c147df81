import random
import re
from collections import Counter

from tests_support import docs, edges, plan_has_no_python  # noqa: F401

from callspark.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures(spark, docs, edges):
    rng = random.Random(5)
    rows = list(edges)
    for i in range(100, 160):
        words = [f"w{rng.randrange(3 if i % 2 else 300)}" for _ in range(rng.randrange(0, 90))]
        rows.append((i, "".join(w + rng.choice([" ", "\n", "\t\x0b", " # ", "\u00a0"]) for w in words)))
    rows += [(200, "a b c d e f g h " * 500), (201, "same line\n" * 50), (202, "x " * 40_000), (203, "a b c d e f g h"), (204, "a b c d e f g h i a b c d e f g h")]
    got = quality.ledger(docs(rows)).collect()
    assert len(got) == len(rows)
    want = Counter((i, *brute(t)) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want
    assert quality.ledger(docs(rows).limit(0)).collect() == []


def test_policies_and_ablation(spark, docs):
    rows = [(1, "few"), (2, "### " * 30 + " ".join(f"w{i}" for i in range(40))), (3, " ".join(f"w{i}" for i in range(30))), (4, "GO HOME NOW")]
    book = quality.ledger(docs(rows))
    strict = {r["doc_id"]: r["kept"] for r in quality.verdicts(book).collect()}
    base = {r["doc_id"]: r["kept"] for r in quality.verdicts(book, quality.BASE).collect()}
    assert strict == {1: False, 2: False, 3: True, 4: False}
    assert not base[1] and base[3]
    masks = [r["failed"] for r in book.collect()]
    for r in quality.ablation(book).collect():
        bit = quality.bit(r["rule"])
        assert r["n_failed"] == sum(m & bit > 0 for m in masks) and r["n_only"] == sum(m == bit for m in masks)


def test_native(spark, docs):
    plan_has_no_python(quality.verdicts(quality.ledger(docs([(1, "a")]))))


def test_policies_and_ablation_read_the_stored_bits(spark, docs, edges):
    from callspark.llm import catalog

    book = quality.stored(docs(edges + [(50, "# " * 40), (51, "AB CD " * 30), (52, "a b"), (53, "word " * 40)]))
    assert "FileScan" in book._jdf.queryExecution().executedPlan().toString()
    masks = [r["failed"] for r in book.collect()]
    for policy in (quality.BASE, quality.STRICT):
        kept = [r["kept"] for r in quality.verdicts(book, policy).collect()]
        assert sum(kept) == sum(not m & policy.mask for m in masks)
        for r in quality.ablation(book, policy).collect():
            own = quality.bit(r["rule"])
            assert r["n_failed"] == sum(bool(m & own) for m in masks)
            assert r["n_only"] == sum(m & policy.mask == own for m in masks)
    assert "quality_ablation" in catalog.QUERIES and "quality_ablation" in catalog.SQL
