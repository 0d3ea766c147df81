import hashlib
import random
import re
import time

from tests_support import docs, edges, frame, prose  # noqa: F401

from callspark.llm import fill_middle as fim


def plain_cut(units, k):
    """Code points and bytes before unit k, by walking."""
    before = "".join(units[:k])
    return len(before.encode()), len(before)


def texts(rng):
    letters = "ab é€😀\n"
    out = ["".join(rng.choice(letters) for _ in range(rng.randrange(3000))) for _ in range(30)]
    return [*out, "", "a", "😀" * 700, "x" * 1024, "é" * 512, "x" * 1023 + "é", "<P> in text", "word " * 900]


def test_cuts_equal_walking():
    rng = random.Random(1)
    for block in (1, 7, 1024):
        for text in texts(rng):
            cutter = fim.Cutter(text, block=block)
            assert cutter.n == len(text)
            for k in {0, 1, len(text) // 2, len(text), *(rng.randrange(len(text) + 1) for _ in range(5))}:
                if k <= len(text):
                    assert cutter.cut(k) == plain_cut(list(text), k)


def test_cuts_by_words():
    pattern = re.compile(r"\s*\S+\s*|\s+", re.S)
    rng = random.Random(2)
    for text in texts(rng):
        units = pattern.findall(text)
        cutter = fim.Cutter(text, pattern, block=16)
        assert cutter.n == len(units)
        for k in range(0, len(units) + 1, max(1, len(units) // 7)):
            assert cutter.cut(k) == plain_cut(units, k)
    one = fim.Cutter("y" * 5000 + " z", pattern, block=16)  # a unit over many blocks
    assert one.cut(1) == (5001, 5001)


def test_fenwick_descends_over_empty_blocks():
    import numpy as np

    for counts in ([0, 0, 3, 0, 0, 2, 0], [1], [0, 1], [5, 0, 0, 0, 1]):
        tree = fim.Fenwick(np.array(counts))
        ends = [sum(counts[: i + 1]) for i in range(len(counts))]
        assert [tree.sum(i + 1) for i in range(len(counts))] == ends
        for wanted in range(sum(counts)):
            block, rest = tree.descend(wanted)
            assert block == next(i for i, e in enumerate(ends) if e > wanted)
            assert rest == wanted - sum(counts[:block])


def plain(doc_id, text):
    """The contract, written out."""
    text = text or ""
    digest = hashlib.sha256(("1:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_table_equals_plain_version(spark, edges):
    rng = random.Random(5)
    rows = edges + [(i, t) for i, t in enumerate(texts(rng), 100)] + [(1000 + i, prose(rng, i)) for i in range(60)]
    got = fim.transformed(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = sorted(((r[0], *plain(r[0], r[1]), r[1] or "") for r in rows), key=repr)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in got), key=repr) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_restored_next_to_parts_of_markers():
    for text in ("<", "S>", "<S", "P><M", "<<<>>>", "<<S", "M>" * 5):
        for i in range(40):
            made = fim.transform(i, text)
            assert fim.restored(made.form, made.output) == text


def test_no_rows(spark):
    assert fim.transformed(frame(spark, [])).count() == 0


def test_long_text_is_linear():
    begin = time.time()
    made = fim.transform(3, "é line of words\n" * 1_000_000)
    assert time.time() - begin < 10 and made.n == 16_000_000
