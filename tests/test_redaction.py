import random
import re
import time

import pytest
from conftest import plan
from pyspark.sql import functions as F

from callspark.functions import redaction as R
from callspark.operators import redact
from callspark.operators.transcripts import SEGMENTS

TEXTS = [
    "Call (212) 555-0187 or 212.555.0187 now", "mail jo.d+x@ex-am.co.uk please", "account 123456789 closed",
    "on 3/14/1999 and 1999-03-14 and March 3, 1999", "12 Long Street, Springfield, PA 19101 is home",
    "ssn 123-45-6789 ends 6789", "in 1999", "paid $1,234.50 and $ 7", "a payment of $20", "confirmation number is 12, 34",
    "Confirmation Number ABC", "passport AB1234567", "DL 123456789", "EIN 123456789", "Mr. Smith and Miss Lee, missing",
    "", None, "naïve-x é1x a-b_c end.", "one two foo", "ONE and two.", "seven", "onetwo oneself", "one, two",
    "card 4111-1111-1111-1111", "x12341234123412341234y", "5555 6666 7777 8888 9999 aaaa", "a.b.c..d -e- f_",
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string").repartition(3)


def column(df, col):
    return {r.id: r.r for r in df.select("id", col.alias("r")).collect()}


def expected(fn):
    return {i: None if t is None else fn(t) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("recognizer", R.RECOGNIZERS + R.COMMON_RECOGNIZERS, ids=lambda r: r.entity)
def test_matches_equal_python(texts, recognizer):
    pattern = re.compile(recognizer.regex, re.IGNORECASE)
    got = column(texts, R.matches("text", recognizer))
    assert {i: g or [] for i, g in got.items()} == {
        i: [m.group(0) for m in pattern.finditer(t or "")] for i, t in enumerate(TEXTS)
    }


def test_replace_all_equals_python(texts):
    def chain(t):
        for r in R.in_order(R.RECOGNIZERS):
            t = re.sub(r.regex, lambda m: R.tag(r), t, flags=re.IGNORECASE)
        return t

    assert column(texts, R.replace_all("text")) == expected(chain)


def test_replacement_in_arrow_equals_the_built_in_one(spark):
    rng = random.Random(21)
    parts = ["1234", "12", "5 ", "12345", "19101", " ", ",", ", ", "-", "_", ".", "@", "$", "(212) 555-", "0187", "a", "x.com", "é", "٣", "K", "\n", "\x0b", "\x1c", "\x7f", "\\1",
             "Mr.", "Miss", "confirmation number ", "main st", "payment of $20", "Boston, MA 02134", "March 3, 1999", "AB1234567", "DL 123456789", "EIN123456789", "DE12", "http://a.b/", "192.168.", "4111-1111-"]
    made = TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 18))) for _ in range(4000)]
    df = spark.createDataFrame([(t,) for t in made], "t string").repartition(3)
    for recognizers in (R.RECOGNIZERS, R.without("US_SSN_LAST4"), R.RECOGNIZERS + R.COMMON_RECOGNIZERS):
        both = df.select("t", redact.replace_all("t", recognizers).alias("a"), R.replace_all("t", recognizers).alias("b"))
        assert "ArrowEvalPython" in plan(both)
        assert both.filter(~F.col("a").eqNullSafe(F.col("b"))).limit(3).collect() == []
    own = R.from_config({"pattern_recognizers": {"word": {"name": "w", "regex": r"(?<=a)b++", "score": 0.5}}})
    assert spark.createDataFrame([("abbc",)], "t string").select(redact.replace_all("t", own)).first()[0] == "a<WORD>c"


@pytest.mark.parametrize("name", ["redact_patterns", "redact_patterns_keep_years", "redact_patterns_extended", "redact_text"])
def test_pattern_queries_replace_in_arrow(spark, sf, name):
    from query_catalog import redaction

    assert "ArrowEvalPython" in plan(redaction.QUERIES[name](spark, sf))


JOINED = r"\b\w+([.*\-_]+\w+)+\b"
NUMBERS = r"\b(?:(?:" + "|".join(R.NUMBER_WORDS) + r")\s*)+\b"


def long_numbers(t):
    def mask(m):
        return re.sub(r"\d", "X", m.group(0)[:-4]) + m.group(0)[-4:]

    return re.sub(r"\b(?:\d{4}[-\s]?){2,}(?=\d{4})", mask, t)


def test_sequence_rules_equal_python(texts):
    assert column(texts, R.replace_joined("text")) == expected(lambda t: re.sub(JOINED, "***", t))
    assert column(texts, R.replace_digits("text")) == expected(lambda t: re.sub(r"\b\d+\b", "[REDACTED]", t))
    assert column(texts, R.mask_long_numbers("text")) == expected(long_numbers)
    spoken = expected(lambda t: re.sub(NUMBERS, "[REDACTED]", t, flags=re.IGNORECASE))
    assert column(texts, R.replace_spoken_numbers("text")) == spoken


def test_sequence_rules_in_order(texts):
    def rules(t):
        t = re.sub(JOINED, "***", t)
        t = re.sub(r"\b\d+\b", "[REDACTED]", t)
        t = re.sub(JOINED, "[REDACTED]", t)
        return re.sub(NUMBERS, "[REDACTED]", long_numbers(t), flags=re.IGNORECASE)

    assert column(texts, R.sequence_rules("text")) == expected(rules)


def test_long_runs_do_not_overflow(spark):
    df = spark.createDataFrame([(0, "one two " * 20000 + "x"), (1, "-".join(["a"] * 20000))], "id int, text string")
    assert column(df, R.sequence_rules("text")) == {0: "[REDACTED]x", 1: "***"}


LONG = {
    "list": "confirmation number is " + ", ".join(map(str, range(20_000))) + " $1 @ Mr",
    "dashes": "x" + "-" * 60_000 + " 1@",
    "joined": "a-" * 30_000 + "b 1 @ http",
    "dots": "a." * 30_000 + " 1 @ http",
    "digits": "1234-12341234 " * 10_000 + "@",
    "words": "5 " + "word " * 20_000 + "12 @ http",
    "commas": "$1" + ",000" * 30_000 + " @",
}


@pytest.mark.parametrize("recognizer", R.RECOGNIZERS + R.COMMON_RECOGNIZERS, ids=lambda r: r.entity)
def test_recognizers_on_long_texts(spark, recognizer):
    df = spark.createDataFrame([(t,) for t in LONG.values()], "t string")
    begin = time.perf_counter()
    df.select(R.matches("t", recognizer), F.regexp_replace("t", recognizer.java, "#")).collect()
    assert time.perf_counter() - begin < 30  # quadratic patterns take minutes


@pytest.mark.parametrize("rule", [R.replace_joined, R.replace_digits, R.mask_long_numbers, R.replace_spoken_numbers])
def test_sequence_rules_on_long_texts(spark, rule):
    df = spark.createDataFrame([(t,) for t in LONG.values()], "t string")
    begin = time.perf_counter()
    df.select(rule("t")).collect()
    assert time.perf_counter() - begin < 30


@pytest.mark.parametrize("entity", [r.entity for r in R.RECOGNIZERS if r.linear])
def test_linear_variants_have_the_same_matches(spark, entity):
    r = next(r for r in R.RECOGNIZERS if r.entity == entity)
    rng = random.Random(5)
    parts = ["1234", "12", "5 ", "12345", " ", ",", ", ", "-", "_", ".", "..", "@", "%", "a", "abc", "x.com", ".x@y.org", "q@r.st.uv", "MA", "é",
             "confirmation number ", "main st", "Boston, MA 02134", "\n", "+1"]
    texts = [("".join(rng.choice(parts) for _ in range(rng.randrange(1, 18))),) for _ in range(5000)]
    plain, linear = F.regexp_extract_all("t", F.lit(f"(?iU){r.regex}"), F.lit(0)), F.regexp_extract_all("t", F.lit(r.java), F.lit(r.group))
    assert spark.createDataFrame(texts, "t string").filter(plain != linear).limit(3).collect() == []


def test_addresses_behind_long_domains_and_runs(spark):
    r = next(r for r in R.RECOGNIZERS if r.entity == "EMAIL_ADDRESS")
    rng = random.Random(9)
    texts = [f"{a}{'b' * n}{c}" for n in (1, 63, 64, 65, 999, 1000, 1001, 5000) for a in ("a@", "..a@", "é.a@", "éa@", "a.") for c in (".cc-ddd@e.ff", "@x.yy", ".cc@", ".c-d@e.ff.gg")]
    texts += ["".join(rng.choice("ab.-%@é_ ") for _ in range(rng.randrange(40))) for _ in range(5000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.regexp_extract_all("t", F.lit(f"(?iU){r.regex}"), F.lit(0))
    assert df.filter(R.matches("t", r) != plain).limit(3).collect() == []
    assert df.filter(R.match_count("t", r) != F.size(plain)).limit(3).collect() == []
    assert df.filter(R.replace_all("t", [r]) != F.regexp_replace("t", f"(?iU){r.regex}", "<EMAIL_ADDRESS>")).limit(3).collect() == []


def test_digest_shuts_out_no_match(spark):
    rng = random.Random(11)
    parts = ["1", "12", "123", "1234", "12345678", " ", "-", ".", "/", "(", ")", ", ", "$", "@", "x.com", "AB", "March ", "DL", "EIN", "Main st", "PA ", "19101", "٣", "é", "\n", "amount of ", "a"]
    texts = [("".join(rng.choice(parts) for _ in range(rng.randrange(1, 14))),) for _ in range(6000)]
    texts += [("(212) - 555-0187 1.2.3.4 4111-1111 1111-1111",), ("12 Long Street, Springfield, PA 19101",), ("March 3, 1999 on 3/4/99",), ("$ 7",), (None,)]
    df = spark.createDataFrame(texts, "t string").withColumn("d", R.digest("t"))
    for r in R.RECOGNIZERS + R.COMMON_RECOGNIZERS:
        plain = F.regexp_extract_all("t", F.lit(f"(?iU){r.regex}"), F.lit(0))
        assert df.filter(R.matches("t", r, F.col("d")) != plain).limit(3).collect() == [], r.entity
    everything = R.RECOGNIZERS + R.COMMON_RECOGNIZERS
    one_by_one = F.col("t")
    for r in R.in_order(everything):
        one_by_one = F.regexp_replace(one_by_one, f"(?iU){r.regex}", R.tag(r))
    assert df.filter(R.replace_all("t", everything) != one_by_one).limit(3).collect() == []


def test_redaction_is_idempotent(texts):
    once = texts.select("id", R.redact_text("text").alias("text"))
    assert column(once, R.redact_text("text")) == column(once, F.col("text"))


def test_column_path_has_no_python(texts):
    assert "Python" not in plan(texts.select(R.redact_text("text")))


def test_mask_words_keeps_length(spark):
    df = spark.createDataFrame([(0, "Al met Al.pha and Alan, a+b", ["Al", "a+b", "x"]), (1, "none", [])], "id int, text string, w array<string>")
    masked = column(df, R.mask_words("text", "w"))
    assert masked == {0: "** met **.pha and Alan, ***", 1: "none"}


def test_mask_listed_equals_per_text_list(spark):
    df = spark.createDataFrame([(0, "Ann met Bob, not Bobby"), (1, "nobody"), (2, "Ann Ann")], "id int, text string")
    names = spark.createDataFrame([("Ann",), ("Bob",), ("Bob",)], "name string")
    for rows, most in ((1, 0), (4_000_000, 0), (None, 1_000_000)):
        got = redact.mask_listed(df, "id", "text", names, rows_per_task=rows, max_names=most)
        assert {r.id: r.masked for r in got.collect()} == {0: "*** met ***, not Bobby", 1: "nobody", 2: "*** ***"}


def test_mask_listed_in_tasks_shuffles_nothing(spark):
    odd = ["a, b a", "", None, "é1 naïve_x é1", "-a-", "a" * 3000 + " a", "no\nnames, here", "x\u0301y x", "a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "id int, text string")
    names = spark.createDataFrame([("a",), ("é1",), ("x",), (None,), ("",), ("x\u0301y",)], "name string")
    here, joined = redact.mask_listed(df, "id", "text", names), redact.mask_listed(df, "id", "text", names, max_names=0)
    assert "Exchange" not in plan(here) and "Exchange" in plan(joined)
    assert {r.id: r.masked for r in here.collect()} == {r.id: r.masked for r in joined.collect()}
    assert here.filter("id = 0").first().masked == "*, b *"


def test_mask_account(spark):
    df = spark.createDataFrame([(0, "1234-5678-9012"), (1, "12"), (2, "A1B2C3D4E5")], "id int, text string")
    assert column(df, R.mask_account("text")) == {0: "XXXX-XXXX-9012", 1: "12", 2: "AXB2C3D4E5"}


def test_detect_positions(texts):
    found = redact.detect(texts, "text").collect()
    by_text = {(r.id, r.entity, TEXTS[r.id][r.start:r.end]) for r in found}
    assert (5, "US_SSN", "123-45-6789") in by_text and (5, "US_SSN", "6789") in by_text
    assert (0, "PHONE_NUMBER", "(212) 555-0187") in by_text


def test_digest_shuts_out_no_span():
    rng = random.Random(21)
    parts = ["1", "12", "123", "1234", "12345678", " ", "-", ".", "/", "(", ")", ", ", "$", "@", "x.com", "AB", "March ", "DL", "EIN", "Main st", "PA ", "19101", "٣", "é", "\n", "amount of ", "Mr. ", "confirmation number "]
    everything = R.RECOGNIZERS + R.COMMON_RECOGNIZERS
    patterns = redact._patterns(everything)
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 16)))
        plain = [(R.tag(r)[1:-1], m.start(), m.end(), r.score) for r in everything for m in re.finditer(r.regex, text, re.IGNORECASE) if m.end() > m.start()]
        assert redact._spans(text, patterns) == plain


def test_anonymize_preferences(spark):
    low = R.Recognizer("LOW", r"\d+", 0.3, "")
    high = R.Recognizer("HIGH", r"b\d", 0.9, "")
    wide = R.Recognizer("WIDE", r"[a-z]\d+", 0.3, "")
    df = spark.createDataFrame([("b123 a456 7",), (None,)], "text string")

    def anonymized(prefer):
        return [r.anonymized for r in redact.anonymize(df, "text", (low, high, wide), prefer=prefer).collect()]

    assert anonymized("length") == ["<WIDE> <WIDE> <LOW>", None]
    assert anonymized("score") == ["<HIGH>23 <WIDE> <LOW>", None]


def test_fast_path_and_spans_agree_on_calls(texts):
    # Texts without partly overlapping patterns; there the two ways differ by design.
    some = texts.filter("id in (0, 1, 2, 4, 6, 7, 9, 12, 14, 15)")
    assert column(some, R.replace_all("text")) == column(redact.anonymize(some, "text"), F.col("anonymized"))


def test_redact_segments_keeps_other_fields(spark):
    df = spark.createDataFrame([("f", [(0.0, 1.0, "call 212-555-0187", 0.1), (1.0, 2.0, None, None)])], f"file_path string, t {SEGMENTS}")
    row = df.withColumn("r", R.redact_segments("t")).first()
    assert [s.text for s in row.r] == ["call <***>", None]
    assert [(s.start, s.end, s.no_speech_probability) for s in row.r] == [(0.0, 1.0, 0.1), (1.0, 2.0, None)]
    assert row.t[0].text == "call 212-555-0187"


def test_recognizers_from_config(spark):
    config = {"pattern_recognizers": {
        "zip": {"name": "Z", "regex": r"\b\d{5}\b", "score": 0.5},
        "code": [{"name": "A", "regex": "a+", "score": 0.4}, {"name": "B", "regex": "b+", "score": 0.6}],
    }}
    found = R.from_config(config)
    assert [(r.entity, r.score) for r in found] == [("ZIP", 0.5), ("CODE", 0.4), ("CODE", 0.6)]
    df = spark.createDataFrame([(0, "12345 aabb")], "id int, text string")
    assert column(df, R.replace_all("text", found)) == {0: "<ZIP> <CODE><CODE>"}


def test_quality_counts(spark):
    df = spark.createDataFrame([("in 1999 and 1234", "in 1999 and <US_SSN>")], "o string, r string")
    year = (R.Recognizer("YEAR", r"\b\d{4}\b", 0.5),)
    got = {r.metric: r.value for r in redact.quality(df, "o", "r", year).collect()}
    assert got == {"tokens": 4.0, "marks": 1.0, "matches:YEAR": 2.0, "residual:YEAR": 1.0, "coverage": 0.5, "redacted_share": 0.25}


def test_joined_names_cost_one_pass_over_a_text(spark):
    words = [f"w{i}" for i in range(30_000)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, "none here"), (3, None), (4, "w1-w2.w1 x")], "id int, text string")
    names = spark.createDataFrame([(w,) for w in words], "name string")
    begin = time.time()
    got = {r.id: r.masked for r in redact.mask_listed(df, "id", "text", names, max_names=0).collect()}
    assert time.time() - begin < 20
    assert got == {1: " ".join("*" * len(w) for w in words), 2: "none here", 3: None, 4: "**-**.** x"}


def test_python_forms_have_the_matches_of_the_patterns():
    rng = random.Random(8)
    bits = ["1", "23", "456", "7890", "12345", "(", ")", "-", ".", "/", " ", " ", ",", "_", "é", "٣", "A", "PA", "ſ", "Mr.", "Miss", "March", "ſeptember",
            "Sept", "May", "bill", "amount", "of", "$", "xbill", "Long St", "200-55-1234", "12/3/2001", "555 123 4567", "12345678"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 14))) for _ in range(20_000)]
    texts += [f"{a}{m}{b}" for m in ("(555) 123-4567", "12 Long Street, Springfield, PA 12345", "March 3, 2001", "payment of $1,000.50", "Mrs.", "123456789") for a in bits for b in bits]
    forms = [r for r in R.RECOGNIZERS if r.python]
    assert len(forms) >= 8
    for r in forms:
        plain, form = re.compile(r.regex, re.IGNORECASE), re.compile(r.python, re.IGNORECASE)
        found = [[m.span() for m in plain.finditer(t)] for t in texts]
        assert found == [[m.span() for m in form.finditer(t)] for t in texts] and any(found), r.entity


def test_counts_and_lists_in_arrow_equal_the_built_in_ones(spark):
    rng = random.Random(22)
    parts = ["1234", "5 ", "19101", " ", ", ", "-", ".", "@", "$", "é", "٣", "\n", "\x0b", "\x01", "Mr.", "Miss", "confirmation number ", "payment of $20", "Boston, MA 02134", "x@y.org", "123456789"]
    made = TEXTS + ["payment of $20payment of $30", "Mr.Mr."] + ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 14))) for _ in range(1500)]
    df = spark.createDataFrame([(t,) for t in made], "t string").repartition(3)
    digested = df.withColumn("d", R.digest("t"))
    counts = redact.match_counts(df, {"t": (r"\S+", F.regexp_count("t", F.lit(r"(?U)\S+")))}, R.RECOGNIZERS)
    assert "MapInArrow" in plan(counts)
    got = counts.agg(*[F.sum(F.col("t")[i]) for i in range(len(R.RECOGNIZERS) + 1)]).first()
    want = digested.agg(*[F.sum(R.match_count("t", r, F.col("d"))) for r in R.RECOGNIZERS], F.sum(F.regexp_count("t", F.lit(r"(?U)\S+")))).first()
    assert tuple(got) == tuple(want)
    found = df.select("t", F.explode(redact.match_lists("t", R.RECOGNIZERS)).alias("m")).select("t", "m.*")
    assert "ArrowEvalPython" in plan(found)
    for r in R.RECOGNIZERS:
        each = digested.select("t", F.explode(F.array_distinct(R.matches("t", r, F.col("d")))).alias("match"))
        own = found.filter(F.col("entity") == r.entity).select("t", "match")
        assert each.exceptAll(own).collect() == own.exceptAll(each).collect() == []


def made_texts():
    rng = random.Random(23)
    parts = ["1", "12", "1234", "5 ", "12345678", "19101", " ", " ", ",", ", ", "-", "_", ".", "/", "(", ")", "@", "@x.com", "a", "b.c", "$", "<", ">", "~", '"', "é", "ß", "日", "😀", "٣", "²", "ı", "İ", "ſ", "\u212a", "\u0301", "\u00a0", "\n", "\x00",
             "\x01", "\x0b", "\x1c", "\x7f", "\\1", "Mr.", "Miss", "Mıſs", "confirmation number ", "main st", "payment of $20", "Boston, MA 02134", "March 3, 1999", "AB1234567", "DL 123456789", "EIN123456789", "DE12", "A1B2C3D4E5F6", "http://a.b/", "192.168.", "4111-1111-"]
    return [t or "" for t in TEXTS] + ["".join(rng.choice(parts) for _ in range(rng.randrange(16))) for _ in range(6000)]


def test_spans_of_many_texts_equal_python():
    made = made_texts()
    for some in (made, [t for t in made if t.isascii()], [""], ["é", "none"], ["", "a@b.cc"], ["b" * 4_500_000 + " 1234 é", "5678"]):
        for recognizers in (R.RECOGNIZERS + R.COMMON_RECOGNIZERS, R.RECOGNIZERS[:1], R.without("US_SSN_LAST4")):
            row, which, start, end = redact._Spans(recognizers)(some)
            plain = [(i, k, *m.span()) for i, t in enumerate(some) for k, r in enumerate(recognizers) for m in re.finditer(r.regex, t, re.IGNORECASE)]
            assert list(zip(row.tolist(), which.tolist(), start.tolist(), end.tolist())) == plain


def test_stand_ins_are_of_the_kind_of_their_characters():
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for kind in (r"\w", r"\d", r"\s", "[a-z]", "[A-Z]", *"abcdefghijklmnopqrstuvwxyz", r"[^\s<>\"]", r"[.,$/\-]"):
        pattern = re.compile(kind, re.IGNORECASE)
        assert [c for c in every if bool(pattern.match(c)) != bool(pattern.match(redact._stand_in(c)))] == [], kind


def test_slices_hold_every_text():
    import numpy as np

    most = redact._BYTES
    lengths = np.array([0, most, 1, most - 1, most + 5, 0, 3, most // 2, most // 2, 0], np.int32)
    assert list(redact._slices(lengths)) == [(0, 2), (2, 4), (4, 5), (5, 8), (8, 10)]
    assert list(redact._slices(lengths[:0])) == []


def test_spans_are_found_in_arrow(spark, sf):
    from query_catalog import redaction

    assert "MapInArrow" in plan(redaction.QUERIES["detect_spans"](spark, sf))
    made = made_texts() + [None]
    df = spark.createDataFrame([(None if i % 7 == 0 else i, t, [i]) for i, t in enumerate(made)], "id int, t string, more array<int>").repartition(3)
    patterns = redact._patterns(R.RECOGNIZERS)
    plain = [(None if i % 7 == 0 else i, [i], *span) for i, t in enumerate(made) for span in redact._spans(t, patterns)]
    found = redact.detect(df, "t")
    assert found.columns == ["id", "more", "entity", "start", "end", "score"]
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, plain))
    own = R.from_config({"pattern_recognizers": {"word": {"name": "w", "regex": r"(?<=a)b++", "score": 0.5}}})
    assert [tuple(r) for r in redact.detect(spark.createDataFrame([("abbc",)], "t string"), "t", own).collect()] == [("WORD", 1, 3, 0.5)]
