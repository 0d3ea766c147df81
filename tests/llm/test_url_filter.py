import math
import random
from collections import Counter

import pytest
from tests_support import plan_has_no_python

from callspark.llm import catalog, url_filter


def host_path(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
    tail = rest[end:]
    cut = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return host, tail[:cut]


def rule_of(host, path):
    fits = [r for r in catalog.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.org", "http://example.org/", "https://a.b.Example.ORG/en/12?x=1", "http://example.org/es/#f",
    "http://org/x", "http://notorg/x", "http://x.com/fr/a", "http://x.com/de", "http://x.com/de/", "http://com/de/q?u=http://org/", "http://x.com?/fr/",
    "ftp://u:p@h.org:80/z", "a://b://c/d", "http://É.ORG/ä", "http://x.com/fr/\n/y", "http://" + "a." * 40_000 + "com/fr/" + "b/" * 40_000,
]


def test_hosts_and_rules(spark):
    rows = [(i, u, "x", 1.0) for i, u in enumerate(URLS)] + [(None, URLS[5], "y", 2.0), (1, "", "x", 1.0)]
    table = spark.createDataFrame(rows, "page_id long, url string, host string, score double")
    model = url_filter.fit(spark.createDataFrame([], "url string, label int"))
    out = url_filter.judge(table, model, catalog.URL_RULES)
    plan_has_no_python(out)
    got = out.collect()
    assert len(got) == len(rows)
    want = Counter()
    for i, u, *_ in rows:
        host, path = host_path(u)
        rule = rule_of(host, path)
        want[i, host, path, rule and rule.name] += 1
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in got) == want
    verdicts = {r.name: r.verdict for r in catalog.URL_RULES}
    assert all(r["verdict"] == verdicts.get(r["rule"], r["verdict"]) and r["verdict"] in ("allow", "block") for r in got)
    assert url_filter.judge(table.limit(0), model, catalog.URL_RULES).collect() == []


def test_trees_learn_and_equal_their_expression(spark):
    rng = random.Random(17)

    def url():
        bad = rng.random() < 0.4
        if bad:
            return f"http://{rng.choice('xyz')}{rng.randrange(10**6)}.spam{rng.randrange(3)}.info/{'/'.join(str(rng.randrange(999)) for _ in range(6))}?a=1&b=2&c=3", 1
        return f"https://www.site{rng.randrange(5)}.org/{rng.choice(['news', 'about', 'essay'])}/{rng.choice(['one', 'two'])}", 0

    rows = [url() for _ in range(1200)]
    model = url_filter.fit(spark.createDataFrame(rows[:800], "url string, label int"))
    table = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows[800:])], "page_id long, url string")
    got = {r["page_id"]: r for r in url_filter.judge(table, model, []).collect()}
    right = sum((got[i]["verdict"] == "block") == bool(label) for i, (_, label) in enumerate(rows[800:]))
    assert right / 400 > 0.97


def test_entropy(spark):
    texts = ["", "aaaa", "ab", "abcdé€", "aab"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(url_filter.entropy(url_filter.F.col("t"))).collect()]
    for t, e in zip(texts, got, strict=True):
        assert e == pytest.approx(-sum(n / len(t) * math.log2(n / len(t)) for n in Counter(t).values()) if t else 0)


def test_suffixes_are_counted_over_all_labelled_urls(spark, monkeypatch):
    rng = random.Random(23)
    # 1,500 suffixes, of which the sample below can't hold a fifth; nothing but the suffix tells the labels.
    rows = [(f"http://www.host{i:04d}.org/{rng.randrange(10**6):06d}", i % 3 == 0) for i in range(1500) for _ in range(12)]
    labelled = spark.createDataFrame([(u, int(b)) for u, b in rows], "url string, label int")
    table = spark.createDataFrame([(i, f"http://www.host{i:04d}.org/{rng.randrange(10**6):06d}") for i in range(1500)], "page_id long, url string")
    small = url_filter.Settings(sample=300)
    model = url_filter.fit(labelled, small)
    want, prior = {r[0]: r[1:] for r in model.statistics.collect()}, model.prior
    assert len(want) == 1500 and prior == pytest.approx(6001 / 18002)
    assert all(count == pytest.approx(math.log(13)) for _, count in want.values())
    assert sorted({round(rate, 9) for rate, _ in want.values()}) == [round((b + 20 * prior) / 32, 9) for b in (0, 12)]
    verdicts = [tuple(r) for r in url_filter.judge(table, model, []).orderBy("page_id").collect()]
    assert all((r[4] == "block") == (r[0] % 3 == 0) for r in verdicts)
    # A table too large to be sent gives the same.
    monkeypatch.setattr(url_filter, "SENT_SUFFIXES", 10)
    out = url_filter.judge(table, url_filter.fit(labelled, small), [])
    assert [tuple(r) for r in out.orderBy("page_id").collect()] == verdicts
