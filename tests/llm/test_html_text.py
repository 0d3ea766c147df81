import pytest

from callspark.llm import catalog, html_text
from callspark.llm.html_text import main_text

LONG = "The rain in the north is a matter of record, and it was for the people of the coast that the tables were made by hand."


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("plain text", "plain text"),
        ("<p>Short.</p>", "Short."),
        (f"<nav><a href=/>Home</a></nav><article><h1>Title</h1><p>{LONG}</p><p>Yes.</p></article><footer>{LONG}</footer>", f"Title {LONG} Yes."),
        (f"<header>Site {LONG}</header><main><p>{LONG}</p></main>", LONG),
        ("<article><header><h1>Head</h1></header><p>Body.</p></article>", "Head Body."),
        (f"<article><p>One&nbsp;&amp;&#x20;two &eacute;\n\t x</p><div class='ad'>{LONG}</div><p>End</p></article>", "One & two é x End"),
        ("<article><p>a<b>b</b>c<br>d<p>e</article>", "abc d e"),
        ("<article><script>var t='</p>';</script><style>p{}</style>Text<!-- no --></article>", "Text"),
        ("<article>Text<script>never closed", "Text"),
        (f"<article>Text</article><section id='comments'><article class='comment'>{LONG}</article></section>", "Text"),
        (f"<article><p>Text</p><div class='user-comments'><p>{LONG}</p></div><aside>{LONG}</aside><form>{LONG}</form></article>", "Text"),
        (f"<article><p>{LONG}</p><ul><li><a href=x>{LONG}</a></li></ul><p>Tail</p></article>", f"{LONG} Tail"),
        (f"<div class='cookie-notice'>{LONG}</div><div><p>{LONG}</p><p>Near.</p></div>", f"{LONG} Near."),
        (f"<div><p>{LONG}</p></div><div><a href=1>{LONG}</a></div><p>© 2020 Someone</p>", LONG),
        ("<article><p>2 < 3 and 4 > 1</p></article>", "2 < 3 and 4 > 1"),
        ("<article><p title='a>b'>q</p></article>", "q"),
        ("<article hidden>secret</article><article>open</article>", "open"),
        ("<body class='has-sidebar'><article class='post sidebar-left'>kept</article></body>", "kept"),
    ],
)
def test_cases(html, text):
    assert main_text(html) == text


def test_second_pass_takes_the_nearest_decided_label():
    good, bad, undecided = html_text.GOOD, html_text.BAD, html_text.OPEN
    assert html_text.second_pass([undecided, good, undecided, undecided, undecided, bad, undecided], False) == [True, True, True, False, False, False, False]
    assert html_text.second_pass([bad, undecided, good], True) == [False, True, True]
    assert html_text.second_pass([undecided, undecided], False) == [True, True]


@pytest.mark.parametrize("html", ["<" * 200_000, '<a x="' * 40_000, "<p " * 60_000, "&" * 100_000, "<!--" * 50_000, "<div>" * 50_000, "<script>" * 40_000])
def test_hostile_pages_end(html):
    main_text(html)


def test_a_long_page_is_whole():
    html = "<article>" + "".join(f"<p>{LONG} {i}</p>" for i in range(20_000)) + "</article>"
    assert main_text(html) == " ".join(f"{LONG} {i}" for i in range(20_000))


def test_table(spark):
    rows = [(1, "u", "<article>é</article>", 5), (None, None, None, 6), (1, "u", "<article>é</article>", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = sorted(map(tuple, html_text.extract(pages).collect()), key=str)
    assert got == sorted([(1, "u", "é", 1), (1, "u", "é", 1), (None, None, "", 0)], key=str)
    assert html_text.extract(pages.limit(0)).collect() == []


def test_query_returns_the_articles(spark, sf):
    import re
    from html import unescape

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in catalog.op1_html_text(spark, sf).collect():
        article = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        assert r["text"] == " ".join(unescape(re.sub(r"<[^>]*>", " ", article)).split())
        assert r["n_chars"] == len(r["text"])


@pytest.mark.parametrize(
    "html, text",
    [
        # Links of any element are told by their density, and what stands between two of them goes.
        (f"<article><p>{LONG}</p><p><a href=x>Read also: {LONG}</a></p><p>{LONG}</p></article>", f"{LONG} {LONG}"),
        (f"<article><p>{LONG}</p><p><a href=x>{LONG}</a></p><p>Advert</p><div><a href=y>Share</a></div><p>{LONG}</p></article>", f"{LONG} {LONG}"),
        (f"<main><p>{LONG}</p><div><a href=x>One</a></div><p>Next to links</p><p>Too</p><p>Near</p><p>{LONG}</p></main>", f"{LONG} Too Near {LONG}"),
        (f"<article><h1><a href=x>Title</a></h1><p>{LONG}</p></article>", f"Title {LONG}"),
        # An element that holds the article is not dropped for a word in its class or id.
        (f"<div class='has sidebar'><p>Menu</p><article><p>{LONG}</p></article></div>", LONG),
        (f"<section id='social'><div class='banner'><main><p>{LONG}</p></main></div><div class='related'>{LONG}</div></section>", LONG),
        (f"<main><div class='widget'><p>Kept.</p><article><p>{LONG}</p></article></div><div class='related'><p>{LONG}</p></div></main>", f"Kept. {LONG}"),
        (f"<div class='comments'><article class='comment'><p>{LONG}</p></article></div><p>{LONG} 1</p>", f"{LONG} 1"),
        (f"<div class='sidebar' hidden><article>{LONG}</article></div><p>{LONG} 1</p>", f"{LONG} 1"),
    ],
)
def test_links_neighbours_and_hints_with_articles(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize("html", ["<div class=ad>" * 50_000 + "<article>x" * 1_000])
def test_nested_hints_end(html):
    assert main_text(html) == " ".join("x" * 1_000)


@pytest.mark.parametrize(
    "html, text",
    [
        # A link around whole blocks counts for them, and ends with what it began in.
        (f"<article><p>{LONG}</p><a href=x><p>Read also: {LONG}</p></a><a href=y><div>{LONG}</div></a><p>{LONG}</p></article>", f"{LONG} {LONG}"),
        (f"<article><p><a href=x>{LONG}</p><p>{LONG} 1</p></article>", f"{LONG} 1"),
        (f"<article><p>{LONG}<a href=x>more<p>{LONG} 1</article>", f"{LONG}more {LONG} 1"),
        (f"<div><section><a href=x>{LONG}</section><p>{LONG} 1</p></div>", f"{LONG} 1"),
        # Cards beside the article have no text of their own.
        (f"<main><p>{LONG}</p></main><article><a href=1><h3>Card</h3></a><p>Teaser</p></article><article><h3>Other</h3></article>", LONG),
        ("<article><p>One</p></article><article><p>Two</p></article>", "One Two"),
        # Labels of adverts, in an article or without one.
        (f"<p>{LONG}</p><p>Advertisement</p><p>{LONG} 1</p>", f"{LONG} {LONG} 1"),
        (f"<article><p>{LONG}</p><div>Anzeige:</div><p>{LONG} 1</p></article>", f"{LONG} {LONG} 1"),
    ],
)
def test_block_links_cards_and_labels(html, text):
    assert main_text(html) == text


def test_end_tags_of_nothing_are_passed_over():
    import time

    def spent(n):
        begin = time.perf_counter()
        main_text("<div>" * n + "</section>" * n + "x")
        return time.perf_counter() - begin

    spent(1000)
    assert spent(40_000) < 20 * spent(8_000) + 0.5


def plain_article(blocks, in_article):
    """Both passes over (text, linked) blocks, written as the rule says: every open block asks all others."""
    labels = []
    for text, linked in blocks:
        words = [w.lower() for w in text.replace(".", "").split()]
        if linked:
            labels.append(-1)
        elif len(text) >= 70 and sum(w in html_text._STOP_WORDS for w in words) >= 0.2 * len(words):
            labels.append(1)
        else:
            labels.append(0)
    decided = [(i, x) for i, x in enumerate(labels) if x] + ([(-1, 1), (len(labels), 1)] if in_article else [])
    kept = []
    for i, own in enumerate(labels):
        if own:
            kept.append(own > 0)
            continue
        left = max((d for d in decided if d[0] < i), default=None)
        right = min((d for d in decided if d[0] > i), default=None)
        kept.append(_nearest(i, left, right, in_article))
    return " ".join(t for (t, _), k in zip(blocks, kept, strict=True) if k)


def _nearest(i, left, right, in_article):
    found = [d for d in (left, right) if d]
    if not found:
        return True
    least = min(abs(d[0] - i) for d in found)
    labels = {d[1] for d in found if abs(d[0] - i) == least}
    return labels == {1} or (labels == {1, -1} and in_article)


@pytest.mark.parametrize("in_article", [True, False])
def test_generated_pages_equal_the_plain_rule(in_article):
    import random

    rng = random.Random(17)
    for _ in range(400):
        blocks = []
        for i in range(rng.randrange(1, 12)):
            kind = rng.choice("gggoosl")
            text = {"g": f"{LONG} {i}", "o": f"Words without any {i}", "s": f"xyzzy {'plugh ' * 20}{i}".strip(), "l": f"Linked {LONG if rng.random() < 0.5 else 'menu'} {i}"}[kind]
            blocks.append((text, kind == "l"))
        body = "".join(f"<p><a href=#>{t}</a></p>" if linked else f"<p>{t}</p>" for t, linked in blocks)
        page = f"<nav>{LONG}</nav><article>{body}</article><footer>{LONG}</footer>" if in_article else f"<nav>{LONG}</nav><div>{body}</div><footer>{LONG}</footer>"
        assert main_text(page) == plain_article(blocks, in_article)
