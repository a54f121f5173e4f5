"""Search, chat formatting and page text."""

import hashlib
import html
import re
import time

import numpy as np
import pytest

import __spark_entry__ as contract
import check
from pavilion.llm import chat, html_text, search

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_exact_top_k", "op10_format_chats"])
def test_query_equals_reference_sql(spark, name):
    assert check.compare(spark, check.database(FOLDER), FOLDER, name).same


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, terms int, score int")


@pytest.mark.parametrize("block_bytes", [200, search.BLOCK_BYTES])
def test_search_equals_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(search, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(search, "LEAST_ROWS", 50)
    monkeypatch.setattr(search, "TILE_CELLS", 100)
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.round(r.normal(size=6), 1)]) for i in range(300)]
    rows += [(300, [0.0] * 6), (400, [0.5] * 6), (401, [0.5] * 6), (500, [1.0]), (-100, [1.0, 2.0]), (502, [])]
    # rows that share an identifier are candidates and queries of their own
    rows += [(1, [5.0, 5.0]), (1, [2.0, 0.0]), (200, [1.0, 1.0, 1.0]), rows[100], rows[3], rows[3]]
    bad = [(600, None), (601, [1.0, None]), (602, [float("nan")]), (603, [float("inf")]), (None, [1.0])]
    weighted = search.weighted_rows(vectors(spark, rows + bad).repartition(4))
    found = search.top_k(weighted.where("vec_id % 100 = 0"), weighted, 10)
    terms = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows]
    want = []
    for place, (q, own) in enumerate(terms):
        if q % 100 == 0:
            others = [(i, v) for k, (i, v) in enumerate(terms) if k != place]
            scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in others)
            want += [(q, k, i, -s) for k, (s, i) in enumerate(scored[:10], 1)]
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)


def test_candidates_are_copied_once_per_block_of_query_bytes(spark):
    """A hundredth of 25 million rows of 64 terms is one block; so is any smaller number."""
    assert search.BLOCK_BYTES // (64 * 4) >= 250_000
    rows = [(i, [0.5] * 64) for i in range(2000)]
    weighted = search.weighted_rows(vectors(spark, rows))
    assert {len(r["terms"]) for r in weighted.collect()} == {256}
    assert search.copies(weighted) == 1


def test_search_of_huge_weights_and_of_nothing(spark):
    weighted = search.weighted_rows(vectors(spark, [(100, [3e38]), (1, [3e38]), (2, [-3e38])]))
    found = search.top_k(weighted.where("vec_id = 100"), weighted, 10).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"])] == [(1, 2**63 - 1), (2, -(2**63))]
    none = search.weighted_rows(vectors(spark, []))
    assert search.top_k(none, none, 10).collect() == []


def turns(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, n_turns int, formatted string")


def test_chat_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", r"<\s> <\\/s> [\INST]", "<r:6162>x</r>", "", None, "a\\b <s", "[/INST", "é\n\n[SYS]"]
    roles = ["user", "assistant", "system", "tool", None, "rôle>"]
    rows = [(c, t, roles[(c + t) % 6], odd[(c * 3 + t) % 8]) for c in range(12) for t in range(5)]
    rows += [(None, 0, "user", "hi"), (20, None, "user", "null turn"), (20, 0, "assistant", "b"), (20, 0, "assistant", "a")]
    found = {r["conv_id"]: r for r in chat.format_digests(turns(spark, rows)).collect()}
    by_id = {}
    for c, t, role, text in rows:
        by_id.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(found) == set(by_id)
    for c, own in by_id.items():
        own.sort()
        loss = "".join(x[3] for x in own if x[2] == "assistant")
        whole = "".join(f"{x[2]}\n{x[3]}\n" for x in own)
        r = found[c]
        assert (r["n_turns"], r["loss_chars"]) == (len(own), len(loss))
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    formatted = chat.format_conversations(turns(spark, rows)).collect()
    sizes = {r["conv_id"]: len(r["formatted"]) for r in formatted}
    assert all(found[c]["formatted_chars"] == sizes[c] for c in found)
    for r in formatted:
        marks = re.findall(chat.CONTROL, r["formatted"])
        assert len(marks) == 2 * len(by_id[r["conv_id"]])
    assert chat.format_digests(turns(spark, [])).collect() == []


PAGE = """<!doctype html><html><head><title>t</title><style>p{}</style></head><body><header>Site</header>
<nav><ul><li><a href=/>Home</a></ul></nav><div class="cookie-notice">We use cookies.</div>
<article><h1>Big &amp; small</h1><p>First <b>bold</b>
 paragraph&nbsp;here, with text.<br>Second line.<p>Unclosed one &lt;tag&gt;.<script>var a = "</p>";</script>
<ul><li>an item<li>another</ul><form><input><label>Mail</label></form><aside>Side</aside>
<div class="ad">Buy!</div></article><section id="comments"><p>Nice post, really, I liked it.</p></section>
<footer>&copy; all</footer></body></html>"""


def test_page_text():
    want = "Big & small First bold paragraph here, with text. Second line. Unclosed one <tag>. an item another"
    assert html_text.main_text(PAGE) == want
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p></p>") == ""
    assert html_text.main_text("plain words only") == "plain words only"
    long = "<body><div><h2>x</h2>" + "<p>Some text, more of it.</p>" * 20_000 + "</div></body>"
    assert html_text.main_text(long).count("Some") == 20_000


@pytest.mark.parametrize(
    "page",
    [
        "<article><h1>Title</h1><p>Lead, short.</p><div>{}</div></article>",
        "<main><section><h2>Title</h2><p>Lead, short.</p></section><section>{}</section></main>",
        "<div class=post><h2>Title</h2><p>Lead, short.</p><blockquote>{}</blockquote></div>",
        "<div><h2>Title</h2><p>Lead, short and plain, with marks, to be kept.</p><div>{}</div></div>",
    ],
)
def test_text_beside_a_long_container_is_kept(page):
    rest = "<p>Some text, more of it.</p>" * 200
    menu = "<nav><a href=/>Home</a></nav><div><h3>Latest</h3><ul><li><a href=/x>x</a></ul></div>"
    found = html_text.main_text(f"<body>{menu}{page.format(rest)}</body>")
    lead = re.search("<p>(.*?)</p>", page).group(1)
    assert found == " ".join(["Title", lead] + ["Some text, more of it."] * 200)


@pytest.mark.parametrize(
    "part",
    [
        '<h2 id="related-work">Related work</h2>',
        '<h2 id="form-and-function">Form and function</h2>',
        '<h3 class="header">Search</h3>',
        '<p id="share-prices">Share prices rose, as they do, and fell again.</p>',
        '<p class="notice">Notices, in a paragraph of the text, are read.</p>',
        '<section id="search-methods"><h2>Methods</h2><p>We search, sort, and look again; then we write it down, all of it.</p></section>',
        '<section id="related"><p>We search, sort, and look again; then we write it down, all of it.</p></section>',
        '<div class="widget-theory"><p>We search, sort, and look again; then we write it down, all of it.</p></div>',
        '<ul class="steps"><li id="ad-one">First, we look.</li></ul>',
        '<p>5 < 6, and <img alt="x > y" src=\'a>b\'>after the picture, more text.</p>',
        "<p title=it's>An odd quote, in a tag, ends nothing.</p>",
    ],
)
@pytest.mark.parametrize(
    "page",
    [
        "<html><body><nav><a href=/>Home</a></nav><article><h1>T</h1>{}</article><footer>f</footer></body></html>",
        "<body><div id=wrap><div class='sidebar'><p>Side, text.</p></div><main><section>{}</section></main></div></body>",
        "<body><div class='post-content'>{}</div><div id='comments'><p>Nice, really.</p></div></body>",
        "<body><div class=a><ul class=menu><li><a href=x>x</a></ul></div><div class=b>{}</div></body>",
    ],
)
def test_parts_of_an_article_stay_whatever_their_names(page, part):
    prose = "<p>Some text, more of it, and still more.</p>" * 30
    if "class=b" in page and re.search("h3 class|widget|id=\"related\"|search-methods|share-prices|notice|ad-one", part):
        pytest.skip("outside an article, names count")
    found = html_text.main_text(page.format(prose + part + prose))
    plain = html.unescape(re.sub("<(?=[/A-Za-z])(?:[^>\"']|\"[^\"]*\"|'[^']*'|(?<==it)')*>", " ", part))
    want = " ".join(["Some text, more of it, and still more."] * 30)
    assert found.replace("T Some", "Some", 1) == f"{want} {' '.join(plain.split())} {want}"


@pytest.mark.parametrize(
    "part",
    [
        '<div class="ad">Buy now!</div>',
        '<div class="share-buttons"><a href=x>Tweet</a> <a href=y>Mail</a></div>',
        '<ul class="related-posts"><li><a href=x>One</a><li><a href=x>Two</a></ul>',
        '<section class="comments"><p>Nice, really, I liked it, thanks.</p></section>',
        '<div id="newsletter">Subscribe, now, to all of our news.</div>',
        '<div hidden>Some text, more of it, and still more.</div>',
        '<p style="display: none">Some text, more of it, and still more.</p>',
    ],
)
def test_other_parts_in_an_article_go(part):
    prose = "<p>Some text, more of it, and still more.</p>" * 30
    found = html_text.main_text(f"<body><article>{prose}{part}{prose}</article></body>")
    assert found == " ".join(["Some text, more of it, and still more."] * 60)


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 50_000 + "deep, text",
        "<div>" * 20_000 + "</p>" * 20_000 + "<p>x, y",
        "<script " * 20_000,
        "<a href='" * 20_000,
        "<b>" * 20_000 + "<p>x" * 20_000,
        "<!--" * 20_000 + "<x" * 20_000,
        "<div><p>a, b</p>" * 10_000,
    ],
)
def test_hostile_pages_take_time_in_proportion(page):
    start = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - start < 1.5


def test_pages_equal_their_articles(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in html_text.extract(pages).collect():
        article = re.search(r"<article>(.*?)</article>", source[r["page_id"]], re.S).group(1)
        parts = re.split(r"<[^>]*>", re.sub(r"</?b>", "", article))
        want = " ".join(filter(None, (" ".join(html.unescape(p).split()) for p in parts)))
        assert (r["text"], r["n_chars"]) == (want, len(want))


def test_pages_with_nulls_repeats_and_extra_columns(spark):
    rows = [(1, "u", None, "x"), (None, None, "", "x"), (1, "u", "<article>a</article>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted((r["text"], r["n_chars"]) for r in html_text.extract(pages).collect()) == [("", 0), ("", 0), ("a", 1)]
    assert html_text.extract(pages.limit(0)).collect() == []
