"""Main text of pages: markup, host-wide repetition, portions."""

import random

import numpy as np
import pytest

from textloom.llm import html_text as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li>Home</ul></nav>
<div id="cookie-notice"><p>We use cookies</p></div><form><label>Mail</label><input></form>
<article><h1>Head&amp;line</h1><p><b>One  two&nbsp;three<br><p>Four <span class="ad">buy</span> five &lt;6&gt; &copy 7
<aside>note</aside><div class="share-links">Share</div><p>Eight</p><!-- <p>gone</p> -->
<section class="comments"><article><p>first!</p></article></section><footer>By me</footer></article>
<div class="sidebar">Links</div><footer>&copy; us</footer></body></html>"""
TEXT = "Head&line\nOne two three\nFour five <6> © 7\nEight"

CASES = {
    PAGE: TEXT,
    None: "",
    "": "",
    "plain words only": "plain words only",
    "<main><p>a</p><div>b</div></main><p>c</p>": "a\nb",
    "<article><p>cut in the ta<a href=\"x": "cut in the ta",
    "<article>x<script>never closed": "x",
    "<article><p class='ad'>no<p>yes</article>": "yes",
    "<article>a &amp;amp; b &unknown; &#65;&#x42</article>": "a &amp; b &unknown; AB",
    "<article>1 < 2 and <3</article>": "1 < 2 and <3",
    "<div><p>open</p><nav>menu</nav></div>": "open",
    "<ARTICLE><P>Big</P>  \n\t</ARTICLE>": "Big",
    "<article></article>": "",
    "<div class='page with-sidebar'><article><div class='post-header'><h1>T</h1></div>x</article></div>": "T\nx",
    "<div class='page-header'>s</div><div id='comments'><article>c</article></div><p>o</p>": "o",
}


def test_pages_by_markup(spark):
    rows = [(k, f"http://h{k}/x", page, "t", 1) for k, page in enumerate(CASES)]
    rows += [(None, None, PAGE, "t", 1), (0, "http://h0/x", PAGE, "t", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, row int")
    found = H.main_text(df).collect()
    assert len(found) == len(rows)
    got = {(r.page_id, r.url): r.text for r in found}
    for k, text in enumerate(CASES.values()):
        assert got[k, f"http://h{k}/x"] == text, k
    assert got[None, None] == TEXT
    assert H.main_text(df.limit(0)).count() == 0


def test_very_long_page():
    page = "<article>" + "<p>word</p>" * 50_000 + "</article>"
    assert H.parsed(page)[0] == "\n".join(["word"] * 50_000)


@pytest.mark.parametrize("portion", [2000, 2])
def test_repeated_open_text_goes(spark, portion):
    draw = random.Random(4)
    unique = lambda n: " ".join(f"u{draw.random()}" for _ in range(n))
    notice = "all rights reserved by the owners of this very site since ever"
    rows, want = [], {}
    for k in range(9):
        body = [unique(12), unique(3)]
        page = f"<div>{body[0]}</div><p>{notice}</p><p>{body[1]} {notice} tail{k}</p>"
        rows.append((k, "http://one/", page))
        want[k] = f"{body[0]}\n{body[1]} tail{k}"
    rows.append((20, "http://two/", f"<p>{notice}</p>"))  # another host: nothing repeats
    want[20] = notice
    copy = f"<p>{unique(30)}</p>"
    for k in range(30, 36):  # copies of a page don't remove each other
        rows.append((k, "http://three/", copy))
        want[k] = copy[3:-4]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    config = H.ExtractConfig(portion_pages=portion)
    assert {r.page_id: r.text for r in H.main_text(df, config).collect()} == want


def test_suffix_array_groups_by_loop():
    draw = np.random.default_rng(6)
    for depth in (1, 2, 3, 5, 8):
        streams = [draw.integers(0, 3, draw.integers(0, 40)).astype(np.uint64) for _ in range(7)]
        _, pages = H.portion_runs(streams, depth)
        plain = {}
        for k, s in enumerate(streams):
            for i in range(len(s) - depth + 1):
                plain.setdefault(tuple(s[i : i + depth].tolist()), set()).add(k)
        assert sorted(pages.tolist()) == sorted(len(v) for v in plain.values())
    tokens = draw.integers(0, 4, 60)
    order, _ = H.suffix_order(tokens, 60)
    assert [tokens[i:].tolist() for i in order] == sorted(tokens[i:].tolist() for i in range(60))


@pytest.mark.parametrize("portion", [2000, 2])
def test_pages_that_share_all_outside_count_each(spark, portion):
    chrome = "the same menu advert and footer on every page of this site"
    rows = [(k, "http://one/", f"<nav>{chrome}</nav><article>own text {k}</article>") for k in range(3)]
    rows += [(10, "http://one/", f"<nav>{chrome}</nav><div>an open page</div>")]
    rows += [(k, "http://two/", f"<nav>{chrome}</nav><article>two pages {k % 2}</article>") for k in range(20, 25)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in H.main_text(df, H.ExtractConfig(portion_pages=portion)).collect()}
    assert [got[k].boilerplate_tokens for k in (0, 1, 2, 10)] == [12] * 4 and got[10].text == "an open page"
    assert all(got[k].boilerplate_tokens == 0 for k in range(20, 25))


@pytest.mark.parametrize(
    "page,text",
    [
        ("<article><p>a<svg viewBox='0 0 1 1'/> b</p><p>c</p></article>", "a b\nc"),
        ("<article>a<svg><title>t</title><text>drawn</text></svg> b</article>", "a b"),
        ("<article><p>a<svg><path d='x'><p>b</p></article>", "a\nb"),
        ("<div><noscript>no</div><article>a</article>", "a"),
        ("<div><template><p>no</p></div><article>a</article>", "a"),
        ("<article>a<noscript><img>no</noscript> b</article>", "a b"),
    ],
)
def test_open_and_self_closed_parts_end_with_their_parent(page, text):
    assert H.parsed(page)[0] == text


def test_text_beside_articles_is_judged(spark):
    chrome = "read this and many more stories on our pages every single day"
    rows, want = [], {}
    for k in range(3):
        rows.append((k, f"<main><h1>Headline {k}</h1><article>own {k}</article><p>{chrome}</p></main>"))
        want[k] = f"Headline {k}\nown {k}"
        rows.append((10 + k, f"<p>{chrome}</p><div>body{k} text</div><article>teaser</article>"))
        want[10 + k] = f"body{k} text\nteaser"
    df = spark.createDataFrame(rows, "page_id long, html string").selectExpr("page_id", "'http://h/' AS url", "html")
    assert {r.page_id: r.text for r in H.main_text(df).collect()} == want


@pytest.mark.parametrize(
    "page,text",
    [
        ("<article><p>a</p><!--><p>b</p><!---><p>c</p><!-- x --!><p>d</p></article>", "a\nb\nc\nd"),
        ("<article><p>a</p><div class='search-results-study'>b</div><p id='privacy-law'>c</p></article>", "a\nb\nc"),
        ("<article><p>a</p><div class='share-buttons'>b</div><p id='comment-17'>c</p><p>d</p></article>", "a\nd"),
        ("<div class='search-results-study'>b</div><article>a</article>", "a"),
    ],
)
def test_empty_comments_and_whole_names(page, text):
    assert H.parsed(page)[0] == text


def test_open_blocks_know_their_places():
    """A block equal to an earlier one is judged where it stands."""
    page = "<ul><li>a b</li></ul><p>x y</p><p>a b</p>"
    settled, blocks, begins, outside, _ = H.parsed(page)
    assert settled is None and blocks == ["a b", "x y", "a b"] == outside and begins == [0, 2, 4]
    assert H.unique_text(blocks, begins, {0, 1}) == "x y\na b"
    assert H.unique_text(["a b", "sure"], [4, -1], {0, 1}) == "a b\nsure"
    assert H.unique_text(["a b"], [0], {0, 1}) == ""
