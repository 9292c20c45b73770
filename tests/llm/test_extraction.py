import html
import itertools
import random
import re

import pytest

from tidemark.llm import extraction, queries
from tidemark.llm.extraction import main_text, minimum_cut

LONG = "The committee met on Tuesday, and after a long debate it agreed to publish all of its findings by the end of the year."


def article_of(page):
    """Text of the one article, by the shape that these pages share."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:h1|p)>", inside)
    texts = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_whole_table_as_its_articles(spark, table):
    pages = {r["page_id"]: r for r in table("pages").collect()}
    rows = queries.op11_html_text(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(pages)
    for row in rows:
        page = pages[row["page_id"]]
        assert row["text"] == article_of(page["html"]) and row["url"] == page["url"]
        assert row["n_chars"] == len(row["text"])


@pytest.mark.parametrize("seed", range(6))
def test_cut_is_least(seed):
    rng = random.Random(seed)
    for _ in range(60):
        n = rng.randrange(1, 9)
        own = [rng.choice((-3, -1, -0.5, 0, 0.25, 1, 2.5)) for _ in range(n)]
        edges = [(i, i + 1, rng.choice((0, 0.3, 1, 4))) for i in range(n - 1)]
        edges += [(*sorted(rng.sample(range(n), 2)), rng.random() * 3) for _ in range(n // 2) if n > 1]

        def cost(labels):
            pay = sum(abs(x) for x, label in zip(own, labels) if (x > 0) != label)
            return pay + sum(round(w * 1000) / 1000 for a, b, w in edges if labels[a] != labels[b])

        every = list(itertools.product((False, True), repeat=n))
        least = min(map(cost, every))
        got = minimum_cut(list(own), edges)
        assert cost(got) == pytest.approx(least)
        assert sum(got) == min(sum(x) for x in every if cost(x) == pytest.approx(least))


def test_long_chain_is_cut_in_time():
    rng = random.Random(2)
    n = 30_000
    own = [rng.choice((-0.4, 0.3, -0.1, 0.2)) for _ in range(n)]
    edges = [(i, i + 1, 0.8) for i in range(n - 1)] + [(i, i + 7, 0.5) for i in range(0, n - 7, 5)]
    assert len(minimum_cut(own, edges)) == n


PAGES = {
    "landmarks": f"""<html><head><title>T</title></head><body><header><a href=/>Site</a><h2>Best site of all, really.</h2></header>
        <nav><ul><li><a href=a>Home</a><li><a href=b>About us and everything</a></ul></nav>
        <main><article><header><h1>Head line</h1></header><p>{LONG}<p>Short.
        <aside>You may also like this other very long article about something else entirely, read on.</aside>
        <p>Another &amp; <em>last</em> one.</article>
        <section id="comments"><h3>Comments</h3><article class="comment"><p>{LONG} I disagree, said the reader.</p></article></section></main>
        <form><label>Mail</label> <input> <button>Send it now</button></form><footer>&copy; 2020 {LONG}</footer></body></html>""",
    "classes": f"""<body class="home has-sidebar"><div id="masthead"><div class="menu"><a href=1>One</a> <a href=2>Two</a></div></div>
        <div class="cookieNotice"><p>We use cookies to make this site better, and by going on you agree to that.</p></div>
        <div id="wrapper" class="no-sidebar"><div class="post-content"><h1>Head line</h1><p>{LONG}</p><p>Short.</p>
        <div class="ad-slot"><p>Buy now! {LONG}</p></div><p>Another &#38; <i>last</i> one.</p></div>
        <div class="sidebar"><p>{LONG}</p></div><ol class="commentlist"><li><p>{LONG}</p></li></ol></div>
        <div class="site-footer"><p>All rights reserved. {LONG}</p></div></body>""",
    "bare": f"""<h1>Head line</h1><p>{LONG}</p><p>Short.</p><script>if (a < b) {{ document.write("<p>{LONG}</p>") }}</script>
        <style>p {{ color: red }}</style><!-- <p>{LONG}</p> --><p>Another &amp; last
        one.</p><ul><li><a href=x>Terms</a></li><li><a href=y>Privacy</a></li><li><a href=z>Imprint</a></li></ul>""",
    "wrapped in a form": f"""<form id=aspnetForm><div role="navigation"><a href=q>Start</a></div><div role=main><h1>Head line</h1>
        <p>{LONG}</p><p>Short.</p><p>Another &amp; last one.</p></div><div role=contentinfo>{LONG}</div></form>""",
    "no end of head, upper case": f"""<HTML><HEAD><TITLE>x</TITLE><BODY><ARTICLE><H1>Head line</H1><P>{LONG}<P>Short.<P>Another &amp; last one.""",
}


@pytest.mark.parametrize("name", PAGES)
def test_templates(name):
    assert main_text(PAGES[name]) == "\n\n".join(["Head line", LONG, "Short.", "Another & last one."])


def test_blocks_in_an_article():
    page = f"""<article><h2>A list</h2><ul><li>First <b>thing</b> to do</li><li>Second</li></ul>
        <table><tr><td>Cell one<td>Cell&nbsp;two<tr><th>Third</table><blockquote>Quoted words.</blockquote>
        <pre>x  =  1\n  y</pre><p>{LONG} See <a href=u>this page</a>.<br>New line.</p><figure><img src=i>
        <figcaption>A caption here.</figcaption></figure><p hidden>Not to be seen at all.</p></article>"""
    assert main_text(page).split("\n\n") == [
        "A list", "First thing to do", "Second", "Cell one", "Cell two", "Third", "Quoted words.", "x = 1 y",
        f"{LONG} See this page. New line.", "A caption here.",
    ]


def test_damaged_pages():
    whole = f"<article><p>{LONG}</p></article>"
    assert main_text(None) == main_text("") == main_text("<script>x") == main_text("<nav>a b c") == ""
    assert main_text(whole[:-14]) == LONG
    assert main_text(whole + '<p class="') == LONG
    assert main_text(whole + "<!-- open <p>never</p>") == LONG
    assert main_text(f"<article><p>1 < 2 and 3 > 2. {LONG} &am") == f"1 < 2 and 3 > 2. {LONG} &am"
    assert main_text(f"<article></div></b></p><p title='>'>{LONG}</i>") == LONG
    assert main_text("<div>" * 20_000 + f"<p>{LONG}") == LONG
    deep = "<article>" + "".join(f"<p>{LONG} {i}<b>" for i in range(5000))
    assert main_text(deep).count("\n\n") == 4999


def test_only_whole_attributes_count():
    page = f"""<article><p data-id="comments" title="a hidden nav" CLASS='lead'>{LONG}</p>
        <p class=sidebar>{LONG} Beside.</p><p Class = "x menu-item">{LONG} Item.</p></article>"""
    assert main_text(page) == LONG


def test_odd_rows(spark):
    kinds = "page_id long, html string, text string, n_chars long, page string, own0 int"
    rows = [(1, None, "own", 1, "p", 2), (None, "", "own", 1, "p", 2), (1, f"<p>{LONG}</p>", None, None, None, None)]
    rows += [rows[-1]] * 3
    df = spark.createDataFrame(rows, kinds)
    out = extraction.extract(df)
    assert out.columns == ["page_id", "page", "own0", "text", "n_chars"]
    assert sorted(r["n_chars"] for r in out.collect()) == [0, 0, *[len(LONG)] * 4]
    assert extraction.extract(spark.createDataFrame([], kinds)).count() == 0
