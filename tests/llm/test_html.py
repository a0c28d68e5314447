import html
import re

import pytest

from clientcurve.llm._html import article_text, container_vote
from clientcurve.llm.html_extract import extract_articles, host_paths

PAGE = """<!DOCTYPE html><html><head><title>T</title><meta charset=x></head><body class="has-sidebar"><header class="site-header"><h1>Site</h1><nav><a href=/>Home</a></nav></header>
<div id="cookie-notice">We use cookies</div><div class="layout"><main><article class="post post-12"><header><h1>Head &amp; line</h1><p class="byline">By Bob</p></header><p>One&nbsp;two <a href=x>link</a> three.<p>Para two &lt;b&gt;<br>next line<ul><li>item 1<li>item 2</ul><div class="ad-slot">Buy now</div><blockquote>Quote &#8212; x</blockquote><pre> a
 b </pre><table><tr><td>c1<td>c2</table><form><input><label>Email</label></form><script>var a="<p>x</p>";</script></article>
<section class="comments"><h2>Comments</h2><div class="comment"><p>Great post! Very long comment text goes here, much longer than others.</p></div></section></main><aside class="sidebar"><p>About me</p></aside></div><footer>&copy; x</footer></body></html>"""


def test_article_without_what_surrounds_it():
    want = "Head & line\nOne two link three.\nPara two <b> next line\nitem 1\nitem 2\nQuote — x\na b\nc1\nc2"
    assert article_text(PAGE, None) == want
    assert article_text(PAGE, ">html>body.has-sidebar>div.layout>main>article.post.post-#") == want
    assert article_text(PAGE, ">html>body>div.not-here") == want


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("plain < text & more", "plain < text & more"),
        ("<p>unclosed <b>x<!-- c", "unclosed x"),
        ("<div><script>no end", ""),
        ("<p>a<p>b<div>c</div>d", "a\nb\nc\nd"),
        ("<p title='a > b'>x</p><p title=\"c > d>y</p><p>z</p>", "x\nd>y\nz"),  # an unclosed quote: the tag ends at its first >
        ("<body><p>&#x41;&eacute;&xyz; &amp;amp;</p>", "Aé&xyz; &amp;"),
        ("<div style='display:none'>hid</div><p>seen</p>", "seen"),
        ("<ul><li><a href=1>all</a><li><a href=2>links</a></ul>", ""),
    ],
)
def test_odd_pages(page, text):
    assert article_text(page, None) == text


def test_many_open_elements_are_no_trouble():
    deep = "<div>" * 3000 + "x" + "<p>" * 3000 + "<" * 5000 + "<a b='" * 500
    assert article_text(deep, None).startswith("x")


def brute(page):
    """The article element of the test tables' pages, cut out by its tags."""
    inner = page[page.index("<article>") + 9 : page.index("</article>")].replace("<br>", " ")
    lines = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|div)>", inner))
    return "\n".join(x for x in lines if x)


def test_test_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    out = {r["page_id"]: r for r in extract_articles(pages).collect()}
    rows = pages.collect()
    assert len(out) == len(rows)
    for r in rows:
        assert out[r["page_id"]]["text"] == brute(r["html"]) and out[r["page_id"]]["n_chars"] == len(brute(r["html"]))


def test_hosts_agree_on_a_path(spark):
    """A page whose comments outweigh its article follows the host's other pages."""
    body = "<html><body><div class='c{0}'><p>{1}</p></div><div class='talk'><p>{2}</p></div></body></html>"
    rows = [(i, f"https://U@Site.example:80/p/{i}?x#y", body.format(i, "article words " * 30, "short"), "e", "e", 1) for i in range(5)]
    rows += [(9, "http://site.example", body.format(9, "real text " * 10, "shouting " * 400), "e", "e", 1)]
    rows += [(10, None, "<p>no url</p>", None, None, 1), (11, "odd", None, None, None, None), (11, "odd", None, None, None, None), (None, "http://b.example/", "<p>null id</p>", None, None, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, path string, h int")
    paths = {r["host"]: r["path"] for r in host_paths(pages).collect()}
    assert paths["site.example"] == ">html>body>div.c#"
    out = extract_articles(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = [(r["page_id"], r["text"]) for r in out.collect()]
    assert (9, ("real text " * 10).strip()) in got and got.count((11, "")) == 2 and (None, "null id") in got and (10, "no url") in got
    assert extract_articles(pages.limit(0)).collect() == []


def test_vote():
    assert container_vote(PAGE)[0] == ">html>body.has-sidebar>div.layout>main>article.post.post-#" and container_vote("<nav>x</nav>") is None


LONG = "<p>" + "long body words " * 40 + "</p>"
LINE = ("long body words " * 40).strip()


@pytest.mark.parametrize(
    "page,text,path",
    [
        (f"<body><article><h1>Title</h1><p>lead</p><div class=content>{LONG}</div><section>short end</section></article></body>", f"Title\nlead\n{LINE}\nshort end", ">body>article"),
        (f"<body><article><header><h1>Title</h1></header><p>lead</p><table><tr><td>{LONG}</td></tr></table><p>end</p></article><p>of the site</p></body>", f"Title\nlead\n{LINE}\nend", ">body>article"),
        (f"<body><main><h1>Title</h1><section>{LONG}</section><section>end</section></main></body>", f"Title\n{LINE}\nend", ">body>main"),
        (f"<body><nav>menu</nav><div class=post><h1>Title</h1><p class=byline>By B</p><div class=text>{LONG}</div><p>end</p></div></body>", f"Title\n{LINE}\nend", ">body>div.post"),
        (f"<body><div><header><h1>Title</h1></header><div class=text>{LONG}</div></div></body>", f"Title\n{LINE}", ">body>div"),
        (f"<body><h1>Title</h1><div class=text>{LONG}</div><section>end</section></body>", f"Title\n{LINE}\nend", ">body"),
        # What is of no article stays out.
        (f"<body><div><div class=text>{LONG}</div><ul><li><a href=1>one</a><li><a href=2>two</a></ul></div></body>", LINE, ">body>div>div.text"),
        (f"<body><main><article><div>{LONG}</div></article><article class=x><p>another</p></article></main></body>", LINE, ">body>main>article"),
        (f"<body><article><div>{LONG}</div><section class=comments><article class=comment>talk</article></section><p>end</p></article></body>", f"{LINE}\nend", ">body>article"),
    ],
)
def test_all_of_an_article_beside_its_dense_container(page, text, path):
    assert article_text(page, None) == text and container_vote(page)[0] == path
    assert article_text(page, path) == text


def test_all_containers_at_the_path_and_pages_of_other_layouts(spark):
    one = "<html><body><div><section><p>{}</p></section></div><div class='talk'><p>short words of others</p></div></body></html>"
    rows = [(i, "http://a.example/", one.format(f"article words {i} " * 30)) for i in range(5)]
    parts = [f"part {k} " * (9 + 20 * (k == 1)) for k in range(3)]
    rows += [(5, "http://a.example/", one.format(parts[0] + "</p></section><section><p>" + parts[1] + "</p></section><section><p>" + parts[2]))]
    # A teaser at the host's path, the article elsewhere; with more talk than article.
    story = "<div class='story'><h2>Head</h2><p>" + "real words " * 50 + "</p></div><div class='talk'>"
    rows += [(6, "http://a.example/", one.format("teaser").replace("<div class='talk'>", story))]
    rows += [(7, "http://a.example/", one.format("teaser").replace("<div class='talk'>", story + "shouting " * 300))]
    rows += [(8, "http://a.example/", one.format("real text " * 10).replace("short", "shouting " * 400))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert [tuple(r) for r in host_paths(pages).select("path", "beside").collect()] == [(">html>body>div>section", [">html>body>div.talk"])]
    out = {r["page_id"]: r["text"] for r in extract_articles(pages).collect()}
    assert out[5] == "\n".join(p.strip() for p in parts)
    assert out[6] == out[7] == "Head\n" + ("real words " * 50).strip()
    assert out[8] == ("real text " * 10).strip() and out[0] == ("article words 0 " * 30).strip()


@pytest.mark.parametrize(
    "page,text",
    [
        # Words of class and id beside an article's own words, around its whole text.
        (f"<body><nav>menu</nav><div class=legal-text>{LONG}</div><footer>f</footer></body>", LINE),
        (f"<body><div class='widget text'>{LONG}</div></body>", LINE),
        (f"<body><div id=search-results-article><h1>T</h1>{LONG}</div></body>", f"T\n{LINE}"),
        (f"<body><div class=notice>{LONG}</div></body>", LINE),
        (f"<body><div class=sidebar>{LONG}</div><p>end</p></body>", f"{LINE}\nend"),
        # Inside an article.
        (f"<body><main><section>{LONG}</section><section class=notice-of-change>{LONG}</section></main></body>", f"{LINE}\n{LINE}"),
        (f"<body><main><section>{LONG}</section><section class=notice><p>a change of note</p></section></main></body>", f"{LINE}\na change of note"),
        (f"<body><article>{LONG}<blockquote class=social-quote>said so</blockquote><p class=tags-intro>of tags</p><h2 class=share-heading>Shares</h2>{LONG}</article></body>", f"{LINE}\nsaid so\nof tags\nShares\n{LINE}"),
        (f"<body><div class=post><p class=tags-intro>of tags</p><div class=text>{LONG}</div></div></body>", f"of tags\n{LINE}"),
        # What such words name is left out where more speaks against it.
        (f"<body><article>{LONG}<ul class=tags><li><a href=1>one</a><li><a href=2>two</a></ul><div class=share><a href=x>send</a></div></article></body>", LINE),
        (f"<body><div class=sidebar-content><p>about us and others here</p></div><div class=text>{LONG}</div></body>", LINE),
        (f"<body><div class=ad>buy</div><article>{LONG}<div class='ad-box'>buy more</div></article><div class='comment-list'>{LONG}{LONG}</div></body>", LINE),
        (f"<body><div role=banner>site</div><div class=text>{LONG}</div><div id=cookieBar>we use cookies</div></body>", LINE),
    ],
)
def test_words_of_class_are_only_evidence(page, text):
    assert article_text(page, None) == text


def test_text_that_a_host_repeats(spark, monkeypatch):
    page = "<body><article><p>{}</p><p class=disclaimer>{}</p></article></body>"
    rows = [(i, "http://a.example/", page.format(f"words {i} " * 30, "the same on all pages")) for i in range(12)]
    rows += [(20, "http://a.example/", page.format("words 20 " * 30, "its own text here")), (21, "http://b.example/", page.format("words 21 " * 30, "the same on all pages"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: f"words {i} " * 30 for i in range(12)} | {20: "words 20 " * 30 + "\nits own text here", 21: "words 21 " * 30 + "\nthe same on all pages"}
    want = {i: t.replace(" \n", "\n").strip() for i, t in want.items()}
    for limit in (4 << 20, 0):  # broadcast, and dealt over salts
        monkeypatch.setattr("clientcurve.llm.html_extract.BROADCAST_BYTES", limit)
        assert {r["page_id"]: r["text"] for r in extract_articles(pages).collect()} == want
