"""Selectors against hand-written trees, dates in text, and the bounded crawl."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import dates
from corpusloom.functions import selectors as S
from corpusloom.sources import landing
from corpusloom.sources.crawl import Crawl

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title></head><body id="top" class="wide dark">
<div class="posts"><div class="post first" data-id="p1"><p>One <b>bold</b><p>Two</div><div class="post" data-id="p2-x"><span><p>Three</p></span></div></div>
<ul><li>a<li>b <a href="/x?q=1&amp;r=2">link</a><ul><li>c</ul><li>d</ul>
<table><tr><td>1<td>2<tr><td>3</table><article><h1>Head <i>line</i></h1><nav>menu</nav><time datetime="2024-03-05T10:00:00Z">then</time><p class="ad x">buy</p>body text</article></body></html>"""


@pytest.mark.parametrize(("selector", "wanted"), [
    ("p", ["One bold", "Two", "Three", "buy"]), ("div.post > p", ["One bold", "Two"]), ("div.post p", ["One bold", "Two", "Three"]), (".post.first b", ["bold"]), ("body#top.dark.wide h1", ["Head line"]),
    ("[data-id]", ["One bold Two", "Three"]), ('[data-id="p1"] p', ["One bold", "Two"]), ("div[data-id^=p2] p", ["Three"]), ("[data-id$='-x'] p", ["Three"]), ("[data-id*=2] p", ["Three"]), ("[class~=post] > span", ["Three"]), ("[data-id|=p2] p", ["Three"]),
    ("ul > li", ["a", "b link c", "c", "d"]), ("ul ul > li", ["c"]), ("body > ul > li", ["a", "b link c", "d"]), ("tr", ["1 2", "3"]), ("td", ["1", "2", "3"]), ("h1, title", ["T & t", "Head line"]), ("*.first > *", ["One bold", "Two"]), ("h2", []), ("DIV.POST", []), ("TITLE", ["T & t"]),
])
def test_select(selector, wanted):
    assert [S.clean(" ".join(n.texts())) for n in S.select(S.parse(PAGE), selector)] == wanted


@pytest.mark.parametrize("selector", ["", "a >", "> a", "a,,b", "a:hover", "a[", "div&p", ".5"])
def test_wrong_selectors_are_errors(selector):
    with pytest.raises(ValueError, match="selector"):
        S.compiled(selector)


def test_fields():
    wanted = [("t", "text", "h1", None), ("c", "html", "article", "nav, .ad, time"), ("l", "links", "li a", None), ("p", "texts", "p", None), ("d", "date", "time", None), ("n", "text", ".none", None), ("nd", "date", ".none", None), ("i", "attr:data-id", ".post", None)]
    got = {f: v if vs is None else vs for f, v, vs in S.fields(PAGE, "https://s.example/a/b", wanted)}
    assert got == {"t": "Head line", "c": "<article><h1>Head <i>line</i></h1>body text</article>", "l": ["https://s.example/x?q=1&r=2"], "p": ["One bold", "Two", "Three", "buy"], "d": "2024-03-05T10:00:00Z", "n": "", "nd": None, "i": "p1"}
    assert S.fields(None, None, wanted[:1]) == [("t", "", None)]
    assert S.parse("<div>" * 30000 + "x").children  # depth is no recursion
    with pytest.raises(ValueError, match="kind"):
        S.fields(PAGE, None, [("x", "odd", "p", None)])


def test_articles_by_source(spark):
    body = "A long enough article body, with words and words, so that it passes the least length of one hundred characters."
    html = f'<h1>Usual</h1><h2>Other</h2><article><p>{body}</p><div class="ad">x</div></article><div class="text">{body} Elsewhere.<span class="by">Ann</span></div><time>March 5, 2024</time>'
    pages = spark.createDataFrame([(1, "https://a/1", html, "a"), (2, "https://b/1", html, "b"), (3, "https://c/1", "<p>no</p>", "a"), (4, "https://d/1", None, None)], "page_id long, url string, html string, source_name string")
    own = spark.createDataFrame([("b", "title", "h2"), ("b", "content", "div.text"), ("b", "author", ".by"), ("b", "links", "")], "source_name string, field string, selector string")
    got = {r.page_id: r for r in landing.articles(pages, landing.article_selectors(own, pages)).collect()}
    assert {k: (r.title, r.author, r.content_text) for k, r in got.items()} == {1: ("Usual", "", body), 2: ("Other", "Ann", f"{body} Elsewhere. Ann")}
    assert got[1].date_published == datetime.datetime(2024, 3, 5) and got[2].links == []
    assert [r.content_text for r in landing.articles(pages.drop("source_name")).collect()] == [body, body]


D = datetime.datetime


@pytest.mark.parametrize(("text", "wanted"), [
    ("2024-03-05", D(2024, 3, 5)), ("2024-03-05T10:15:30Z", D(2024, 3, 5, 10, 15, 30)), ("2024-03-05 10:15:30.25+02:00", D(2024, 3, 5, 8, 15, 30, 250000)), ("on 2024/3/5 at 9:05 pm", D(2024, 3, 5, 21, 5)), ("20240305T101530", D(2024, 3, 5, 10, 15, 30)),
    ("5 March 2024", D(2024, 3, 5)), ("Posted: Tuesday, March 5th, 2024 at 12:30 AM by x", D(2024, 3, 5, 0, 30)), ("5. März 2024", D(2024, 3, 5)), ("1er août 2023", D(2023, 8, 1)), ("3 de mayo de 2022", D(2022, 5, 3)), ("Sept. 9, 2021 -0500 07:00", D(2021, 9, 9, 12)), ("June 2020", D(2020, 6, 1)), ("12 PM, Dec 1 2020", D(2020, 12, 1, 12)),
    ("3/5/2024", D(2024, 3, 5)), ("13/5/2024", D(2024, 5, 13)), ("3.5.24", D(2024, 3, 5)), ("1/2/99", D(1999, 1, 2)), ("29/2/2024", D(2024, 2, 29)),
    ("yesterday", D(2024, 5, 31)), ("Today 10:20", D(2024, 6, 1, 10, 20)), ("an hour ago", D(2024, 6, 1, 11)), ("3 days ago", D(2024, 5, 29, 12)), ("2 weeks ago", D(2024, 5, 18, 12)),
    ("2024-02-30", None), ("31/6/2023", None), ("2023-02-30 or 4 May 2023", D(2023, 5, 4)), ("version 1.2.3", None), ("in 2024", None), ("call 555-12-34", None), ("2024-03-05 25:99", D(2024, 3, 5)), ("", None), (None, None), ("maybe 2024", None),
])
def test_dates(spark, text, wanted):
    got = spark.createDataFrame([(text,)], "t string").select(dates.read(F.col("t"), F.lit("2024-06-01 12:00:00").cast("timestamp")).cast("timestamp_ntz")).first()[0]
    assert got == wanted


def test_day_first(spark):
    df = spark.createDataFrame([("3/5/2024",), ("3/15/2024",)], "t string").select(dates.read(F.col("t"), day_first=True).cast("date").cast("string"))
    assert [r[0] for r in df.collect()] == ["2024-05-03", "2024-03-15"]


def test_crawl(spark, tmp_path):
    graph = {"a": ["b", "c", "a", "b"], "b": ["d"], "c": ["d", "e", None], "d": ["a", "f"], "e": ["gone"]}
    pages = spark.createDataFrame(list(graph.items()), "url string, links array<string>")
    crawl = Crawl(spark, str(tmp_path / "c"))
    crawl.start(spark.createDataFrame([("s", "a", 0), ("s", "a", 1), ("t", "e", 0)], "source string, url string, position int"))
    take = lambda n, **k: sorted((r.source, r.url, r.depth) for r in crawl.round(n, pages, F.col("links"), **k).collect())
    assert take(1, per_source=1) == [("s", "a", 0), ("t", "e", 0)]
    assert take(2, per_source=1) == [("s", "b", 1), ("t", "gone", 1)]
    assert take(2, per_source=1) == [("s", "b", 1), ("t", "gone", 1)]  # again under its number
    crawl = Crawl(spark, str(tmp_path / "c"))  # after a restart
    assert take(3, per_source=1) == [("s", "c", 1)]
    assert take(4, per_source=9) == [("s", "d", 2), ("s", "e", 2)]
    assert crawl.run(pages, F.col("links"), 10) == 5 and crawl.waiting().isEmpty()
    assert {(r.source, r.url, r.depth, r.found, r.taken) for r in crawl.frontier().where("url in ('f', 'gone')").collect()} == {("s", "f", 3, 4, 5), ("s", "gone", 3, 4, 5), ("t", "gone", 1, 1, 2)}
    crawl.start(spark.createDataFrame([("s", "a", 0), ("s", "new", 0)], "source string, url string, position int"))
    assert [(r.source, r.url) for r in crawl.waiting().collect()] == [("s", "new")]


def test_source_of_an_element():
    html = "<p>a &amp;&amp\n<b>x &quot;y</b>\n</p><ul><li>one<li>two &lt</ul><h1>H &amp"
    got = {s: S.fields(html, None, [("x", "source", s, None)])[0][1] for s in ("p", "b", "li", "ul", "h1", "h2")}
    assert got == {"p": "a &amp;&amp\n<b>x &quot;y</b>\n", "b": "x &quot;y", "li": "one", "ul": "<li>one<li>two &lt", "h1": "H &amp", "h2": ""}


def test_selector_fields_keeps_references_as_its_sql_does(spark, tmp_path):
    from corpusloom.plans import catalog

    pages = [(3, "https://a.example/3", "<html><body><nav><ul><li><a href=\"/x\">x</a></ul></nav><article><h1>A &amp;&amp; B&amp</h1></article></body></html>"),
             (4, "https://a.example/4", "<html><head><title>t = &quot;0c &lt;b&gt;</title></head><body><div class=\"ad\">B&uuml;\n <i>y</i></div></body></html>")]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: (r.title, r.advert, r.links) for r in catalog.QUERIES["selector_fields"](spark, str(tmp_path)).collect()}
    assert got == {3: ("A && B&amp", None, "https://a.example/x"), 4: ('t = &quot;0c <b>', "B&uuml; y", None)}
