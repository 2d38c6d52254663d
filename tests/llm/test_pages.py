"""Url filters, main text and language of pages."""

import duckdb
import pytest

from sourcetrail.llm import html_text, language, redirects
from sourcetrail.llm.queries import LLM_ORACLES, LLM_QUERIES, URL_RULES

FOLDER = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, host string, path string, verdict string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", "z") for i, (u, h) in enumerate(rows)], PAGES)


@pytest.mark.parametrize("name", ["op2_exact_topk", "op8_url_filters"])
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for table in ("pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = LLM_QUERIES[name](spark, FOLDER)
    cursor = con.execute(LLM_ORACLES[name])
    at = {c[0]: i for i, c in enumerate(cursor.description)}
    assert sorted(df.columns) == sorted(at)
    assert sorted(repr([r[c] for c in sorted(at)]) for r in df.collect()) == sorted(repr([r[at[c]] for c in sorted(at)]) for r in cursor.fetchall())


def test_given_pages_declare_no_aliases(spark):
    given = spark.read.parquet(f"{FOLDER}/pages.parquet")
    assert redirects.links(given).collect() == []


def test_blocks_reach_aliases(spark):
    canonical = '<html><head><LINK href="{}" rel=canonical></head></html>'
    refresh = "<meta http-equiv='refresh' content='0; URL={}'>"
    rows = [
        ("http://a.net/1", canonical.format("https://shop.com/de/7")),  # alias of a blocked address
        ("http://b.net/x/2?q#f", refresh.format("//a.net/1")),  # over a second step
        ("http://c.org/9", refresh.format("http://a.net/1")),  # its own allow comes first
        ("https://SHOP.com/de/7", None),
        ("http://d.net/3", canonical.format("4")),  # relative, and nothing is blocked there
        ("http://example.org/en/12", ""),
        (None, canonical.format("http://a.net/1")),
        ("no scheme", None),
        ("http://b.net/x/2?q", None),  # the same address without the fragment
        ("http://b.net/x/2?q", None),
        ("http://fr.com", None),
    ]
    got = [(x.host, x.path, x.rule, x.verdict) for x in redirects.judge(pages(spark, rows), URL_RULES).orderBy("page_id").collect()]
    assert got == [
        ("a.net", "/1", None, "block"),
        ("b.net", "/x/2", None, "block"),
        ("c.org", "/9", "org/", "allow"),
        ("shop.com", "/de/7", "com/de/", "block"),
        ("d.net", "/3", None, "allow"),
        ("example.org", "/en/12", "example.org/en/1", "block"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("b.net", "/x/2", None, "block"),
        ("b.net", "/x/2", None, "block"),
        ("fr.com", "", None, "allow"),
    ]
    assert redirects.judge(pages(spark, []), URL_RULES).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header>Site <nav><ul><li><a href=/>Home</a></ul></nav></header><div class="cookie-notice"><p>We use cookies, a lot of them.</p></div>
<div class="wrap"><div class="post post-17" id=main><h1>Title &amp; more</h1><p>First&nbsp;line<br>goes   on <b>bold</b> here,
with &eacute; and &#x41;.<p>Second paragraph <i>unclosed with enough text to count.<!-- <p>no</p> -->
<ul><li>one<li>two</ul><aside>Related things</aside><form><p>Mail</p></form></div>
<div class="sidebar"><p>Side text that should not appear at all</p></div><section id="comments"><p>Reader says hello</p></section></div>
<footer><p>&copy; all</p></footer></body></html>"""


def test_main_text_of_a_page():
    page = html_text.parse(PAGE)
    best = html_text.best_container(page)
    assert page.paths[best] == "html>body>div.wrap>div.post.post-"
    text = "Title & more\nFirst line goes on bold here, with é and A.\nSecond paragraph unclosed with enough text to count.\none\ntwo"
    assert html_text.extract(page, None) == text == html_text.extract(page, page.paths[best])


def test_hosts_vote(spark):
    body = "<body><div class=story><p>{}</p></div><div class=box><p>{}</p></div></body>"
    rows = [("http://h.net/1", body.format("main text " * 9, "box")), ("http://h.net/2", body.format("main again " * 9, "box"))]
    rows += [("http://h.net/3", body.format("short", "a box that is longer than the story")), ("http://h.net/4", "<p>no path</p>"), (None, None), ("http://h.net/5", ""), ("http://h.net/5", "")]
    rows += [("http://long.net/", "<article>" + "<p>word</p>" * 20_000 + "<p>broken <a href='"), ("http://h.net/7", "<<a<>b</p></div>&#0;")]
    got = [x.text for x in html_text.main_text(pages(spark, rows)).orderBy("page_id").collect()]
    assert got[:7] == [("main text " * 9).strip(), ("main again " * 9).strip(), "short", "no path", "", "", ""]
    assert got[7].count("\n") >= 19_999 and len(got) == 9
    assert html_text.main_text(pages(spark, [])).collect() == []


def test_language_fuses_evidence(spark):
    docs = spark.createDataFrame(
        [("the house and the garden of the king " * 9, "en"), ("das haus und der garten des königs " * 9, "de"), (None, "fr"), ("x", None)], "text string, lang string"
    )
    en, de = "<html lang='EN-us'><body><p>the king and the house</p>", '<html lang="de"><body><p>der könig und das haus</p>'
    rows = [("http://a.com/1", en), ("http://a.com/2", en), ("http://b.de/1", de), ("http://b.de/2", de), ("http://b.de/3", de), ("http://b.de/4", None), ("http://c.de/5", "<html lang=de>"), (None, en), (None, None)]
    got = {x.page_id: x for x in language.identify(pages(spark, rows), docs).collect()}
    assert [got[i].lang for i in range(8)] == ["en", "en", "de", "de", "de", "de", "de", "en"]  # 5 by its host, 6 by its declaration
    assert all(0 < x.probability <= 1 for x in got.values()) and got[2].host_pages == 4
    assert language.identify(pages(spark, []), docs).collect() == []
    unlabelled = language.identify(pages(spark, rows), docs.where("lang is null")).collect()
    assert len(unlabelled) == 9 and {x.lang for x in unlabelled} == {None}


def test_language_of_fragments_all_text_and_rare_labels(spark, monkeypatch):
    docs = [("the house and the garden of the king " * 9, "en")] * 3 + [("das haus und der garten des königs " * 9, "de")] * 2 + [("la casa e il giardino del re " * 9, "it")]
    docs = spark.createDataFrame(docs, "text string, lang string")
    rows = [("http://a.com/1", "<h1>das haus</h1><p>und der garten des königs"), ("http://b.com/2", "la casa e il giardino del re")]
    rows += [("http://c.com/3", "<body><div><p>the king 1234567</div>" + "<section><p>das haus</section><section><p>der garten</section><section><p>des königs</section>" * 3)]
    for most in (64, 1):  # all languages in one block, each in its own
        monkeypatch.setattr(language, "LANGUAGES", most)
        got = [(x.lang, round(x.probability, 9)) for x in language.identify(pages(spark, rows), docs).orderBy("page_id").collect()]
        assert [x[0] for x in got] == ["de", "it", "de"]
        first = got if most == 64 else first
    assert got == first
