import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sheafline.functions import html, text, url
from sheafline.operators import audit, enrich, failures, fulltext, items, summaries
from sheafline.schemas import SUMMARY_KEYS


def column(spark, values, f, kind="string"):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").orderBy("i").select(f(F.col("v"))).collect()]


def test_text_functions(spark):
    assert column(spark, ["  a b ", None, ""], text.strip) == ["a b", None, ""]
    assert column(spark, ["x" * 200, "x" * 201, "  ", None], text.clean_title) == ["x" * 200, "x" * 200 + "...", "", None]
    assert column(spark, ['a<b>: "c" d/e', None], text.safe_name) == ["ab_c_de", None]
    assert column(spark, ["see 10.1234/abc.d).", "none", None, "A 10.99999/X and 10.1/y"], text.first_doi) == ["10.1234/abc.d).", None, None, "10.99999/X"]
    assert column(spark, ["```json\n{}\n```", "{}", "```{}```", "a ``` b"], text.unfenced) == ["{}", "{}", "{}", "a ``` b"]
    assert column(spark, ["Lung CANCER and insulin", "", None, "deep learning"], text.topics) == [["oncology", "diabetes"], [], [], ["ai-ml"]]
    assert column(spark, ['["a","b"]', "plain", None], text.lines_of) == ["a\nb", "plain", None]
    long = "p" * 31
    assert column(spark, [["p" * 30, long], [], None], lambda c: text.paragraphs(c, True), "array<string>") == [long, "", None]
    assert column(spark, [["q" * 49, "q" * 50, "Cookie " + "q" * 60]], lambda c: text.paragraphs(c, False), "array<string>") == ["q" * 50]


def test_notice_limits(spark):
    n = lambda s: spark.range(1).select(text.notice(F.lit(None).cast("string"), F.lit(""), F.lit("2020"), F.lit(None).cast("string"), F.lit("http://a"), F.lit(s))).first()[0]
    assert "x" * 1000 + "\n\n🔗 <http://a|" in n("x" * 1000) and "x" * 1000 + "..." in n("x" * 1001)
    assert "*Unknown Title*\n_Unknown Journal | 2020_\n\n" in n("s")


def test_addresses(spark):
    assert column(spark, [" HTTP://A.b/C?x=1#f ", None, "a#f?x"], url.normalized) == ["http://a.b/c", None, "a#f"]
    assert column(spark, ["http://u@h:8/p?q", "/p/q", "//h/x", None], url.netloc) == ["u@h:8", "", "h", ""]
    assert column(spark, ["http://h/a b?x", "/p/q#f", ""], url.path) == ["/a b", "/p/q", ""]
    base = F.lit("https://s.example/list/page")
    cases = ["/a", "//h/a", "a", "http://x/y", "#x", "mailto:a@b", None]
    assert column(spark, cases, lambda c: url.absolute(c, base)) == ["https://s.example/a", "https://h/a", None, "http://x/y", None, None, None]
    assert column(spark, ["../b", "?q", None], lambda c: url.joined(base, c)) == ["https://s.example/b", "https://s.example/list/page?q", None]
    good = lambda c: url.is_article(c, F.lit("site.example"))
    cases = ["", "http://other.example/news/1", "http://site.example/login/news/", "http://www.site.example/NEWS/1", "/a/b", "/abcdefgh/ijklmnop", "http://site.example/x#y", None]
    assert column(spark, cases, good) == [False, False, False, True, False, True, False, False]
    assert column(spark, ["a.known.org", "known.org", "unknown.org"], lambda c: url.known_feed(c, {"known.org": "f"})) == ["f", "f", None]


PAGE = """<html><head><meta content="It's &amp; a title" name="citation_title"><meta name='description' content='Short'><meta name="citation_author" content="A B"><meta name="citation_author" content="C D">
<script>var x = "</p><p>no";</script></head><body><div class="modal big"><p>%s</p></div><p>Outside %s</p><article><p>%s<p>%s</article><a href="/f/x.PDF?d=1">d</a></body></html>"""


def test_extraction(spark):
    doc = html.extract(PAGE % ("overlay " * 20, "y" * 60, "a" * 201, "b" * 30))
    assert doc == {"text": "a" * 201, "title": "It's & a title", "authors": ["A B", "C D"], "abstract": "Short"}
    doc = html.extract(PAGE % ("overlay " * 20, "y" * 60, "a" * 100, "b" * 40))
    assert doc["text"] == "Outside " + "y" * 60 + "\n\n" + "a" * 100
    assert html.extract("") == {"text": "", "title": None, "authors": [], "abstract": None}
    assert html.extract(None)["text"] is None
    ld = lambda d: f'<script type="application/ld+json">{d if isinstance(d, str) else json.dumps(d)}</script>'
    got = html.extract(ld("{bad") + ld([{"@type": "NewsArticle", "headline": "n"}, {"@type": "Article", "name": "L", "author": [{"name": "X"}, "Y"], "abstract": "abs"}]))
    assert (got["title"], got["authors"], got["text"]) == ("L", ["X", "Y"], "abs")
    got = html.extract(ld([{"@type": "Article", "headline": "first"}]) + ld({"@type": "NewsArticle", "headline": "dict", "author": {"name": "Z"}}))
    assert (got["title"], got["authors"]) == ("dict", ["Z"])
    assert html.extract('<meta name="citation_title" content=""><meta property="og:title" content="og">')["title"] is None
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "<p>x"), (4, PAGE % ("", "", "a" * 201, ""))], "page_id long, html string")
    assert {r["id"]: r["status"] for r in html.documents(rows).collect()} == {1: "error", 2: "no_content", 3: "no_content", 4: "ok"}
    assert html.documents(rows.limit(0)).count() == 0


def test_tags_and_links(spark):
    page = PAGE % ("", "", "", "")
    assert column(spark, [page, "<p>", None], html.pdf_link) == ["/f/x.PDF?d=1", None, None]
    assert column(spark, ['<meta name="citation_pdf_url" content=""><a href="a.pdf">', '<meta content="/m.pdf" name="citation_pdf_url">'], html.pdf_link) == ["a.pdf", "/m.pdf"]
    assert column(spark, ["<h1 class=x>A <b>B</b></h1>", "<h2>"], html.heading) == ["A B", None]
    feeds = '<a href="/x/feed"><a href="y.rss"><link href="/b" type="application/rss+xml"><link type="application/rss+xml" href="/a">'
    assert column(spark, [feeds], html.feed_links) == [["/a", "/b", "y.rss", "/x/feed"]]
    body = '<div><a class="card big" href="/1">One<b> x</b></a><a href="/2">Two</a><a>none</a><section id="s"><a href="/3" data-k="v">Three</a></section></div>'
    rows = spark.createDataFrame([("p1", body, "a.card"), ("p2", body, ".none"), ("p3", body, "#s a[data-k='v']"), ("p4", body, "a:has-text('two')"), ("p5", None, None)], "page_url string, html string, sel string")
    got = {}
    for r in html.links(rows, selector_col="sel").collect():
        got.setdefault(r["page_url"], []).append((r["href"], r["title"]))
    assert got == {"p1": [("/1", "One x")], "p2": [("/1", "One x"), ("/2", "Two"), ("/3", "Three")], "p3": [("/3", "Three")], "p4": [("/2", "Two")]}


def test_items(spark):
    rows = [(1, "http://a/x?1", "s"), (2, " HTTP://a/X?2 ", "s"), (3, None, "s"), (4, "http://a/y ", "t"), (5, "http://a/y", "t")]
    df = spark.createDataFrame(rows, "seq long, url string, source string")
    assert [r["seq"] for r in items.deduplicated(df).orderBy("seq").collect()] == [1, 4]
    assert [r["seq"] for r in items.deduplicated(df, keep_query=True).orderBy("seq").collect()] == [1, 2, 4]
    assert items.deduplicated(df.limit(0)).count() == 0
    links = spark.createDataFrame([("http://h.example/l", "s", h, t, i, b) for i, (h, t, b) in enumerate([("/news/1", " A ", False), ("/news/1", "B", False), ("/about/1", "C", False), ("/about/2", "D", True), ("x", "E", True)])], "page_url string, source string, href string, title string, pos int, by_selector boolean")
    assert {(r["url"], r["title"]) for r in items.page_links(links).collect()} == {("http://h.example/news/1", "A"), ("http://h.example/about/2", "D")}
    seen = spark.createDataFrame([("a",), (None,)], "id string")
    new = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "k string, n int")
    assert sorted(r["n"] for r in items.unseen(new, seen, "k").collect()) == [2, 3, 4]
    assert [r["id"] for r in items.marked(seen, new, "k").collect()] == ["b"]
    assert sorted((r["k"] or "", r["n"]) for r in items.top_per(new, "k", [F.desc("n")], 1).collect()) == [("", 4), ("a", 1), ("b", 3)]


def test_audit(spark):
    sources = spark.createDataFrame([("many", "rss", "r"), ("few", None, "r"), ("none", "list_page", None), ("odd", "ftp", None)], "name string, fetch_method string, rss string")
    sources = sources.selectExpr("name", "'t' AS type", "fetch_method", "rss", "'u' AS url", "null AS sitemap")
    rows = spark.createDataFrame([(i, "many" if i < 9 else "few", f"t{i}", f"u{i}") for i in range(11)], "seq long, source string, title string, url string")
    got = {r["name"]: r for r in audit.audit(sources, rows).collect()}
    assert {k: (r["article_count"], r["status"]) for k, r in got.items()} == {"many": (9, "ok"), "few": (2, "low"), "none": (0, "empty"), "odd": (0, "error")}
    assert [s["title"] for s in got["many"]["sample_articles"]] == ["t0", "t1", "t2"] and got["none"]["sample_articles"] == []
    assert {(r["status"], r["sources"], r["articles"]) for r in audit.totals(audit.audit(sources, rows)).collect()} == {("ok", 1, 9), ("low", 1, 2), ("empty", 1, 0), ("error", 1, 0), (None, 4, 11)}


def test_cascade(spark):
    oa_json = lambda **k: json.dumps({"is_oa": True, "title": "T: a/b", "published_date": "2020", "best_oa_location": {"url_for_pdf": "http://oa/x.pdf"}, **k})
    oa = spark.createDataFrame([("10.1234/a", oa_json()), ("10.1234/b", oa_json(is_oa=False)), ("10.1234/c", oa_json(best_oa_location=None)), ("10.1234/d", oa_json(best_oa_location={"url_for_pdf": ""})), ("10.1234/e", "{bad")], "doi string, json string")
    reg = spark.createDataFrame([("10.1234/B", json.dumps({"message": {"title": ["R"], "abstract": "abs"}})), ("10.1234/c", json.dumps({"message": {"title": []}}))], "doi string, json string")
    rows = [(1, "http://h/x.PDF", "10.1234/A"), (2, "http://h/p", "<p>10.1234/A</p>"), (3, "http://h/p", '10.1234/b <a href="q.pdf">'), (4, "http://h/p", "10.1234/b"), (5, "http://h/p", "10.1234/c"), (6, "http://h/p", None), (7, "http://h/p", "10.1234/d")]
    a = spark.createDataFrame(rows, "article_id long, url string, html string")
    full = lambda **k: {r["article_id"]: r for r in fulltext.cascade(a, fulltext.open_access(oa), fulltext.registered(reg), **k).collect()}
    got = full()
    assert {k: r["note"] for k, r in got.items()} == {1: "direct", 2: "unpaywall", 3: "html_anchor", 4: "crossref_no_pdf", 5: "no_pdf_found", 6: "no_pdf_found", 7: "no_pdf_found"}
    assert got[3]["pdf_url"] == "http://h/q.pdf" and got[4]["fallback_abstract"] == "abs" and got[2]["file_name"] == "T_ab.pdf"
    ok = spark.createDataFrame([("http://h/x.PDF", False), ("http://oa/x.pdf", True)], "url string, ok boolean")
    assert full(fetched=ok)[1]["note"] == "unpaywall" and full(fetched=ok)[3]["note"] == "crossref_no_pdf"


def test_summaries(spark):
    base = {k: "v" for k in SUMMARY_KEYS} | {"authors": ["A", "B"], "doi": None}
    raws = [json.dumps(base), "```json\n" + json.dumps(base | {"dataset": ["x", "y"], "extra": 1, "input_token": 5}) + "\n```", json.dumps({k: v for k, v in base.items() if k != "model"}), json.dumps(base | {"title": 3}), json.dumps(base | {"authors": "A"}), "no json", "[1]", None, ""]
    df = spark.createDataFrame(list(enumerate(raws)), "i int, raw string")
    got = {r["i"]: r for r in summaries.validated(df).collect()}
    assert [got[i]["error"] for i in range(5)] == [None, None, "missing: model", "wrong type: title", "wrong type: authors"]
    assert all(got[i]["error"] == "no JSON object" for i in range(5, 9))
    assert got[1]["summary"]["dataset"] == "x\ny" and got[1]["summary"]["input_token"] == 5 and got[0]["summary"]["doi"] is None and got[0]["summary"]["authors"] == ["A", "B"]
    s = summaries.validated(df.where("i = 0")).select(summaries.overridden(F.col("summary"), F.lit(""), F.lit("10.1/x"), F.lit(None).cast("string")).alias("s")).first()["s"]
    assert (s["title"], s["doi"], s["published_date"]) == ("v", "10.1/x", "v")
    shapes = ['{"choices":[{"message":{"content":"a"}}]}', '{"choices":[{"text":"b"}]}', '{"choices":[]}', None]
    assert column(spark, shapes, summaries.answer) == ["a", "b", None, None]


def test_failures_and_enrichers(spark, tmp_path):
    from sheafline.operators import failures as q

    folder = str(tmp_path / "queue")
    assert q.read(spark, folder).count() == 0
    df = spark.createDataFrame([("u", "s", "t", dt.datetime(2024, 1, 2, 3, 4, 5), "boom"), ("v", "s", None, None, None)], "url string, source string, title string, published timestamp, e string")
    q.append(q.records(df, "e", F.lit("2024-05-06 07:08:09").cast("timestamp")), folder)
    (tmp_path / "queue" / "bad.json").write_text("not json\n")
    r = q.read(spark, folder).collect()
    assert len(r) == 1 and r[0]["item"]["published"] == "2024-01-02T03:04:05" and r[0]["failed_at"] == "2024-05-06T07:08:09"
    q.clear(spark, folder)
    assert q.read(spark, folder).count() == 0
    texts = spark.createDataFrame([(1, "One study. One study of two things. Other."), (2, ""), (3, None)], "i int, text string")
    out = {r["i"]: r for r in enrich.enriched(enrich.enriched(texts, "text", enrich.Extractive(1), "s"), "text", enrich.HashedEmbedding(8), "v").collect()}
    assert out[1]["s"] and len(out[1]["v"]) == 8 and out[2]["s"] is None and out[3]["v"] is None

    class Broken:
        schema_type = "string"

        def __call__(self, texts):
            raise RuntimeError("down")

    assert {r["s_error"] for r in enrich.enriched(texts, "text", Broken(), "s").collect()} == {"RuntimeError: down"}
    v = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([1.0, 1.0], [2.0, 2.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0]), ([1.0], [1.0, 2.0])], "a array<float>, b array<float>")
    got = [r[0] for r in v.select(enrich.cosine(F.col("a"), F.col("b"))).collect()]
    assert got[0] == 0 and got[1] == pytest.approx(1) and got[2:] == [None, None, None]
    assert failures.tally(spark.createDataFrame([("ok",), ("ok",), ("error",)], "status string")).count() == 2
