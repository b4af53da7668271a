import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as entry
from sheafline import sinks
from sheafline.plans import pipeline
from sheafline.sources import readers
from sheafline.streaming import state

def RUN():
    return F.lit("2025-01-01 00:00:00").cast("timestamp")


def test_source_list(spark, tmp_path):
    f = tmp_path / "s.yaml"
    f.write_text("sources:\n  - name: a\n    rss: http://r\n    selectors: {article_link: .x}\n  - name: b\n    fetch_method: list_page\n    url: http://u\n")
    got = {r["name"]: r for r in readers.source_list(spark, str(f)).collect()}
    assert got["a"]["fetch_method"] == "rss" and got["a"]["selectors"] == {"article_link": ".x"} and got["b"]["url"] == "http://u"
    f.write_text("other: 1\n")
    assert readers.source_list(spark, str(f)).count() == 0


def test_feeds(spark, tmp_path):
    rss, atom, sm = tmp_path / "r.xml", tmp_path / "a.xml", tmp_path / "s.xml"
    rss.write_text('<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><item><title>T1</title><link>http://a/1</link><pubDate>Tue, 02 Jan 2024 10:00:00 +0200</pubDate><dc:creator>X</dc:creator></item><item><title>2024</title></item></channel></rss>')
    atom.write_text('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A</title><link rel="self" href="http://s"/><link href="http://a/2"/><updated>2024-01-02T00:00:00Z</updated><author><name>N</name></author></entry></feed>')
    sm.write_text("<urlset><url><loc> http://a/3 </loc></url><url></url></urlset>")
    got = readers.rss(spark, str(rss), "s", RUN()).orderBy("title").collect()
    assert [(r["title"], r["url"], r["published"]) for r in got] == [("2024", None, dt.datetime(2025, 1, 1)), ("T1", "http://a/1", dt.datetime(2024, 1, 2, 8))]
    assert got[1]["authors"][0]["name"] == "X"
    got = readers.atom(spark, str(atom), "s", RUN()).first()
    assert (got["url"], got["published"], got["authors"][0]["name"]) == ("http://a/2", dt.datetime(2024, 1, 2), "N")
    assert [r["url"] for r in readers.sitemap(spark, str(sm), "s", RUN()).collect()] == ["http://a/3"]


def test_pdf_and_feed_probe(spark, tmp_path):
    (tmp_path / "x.pdf").write_bytes(b"no pdf")
    r = readers.pdf_texts(spark, str(tmp_path)).first()
    assert r["text"] is None and r["error"] and len(r["sha256"]) == 64
    sites = spark.createDataFrame([("http://a/",), ("http://b",)], "site string")
    counts = spark.createDataFrame([("http://a/feed", 3), ("http://a/rss", 0), ("http://a/atom.xml", 9)], "feed string, n long")
    assert readers.first_feed(readers.feed_candidates(sites, ("/rss", "/feed", "/atom.xml")), counts).collect()[0]["feed"] == "http://a/feed"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("k", "T", "body"), ("l", None, None)], "article_id string, title string, text string")
    sinks.contents(df, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).where("article_id = 'k'").first()["content"].startswith("Title: T\n====")
    sinks.dated(df.select("article_id"), str(tmp_path / "d"), RUN())
    assert (tmp_path / "d" / "y=2025" / "m=01" / "d=01").exists()
    assert sinks.notify(df.withColumn("payload", F.lit("p")), None) == 0


def test_stream_accepts_once(spark, tmp_path):
    src, seen, out = (str(tmp_path / n) for n in ("src", "seen", "out"))
    one = spark.createDataFrame([(1, "http://a/1", dt.datetime(2024, 1, 1)), (2, "http://A/1?x", dt.datetime(2024, 1, 1))], "seq long, url string, t timestamp")
    one.write.parquet(src)
    run = lambda: state.accept(spark, spark.readStream.schema("seq long, url string, t timestamp").parquet(src), seen, out, str(tmp_path / "cp"))
    run()
    spark.createDataFrame([(3, "http://a/1", dt.datetime(2024, 1, 2)), (4, "http://a/2", dt.datetime(2024, 1, 2))], "seq long, url string, t timestamp").write.mode("append").parquet(src)
    run()
    assert sorted(r["seq"] for r in spark.read.parquet(out).collect()) == [1, 4]
    q = state.first_seen(spark.readStream.schema("seq long, url string, t timestamp").parquet(src), "t").writeStream.format("memory").queryName("first_seen").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("first_seen").count() == 2


def test_pipeline(spark):
    sources = spark.createDataFrame([("s", "journal", "none", {"article_link": ".x"})], "name string, type string, pdf_strategy string, selectors map<string,string>")
    feed = spark.createDataFrame([(1, "http://a/x.pdf", "s", "T", "2024", "10.1234/a", None), (2, "http://a/X.pdf?y", "s", "U", "2024", None, None)], "seq long, url string, source string, title string, published string, doi string, selectors map<string,string>")
    links = spark.createDataFrame([(3, "http://a/b", "s", "L")], "seq long, url string, source string, title string")
    found = pipeline.discover(sources, feed, links)
    assert sorted(r["seq"] for r in found.collect()) == [1, 3]
    pages = spark.createDataFrame([("http://a/b", "<article><p>" + "Words of a page. " * 20)], "url string, html string")
    got = {r["url"]: r for r in pipeline.process(found, pages).collect()}
    assert got["http://a/x.pdf"]["note"] == "direct" and got["http://a/x.pdf"]["status"] == "no_content"
    assert got["http://a/b"]["status"] == "ok" and "*L*" in got["http://a/b"]["payload"]


def test_entry_contract(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and "p3_found" in queries
    assert entry.entry(spark).columns == ["table_name", "row_id", "iso_value"]
