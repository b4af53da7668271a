"""The whole run as one plan: discover, deduplicate, extract, find full texts, summarise, report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.functions import html, text, url
from sheafline.operators import enrich, fulltext, items


def discover(sources: DataFrame, feed: DataFrame, links: DataFrame) -> DataFrame:
    """Items of all sources in discovery order, each address once, with its source's settings.

    Addresses are deduplicated on narrow columns before anything wide is joined.
    """
    found = items.deduplicated(items.together(feed, links))
    return items.annotated(found, sources)


def process(articles: DataFrame, pages: DataFrame, oa: DataFrame | None = None, registry: DataFrame | None = None, enricher: enrich.Enricher | None = None) -> DataFrame:
    """One result row per article: document, full-text candidate, summary, status and notification.

    ``articles``: ``url, source, title, published, doi``; ``pages``: ``url, html``.
    """
    a = articles.select("url", "source", F.col("title").alias("item_title"), F.col("published").cast("string").alias("item_published"), F.col("doi").alias("item_doi"), url.article_key(F.col("url")).alias("article_id"))
    a = a.join(pages.select("url", "html"), "url", "left")
    docs = html.documents(a.select(F.xxhash64("article_id").alias("k"), "html"), "k").withColumnRenamed("id", "k")
    full = fulltext.cascade(a.select("article_id", "url", "html", F.col("item_doi").alias("doi")), oa, registry).select("article_id", "doi", "pdf_url", "note", F.col("published_date").alias("oa_published"), F.col("title").alias("oa_title"), "fallback_abstract")
    joined = a.drop("html").withColumn("k", F.xxhash64("article_id")).join(docs, "k", "left").drop("k").join(full, "article_id", "left")
    joined = joined.withColumn("title", text.filled(F.col("item_title"), F.col("title"), F.col("oa_title"))).withColumn("content", text.filled(F.col("text"), F.col("abstract"), F.col("fallback_abstract")))
    done = enrich.enriched(joined.select("article_id", "url", "source", "title", "item_published", "oa_published", "doi", "pdf_url", "note", "authors", "abstract", "content"), "content", enricher or enrich.Extractive(), "summary")
    status = F.when(F.col("summary_error").isNotNull(), "error").when(F.col("content").isNull(), "no_content").otherwise("ok")
    published = text.filled(F.col("oa_published"), F.col("item_published"))
    return done.withColumn("status", status).withColumn("published_date", published).withColumn("payload", text.notice(F.col("title"), F.col("source"), published, F.col("doi"), F.col("url"), F.col("summary")))
