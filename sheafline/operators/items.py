"""Discovery as DataFrames: dispatch of sources, items of each kind, keep-first deduplication, new items."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafline.functions import text, url


def dispatched(sources: DataFrame) -> DataFrame:
    """Sources with the way they are read (``rss``, ``sitemap``, ``list_page``; null for an unknown one) and its address."""
    method = F.coalesce("fetch_method", F.lit("rss"))
    address = F.when(method == "rss", F.col("rss")).when(method == "sitemap", F.col("sitemap")).when(method == "list_page", F.col("url"))
    return sources.select("name", F.when(method.isin("rss", "sitemap", "list_page"), method).alias("method"), text.filled(address).alias("address"))


def first_by(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each key in a given order; rows without key are left out.

    The order must be unique to give the same row in every run. One partial aggregate per key crosses the shuffle, so a
    key that many rows have is no hot partition, as it would be in a window.
    """
    cols = df.columns
    kept = df.withColumn("_key", key).where(F.col("_key").isNotNull())
    best = kept.groupBy("_key").agg(F.min_by(F.struct(*cols), order).alias("_row"))
    return best.select("_row.*")


def deduplicated(items: DataFrame, keep_query: bool = False) -> DataFrame:
    """Items with the first occurrence of each normalised address; items without address are left out."""
    return first_by(items, url.article_key(F.col("url"), keep_query), "seq")


def page_links(links: DataFrame, keep_unfiltered: bool = True) -> DataFrame:
    """Links of list pages as items: absolute, once per page, filtered unless a selector chose them, titles cleaned.

    ``links``: ``page_url, source, href, title, pos, by_selector``.
    """
    full = links.withColumn("url", url.absolute(F.col("href"), F.col("page_url"))).where("url is not null")
    once = first_by(full, F.struct("page_url", "url"), "pos")
    good = url.is_article(F.col("url"), url.netloc(F.col("page_url")))
    kept = once.where(F.col("by_selector") | good) if keep_unfiltered else once.where(good)
    return kept.select("url", "source", text.clean_title(F.col("title")).alias("title"), "page_url", "pos")


def together(*frames: DataFrame) -> DataFrame:
    """Union by name; columns that one kind lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def annotated(items: DataFrame, sources: DataFrame) -> DataFrame:
    """Items with their source's settings; own selectors win. The small side is broadcast if its size allows."""
    s = sources.select(F.col("name").alias("source"), "type", "pdf_strategy", F.col("selectors").alias("_selectors"))
    return items.join(s, "source").withColumn("selectors", F.coalesce("selectors", "_selectors", F.create_map().cast("map<string,string>"))).drop("_selectors")


def unseen(df: DataFrame, seen: DataFrame, key: str, seen_key: str = "id") -> DataFrame:
    """Rows whose key is not in ``seen``; rows without key count as new."""
    return df.join(seen.select(F.col(seen_key).alias("_seen")), F.col(key) == F.col("_seen"), "left_anti")


def marked(seen: DataFrame, new: DataFrame, key: str, seen_key: str = "id") -> DataFrame:
    """Keys to append to ``seen``: new ones, each once."""
    return unseen(new.select(F.col(key).alias(seen_key)).where(F.col(key).isNotNull()).distinct(), seen, seen_key, seen_key)


def top_per(df: DataFrame, by: str, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_n") <= n).drop("_n")
