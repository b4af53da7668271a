"""Discovery quality per source."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafline.functions import text


def elapsed(start: Column, end: Column) -> Column:
    """Seconds between two times, rounded to hundredths."""
    return F.round((F.unix_micros(end) - F.unix_micros(start)) / 1_000_000, 2)


def audit(sources: DataFrame, items: DataFrame, samples: int = 3, errors: DataFrame | None = None) -> DataFrame:
    """``name, type, method, url, article_count, status, sample_articles`` of every source, also of those without items.

    Status: error, empty (0), low (1 to 4), ok. Samples are the first items by ``seq``, chosen within 64
    salted parts of each source first, so that no task sorts a whole source.
    """
    first = F.slice(F.array_sort(F.collect_list(F.struct("seq", F.substring("title", 1, 80).alias("title"), F.substring("url", 1, 100).alias("url")))), 1, samples)
    counts = items.groupBy("source").agg(F.count(F.lit(1)).alias("article_count"))
    # lowest sequence numbers per source through a salted two-step selection
    salted = items.select("source", "seq", "title", "url", F.pmod(F.xxhash64("seq"), F.lit(64)).alias("salt"))
    few = salted.withColumn("_n", F.row_number().over(Window.partitionBy("source", "salt").orderBy("seq"))).where(F.col("_n") <= samples)
    sampled = few.groupBy("source").agg(first.alias("sample_articles"))
    joined = sources.join(counts, sources["name"] == counts["source"], "left").drop("source").join(sampled, sources["name"] == sampled["source"], "left").drop("source")
    failed = F.lit(False)
    if errors is not None:
        joined = joined.join(errors.select(F.col("source").alias("_failed")).distinct(), sources["name"] == F.col("_failed"), "left")
        failed = F.col("_failed").isNotNull()
    n = F.coalesce("article_count", F.lit(0))
    known = F.coalesce("fetch_method", F.lit("rss")).isin("rss", "sitemap", "list_page")
    status = F.when(failed | ~known, "error").when(n == 0, "empty").when(n < 5, "low").otherwise("ok")
    return joined.select(
        "name", "type", F.coalesce("fetch_method", F.lit("rss")).alias("method"), text.filled(F.col("rss"), F.col("url"), F.col("sitemap")).alias("url"),
        n.alias("article_count"), status.alias("status"), F.transform(F.coalesce("sample_articles", F.array()), lambda s: F.struct(s["title"].alias("title"), s["url"].alias("url"))).alias("sample_articles"),
    )


def totals(audited: DataFrame) -> DataFrame:
    """Sources and articles per status, and over all (status null)."""
    return audited.rollup("status").agg(F.count(F.lit(1)).alias("sources"), F.sum("article_count").alias("articles"))
