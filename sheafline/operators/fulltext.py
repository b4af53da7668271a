"""Which full text an article has: lookups by identifier and an ordered cascade of candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.functions import html, text, url
from sheafline.schemas import OPEN_ACCESS, REGISTRY


def open_access(lookup: DataFrame, doi: str = "doi", body: str = "json", any_location: bool = False) -> DataFrame:
    """``doi, oa`` of records that offer a PDF. ``any_location``: also the first of all locations, and page addresses."""
    d = F.from_json(body, OPEN_ACCESS)
    best = d["best_oa_location"]
    place = F.coalesce(best, F.get(d["oa_locations"], F.lit(0))) if any_location else best
    pdf = text.filled(place["url_for_pdf"], place["url"]) if any_location else text.filled(place["url_for_pdf"])
    info = F.struct(pdf.alias("pdf_url"), d["title"].alias("title"), place["license"].alias("license"), place["host_type"].alias("host"), d["published_date"].alias("published_date"))
    rows = lookup.select(F.lower(doi).alias("doi"), F.when(F.coalesce(d["is_oa"], F.lit(False)) & pdf.isNotNull(), info).alias("oa"))
    latest = F.struct(F.coalesce(F.col("oa.published_date"), F.lit("")), F.col("oa.pdf_url"))  # of several records the latest, by its date
    return rows.where("doi is not null and oa is not null").groupBy("doi").agg(F.max_by("oa", latest).alias("oa"))


def registered(lookup: DataFrame, doi: str = "doi", body: str = "json") -> DataFrame:
    """``doi, registry``: first title and abstract of registry records."""
    m = F.from_json(body, REGISTRY)["message"]
    info = F.struct(F.get(m["title"], F.lit(0)).alias("title"), m["abstract"].alias("abstract"))
    return lookup.select(F.lower(doi).alias("doi"), F.when(m.isNotNull(), info).alias("registry")).where("doi is not null and registry is not null").groupBy("doi").agg(F.min("registry").alias("registry"))


def _candidate(when: Column, pdf: Column, note: Column | str, oa: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.when(
        when & pdf.isNotNull(),
        F.struct(pdf.alias("pdf_url"), (F.lit(note) if isinstance(note, str) else note).alias("note"), (oa["title"] if oa is not None else none).alias("title"), (oa["published_date"] if oa is not None else none).alias("published_date")),
    )


def cascade(articles: DataFrame, oa: DataFrame | None = None, registry: DataFrame | None = None, fetched: DataFrame | None = None) -> DataFrame:
    """One row per article with the first candidate that holds: direct link, open-access record, link of the page; else notes.

    ``articles``: ``article_id, url, html`` and optionally ``doi`` (else taken from the page). Lookups are equi-joins on
    the identifier against tables with one row per identifier. ``fetched`` (``url, ok``): where given, a candidate must be
    among the addresses that could be fetched. The abstract of the registry is looked up for articles without candidate.
    """
    a = articles
    if "doi" not in a.columns:
        a = a.withColumn("doi", F.lit(None).cast("string"))
    a = a.withColumn("doi", F.coalesce(text.filled(F.col("doi")), text.first_doi(F.col("html")))).withColumn("_doi", F.lower("doi"))
    a = a.join(oa.withColumnRenamed("doi", "_doi"), "_doi", "left") if oa is not None else a.withColumn("oa", F.from_json(F.lit(None).cast("string"), "pdf_url string, title string, license string, host string, published_date string"))
    link = url.joined(F.col("url"), html.pdf_link(F.col("html")))
    yes = F.lit(True)
    found = [
        _candidate(F.lower("url").endswith(".pdf"), F.col("url"), "direct"),
        _candidate(F.col("oa").isNotNull(), F.col("oa")["pdf_url"], "unpaywall", F.col("oa")),
        _candidate(yes, link, "html_anchor"),
    ]
    a = a.withColumn("_all", F.array_compact(F.array(*found)))
    if fetched is not None:
        good = fetched.where("ok").select(F.col("url").alias("_url")).distinct()
        tried = a.select("article_id", F.posexplode("_all").alias("_n", "_c")).join(good, F.col("_c.pdf_url") == F.col("_url"))
        first = tried.groupBy("article_id").agg(F.min_by("_c", "_n").alias("chosen"))
        a = a.join(first, "article_id", "left")
    else:
        a = a.withColumn("chosen", F.get("_all", F.lit(0)))
    if registry is not None:
        rest = a.where("chosen is null and _doi is not null").select("article_id", "_doi").join(registry.withColumnRenamed("doi", "_doi"), "_doi").select("article_id", "registry")
        a = a.join(rest, "article_id", "left")
    else:
        a = a.withColumn("registry", F.from_json(F.lit(None).cast("string"), "title string, abstract string"))
    note = F.coalesce(F.col("chosen.note"), F.when(F.col("registry.abstract").isNotNull(), "crossref_no_pdf").otherwise("no_pdf_found"))
    return a.select(
        "article_id", "doi", F.col("chosen.pdf_url").alias("pdf_url"), note.alias("note"), F.col("chosen.title").alias("title"),
        F.col("chosen.published_date").alias("published_date"), F.when(F.col("chosen").isNull(), F.col("registry.abstract")).alias("fallback_abstract"),
        F.when(F.col("chosen").isNotNull(), text.pdf_name(F.col("chosen.title"), F.col("article_id").cast("string"))).alias("file_name"),
    )
