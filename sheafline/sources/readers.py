"""Readers: source list, feeds, sitemaps, pages and PDFs that were fetched before."""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.operators.timestamps import with_iso, with_parts
from sheafline.schemas import ATOM_ENTRY, RSS_ENTRY, SITEMAP_ENTRY, SOURCE


def source_list(spark: SparkSession, path: str) -> DataFrame:
    """Sources of a YAML file, key ``sources``; the file is small and read on the driver."""
    import yaml

    with open(path, encoding="utf-8") as f:
        rows = (yaml.safe_load(f) or {}).get("sources") or []
    names = [p.strip().split(" ")[0] for p in SOURCE.split(", ")]
    clean = [tuple({str(k): str(v) for k, v in (r.get(n) or {}).items()} if n == "selectors" else r.get(n, "rss" if n == "fetch_method" else None) for n in names) for r in rows]
    return spark.createDataFrame(clean, SOURCE)


def _time(df: DataFrame, value: str, run_at: Column) -> DataFrame:
    """Adds ``published``: the instant of a feed's date, else the time of the run."""
    df = df.withColumn("_order", F.lit(None).cast("string")).withColumn("_tz", F.lit("UTC"))
    df = with_iso(with_parts(df, value, "_order"), "_tz")
    return df.withColumn("published", F.coalesce(F.try_to_timestamp("iso_value"), run_at)).drop("_order", "_tz", "p", "iso_value")


def rss(spark: SparkSession, path: str, source: str, run_at: Column, whole_files: bool = True) -> DataFrame:
    """Entries of RSS files; a missing date becomes the time of the run. ``whole_files=False``: files with one entry a line, without a root."""
    raw = spark.read.format("xml").schema(RSS_ENTRY).option("rowTag", "item").option("ignoreNamespace", "true").option("multiLine", whole_files).load(path)
    rows = raw.select(F.trim("link").alias("url"), F.lit(source).alias("source"), "title", F.col("pubDate").alias("_date"), F.col("identifier").alias("doi"), F.coalesce("creator", F.array_compact(F.array("author"))).alias("_who"))
    rows = _time(rows, "_date", run_at)
    return rows.select("url", "source", "title", "published", "doi", F.transform("_who", lambda a: F.struct(a.alias("name"))).alias("authors"))


def atom(spark: SparkSession, path: str, source: str, run_at: Column) -> DataFrame:
    """Entries of Atom files."""
    raw = spark.read.format("xml").schema(ATOM_ENTRY).option("rowTag", "entry").option("ignoreNamespace", "true").load(path)
    main = F.filter("link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    rows = raw.select(F.coalesce(F.get(main, F.lit(0))["_href"], F.get("link", F.lit(0))["_href"]).alias("url"), F.lit(source).alias("source"), "title", F.coalesce("published", "updated").alias("_date"), F.col("author").alias("authors"))
    return _time(rows, "_date", run_at).select("url", "source", "title", "published", F.lit(None).cast("string").alias("doi"), "authors")


def sitemap(spark: SparkSession, path: str, source: str, run_at: Column, whole_files: bool = True) -> DataFrame:
    """Addresses of a sitemap, or of the sitemaps an index lists. ``whole_files=False``: files with one entry a line, without a root."""
    frames = [spark.read.format("xml").schema(SITEMAP_ENTRY).option("rowTag", tag).option("ignoreNamespace", "true").option("multiLine", whole_files).load(path) for tag in (("url", "sitemap") if whole_files else ("url",))]  # a line is one entry, whatever its tag
    locs = reduce(DataFrame.unionByName, frames).where("loc is not null")
    return locs.select(F.trim("loc").alias("url"), F.lit(source).alias("source"), F.lit(None).cast("string").alias("title"), run_at.cast("timestamp").alias("published"))


def html_files(spark: SparkSession, path: str) -> DataFrame:
    """``url, html``: one row per file of fetched pages."""
    return spark.read.option("wholetext", "true").text(path).select(F.input_file_name().alias("url"), F.col("value").alias("html"))


def pdf_texts(spark: SparkSession, path: str) -> DataFrame:
    """``path, sha256, text, error`` of PDF files; text needs ``pypdf``, without it the error says so."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path)

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            from pypdf import PdfReader
        except ImportError:
            PdfReader = None
        for b in batches:
            texts, errors = [], []
            for content in b["content"]:
                try:
                    if PdfReader is None:
                        raise RuntimeError("pypdf is not installed")
                    pages = [p.extract_text() or "" for p in PdfReader(io.BytesIO(content)).pages]
                    texts.append("".join(p + "\n" for p in pages if p))
                    errors.append(None if texts[-1].strip() else "no text")
                except Exception as e:  # noqa: BLE001
                    texts.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"path": b["path"], "sha256": b["sha256"], "text": texts, "error": errors})

    return files.select("path", F.sha2("content", 256).alias("sha256"), "content").mapInPandas(apply, "path string, sha256 string, text string, error string")


def feed_candidates(sites: DataFrame, paths: tuple[str, ...]) -> DataFrame:
    """Site × the usual places of feeds, as an array that is exploded: no join, rank tells the order."""
    return sites.select("*", F.posexplode(F.array(*[F.lit(p) for p in paths])).alias("rank", "_p")).withColumn("feed", F.concat(F.regexp_replace("site", "/+$", ""), "_p")).drop("_p")


def first_feed(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Per site the first candidate that has entries. ``counts``: ``feed, n``."""
    good = candidates.join(counts.where("n > 0"), "feed")
    return good.groupBy("site").agg(F.min_by(F.struct("feed", "n"), "rank").alias("f")).select("site", "f.feed", "f.n")
