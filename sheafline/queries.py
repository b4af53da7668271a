"""Registered queries of the core operators and, where SQL can state them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.operators import timestamps
from sheafline.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query, and its SQL if given."""

    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("p3_found")
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable date of the feed and of both summary tables in its normal form."""
    clock = table(spark, folder, "source_clock")
    parts = []
    for name, row, value, ingested in (
        ("feed_items", "seq", "published", "fetched_at"), ("summaries_pdf", "paper_id", "published_date", None), ("summaries_html", "paper_id", "published_date", None),
    ):
        df = table(spark, folder, name)
        parts.append(df.select(F.lit(name).alias("table_name"), F.col(row).alias("row_id"), "source", F.col(value).alias("value"), (F.col(ingested) if ingested else F.lit(None).cast("timestamp")).alias("ingested")))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return timestamps.normalise_times(rows, clock, ["table_name", "row_id"], "value", ingested_col="ingested")


@query("p3_zones")
def p3_zones(spark: SparkSession, folder: str) -> DataFrame:
    """Per source: whether the zone that its own rows point to keeps the same time as the declared one, which takes no part.

    Zones agree if their clocks do in January and in July. Where rows reach the feed months after publication, their
    delays say nothing, and rows with written offsets decide.
    """
    clock = table(spark, folder, "source_clock")
    feed = table(spark, folder, "feed_items").select("source", "published", F.col("fetched_at").alias("ingested")).join(clock.select("source", "date_order"), "source")
    found = timestamps.estimate_zones(timestamps.with_parts(feed, "published", "date_order"))
    at = lambda zone, day: F.convert_timezone(F.col(zone), F.lit("UTC"), F.lit(f"2024-{day} 12:00:00").cast("timestamp_ntz"))
    same = (at("tz_estimated", "01-15") == at("tz_name", "01-15")) & (at("tz_estimated", "07-15") == at("tz_name", "07-15"))
    compared = clock.select("source", "tz_name").join(found, "source", "left").groupBy("source", "tz_name")
    return compared.agg(F.coalesce(F.min(same), F.lit(False)).alias("agrees"))
