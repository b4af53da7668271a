"""Writers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.session import cut


def dated(df: DataFrame, folder: str, run_at: Column, form: str = "parquet") -> None:
    """Rows below ``y=/m=/d=`` of the run."""
    parts = {"y": "yyyy", "m": "MM", "d": "dd"}
    df.withColumns({k: F.date_format(run_at, f) for k, f in parts.items()}).write.mode("append").partitionBy(*parts).format(form).save(folder)


def day_path(at: Column) -> Column:
    return F.date_format(at, "yyyy/MM/dd")


def object_address(bucket: str | None, prefix: str, at: Column, path: Column) -> Column:
    """Address of a file in an object store; null without bucket."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.concat_ws("/", F.lit(f"s3://{bucket}"), F.lit(prefix), day_path(at), name) if bucket else F.lit(None).cast("string")


def contents(df: DataFrame, folder: str) -> None:
    """Texts with their title above a rule, one file per part, keyed by article."""
    rule = F.concat(F.lit("Title: "), F.coalesce("title", F.lit("")), F.lit("\n" + "=" * 60 + "\n\n"))
    df.select("article_id", F.concat(F.when(F.col("title").isNotNull(), rule).otherwise(F.lit("")), F.coalesce("text", F.lit(""))).alias("content")).write.mode("append").parquet(folder)


def notify(df: DataFrame, send: Callable[[str], None] | None) -> int:
    """Hands each ``payload`` to ``send`` on the executors; without one nothing is sent. Returns the number of payloads.

    The rows are cut first, so that what makes them runs once. A task that is retried sends again what it had sent.
    """
    if send is None:
        return 0
    rows_to_send = cut(df.select("payload"))

    def deliver(rows: Iterator) -> None:
        for r in rows:
            send(r["payload"])

    rows_to_send.foreachPartition(deliver)
    return rows_to_send.count()


def raw_answers(df: DataFrame, folder: str) -> None:
    """Model answers that did not validate, as they came, beside their error."""
    df.where("error is not null").select("article_id", "error", "raw").write.mode("append").json(folder)


def summary_files(df: DataFrame, folder: str, run_at: Column) -> None:
    """Valid summaries as JSON below the folder of the run's day."""
    dated(df.where("summary is not null").select("article_id", "summary"), folder, run_at, "json")
