"""Failed records: what went wrong with which item, as lines of JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.schemas import FAILED


def records(df: DataFrame, error: str, at: Column) -> DataFrame:
    """``item`` (address, source, title, time as ISO text), ``error`` and ``failed_at`` of rows with an error."""
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    item = F.struct("url", "source", "title", (iso(F.col("published")) if dict(df.dtypes).get("published", "").startswith("timestamp") else F.col("published").cast("string")).alias("published"))
    return df.where(F.col(error).isNotNull()).select(item.alias("item"), F.col(error).alias("error"), iso(at).alias("failed_at"))


def append(failed: DataFrame, folder: str) -> None:
    failed.write.mode("append").json(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Records of a queue; lines that are no JSON are skipped, a missing folder is empty."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(FAILED).option("mode", "DROPMALFORMED").json(folder)
    except AnalysisException:
        return spark.createDataFrame([], FAILED)


def clear(spark: SparkSession, folder: str) -> None:
    spark.createDataFrame([], FAILED).write.mode("overwrite").json(folder)


def tally(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
