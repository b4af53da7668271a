"""Items as a stream: the first of each address, against what earlier runs accepted."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.functions import url
from sheafline.operators import items


def first_seen(stream: DataFrame, time: str, late: str = "1 day") -> DataFrame:
    """Items of a stream without repetitions within the watermark. ``time`` may lack a zone; it is read as UTC."""
    keyed = stream.withColumn(time, F.col(time).cast("timestamp")).withColumn("article_key", url.article_key(F.col("url"))).where("article_key is not null")
    return keyed.withWatermark(time, late).dropDuplicatesWithinWatermark(["article_key"])


def counts(stream: DataFrame, time: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Items per source and window."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return timed.groupBy(F.window(time, window).alias("w"), "source").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "source", "n")


def accept(spark: SparkSession, stream: DataFrame, seen_folder: str, out_folder: str, checkpoint: str) -> None:
    """Runs over what is available: new keys are appended to ``seen_folder``, their rows to ``out_folder``, batch by batch.

    A batch that is repeated after a failure writes to the same place again, so nothing is accepted twice.
    """

    def step(batch: DataFrame, number: int) -> None:
        keyed = batch.withColumn("article_key", url.article_key(F.col("url"))).where("article_key is not null")
        try:
            before = spark.read.parquet(seen_folder).where(F.col("batch") != number).select("id")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            before = spark.createDataFrame([], "id string")  # nothing accepted yet
        new = items.first_by(items.unseen(keyed, before, "article_key"), F.col("article_key"), "seq").persist()
        new.write.mode("overwrite").parquet(f"{out_folder}/batch={number}")
        new.select(F.col("article_key").alias("id")).write.mode("overwrite").parquet(f"{seen_folder}/batch={number}")
        new.unpersist()

    q = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
