"""Streaming forms of row-local and first-wins operators (an extension: the batch pipeline has no streams)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sarqyt.session import ensure_checkpoint_dir


def first_events(stream: DataFrame, key: str, time: str, delay: str = "10 minutes") -> DataFrame:
    """First row per key as far as the watermark reaches back; state is bounded by it."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, time: str, by: str, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    return stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), by, "n")


def run_available(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there, into a table in the shared checkpoint folder, and returns that table."""
    spark: SparkSession = stream.sparkSession
    ensure_checkpoint_dir(spark)
    base = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stream-{uuid.uuid4().hex}"
    q = stream.writeStream.format("parquet").outputMode(mode).option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")
