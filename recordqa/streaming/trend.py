"""Streaming quality trend over tumbling windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from recordqa.functions.ids import time_bucket


def trend_stream(results: DataFrame, granularity: str = "hour", delay: str = "1 hour") -> DataFrame:
    """Counts per (bucket, check, verdict) of a result stream; a bucket is final once the
    watermark has passed its end. State is bounded by open buckets times checks times verdicts."""
    width = {"hour": "1 hour", "day": "1 day"}[granularity]
    return (
        results.filter(F.col("created_at").isNotNull())
        .withWatermark("created_at", delay)
        .groupBy(F.window("created_at", width), "check_name", "result")
        .agg(F.count("*").alias("cnt"))
        .select(time_bucket(F.col("window.start"), granularity).alias("bucket"), "check_name", "result", "cnt")
    )


def write_trend(trend: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished buckets as Parquet until the available input is used up."""
    return (
        trend.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
