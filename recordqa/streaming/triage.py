"""Incremental triage and incremental resume over arriving files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from recordqa.functions.text import has_text
from recordqa.functions.variants import encode_json
from recordqa.operators.judging import not_processed
from recordqa.operators.triage import triage
from recordqa.sources.lines import parse_records


def lines_stream(
    spark: SparkSession, directory: str, files_per_batch: int | None = None, pattern: str = "*.jsonl"
) -> DataFrame:
    """Non-blank lines of files as they arrive."""
    reader = spark.readStream.format("text").option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.load(directory)
        .select(F.btrim("value", F.lit(" \t\r\n\f\u000b")).alias("value"))
        .filter(has_text(F.col("value")))
    )


def _holds_files(spark: SparkSession, folder: str) -> bool:
    try:
        return bool(spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(folder).select("path").head(1))
    except AnalysisException:
        return False


def triage_stream(
    spark: SparkSession,
    directory: str,
    out_dir: str,
    checkpoint: str,
    run_id: str,
    files_per_batch: int | None = None,
    pattern: str = "*.jsonl",
) -> StreamingQuery:
    """Triage new files into ``log``, ``escalated`` and ``dead_letter`` below ``out_dir``.

    Every micro-batch writes its own ``run_id=<run>/batch=<id>`` folders in overwrite mode, so a
    batch that is replayed after a failure replaces itself, and runs do not touch each other. A run id that
    has output but no checkpoint here is refused: its batches would start anew and replace it. Runs until the files
    present at the start are done, then stops.
    """
    base, own = out_dir.rstrip("/"), f"run_id={run_id}"
    if _holds_files(spark, f"{base}/triaged/{own}") and not _holds_files(spark, f"{checkpoint.rstrip('/')}/offsets"):
        raise ValueError(f"run {run_id!r} already has output under another checkpoint")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = triage(parse_records(batch)).select(
            F.lit(run_id).alias("run_id"), F.current_timestamp().alias("created_at"), "event_id", "decision", "reason", "value"
        )
        # One pass: the sink splits rows by decision; log columns and lines sit side by side.
        rows.write.mode("overwrite").partitionBy("decision").parquet(f"{base}/triaged/{own}/batch={batch_id}")
        stored = rows.sparkSession.read.schema(rows.schema).parquet(f"{base}/triaged/{own}/batch={batch_id}")
        stored.drop("value").write.mode("overwrite").json(f"{base}/log/{own}/batch={batch_id}")
        stored.filter("decision = 'escalate'").select("value").write.mode("overwrite").text(
            f"{base}/escalated/{own}/batch={batch_id}"
        )
        dead = F.struct("run_id", "created_at", "event_id", "reason", F.parse_json("value").alias("source_record"))
        stored.filter("decision = 'fail'").select(encode_json(dead).alias("value")).write.mode("overwrite").text(
            f"{base}/dead_letter/{own}/batch={batch_id}"
        )

    return (
        lines_stream(spark, directory, files_per_batch, pattern)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def first_sightings(rows: DataFrame, time_col: str = "created_at", delay: str = "1 day") -> DataFrame:
    """Streaming resume: an event id passes once per watermark window, whatever the batch."""
    return rows.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["event_id"])


def resume_stateful(rows: DataFrame, out_dir: str, checkpoint: str, ttl: str = "30 days") -> StreamingQuery:
    """Appends rows whose event id was not seen in the last ``ttl`` to ``out_dir``, over any number of starts.

    What was seen is the query's own state, which the checkpoint carries from start to start and which is as
    large as the ids of one ``ttl``; the history is never read. Time is that of arrival, so no row is late. Of rows with one
    id in a batch any may pass; rows without an id are left out. Output is exactly once (file sink with a commit log).
    """
    arrived = rows.filter(F.col("event_id").isNotNull()).withColumn("arrived_at", F.current_timestamp())
    return (
        first_sightings(arrived, "arrived_at", ttl)
        .writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def resume_stream(
    rows: DataFrame,
    done: Callable[[], DataFrame],
    process: Callable[[DataFrame, int], None],
    checkpoint: str,
) -> StreamingQuery:
    """Hand each micro-batch to ``process`` without the event ids ``done()`` already holds."""

    def step(batch: DataFrame, batch_id: int) -> None:
        process(not_processed(batch, done()), batch_id)

    return (
        rows.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
