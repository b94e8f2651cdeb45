"""Streams must end where the batch operators end."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from recordqa.operators.metrics import trend
from recordqa.operators.triage import triage
from recordqa.sources.lines import parse_records, read_jsonl_lines
from recordqa.streaming.trend import trend_stream, write_trend
from recordqa.streaming.triage import first_sightings, lines_stream, resume_stream, triage_stream


def put(folder, name, ids):
    folder.mkdir(exist_ok=True)
    with (folder / name).open("w") as out:
        for i in ids:
            attrs = {"category": "c", "article_sentence": "" if i % 4 == 0 else "s"}
            out.write(json.dumps({"data": [{"id": f"e{i}", "attributes": attrs}]}) + "\n")


def test_triage_stream_equals_batch_and_picks_up_new_files(spark, tmp_path):
    source, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    put(source, "a.jsonl", range(10))
    put(source, "b.jsonl", range(10, 15))
    triage_stream(spark, str(source), out, ckpt, "r", files_per_batch=1).awaitTermination()
    put(source, "c.jsonl", range(15, 20))
    triage_stream(spark, str(source), out, ckpt, "r").awaitTermination()
    batch = triage(parse_records(read_jsonl_lines(spark, str(source))))
    assert rows(spark.read.json(f"{out}/log"), "event_id", "decision") == rows(batch, "event_id", "decision")
    assert spark.read.text(f"{out}/escalated").count() == 15
    dead = spark.read.json(f"{out}/dead_letter")
    assert dead.count() == 5 and dead.select("source_record.data").first() is not None


def test_a_second_triage_run_leaves_the_first_alone(spark, tmp_path):
    out = str(tmp_path / "out")
    for run, ids in (("r1", range(5)), ("r2", range(5, 8))):
        put(tmp_path / run, "a.jsonl", ids)
        triage_stream(spark, str(tmp_path / run), out, str(tmp_path / f"c-{run}"), run).awaitTermination()
    assert spark.read.json(f"{out}/log").count() == 8
    with pytest.raises(ValueError, match="another checkpoint"):
        triage_stream(spark, str(tmp_path / "r1"), out, str(tmp_path / "c-new"), "r1")


def test_resume_stream_skips_processed_ids(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "a.jsonl", range(6))
    done_path, ckpt = str(tmp_path / "done"), str(tmp_path / "ckpt")
    spark.createDataFrame([("e1",), ("e2",)], "event_id string").write.json(done_path)
    events = lines_stream(spark, str(source)).select(F.get_json_object("value", "$.data[0].id").alias("event_id"))
    resume_stream(
        events,
        lambda: spark.read.schema("event_id string").json(done_path),
        lambda df, _: df.write.mode("append").json(done_path),
        ckpt,
    ).awaitTermination()
    assert rows(spark.read.json(done_path)) == [(f"e{i}",) for i in range(6)]


def results_files(spark, tmp_path):
    df = spark.range(200).select(
        F.timestamp_seconds(F.col("id") * 600).alias("created_at"),
        F.lit("semantic_accuracy").alias("check_name"),
        F.when(F.col("id") % 3 == 0, "fail").otherwise("pass").alias("result"),
        F.concat(F.lit("e"), F.col("id") % 20).alias("event_id"),
    )
    path = str(tmp_path / "results")
    df.write.parquet(path)
    return df, spark.readStream.schema(df.schema).parquet(path)


def test_trend_stream_equals_batch_for_finished_buckets(spark, tmp_path):
    df, stream = results_files(spark, tmp_path)
    out = str(tmp_path / "trend")
    write_trend(trend_stream(stream, "hour", "10 minutes"), out, str(tmp_path / "c")).awaitTermination()
    got = rows(spark.read.parquet(out), "bucket", "check_name", "result", "cnt")
    want = rows(trend(df, "hour"), "bucket", "check_name", "result", "cnt")
    last = max(b for b, *_ in want)
    assert got == [r for r in want if r[0] < last]


def test_first_sightings(spark, tmp_path):
    _, stream = results_files(spark, tmp_path)
    query = (
        first_sightings(stream, delay="30 days").writeStream.format("parquet").option("path", str(tmp_path / "o"))
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 20
