"""Queries that write through every sink or stream into the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordqa.operators import drift, judging, loading, review
from recordqa.operators.triage import triage
from recordqa.session import shared_dir
from recordqa.sinks import files
from recordqa.sources.lines import (
    parse_records,
    parse_results,
    read_all_checks,
    read_all_remediations,
    read_audit,
    read_jsonl_lines,
    read_lines_or_empty,
)
from recordqa.sources.warehouse import Warehouse
from recordqa.streaming.trend import trend_stream, write_trend
from recordqa.streaming.triage import resume_stream, triage_stream
from workload.review_queries import ORACLE as REVIEW
from workload.views import audit_view, labels_view, nested_lines, read, results_view, with_views


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/recordqa/round-trips/{name}-{uuid.uuid4().hex}"


def _envelopes(spark, sf) -> DataFrame:
    """Results of events as the check stage would write them."""
    rows = results_view(spark, sf)
    said = F.struct("event_id", "result", "confidence", F.concat(F.lit("r"), "id").alias("reason"))
    return rows.select(
        "check_name", "run_id", "prompt_version", F.lit("f.txt").alias("prompt_file"), F.col("created_at").cast("timestamp").alias("created_at"),
        F.concat(F.lit('{"n":'), F.col("id").cast("string"), F.lit("}")).alias("source_record"),
        F.parse_json(F.to_json(said)).alias("llm_check"), F.lit("m").alias("model"),
        F.struct(F.lit(1.5).alias("call_latency_ms")).alias("llm_metrics"),
    )


def lines_round_trip(spark, sf):
    base = _folder(spark, "lines")
    value = F.concat(F.lit('  {"id":'), F.col("doc_id").cast("string"), F.lit(',"h":"'), F.md5("text"), F.lit('"} '))
    files.write_lines(read(spark, sf, "documents").select(value.alias("value")), f"{base}/records.jsonl")
    return read_jsonl_lines(spark, base).select("value")


def results_round_trip(spark, sf):
    """Two appends, read by check."""
    base = _folder(spark, "results")
    rows = _envelopes(spark, sf)
    for part in (rows.filter("run_id < 'R05'"), rows.filter("run_id >= 'R05'")):
        files.write_results(part, base)
    out = judging.verdict_columns(read_all_checks(spark, base))
    stamp = F.date_format(F.try_to_timestamp("created_at"), "yyyy-MM-dd HH:mm:ss")
    return out.select("check_name", "run_id", "event_id", "result", "confidence", "reason", stamp.alias("created_at"))


def remediations_round_trip(spark, sf):
    """The second write replaces the checks it holds and leaves the others."""
    base = _folder(spark, "remediations")
    rows = _envelopes(spark, sf).select(
        "run_id", "created_at", "check_name", "model", F.lit(0).alias("pos"), F.lit("x").alias("event_id"), "source_record",
        F.col("llm_check").alias("failed_check"), F.parse_json(F.lit('{"decision":"no_change"}')).alias("remediation"), "llm_metrics",
    )
    files.write_remediations(rows, base)
    files.write_remediations(rows.filter("check_name = 'entity_resolution' and run_id = 'R00'"), base)
    got = loading.to_remediation_rows(read_all_remediations(spark, base))
    return got.select("run_id", "check_name", "event_id", F.get_json_object("remediation_json", "$.decision").alias("decision"))


def audit_round_trip(spark, sf):
    path = _folder(spark, "audit")
    rows = audit_view(spark, sf).select(
        "stage", "run_id", "model", "provider", "latency_ms", F.struct("prompt_tokens", "completion_tokens").alias("usage"),
        F.struct(F.col("call_id").alias("n")).alias("request"),
    )
    files.append_audit(rows, path)
    got = loading.to_audit_rows(read_audit(spark, path))
    return got.select(
        "stage", "run_id", "model", "provider", "latency_ms",
        F.get_json_object("request_json", "$.n").cast("bigint").alias("call_id"),
        F.get_json_object("usage_json", "$.prompt_tokens").cast("bigint").alias("prompt_tokens"),
    )


def triage_sinks(spark, sf):
    base = _folder(spark, "triage")
    files.write_triage(triage(parse_records(nested_lines(spark, sf))), "run", f"{base}/log", f"{base}/escalated", f"{base}/dead")
    return _triaged(spark, f"{base}/log", f"{base}/escalated", f"{base}/dead")


def _triaged(spark, log: str, escalated: str, dead: str) -> DataFrame:
    event = F.get_json_object("value", "$.data[0].id")
    logged = spark.read.json(log).select(F.concat(F.lit("log:"), "decision").alias("sink"), "event_id")
    passed = read_lines_or_empty(spark, escalated).select(F.lit("escalated").alias("sink"), event.alias("event_id"))
    failed = spark.read.json(dead).select(F.lit("dead").alias("sink"), F.expr("source_record.data[0].id").alias("event_id"))
    return logged.unionByName(passed).unionByName(failed).groupBy("sink", F.coalesce("event_id", F.lit("")).alias("event_id")).count()


def triage_stream_runs(spark, sf):
    """Two runs of one stream into one folder; both stay."""
    base = _folder(spark, "stream")
    lines = nested_lines(spark, sf)
    for run, part in (("r1", lines.filter("line_id % 3 = 0")), ("r2", lines.filter("line_id % 3 <> 0"))):
        files.write_lines(part, f"{base}/in-{run}")
        query = triage_stream(spark, f"{base}/in-{run}", f"{base}/out", f"{base}/state-{run}", run, pattern="*")
        query.awaitTermination()
    out = f"{base}/out"
    nested = f"{out}/escalated/*/*"
    return _triaged(spark, f"{out}/log", nested, f"{out}/dead_letter")


def trend_stream_buckets(spark, sf):
    """Buckets the watermark has closed, from files as they arrive."""
    base = _folder(spark, "trend")
    rows = results_view(spark, sf).withColumn("created_at", F.col("created_at").cast("timestamp"))
    rows.select("created_at", "check_name", "result").write.parquet(f"{base}/in")
    stream = spark.readStream.schema("created_at timestamp, check_name string, result string").parquet(f"{base}/in")
    write_trend(trend_stream(stream, "day", "1 hour"), f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out")


def resume_stream_ids(spark, sf):
    """Events of run R00 are done before the stream starts."""
    base = _folder(spark, "resume")
    rows = results_view(spark, sf).select("event_id", "run_id").distinct()
    rows.filter("run_id = 'R00'").select("event_id").distinct().write.parquet(f"{base}/done")
    rows.filter("run_id <> 'R00'").select("event_id").distinct().write.parquet(f"{base}/in")
    done = lambda: spark.read.schema("event_id string").parquet(f"{base}/done")
    resume_stream(
        spark.readStream.schema("event_id string").parquet(f"{base}/in"),
        done,
        lambda batch, _: batch.write.mode("append").parquet(f"{base}/done"),
        f"{base}/state",
    ).awaitTermination()
    return done().groupBy("event_id").count()


def drift_report_document(spark, sf):
    path = _folder(spark, "drift")
    rows = results_view(spark, sf)
    report = files.drift_report(drift.drift_summary(rows), drift.drift_examples(drift.compare_runs(rows)))
    files.write_drift_report(report, path)
    checks = F.from_json(
        "value", "checks MAP<STRING, STRUCT<base_rows BIGINT, candidate_rows BIGINT, common_rows BIGINT, decision_changed_count BIGINT>>"
    )["checks"]
    entries = spark.read.text(path, wholetext=True).select(F.explode(checks).alias("check_name", "e"))
    return entries.select("check_name", "e.*")


def review_export(spark, sf):
    base = _folder(spark, "export")
    labels = labels_view(spark, sf)
    files.export_reviews(
        review.labelled_set(labels, results_view(spark, sf)), review.export_totals(labels), review.export_breakdown(labels), base
    )
    doc = F.from_json(
        "value", "total_reviews BIGINT, overrides BIGINT, approve_fail BIGINT, "
        "breakdown_by_check_and_label ARRAY<STRUCT<check_name STRING, human_label STRING, count BIGINT>>",
    )
    summary = spark.read.text(f"{base}/results", wholetext=True).select(doc.alias("d")).select("d.*")
    counted = summary.select("total_reviews", "overrides", "approve_fail", F.explode("breakdown_by_check_and_label").alias("b"))
    return counted.select("total_reviews", "overrides", "approve_fail", "b.check_name", "b.human_label", F.col("b.count").alias("cnt"))


def warehouse_load(spark, sf):
    """Load, label every third failure, reload the same runs: rows stay, labels still match, records are one per event."""
    house = Warehouse(spark, _folder(spark, "warehouse"))
    house.init()
    base = _folder(spark, "warehouse-results")
    files.write_results(_envelopes(spark, sf), base)
    house.load_quality(read_all_checks(spark, base))
    third = F.substring("reason", 2, 20).cast("bigint") % 3 == 0
    picked = house.table("llm_quality_results").filter("result = 'fail'").filter(third)
    house.label(picked.select(F.col("id").alias("quality_result_id"), "event_id", "check_name", F.lit("override_pass").alias("human_label"), F.lit("me").alias("reviewer")))
    house.load_quality(read_all_checks(spark, base), replace_runs=True)
    labels = house.table("human_review_labels").select(F.col("quality_result_id").alias("id"), F.lit(1).alias("labelled"))
    rows = house.table("llm_quality_results").join(labels, "id", "left")
    per_check = rows.groupBy("check_name").agg(F.count("*").alias("n"), F.count("labelled").alias("n_labelled"))
    return per_check.withColumn("n_events", F.lit(house.table("records").count()).cast("bigint"))


QUERIES = {
    f.__name__: f
    for f in (
        lines_round_trip, results_round_trip, remediations_round_trip, audit_round_trip, triage_sinks, triage_stream_runs,
        trend_stream_buckets, resume_stream_ids, drift_report_document, review_export, warehouse_load,
    )
}

_TRIAGED = """
bad as (select event_id, (event_id = '' or coalesce(category, '') = '' or article_sentence = '') b from rec),
sinks as (select case when b then 'log:fail' else 'log:escalate' end sink, event_id from bad
  union all select case when b then 'dead' else 'escalated' end, event_id from bad)"""
_TRIAGE_SQL = with_views("", "rec").rstrip() + "," + _TRIAGED + '\nselect sink, event_id, count(*) "count" from sinks group by 1, 2'

ORACLE = {
    "lines_round_trip": """select concat('{"id":', doc_id, ',"h":"', md5(text), '"}') "value" from documents""",
    "results_round_trip": with_views(
        "select check_name, run_id, event_id, result, confidence, concat('r', id) reason, "
        "strftime(created_at, '%Y-%m-%d %H:%M:%S') created_at from qr", "qr"),
    "remediations_round_trip": with_views(
        "select run_id, check_name, event_id, 'no_change' decision from qr where check_name <> 'entity_resolution' or run_id = 'R00'", "qr"),
    "audit_round_trip": with_views(
        "select stage, coalesce(run_id, concat('legacy_', coalesce(stage, 'unknown'))) run_id, model, provider, latency_ms, "
        "call_id, prompt_tokens from au", "au"),
    "triage_sinks": _TRIAGE_SQL,
    "triage_stream_runs": _TRIAGE_SQL,
    "trend_stream_buckets": with_views(
        "select strftime(created_at, '%Y-%m-%d') bucket, check_name, result, count(*) cnt from qr where created_at is not null and "
        "date_trunc('day', created_at) + interval 1 day <= (select max(created_at) from qr) - interval 1 hour group by 1, 2, 3", "qr"),
    "resume_stream_ids": with_views('select event_id, CAST(1 AS BIGINT) "count" from qr where event_id is not null group by 1', "qr"),
    "drift_report_document": f"select check_name, base_rows, candidate_rows, common_rows, decision_changed_count from ({REVIEW['drift_summary']})",
    "review_export": with_views(
        "select (select count(*) from hr) total_reviews, (select count(*) from hr where human_label = 'override_pass') overrides, "
        "(select count(*) from hr where human_label = 'approve_fail') approve_fail, check_name, human_label, count(*) cnt "
        "from hr group by check_name, human_label", "hr"),
    "warehouse_load": with_views(
        "select check_name, count(*) n, count(*) filter (result = 'fail' and id % 3 = 0) n_labelled, "
        "(select count(distinct event_id) from qr) n_events from qr where event_id is not null group by 1", "qr"),
}
