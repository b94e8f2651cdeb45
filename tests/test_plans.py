"""The plans behind the operators: what is pushed, joined, limited and never collected."""

import re

import pytest
from pyspark.sql import functions as F

from recordqa.operators import drift, metrics, near_stories, profile, review
from recordqa.operators.loading import to_quality_rows
from recordqa.operators.sampling import sample_records
from recordqa.plans.checks import call_audit
from recordqa.sources.lines import parse_results
from workload.views import labels_view, read, results_view


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def qr(spark, sf_dir):
    return results_view(spark, sf_dir)


def test_backlog_is_an_anti_join_with_top_k(spark, sf_dir, qr):
    text = plan(review.backlog(qr, labels_view(spark, sf_dir)))
    assert "LeftAnti" in text and "TakeOrderedAndProject" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_last_per_event_limits_ranks_before_the_shuffle(qr):
    text = plan(drift.last_per_event(drift.has_run_key(qr)))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_drift_joins_no_events(qr):
    """Only the run list and the per-check results meet in joins."""
    for options in ({}, {"null_mode": "null_changed", "dedupe": False}):
        text = plan(drift.drift_summary(qr, **options))
        assert "SortMergeJoin" not in text and "CartesianProduct" not in text


def test_kpi_points_does_not_expand_rows(qr):
    assert "Expand" not in plan(metrics.kpi_points(qr))


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    rows = read(spark, sf_dir, "events").filter("event_type = 'view'")
    text = plan(rows.groupBy("user_id").count())
    assert "EqualTo(event_type,view)" in text and "ReadSchema: struct<user_id:bigint,event_type:string>" in text


def test_scorecard_reads_no_wide_columns(spark, sf_dir, qr):
    text = plan(metrics.trend(qr.withColumn("source_record_json", F.lit("x"))))
    assert "source_record_json" not in optimized(metrics.trend(qr)) and "ReadSchema" in text


def test_sample_reads_the_rows_once_after_it_has_drawn(spark, sf_dir):
    text = plan(sample_records(read(spark, sf_dir, "documents"), 10, seed=1, key=("doc_id",)))
    assert text.count("FileScan") == 2 and "sample-taken" in text and "CartesianProduct" not in text


def test_quality_rows_parse_each_line_once(spark):
    lines = spark.createDataFrame([("{}", "semantic_accuracy", "f", 0, 0)], "value string, check_name string, file_name string, block_start bigint, line_id bigint")
    text = optimized(to_quality_rows(parse_results(lines)).select("event_id", "result", "confidence"))
    assert text.count("from_json") + text.count("jsontostructs") == 1


def test_call_audit_joins_nothing(spark):
    calls = spark.createDataFrame(
        [], "call_id string, run_id string, check_name string, model_spec string, provider string, prompt_file string, "
        "prompt_version string, latency_ms double, usage string, cost_usd double, request string, response string",
    )
    text = plan(call_audit(calls))
    assert "Join" not in text and "Exchange" not in text


def test_profiles_aggregate_partially(spark, sf_dir):
    text = plan(profile.null_profile(read(spark, sf_dir, "documents")))
    assert "partial_count" in text and text.count("Exchange SinglePartition") == 1
    unique = plan(profile.uniqueness_profile(read(spark, sf_dir, "documents")))
    assert "partial_count" in unique


def test_library_has_no_driver_side_row_loops():
    import pathlib

    root = pathlib.Path(__file__).parent.parent / "recordqa"
    banned = re.compile(r"\.collect\(\)|\.toPandas\(|\.toLocalIterator\(|\.crossJoin\(|localCheckpoint|\.rdd\b|\budf\(")
    hits = [(p.name, m.group()) for p in root.rglob("*.py") if "llm" not in p.parts for m in [banned.search(p.read_text())] if m]
    assert hits == []


def test_a_story_is_split_once_for_all_its_shingles(spark):
    words = [f"w{n}" for n in range(9)]
    df = spark.createDataFrame([(" ".join(words),), ("one two",), (None,)], "t string").select(near_stories.shingles(F.col("t")).alias("h"))
    assert optimized(df).count("split(") == 1  # and not again inside the function over its words
    runs = [" ".join(words[i : i + 5]) for i in range(5)]
    want = [r.h for r in spark.createDataFrame([(r,) for r in runs], "r string").select(F.xxhash64("r").alias("h")).collect()]
    assert df.first().h == want and [len(r.h) for r in df.collect()] == [5, 1, 1]
