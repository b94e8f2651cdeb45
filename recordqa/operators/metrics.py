"""Scorecards and quality trends over the result and audit tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recordqa.functions.ids import time_bucket
from recordqa.operators.review import ALL_RUNS, failed, for_run
from recordqa.schema import CHECKS, VERDICTS


def kpi_points(results: DataFrame, run: str | None = ALL_RUNS) -> DataFrame:
    """Distinct events, distinct failed events and the clean remainder in one pass.

    Two-level grouping: each event collapses map-side first, so no row is
    duplicated as it would be by two distinct counts.
    """
    per_event = (
        for_run(results, run)
        .filter(F.col("event_id").isNotNull())
        .groupBy("event_id")
        .agg(F.max(F.when(F.col("result") == "fail", 1).otherwise(0)).alias("has_fail"))
    )
    totals = per_event.agg(
        F.count("*").alias("total_points"),
        F.coalesce(F.sum("has_fail"), F.lit(0)).alias("failed_points"),
    )
    clean = F.greatest(F.col("total_points") - F.col("failed_points"), F.lit(0))
    return totals.withColumn("clean_points", clean.cast("bigint"))


def kpi_calls(audit: DataFrame, run: str | None = ALL_RUNS) -> DataFrame:
    """Calls, total cost and mean latency of check calls; empty sums read 0."""
    latency = F.avg(F.when(F.col("stage") == "quality_check", F.col("latency_ms")))
    return for_run(audit, run).agg(
        F.count("*").alias("calls"),
        F.coalesce(F.sum("cost_usd"), F.lit(0.0)).alias("total_cost"),
        F.coalesce(latency, F.lit(0.0)).alias("avg_latency_ms"),
    )


def trend(results: DataFrame, granularity: str = "hour", run: str | None = ALL_RUNS) -> DataFrame:
    """Result counts per (bucket, check, verdict)."""
    return (
        for_run(results, run)
        .filter(F.col("created_at").isNotNull())
        .groupBy(time_bucket(F.col("created_at"), granularity).alias("bucket"), "check_name", "result")
        .agg(F.count("*").alias("cnt"))
        .orderBy("bucket", "check_name", "result")
    )


def trend_wide(trend_rows: DataFrame, checks=CHECKS, verdicts=VERDICTS) -> DataFrame:
    """``check__verdict`` columns per bucket, 0 where empty; rows without a verdict drop out.

    The pivot list is the closed vocabulary, so the schema does not move with the data.
    """
    names = [f"{c}__{v}" for c in checks for v in verdicts]
    key = F.concat_ws("__", "check_name", "result")
    return (
        trend_rows.filter(F.col("result").isNotNull())
        .withColumn("_key", key)
        .groupBy("bucket")
        .pivot("_key", names)
        .agg(F.sum("cnt"))
        .fillna(0, subset=names)
        .orderBy("bucket")
    )


def trend_rollup(results: DataFrame, run: str | None = ALL_RUNS) -> DataFrame:
    """Result counts of every level in one pass: ``level, bucket, check_name, result, cnt``.

    Levels: ``hour`` and ``day`` per (bucket, check, verdict), ``check`` and ``verdict`` over time, ``total``. Rows
    are counted by hour, check and verdict in each task; only those counts are grouped again.
    """
    dated = for_run(results, run).filter(F.col("created_at").isNotNull())
    hours = dated.groupBy(
        time_bucket(F.col("created_at"), "hour").alias("_hour"), time_bucket(F.col("created_at"), "day").alias("_day"), "check_name", "result"
    ).agg(F.count("*").alias("_n"))
    sets = [
        [F.col("_hour"), F.col("check_name"), F.col("result")],
        [F.col("_day"), F.col("check_name"), F.col("result")],
        [F.col("check_name")],
        [F.col("result")],
        [],
    ]
    gone = lambda c: F.grouping(c) == 1
    level = (
        F.when(~gone("_hour"), "hour").when(~gone("_day"), "day").when(~gone("check_name"), "check").when(~gone("result"), "verdict").otherwise("total")
    )
    grouped = hours.groupingSets(sets, "_hour", "_day", "check_name", "result").agg(level.alias("level"), F.sum("_n").alias("cnt"))
    return grouped.select("level", F.coalesce("_hour", "_day").alias("bucket"), "check_name", "result", "cnt")


def run_ids(results: DataFrame) -> DataFrame:
    """Distinct run ids, newest first."""
    return results.select("run_id").filter(F.col("run_id").isNotNull()).distinct().orderBy(F.desc("run_id"))


def latest_run_id(results: DataFrame, ignore_legacy: bool = False):
    """Highest run id of the table as a scalar subquery column."""
    rows = results
    if ignore_legacy:
        rows = rows.filter(~F.col("run_id").startswith("legacy_"))
    return rows.agg(F.max("run_id").alias("run_id")).scalar()


def failures_by_check(
    results: DataFrame, run: str | None = ALL_RUNS, ignore_legacy: bool = False
) -> DataFrame:
    """Failures per check of ``run``; with ``ALL`` the latest run is taken."""
    if run in (None, ALL_RUNS):
        rows = results.filter(F.col("run_id") == latest_run_id(results, ignore_legacy))
    else:
        rows = for_run(results, run)
    counts = failed(rows).groupBy("check_name").agg(F.count("*").alias("cnt"))
    return counts.orderBy(F.desc("cnt"), "check_name")


def failures_total(by_check: DataFrame) -> DataFrame:
    return by_check.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("total_failures"))
