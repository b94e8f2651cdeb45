"""Rows of the warehouse tables, and the two keyed upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recordqa.functions.ids import audit_fallback, normalise_run_id
from recordqa.functions.variants import is_object, let, number_at, string_at


def _text_or(value: Column, default: str) -> Column:
    """JSON text of a raw open part; absent parts read as ``default``."""
    return F.coalesce(value, F.lit(default))


def _row_id(*parts: str | Column) -> Column:
    """Surrogate id from what a row says, so that a reload gives the same ids and labels keep their rows.

    No shuffle and no counter; rows that agree in all parts share an id.
    """
    return F.xxhash64(*[F.col(p) if isinstance(p, str) else p for p in parts])


def _created(col: str = "created_at") -> Column:
    return F.try_to_timestamp(F.col(col))


def to_quality_rows(results: DataFrame) -> DataFrame:
    """Warehouse rows of check results as read by ``read_all_checks``.

    Rows whose verdict holds no text event id are skipped. The check name is the
    one of the file, whatever the verdict calls itself. Confidence is lenient:
    the column is REAL, so numeric text converts.

    What a verdict says is taken once, into a generated row: a filter is not pushed below a
    generator, so no parse is repeated, whatever columns the caller reads.
    """
    check = F.col("llm_check")
    said = F.struct(
        string_at(check, "$.event_id").alias("event_id"),
        F.try_variant_get(check, "$.result", "string").alias("result"),
        number_at(check, "$.confidence", strict=False).alias("confidence"),
        F.try_variant_get(check, "$.reason", "string").alias("reason"),
        F.to_json(check).alias("llm_check_json"),
    )
    kept = ("created_at", "prompt_version", "prompt_file", "model", "llm_metrics", "source_record", "check_name", "run_id")
    rows = results.select(*kept, F.explode_outer(F.array(said)).alias("_v")).filter(F.col("_v.event_id").isNotNull())
    run = normalise_run_id(F.col("run_id"), F.col("check_name"))
    return rows.select(
        _row_id(run, "check_name", "_v.event_id", "created_at", "_v.llm_check_json").alias("id"),
        _created().alias("created_at"),
        "prompt_version",
        "prompt_file",
        "model",
        "_v.event_id",
        "_v.result",
        "_v.confidence",
        "_v.reason",
        "_v.llm_check_json",
        _text_or(F.col("llm_metrics"), "null").alias("llm_metrics_json"),
        _text_or(F.col("source_record"), "{}").alias("source_record_json"),
        "check_name",
        run.alias("run_id"),
    )


def to_remediation_rows(remediations: DataFrame) -> DataFrame:
    """Warehouse rows of remediations; a missing event id stays null."""
    failed = F.when(is_object(F.col("failed_check")), F.col("failed_check"))
    run = normalise_run_id(F.col("run_id"), F.col("check_name"))
    return remediations.select(
        _row_id(run, "check_name", "created_at", F.to_json("failed_check"), "remediation").alias("id"),
        run.alias("run_id"),
        _created().alias("created_at"),
        "check_name",
        "model",
        string_at(F.col("failed_check"), "$.event_id").alias("event_id"),
        _text_or(F.to_json(failed), "{}").alias("failed_check_json"),
        _text_or(F.col("remediation"), "null").alias("remediation_json"),
        _text_or(F.col("llm_metrics"), "null").alias("llm_metrics_json"),
        _text_or(F.col("source_record"), "{}").alias("source_record_json"),
    )


def to_audit_rows(audit: DataFrame) -> DataFrame:
    """Warehouse rows of call audits; rows without a run id load as ``legacy_<stage>``."""
    return audit.select(
        _row_id("run_id", "stage", "check_name", "model", "request", "response").alias("id"),
        F.current_timestamp().alias("created_at"),
        "stage",
        normalise_run_id(F.col("run_id"), audit_fallback(F.col("stage"))).alias("run_id"),
        "check_name",
        "model",
        "provider",
        "prompt_file",
        "prompt_version",
        F.col("latency_ms").cast("double").alias("latency_ms"),
        F.col("cost_usd").cast("double").alias("cost_usd"),
        *[_text_or(F.col(c), "null").alias(f"{c}_json") for c in ("usage", "decision", "request", "response")],
    )


def upsert_records(records: DataFrame, incoming: DataFrame, order: tuple[str, ...] = ("seen_at",)) -> DataFrame:
    """One row per event: first sighting kept, last sighting and JSON refreshed.

    ``incoming`` has ``event_id, source_record_json, seen_at`` and the ``order``
    columns that say which JSON is the latest; any incoming row beats a stored one. ``records`` holds an
    event once. Ranks combine map-side, so an event seen without bound is one narrow row per task, and only the
    winner's JSON is carried on.
    """
    key = F.struct(*order)
    known = incoming.filter(F.col("event_id").isNotNull())
    # the latest row of an event is found without its JSON, which is then read once, for the winners
    winners = known.groupBy("event_id").agg(
        F.max(key).alias("_at"), F.min("seen_at").alias("_first"), F.max("seen_at").alias("_last")
    )
    texts = known.select("event_id", key.alias("_at"), "source_record_json")
    same = texts.join(winners, ["event_id", "_at"]).groupBy("event_id")  # rows of equal rank: the greatest text
    latest = same.agg(F.max("source_record_json").alias("_json"), F.min("_first").alias("_first"), F.min("_last").alias("_last"))
    both = records.select("event_id", "source_record_json", "first_seen_at", "last_seen_at").join(latest, "event_id", "full_outer")
    return both.select(
        "event_id",
        F.when(F.col("_last").isNull(), F.col("source_record_json")).otherwise(F.col("_json")).alias("source_record_json"),
        F.least("first_seen_at", "_first").alias("first_seen_at"),
        F.greatest("last_seen_at", "_last").alias("last_seen_at"),
    )
