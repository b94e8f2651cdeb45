"""Identifiers: run ids, prompt versions, model specs, time buckets."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

from recordqa.functions.text import has_text
from recordqa.schema import PROVIDERS

RUN_ID_PATTERN = "yyyyMMdd'T'HHmmss'Z'"


def new_run_id(now: datetime | None = None) -> str:
    """Sortable UTC run id for a run that starts now."""
    return (now or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def run_id_at(ts: Column) -> Column:
    """Run id of a timestamp column; the session time zone must be UTC."""
    return F.date_format(ts, RUN_ID_PATTERN)


def normalise_run_id(run_id: Column, fallback: Column) -> Column:
    """Keep a run id that holds text, else ``legacy_<fallback>``."""
    return F.when(has_text(run_id), run_id).otherwise(F.concat(F.lit("legacy_"), fallback))


def audit_fallback(stage: Column) -> Column:
    return F.coalesce(F.nullif(stage, F.lit("")), F.lit("unknown"))


def prompt_version(file_name: Column) -> Column:
    """Last ``_`` part of the file stem when it starts with ``v``, else ``v1``."""
    stem = F.regexp_replace(file_name, r"(?<=.)\.[^.]*$", "")
    tail = F.element_at(F.split(stem, "_"), -1)
    return F.when(tail.startswith("v"), tail).otherwise(F.lit("v1"))


def version_number(version: Column) -> Column:
    """Number behind the leading ``v``; anything unreadable is 0."""
    return F.coalesce(F.regexp_replace(version, "^v+", "").try_cast("int"), F.lit(0))


def model_spec(spec: Column, strict: bool = True) -> Column:
    """Struct ``(provider, model)`` of a spec column.

    ``strict`` raises on an invalid spec; otherwise the struct is null there.
    """
    has_provider = F.instr(spec, ":") > 0
    parts = F.split(spec, ":", 2)
    provider = F.when(has_provider, F.lower(F.trim(F.get(parts, F.lit(0))))).otherwise(F.lit(PROVIDERS[0]))
    model = F.when(has_provider, F.trim(F.get(parts, F.lit(1)))).otherwise(F.trim(spec))
    parsed = F.struct(provider.alias("provider"), model.alias("model"))
    valid = provider.isin(*PROVIDERS) & (model != "")
    if not strict:
        return F.when(valid, parsed)
    problem = F.raise_error(F.concat(F.lit("invalid model spec: "), F.coalesce(spec, F.lit("null"))))
    return F.when(valid, parsed).otherwise(problem.cast("struct<provider:string,model:string>"))


def time_bucket(ts: Column, granularity: str) -> Column:
    """Bucket label: ``yyyy-MM-dd HH:00`` for hours, ``yyyy-MM-dd`` for days."""
    if granularity == "hour":
        return F.date_format(ts, "yyyy-MM-dd HH:00")
    if granularity == "day":
        return F.date_format(ts, "yyyy-MM-dd")
    raise ValueError(f"granularity must be 'hour' or 'day', got {granularity!r}")
