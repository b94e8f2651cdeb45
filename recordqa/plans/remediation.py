"""The remediation stage: failed results -> requests -> judge -> recommendations and audit."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from recordqa.functions.ids import new_run_id
from recordqa.functions.variants import printed, spliced
from recordqa.operators.batching import batch_ids, first_rows
from recordqa.operators.judging import (
    Judge,
    chat_request,
    judge as apply_judge,
    metrics_struct,
    printed_request,
    with_call_metrics,
)
from recordqa.operators.remediation import (
    attach_remediations,
    failed_checks,
    is_broken,
    unpack_remediations,
)
from recordqa.session import free, pin, stage_table
from recordqa.sources.lines import LINE_ORDER

# fixed values of the audit contract
PROMPT_VERSION = "v1"
FALLBACK_NOTE = "chunked_fallback"


class RemediationRun(NamedTuple):
    run_id: str
    remediations: DataFrame
    audit: DataFrame


def run_remediation(
    results: DataFrame,
    prompt: str,
    judge: Judge | None = None,
    factory: Callable[[], Judge] | None = None,
    model: str = "gpt-4o-mini",
    max_rows_per_check: int | None = None,
    chunk: int = 10,
    run_id: str | None = None,
    order: tuple[str, ...] | None = None,
    mode: str = "failfast",
    fallback_chunk: int | None = None,
    runs: Sequence[str] | None = None,
    as_text: bool = False,
) -> RemediationRun:
    """One recommendation per failed row of ``results``; ``prompt`` is the system text.

    All runs found in ``results`` are covered, or those named in ``runs``.

    Rows are in the order they were written: by creation time, then run, then line; other orders
    are named by ``order``.

    Requests are fixed chunks per check, so no request grows with the table.
    Answers are looked up by (check, event): the last one wins and serves every
    failed row of that event.

    The rows of a call whose response is no JSON are asked again in requests of ``fallback_chunk`` rows, if that is
    given; the audit holds both calls, the later ones with a note. What is no JSON after that raises (``failfast``) or gives
    its rows the default recommendation and sets ``is_invalid`` in the audit (``quarantine``).

    ``as_text``: as in ``run_checks``.
    """
    if mode not in ("failfast", "quarantine"):
        raise ValueError("mode must be 'failfast' or 'quarantine'")
    if fallback_chunk is not None and fallback_chunk <= 0:
        raise ValueError("fallback chunk must be positive")
    if max_rows_per_check is not None and max_rows_per_check <= 0:
        raise ValueError("max_rows_per_check must be positive")
    run_id = run_id or new_run_id()
    results = pin(results)  # before any filter, which would have lines parsed again
    if runs is not None:
        results = results.filter(F.col("run_id").isin(*runs))
    if order is None:
        results, order = in_written_order(results)
    rows = failed_checks(results).select("check_name", *order, "event_id", "source_record", "llm_check", "_pin")
    if as_text:
        rows = rows.withColumn("source_record", printed(F.col("source_record")))
    if max_rows_per_check is not None:
        rows = first_rows(rows, max_rows_per_check, order, ("check_name",))
    # Parsed once, numbered once; requests, shares and the output all read the numbered copy.
    failed = stage_table(rows, "failed")
    rows = stage_table(batch_ids(failed.drop("_pin"), chunk, order, ("check_name",)), "remediation-rows")
    free(failed)

    # The audit of a call is written from the call itself; what the rows need goes by batch.
    requests = _requests(rows, prompt, model, run_id, as_text=as_text)
    calls = stage_table(apply_judge(requests, judge, factory), "remediation-judged").withColumn("note", F.lit(None).cast("string"))
    answered = calls
    if fallback_chunk is not None:
        broken = stage_table(calls.filter(is_broken(calls)).select("check_name", "batch_id"), "remediation-broken")
        # batches keep their order: the parts of batch b are numbered after it and before batch b + 1
        parts = -(-chunk // fallback_chunk) + 1
        part = 1 + F.floor((F.col("pos") % chunk) / fallback_chunk)
        moved = rows.join(broken.withColumn("_again", F.lit(True)), ["check_name", "batch_id"], "left").withColumn(
            "batch_id", F.col("batch_id") * parts + F.when(F.col("_again"), part).otherwise(0)
        )
        rows = stage_table(moved, "remediation-parts")
        again = _requests(rows.filter("_again").drop("_again"), prompt, model, run_id, "again", as_text=as_text)
        again = stage_table(apply_judge(again, judge, factory), "remediation-judged").withColumn("note", F.lit(FALLBACK_NOTE))
        rows = rows.drop("_again")
        first = calls.withColumn("batch_id", F.col("batch_id") * parts)
        answered = first.filter(~is_broken(first)).unionByName(again)
        calls = first.unionByName(again)
    answers = unpack_remediations(answered, mode=mode)
    answered = with_call_metrics(answered)
    last_batch = (
        rows.filter(F.col("event_id").isNotNull())
        .groupBy("check_name", "event_id")
        .agg(F.max("batch_id").alias("batch_id"))
    )
    shares = last_batch.join(
        answered.select("check_name", "batch_id", metrics_struct(F.col("n_rows")).alias("llm_metrics")),
        ["check_name", "batch_id"],
    ).drop("batch_id")
    out = attach_remediations(rows, answers).join(shares, ["check_name", "event_id"], "left")
    remediations = out.select(
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("created_at"),
        "check_name",
        F.lit(model).alias("model"),
        "pos",
        "event_id",
        "source_record",
        F.col("llm_check").alias("failed_check"),
        "remediation",
        "llm_metrics",
    )
    return RemediationRun(run_id, remediations, remediation_audit(with_call_metrics(calls), as_text))


def _requests(rows: DataFrame, prompt: str, model: str, run_id: str, *tag: str, as_text: bool = False) -> DataFrame:
    """One request per (check, batch) of numbered failed rows; ``as_text`` says that records are printed already."""
    # VARIANT cannot be sorted, so members travel as text and are set into the request as they are.
    member = F.struct("pos", "event_id", "source_record", F.to_json("llm_check").alias("failed_check"))
    name = [F.lit(run_id), F.lit("remediation"), F.col("check_name"), *[F.lit(t) for t in tag], F.col("batch_id").cast("string")]
    record = lambda m: m["source_record"] if as_text else printed(m["source_record"], strict=False)
    item = lambda m: spliced([m["event_id"].alias("event_id")], {"source_record": record(m), "failed_check": m["failed_check"]})
    listed = F.concat(F.lit("["), F.array_join(F.transform("members", item), ","), F.lit("]"))
    body = spliced(["check_name"], {"failed_records": listed})
    grouped = rows.groupBy("check_name", "batch_id").agg(F.array_sort(F.collect_list(member)).alias("members"))
    return grouped.select(
        F.concat_ws("/", *name).alias("call_id"),
        "check_name",
        "batch_id",
        F.size("members").cast("bigint").alias("n_rows"),
        F.lit(model).alias("model_spec"),
        F.lit(model).alias("model"),
        F.lit("openai").alias("provider"),
        chat_request(F.lit(prompt), F.lit(model), body).alias("request"),
    )


def in_written_order(results: DataFrame) -> tuple[DataFrame, tuple[str, ...]]:
    """Results with the columns that tell when a line was written, and their names in order.

    Part files of later runs may sort before those of earlier ones by name.
    """
    at = F.coalesce(F.try_to_timestamp("created_at"), F.timestamp_seconds(F.lit(0)))
    return results.withColumns({"written_at": at, "written_by": F.coalesce("run_id", F.lit(""))}), ("written_at", "written_by", *LINE_ORDER)


def remediation_audit(calls: DataFrame, as_text: bool = False) -> DataFrame:
    """Audit rows of remediation calls; the contract gives them no run id and no provider.

    ``note`` names calls that repeat a broken one in smaller parts, ``is_invalid`` the broken ones. With ``as_text`` the
    request is JSON text, keys by name, and no VARIANT.
    """
    total = F.size(
        F.coalesce(
            F.try_variant_get(
                F.try_parse_json(
                    F.try_variant_get(F.try_parse_json("response"), "$.choices[0].message.content", "string")
                ),
                "$.results",
                "array<variant>",
            ),
            F.array().cast("array<variant>"),
        )
    ).cast("bigint")
    return calls.select(
        F.lit("remediation").alias("stage"),
        "check_name",
        "model",
        F.lit(PROMPT_VERSION).alias("prompt_version"),
        "latency_ms",
        "usage",
        "cost_usd",
        F.struct(total.alias("total_results")).alias("decision"),
        (printed_request(F.col("request")) if as_text else F.parse_json("request")).alias("request"),
        F.try_parse_json("response").alias("response"),
        "note",
        is_broken(calls).alias("is_invalid"),
    )
