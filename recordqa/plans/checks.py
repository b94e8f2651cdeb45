"""The check stage: records -> requests -> judge -> results and call audit."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from recordqa.functions.ids import new_run_id
from recordqa.functions.variants import printed, string_at
from recordqa.operators.cost import routing_table
from recordqa.operators.judging import (
    Judge,
    ResponseStore,
    answers_array,
    build_requests,
    enrich,
    finish_answer,
    grouped_records,
    judge as apply_judge,
    judge_in_waves,
    metrics_struct,
    one_response,
    printed_request,
    wave_of,
    with_call_metrics,
    with_given,
)
from recordqa.schema import CHECKS
from recordqa.session import stage_table
from recordqa.sources.lines import LINE_ORDER
from recordqa.sources.prompts import latest_prompts


class CheckRun(NamedTuple):
    run_id: str
    results: DataFrame
    audit: DataFrame
    responses: DataFrame


def run_checks(
    records: DataFrame,
    prompts: DataFrame,
    judge: Judge | None = None,
    factory: Callable[[], Judge] | None = None,
    responses: DataFrame | None = None,
    routing: dict[str, str] | None = None,
    run_id: str | None = None,
    batch_size: int = 10,
    max_body_chars: int = 0,
    order: tuple[str, ...] = LINE_ORDER,
    from_scan: bool = False,
    mode: str = "failfast",
    with_duplicates: bool = False,
    duplicate_threshold: float = 1.0,
    store: str | None = None,
    waves: int = 8,
    as_text: bool = False,
) -> CheckRun:
    """Judge every eligible record with every check.

    ``records`` comes from ``parse_records``; ``prompts`` from ``prompt_registry``.
    Stored ``responses`` (``call_id, response, latency_ms``) of an earlier attempt of the same run
    are used first; a judge is called for the calls they lack. Without a judge such calls have no
    response, and their rows get the default verdict. A call that is stored more than once counts once
    (``one_response``). ``from_scan``: see ``record_batches``. Responses are staged before the two outputs
    branch, so no call is made twice. With ``store``, a folder of this run, they are committed there in
    ``waves``: when the job is lost and started again with the same run id, only calls of waves that were not
    committed are made.

    A response without a results array raises (``failfast``), or with ``mode="quarantine"`` gives its
    rows the default verdict and sets ``is_invalid`` in the audit. A check without a prompt raises.
    ``with_duplicates`` fills the dedupe context of the source check, with near copies too if
    ``duplicate_threshold`` is below 1.

    ``as_text``: source records and, in the audit, requests are the JSON text that the file sinks print, which these then take
    as it is (``ready``); a record is parsed and printed once, not once per check.
    """
    if mode not in ("failfast", "quarantine"):
        raise ValueError("mode must be 'failfast' or 'quarantine'")
    if judge is None and factory is None and responses is None:
        raise ValueError("give a judge, a factory or stored responses")
    run_id = run_id or new_run_id()
    latest = latest_prompts(prompts)
    _require_prompts(latest)
    if as_text:
        records = records.withColumn("value", printed(F.col("value")))
    grouped, texts = grouped_records(records, batch_size, order, from_scan, with_duplicates, duplicate_threshold)
    # what of a batch's rows the results need goes with its calls, as text through the judge
    rows = F.to_json(F.transform("members", lambda m: F.struct(m["pos"].alias("pos"), m["row_id"].alias("row_id"), m["event_id"].alias("event_id"))))
    batches = grouped.withColumns({"_rows": rows, "n_rows": F.size("members").cast("bigint")})
    asks = judge is not None or factory is not None
    waved = ResponseStore(records.sparkSession, store) if asks and store is not None else None
    if waved is not None:
        batches = stage_table(batches.withColumn("_wave", wave_of(waves)), "batches", by="_wave")  # each wave reads its own
    elif asks and responses is not None:
        batches = stage_table(batches, "batches")  # read more than once
    stored = None if responses is None else stage_table(one_response(responses), "stored-responses")

    def requests(known: DataFrame | None, by_name: bool = False) -> DataFrame:
        given = batches.withColumn("_given", F.lit(None)) if known is None else with_given(batches, known, run_id)
        built = build_requests(given, latest, routing_table(routing), run_id, max_body_chars, by_name=by_name)
        return built if known is None else built.withColumn("_given", F.try_element_at("_given", F.col("check_name")))

    def known() -> DataFrame | None:
        """Stored responses, and those of committed waves for calls that are not stored."""
        if waved is None or (committed := waved.committed()).isEmpty():
            return stored
        held = one_response(committed)
        return held if stored is None else stored.unionByName(held.join(stored, "call_id", "left_anti"))

    answered = lambda r: r.withColumns({"response": F.col("_given.response"), "latency_ms": F.col("_given.latency_ms")}).drop("_given")
    unasked = lambda r: r.filter(F.col("_given").isNull()).drop("_given")
    if not asks:
        judged = answered(requests(stored))
    elif waved is not None:
        judge_in_waves(unasked(requests(known())), waved, waves, judge, factory)
        judged = answered(requests(known()))
    elif stored is None:
        judged = apply_judge(requests(None).drop("_given"), judge, factory)
    else:
        each = requests(stored)
        judged = answered(each.filter(F.col("_given").isNotNull())).unionByName(apply_judge(unasked(each), judge, factory))
    # staged with what the response says, so that it is parsed where it arrives and nowhere else
    said = lambda each: with_call_metrics(each).withColumn("_answers", answers_array(F.col("response"), F.col("provider")))
    if waved is not None:
        # requests are asked of the batches again by the audit alone, so they are not staged
        calls = stage_table(said(judged).drop("request", "_wave"), "judged")
        audited = said(answered(requests(calls.select("call_id", "response", "latency_ms"), by_name=as_text)))
    else:
        calls = stage_table(said(judged), "judged")
        audited = calls.withColumn("request", printed_request(F.col("request"))) if as_text else calls
    responses = calls.select("call_id", "response", "latency_ms").filter(F.col("response").isNotNull())
    return CheckRun(run_id, _results(calls, texts, run_id, mode), call_audit(audited, as_text), responses)


def _require_prompts(latest: DataFrame) -> None:
    """Every check has a prompt; the driver sees names of the closed check list only."""
    found = latest.filter(F.col("base").isin(*CHECKS)).agg(F.collect_set("base")).first()[0]
    if missing := [c for c in CHECKS if c not in found]:
        raise FileNotFoundError(f"no prompt for: {', '.join(missing)}")


def _results(calls: DataFrame, texts: DataFrame, run_id: str, mode: str = "failfast") -> DataFrame:
    """One row per (check, eligible record): answers are matched inside their call, raw texts are looked up by row id."""
    parsed = calls.drop("request")
    if mode == "failfast":
        boom = F.raise_error(F.concat(F.lit("response without a results array: "), F.col("call_id")))
        bad = F.col("response").isNotNull() & F.col("_answers").isNull()
        parsed = parsed.withColumn("_answers", F.when(bad, boom.cast("array<variant>")).otherwise(F.col("_answers")))
    none = F.array().cast("array<variant>")
    parsed = parsed.withColumn("_answers", F.coalesce("_answers", none)).withColumn(
        "_pairs",
        F.transform(
            "_answers",
            lambda a: F.struct(
                string_at(a, "$.event_id").alias("id"),
                F.try_variant_get(a, "$.result", "variant").alias("result"),
            ),
        ),
    )
    members = F.from_json("_rows", "ARRAY<STRUCT<pos: BIGINT, row_id: BIGINT, event_id: STRING>>")
    rows = parsed.drop("response", "_answers").select("*", F.explode(members).alias("m")).drop("_rows")
    hits = F.filter("_pairs", lambda p: p["id"] == F.col("m.event_id"))
    answer = F.get(hits, F.size(hits) - 1)["result"]
    rows = rows.withColumn("event_id", F.col("m.event_id")).withColumn(
        "llm_check", finish_answer(answer, F.col("check_name"), F.col("event_id"), F.col("prompt_version"))
    )
    enriched = enrich(
        rows, run_id, F.col("prompt_version"), F.col("prompt_file"), F.col("model_spec"),
        metrics_struct(F.col("n_rows")),
    )
    texts = texts.withColumnRenamed("row_id", "_row")
    # calls are few and hold many rows each, which no estimate counts: their rows must not be broadcast
    return enriched.hint("merge").join(texts, F.col("m.row_id") == F.col("_row")).select(
        "run_id",
        "prompt_version",
        "prompt_file",
        "created_at",
        "check_name",
        F.col("m.pos").alias("pos"),
        "event_id",
        "source_record",
        "llm_check",
        "model",
        "llm_metrics",
    )


def call_audit(calls: DataFrame, as_text: bool = False) -> DataFrame:
    """One audit row per call; verdicts are counted on the raw answers, inside the row.

    ``is_invalid`` marks calls whose response is missing or holds no results array. With ``as_text`` the request is taken
    as the JSON text it is, keys by name, and not made a VARIANT.
    """
    if "_answers" not in calls.columns:
        calls = calls.withColumn("_answers", answers_array(F.col("response"), F.col("provider")))
    counted = calls.withColumn(
        "_verdicts", F.transform("_answers", lambda a: F.coalesce(string_at(a, "$.result.result"), F.lit("")))
    )
    count = lambda test: F.coalesce(F.size(F.filter("_verdicts", test)), F.lit(0)).cast("bigint")
    decision = F.struct(
        count(lambda v: v == "pass").alias("pass"),
        count(lambda v: v == "fail").alias("fail"),
        count(lambda v: ~v.isin("pass", "fail")).alias("other"),
    )
    return counted.select(
        F.lit("quality_check").alias("stage"),
        "run_id",
        "check_name",
        F.col("model_spec").alias("model"),
        "provider",
        "prompt_file",
        "prompt_version",
        "latency_ms",
        "usage",
        "cost_usd",
        decision.alias("decision"),
        (F.col("request") if as_text else F.parse_json("request")).alias("request"),
        F.try_parse_json("response").alias("response"),
        F.col("_answers").isNull().alias("is_invalid"),
    )
