"""Queries over the judge and remediation stages, loading and output contracts.

Judges are rule-based stand-ins: they answer from the request text alone, so the
SQL twins can state the answers directly from the tables.
"""

from __future__ import annotations

import json
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from recordqa.functions.ids import audit_fallback, model_spec as spec_column, normalise_run_id, run_id_at
from recordqa.operators import batching, contract, cost, judging, loading, remediation
from recordqa.plans.checks import run_checks
from recordqa.plans.remediation import run_remediation
from recordqa.schema import CHECKS
from recordqa.sources.lines import (
    parse_audit,
    parse_json_lines,
    parse_records,
    parse_remediations,
    parse_results,
)
from workload.views import audit_view, flat_records, nested_lines, read, results_view, with_views

# The judges travel to the workers by value, so they need no path there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# ---- stand-in judges ------------------------------------------------------
def _inputs(request: str):
    return json.loads(json.loads(request)["messages"][-1]["content"].split("INPUT:\n", 1)[1])


def _body(provider: str, results: list, usage: dict) -> str:
    text = json.dumps({"results": results}, ensure_ascii=False)
    if provider == "anthropic":
        half = len(text) // 2
        parts = [{"type": "text", "text": text[:half]}, {"type": "note"}, {"type": "text", "text": text[half:]}]
        return json.dumps({"content": parts, "usage": usage}, ensure_ascii=False)
    return json.dumps({"choices": [{"message": {"content": text}}], "usage": usage}, ensure_ascii=False)


def length_judge(requests: pd.DataFrame) -> pd.DataFrame:
    """Verdict by summary length; every seventh length gets no answer."""
    bodies = []
    for request, spec in zip(requests["request"], requests["model_spec"]):
        inputs = _inputs(request)
        results = [
            {"event_id": i["event_id"], "result": {"result": "fail" if len(i["event_summary"]) % 3 == 0 else "pass",
                                                   "confidence": len(i["event_summary"]) % 100 / 100, "reason": "by length"}}
            for i in inputs
            if len(i["event_summary"]) % 7
        ]
        n = sum(len(i["event_summary"]) for i in inputs)
        bodies.append(_body(spec.split(":")[0], results, {"prompt_tokens": n, "completion_tokens": 10 * len(results)}))
    return pd.DataFrame({"call_id": requests["call_id"], "response": bodies, "latency_ms": 600.0})


def fix_judge(requests: pd.DataFrame) -> pd.DataFrame:
    """Remediation by the row number in the failed check; every ninth row gets no answer."""
    decisions = ("correct_label", "correct_entity_link", "mark_low_credibility", "no_change")
    bodies = []
    for request in requests["request"]:
        rows = [(r["event_id"], int(r["failed_check"]["reason"])) for r in _inputs(request)["failed_records"]]
        results = [
            {"event_id": e, "decision": decisions[i % 4], "proposed_patch": None, "reasoning": "by row",
             "confidence": i % 100 / 100, "evidence_spans": [], "review_recommended": True}
            for e, i in rows if i % 9
        ]
        bodies.append(_body("openai", results, {"prompt_tokens": 1000, "completion_tokens": 100 * len(rows)}))
    return pd.DataFrame({"call_id": requests["call_id"], "response": bodies, "latency_ms": 900.0})


def _prompts(spark) -> DataFrame:
    return spark.createDataFrame(
        [(c, f"v{n}", n, f"{c}_v{n}.txt", f"Rules of {c}, version {n}.") for c in CHECKS for n in (1, 2)],
        "base string, version string, version_num int, file string, text string",
    )


ROUTING = {"entity_resolution": "anthropic:model-a", "source_credibility": "gpt-4o"}


# ---- judge stage ----------------------------------------------------------
def requests(spark, sf):
    """Request rows; inputs are read back to show that each holds its whole batch in order."""
    batches = judging.record_batches(parse_records(nested_lines(spark, sf)), 10)
    rows = judging.build_requests(batches, _prompts(spark).filter("version_num = 2"), cost.routing_table(ROUTING), "run")
    turns = F.from_json("request", "messages ARRAY<STRUCT<role STRING, content STRING>>")["messages"]
    inputs = F.from_json(
        F.split_part(F.element_at(turns, -1)["content"], F.lit("INPUT:\n"), F.lit(2)),
        "ARRAY<STRUCT<event_id STRING, source_body STRING>>",
    )
    return rows.select(
        "call_id", "check_name", "n_rows", "prompt_version", "prompt_file", "model_spec",
        F.array_join(F.transform(inputs, lambda i: i["event_id"]), ",").alias("event_ids"),
        F.aggregate(inputs, F.lit(0), lambda a, i: a + F.coalesce(F.length(i["source_body"]), F.lit(0))).cast("bigint").alias("body_chars"),
    )


def _run(spark, sf):
    return run_checks(parse_records(nested_lines(spark, sf)), _prompts(spark), length_judge, routing=ROUTING, run_id="run")


def check_results(spark, sf):
    rows = judging.verdict_columns(_run(spark, sf).results)
    metrics = F.col("llm_metrics")
    return rows.select(
        "check_name", "event_id", "pos", "result", "confidence", "reason", "prompt_version", "prompt_file", "model",
        F.try_variant_get("llm_check", "$.check_version", "string").alias("check_version"),
        F.try_variant_get(F.parse_json("source_record"), "$.data[0].id", "string").alias("record_id"),
        F.round(metrics["estimated_latency_ms_per_row"], 6).alias("latency_per_row"),
        F.round(metrics["estimated_cost_usd_per_row"], 9).alias("cost_per_row"),
    )


def check_audit(spark, sf):
    return _run(spark, sf).audit.select(
        "check_name", "model", "provider", "prompt_version", "latency_ms",
        F.round("cost_usd", 9).alias("cost_usd"),
        F.try_variant_get("usage", "$.prompt_tokens", "bigint").alias("prompt_tokens"),
        F.col("decision.pass").alias("n_pass"), F.col("decision.fail").alias("n_fail"), F.col("decision.other").alias("n_other"),
    )


def check_resume(spark, sf):
    """Half of the responses are stored, the judge is asked for the rest."""
    first = _run(spark, sf).responses
    records, prompts = parse_records(nested_lines(spark, sf)), _prompts(spark)
    half = first.filter(F.crc32(F.col("call_id").cast("binary")) % 2 == 0)
    again = run_checks(records, prompts, length_judge, responses=half, routing=ROUTING, run_id="run")
    return judging.verdict_columns(again.results).select("check_name", "event_id", "pos", "result", "confidence", "reason")


def check_invalid_answers(spark, sf):
    """Responses of every 13th batch are broken: default verdicts, and a mark in the audit."""
    batch = F.split_part("call_id", F.lit("/"), F.lit(3)).cast("int")
    broken = _run(spark, sf).responses.withColumn("response", F.when(batch % 13 == 0, F.lit("{no json")).otherwise(F.col("response")))
    run = run_checks(
        parse_records(nested_lines(spark, sf)), _prompts(spark), responses=broken, routing=ROUTING, run_id="run", mode="quarantine"
    )
    verdicts = judging.verdict_columns(run.results).groupBy("check_name", "result", "reason").agg(F.count("*").alias("n"))
    marked = run.audit.groupBy("check_name").agg(F.count_if("is_invalid").alias("n_invalid"))
    return verdicts.join(marked, "check_name")


def batch_ids(spark, sf):
    out = batching.batch_ids(results_view(spark, sf), 10, ("id",), ("run_id", "check_name"))
    return out.select("id", "run_id", "check_name", "pos", "batch_id")


def cap_failures(spark, sf):
    failed = results_view(spark, sf).filter("result = 'fail'")
    return batching.first_rows(failed, 50, ("id",), ("check_name",)).select("id", "check_name")


def cap_failures_large(spark, sf):
    """A cap above the ranked-window threshold, by positions."""
    failed = results_view(spark, sf).filter("result = 'fail'")
    return batching.first_rows(failed, 1200, ("id",), ("check_name",)).select("id", "check_name")


def _stored(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Judge responses for batches of ten results, in chat or block shape by batch parity.

    Rows without a verdict get no answer; every tenth batch repeats its first
    answered event at the end, with the verdict ``pass``.
    """
    rows = batching.batch_ids(results_view(spark, sf), 10, ("id",), ("run_id", "check_name")).withColumn(
        "call_id", F.concat_ws("/", "run_id", "check_name", F.col("batch_id").cast("string"))
    )
    verdict = lambda r, c: F.struct(r.alias("result"), c.alias("confidence"))
    answer = F.when(
        F.col("result").isNotNull(),
        F.struct("pos", "event_id", verdict(F.col("result"), F.col("confidence")).alias("result")),
    )
    answers = rows.groupBy("call_id", "batch_id").agg(F.array_sort(F.collect_list(answer)).alias("a"))
    again = F.transform(
        F.slice("a", 1, 1),
        lambda x: F.struct(x["pos"].alias("pos"), x["event_id"].alias("event_id"), verdict(F.lit("pass"), F.lit(0.5)).alias("result")),
    )
    listed = F.when(F.col("batch_id") % 10 == 0, F.concat("a", again)).otherwise(F.col("a"))
    text = F.to_json(
        F.struct(F.transform(listed, lambda x: F.struct(x["event_id"].alias("event_id"), x["result"].alias("result"))).alias("results"))
    )
    chat = F.to_json(F.struct(F.array(F.struct(F.struct(text.alias("content")).alias("message"))).alias("choices")))
    part = lambda t: F.struct(F.lit("text").alias("type"), t.alias("text"))
    cut = F.floor(F.length(text) / 2).cast("int")
    blocks = F.to_json(
        F.struct(
            F.array(
                part(F.substr(text, F.lit(1), cut)),
                F.struct(F.lit("note").alias("type"), F.lit("-").alias("text")),
                part(F.substr(text, cut + 1)),
            ).alias("content")
        )
    )
    even = F.col("batch_id") % 2 == 0
    responses = answers.select(
        "call_id",
        F.when(even, "openai").otherwise("anthropic").alias("provider"),
        F.when(even, chat).otherwise(blocks).alias("response"),
    )
    return rows, responses


def _flat_answers(answers: DataFrame) -> DataFrame:
    return answers.select(
        "call_id", "position", "event_id",
        F.try_variant_get("result", "$.result", "string").alias("result"),
        F.try_variant_get("result", "$.confidence", "double").alias("confidence"),
    )


def unpack_chat(spark, sf):
    responses = _stored(spark, sf)[1].filter("provider = 'openai'")
    return _flat_answers(judging.unpack(responses, "openai"))


def unpack_blocks(spark, sf):
    responses = _stored(spark, sf)[1].filter("provider = 'anthropic'")
    return _flat_answers(judging.unpack(responses, "anthropic"))


def last_answer(spark, sf):
    answers = judging.unpack(_stored(spark, sf)[1], F.col("provider"))
    return _flat_answers(judging.last_answer(answers))


def attach_answers(spark, sf):
    rows, responses = _stored(spark, sf)
    out = judging.attach_answers(
        rows.select("id", "call_id", "check_name", "event_id", "prompt_version"), judging.unpack(responses, F.col("provider"))
    )
    return judging.verdict_columns(out).select(
        "id", "event_id", "result", "confidence",
        F.try_variant_get("llm_check", "$.check_version", "string").alias("check_version"),
        F.try_variant_get("llm_check", "$.check_name", "string").alias("own_check"),
    )


def decision_summary(spark, sf):
    return judging.decision_summary(judging.unpack(_stored(spark, sf)[1], F.col("provider")))


def resume(spark, sf):
    rows = results_view(spark, sf)
    done = rows.filter("run_id = 'R00' AND check_name = 'source_credibility'")
    return judging.not_processed(rows, done).select("id", "event_id")


def processed_ids(spark, sf):
    return judging.processed_ids(results_view(spark, sf))


# ---- cost and routing -----------------------------------------------------
def call_cost(spark, sf):
    return cost.with_cost(audit_view(spark, sf)).select("call_id", F.round("cost_usd", 9).alias("cost_usd"))


def cost_attribution(spark, sf):
    """Each conversation is a call; its turns share latency and cost."""
    turns = cost.with_cost(audit_view(spark, sf)).withColumn("turn_id", F.col("call_id")).withColumn(
        "call_id", F.floor(F.col("turn_id") / 1000)
    )
    calls = turns.groupBy("call_id").agg(F.sum("latency_ms").alias("latency_ms"), F.sum("cost_usd").alias("cost_usd"))
    out = cost.attribute_call(calls, turns.select("turn_id", "call_id"))
    return out.withColumns({c: F.round(c, 12) for c in ("latency_ms_per_row", "cost_usd_per_row")})


def routing(spark, sf):
    return cost.with_routing(results_view(spark, sf), cost.routing_table(ROUTING)).select("id", "model_spec", "provider", "model")


def model_spec(spark, sf):
    kind = F.col("call_id") % 5
    spec = (
        F.when(kind == 0, F.concat(F.lit("OpenAI: "), "model", F.lit(" ")))
        .when(kind == 1, F.col("model"))
        .when(kind == 2, F.concat(F.lit("anthropic:"), "model"))
        .when(kind == 3, F.concat(F.lit("foo:"), "model"))
        .otherwise(F.lit("openai:"))
    )
    return audit_view(spark, sf).withColumn("spec", spec_column(spec, strict=False)).select("call_id", "spec.provider", "spec.model")


def legacy_run_id(spark, sf):
    return audit_view(spark, sf).select(
        "call_id", normalise_run_id(F.col("run_id"), audit_fallback(F.col("stage"))).alias("run_id")
    )


def run_id_of_time(spark, sf):
    return results_view(spark, sf).select("id", run_id_at(F.col("created_at").cast("timestamp")).alias("run_id"))


# ---- loading --------------------------------------------------------------
def _result_lines(spark, sf) -> DataFrame:
    """Result lines with blank runs, textual confidence, missing ids and foreign check names."""
    i = F.col("id")
    conf = F.when(i % 6 == 0, F.concat(F.lit('"'), F.col("confidence").cast("string"), F.lit('"'))).otherwise(
        F.col("confidence").cast("string")
    )
    quoted = lambda c: F.coalesce(F.concat(F.lit('"'), c, F.lit('"')), F.lit("null"))
    event = F.when(i % 8 == 0, F.lit("null")).when(i % 8 == 1, F.lit("17")).otherwise(quoted(F.col("event_id")))
    run = F.when(i % 5 == 0, F.lit("null")).when(i % 5 == 1, F.lit('"  "')).otherwise(quoted(F.col("run_id")))
    value = F.concat(
        F.lit('{"run_id":'), run, F.lit(',"prompt_version":"'), F.col("prompt_version"),
        F.lit('","created_at":"'), F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"),
        F.lit('","source_record":{"data":[{"id":'), event, F.lit('}],"n":'), i.cast("string"), F.lit('},"model":"m","llm_metrics":null,'),
        F.lit('"llm_check":{"check_name":"own_name","event_id":'), event, F.lit(',"result":'), quoted(F.col("result")),
        F.lit(',"confidence":'), F.coalesce(conf, F.lit("null")), F.lit(',"reason":"r'), i.cast("string"), F.lit('"}}'),
    )
    return results_view(spark, sf).select(
        value.alias("value"), F.lit("f.jsonl").alias("file_name"), F.lit(0).cast("bigint").alias("block_start"),
        i.alias("line_id"), "check_name",
    )


def quality_rows(spark, sf):
    out = loading.to_quality_rows(parse_results(_result_lines(spark, sf)))
    return out.select(
        "run_id", "check_name", "prompt_version", "event_id", "result", "confidence", "reason",
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"), "llm_metrics_json", "source_record_json",
    )


def strict_confidence(spark, sf):
    """The file path of T6: text is not a number."""
    rows = judging.verdict_columns(parse_results(_result_lines(spark, sf)))
    return rows.select("line_id", "event_id", "confidence")


def remediation_rows(spark, sf):
    lines = _result_lines(spark, sf).withColumn("value", F.replace("value", F.lit('"llm_check":'), F.lit('"failed_check":')))
    out = loading.to_remediation_rows(parse_remediations(lines))
    return out.select("run_id", "check_name", "event_id", "remediation_json", "source_record_json")


def audit_rows(spark, sf):
    fields = F.struct(
        "stage", "run_id", "model", "provider", "latency_ms",
        F.struct("prompt_tokens", "completion_tokens").alias("usage"), F.struct(F.col("call_id").alias("n")).alias("request"),
    )
    lines = audit_view(spark, sf).select(F.to_json(fields).alias("value"))
    out = loading.to_audit_rows(parse_audit(lines))
    return out.select(
        "stage", "run_id", "model", "provider", "latency_ms", "decision_json",
        F.get_json_object("usage_json", "$.prompt_tokens").cast("bigint").alias("prompt_tokens"),
        F.get_json_object("request_json", "$.n").cast("bigint").alias("call_id"),
    )


def upsert_records(spark, sf):
    """Runs R00-R04 are stored first, R05-R09 arrive later."""
    rows = results_view(spark, sf).withColumns(
        {"source_record_json": F.concat(F.lit('{"n":'), F.col("id").cast("string"), F.lit("}")), "seen_at": F.col("created_at")}
    )
    empty = rows.limit(0).select("event_id", "source_record_json", F.col("seen_at").alias("first_seen_at"), F.col("seen_at").alias("last_seen_at"))
    old = loading.upsert_records(empty, rows.filter("run_id < 'R05'"), ("seen_at", "id"))
    out = loading.upsert_records(old, rows.filter("run_id >= 'R05'"), ("seen_at", "id"))
    stamp = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return out.withColumns({c: F.date_format(c, stamp) for c in ("first_seen_at", "last_seen_at")})


def quarantine(spark, sf):
    """Every 13th line is cut short; malformed lines are kept and flagged."""
    v = F.when(F.col("line_id") % 13 == 0, F.left("value", F.length("value") - 1)).otherwise(F.col("value"))
    lines = nested_lines(spark, sf).withColumn("value", v)
    out = parse_json_lines(lines, "data ARRAY<STRUCT<id STRING>>", "quarantine")
    return out.select("line_id", "is_malformed")


# ---- remediation ----------------------------------------------------------
def _failing(spark, sf) -> DataFrame:
    check = F.struct("event_id", "result", "confidence", F.col("id").cast("string").alias("reason"))
    record = F.concat(F.lit('{"data":[{"id":"'), F.col("event_id"), F.lit('"}]}'))
    return results_view(spark, sf).select(
        "check_name", "id", record.alias("source_record"), F.to_variant_object(check).alias("llm_check")
    )


def remediations(spark, sf):
    run = run_remediation(_failing(spark, sf), "Fix what failed.", fix_judge, run_id="fix", order=("id",))
    item, metrics = F.col("remediation"), F.col("llm_metrics")
    return run.remediations.select(
        "check_name", "event_id", "pos",
        F.try_variant_get("failed_check", "$.reason", "bigint").alias("id"),
        F.try_variant_get(item, "$.decision", "string").alias("decision"),
        F.try_variant_get(item, "$.confidence", "double").alias("confidence"),
        F.round(metrics["estimated_cost_usd_per_row"], 9).alias("cost_per_row"),
    )


def remediation_audit(spark, sf):
    run = run_remediation(_failing(spark, sf), "Fix what failed.", fix_judge, run_id="fix", order=("id",))
    return run.audit.select(
        "stage", "check_name", "model", "prompt_version", "latency_ms", F.round("cost_usd", 9).alias("cost_usd"),
        F.col("decision.total_results").alias("total_results"),
    )


def route(spark, sf):
    return remediation.route(results_view(spark, sf)).select("id", "queue")


def route_remediation(spark, sf):
    decided = results_view(spark, sf).withColumn(
        "decision", F.when(F.col("id") % 4 == 3, "no_change").otherwise("correct_label")
    )
    return remediation.route_remediation(decided).select("id", "route", "effective_decision")


def remediation_violations(spark, sf):
    """Patches of the category: some stale, some of an unknown decision, some without a patch."""
    d = F.col("doc_id")
    item = F.to_variant_object(
        F.struct(
            F.when(d % 7 == 0, "rewrite").otherwise("correct_label").alias("decision"),
            F.when(
                d % 5 != 0,
                F.struct(
                    F.lit("attributes.category").alias("path"),
                    F.when(d % 3 == 0, F.lit("other")).otherwise(F.col("category")).alias("old_value"),
                    F.lit("new").alias("new_value"),
                ),
            ).alias("proposed_patch"),
            F.lit("why").alias("reasoning"),
            F.lit(0.5).alias("confidence"),
            F.array(F.struct(F.lit("t").alias("text"))).alias("evidence_spans"),
            F.lit(True).alias("review_recommended"),
        )
    )
    lines = nested_lines(spark, sf).select(F.col("line_id").alias("doc_id"), F.col("value").alias("source_record"))
    rows = flat_records(spark, sf).select("doc_id", item.alias("remediation")).join(lines, "doc_id")
    return remediation.remediation_violations(rows).select(
        "doc_id", F.array_join(F.array_sort("violations"), ",").alias("violations")
    )


# ---- contracts ------------------------------------------------------------
def _verdicts(spark, sf) -> DataFrame:
    """Judge outputs per document with rule-made faults and evidence taken from the text."""
    d = F.col("doc_id")
    check = F.when(d % 3 == 0, "semantic_accuracy").when(d % 3 == 1, "entity_resolution").otherwise("source_credibility")
    spans = F.array(
        F.struct(F.substring("body", 5, 30).alias("text"), F.lit("source_body").alias("source_field")),
        F.struct(
            F.when(d % 4 == 0, F.lit("␟ absent ␟")).otherwise(F.substring("article_sentence", 1, 10)).alias("text"),
            F.when(d % 10 == 9, "source_footer").otherwise("article_sentence").alias("source_field"),
        ),
    )
    text = lambda c: F.to_json(F.struct(c.alias("x")))
    inner = lambda c: F.substr(text(c), F.lit(6), F.length(text(c)) - 6)
    body = F.concat(
        F.lit('{"check_name":"c","check_version":"v2","event_id":"e","result":'),
        F.when(d % 11 == 0, F.lit('"maybe"')).otherwise(F.lit('"pass"')),
        F.lit(',"confidence":'),
        F.when(d % 13 == 0, F.lit("1.5")).when(d % 13 == 1, F.lit('"0.5"')).otherwise(F.lit("0.5")),
        F.when(d % 17 == 0, F.lit(',"reason_text":"x"')).otherwise(F.concat(F.lit(',"reason":'), inner(F.col("summary")))),
        F.when(check != "entity_resolution", F.concat(F.lit(',"evidence_spans":'), inner(spans))).otherwise(
            F.concat(
                F.lit(',"entity_assessments":[{"entity_id":"C1","entity_name":"n","is_plausibly_linked":true,"role_fit":'),
                F.when(d % 5 == 0, F.lit('"none"')).otherwise(F.lit('"strong"')),
                F.lit(',"evidence_spans":'), inner(spans), F.lit("}]"),
            )
        ),
        F.when(
            check == "source_credibility",
            F.concat(
                F.lit(',"quality_signals":{"is_event_bearing":true,"is_marketing_heavy":false,"is_likely_duplicate":'),
                F.when(d % 4 == 2, F.lit('"no"')).otherwise(F.lit("false")),
                F.lit(',"is_relevant_to_label":true}'),
            ),
        ).otherwise(F.lit("")),
        F.lit("}"),
    )
    return flat_records(spark, sf).select("doc_id", check.alias("check_name"), F.parse_json(body).alias("llm_check"))


def contract_violations(spark, sf):
    return contract.contract_violations(_verdicts(spark, sf)).select(
        "doc_id", F.array_join(F.array_sort("violations"), ",").alias("violations")
    )


def evidence_spans(spark, sf):
    return contract.evidence_spans(_verdicts(spark, sf))


def explode_assessments(spark, sf):
    return contract.explode_assessments(_verdicts(spark, sf).filter("check_name = 'entity_resolution'"))


def quality_signals(spark, sf):
    return contract.quality_signals(_verdicts(spark, sf).filter("check_name = 'source_credibility'"))


def ungrounded_spans(spark, sf):
    verdicts = _verdicts(spark, sf).withColumn("event_id", F.col("doc_id")).drop("doc_id")
    payload = flat_records(spark, sf).select(
        F.col("doc_id").alias("event_id"), "article_sentence", F.lit(None).cast("string").alias("source_title"),
        F.when(~F.col("no_article"), F.col("body")).alias("source_body"),
    )
    return contract.ungrounded_spans(verdicts, payload)


def reconcile(spark, sf):
    """Events of run R00 against those of R09, per check: repeats and misses show up."""
    rows = results_view(spark, sf)
    return contract.reconcile(rows.filter("run_id = 'R00'"), rows.filter("run_id = 'R09'"), ("check_name", "event_id"))


QUERIES = {
    f.__name__: f
    for f in (
        requests, check_results, check_audit, check_resume, check_invalid_answers, batch_ids, cap_failures, cap_failures_large, unpack_chat, unpack_blocks,
        last_answer, attach_answers, decision_summary, resume, processed_ids, call_cost, cost_attribution, routing,
        model_spec, legacy_run_id, run_id_of_time, quality_rows, strict_confidence, remediation_rows, audit_rows,
        upsert_records, quarantine, remediations, remediation_audit, route, route_remediation, remediation_violations,
        contract_violations, evidence_spans, explode_assessments, quality_signals, ungrounded_spans, reconcile,
    )
}

# ---- SQL twins ------------------------------------------------------------
_COST = """case when {provider} = 'openai' then
    {pin} / 1000.0::DOUBLE * case {model} when 'gpt-4o-mini' then 0.00015::DOUBLE when 'gpt-4o' then 0.005::DOUBLE
                                when 'gpt-4.1' then 0.01::DOUBLE end
  + {pout} / 1000.0::DOUBLE * case {model} when 'gpt-4o-mini' then 0.0006::DOUBLE when 'gpt-4o' then 0.015::DOUBLE
                                when 'gpt-4.1' then 0.03::DOUBLE end end"""
_AU_COST = _COST.format(provider="provider", model="model", pin="prompt_tokens", pout="completion_tokens")

_BATCHED = """
el as (select *, row_number() over (order by doc_id) - 1 pos from rec where event_id <> ''),
eb as (select *, pos // 10 batch_id, length(summary) len from el),
ck as (select unnest(['semantic_accuracy', 'entity_resolution', 'source_credibility']) check_name,
  unnest(['openai:gpt-4o-mini', 'anthropic:model-a', 'gpt-4o']) model,
  unnest(['gpt-4o-mini', 'model-a', 'gpt-4o']) model_name, unnest(['openai', 'anthropic', 'openai']) provider),
calls as (select batch_id, count(*) n_rows, CAST(sum(len) AS BIGINT) pin, 10 * count(*) filter (len % 7 <> 0) pout,
  count(*) filter (len % 7 <> 0 and len % 3 <> 0) n_pass, count(*) filter (len % 7 <> 0 and len % 3 = 0) n_fail
  from eb group by 1)"""
_CALL_COST = _COST.format(provider="provider", model="model_name", pin="pin", pout="pout")

_STORED = """
nb as (select *, row_number() over (partition by run_id, check_name order by id) - 1 pos from qr),
bt as (select *, pos // 10 batch_id, concat(run_id, '/', check_name, '/', pos // 10) call_id from nb),
an as (select call_id, batch_id, event_id, result, confidence, id,
         row_number() over (partition by call_id order by pos) - 1 position from bt where result is not null),
ans as (select call_id, batch_id, CAST(position AS INT) position, event_id, result, confidence from an
  union all select call_id, batch_id, CAST(n AS INT), event_id, 'pass', 0.5::DOUBLE from (select *, count(*) over (partition by call_id) n from an)
  where batch_id % 10 = 0 and position = 0)"""
_ANS = "select call_id, position, event_id, result, confidence from ans"
_LAST = "(select *, row_number() over (partition by call_id, event_id order by position desc) r from ans)"

_VER = """
ver as (select *, case doc_id % 3 when 0 then 'semantic_accuracy' when 1 then 'entity_resolution' else 'source_credibility' end check_name,
  substr(body, 5, 30) t1, case when doc_id % 4 = 0 then '␟ absent ␟' else left(article_sentence, 10) end t2,
  case when doc_id % 10 = 9 then 'source_footer' else 'article_sentence' end f2 from rec)"""
_SPANS = """select doc_id, check_name, 0 span_pos, t1 span_text, 'source_body' source_field, body, no_article, article_sentence from ver
  union all select doc_id, check_name, 1, t2, f2, body, no_article, article_sentence from ver"""


def _more(views: str, *ctes: str) -> str:
    return with_views("", *views.split()).rstrip() + ",\n" + ",\n".join(ctes) + "\n"


ORACLE = {
    "requests": _more("rec", _BATCHED) + """
select concat('run/', check_name, '/', batch_id) call_id, check_name, count(*) n_rows, 'v2' prompt_version,
  concat(check_name, '_v2.txt') prompt_file, model model_spec, string_agg(event_id, ',' order by pos) event_ids,
  CAST(sum(case when no_article then 0 else length(body) end) AS BIGINT) body_chars
from eb, ck group by batch_id, check_name, model""",
    "check_results": _more("rec", _BATCHED) + f"""
select check_name, event_id, pos, case when len % 7 = 0 or len % 3 = 0 then 'fail' else 'pass' end result,
  case when len % 7 = 0 then 0.0::DOUBLE else (len % 100)::DOUBLE / 100 end confidence,
  case when len % 7 = 0 then 'No valid model result returned for this row.' else 'by length' end reason,
  'v2' prompt_version, concat(check_name, '_v2.txt') prompt_file, model,
  case when len % 7 = 0 then 'v1' else 'v2' end check_version, event_id record_id,
  round(600.0::DOUBLE / n_rows, 6) latency_per_row, round({_CALL_COST} / n_rows, 9) cost_per_row
from eb join calls using (batch_id), ck""",
    "check_audit": _more("rec", _BATCHED) + f"""
select check_name, model, provider, 'v2' prompt_version, 600.0::DOUBLE latency_ms, round({_CALL_COST}, 9) cost_usd,
  pin prompt_tokens, n_pass, n_fail, CAST(0 AS BIGINT) n_other from calls, ck""",
    "check_resume": _more("rec", _BATCHED) + """
select check_name, event_id, pos, case when len % 7 = 0 or len % 3 = 0 then 'fail' else 'pass' end result,
  case when len % 7 = 0 then 0.0::DOUBLE else (len % 100)::DOUBLE / 100 end confidence,
  case when len % 7 = 0 then 'No valid model result returned for this row.' else 'by length' end reason from eb, ck""",
    "check_invalid_answers": _more("rec", _BATCHED) + """
select check_name, case when lost or len % 3 = 0 then 'fail' else 'pass' end result,
  case when lost then 'No valid model result returned for this row.' else 'by length' end reason, count(*) n,
  (select count(*) from calls where batch_id % 13 = 0) n_invalid
from (select *, batch_id % 13 = 0 or len % 7 = 0 lost from eb), ck group by 1, 2, 3""",
    "batch_ids": with_views(
        "select id, run_id, check_name, p pos, p // 10 batch_id from (select *, row_number() over "
        "(partition by run_id, check_name order by id) - 1 p from qr)", "qr"),
    "cap_failures": with_views(
        "select id, check_name from (select *, row_number() over (partition by check_name order by id) r from qr "
        "where result = 'fail') where r <= 50", "qr"),
    "cap_failures_large": with_views(
        "select id, check_name from (select *, row_number() over (partition by check_name order by id) r from qr "
        "where result = 'fail') where r <= 1200", "qr"),
    "unpack_chat": _more("qr", _STORED) + _ANS + " where batch_id % 2 = 0",
    "unpack_blocks": _more("qr", _STORED) + _ANS + " where batch_id % 2 = 1",
    "last_answer": _more("qr", _STORED) + f"select call_id, position, event_id, result, confidence from {_LAST} where r = 1",
    "attach_answers": _more("qr", _STORED) + f"""
select b.id, b.event_id, coalesce(a.result, 'fail') result, case when a.call_id is null then 0.0::DOUBLE else a.confidence end confidence,
  case when a.call_id is null then 'v1' else b.prompt_version end check_version, b.check_name own_check
from bt b left join (select * from {_LAST} where r = 1) a using (call_id, event_id)""",
    "decision_summary": _more("qr", _STORED) + "select call_id, count(*) filter (result = 'pass') \"pass\", "
        "count(*) filter (result = 'fail') fail, CAST(0 AS BIGINT) other from ans group by 1",
    "resume": with_views(
        "select id, event_id from qr where event_id not in (select event_id from qr where run_id = 'R00' and "
        "check_name = 'source_credibility')", "qr"),
    "processed_ids": with_views("select distinct event_id from qr where event_id is not null", "qr"),
    "call_cost": with_views(f"select call_id, round({_AU_COST}, 9) cost_usd from au", "au"),
    "cost_attribution": with_views(f"""
select call_id turn_id, call_id // 1000 call_id, round(sum(latency_ms) over w / count(*) over w, 12) latency_ms_per_row,
  round(sum(cost) over w / count(*) over w, 12) cost_usd_per_row
from (select *, {_AU_COST} cost from au) window w as (partition by call_id // 1000)""", "au"),
    "routing": with_views(
        "select id, case check_name when 'semantic_accuracy' then 'openai:gpt-4o-mini' when 'entity_resolution' then "
        "'anthropic:model-a' else 'gpt-4o' end model_spec, case check_name when 'entity_resolution' then 'anthropic' else "
        "'openai' end provider, case check_name when 'semantic_accuracy' then 'gpt-4o-mini' when 'entity_resolution' then "
        "'model-a' else 'gpt-4o' end model from qr", "qr"),
    "model_spec": with_views(
        "select call_id, case call_id % 5 when 0 then 'openai' when 1 then 'openai' when 2 then 'anthropic' end provider, "
        "case when call_id % 5 <= 2 then model end model from au", "au"),
    "legacy_run_id": with_views(
        "select call_id, coalesce(run_id, concat('legacy_', coalesce(stage, 'unknown'))) run_id from au", "au"),
    "run_id_of_time": with_views("select id, strftime(created_at, '%Y%m%dT%H%M%SZ') run_id from qr", "qr"),
    "quality_rows": with_views("""
select case when id % 5 <= 1 then concat('legacy_', check_name) else run_id end run_id, check_name, prompt_version, event_id,
  result, confidence, concat('r', id) reason, strftime(created_at, '%Y-%m-%d %H:%M:%S') created_at, 'null' llm_metrics_json,
  concat('{"data":[{"id":"', event_id, '"}],"n":', id, '}') source_record_json
from qr where id % 8 > 1""", "qr"),
    "strict_confidence": with_views(
        "select id line_id, case when id % 8 > 1 then event_id end event_id, case when id % 6 <> 0 then confidence end "
        "confidence from qr", "qr"),
    "remediation_rows": with_views("""
select case when id % 5 <= 1 then concat('legacy_', check_name) else run_id end run_id, check_name,
  case when id % 8 > 1 then event_id end event_id, 'null' remediation_json,
  concat('{"data":[{"id":', case id % 8 when 0 then 'null' when 1 then '17' else concat('"', event_id, '"') end, '}],"n":', id, '}') source_record_json
from qr""", "qr"),
    "audit_rows": with_views(
        "select stage, coalesce(run_id, concat('legacy_', coalesce(stage, 'unknown'))) run_id, model, provider, latency_ms, "
        "'null' decision_json, prompt_tokens, call_id from au", "au"),
    "upsert_records": with_views("""
select event_id, concat('{"n":', arg_max(id, created_at), '}') source_record_json,
  strftime(min(created_at), '%Y-%m-%d %H:%M:%S.%f') first_seen_at, strftime(max(created_at), '%Y-%m-%d %H:%M:%S.%f') last_seen_at
from qr group by 1""", "qr"),
    "quarantine": "select doc_id line_id, doc_id % 13 = 0 is_malformed from documents",
    "remediations": _more("qr", """
fl as (select *, row_number() over (partition by check_name order by id) - 1 pos from qr where result = 'fail'),
fb as (select *, pos // 10 batch_id from fl),
sz as (select check_name, batch_id, count(*) n from fb group by 1, 2),
la as (select check_name, event_id, max(id) filter (id % 9 <> 0) last_id, max(batch_id) last_batch from fb group by 1, 2)""") + """
select f.check_name, f.event_id, f.pos, f.id,
  case when last_id is null then 'no_change' else case last_id % 4 when 0 then 'correct_label' when 1 then 'correct_entity_link'
    when 2 then 'mark_low_credibility' else 'no_change' end end decision,
  case when last_id is null then 0.0::DOUBLE else (last_id % 100)::DOUBLE / 100 end confidence,
  round((1.0::DOUBLE * 0.00015::DOUBLE + 100 * n / 1000.0::DOUBLE * 0.0006::DOUBLE) / n, 9) cost_per_row
from fb f join la using (check_name, event_id) join sz s on s.check_name = f.check_name and s.batch_id = la.last_batch""",
    "remediation_audit": _more("qr", """
fl as (select *, row_number() over (partition by check_name order by id) - 1 pos from qr where result = 'fail')""") + """
select 'remediation' stage, check_name, 'gpt-4o-mini' model, 'v1' prompt_version, 900.0::DOUBLE latency_ms,
  round(1.0::DOUBLE * 0.00015::DOUBLE + 100 * count(*) / 1000.0::DOUBLE * 0.0006::DOUBLE, 9) cost_usd,
  count(*) filter (id % 9 <> 0) total_results from fl group by check_name, pos // 10""",
    "route": with_views(
        "select id, case when result = 'fail' and coalesce(confidence, 0) >= 0.9 then 'remediation' when result = 'fail' then "
        "'human_review' when result = 'pass' and coalesce(confidence, 0) < 0.7 then 'spot_check' else 'none' end queue from qr", "qr"),
    "route_remediation": with_views(
        "select id, case when id % 4 = 3 then 'escalate' when coalesce(confidence, 0) >= 0.9 then 'approval' when "
        "coalesce(confidence, 0) >= 0.7 then 'manual' else 'escalate' end route, case when id % 4 = 3 or "
        "coalesce(confidence, 0) < 0.7 then 'no_change' else 'correct_label' end effective_decision from qr", "qr"),
    "remediation_violations": with_views("""
select doc_id, concat_ws(',', case when doc_id % 5 = 0 and doc_id % 7 <> 0 then 'missing_patch' end,
  case when doc_id % 5 <> 0 and doc_id % 3 = 0 then 'stale_old_value' end,
  case when doc_id % 7 = 0 then 'unknown_decision' end) violations
from rec where doc_id % 7 = 0 or doc_id % 5 = 0 or doc_id % 3 = 0""", "rec"),
    "contract_violations": _more("rec", _VER) + r"""
select doc_id, v violations from (select doc_id, concat_ws(',',
  case when check_name = 'entity_resolution' and (doc_id % 10 = 9) then 'bad_assessments' end,
  case when doc_id % 13 <= 1 then 'bad_confidence' end,
  case when check_name = 'source_credibility' and doc_id % 4 = 2 then 'bad_signals' end,
  case when check_name <> 'entity_resolution' and (doc_id % 10 = 9) then 'bad_spans' end,
  case when doc_id % 17 = 0 then 'extra_key' end,
  case when doc_id % 17 <> 0 and len(list_filter(regexp_split_to_array(summary, '\s+'), lambda x: x <> '')) >
    case when check_name = 'semantic_accuracy' then 60 else 80 end then 'long_reason' end,
  case when doc_id % 17 = 0 then 'missing_key' end,
  case when doc_id % 11 = 0 then 'unknown_verdict' end) v from ver) where v <> ''""",
    "evidence_spans": _more("rec", _VER, f"sp as ({_SPANS})")
        + "select doc_id, check_name, case when check_name = 'entity_resolution' then CAST(0 AS INT) end entity_pos, CAST(span_pos AS INT) span_pos, span_text, source_field from sp",
    "explode_assessments": _more("rec", _VER) + "select doc_id, check_name, CAST(0 AS INT) entity_pos, 'C1' entity_id, 'n' entity_name, "
        "true is_plausibly_linked, case when doc_id % 5 = 0 then 'none' else 'strong' end role_fit, CAST(2 AS INT) n_spans from ver "
        "where check_name = 'entity_resolution'",
    "quality_signals": _more("rec", _VER) + "select doc_id, check_name, true is_event_bearing, false is_marketing_heavy, "
        "case when doc_id % 4 <> 2 then false end is_likely_duplicate, true is_relevant_to_label from ver where check_name = 'source_credibility'",
    "ungrounded_spans": _more("rec", _VER, f"sp as ({_SPANS})") + """
select doc_id event_id, check_name, case when check_name = 'entity_resolution' then CAST(0 AS INT) end entity_pos, span_text, source_field from sp where not coalesce(contains(
  case source_field when 'source_body' then case when not no_article then body end when 'article_sentence' then article_sentence end,
  span_text), false)""",
    "reconcile": with_views("""
select check_name, event_id, CAST(sum(e) AS BIGINT) n_expected, CAST(sum(a) AS BIGINT) n_actual,
  case when sum(a) < sum(e) then 'missing' when sum(e) = 0 then 'unexpected' else 'duplicated' end status
from (select check_name, event_id, CAST(run_id = 'R00' AS INT) e, CAST(run_id = 'R09' AS INT) a from qr where run_id in ('R00', 'R09'))
group by 1, 2 having sum(e) <> sum(a)""", "qr"),
}
