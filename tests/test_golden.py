"""Hand-written rows for the semantics traps."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from recordqa.functions import ids, text
from recordqa.operators import drift, judging, loading, metrics, records, review
from recordqa.operators.cost import routing_table, with_cost, with_routing
from recordqa.operators.triage import triage, triage_counts
from recordqa.operators.conformance import relationships, schema_violations
from recordqa.operators.profile import parse_amount
from recordqa.sources.lines import (
    parse_records,
    parse_results,
    read_all_checks,
    read_jsonl_lines,
    read_results,
)
from recordqa.sources.prompts import latest_prompts, prompt_registry


def lines(spark, *values):
    return spark.createDataFrame(
        [(v if isinstance(v, str) else json.dumps(v, ensure_ascii=False), "f", 0, i) for i, v in enumerate(values)],
        "value string, file_name string, block_start bigint, line_id bigint",
    )


def event(id_="e1", category="c", sentence="s", **attrs):
    return {"id": id_, "type": "news_event", "attributes": {"category": category, "article_sentence": sentence, **attrs}}


def article(title):
    return {"id": title, "type": "news_article", "attributes": {"title": title}}


def results(spark, data):
    """(id, check, version, run, event, result, confidence)"""
    return spark.createDataFrame(
        data,
        "id bigint, check_name string, prompt_version string, run_id string, event_id string, result string, confidence double",
    ).withColumn("created_at", F.timestamp_seconds("id"))


# ---- records and triage ---------------------------------------------------
def test_missing_is_null_or_empty_but_not_blank(spark):
    recs = lines(
        spark,
        {"data": [event(id_="")]},
        {"data": [event(category=None)]},
        {"data": [event(sentence=" ")]},
        {"data": []},
        {"data": None},
        {},
    )
    got = triage(parse_records(recs))
    assert [r.decision for r in got.orderBy("line_id").collect()] == ["fail", "fail", "escalate", "fail", "fail", "fail"]
    assert [r.event_id for r in got.orderBy("line_id").collect()][3:] == [None, None, None]
    assert triage_counts(got).first().asDict() == {"pass": 0, "fail": 5, "escalate": 1}


def test_only_the_first_event_and_the_first_article_count(spark):
    recs = lines(
        spark,
        {"data": [event("a"), event("b")], "included": [article("one"), article("two")]},
        {"data": [event("c")], "included": [{"id": "x", "type": "company", "attributes": None}]},
        {"data": [event("d")]},
    )
    got = records.extract_payload(parse_records(recs))
    assert rows(got, "event_id", "source_title") == [("a", "one"), ("c", None), ("d", None)]
    linked = {r.event_id: r.linked_entities for r in got.collect()}
    assert linked["d"] == [] and linked["c"][0].entity_id == "x" and linked["c"][0].entity_name is None


def test_truncation_counts_code_points(spark):
    df = spark.createDataFrame([("äöü€",)], "b string")
    assert df.select(text.truncate_chars(F.col("b"), 2), text.truncate_chars(F.col("b"), 0)).first() == ("äö", "äöü€")


def test_unknown_check_is_refused(spark):
    with pytest.raises(ValueError):
        records.check_input_struct(F.col, "spelling")


def test_malformed_lines_by_mode(spark):
    recs = lines(spark, "{bad", {"data": [event("a")]})
    with pytest.raises(Exception, match="malformed"):
        records.extract_payload(parse_records(recs)).select("event_id").collect()
    assert parse_records(recs, mode="drop").count() == 1
    kept = parse_records(recs, mode="quarantine").orderBy("line_id").collect()
    assert [r.is_malformed for r in kept] == [True, False]


def test_wrongly_typed_fields_do_not_make_a_line_malformed(spark):
    recs = lines(spark, '{"data":[{"id":"a","attributes":{"category":"x","article_sentence":{"k":1}}}],"included":7}')
    assert records.extract_payload(parse_records(recs)).first().event_id == "a"


def test_record_cap_takes_the_first_lines(spark):
    recs = lines(spark, *[{"data": [event(f"e{i}")]} for i in range(5)])
    assert rows(records.extract_payload(parse_records(recs, max_records=2)), "event_id") == [("e0",), ("e1",)]
    with pytest.raises(ValueError):
        parse_records(recs, max_records=0)


# ---- sources --------------------------------------------------------------
def test_blank_lines_are_skipped_and_lines_stripped(spark, tmp_path):
    (tmp_path / "b.jsonl").write_text('\n   \n\t\n  {"n":2}  \n')
    (tmp_path / "a.jsonl").write_text('{"n":1}\n')
    (tmp_path / "c.txt").write_text("no\n")
    got = read_jsonl_lines(spark, str(tmp_path)).orderBy("file_name", "block_start", "line_id")
    assert [(r.file_name.rsplit("/", 1)[-1], r.value) for r in got.collect()] == [("a.jsonl", '{"n":1}'), ("b.jsonl", '{"n":2}')]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_jsonl_lines(spark, str(tmp_path / "nothing")).count()


def test_missing_results_are_empty_and_checks_are_tagged(spark, tmp_path):
    assert read_results(spark, str(tmp_path / "none.jsonl")).count() == 0
    line = {"run_id": "r", "prompt_version": 3, "llm_check": {"check_name": "other", "event_id": "e"}, "source_record": {"b": 1, "a": 2}}
    (tmp_path / "entity_resolution_results.jsonl").write_text(json.dumps(line) + "\n")
    row = read_all_checks(spark, str(tmp_path)).first()
    assert (row.check_name, row.run_id, row.prompt_version) == ("entity_resolution", "r", None)
    assert row.source_record == '{"b":1,"a":2}'


def test_prompt_files(spark, tmp_path):
    for name in ("semantic_accuracy_v10.txt", "semantic_accuracy_v2.txt", "x_vfinal.txt"):
        (tmp_path / name).write_text(name)
    reg = prompt_registry(spark, str(tmp_path))
    assert rows(latest_prompts(reg), "base", "version", "version_num", "text") == [
        ("semantic_accuracy", "v10", 10, "semantic_accuracy_v10.txt"),
        ("x", "vfinal", 0, "x_vfinal.txt"),
    ]
    names = spark.createDataFrame([("x_final.txt",), ("x_v3.txt",), ("plain.txt",)], "f string")
    assert [r[0] for r in names.select(ids.prompt_version(F.col("f"))).collect()] == ["v1", "v3", "v1"]


# ---- ids and cost ---------------------------------------------------------
def test_model_specs(spark):
    good = spark.createDataFrame([("OpenAI: gpt-4o ",), ("gpt-4o",)], "s string").select(ids.model_spec(F.col("s")).alias("m"))
    assert [tuple(r.m) for r in good.collect()] == [("openai", "gpt-4o")] * 2
    for bad in ("foo:bar", "openai:"):
        with pytest.raises(Exception, match="invalid model spec"):
            spark.createDataFrame([(bad,)], "s string").select(ids.model_spec(F.col("s"))).collect()


def test_routing(spark):
    assert set(routing_table(single_model="anthropic:m").values()) == {"anthropic:m"}
    with pytest.raises(ValueError):
        routing_table({"spelling": "gpt-4o"})
    df = spark.createDataFrame([("semantic_accuracy",)], "check_name string")
    with pytest.raises(Exception, match="invalid model spec"):
        with_routing(df, routing_table(single_model="foo:bar")).collect()


def test_routing_join(spark):
    df = spark.createDataFrame([("semantic_accuracy",), ("other",)], "check_name string")
    assert rows(with_routing(df, routing_table()), "check_name", "provider", "model") == [
        ("other", None, None),
        ("semantic_accuracy", "openai", "gpt-4o-mini"),
    ]


def test_cost(spark):
    calls = spark.createDataFrame(
        [("openai", "gpt-4o", 1000, 2000), ("anthropic", "gpt-4o", 1, 1), ("openai", "new", 1, 1), ("openai", "gpt-4o", None, 1), ("openai", None, 1, 1)],
        "provider string, model string, prompt_tokens bigint, completion_tokens bigint",
    )
    got = [r.cost_usd for r in with_cost(calls).collect()]
    assert got[0] == pytest.approx(0.035) and got[1:] == [None] * 4


def test_run_ids(spark):
    df = spark.createDataFrame([(None,), ("  ",), ("r1",), (" ",)], "r string")
    got = [r[0] for r in df.select(ids.normalise_run_id(F.col("r"), F.lit("c"))).collect()]
    assert got == ["legacy_c", "legacy_c", "r1", "legacy_c"]
    assert ids.new_run_id(datetime.fromisoformat("2025-01-02T03:04:05+00:00")) == "20250102T030405Z"


# ---- verdicts -------------------------------------------------------------
def verdict_lines(spark, *confidences):
    return lines(
        spark,
        *[
            {"run_id": "r", "prompt_version": "v1", "llm_check": {"event_id": "e", "result": "pass", "confidence": c}}
            for c in confidences
        ],
    )


def test_confidence_strict_and_lenient(spark):
    parsed = parse_results(verdict_lines(spark, 0.5, "0.5", True, None)).withColumn("check_name", F.lit("semantic_accuracy"))
    strict = judging.verdict_columns(parsed).orderBy("line_id").select("confidence").collect()
    assert [r[0] for r in strict] == [0.5, None, 1.0, None]
    loaded = loading.to_quality_rows(parsed).select("confidence").collect()
    assert sorted(str(r[0]) for r in loaded) == ["0.5", "0.5", "1.0", "None"]


def test_default_answer(spark):
    rows_ = spark.createDataFrame([("c1", "semantic_accuracy", e, "v2") for e in ("a", "b", "c")], "call_id string, check_name string, event_id string, prompt_version string")
    body = {"choices": [{"message": {"content": json.dumps({"results": [
        {"event_id": "a", "result": {"result": "pass", "event_id": "zzz", "check_version": "v9"}},
        {"event_id": "b", "result": "nonsense"},
        {"event_id": "", "result": {"result": "pass"}},
    ]})}}]}
    answers = judging.unpack(spark.createDataFrame([("c1", json.dumps(body))], "call_id string, response string"), "openai")
    out = {r.event_id: json.loads(r.j) for r in judging.attach_answers(rows_, answers).select("event_id", F.to_json("llm_check").alias("j")).collect()}
    assert out["a"] == {"result": "pass", "event_id": "a", "check_version": "v9", "check_name": "semantic_accuracy"}
    for e in ("b", "c"):
        assert (out[e]["result"], out[e]["confidence"], out[e]["check_version"]) == ("fail", 0.0, "v1")
    counts = judging.decision_summary(answers).first()
    assert (counts["pass"], counts["fail"], counts["other"]) == (2, 0, 1)


def test_invalid_response(spark):
    bad = spark.createDataFrame([("c1", '{"choices":[{"message":{"content":"no json"}}]}')], "call_id string, response string")
    with pytest.raises(Exception, match="results array"):
        judging.unpack(bad, "openai").collect()
    assert judging.unpack(bad, "openai", "quarantine").first().is_invalid


def test_run_key_needs_text(spark):
    raw = lines(
        spark,
        {"run_id": 5, "prompt_version": "v1", "llm_check": {"event_id": "a"}},
        {"run_id": "r", "prompt_version": "v1", "llm_check": {"event_id": 7}},
        {"run_id": "r", "prompt_version": "v1", "llm_check": {"event_id": "c"}},
    )
    got = drift.has_run_key(judging.verdict_columns(parse_results(raw)))
    assert [r.event_id for r in got.collect()] == ["c"]


# ---- drift ----------------------------------------------------------------
C = "semantic_accuracy"


def test_null_modes_differ_only_on_null_pairs(spark):
    base = [("p", "f"), (None, None), ("p", None)]
    data = []
    for i, (b, c) in enumerate(base):
        data += [(2 * i, C, "v1", "r1", f"e{i}", b, 0.5), (2 * i + 1, C, "v2", "r2", f"e{i}", c, 0.75)]
    df = results(spark, data)
    count = lambda **k: drift.drift_summary(df, **k).filter(F.col("check_name") == C).first()
    assert count().decision_changed_count == 2
    assert count(null_mode="null_changed").decision_changed_count == 3
    assert count().avg_confidence_delta_candidate_minus_base == pytest.approx(0.25)
    assert count(null_mode="null_changed", dedupe=False).decision_changed_count == 3
    with pytest.raises(ValueError):
        drift.drift_summary(df, null_mode="other")


def test_repeats_last_wins_or_all_pairs(spark):
    df = results(spark, [(1, C, "v1", "r", "e", "pass", 0.1), (2, C, "v1", "r", "e", "fail", 0.2), (3, C, "v2", "r", "e", "fail", 0.4)])
    one = lambda **k: drift.drift_summary(df, **k).filter(F.col("check_name") == C).first()
    last, pairs = one(), one(null_mode="null_changed", dedupe=False)
    assert (last.common_rows, last.decision_changed_count) == (1, 0)
    assert (pairs.base_rows, pairs.common_rows, pairs.decision_changed_count) == (2, 2, 1)
    assert pairs.avg_confidence_delta_candidate_minus_base == pytest.approx(0.25)
    statuses = dict(rows(drift.drift_summary(df), "check_name", "status"))
    assert statuses["entity_resolution"] == "missing_run"
    none = results(spark, [(1, C, "v1", "r", "a", "pass", 0.1), (3, C, "v2", "r", "b", "fail", 0.4)])
    got = drift.drift_summary(none).filter(F.col("check_name") == C).first()
    assert (got.status, got.base_rows, got.decision_changed_rate) == ("no_overlap", 1, 0.0)


def test_latest_run_is_the_highest_text(spark):
    df = results(spark, [(i, C, "v1", r, "e", "fail", 0.5) for i, r in enumerate(("20250101T000000Z", "20250102T000000Z", "legacy_x"))])
    assert drift.latest_run(df).first().run_id == "legacy_x"
    assert drift.latest_run(df, ignore_legacy=True).first().run_id == "20250102T000000Z"
    assert metrics.failures_by_check(df).first().cnt == 1


# ---- review ---------------------------------------------------------------
def test_published_confusion_matrix(spark):
    """83 labels with the published counts per check."""
    counts = {
        "semantic_accuracy": (23, 9),
        "entity_resolution": (10, 14),
        "source_credibility": (0, 27),
    }
    data = []
    for check, (tp, fp) in counts.items():
        labels = [("approve_fail", "needs_changes", "reject_record")[i % 3] for i in range(tp)] + ["override_pass"] * fp
        data += [(check, "fail", label) for label in labels]
    assert len(data) == 83
    joined = spark.createDataFrame(data, "check_name string, result string, human_label string")
    assert rows(review.review_metrics(joined), "check_name", "precision", "recall", "accuracy") == [
        ("entity_resolution", 0.417, 1.0, 0.417),
        ("semantic_accuracy", 0.719, 1.0, 0.719),
        ("source_credibility", 0.0, None, 0.0),
    ]


def test_totals_of_no_labels_are_null(spark):
    empty = spark.createDataFrame([], "human_label string")
    assert review.export_totals(empty).first() == (0, None, None)


def test_view_keeps_labelled_rows_backlog_drops_them(spark):
    df = results(spark, [(1, C, "v1", "r", "a", "fail", 0.1), (2, C, "v1", "r", "b", "fail", 0.2)]).withColumn("reason", F.lit("x"))
    labels = spark.createDataFrame([(1,)], "quality_result_id bigint")
    assert review.backlog_view(df).count() == 2
    assert [r.event_id for r in review.backlog(df, labels).collect()] == ["b"]


def test_label_upsert_is_idempotent(spark):
    ddl = "quality_result_id bigint, human_label string, labeled_at timestamp"
    old = spark.createDataFrame([(1, "approve_fail", datetime(2025, 1, 1)), (2, "approve_fail", datetime(2025, 1, 1))], ddl)
    new = spark.createDataFrame([(1, "override_pass", datetime(2025, 1, 1))], ddl)
    once = review.upsert_labels(old, new)
    assert rows(once, "quality_result_id", "human_label") == [(1, "override_pass"), (2, "approve_fail")]
    assert rows(review.upsert_labels(once, new)) == rows(once)


def test_record_upsert(spark):
    ddl = "event_id string, source_record_json string, seen_at timestamp"
    empty = spark.createDataFrame([], "event_id string, source_record_json string, first_seen_at timestamp, last_seen_at timestamp")
    day = lambda d: datetime(2025, 1, d)
    first = loading.upsert_records(empty, spark.createDataFrame([("a", "1", day(1))], ddl))
    again = loading.upsert_records(first, spark.createDataFrame([("a", "2", day(2)), (None, "x", day(2))], ddl))
    assert rows(again) == [("a", "2", day(1), day(2))]


# ---- conformance, amounts, times ------------------------------------------
def test_relationship_shapes(spark):
    ref = lambda i: {"id": i, "type": "company"}
    rec = {"data": [{**event("e"), "relationships": {"one": {"data": ref("1")}, "many": {"data": [ref("2"), ref("3")]}, "none": {"data": None}}}]}
    got = relationships(parse_records(lines(spark, rec), full=True))
    assert rows(got, "rel", "target_id") == [("many", "2"), ("many", "3"), ("one", "1")]


def test_schema_violations(spark):
    good = {
        "data": [{**event("e", summary="s", found_at="2025-01-01T00:00:00Z", confidence=0.5, human_approved=True, planning=False,
                          headcount=3, assets_tags=[], location_data=[{"city": "x"}], effective_date="2025-01-01"), "relationships": {}}],
        "included": [article("t"), {"id": "c", "type": "company", "attributes": {"domain": "d"}}],
    }
    bad = json.loads(json.dumps(good))
    bad["data"][0]["attributes"].update(headcount="many", assets_tags=[1], effective_date="soon", planning=None)
    bad["included"].append({"id": "p", "type": "person", "attributes": {}})
    bad["included"][1]["attributes"]["domain"] = 5
    got = schema_violations(lines(spark, good, bad, {"data": []}))
    assert rows(got, "part", "position", "field", "rule") == sorted(
        [("data", 0, "headcount", "type"), ("data", 0, "assets_tags", "type"), ("data", 0, "effective_date", "type"),
         ("data", 0, "planning", "missing"), ("included", 1, "domain", "type"), ("included", 2, "type", "tag"),
         ("record", 0, "included", "missing")],
        key=lambda r: tuple((True, str(v)) for v in r),
    )


@pytest.mark.parametrize(
    "amount,value,currency,ok",
    [
        ("8.8 billion baht", 8.8e9, "THB", True),
        ("€50M", 5e7, "EUR", True),
        ("5M EUR", 5e6, "EUR", True),
        ("£10 million", 1e7, "GBP", True),
        ("$1,250.50", 1250.5, "USD", True),
        ("USD 3bn", 3e9, "USD", True),
        ("1200", 1200.0, None, True),
        ("several millions", None, None, False),
        ("10 million bananas", None, None, False),
        (None, None, None, False),
    ],
)
def test_amounts(spark, amount, value, currency, ok):
    got = parse_amount(spark.createDataFrame([(amount,)], "amount string")).first()
    assert got.amount_value == (pytest.approx(value) if value else value)
    assert (got.currency, got.amount_parsed) == (currency, ok)


def test_timestamps(spark):
    df = spark.createDataFrame([("2025-07-07T10:00:00Z",), ("2025-07-07T10:00:00+02:00",), ("2025-02-30T10:00:00Z",), ("2025-07-07",), (None,)], "t string")
    assert [r[0] for r in df.select(text.valid_iso_timestamp(F.col("t"))).collect()] == [True, True, False, False, False]
