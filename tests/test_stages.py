"""Judge, remediation and full run over files; sinks; warehouse."""

import json
import math
import sys

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from conftest import rows
from recordqa.operators import batching, contract, drift, judging, metrics, review, sampling
from recordqa.operators.cost import routing_table
from recordqa.plans.checks import run_checks
from recordqa.plans.full_run import run_all
from recordqa.plans.remediation import run_remediation
from recordqa.schema import CHECKS, TABLE_DDL
from recordqa.sinks import files
from recordqa.sources.lines import parse_records, read_all_checks, read_all_remediations, read_audit, read_jsonl_lines
from recordqa.sources.prompts import prompt_registry
from recordqa.sources.warehouse import Warehouse
from workload.judge_queries import fix_judge, length_judge

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture
def input_dir(tmp_path):
    """25 records over two files; three of them fail triage."""
    folder = tmp_path / "input"
    folder.mkdir()
    for name, ids in (("a.jsonl", range(0, 13)), ("b.jsonl", range(13, 25))):
        with (folder / name).open("w") as out:
            for i in ids:
                sentence = "" if i in (3, 14, 20) else f"sentence {i}"
                attrs = {"summary": "x" * (i + 1), "category": "c", "article_sentence": sentence}
                out.write(json.dumps({"data": [{"id": f"e{i:02d}", "type": "news_event", "attributes": attrs}], "included": []}) + "\n\n")
    return str(folder)


@pytest.fixture
def prompts_dir(tmp_path):
    folder = tmp_path / "prompts"
    folder.mkdir()
    for check in CHECKS:
        for v in ("v1", "v2"):
            (folder / f"{check}_{v}.txt").write_text(f"{check} {v}")
    (folder / "remediation_v1.txt").write_text("fix")
    return str(folder)


def reason_judge(requests: pd.DataFrame) -> pd.DataFrame:
    """A remediation judge for verdicts without a row number in their reason."""
    bodies = []
    for request in requests["request"]:
        inputs = json.loads(json.loads(request)["messages"][1]["content"].split("INPUT:\n", 1)[1])
        results = [{"event_id": r["event_id"], "decision": "correct_label", "confidence": 0.8, "reasoning": "r",
                    "proposed_patch": {"path": "attributes.category", "old_value": r["source_record"]["data"][0]["attributes"]["category"], "new_value": "d"},
                    "evidence_spans": [], "review_recommended": False} for r in inputs["failed_records"]]
        bodies.append(json.dumps({"choices": [{"message": {"content": json.dumps({"results": results})}}], "usage": {}}))
    return pd.DataFrame({"call_id": requests["call_id"], "response": bodies, "latency_ms": 5.0})


def test_numbering_from_a_scan_equals_the_general_one(spark, input_dir):
    lines = read_jsonl_lines(spark, input_dir).filter("value not like '%e07%'")
    fast = batching.line_positions(lines).select("value", "pos")
    slow = batching.positions(lines).select("value", "pos")
    assert rows(fast) == rows(slow)
    assert sorted(r.pos for r in fast.collect()) == list(range(24))
    with pytest.raises(Exception, match="moved since the scan"):
        batching.line_positions(lines.repartition(5, "value")).collect()


def test_batches_cover_the_input_once(spark):
    df = spark.range(0, 1003).withColumn("k", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)))
    got = batching.batch_ids(df, 10, ("id",), ("k",))
    sizes = got.groupBy("k", "batch_id").agg(F.count("*").alias("n"), F.max("id").alias("hi"), F.min("id").alias("lo"))
    assert sizes.filter("n > 10").count() == 0
    per_key = {r.k: r for r in got.groupBy("k").agg(F.count("*").alias("n"), F.countDistinct("batch_id").alias("b")).collect()}
    assert all(r.b == math.ceil(r.n / 10) for r in per_key.values())
    with pytest.raises(ValueError):
        batching.batch_ids(df, 0, ("id",))


def test_stored_responses_give_the_same_results(spark, input_dir, prompts_dir):
    records = parse_records(read_jsonl_lines(spark, input_dir))
    prompts = prompt_registry(spark, prompts_dir)
    first = run_checks(records, prompts, length_judge, run_id="r1", batch_size=4, from_scan=True)
    again = run_checks(records, prompts, responses=first.responses, run_id="r1", batch_size=4)
    cols = ("check_name", "event_id", "pos", F.to_json("llm_check").alias("j"), F.to_json("llm_metrics").alias("m"))
    assert rows(first.results, *cols) == rows(again.results, *cols)
    assert first.results.count() == 75 and first.audit.count() == 3 * 7
    assert contract.reconcile(first.results, again.results, ("check_name", "event_id")).count() == 0
    versions = {r.prompt_version for r in first.results.select("prompt_version").distinct().collect()}
    assert versions == {"v2"}


def test_the_source_check_sees_how_often_a_story_was_told(spark, input_dir, prompts_dir):
    records = parse_records(read_jsonl_lines(spark, input_dir))
    batches = judging.record_batches(records, 40, with_duplicates=True)
    requests = judging.build_requests(batches, prompt_registry(spark, prompts_dir).filter("version = 'v2'"), routing_table(), "r")
    request = requests.filter("check_name = 'source_credibility'").first().request
    inputs = json.loads(json.loads(request)["messages"][-1]["content"].split("INPUT:\n", 1)[1])
    told = {}
    for i in inputs:
        told.setdefault(i["article_sentence"], []).append(i["dedupe_context"]["possible_duplicate_count"])
    assert all(set(v) == {len(v) - 1 if s else 0} for s, v in told.items()) and len(inputs) == 25


def test_missing_prompt_raises(spark, input_dir, prompts_dir):
    prompts = prompt_registry(spark, prompts_dir).filter("base <> 'entity_resolution'")
    with pytest.raises(FileNotFoundError, match="entity_resolution"):
        run_checks(parse_records(read_jsonl_lines(spark, input_dir)), prompts, length_judge)


def test_later_run_wins_whatever_its_file_is_called(spark):
    data = [("b", "2025-01-01T00:00:00Z", "r1", 1), ("a", "2025-01-02T00:00:00Z", "r2", 2)]
    df = spark.createDataFrame(data, "file_name string, created_at string, run_id string, n int").select(
        "*", F.lit(0).cast("bigint").alias("block_start"), F.lit(0).cast("bigint").alias("line_id"),
        F.lit("semantic_accuracy").alias("check_name"), F.lit("{}").alias("source_record"),
        F.parse_json(F.concat(F.lit('{"event_id":"e","result":"fail","reason":"'), F.col("n").cast("string"), F.lit('"}'))).alias("llm_check"),
    )
    run = run_remediation(df, "Fix.", fix_judge, chunk=1)
    got = [json.loads(r[0])["confidence"] for r in run.remediations.select(F.to_json("remediation")).collect()]
    assert got == [0.02, 0.02]


def test_full_run_and_warehouse(spark, input_dir, prompts_dir, tmp_path):
    out = str(tmp_path / "out")
    done = run_all(spark, read_jsonl_lines(spark, input_dir), prompts_dir, out, length_judge, reason_judge, run_id="20250101T000000Z")
    assert done.triage_counts.first().asDict() == {"pass": 0, "fail": 3, "escalate": 22}

    results = read_all_checks(spark, done.results_dir)
    assert results.count() == 66
    line = json.loads(results.first().value)
    assert isinstance(line["source_record"], dict) and isinstance(line["llm_check"], dict)
    assert set(line) == {"run_id", "prompt_version", "prompt_file", "created_at", "source_record", "llm_check", "model", "llm_metrics"}
    failed = judging.verdict_columns(results).filter("result = 'fail'")
    fixes = read_all_remediations(spark, done.remediations_dir)
    assert fixes.count() == failed.count() > 0
    audit = read_audit(spark, done.audit_path)
    stages = dict(rows(audit.groupBy("stage").count()))
    # 22 records in batches of 20: two calls per check; failures in chunks of ten
    assert stages["quality_check"] == 6 and stages["remediation"] >= 3
    log = spark.read.json(f"{out}/logs/triage")
    dead = spark.read.json(f"{out}/logs/dead_letter")
    assert log.count() == 25 and rows(dead, "event_id") == [("e03",), ("e14",), ("e20",)]
    assert dead.select("source_record.data").first() is not None

    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.init()
    wh.init()
    assert all(wh.table(name).count() == 0 for name in TABLE_DDL)
    wh.load_quality(results)
    wh.load_remediations(fixes)
    wh.load_audit(audit)
    wh.load_triage(log.withColumn("created_at", F.col("created_at").cast("timestamp")))
    assert wh.table("llm_quality_results").count() == 66
    assert wh.table("records").count() == 22 and wh.table("triage_results").count() == 25
    runs = {r.run_id for r in wh.table("llm_call_audit").select("run_id").distinct().collect()}
    assert runs == {"20250101T000000Z", "legacy_remediation"}
    # a plain second load appends copies with the same ids; records stay one per event
    wh.load_quality(results)
    table = wh.table("llm_quality_results")
    assert table.count() == 132 and table.select("id").distinct().count() == 66
    assert wh.table("records").count() == 22
    wh.load_quality(results, replace_runs=True)
    assert wh.table("llm_quality_results").count() == 66

    first = wh.table("llm_quality_results").filter("result = 'fail'").orderBy("id").first()
    label = spark.createDataFrame([(first.id, first.event_id, first.check_name, "override_pass", "me")],
                                  "quality_result_id bigint, event_id string, check_name string, human_label string, reviewer string")
    before = review.unreviewed(wh.table("llm_quality_results"), wh.table("human_review_labels")).count()
    wh.label(label)
    wh.label(label.withColumn("human_label", F.lit("approve_fail")))
    assert rows(wh.table("human_review_labels"), "human_label") == [("approve_fail",)]
    after = review.unreviewed(wh.table("llm_quality_results"), wh.table("human_review_labels")).count()
    assert after == before - 1
    # a reload gives the same ids, so the label still finds its result
    wh.load_quality(results, replace_runs=True)
    again = review.unreviewed(wh.table("llm_quality_results"), wh.table("human_review_labels")).count()
    assert again == after
    wh.create_views()
    assert spark.sql("select count(*) from human_review_backlog").first()[0] == before
    with pytest.raises(Exception, match="must not be null"):
        wh.label(label.withColumn("human_label", F.lit(None).cast("string")))
    assert wh.table("human_review_labels").count() == 1
    assert metrics.kpi_calls(wh.table("llm_call_audit"), "20250101T000000Z").first().calls == 6


def test_remediation_cap_defaults_and_missing_ids(spark):
    check = lambda e, i: f'{{"event_id":{json.dumps(e)},"result":"fail","reason":"{i}"}}'
    data = [("semantic_accuracy", i, "{}", check("e1" if i % 2 else None, i)) for i in range(12)]
    df = spark.createDataFrame(data, "check_name string, id bigint, source_record string, c string").select(
        "check_name", "id", "source_record", F.parse_json("c").alias("llm_check")
    )
    run = run_remediation(df, "Fix.", fix_judge, max_rows_per_check=5, chunk=2, order=("id",))
    got = run.remediations.orderBy("pos").collect()
    assert [r.event_id for r in got] == [None, "e1", None, "e1", None]
    decisions = [json.loads(r.d)["decision"] for r in run.remediations.orderBy("pos").select(F.to_json("remediation").alias("d")).collect()]
    # e1 answers come from rows 1 and 3; the last one (3 % 4) wins for both
    assert decisions == ["no_change"] * 5 and got[0].llm_metrics is None and got[1].llm_metrics is not None
    assert run.audit.count() == 3
    with pytest.raises(ValueError):
        run_remediation(df, "Fix.", fix_judge, max_rows_per_check=0, order=("id",))


def test_judge_factory_is_opened_per_task(spark):
    requests = spark.range(8).select(
        F.col("id").cast("string").alias("call_id"), F.lit("c").alias("check_name"), F.lit("m").alias("model_spec"), F.lit("{}").alias("request")
    )

    def factory():
        opened = {"n": 0}

        def call(pdf):
            opened["n"] += 1
            return pd.DataFrame({"call_id": pdf["call_id"], "response": "{}", "latency_ms": 1.0})

        return call

    assert judging.judge(requests, factory=factory).count() == 8
    with pytest.raises(ValueError):
        judging.judge(requests)
    silent = lambda pdf: pd.DataFrame({"call_id": pdf["call_id"][:0], "response": [], "latency_ms": []})
    with pytest.raises(Exception, match="answer every call"):
        judging.judge(requests, silent).count()


def test_sampling(spark, input_dir, tmp_path):
    lines = read_jsonl_lines(spark, input_dir)
    one = sampling.sample_records(lines, 10, seed=1)
    assert one.count() == 10 and rows(one, "value") == rows(sampling.sample_records(lines, 10, seed=1), "value")
    assert one.join(lines, "value", "left_anti").count() == 0
    assert sampling.sample_records(lines, 100).count() == 25
    assert sampling.sample_summary(lines, 100).first() == (25, 25)
    files.write_lines(one, str(tmp_path / "sample"))
    assert spark.read.text(str(tmp_path / "sample")).count() == 10
    with pytest.raises(ValueError):
        sampling.sample_records(lines, 0)


def test_a_seed_gives_the_same_sample_whatever_the_split(spark, monkeypatch):
    df = spark.createDataFrame([(f"line {i % 700}",) for i in range(5000)], "value string")
    one = rows(sampling.sample_records(df, 1234, seed=3, key=("value",)))
    monkeypatch.setattr(sampling, "RUN", 3)
    assert len(one) == 1234 and rows(sampling.sample_records(df.repartition(13), 1234, seed=3, key=("value",))) == one


def test_equal_lines_are_drawn_one_by_one(spark):
    df = spark.createDataFrame([("same", i) for i in range(50)], "value string, n int")
    assert sampling.sample_records(df, 7, seed=1, key=("value",)).count() == 7


def test_reports(spark, tmp_path):
    data = [(i, "semantic_accuracy", v, f"r{v}", f"e{i % 3}", "fail" if v == "v1" else "pass", 0.5) for i in range(3) for v in ("v1", "v2")]
    df = spark.createDataFrame(data, "id bigint, check_name string, prompt_version string, run_id string, event_id string, result string, confidence double").withColumn("created_at", F.timestamp_seconds("id"))
    report = files.drift_report(drift.drift_summary(df), drift.drift_examples(drift.compare_runs(df)))
    files.write_drift_report(report, str(tmp_path / "drift"))
    doc = json.loads(spark.read.text(str(tmp_path / "drift"), wholetext=True).first()[0])
    assert doc["base_version"] == "v1" and set(doc["checks"]) == set(CHECKS)
    got = doc["checks"]["semantic_accuracy"]
    assert got["decision_changed_count"] == 3 and [e["event_id"] for e in got["examples"]] == ["e0", "e1", "e2"]
    assert "error" in doc["checks"]["entity_resolution"]

    labels = spark.createDataFrame(
        [(0, "semantic_accuracy", "override_pass", "2025-01-01"), (2, "semantic_accuracy", "approve_fail", "2025-01-02"), (99, "x", "approve_fail", "2025-01-03")],
        "quality_result_id bigint, check_name string, human_label string, labeled_at string",
    )
    files.export_reviews(review.labelled_set(labels, df.filter("prompt_version = 'v1'")), review.export_totals(labels), review.export_breakdown(labels), str(tmp_path / "evals"))
    summary = json.loads(spark.read.text(str(tmp_path / "evals/results"), wholetext=True).first()[0])
    assert (summary["total_reviews"], summary["overrides"], summary["approve_fail"]) == (3, 1, 2)
    assert len(summary["breakdown_by_check_and_label"]) == 3
    assert spark.read.json(str(tmp_path / "evals/labelled_sets")).count() == 2
    text = spark.read.text(str(tmp_path / "evals/findings"), wholetext=True).first()[0].splitlines()
    assert text[0].startswith("# ") and "- Reviewed items: **3**" in text and text[-1] == "- `x` / `approve_fail`: **1**"


# ---- what travels ---------------------------------------------------------
def test_positions_in_many_ranges_with_groups_nulls_and_ties(spark, monkeypatch):
    monkeypatch.setattr(batching, "RANGES", 7)
    monkeypatch.setattr(batching, "STEP", 3)
    data = [(None if i % 5 == 0 else f"g{i % 3}", i * 37 % 101, "x" * (i % 4)) for i in range(101)]
    df = spark.createDataFrame(data, "g string, o int, text string")
    got = {(r.g, r.o): r.pos for r in batching.positions(df, ("o",), ("g",)).collect()}
    want = {(g, o): n for key in {d[0] for d in data} for n, (g, o) in enumerate(sorted((d[:2] for d in data if d[0] == key), key=lambda d: d[1]))}
    assert got == want
    ranged = batching.ranged_positions(df, ("o",), size=10)
    assert [r.pos for r in ranged.orderBy("o").collect()] == list(range(101))
    batches = ranged.groupBy(F.floor(F.col("pos") / 10)).agg(F.countDistinct("_range").alias("n"))
    assert ranged.select("_range").distinct().count() > 3 and batches.filter("n > 1").count() == 0
    twice = batching.positions(df.filter("o < 40").unionByName(df.filter("o < 40")), ("o",))
    assert sorted(r.pos for r in twice.collect()) == sorted(2 * [p for p in range(80)])
    assert batching.positions(df.limit(0), ("o",)).count() == 0


def test_rows_are_numbered_where_one_shuffle_put_them(spark):
    df = spark.createDataFrame([(i, "text") for i in range(50)], "o int, text string")
    batches = batching.ranged_positions(df, ("o",), size=10).groupBy("_range", F.floor(F.col("pos") / 10)).agg(F.collect_list("text"))
    assert batches._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_a_judge_is_given_frames_of_bounded_size(spark):
    def sizes(pdf):
        return pdf[["call_id"]].assign(response=str(int(pdf["request"].str.len().sum())), latency_ms=1.0)

    rows_ = spark.range(400).select(
        F.col("id").cast("string").alias("call_id"), F.lit("c").alias("check_name"), F.lit("m").alias("model_spec"), F.repeat(F.lit("x"), 100_000).alias("request")
    )
    seen = judging.judge(rows_.coalesce(1), sizes).select(F.max(F.col("response").cast("bigint")), F.count("*")).first()
    assert seen[0] <= 2 * judging.FRAME_BYTES and seen[1] == 400


def test_stored_responses_meet_batches_and_not_requests(spark):
    batches = spark.createDataFrame([(0, [1]), (1, [2])], "batch_id bigint, members array<int>")
    stored = spark.createDataFrame(
        [(f"r/{CHECKS[0]}/0", "a", 1.0), (f"r/{CHECKS[1]}/0", None, 2.0), (f"r/{CHECKS[0]}/01", "b", 3.0), (f"s/{CHECKS[0]}/1", "c", 4.0), ("x", "d", 5.0)],
        "call_id string, response string, latency_ms double",
    )
    given = {r.batch_id: r._given for r in judging.with_given(batches, stored, "r").collect()}
    assert {k: tuple(v) for k, v in given[0].items()} == {CHECKS[0]: ("a", 1.0), CHECKS[1]: (None, 2.0)} and given[1] is None
