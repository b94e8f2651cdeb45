"""Near copies, waves, quarantine, stateful resume, stored sketches: what the SQL twins cannot show."""

import gzip
import json
import random
import sys
from pathlib import Path

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from recordqa.functions.variants import printed
from recordqa import session
from recordqa.operators import conformance, duplicates, judging, loading, near_stories, sampling, sketches
from recordqa.plans import full_run
from recordqa.plans.checks import run_checks
from recordqa.plans.full_run import run_all
from recordqa.plans.remediation import run_remediation
from recordqa.schema import CHECKS
from recordqa.session import OPEN_FILES, READ_ROWS, free, open_files, scratch, shared_dir, stage_table
from recordqa.sinks import files
from recordqa.sources.lines import parse_records, read_all_checks, read_audit, read_jsonl_lines
from recordqa.sources.prompts import prompt_registry
from recordqa.sources.warehouse import Warehouse
from recordqa.streaming.triage import resume_stateful
from workload import run_queries
from workload.judge_queries import fix_judge, length_judge

cloudpickle.register_pickle_by_value(sys.modules[__name__])


# ---- near copies ----------------------------------------------------------
def _jaccard(a, b, k=5):
    cut = lambda t: {tuple(t.split()[i : i + k]) for i in range(max(len(t.split()) - k + 1, 1))}
    return len(cut(a) & cut(b)) / len(cut(a) | cut(b))


def _texts(seed, n_families=12, members=6):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    out = []
    for _ in range(n_families):
        base = [word() for _ in range(rng.choice([4, 60, 120, 200]))]
        for _ in range(members):
            own = list(base)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = word()
            out.append(" ".join(own))
    return out + [out[0], out[0].upper() + "!", None, "", " - ", "one"]


def test_near_links_are_the_pairs_above_the_threshold(spark):
    texts = _texts(3)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id int, article_sentence string, a string")
    forms = sorted({" ".join("".join(c if c.isalnum() else " " for c in t.lower()).split()) for t in texts if t} - {""})
    want = {(a, b) for i, a in enumerate(forms) for b in forms[i + 1 :] if _jaccard(a, b) >= 0.8}
    key = {r.k: r.f for r in spark.createDataFrame([(f,) for f in forms], "f string").select("f", duplicates.story_key(F.col("f")).alias("k")).collect()}
    got = {tuple(sorted((key[r.a], key[r.b]))) for r in near_stories.near_links(df).collect()}
    assert got <= want and len(got) >= 0.9 * len(want) and len(want) > 20
    for r in near_stories.near_links(df).collect():
        assert r.similarity == pytest.approx(_jaccard(key[r.a], key[r.b]))


def test_large_buckets_are_dealt_out_without_losing_a_pair(spark, monkeypatch):
    texts = [" ".join(f"w{n}" for n in range(80)) + f" tail{i}" for i in range(60)]  # all in the same buckets
    df = spark.createDataFrame([(t,) for t in texts], "article_sentence string")
    monkeypatch.setattr(near_stories, "BUCKET", 7)
    assert near_stories.near_links(df).count() == 60 * 59 // 2
    counted = near_stories.near_duplicate_counts(df)
    assert rows(counted.select("possible_duplicate_count", "similar_stories").distinct()) == [(59, 59)]


def test_near_context_counts_copies_of_similar_stories(spark):
    base = " ".join(f"w{n}" for n in range(60))
    df = spark.createDataFrame([(1, base), (2, base), (3, base + " more"), (4, "other words"), (5, None)], "id int, article_sentence string")
    count = F.col("dedupe_context.possible_duplicate_count").alias("n")
    assert rows(duplicates.dedupe_context(df, threshold=0.8).select("id", count)) == [(1, 2), (2, 2), (3, 2), (4, 0), (5, 0)]
    assert rows(duplicates.dedupe_context(df).select("id", count)) == [(1, 1), (2, 1), (3, 0), (4, 0), (5, 0)]
    assert near_stories.near_links(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        near_stories.near_links(df, threshold=0)


def test_what_bands_may_miss_is_rare():
    assert near_stories.miss_probability(0.8) < 4e-4 and near_stories.miss_probability(0.9) < 1e-7


# ---- waves ----------------------------------------------------------------
def _prompts(spark, *more):
    return spark.createDataFrame(
        [(c, "v1", 1, f"{c}_v1.txt", c) for c in (*CHECKS, *more)], "base string, version string, version_num int, file string, text string"
    )


def _records(spark, n=40):
    lines = [json.dumps({"data": [{"id": f"e{i:02d}", "attributes": {"summary": "x" * (i + 1), "category": "c", "article_sentence": f"s {i}"}}]}) for i in range(n)]
    return spark.createDataFrame([(v, "f", 0, i) for i, v in enumerate(lines)], "value string, file_name string, block_start long, line_id long")


def lost_after_two(requests: pd.DataFrame) -> pd.DataFrame:
    if any(int(c.rsplit("/", 1)[1]) >= 2 for c in requests["call_id"]):
        raise RuntimeError("lost")
    return length_judge(requests).assign(latency_ms=1.0)


def late(requests: pd.DataFrame) -> pd.DataFrame:
    return length_judge(requests).assign(latency_ms=2.0)


def test_a_lost_run_asks_only_for_what_no_committed_wave_holds(spark, tmp_path):
    records, prompts, store = parse_records(_records(spark)), _prompts(spark), str(tmp_path / "calls")
    run = lambda judge, n: run_checks(records, prompts, judge, run_id="r", batch_size=5, store=store, waves=n)
    with pytest.raises(PySparkException, match="lost"):
        run(lost_after_two, 4)  # batches 0..7: waves 0 and 1 fail with batches 4 and 5, so nothing is committed
    assert judging.ResponseStore(spark, store).committed().count() == 0
    with pytest.raises(PySparkException, match="lost"):
        run(lost_after_two, 8)  # one batch a wave: 0 and 1 are committed
    held = judging.ResponseStore(spark, store).committed()
    assert held.count() == 2 * len(CHECKS) and held.where("latency_ms <> 1").count() == 0
    out = run(late, 3)
    assert rows(out.audit.groupBy("latency_ms").count()) == [(1.0, 2 * len(CHECKS)), (2.0, 6 * len(CHECKS))]
    assert judging.ResponseStore(spark, store).committed().groupBy("call_id").count().where("count > 1").count() == 0
    assert out.results.count() == 40 * len(CHECKS)
    again = run(lost_after_two, 3)  # all is held: nobody is asked
    assert again.audit.where("latency_ms = 2").count() == 6 * len(CHECKS)


def test_one_response_is_the_last_stored(spark):
    df = spark.createDataFrame(
        [("a", "old", 1.0, 1), ("a", None, 1.0, 2), ("a", "new", 1.0, 2), ("b", None, None, 1), ("c", "x", 1.0, 1), ("c", "x", 1.0, 1)],
        "call_id string, response string, latency_ms double, stored_at int",
    )
    assert rows(judging.one_response(df), "call_id", "response") == [("a", "new"), ("b", None), ("c", "x")]


# ---- quarantine -----------------------------------------------------------
def half_broken(requests: pd.DataFrame) -> pd.DataFrame:
    out = fix_judge(requests)
    out.loc[requests["call_id"].str.contains("entity_resolution"), "response"] = "no json"
    return out


@pytest.fixture
def failing(spark):
    values = [(c, i, f'{{"data":[{{"id":"e{i}"}}]}}', f'{{"event_id":"e{i}","result":"fail","reason":"{i + 1}"}}') for c in CHECKS for i in range(5)]
    df = spark.createDataFrame(values, "check_name string, id int, source_record string, llm_check string")
    return df.withColumn("llm_check", F.parse_json("llm_check"))


def test_one_broken_remediation_answer_does_not_end_the_run(spark, failing):
    with pytest.raises(PySparkException, match="not JSON"):
        run_remediation(failing, "Fix.", half_broken, order=("id",)).remediations.collect()
    run = run_remediation(failing, "Fix.", half_broken, order=("id",), mode="quarantine", chunk=4, fallback_chunk=3)
    got = run.remediations.select("check_name", F.try_variant_get("remediation", "$.reasoning", "string").alias("why"))
    counts = rows(got.groupBy("check_name", "why").count())
    assert counts == [("entity_resolution", "No valid remediation returned for this row.", 5)] + [(c, "by row", 5) for c in sorted(CHECKS) if c != "entity_resolution"]
    audit = rows(run.audit.groupBy("check_name", "note", "is_invalid").count())
    # two calls, broken, and their parts of three: 3 + 1 and 1
    assert [a for a in audit if a[0] == "entity_resolution"] == [("entity_resolution", None, True, 2), ("entity_resolution", "chunked_fallback", True, 3)]
    assert all(a[1:] == (None, False, 2) for a in audit if a[0] != "entity_resolution")
    for wrong in ({"mode": "drop"}, {"fallback_chunk": 0}):
        with pytest.raises(ValueError):
            run_remediation(failing, "Fix.", fix_judge, order=("id",), **wrong)


def every_fix_broken(requests: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"call_id": requests["call_id"], "response": "no json", "latency_ms": 1.0})


def test_a_run_survives_bad_lines_and_bad_answers_and_loses_neither(spark, tmp_path):
    folder = tmp_path / "input"
    folder.mkdir()
    lines = [json.loads(r.value) for r in _records(spark, 12).collect()]
    (folder / "a.jsonl").write_text("\n".join([*map(json.dumps, lines), "{broken", '{"data":[']) + "\n")
    prompts = tmp_path / "prompts"
    prompts.mkdir()
    for base in (*CHECKS, "remediation"):
        (prompts / f"{base}_v1.txt").write_text(base)
    read = lambda: read_jsonl_lines(spark, str(folder))
    with pytest.raises(PySparkException, match="malformed"):
        run_all(spark, read(), str(prompts), str(tmp_path / "x"), length_judge, every_fix_broken)
    before = set((Path(shared_dir(spark).removeprefix("file:")) / "recordqa").rglob("*.parquet"))
    done = run_all(spark, read(), str(prompts), str(tmp_path / "out"), length_judge, every_fix_broken, run_id="r1", mode="quarantine")
    kept = spark.read.json(done.quarantine_path)
    assert rows(kept, "run_id", "value") == [("r1", '{"data":['), ("r1", "{broken")] and kept.where("file_name LIKE '%a.jsonl'").count() == 2
    staged = Path(shared_dir(spark).removeprefix("file:")) / "recordqa"
    new = {f for f in staged.rglob("*.parquet") if f not in before and "round-trips" not in f.parts}
    assert sum(spark.read.parquet(str(f)).count() for f in new) == 0  # scratch of the run is empty
    assert rows(done.triage_counts, "escalate") == [(12,)] and read_all_checks(spark, done.results_dir).count() == 12 * len(CHECKS)
    fixed = spark.read.json(done.remediations_dir).select("remediation.decision").distinct()
    assert rows(fixed) == [("no_change",)]
    assert read_audit(spark, done.audit_path).where("stage = 'remediation'").count() == len(CHECKS)


def test_a_run_packs_its_files_and_empties_what_each_stage_staged(spark, tmp_path, monkeypatch):
    prompts, lines = tmp_path / "prompts", _records(spark, 70).withColumn("value", F.when(F.col("line_id") == 5, "{broken").otherwise(F.col("value")))
    prompts.mkdir()
    for base in (*CHECKS, "remediation"):
        (prompts / f"{base}_v1.txt").write_text(base)
    shared, left = Path(shared_dir(spark).removeprefix("file:")) / "recordqa", {}
    held = lambda: {d for d in shared.iterdir() if d.name != "round-trips" and list(d.rglob("*.parquet")) and spark.read.parquet(str(d)).count()}

    def watched(name):
        real = getattr(full_run, name)
        monkeypatch.setattr(full_run, name, lambda *a, **k: (left.setdefault(name, []).append(held() - before), sizes.add(spark.conf.get(batch)), real(*a, **k))[2])

    before, batch, sizes = held(), "spark.sql.parquet.columnarReaderBatchSize", set()
    usual = spark.conf.get(batch)
    monkeypatch.setattr(files, "PACKED_LINES", 10)
    watched("run_checks")
    watched("run_remediation")
    run = lambda out, **more: run_all(spark, lines, str(prompts), str(tmp_path / out), length_judge, every_fix_broken, run_id="r1", mode="quarantine", **more)
    packed, plain = run("packed"), run("plain", codec=None)
    assert left == {"run_checks": [set(), set()], "run_remediation": [set(), set()]}
    assert sizes == {str(READ_ROWS)} and spark.conf.get(batch) == usual != str(READ_ROWS)  # long requests are read a few at a time
    said = lambda done: rows(judging.verdict_columns(read_all_checks(spark, done.results_dir)), "check_name", "event_id", "result", "source_record")
    assert said(packed) == said(plain) and len(said(plain)) == 69 * len(CHECKS)
    assert rows(spark.read.json(packed.quarantine_path), "value", "line_id") == rows(spark.read.json(plain.quarantine_path), "value", "line_id") == [("{broken", 5)]
    assert read_audit(spark, packed.audit_path).count() == read_audit(spark, plain.audit_path).count() > 0
    of = lambda out: [f for f in (tmp_path / out).rglob("part-*") if "calls" not in f.relative_to(tmp_path / out).parts[:1]]
    assert {f.suffix for f in of("packed")} == {".gz"} and {f.suffix for f in of("plain")} == {".json", ".txt"}
    assert all(len(gzip.open(f).readlines()) <= 10 for f in of("packed"))


def fixed(requests: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"call_id": requests["call_id"], "response": '{"choices":[{"message":{"content":"{}"}}]}', "latency_ms": 1.0})


def test_lines_are_parsed_once_though_one_run_is_asked_for(spark):
    seen = spark.sparkContext.accumulator(0)

    def line(n: int) -> str:
        seen.add(1)
        return json.dumps({"run_id": f"r{n % 2}", "event_id": f"e{n}", "result": "fail"})

    said = spark.range(20).select(
        F.col("id"), F.lit("semantic_accuracy").alias("check_name"), F.lit("{}").alias("source_record"), F.try_parse_json(F.udf(line)("id")).alias("llm_check")
    )
    results = said.withColumn("run_id", F.try_variant_get("llm_check", "$.run_id", "string"))
    run = run_remediation(results, "Fix.", fixed, order=("id",), runs=["r1"])
    assert seen.value == 20 and run.remediations.count() == 10


ODD = ['{"b":1, "a":{"z":[1.50,1e3,-0.0,12345678901234567890],"y":null}}', '{"t":"q\\"uo \\\\ te \\u0007 \\u2028 \\n é 😀 \\u00e9 <\\/p>"}', '{"a":"{\\"role\\":\\"user\\",\\"content\\":\\"x\\"}"}', "[ ]", "null", None]


def test_files_hold_printed_text_as_they_hold_what_is_parsed(spark, tmp_path):
    rows_of = spark.createDataFrame(list(enumerate(ODD)), "n int, source_record string").select(
        F.lit("r").alias("run_id"), F.lit("v1").alias("prompt_version"), F.lit(None).cast("string").alias("prompt_file"), F.expr("TIMESTAMP'2025-01-01 00:00:00.5'").alias("created_at"),
        F.when(F.col("n") % 2 == 0, CHECKS[0]).otherwise(CHECKS[1]).alias("check_name"), "source_record", F.parse_json(F.lit('{"z":1,"a":null}')).alias("llm_check"),
        F.lit("m").alias("model"), F.struct(F.lit(0.25).alias("x"), F.lit(None).cast("int").alias("y")).alias("llm_metrics"),
    )
    files.write_results(rows_of, str(tmp_path / "parsed"))
    files.write_results(rows_of.withColumn("source_record", printed(F.col("source_record"))), str(tmp_path / "ready"), codec="gzip", ready="source_record")
    read = lambda name: rows(spark.read.text(str(tmp_path / name)))
    assert read("ready") == read("parsed") and len(read("ready")) == len(ODD)
    files.append_audit(rows_of.select("run_id", F.parse_json("source_record").alias("request"), "llm_metrics"), str(tmp_path / "audit"))
    files.append_audit(rows_of.select("run_id", printed(F.col("source_record")).alias("request"), "llm_metrics"), str(tmp_path / "audit-ready"), ready="request")
    assert read("audit-ready") == read("audit")


def test_requests_are_printed_without_parsing_what_they_ask(spark):
    said = [*(t for t in ODD if t), 'ü {"role":"user","content":"y"}]}', ""]
    df = spark.createDataFrame([(a, b, p) for a in said for b in said for p in ("openai", "anthropic")], "prompt string, asked string, provider string")
    body = lambda by_name: judging.provider_request(F.col("provider"), F.col("prompt"), F.lit("m"), F.col("asked"), by_name=by_name)
    got = df.select(body(False).alias("r"), body(True).alias("by_name")).select("r", "by_name", printed(F.col("r")).alias("want"), judging.printed_request(F.col("r")).alias("got"))
    assert got.filter("got <=> want AND by_name <=> want").count() == len(said) ** 2 * 2
    other = spark.createDataFrame([('{"b":1,"a":2}',), ('{"role":"user","content":1}',), (None,)], "r string")
    assert rows(other.select(judging.printed_request(F.col("r")))) == [(None,), ('{"a":2,"b":1}',), ('{"content":1,"role":"user"}',)]


def test_a_run_prints_a_record_and_a_request_once(spark, tmp_path):
    lines = _records(spark, 30).withColumn("value", F.replace("value", F.lit('{"data"'), F.lit('{ "z":1, "data"')))
    prompts = _prompts(spark)
    run = lambda name, **more: run_checks(parse_records(lines), prompts, length_judge, run_id="r", batch_size=4, store=str(tmp_path / name), waves=3, **more)
    text, plain = run("a", as_text=True), run("b")
    assert dict(text.audit.dtypes)["request"] == "string" and dict(plain.audit.dtypes)["request"] == "variant"
    asked = lambda audit, request: rows(audit.select("check_name", request.alias("r"), "decision", "cost_usd", "is_invalid"))
    assert asked(text.audit, F.col("request")) == asked(plain.audit, F.to_json("request")) and text.audit.count() == 8 * len(CHECKS)
    of = lambda out, c: rows(judging.verdict_columns(out.results).select("check_name", "event_id", "result", "pos", c.alias("c")))
    assert of(text, F.col("source_record")) == of(plain, printed(F.col("source_record"))) and of(text, F.col("source_record")) != of(plain, F.col("source_record"))
    # the rows of a call are many more than its size tells: they are never broadcast
    assert "BroadcastHashJoin" not in text.results._jdf.queryExecution().executedPlan().toString()
    calls = spark.createDataFrame([("r/c/7", "c", "m", "q")], "call_id string, check_name string, model_spec string, request string")
    assert judging.judge(calls, fixed, only_answers=True).columns == ["call_id", "response", "latency_ms"]


def test_a_table_that_failed_to_be_staged_is_emptied_too(spark, tmp_path, monkeypatch):
    shared = Path(shared_dir(spark).removeprefix("file:")) / "recordqa"
    before, key = set(shared.iterdir()) if shared.exists() else set(), "spark.sql.maxConcurrentOutputFileWriters"
    usual = spark.conf.get(key)
    broken = spark.range(100).select(F.when(F.col("id") == 50, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("id")).alias("x"))
    with pytest.raises(PySparkException, match="lost"), scratch(spark):
        stage_table(broken, "broken")
    left = set(shared.iterdir()) - before
    assert len(left) == 1 and all(spark.read.parquet(str(d)).count() == 0 for d in left) and spark.conf.get(key) == usual
    with open_files(spark):
        assert int(spark.conf.get(key)) >= OPEN_FILES > len(CHECKS)
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path / "a b%20c"))
    free(stage_table(spark.range(5).toDF("x"), "kept"))
    assert [p.name for p in tmp_path.iterdir()] == ["a b%20c"]
    (kept,) = (tmp_path / "a b%20c" / "recordqa").iterdir()
    assert kept.name.startswith("kept") and sum(spark.read.parquet(str(f)).count() for f in kept.glob("*.parquet")) == 0


def test_lines_are_stripped_of_the_same_blanks(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(' {"a":1}\t\r\n\x0b\x0c{"a":2} \n\u00a0{"a":3}\u00a0\n  \n\u00a0\n{"a":4}\nx \n'.encode())
    assert rows(read_jsonl_lines(spark, str(tmp_path)), "value") == rows(spark.createDataFrame([(v,) for v in ('{"a":1}', '{"a":2}', '\u00a0{"a":3}\u00a0', '{"a":4}', "x")], "value string"))


# ---- the rest -------------------------------------------------------------
def test_prompt_names_are_those_of_the_files(spark, tmp_path):
    for name in ("a b_v1.txt", "a+b_v2.txt", "50%25_v3.txt", "ä_v4.txt"):
        (tmp_path / name).write_text("x")
    assert {r.file for r in prompt_registry(spark, str(tmp_path)).collect()} == {"a b_v1.txt", "a+b_v2.txt", "50%25_v3.txt", "ä_v4.txt"}


def test_stateful_resume_reads_no_history(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([("a", 1), ("b", 1), ("a", 1), (None, 1)], "event_id string, n int").write.parquet(src)
    stream = lambda: spark.readStream.schema("event_id string, n int").parquet(src)
    resume_stateful(stream(), out, state).awaitTermination()
    spark.createDataFrame([("b", 2), ("c", 2), ("c", 2)], "event_id string, n int").write.mode("append").parquet(src)
    query = resume_stateful(stream(), out, state)
    query.awaitTermination()
    assert rows(spark.read.parquet(out), "event_id", "n") == [("a", 1), ("b", 1), ("c", 2)]
    assert query.lastProgress is None or len(query.lastProgress["sources"]) == 1
    assert sum(p["numInputRows"] for p in query.recentProgress) == 3  # the second start reads its own files only


def test_upsert_keeps_the_first_sighting_and_takes_the_last_text(spark):
    kind = "event_id string, source_record_json string, first_seen_at int, last_seen_at int"
    old = spark.createDataFrame([("a", "old", 5, 6), ("z", "z", 1, 1)], kind)
    new = spark.createDataFrame([("a", "x", 4, 1), ("a", "y", 9, 1), ("a", "w", 9, 1), ("b", "b", 7, 2), (None, "n", 1, 1)], "event_id string, source_record_json string, seen_at int, n int")
    got = loading.upsert_records(old, new, ("seen_at", "n"))
    assert rows(got, "event_id", "source_record_json", "first_seen_at", "last_seen_at") == [("a", "y", 4, 9), ("b", "b", 7, 7), ("z", "z", 1, 1)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by" not in plan
    assert rows(loading.upsert_records(old, new.limit(0), ("seen_at", "n")), "event_id", "first_seen_at") == [("a", 5), ("z", 1)]


def test_merged_sketches_answer_without_the_data(spark):
    df = spark.range(40_000).select((F.col("id") % 4).alias("load"), (F.col("id") % 5000).alias("v"), F.sqrt(F.col("id") / 40_000).alias("x"))
    stored = sketches.distinct_sketches(df, ["v"], ["load"])
    assert stored.count() == 4
    found = sketches.merged_distinct(stored).first()
    assert found["rows"] == 40_000 and abs(found.distinct_estimate - 5000) <= 100
    quantiles = {r.share: r.value for r in sketches.merged_quantiles(sketches.quantile_sketches(df, "x", ["load"]), [0.25, 0.5]).collect()}
    assert quantiles[0.25] == pytest.approx(0.5, abs=0.01) and quantiles[0.5] == pytest.approx(0.7071, abs=0.01)


def test_leaders_are_exact_or_refused(spark, monkeypatch):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 5).otherwise(F.col("id")).cast("string").alias("v"))
    leaders = sketches.exact_leaders(df, "v", sketches.frequency_sketches(df, "v"), 3)
    want = df.groupBy("v").count().orderBy(F.desc("count"), "v").limit(3)
    assert rows(leaders, "value", "cnt") == rows(want)
    monkeypatch.setattr(sketches, "FOLLOWED", 100)
    flat = spark.range(5000).select(F.col("id").alias("v"))
    with pytest.raises(PySparkException, match="no leaders"):
        sketches.exact_leaders(flat, "v", sketches.frequency_sketches(flat, "v"), 3).collect()


def test_leaders_of_even_values_are_counted(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(sketches, "FOLLOWED", 100)
    df = spark.range(20_000).select(F.concat(F.lit("v"), (F.col("id") % 4_999).cast("string")).alias("v")).unionByName(
        spark.createDataFrame([(None,), ("v7",), ("v7",)], "v string")
    )
    leaders = sketches.exact_leaders(df, "v", sketches.frequency_sketches(df, "v"), 3, flat="count")
    assert rows(leaders, "value", "cnt", "n") == [("v0", 5, 20_002), ("v1", 5, 20_002), ("v7", 6, 20_002)]
    few = df.filter("v in ('v1', 'v7')")
    assert rows(sketches.exact_leaders(few, "v", sketches.frequency_sketches(few, "v"), 3, flat="count"), "value", "cnt") == [("v1", 5), ("v7", 6)]
    # the query itself, over more users than the sketch follows
    events = spark.range(4_000).select(
        F.col("id").alias("event_id"), F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'").alias("ts"), (F.col("id") % 1_999).alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k":1}').alias("props"),
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    got = rows(run_queries.frequent_events(spark, str(tmp_path)), "value", "cnt", "n")
    assert len(got) == 20 and got[:2] == [("E0", 3, 4_000), ("E1", 3, 4_000)]


def test_schema_drift_of_odd_lines(spark):
    lines = [("{bad",), ('{"data":[]}',), ('{"data":[{"attributes":{"summary":null,"headcount":1.5,"new":[1]}}]}',), (None,)]
    found = rows(conformance.schema_drift(spark.createDataFrame(lines, "value string")).where("rows > 0"))
    assert found == [("headcount", "NUMBER", 1, True, True), ("new", "ARRAY", 1, False, False), ("summary", "NULL", 1, True, True)]
    empty = conformance.schema_drift(spark.createDataFrame([], "value string"))
    assert empty.count() == len(conformance.DECLARED) and empty.where("rows > 0 OR fits").count() == 0


# ---- keyed tables ---------------------------------------------------------
def _reviews(spark, ids, label):
    return spark.createDataFrame(
        [(i, f"e{i}", CHECKS[0], label, "me", None) for i in ids],
        "quality_result_id long, event_id string, check_name string, human_label string, reviewer string, notes string",
    )


def _files(folder):
    return {str(f.relative_to(folder)) for f in folder.rglob("*.parquet")}


def test_keyed_tables_are_cut_finer_as_they_grow(spark, tmp_path):
    wh, folder = Warehouse(spark, str(tmp_path), bucket_rows=10), tmp_path / "human_review_labels"
    wh.init()
    table = lambda: rows(wh.table("human_review_labels"), "quality_result_id", "human_label")
    assert table() == [] and wh.buckets("human_review_labels") == 1
    wh.label(_reviews(spark, range(5), "approve_fail"))
    assert wh.buckets("human_review_labels") == 1 and len(table()) == 5
    wh.label(_reviews(spark, range(3, 60), "override_pass"))
    want = {i: "override_pass" if i >= 3 else "approve_fail" for i in range(60)}
    assert wh.buckets("human_review_labels") == 8 and dict(table()) == want and len(table()) == 60
    before = _files(folder / "buckets=8")
    assert len(before) == 8 and _files(folder / "buckets=1") == set()  # what is no longer read is gone
    wh.label(_reviews(spark, [7], "reject_record"))  # one key: one bucket is written anew
    after = _files(folder / "buckets=8")
    assert len(before - after) == 1 and len(after - before) == 1 and dict(table()) == {**want, 7: "reject_record"}


@pytest.mark.parametrize("stage", ["quality", "remediations"])
def test_a_load_parses_its_lines_once(spark, tmp_path, stage):
    wh, seen = Warehouse(spark, str(tmp_path)), spark.sparkContext.accumulator(0)
    wh.init()

    def line(n: int) -> str:
        seen.add(1)
        return json.dumps({"event_id": f"e{n % 4}" if n % 5 else None, "result": "fail", "confidence": 0.5})

    said = F.try_parse_json(F.udf(line)("n"))
    lines = spark.range(20).select(
        F.col("id").alias("n"), F.lit("semantic_accuracy").alias("check_name"), F.lit("r").alias("run_id"), F.lit("2025-01-01T00:00:00Z").alias("created_at"),
        *[F.lit("x").alias(c) for c in ("prompt_version", "prompt_file", "model", "llm_metrics", "file_name")], F.concat(F.lit('{"n":'), "id", F.lit("}")).alias("source_record"),
        F.lit(0).cast("bigint").alias("block_start"), F.col("id").alias("line_id"), F.lit("{}").alias("remediation"),
    )
    if stage == "quality":
        wh.load_quality(lines.withColumn("llm_check", said))
    else:
        wh.load_remediations(lines.withColumn("failed_check", said))
    assert seen.value == 20
    assert rows(wh.table("records"), "event_id", "source_record_json") == [(f"e{k}", f'{{"n":{n}}}') for k, n in ((0, 16), (1, 17), (2, 18), (3, 19))]
    table = wh.table("llm_quality_results" if stage == "quality" else "llm_remediation_results")
    assert table.count() == (16 if stage == "quality" else 20)


def test_a_finer_layout_that_was_not_committed_is_not_read(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.init()
    wh.label(_reviews(spark, range(4), "approve_fail"))
    stray = wh.table("human_review_labels").limit(2)
    stray.write.parquet(str(tmp_path / "human_review_labels" / "buckets=2" / "bucket=0"))  # a load was lost here
    assert len(rows(wh.table("human_review_labels"))) == 4
    finer = Warehouse(spark, str(tmp_path), bucket_rows=2)
    finer.label(_reviews(spark, [9], "reject_record"))
    assert finer.buckets("human_review_labels") == 4 and len(rows(finer.table("human_review_labels"))) == 5


def test_sample_is_exact_for_copies_and_for_all(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("value"))
    for n in (1, 40, 2999, 3000, 9000):
        one = rows(sampling.sample_records(df, n, seed=5, key=("value",)))
        assert len(one) == min(n, 3000) and one == rows(sampling.sample_records(df.repartition(9), n, seed=5, key=("value",)))
    few, many = rows(sampling.sample_records(df, 60, seed=5, key=("value",))), sampling.FEW
    sampling.FEW = 10
    try:
        assert few == rows(sampling.sample_records(df, 60, seed=5, key=("value",)))  # either way of ranking
    finally:
        sampling.FEW = many
    assert sampling.sample_records(df.limit(0), 5, key=("value",)).collect() == []
