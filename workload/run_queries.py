"""Queries over whole runs: quarantine, waves, fallback, near duplicates, drift, stored sketches."""

from __future__ import annotations

import json
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from recordqa.operators import conformance, judging, loading, metrics, near_stories, profile, remediation, sketches
from recordqa.plans.checks import run_checks
from recordqa.plans.full_run import run_all
from recordqa.plans.remediation import run_remediation
from recordqa.schema import CHECKS
from recordqa.session import stage_table
from recordqa.sinks import files
from recordqa.sources.lines import parse_records, read_all_checks, read_all_remediations, read_results
from recordqa.sources.prompts import latest_prompts, prompt_registry
from recordqa.streaming.triage import resume_stateful
from workload import judge_queries
from workload.judge_queries import ROUTING, length_judge
from workload.round_trips import _envelopes, _folder
from workload.views import flat_records, nested_lines, read, results_view, with_views

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(judge_queries)

LOST_WAVE, WAVES = 2, 4


# ---- stand-in judges ------------------------------------------------------
def losing_judge(requests: pd.DataFrame) -> pd.DataFrame:
    """Fails in one of the waves."""
    if any(int(c.rsplit("/", 1)[1]) % WAVES == LOST_WAVE for c in requests["call_id"]):
        raise RuntimeError("lost")
    return length_judge(requests)


def second_judge(requests: pd.DataFrame) -> pd.DataFrame:
    """As the first, but its reasons say that it was the second."""

    def again(body: str) -> str:
        doc = json.loads(body)
        if "choices" in doc:
            text = doc["choices"][0]["message"]["content"]
        else:
            text = "".join(part.get("text", "") for part in doc["content"])
        provider = "openai" if "choices" in doc else "anthropic"
        return judge_queries._body(provider, json.loads(text.replace("by length", "asked again"))["results"], doc["usage"])

    return length_judge(requests).assign(response=lambda x: x["response"].map(again))


def _rows_of(request: str) -> list:
    return json.loads(json.loads(request)["messages"][-1]["content"].split("INPUT:\n", 1)[1])["failed_records"]


def breaking_judge(requests: pd.DataFrame) -> pd.DataFrame:
    """Remediation as in ``fix_judge``; large requests break by the parity of their row numbers, small ones by sevens."""
    out = judge_queries.fix_judge(requests)
    for n, request in enumerate(requests["request"]):
        ids = [int(r["failed_check"]["reason"]) for r in _rows_of(request)]
        if sum(ids) % (2 if len(ids) > 3 else 7) == 0:
            out.loc[n, "response"] = '{"choices":[{"message":{"content":"{no json"}}]}'
    return out


def label_judge(requests: pd.DataFrame) -> pd.DataFrame:
    """Corrects the label of every event."""
    bodies = [
        judge_queries._body("openai", [{"event_id": r["event_id"], "decision": "correct_label", "confidence": 0.8} for r in _rows_of(request)], {})
        for request in requests["request"]
    ]
    return pd.DataFrame({"call_id": requests["call_id"], "response": bodies, "latency_ms": 1.0})


# ---- judge stage ----------------------------------------------------------
def check_waves(spark, sf):
    """A run is lost in its third wave and started again: calls of committed waves are not made twice."""
    records, prompts, store = parse_records(nested_lines(spark, sf)), judge_queries._prompts(spark), _folder(spark, "calls")
    run = lambda judge: run_checks(records, prompts, judge, routing=ROUTING, run_id="run", store=store, waves=WAVES)
    try:
        run(losing_judge)
    except PySparkException as err:
        if "lost" not in str(err):
            raise
    out = run(second_judge)
    return judging.verdict_columns(out.results).select("check_name", "event_id", "pos", "result", "reason")


def check_doubled_responses(spark, sf):
    """Every stored response is there twice, once without text: results and audit are those of one."""
    records, prompts = parse_records(nested_lines(spark, sf)), judge_queries._prompts(spark)
    first = run_checks(records, prompts, length_judge, routing=ROUTING, run_id="run").responses
    twice = first.unionByName(first).unionByName(first.withColumn("response", F.lit(None).cast("string")))
    run = run_checks(records, prompts, responses=twice, routing=ROUTING, run_id="run")
    calls = run.audit.groupBy("check_name").agg(F.count("*").alias("n_calls"))
    return judging.verdict_columns(run.results).groupBy("check_name", "result").agg(F.count("*").alias("n")).join(calls, "check_name")


def check_near_context(spark, sf):
    """What the source check is told of each record when near copies count."""
    batches = judging.record_batches(parse_records(nested_lines(spark, sf)), 10, with_duplicates=True, duplicate_threshold=0.8)
    member = batches.select(F.explode("members").alias("m"))
    return member.select("m.event_id", F.col("m.dedupe_context.possible_duplicate_count").alias("possible_duplicate_count"))


# ---- remediation ----------------------------------------------------------
def _broken_run(spark, sf):
    rows = judge_queries._failing(spark, sf)
    return run_remediation(rows, "Fix.", breaking_judge, run_id="fix", order=("id",), mode="quarantine", fallback_chunk=3)


def remediation_invalid_answers(spark, sf):
    """Broken calls are asked again in threes; what breaks again gets the default."""
    return _broken_run(spark, sf).remediations.select(
        "check_name", "event_id", F.try_variant_get("failed_check", "$.reason", "bigint").alias("id"),
        F.try_variant_get("remediation", "$.decision", "string").alias("decision"),
    )


def remediation_fallback_audit(spark, sf):
    audit = _broken_run(spark, sf).audit
    return audit.groupBy("check_name", F.coalesce("note", F.lit("")).alias("note")).agg(
        F.count("*").alias("n_calls"), F.count_if("is_invalid").alias("n_invalid")
    )


def remediation_of_runs(spark, sf):
    """Failures of two runs only."""
    rows = judge_queries._failing(spark, sf).join(results_view(spark, sf).select("id", "run_id"), "id")
    run = run_remediation(rows, "Fix.", judge_queries.fix_judge, run_id="fix", order=("id",), runs=["R03", "R08"])
    return run.remediations.select("check_name", F.try_variant_get("failed_check", "$.reason", "bigint").alias("id"))


def remediation_paths(spark, sf):
    """Patches of attributes of every kind, every third with a stale old value."""
    d = F.col("doc_id")
    path = F.when(d % 4 == 0, "summary").when(d % 4 == 1, "confidence").when(d % 4 == 2, "found_at").otherwise("headcount")
    found = F.date_format(F.timestamp_seconds(F.lit(1751846400) + d), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    old = F.when(d % 4 == 0, F.to_json(F.struct(F.col("summary").alias("v")))).when(d % 4 == 1, F.to_json(F.struct(F.col("confidence").alias("v"))))
    old = old.when(d % 4 == 2, F.to_json(F.struct(found.alias("v")))).otherwise(F.lit('{"v":null}'))
    patch = F.concat(
        F.lit('{"decision":"correct_label","proposed_patch":{"path":"attributes.'), path, F.lit('","old_value":'),
        F.when(d % 3 == 0, F.lit('"stale"')).otherwise(F.substr(old, F.lit(6), F.length(old) - 6)),
        F.lit(',"new_value":1},"reasoning":"r","confidence":0.5,"evidence_spans":[],"review_recommended":true}'),
    )
    lines = nested_lines(spark, sf).select(F.col("line_id").alias("doc_id"), F.col("value").alias("source_record"))
    rows = flat_records(spark, sf).select("doc_id", F.parse_json(patch).alias("remediation")).join(lines, "doc_id")
    return remediation.remediation_violations(rows).select("doc_id", F.array_join(F.array_sort("violations"), ",").alias("violations"))


# ---- files and whole runs -------------------------------------------------
def _put(spark: SparkSession, path: str, text: str) -> None:
    """Writes one small file of a given name, wherever Spark can write."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(text.encode()))
    out.close()


def prompt_files(spark, sf):
    """A prompt per nation, named after its region, and a file that is no prompt."""
    folder = _folder(spark, "prompts")
    nations = read(spark, sf, "nation").join(read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    for r in nations.select("n_nationkey", "n_name", "r_name").collect():  # at most 25
        _put(spark, f"{folder}/{r.r_name}_v{r.n_nationkey}.txt", f"Rules of {r.n_name}.\nSecond line.")
    _put(spark, f"{folder}/notes.txt", "no prompt")
    registry = prompt_registry(spark, folder)
    latest = latest_prompts(registry).select(F.col("file").alias("newest"))
    return registry.join(latest, registry["file"] == latest["newest"], "left").select(
        "base", "version", "version_num", "file", "text", F.col("newest").isNotNull().alias("is_latest")
    )


def results_file(spark, sf):
    """One results path, and one that does not exist."""
    base = _folder(spark, "results-file")
    files.write_results(_envelopes(spark, sf), base)
    one = read_results(spark, f"{base}/check_name=entity_resolution")
    none = read_results(spark, f"{base}/nothing.jsonl")
    return judging.verdict_columns(one.unionByName(none)).select("run_id", "event_id", "result", "confidence")


def pipeline_run(spark, sf):
    """Lines to remediations with every 13th line cut short: counts of all that was written."""
    base = _folder(spark, "run")
    for check in (*CHECKS, "remediation"):
        _put(spark, f"{base}/prompts/{check}_v1.txt", f"Rules of {check}.")
    broken = F.when(F.col("line_id") % 13 == 0, F.left("value", F.length("value") - 1)).otherwise(F.col("value"))
    lines = nested_lines(spark, sf).withColumn("value", broken)
    done = run_all(
        spark, lines, f"{base}/prompts", f"{base}/out", length_judge, label_judge, run_id="20250101T000000Z", mode="quarantine", this_run_only=True
    )
    counted = lambda df, stage, name: df.groupBy(F.lit(stage).alias("stage"), name.alias("name")).agg(F.count("*").alias("n"))
    log = spark.read.json(f"{base}/out/logs/triage")
    results = judging.verdict_columns(read_all_checks(spark, done.results_dir))
    fixes = loading.to_remediation_rows(read_all_remediations(spark, done.remediations_dir))
    parts = [
        counted(log, "triage", F.col("decision")),
        counted(spark.read.schema("run_id string, value string").json(done.quarantine_path), "quarantine", F.col("run_id")),
        counted(results, "result", F.concat_ws(":", "check_name", "result")),
        counted(fixes, "remediation", F.get_json_object("remediation_json", "$.decision")),
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def resume_stateful_ids(spark, sf):
    """Two starts from one checkpoint: an event of the first is not handed out by the second."""
    base = _folder(spark, "resume-state")
    rows = results_view(spark, sf).select("event_id", F.when(F.col("run_id") < "R05", 1).otherwise(2).alias("part"))
    for part in (1, 2):
        rows.filter(F.col("part") == part).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema("event_id string, part int").parquet(f"{base}/in")
        resume_stateful(stream, f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.schema("event_id string, part int").parquet(f"{base}/out")


# ---- profiles -------------------------------------------------------------
def near_duplicate_counts(spark, sf):
    """Copies and near copies of the first line of each document."""
    return near_stories.near_duplicate_counts(flat_records(spark, sf)).select("doc_id", "possible_duplicate_count", "similar_stories")


def near_links(spark, sf):
    return near_stories.near_links(flat_records(spark, sf)).select("a", "b", F.round("similarity", 9).alias("similarity"))


def schema_drift(spark, sf):
    """Every fifth event names its confidence otherwise, every seventh has it as text."""
    d, v = F.col("line_id"), F.col("value")
    texts = F.regexp_replace(v, '"confidence":([0-9.]+)', '"confidence":"$1"')
    other = F.when(d % 5 == 0, F.replace(v, F.lit('"confidence":'), F.lit('"confidence_score":'))).when(d % 7 == 0, texts).otherwise(v)
    return conformance.schema_drift(nested_lines(spark, sf).withColumn("value", other))


def distinct_merged(spark, sf):
    """Distinct counts merged from one sketch per run, beside the exact ones."""
    rows, fields = results_view(spark, sf), ["id", "event_id", "confidence", "result"]
    stored = stage_table(sketches.distinct_sketches(rows, fields, ["run_id"]), "distinct-sketches")
    exact = profile.uniqueness_profile(rows, fields).select("field", "distinct_values")
    error = F.abs(F.col("distinct_estimate") - F.col("distinct_values")) / F.col("distinct_values")
    return sketches.merged_distinct(stored).join(exact, "field").select("field", "rows", "nulls", "distinct_values", (error <= 0.02).alias("is_within"))


def quantiles_merged(spark, sf):
    """Quantiles of the confidence per check, merged over runs, with the exact ranks of what was found."""
    rows = results_view(spark, sf)
    stored = stage_table(sketches.quantile_sketches(rows, "confidence", ["check_name", "prompt_version", "run_id"]), "quantile-sketches")
    found = stage_table(sketches.merged_quantiles(stored, [0.05, 0.25, 0.5, 0.75, 0.95], ["check_name"]), "quantiles")
    both = rows.filter("confidence IS NOT NULL").select("check_name", "confidence").join(found, "check_name")
    ranks = both.groupBy("check_name", "share", "n").agg(
        F.count_if(F.col("confidence") < F.col("value")).alias("_below"), F.count_if(F.col("confidence") <= F.col("value")).alias("_upto")
    )
    near = (F.col("_below") <= F.col("n") * (F.col("share") + 0.01)) & (F.col("_upto") >= F.col("n") * (F.col("share") - 0.01))
    return ranks.select("check_name", "share", "n", near.alias("is_within"))


def frequent_events(spark, sf):
    """The twenty events with most results, from one sketch per run and one exact pass, or two where no event leads by much."""
    rows = results_view(spark, sf)
    stored = stage_table(sketches.frequency_sketches(rows, "event_id", ["run_id"]), "frequency-sketches")
    return sketches.exact_leaders(rows, "event_id", stored, 20, flat="count")


def trend_rollup(spark, sf):
    return metrics.trend_rollup(results_view(spark, sf))


QUERIES = {
    f.__name__: f
    for f in (
        check_waves, check_doubled_responses, check_near_context, remediation_invalid_answers, remediation_fallback_audit,
        remediation_of_runs, remediation_paths, prompt_files, results_file, pipeline_run, resume_stateful_ids, near_duplicate_counts,
        near_links, schema_drift, distinct_merged, quantiles_merged, frequent_events, trend_rollup,
    )
}

# ---- SQL twins ------------------------------------------------------------
_more, _BATCHED = judge_queries._more, judge_queries._BATCHED

_NEAR = r"""
forms as (select doc_id, event_id, nullif(trim(regexp_replace(lower(article_sentence), '[^\p{L}\p{N}]+', ' ', 'g')), '') f from rec %s),
told as (select f, count(*) copies, string_split(f, ' ') w from forms where f is not null group by f),
grams as (select distinct f, array_to_string(w[i:i + 4], ' ') g from (select f, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) i from told)),
sizes as (select f, count(*) n from grams group by f),
pairs as (select x.f fa, y.f fb, count(*) c from grams x join grams y on x.g = y.g and x.f <> y.f group by 1, 2),
links as (select fa, fb, c / (a.n + b.n - c) similarity from pairs join sizes a on a.f = fa join sizes b on b.f = fb where c / (a.n + b.n - c) >= 0.8),
near as (select fa, CAST(sum(copies) AS BIGINT) others, count(*) n_stories from links join told on f = fb group by fa),
counted as (select doc_id, event_id, case when m.f is null then 0 else copies - 1 + coalesce(others, 0) end possible_duplicate_count,
  coalesce(n_stories, 0) similar_stories from forms m left join told using (f) left join near on fa = m.f)"""

_LOST = """
fl as (select *, row_number() over (partition by check_name order by id) - 1 pos from qr where result = 'fail'),
b1 as (select *, pos // 10 batch_id, pos % 10 // 3 part, sum(id) over (partition by check_name, pos // 10) s, count(*) over (partition by check_name, pos // 10) n from fl),
b2 as (select *, s % case when n > 3 then 2 else 7 end = 0 broken, sum(id) over (partition by check_name, batch_id, part) ps from b1),
fb as (select *, broken and ps % 7 = 0 lost from b2)"""

_DECLARED = ", ".join(
    f"('{name}', '{'NUMBER' if kind in ('DOUBLE', 'BIGINT') else kind}')" for name, kind in conformance.DECLARED.items()
)

ORACLE = {
    "check_waves": _more("rec", _BATCHED) + f"""
select check_name, event_id, pos, case when len % 7 = 0 or len % 3 = 0 then 'fail' else 'pass' end result,
  case when len % 7 = 0 then 'No valid model result returned for this row.' when batch_id % {WAVES} < {LOST_WAVE} then 'by length'
    else 'asked again' end reason from eb, ck""",
    "check_doubled_responses": _more("rec", _BATCHED) + """
select check_name, case when len % 7 = 0 or len % 3 = 0 then 'fail' else 'pass' end result, count(*) n,
  (select count(*) from calls) n_calls from eb, ck group by 1, 2""",
    "check_near_context": _more("rec", _NEAR % "where event_id <> ''") + "select event_id, possible_duplicate_count from counted",
    "near_duplicate_counts": _more("rec", _NEAR % "") + "select doc_id, possible_duplicate_count, similar_stories from counted",
    "near_links": _more("rec", _NEAR % "")
        + "select md5(fa) a, md5(fb) b, round(similarity, 9) similarity from links where md5(fa) < md5(fb)",
    "remediation_invalid_answers": _more("qr", _LOST, """
la as (select check_name, event_id, max(id) filter (id % 9 <> 0 and not lost) last_id from fb group by 1, 2)""") + """
select check_name, event_id, id, case when last_id is null then 'no_change' else case last_id % 4 when 0 then 'correct_label'
  when 1 then 'correct_entity_link' when 2 then 'mark_low_credibility' else 'no_change' end end decision
from fb join la using (check_name, event_id)""",
    "remediation_fallback_audit": _more("qr", _LOST) + """
select check_name, '' note, count(distinct batch_id) n_calls, count(distinct batch_id) filter (broken) n_invalid from fb group by 1
union all
select check_name, 'chunked_fallback', count(distinct (batch_id, part)), count(distinct (batch_id, part)) filter (lost)
from fb where broken group by 1""",
    "remediation_of_runs": with_views("select check_name, id from qr where result = 'fail' and run_id in ('R03', 'R08')", "qr"),
    "remediation_paths": "select doc_id, 'stale_old_value' violations from documents where doc_id % 3 = 0",
    "prompt_files": """
select r_name base, concat('v', n_nationkey) "version", CAST(n_nationkey AS INT) version_num, concat(r_name, '_v', n_nationkey, '.txt') file,
  concat('Rules of ', n_name, '.', chr(10), 'Second line.') "text", n_nationkey = max(n_nationkey) over (partition by r_name) is_latest
from nation join region on n_regionkey = r_regionkey""",
    "results_file": with_views("select run_id, event_id, result, confidence from qr where check_name = 'entity_resolution'", "qr"),
    "pipeline_run": _more("rec", """
ok as (select *, event_id = '' or coalesce(category, '') = '' or article_sentence = '' bad, length(summary) len from rec where doc_id % 13 <> 0),
ck as (select unnest(['semantic_accuracy', 'entity_resolution', 'source_credibility']) check_name),
rs as (select check_name, len % 7 = 0 or len % 3 = 0 failed from ok, ck where not bad)""") + """
select 'triage' stage, case when bad then 'fail' else 'escalate' end "name", count(*) n from ok group by 2
union all select 'quarantine', '20250101T000000Z', count(*) from rec where doc_id % 13 = 0 having count(*) > 0
union all select 'result', concat(check_name, ':', case when failed then 'fail' else 'pass' end), count(*) from rs group by 2
union all select 'remediation', 'correct_label', count(*) from rs where failed having count(*) > 0""",
    "resume_stateful_ids": with_views(
        "select event_id, CAST(min(case when run_id < 'R05' then 1 else 2 end) AS INT) part from qr where event_id is not null group by 1", "qr"),
    "schema_drift": _more("rec", f"""
decl as (select * from (values {_DECLARED}) t(attribute, kind)),
seen as (
  select 'summary' attribute, 'STRING' kind from rec where summary is not null union all select 'category', 'STRING' from rec where category is not null
  union all select 'article_sentence', 'STRING' from rec where article_sentence is not null union all select 'found_at', 'STRING' from rec
  union all select 'effective_date', 'STRING' from rec where doc_id % 3 = 0
  union all select case when doc_id % 5 = 0 then 'confidence_score' else 'confidence' end,
    case when doc_id % 5 <> 0 and doc_id % 7 = 0 then 'STRING' else 'NUMBER' end from rec)""") + """
select coalesce(s.attribute, d.attribute) attribute, s.kind, coalesce(s.n, 0) "rows", d.attribute is not null declared,
  coalesce(s.kind = d.kind, false) fits
from (select attribute, kind, count(*) n from seen group by 1, 2) s full join decl d on s.attribute = d.attribute""",
    "distinct_merged": with_views("""
select field, count(*) "rows", count(*) - count(v) nulls, count(distinct v) distinct_values, true is_within from (
  select 'id' field, CAST(id AS VARCHAR) v from qr union all select 'event_id', event_id from qr
  union all select 'confidence', CAST(confidence AS VARCHAR) from qr union all select 'result', result from qr) group by 1""", "qr"),
    "quantiles_merged": with_views("""
select check_name, CAST(share AS DOUBLE) share, count(*) n, true is_within from qr, (select unnest([0.05, 0.25, 0.5, 0.75, 0.95]) share)
where confidence is not null group by 1, 2""", "qr"),
    "frequent_events": with_views("""
select event_id "value", count(*) cnt, count(*) / (select count(*) from qr where event_id is not null) "share",
  (select count(*) from qr where event_id is not null) n from qr where event_id is not null group by 1 order by cnt desc, event_id limit 20""", "qr"),
    "trend_rollup": with_views("""
select 'hour' "level", strftime(date_trunc('hour', created_at), '%Y-%m-%d %H:00') bucket, check_name, result, count(*) cnt from qr where created_at is not null group by 1, 2, 3, 4
union all select 'day', strftime(created_at, '%Y-%m-%d'), check_name, result, count(*) from qr where created_at is not null group by 1, 2, 3, 4
union all select 'check', null, check_name, null, count(*) from qr where created_at is not null group by check_name
union all select 'verdict', null, null, result, count(*) from qr where created_at is not null group by result
union all select 'total', null, null, null, count(*) from qr where created_at is not null""", "qr"),
}
