"""Queries over results, labels and audit rows, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recordqa.operators import drift, metrics, review
from recordqa.operators.cost import with_cost
from recordqa.schema import CHECKS
from workload.views import audit_view, labels_view, results_view, with_views

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _text_time(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, STAMP) for c in cols})


def _duck_time(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def _joined(spark, sf):
    return review.labelled_results(labels_view(spark, sf), results_view(spark, sf))


JOINED = "hr h join qr q on q.id = h.quality_result_id"


def backlog(spark, sf):
    return _text_time(review.backlog(results_view(spark, sf), labels_view(spark, sf)), "last_seen_at")


def backlog_all(spark, sf):
    """Whole backlog, without the screen's top 200."""
    out = review.backlog(results_view(spark, sf), labels_view(spark, sf), n=None)
    return _text_time(out, "last_seen_at")


def backlog_view(spark, sf):
    rows = results_view(spark, sf).withColumn("reason", F.lit(None).cast("string"))
    return _text_time(review.backlog_view(rows), "created_at")


def review_queue(spark, sf):
    out = review.review_queue(results_view(spark, sf), labels_view(spark, sf), "semantic_accuracy", 200)
    return _text_time(out, "created_at")


def kpi_points(spark, sf):
    return metrics.kpi_points(results_view(spark, sf))


def kpi_points_run(spark, sf):
    return metrics.kpi_points(results_view(spark, sf), "R04")


def _costed(spark, sf):
    return with_cost(audit_view(spark, sf))


def kpi_calls(spark, sf):
    out = metrics.kpi_calls(_costed(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in ("total_cost", "avg_latency_ms")})


def kpi_calls_run(spark, sf):
    out = metrics.kpi_calls(_costed(spark, sf), "R04")
    return out.withColumns({c: F.round(c, 6) for c in ("total_cost", "avg_latency_ms")})


def trend_hour(spark, sf):
    return metrics.trend(results_view(spark, sf), "hour")


def trend_day(spark, sf):
    return metrics.trend(results_view(spark, sf), "day")


def trend_wide(spark, sf):
    return metrics.trend_wide(metrics.trend(results_view(spark, sf), "day"))


def failures_by_check(spark, sf):
    return metrics.failures_by_check(results_view(spark, sf))


def failures_by_check_run(spark, sf):
    return metrics.failures_by_check(results_view(spark, sf), "R02")


def failures_total(spark, sf):
    return metrics.failures_total(metrics.failures_by_check(results_view(spark, sf)))


def run_ids(spark, sf):
    return metrics.run_ids(results_view(spark, sf))


def latest_run(spark, sf):
    return drift.latest_run(results_view(spark, sf))


def last_per_event(spark, sf):
    out = drift.last_per_event(drift.has_run_key(results_view(spark, sf)))
    return out.select("check_name", "prompt_version", "run_id", "event_id", "id", "result", "confidence")


def _rounded(df):
    return df.withColumns(
        {c: F.round(c, 6) for c in ("decision_changed_rate", "avg_confidence_delta_candidate_minus_base")}
    )


def drift_summary(spark, sf):
    return _rounded(drift.drift_summary(results_view(spark, sf)))


def drift_summary_screen(spark, sf):
    return _rounded(drift.drift_summary(results_view(spark, sf), null_mode="null_changed", dedupe=False))


def drift_missing_run(spark, sf):
    return _rounded(drift.drift_summary(results_view(spark, sf), "v1", "v9"))


def compare_runs(spark, sf):
    return drift.compare_runs(results_view(spark, sf))


def common_ids(spark, sf):
    return drift.common_ids(results_view(spark, sf))


def drift_examples(spark, sf):
    return drift.drift_examples(drift.compare_runs(results_view(spark, sf)))


def drift_examples_screen(spark, sf):
    return drift.drift_examples_screen(results_view(spark, sf))


def labelled_set(spark, sf):
    return _text_time(review.labelled_set(labels_view(spark, sf), results_view(spark, sf)), "labeled_at")


def label_distribution(spark, sf):
    return review.label_distribution(_joined(spark, sf))


def review_totals(spark, sf):
    return review.review_totals(_joined(spark, sf))


def by_reviewer(spark, sf):
    return review.by_reviewer(_joined(spark, sf))


def active_reviewers(spark, sf):
    return review.active_reviewers(_joined(spark, sf))


def recent_reviews(spark, sf):
    return _text_time(review.recent_reviews(_joined(spark, sf)), "labeled_at")


def export_totals(spark, sf):
    return review.export_totals(labels_view(spark, sf))


def export_breakdown(spark, sf):
    return review.export_breakdown(labels_view(spark, sf))


def review_metrics(spark, sf):
    return review.review_metrics(_joined(spark, sf))


def upsert_labels(spark, sf):
    """A second round of labels replaces every third one and adds unseen results."""
    old = labels_view(spark, sf)
    new = old.filter("quality_result_id % 30 = 0").withColumns(
        {
            "human_label": F.lit("approve_fail"),
            "reviewer": F.lit("reviewer_9"),
            "labeled_at": F.expr("labeled_at + INTERVAL '1' DAY"),
        }
    )
    added = old.filter("quality_result_id % 50 = 0").withColumn(
        "quality_result_id", F.col("quality_result_id") + 5
    )
    return _text_time(review.upsert_labels(old, new.unionByName(added)), "labeled_at")


QUERIES = {
    f.__name__: f
    for f in (
        backlog, backlog_all, backlog_view, review_queue, kpi_points, kpi_points_run, kpi_calls, kpi_calls_run,
        trend_hour, trend_day, trend_wide, failures_by_check, failures_by_check_run, failures_total, run_ids,
        latest_run, last_per_event, drift_summary, drift_summary_screen, drift_missing_run, compare_runs,
        common_ids, drift_examples, drift_examples_screen, labelled_set, label_distribution, review_totals,
        by_reviewer, active_reviewers, recent_reviews, export_totals, export_breakdown, review_metrics,
        upsert_labels,
    )
}

# ---- SQL twins ------------------------------------------------------------
_BACKLOG = """
select q.event_id, q.run_id, count(*) failed_checks, min(q.confidence) min_confidence,
       {seen} last_seen_at
from qr q left join hr h on h.quality_result_id = q.id
where q.result = 'fail' and h.quality_result_id is null {extra}
group by q.event_id, q.run_id"""

_COST = """costed as (
select *, case when provider = 'openai' then
    prompt_tokens / 1000.0::DOUBLE * case model when 'gpt-4o-mini' then 0.00015::DOUBLE when 'gpt-4o' then 0.005::DOUBLE
                                when 'gpt-4.1' then 0.01::DOUBLE end
  + completion_tokens / 1000.0::DOUBLE * case model when 'gpt-4o-mini' then 0.0006::DOUBLE when 'gpt-4o' then 0.015::DOUBLE
                                when 'gpt-4.1' then 0.03::DOUBLE end end cost_usd
from au)"""

_KPI_CALLS = """
select count(*) calls, round(coalesce(sum(cost_usd), 0), 6) total_cost,
  round(coalesce(avg(case when stage = 'quality_check' then latency_ms end), 0), 6) avg_latency_ms
from costed where {where}"""

# latest run of either version, then the rows of those runs
_RUNS = """
latest as (select check_name, prompt_version, max(run_id) run_id from qr group by all),
picked as (select q.* from qr q join latest l using (check_name, prompt_version, run_id)),
lastrow as (select * from (select *, row_number() over (partition by check_name, prompt_version, run_id, event_id
             order by created_at desc, id desc) r from picked) where r = 1),
runs as (select check_name, max(case when prompt_version = 'v1' then run_id end) base_run_id,
                max(case when prompt_version = 'v2' then run_id end) candidate_run_id from latest group by 1)"""

_PAIRS = """
pairs as (select b.check_name, b.event_id, b.result base_result, c.result candidate_result,
                 b.confidence base_confidence, c.confidence candidate_confidence, b.id bid, c.id cid
          from {src} b join {src} c on b.check_name = c.check_name and b.event_id = c.event_id
          where b.prompt_version = 'v1' and c.prompt_version = 'v2')"""

_SUMMARY = """
select r.check_name, r.base_run_id, r.candidate_run_id,
  (select count(*) from {src} x where x.check_name = r.check_name and prompt_version = 'v1') base_rows,
  (select count(*) from {src} x where x.check_name = r.check_name and prompt_version = 'v2') candidate_rows,
  s.common_rows, s.decision_changed_count,
  round(s.decision_changed_count / s.common_rows, 6) decision_changed_rate,
  round(s.delta, 6) avg_confidence_delta_candidate_minus_base, 'ok' status
from runs r join (
  select check_name, count(*) common_rows,
    count(*) filter ({changed}) decision_changed_count,
    avg(candidate_confidence - base_confidence) delta
  from pairs group by 1) s using (check_name)"""

SCRIPT_CHANGED = "base_result is distinct from candidate_result"
SCREEN_CHANGED = "coalesce(base_result <> candidate_result, true)"


def _examples(changed: str, order: str) -> str:
    return f"""
select check_name, event_id, base_result, candidate_result, base_confidence, candidate_confidence, rank from (
  select *, CAST(row_number() over (partition by check_name order by {order}) AS INT) rank
  from pairs where {changed}) where rank <= 10"""


def _wide() -> str:
    cells = ", ".join(
        f"count(*) filter (check_name = '{c}' and result = '{v}') \"{c}__{v}\"" for c in CHECKS for v in ("pass", "fail")
    )
    return f"select strftime(created_at, '%Y-%m-%d') bucket, {cells} from qr where result is not null group by 1"


_POINTS = """select count(distinct event_id) total_points,
  count(distinct case when result = 'fail' then event_id end) failed_points,
  greatest(count(distinct event_id) - count(distinct case when result = 'fail' then event_id end), 0) clean_points
from qr where {where}"""

ORACLE = {
    "backlog": with_views(
        _BACKLOG.format(seen=_duck_time("max(q.created_at)"), extra="")
        + " order by max(q.created_at) desc, q.event_id, q.run_id limit 200", "qr", "hr"),
    "backlog_all": with_views(
        _BACKLOG.format(seen=_duck_time("max(q.created_at)"), extra=""), "qr", "hr"),
    "backlog_view": with_views(
        f"select event_id, run_id, check_name, result, confidence, CAST(null AS VARCHAR) reason, "
        f"{_duck_time('created_at')} created_at from qr where result = 'fail'", "qr"),
    "review_queue": with_views(
        f"select q.id quality_result_id, q.event_id, q.run_id, q.check_name, q.prompt_version, q.result, q.confidence, "
        f"{_duck_time('q.created_at')} created_at from qr q left join hr h on h.quality_result_id = q.id "
        "where q.result = 'fail' and q.check_name = 'semantic_accuracy' and h.quality_result_id is null "
        "order by q.created_at desc, q.id limit 200", "qr", "hr"),
    "kpi_points": with_views(_POINTS.format(where="event_id is not null"), "qr"),
    "kpi_points_run": with_views(_POINTS.format(where="run_id = 'R04'"), "qr"),
    "kpi_calls": with_views("", "au").rstrip() + ",\n" + _COST + _KPI_CALLS.format(where="true"),
    "kpi_calls_run": with_views("", "au").rstrip() + ",\n" + _COST + _KPI_CALLS.format(where="run_id = 'R04'"),
    "trend_hour": with_views(
        "select strftime(created_at, '%Y-%m-%d %H:00') bucket, check_name, result, count(*) cnt from qr "
        "where created_at is not null group by 1, 2, 3", "qr"),
    "trend_day": with_views(
        "select strftime(created_at, '%Y-%m-%d') bucket, check_name, result, count(*) cnt from qr "
        "where created_at is not null group by 1, 2, 3", "qr"),
    "trend_wide": with_views(_wide(), "qr"),
    "failures_by_check": with_views(
        "select check_name, count(*) cnt from qr where result = 'fail' and run_id = (select max(run_id) from qr) "
        "group by 1", "qr"),
    "failures_by_check_run": with_views(
        "select check_name, count(*) cnt from qr where result = 'fail' and run_id = 'R02' group by 1", "qr"),
    "failures_total": with_views(
        "select count(*) total_failures from qr where result = 'fail' and run_id = (select max(run_id) from qr)", "qr"),
    "run_ids": with_views("select distinct run_id from qr where run_id is not null", "qr"),
    "latest_run": with_views(
        "select check_name, prompt_version, max(run_id) run_id from qr group by 1, 2", "qr"),
    "last_per_event": with_views(
        "select check_name, prompt_version, run_id, event_id, id, result, confidence from (select *, row_number() over "
        "(partition by check_name, prompt_version, run_id, event_id order by created_at desc, id desc) r from qr) "
        "where r = 1", "qr"),
    "drift_summary": with_views("", "qr").rstrip() + ",\n" + _RUNS + "," + _PAIRS.format(src="lastrow")
        + _SUMMARY.format(src="lastrow", changed="where " + SCRIPT_CHANGED),
    "drift_summary_screen": with_views("", "qr").rstrip() + ",\n" + _RUNS + "," + _PAIRS.format(src="picked")
        + _SUMMARY.format(src="picked", changed="where " + SCREEN_CHANGED),
    "drift_missing_run": with_views(
        "select check_name, max(run_id) base_run_id, CAST(null AS VARCHAR) candidate_run_id, CAST(0 AS BIGINT) base_rows, "
        "CAST(0 AS BIGINT) candidate_rows, CAST(0 AS BIGINT) common_rows, CAST(0 AS BIGINT) decision_changed_count, "
        "CAST(0 AS DOUBLE) decision_changed_rate, CAST(null AS DOUBLE) avg_confidence_delta_candidate_minus_base, "
        "'missing_run' status from qr where prompt_version = 'v1' group by 1", "qr"),
    "compare_runs": with_views("", "qr").rstrip() + ",\n" + _RUNS + "," + _PAIRS.format(src="lastrow")
        + " select check_name, event_id, base_result, candidate_result, base_confidence, candidate_confidence from pairs",
    "common_ids": with_views("", "qr").rstrip() + ",\n" + _RUNS
        + " select check_name, event_id from picked where prompt_version = 'v1' intersect "
          "select check_name, event_id from picked where prompt_version = 'v2'",
    "drift_examples": with_views("", "qr").rstrip() + ",\n" + _RUNS + "," + _PAIRS.format(src="lastrow")
        + _examples(SCRIPT_CHANGED, "event_id"),
    "drift_examples_screen": with_views("", "qr").rstrip() + ",\n" + _RUNS + "," + _PAIRS.format(src="picked")
        + _examples(SCREEN_CHANGED, "bid, cid"),
    "labelled_set": with_views(
        f"select h.quality_result_id, q.event_id, h.check_name, h.human_label, h.reviewer, "
        f"{_duck_time('h.labeled_at')} labeled_at, q.run_id, q.prompt_version, q.confidence, q.result llm_result "
        f"from {JOINED}", "qr", "hr"),
    "label_distribution": with_views(
        f"select q.check_name, h.human_label, count(*) cnt from {JOINED} group by 1, 2", "qr", "hr"),
    "review_totals": with_views(
        f"select count(*) reviewed, count(*) filter (h.human_label = 'override_pass') overrides from {JOINED}",
        "qr", "hr"),
    "by_reviewer": with_views(
        f"select coalesce(h.reviewer, 'unknown') reviewer, count(*) cnt from {JOINED} group by 1", "qr", "hr"),
    "active_reviewers": with_views(
        f"select count(distinct coalesce(h.reviewer, 'unknown')) active_reviewers from {JOINED}", "qr", "hr"),
    "recent_reviews": with_views(
        f"select h.quality_result_id, {_duck_time('h.labeled_at')} labeled_at, h.reviewer, q.run_id, q.check_name, "
        f"q.event_id, h.human_label from {JOINED} order by h.labeled_at desc, h.quality_result_id limit 200", "qr", "hr"),
    "export_totals": with_views(
        "select count(*) total_reviews, CAST(sum(case when human_label = 'override_pass' then 1 else 0 end) AS BIGINT) "
        "overrides, CAST(sum(case when human_label = 'approve_fail' then 1 else 0 end) AS BIGINT) approve_fail from hr",
        "hr"),
    "export_breakdown": with_views(
        'select check_name, human_label, count(*) "count" from hr group by 1, 2', "hr"),
    "review_metrics": with_views(f"""
select check_name, n, tp, fp, fn, tn, round(tp / nullif(tp + fp, 0), 3) "precision",
  round(tp / nullif(tp + fn, 0), 3) recall, round((tp + tn) / n, 3) accuracy
from (select q.check_name, count(*) n,
    count(*) filter (q.result = 'fail' and h.human_label <> 'override_pass') tp,
    count(*) filter (q.result = 'fail' and h.human_label = 'override_pass') fp,
    count(*) filter (q.result = 'pass' and h.human_label <> 'override_pass') fn,
    count(*) filter (q.result = 'pass' and h.human_label = 'override_pass') tn
  from {JOINED} where q.result in ('pass', 'fail') group by 1)""", "qr", "hr"),
    "upsert_labels": with_views(f"""
select quality_result_id, check_name,
  case when quality_result_id % 30 = 0 then 'approve_fail' else human_label end human_label,
  case when quality_result_id % 30 = 0 then 'reviewer_9' else reviewer end reviewer,
  {_duck_time("labeled_at + case when quality_result_id % 30 = 0 then INTERVAL 1 DAY else INTERVAL 0 DAY end")} labeled_at
from hr
union all
select quality_result_id + 5, check_name, human_label, reviewer, {_duck_time("labeled_at")}
from hr where quality_result_id % 50 = 0""", "hr"),
}
