"""Human review: queues, backlog, label tables, reviewer statistics, confusion matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordqa.operators.topk import top_k
from recordqa.schema import CHECKS, HUMAN_LABELS, TRUTH_FAIL_LABELS

ALL_RUNS = "ALL"


def for_run(df: DataFrame, run: str | None) -> DataFrame:
    """Rows of one run; ``ALL`` (or None) keeps every row."""
    return df if run in (None, ALL_RUNS) else df.filter(F.col("run_id") == F.lit(run))


def failed(results: DataFrame) -> DataFrame:
    return results.filter(F.col("result") == "fail")


def unreviewed(results: DataFrame, labels: DataFrame) -> DataFrame:
    """Failed results without a label. The join side is left to Catalyst: labels grow."""
    reviewed = labels.select(F.col("quality_result_id").alias("id"))
    return failed(results).join(reviewed, "id", "left_anti")


def backlog_view(results: DataFrame) -> DataFrame:
    """The stored backlog view: failed results, labelled or not."""
    return failed(results).select(
        "event_id", "run_id", "check_name", "result", "confidence", "reason", "created_at"
    )


def backlog(results: DataFrame, labels: DataFrame, run: str | None = ALL_RUNS, n: int | None = 200) -> DataFrame:
    """Unreviewed failures per (event, run), newest first; ``n=None`` gives all of them."""
    grouped = (
        unreviewed(for_run(results, run), labels)
        .groupBy("event_id", "run_id")
        .agg(
            F.count("*").alias("failed_checks"),
            F.min("confidence").alias("min_confidence"),
            F.max("created_at").alias("last_seen_at"),
        )
    )
    if n is None:
        return grouped
    return top_k(grouped, n, F.desc("last_seen_at"), F.asc("event_id"), F.asc("run_id"))


def review_queue(results: DataFrame, labels: DataFrame, check_name: str, n: int = 100) -> DataFrame:
    """The newest ``n`` unreviewed failures of one check."""
    if check_name not in CHECKS:
        raise ValueError(f"unknown check {check_name!r}")
    wanted = (
        "event_id",
        "run_id",
        "check_name",
        "model",
        "prompt_version",
        "result",
        "confidence",
        "reason",
        "source_record_json",
        "created_at",
    )
    waiting = unreviewed(results.filter(F.col("check_name") == check_name), labels)
    return top_k(waiting, n, F.desc("created_at"), F.asc("id")).select(
        F.col("id").alias("quality_result_id"), *[c for c in wanted if c in results.columns]
    )


def labelled_results(labels: DataFrame, results: DataFrame) -> DataFrame:
    """Labels joined to the result they judge; columns of the result carry the prefix-free names.

    The label's own ``check_name`` / ``event_id`` become ``label_check_name`` / ``label_event_id``.
    """
    side = labels
    for name in ("check_name", "event_id"):
        if name in side.columns:
            side = side.withColumnRenamed(name, f"label_{name}")
    return side.join(
        results.withColumnRenamed("id", "quality_result_id"), "quality_result_id", "inner"
    )


def labelled_set(labels: DataFrame, results: DataFrame) -> DataFrame:
    """The labelled set of the export, without an order; see the sink for the sorted file."""
    joined = labelled_results(labels, results)
    cols: list[Column] = [F.col("quality_result_id")]
    for name in ("event_id", "check_name"):
        own = f"label_{name}"
        cols.append(F.col(own if own in joined.columns else name).alias(name))
    rest = ("human_label", "reviewer", "notes", "labeled_at", "run_id", "prompt_version", "model",
            "reason", "confidence")
    cols += [F.col(c) for c in rest if c in joined.columns]
    return joined.select(*cols, F.col("result").alias("llm_result"))


def label_distribution(joined: DataFrame, run: str | None = ALL_RUNS) -> DataFrame:
    """Labels per (check of the result, label)."""
    counts = for_run(joined, run).groupBy("check_name", "human_label").agg(F.count("*").alias("cnt"))
    return counts.orderBy(F.desc("cnt"), "check_name", "human_label")


def review_totals(joined: DataFrame, run: str | None = ALL_RUNS) -> DataFrame:
    return for_run(joined, run).agg(
        F.count("*").alias("reviewed"),
        F.count_if(F.col("human_label") == "override_pass").alias("overrides"),
    )


def by_reviewer(joined: DataFrame, run: str | None = ALL_RUNS) -> DataFrame:
    """Labels per reviewer; the row count is the number of active reviewers."""
    name = F.coalesce(F.col("reviewer"), F.lit("unknown"))
    counts = for_run(joined, run).groupBy(name.alias("reviewer")).agg(F.count("*").alias("cnt"))
    return counts.orderBy(F.desc("cnt"), "reviewer")


def active_reviewers(joined: DataFrame, run: str | None = ALL_RUNS) -> DataFrame:
    return by_reviewer(joined, run).agg(F.count("*").alias("active_reviewers"))


def export_totals(labels: DataFrame) -> DataFrame:
    """Totals of the label table; sums over no labels are null, not 0."""

    def hits(label: str) -> Column:
        return F.sum(F.when(F.col("human_label") == label, 1).otherwise(0))

    return labels.agg(
        F.count("*").alias("total_reviews"),
        hits("override_pass").alias("overrides"),
        hits("approve_fail").alias("approve_fail"),
    )


def export_breakdown(labels: DataFrame) -> DataFrame:
    """Labels per (the label's own check, label); orphans stay in."""
    counts = labels.groupBy("check_name", "human_label").agg(F.count("*").alias("count"))
    return counts.orderBy("check_name", F.desc("count"), "human_label")


def recent_reviews(joined: DataFrame, run: str | None = ALL_RUNS, n: int = 200) -> DataFrame:
    wanted = ("labeled_at", "reviewer", "run_id", "check_name", "event_id", "human_label", "notes")
    newest = top_k(for_run(joined, run), n, F.desc("labeled_at"), F.asc("quality_result_id"))
    return newest.select("quality_result_id", *[c for c in wanted if c in joined.columns])


def review_metrics(joined: DataFrame) -> DataFrame:
    """Confusion matrix per check; the positive class is ``fail``, undefined ratios are null.

    Rows whose verdict is neither pass nor fail, or whose label is outside the
    vocabulary, are not counted.
    """
    judged = joined.filter(F.col("result").isin("pass", "fail") & F.col("human_label").isin(*HUMAN_LABELS))
    said_fail = F.col("result") == "fail"
    is_fail = F.col("human_label").isin(*TRUTH_FAIL_LABELS)
    cells = judged.groupBy("check_name").agg(
        F.count("*").alias("n"),
        F.count_if(said_fail & is_fail).alias("tp"),
        F.count_if(said_fail & ~is_fail).alias("fp"),
        F.count_if(~said_fail & is_fail).alias("fn"),
        F.count_if(~said_fail & ~is_fail).alias("tn"),
    )
    ratio = lambda a, b: F.round(F.try_divide(a, b), 3)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.select(
        "*",
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(tp + tn, F.col("n")).alias("accuracy"),
    )


def upsert_labels(labels: DataFrame, new: DataFrame) -> DataFrame:
    """One label per result: the newest ``labeled_at`` wins, a new row beats a stored one on ties."""
    both = labels.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    newest = Window.partitionBy("quality_result_id").orderBy(
        F.desc("_new"), F.desc_nulls_last("labeled_at"), F.desc("human_label")
    )
    return both.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank", "_new")
