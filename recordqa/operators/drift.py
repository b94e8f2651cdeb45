"""Drift between two versions of a check.

Both definitions in use are built: the *script* form (last row per event,
null-safe comparison) and the *screen* form (all repeats paired, a null verdict
counts as changed). Neither emits pairs: counts and means follow from per-event
aggregates, so an event that fills a third of a run costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from recordqa.schema import CHECKS

RUN_KEY = ("check_name", "prompt_version", "run_id")


def has_run_key(results: DataFrame) -> DataFrame:
    """Rows that can take part in a run: event, run and version are all present."""
    return results.filter(
        F.col("event_id").isNotNull() & F.col("run_id").isNotNull() & F.col("prompt_version").isNotNull()
    )


def last_per_event(results: DataFrame, order: tuple[str, ...] = ("created_at", "id")) -> DataFrame:
    """Last row per (check, version, run, event); a rank limit prunes before the shuffle."""
    newest = Window.partitionBy(*RUN_KEY, "event_id").orderBy(*[F.desc(c) for c in order])
    return results.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def latest_run(results: DataFrame, ignore_legacy: bool = False) -> DataFrame:
    """Highest run id per (check, version), compared as text.

    Distinct keys come first: they collapse in a hash map, while a maximum over
    text would sort every row.
    """
    rows = results.filter(F.col("run_id").isNotNull()).select(*RUN_KEY).distinct()
    if ignore_legacy:
        rows = rows.filter(~F.col("run_id").startswith("legacy_"))
    return rows.groupBy("check_name", "prompt_version").agg(F.max("run_id").alias("run_id"))


def latest_rows(
    results: DataFrame, base_version: str, candidate_version: str, ignore_legacy: bool = False
) -> DataFrame:
    """Rows of the latest run of either version, with ``is_base`` and ``is_candidate``.

    The run list holds one row per check and version (two versions), which is
    what makes its broadcast safe.
    """
    pool = has_run_key(results).filter(
        F.col("prompt_version").isin(base_version, candidate_version) & F.col("check_name").isin(*CHECKS)
    )
    latest = latest_run(pool, ignore_legacy)
    rows = pool.join(F.broadcast(latest), list(RUN_KEY), "left_semi")
    return rows.withColumns(
        {
            "is_base": F.col("prompt_version") == base_version,
            "is_candidate": F.col("prompt_version") == candidate_version,
        }
    )


def _event_pairs(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """One row per (check, event) with the last base and candidate row side by side."""
    key = F.struct(*order)
    value = F.struct("result", "confidence")

    def last(flag: str) -> Column:
        return F.max_by(F.when(F.col(flag), value), F.when(F.col(flag), key))

    return rows.groupBy("check_name", "event_id").agg(
        last("is_base").alias("b"),
        last("is_candidate").alias("c"),
        F.bool_or("is_base").alias("in_base"),
        F.bool_or("is_candidate").alias("in_candidate"),
    )


def _run_pair(results: DataFrame, base_version: str, candidate_version: str, ignore_legacy: bool) -> DataFrame:
    latest = latest_run(
        has_run_key(results).filter(
            F.col("prompt_version").isin(base_version, candidate_version) & F.col("check_name").isin(*CHECKS)
        ),
        ignore_legacy,
    )

    def run_of(version: str) -> Column:
        return F.max(F.when(F.col("prompt_version") == version, F.col("run_id")))

    return latest.groupBy("check_name").agg(
        run_of(base_version).alias("base_run_id"), run_of(candidate_version).alias("candidate_run_id")
    )


def _differs(null_mode: str, a: Column, b: Column) -> Column:
    if null_mode == "null_safe":
        return ~a.eqNullSafe(b)
    if null_mode == "null_changed":
        return F.coalesce(a != b, F.lit(True))
    raise ValueError("null_mode must be 'null_safe' or 'null_changed'")


def _summary_last_wins(rows: DataFrame, null_mode: str, order: tuple[str, ...]) -> DataFrame:
    both = F.col("in_base") & F.col("in_candidate")
    delta = F.when(both, F.col("c.confidence") - F.col("b.confidence"))
    return (
        _event_pairs(rows, order)
        .groupBy("check_name")
        .agg(
            F.count_if("in_base").alias("base_rows"),
            F.count_if("in_candidate").alias("candidate_rows"),
            F.count_if(both).alias("common_rows"),
            F.count_if(both & _differs(null_mode, F.col("b.result"), F.col("c.result"))).alias(
                "decision_changed_count"
            ),
            F.avg(delta).alias("delta"),
        )
    )


def _summary_all_pairs(rows: DataFrame, null_mode: str) -> DataFrame:
    """Counts over all (base, candidate) repeats of an event, without building a pair.

    Per event: pairs = nb * nc; unchanged pairs = sum over verdicts of
    nb(v) * nc(v); the delta sum over pairs with both confidences is
    kb * sum_c - kc * sum_b.
    """

    def side(flag: str, name: str) -> list[Column]:
        conf = F.when(F.col(flag), F.col("confidence"))
        return [
            F.count_if(flag).alias(f"n_{name}"),
            F.count(conf).alias(f"k_{name}"),
            F.sum(conf).alias(f"s_{name}"),
        ]

    per_verdict = rows.groupBy("check_name", "event_id", "result").agg(
        *side("is_base", "b"), *side("is_candidate", "c")
    )
    same = F.col("n_b") * F.col("n_c")
    if null_mode == "null_changed":
        same = F.when(F.col("result").isNotNull(), same).otherwise(0)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0.0)) if c.startswith("s_") else F.sum(c)
    per_event = per_verdict.groupBy("check_name", "event_id").agg(
        *[total(c).alias(c) for c in ("n_b", "k_b", "s_b", "n_c", "k_c", "s_c")],
        F.sum(same).alias("same"),
    )
    n_b, k_b, s_b, n_c, k_c, s_c = (F.col(c) for c in ("n_b", "k_b", "s_b", "n_c", "k_c", "s_c"))
    return per_event.groupBy("check_name").agg(
        F.sum("n_b").alias("base_rows"),
        F.sum("n_c").alias("candidate_rows"),
        F.sum(n_b * n_c).alias("common_rows"),
        F.sum(n_b * n_c - F.col("same")).alias("decision_changed_count"),
        F.try_divide(F.sum(k_b * s_c - k_c * s_b), F.sum(k_b * k_c)).alias("delta"),
    )


def check_list(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in CHECKS])).alias("check_name"))


def drift_summary(
    results: DataFrame,
    base_version: str = "v1",
    candidate_version: str = "v2",
    null_mode: str = "null_safe",
    dedupe: bool = True,
    order: tuple[str, ...] = ("created_at", "id"),
    ignore_legacy: bool = False,
) -> DataFrame:
    """One row per check: sizes, changed decisions, mean confidence change, status.

    ``dedupe=True, null_mode='null_safe'`` is the report form;
    ``dedupe=False, null_mode='null_changed'`` is the screen form.
    """
    _differs(null_mode, F.lit(1), F.lit(1))
    rows = latest_rows(results, base_version, candidate_version, ignore_legacy)
    stats = _summary_last_wins(rows, null_mode, order) if dedupe else _summary_all_pairs(rows, null_mode)
    runs = _run_pair(results, base_version, candidate_version, ignore_legacy)
    # Three sides of one row per check; the check list is fixed.
    joined = (
        check_list(results.sparkSession)
        .join(F.broadcast(runs), "check_name", "left")
        .join(F.broadcast(stats), "check_name", "left")
    )
    missing = F.col("base_run_id").isNull() | F.col("candidate_run_id").isNull()
    status = (
        F.when(missing, "missing_run")
        .when(F.coalesce(F.col("common_rows"), F.lit(0)) == 0, "no_overlap")
        .otherwise("ok")
    )

    def known(name: str) -> Column:
        return F.when(missing, 0).otherwise(F.coalesce(F.col(name), F.lit(0))).cast("bigint").alias(name)

    counts = ("base_rows", "candidate_rows", "common_rows", "decision_changed_count")
    rate = F.coalesce(F.try_divide(F.col("decision_changed_count"), F.col("common_rows")), F.lit(0.0))
    return joined.select(
        "check_name",
        "base_run_id",
        "candidate_run_id",
        *[known(c) for c in counts],
        F.when(missing, 0.0).otherwise(rate).alias("decision_changed_rate"),
        F.when(~missing, F.col("delta")).alias("avg_confidence_delta_candidate_minus_base"),
        status.alias("status"),
    )


def compare_runs(
    results: DataFrame,
    base_version: str = "v1",
    candidate_version: str = "v2",
    order: tuple[str, ...] = ("created_at", "id"),
) -> DataFrame:
    """Events common to the latest run of both versions, last row of each side."""
    rows = latest_rows(results, base_version, candidate_version)
    return (
        _event_pairs(rows, order)
        .filter("in_base AND in_candidate")
        .select(
            "check_name",
            "event_id",
            F.col("b.result").alias("base_result"),
            F.col("c.result").alias("candidate_result"),
            F.col("b.confidence").alias("base_confidence"),
            F.col("c.confidence").alias("candidate_confidence"),
        )
    )


def common_ids(results: DataFrame, base_version: str = "v1", candidate_version: str = "v2") -> DataFrame:
    """Distinct (check, event) present in the latest run of both versions."""
    rows = latest_rows(results, base_version, candidate_version)
    return (
        rows.groupBy("check_name", "event_id")
        .agg(F.bool_or("is_base").alias("b"), F.bool_or("is_candidate").alias("c"))
        .filter("b AND c")
        .select("check_name", "event_id")
    )


def drift_examples(pairs: DataFrame, k: int = 10) -> DataFrame:
    """First ``k`` changed decisions per check by event id, ranked from 1."""
    changed = pairs.filter(_differs("null_safe", F.col("base_result"), F.col("candidate_result")))
    by_event = Window.partitionBy("check_name").orderBy("event_id")
    return changed.withColumn("rank", F.row_number().over(by_event)).filter(F.col("rank") <= k)


def drift_examples_screen(
    results: DataFrame,
    base_version: str = "v1",
    candidate_version: str = "v2",
    k: int = 10,
    order: tuple[str, ...] = ("id",),
) -> DataFrame:
    """First ``k`` changed pairs per check in (base row, candidate row) order, repeats included.

    Only rows that can reach the top ``k`` meet in the join: the first ``k``
    base rows with a changed partner, and per event and verdict the first ``k``
    candidate rows.
    """
    rows = latest_rows(results, base_version, candidate_version).select(
        "check_name", "event_id", "result", "confidence", "is_base", "is_candidate",
        F.struct(*order).alias("_at"),
    )
    base, cand = rows.filter("is_base"), rows.filter("is_candidate")
    seen = cand.select("check_name", "event_id", "result").distinct()
    verdicts = seen.groupBy("check_name", "event_id").agg(
        F.min("result").alias("_lo"), F.max("result").alias("_hi"), F.bool_or(F.col("result").isNull()).alias("_null")
    )
    own = F.col("result")
    can_change = F.col("_null") | own.isNull() | (own != F.col("_lo")) | (own != F.col("_hi"))
    first_base = Window.partitionBy("check_name").orderBy("_at")
    leading = (
        base.join(verdicts, ["check_name", "event_id"])
        .filter(F.coalesce(can_change, F.lit(True)))
        .withColumn("_r", F.row_number().over(first_base))
        .filter(F.col("_r") <= k)
        .select("check_name", "event_id", own.alias("base_result"),
                F.col("confidence").alias("base_confidence"), F.col("_at").alias("_base_at"))
    )
    per_verdict = Window.partitionBy("check_name", "event_id", "result").orderBy("_at")
    partners = (
        cand.withColumn("_r", F.row_number().over(per_verdict))
        .filter(F.col("_r") <= k)
        .select("check_name", "event_id", own.alias("candidate_result"),
                F.col("confidence").alias("candidate_confidence"), F.col("_at").alias("_cand_at"))
    )
    # ``leading`` holds at most k rows per check of the fixed check list.
    pairs = partners.join(F.broadcast(leading), ["check_name", "event_id"]).filter(
        _differs("null_changed", F.col("base_result"), F.col("candidate_result"))
    )
    merge_order = Window.partitionBy("check_name").orderBy("_base_at", "_cand_at")
    return (
        pairs.withColumn("rank", F.row_number().over(merge_order))
        .filter(F.col("rank") <= k)
        .drop("_base_at", "_cand_at")
    )
