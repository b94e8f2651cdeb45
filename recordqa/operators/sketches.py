"""Profiles that are stored per load and merged: distinct counts, quantiles, frequent values.

A load is summarised once by sketches of fixed size; later questions over any set of loads merge the stored rows and
read no data again. The sketches are Spark's own aggregates, so they combine map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from recordqa.session import stage_table

# Registers of a distinct-count sketch as a power of two: a standard error of 0.8 %.
HLL_BITS = 14
# Size parameter of a quantile sketch: ranks are within about 0.4 % (99 % confidence).
KLL_K = 800
# Values a frequency sketch follows; any value above 1 / (0.75 * FOLLOWED) of the rows is among them.
FOLLOWED = 10_000


# ---- distinct counts ------------------------------------------------------
def distinct_sketches(df: DataFrame, fields: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per (``by``, field): ``field, rows, present, sketch``; the values of a field count by their text."""
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").cast("string").alias("v")) for f in fields]))
    cells = df.select(*by, values.alias("_c")).select(*by, "_c.field", "_c.v")
    return cells.groupBy(*by, "field").agg(
        F.count("*").alias("rows"), F.count("v").alias("present"), F.hll_sketch_agg("v", HLL_BITS).alias("sketch")
    )


def merged_distinct(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Uniqueness over all stored loads: ``field, rows, nulls, distinct_estimate, unique_share``."""
    merged = sketches.groupBy(*by, "field").agg(
        F.sum("rows").alias("rows"),
        (F.sum("rows") - F.sum("present")).alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"),
    )
    return merged.withColumn("unique_share", F.try_divide("distinct_estimate", F.col("rows") - F.col("nulls")))


# ---- quantiles ------------------------------------------------------------
def quantile_sketches(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """One row per group: the group's columns, ``n`` and ``sketch`` of the non-null numbers in ``col``."""
    known = df.filter(F.col(col).isNotNull())
    return known.groupBy(*by).agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double(F.col(col).cast("double"), F.lit(KLL_K)).alias("sketch")
    )


def merged_quantiles(sketches: DataFrame, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Quantiles over the stored groups, long form: the ``by`` columns, ``n, share, value``."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(KLL_K)).alias("_s"))
    at = lambda s: F.struct(F.lit(s).alias("share"), F.kll_sketch_get_quantile_double("_s", F.lit(s)).alias("value"))
    return merged.select(*by, "n", F.explode(F.array(*[at(float(s)) for s in shares])).alias("_q")).select(*by, "n", "_q.*")


# ---- frequent values ------------------------------------------------------
def frequency_sketches(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per load: the ``by`` columns, ``n`` (non-null rows) and ``sketch`` of the values of ``col``."""
    value = F.col(col).cast("string")
    made = F.call_function("approx_top_k_accumulate", value, F.lit(FOLLOWED))
    return df.filter(value.isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), made.alias("sketch"))


def candidates(sketches: DataFrame, k: int) -> DataFrame:
    """The ``k`` values that lead the merged sketches: ``value, estimate``."""
    if not 0 < k <= FOLLOWED:
        raise ValueError(f"k must be between 1 and {FOLLOWED}")
    combined = sketches.agg(F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(FOLLOWED)).alias("_s"))
    listed: Column = F.call_function("approx_top_k_estimate", F.col("_s"), F.lit(k))
    return combined.select(F.explode(listed).alias("_e")).select(F.col("_e.item").alias("value"), F.col("_e.count").alias("estimate"))


def exact_leaders(df: DataFrame, col: str, sketches: DataFrame, k: int, flat: str = "refuse") -> DataFrame:
    """The ``k`` most frequent values with exact counts: ``value, cnt, share, n``.

    The merged sketches name the candidates, one pass over the data counts just those: no value that is not a
    candidate is shuffled. The k-th must be frequent enough for the sketch to follow it. Where values are too evenly
    spread for that, the call fails (``flat="refuse"``), or every value is counted, one narrow row per
    value and task (``flat="count"``, which runs the first pass to find out).
    """
    if not 0 < k <= FOLLOWED:
        raise ValueError(f"k must be between 1 and {FOLLOWED}")
    if flat not in ("refuse", "count"):
        raise ValueError("flat must be 'refuse' or 'count'")
    named = candidates(sketches, FOLLOWED).select("value")  # every value that is followed
    values = df.select(F.col(col).cast("string").alias("value"))
    listed = _listed(values.join(named, "value", "left_semi"), k)
    n = sketches.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    both = listed.join(n, F.lit(True))  # one row on either side
    # any value above this share is followed for certain; fewer than k values are all there are if they cover the rows
    followed = (F.col("_least") > F.col("n") / (0.75 * FOLLOWED)) & (F.size("_l") == k)
    certain = followed | (F.coalesce("_sum", F.lit(0)) == F.col("n"))
    if flat == "count":
        both = stage_table(both, "leaders")
        if not both.select(F.coalesce(certain, F.lit(False))).first()[0]:  # one row
            both = _listed(values.filter("value IS NOT NULL"), k).join(n, F.lit(True))
        checked = F.col("_l")
    else:
        boom = F.raise_error(F.lit("no leaders: values are too evenly spread for the sketch")).cast("array<struct<value:string,cnt:bigint>>")
        checked = F.when(certain, F.col("_l")).otherwise(boom)
    return both.select("n", F.explode(checked).alias("_x")).select("_x.*", F.try_divide("_x.cnt", "n").alias("share"), "n")


def _listed(values: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent of ``values`` as one row: ``_l``, their least count and the sum of their counts."""
    first = values.groupBy("value").agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), "value").limit(k)
    return first.agg(F.collect_list(F.struct("value", "cnt")).alias("_l"), F.min("cnt").alias("_least"), F.sum("cnt").alias("_sum"))
