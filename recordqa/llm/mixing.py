"""Mixing sources to target weights.

Every document gets a hash-random key; within its source documents are range-sorted by key,
a distributed prefix sum of their sizes lays them on a line, and the line is cut at the
source's exact budget. Budgets beyond one source size wrap around: whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordqa.llm.common import WORD, stage, text_or_empty

#: Weights by rank of the source (code point order, null last), repeating.
WEIGHTS = (5, 2, 1)


def word_count(text: str | Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, share: float = 1.5, max_epochs: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """Targets per source: source, source_size, target.

    ``sizes`` has one row per source: source, source_size. The budget ``share * total`` is
    dealt by weight; no target exceeds ``max_epochs * source_size`` and the excess goes to
    the others by weight until none is above. With sources in the order of cap / weight, the
    sources that stop at their cap are a prefix, so the fixed point is found without a loop:
    the first source whose cap lies above its share of what is left ends the prefix.
    The windows run over one row per source.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.select("source", "source_size", (F.row_number().over(named) - 1).alias("_rank"))
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    caps = ranked.withColumn("_w", pick).withColumn("_cap", F.col("source_size") * F.lit(float(max_epochs)))
    filling = Window.orderBy(F.col("_cap") / F.col("_w"), "_rank")
    before, rest = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = caps.select(
        "*",
        F.sum("source_size").over(everything).alias("_total"),
        F.coalesce(F.sum("_cap").over(before), F.lit(0.0)).alias("_spent"),
        F.sum("_w").over(rest).alias("_left"),
    ).withColumn("_level", (F.col("_total") * F.lit(float(share)) - F.col("_spent")) / F.col("_left"))
    # the level of the first source that is not full holds for all after it
    open_level = F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level"))
    found = level.withColumn("_open", F.first(open_level, ignorenulls=True).over(filling.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.coalesce(F.least("_cap", F.col("_open") * F.col("_w")), F.col("_cap"))
    return found.select("source", "source_size", F.greatest(target, F.lit(0.0)).alias("target"))


def mix_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    share: float = 1.5,
    max_epochs: float = 2.0,
    weights=WEIGHTS,
    seed: str = "mix",
) -> DataFrame:
    """One row per document: id, size, source_size, target, taken.

    ``taken`` counts words the mix takes, repeats included: whole epochs of the source, and
    of the last epoch the documents up to the budget in key order; the document at the cut
    gives only its leading words, so each source's sum is its target rounded down.

    The key is ``md5(seed:id)``, then id, then size: reruns agree whatever the partitioning.
    Repeated rows lie next to each other and each counts. Null text is empty, a null source
    is a source, a null id has a key. Sources without words take nothing. Empty input gives
    no rows; other columns are ignored.

    Shuffles carry (id, source, size, key) only. Rows are ranged by (source, key), so a
    source with a third of all rows spreads over a third of the tasks; prefix sums run inside
    ranges, and one row per (range, source) is summed across ranges.
    """
    narrow = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), word_count(text_col).alias("_size")
    )
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("_id").cast("string"), F.lit("null"))).cast("binary"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    rows = stage(narrow.withColumn("_key", F.substring(key, 1, 16)), "mix-sizes")
    sizes = rows.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size"))
    targets = stage(
        source_targets(sizes, share, max_epochs, weights).withColumn("_s", F.row_number().over(named)), "mix-targets"
    )
    order = ["_s", "_key", "_id", "_size"]
    dealt = rows.join(targets, rows._source.eqNullSafe(targets.source)).select("_s", "_key", "_id", "_size")
    ranged = stage(
        dealt.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "mix-ranges"
    )
    inside = Window.partitionBy("_range", "_s").orderBy("_key", "_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_range", "_s").agg(F.sum("_size").alias("_n"))
    across = Window.partitionBy("_s").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_range", "_s", F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_base"))
    placed = (
        ranged.withColumn("_at", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
        .join(starts, ["_range", "_s"])
        .join(targets, "_s")
    )
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size") - (F.col("_base") + F.col("_at"))
    taken = epochs * F.col("_size") + F.greatest(F.lit(0), F.least(rest, F.col("_size")))
    return placed.select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("source_size"),
        F.col("target"),
        taken.cast("long").alias("taken"),
    )
