"""Row numbers and fixed-size batches in input order, without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordqa.functions.variants import let
from recordqa.session import stage_table
from recordqa.sources.lines import LINE_ORDER


#: Ranges into which rows are dealt to be numbered.
RANGES = 256
STEP = 16


def _offsets(spans: DataFrame, by: tuple[str, ...], at: tuple[str, ...]) -> DataFrame:
    """Start of every span: the rows of its group in the spans before it.

    ``spans`` has one row per task (or file block) and group, never one per record.
    """
    before = Window.partitionBy(*by).orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    return spans.select(*by, *at, shift.alias("_shift"))


def positions(df: DataFrame, order: tuple[str, ...] = LINE_ORDER, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows plus ``pos``: 0, 1, 2, ... along ``order`` inside each ``by`` group.

    ``order`` must identify the row and hold no nulls. ``df`` is read twice and must be repeatable. Only the key
    columns are sorted and staged to find the bounds of ranges; see ``ranged_positions`` for the rest.
    """
    return ranged_positions(df, order, by).drop("_range")


def ranged_positions(
    df: DataFrame, order: tuple[str, ...] = LINE_ORDER, by: tuple[str, ...] = (), size: int = 1, keys_of: DataFrame | None = None
) -> DataFrame:
    """As ``positions``, with ``_range``: rows are dealt by it, and a range starts at a multiple of ``size`` rows.

    The keys are sorted first, and every so manieth becomes the bound of a range: at most ``RANGES`` bounds, whatever
    the size of the table. The rows then cross the network once, to their range, and are numbered there from its
    bound, so any group may be split over many tasks. ``keys_of`` are rows with the same keys that are cheaper to read.
    """
    keys = [*by, *order]
    placed = stage_table(
        (df if keys_of is None else keys_of)
        .select(*keys)
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id()),
        "positions",
    ).withColumn("_task", F.shiftright("_at", 33))
    bounds = _bounds(placed, order, by, size)
    listed = bounds.agg(F.array_sort(F.collect_list("_key")).alias("_bounds")).withColumn(
        "_every", F.filter("_bounds", lambda b, i: i % STEP == 0)
    )  # one row

    def range_of(key: Column) -> Column:
        """Number of the last bound that is not above the key: found among every ``STEP``-th first, then between two of them."""
        upto = lambda listed: F.size(F.filter(listed, lambda b: b <= key))
        return let((upto(F.col("_every")) - 1) * STEP, lambda s: s + upto(F.slice("_bounds", s + 1, F.lit(STEP))))

    dealt = df.join(F.broadcast(listed), F.lit(True)).withColumn("_range", let(F.struct(*keys), range_of))
    start = bounds.select("_range", "_first", *[F.col(f"_key.{c}").alias(f"_{c}") for c in by])
    here = dealt.drop("_bounds", "_every").repartition("_range").join(F.broadcast(start), "_range")
    continued = F.lit(True)
    for c in by:
        continued = continued & F.col(c).eqNullSafe(F.col(f"_{c}"))
    rank = F.rank().over(Window.partitionBy("_range", *by).orderBy(*order)) - 1
    ties = F.count(F.lit(1)).over(Window.partitionBy("_range", *keys))  # rows that agree in all keys share their places
    numbered = here.withColumn("_rank", rank + F.when(continued, F.col("_first")).otherwise(0)).withColumn("_ties", ties)
    for c in order:
        numbered = numbered.filter(F.col(c).isNotNull())
    places = F.explode(F.sequence(F.col("_rank").cast("bigint"), F.col("_rank").cast("bigint") + F.col("_ties") - 1))
    return numbered.select(*df.columns, places.alias("pos"), "_range")


def _bounds(placed: DataFrame, order: tuple[str, ...], by: tuple[str, ...], size: int) -> DataFrame:
    """Bounds of ranges: ``_range`` (from 1), ``_key`` and ``_first``, the place of the first row with that key in its group."""
    keys = [*by, *order]
    step = size * max(1, -(-placed.count() // (size * RANGES)))
    tasks = placed.groupBy("_task").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    everywhere = _offsets(tasks, (), ("_task",)).withColumnRenamed("_shift", "_all")
    ranked = placed.join(F.broadcast(everywhere), "_task").withColumn("_all", F.col("_at") + F.col("_all"))
    picked = ranked.filter(F.col("_all") % step == 0).select(F.struct(*keys).alias("_key")).distinct()
    # all rows of a picked key, so that a range starts at the first of them
    same = ranked.withColumn("_key", F.struct(*keys)).join(F.broadcast(picked), "_key", "left_semi")
    if by:
        spans = placed.groupBy(*by, "_task").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
        offsets = _offsets(spans, by, ("_task",)).withColumnsRenamed({c: f"_{c}" for c in by}).withColumnRenamed("_task", "_span")
        span = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by] + [F.col("_task") == F.col("_span")]
        same = F.broadcast(same).join(offsets, span, "inner").withColumn("_pos", F.col("_at") + F.col("_shift"))
    else:
        same = same.withColumn("_pos", F.col("_all"))
    starts = same.groupBy("_key").agg(F.min("_all").alias("_all"), F.min("_pos").alias("_first")).filter(F.col("_all") % step == 0)
    number = F.row_number().over(Window.orderBy("_all"))  # at most RANGES rows
    return stage_table(starts.select(number.alias("_range"), "_key", "_first"), "bounds")


def line_positions(df: DataFrame) -> DataFrame:
    """As ``positions`` in line order, for rows that come straight from a line scan.

    Between the scan and here only row-wise steps (select, filter) may lie. Each
    task then holds its lines in order, so nothing is sorted or shuffled: rows
    are staged as they are and each file block is shifted to its place. Rows that
    were moved to other tasks fail the check on the task number.
    """
    placed = stage_table(df.withColumn("_at", F.monotonically_increasing_id()), "lines")
    moved = F.shiftright("_at", 33) != F.shiftright("line_id", 33)
    spans = placed.groupBy("file_name", "block_start").agg(
        F.count("*").alias("_n"), F.min("_at").alias("_first"), F.bool_or(moved).alias("_moved")
    )
    problem = F.raise_error(F.lit("rows have moved since the scan; use positions()")).cast("bigint")
    spans = spans.withColumn("_n", F.when(F.col("_moved"), problem).otherwise(F.col("_n")))
    offsets = _offsets(spans, (), ("file_name", "block_start"))
    return (
        placed.join(offsets, ["file_name", "block_start"])
        .withColumn("pos", F.col("_at") + F.col("_shift"))
        .drop("_at", "_shift")
    )


def batch_ids(
    df: DataFrame, size: int, order: tuple[str, ...] = LINE_ORDER, by: tuple[str, ...] = ()
) -> DataFrame:
    """Rows plus ``pos`` and ``batch_id``; each batch holds ``size`` rows, the last one the rest."""
    if size <= 0:
        raise ValueError("batch size must be positive")
    numbered = positions(df, order, by)
    return numbered.withColumn("batch_id", F.floor(F.col("pos") / F.lit(size)).cast("bigint"))


def first_rows(
    df: DataFrame, n: int, order: tuple[str, ...] = LINE_ORDER, by: tuple[str, ...] = ()
) -> DataFrame:
    """First ``n`` rows per ``by`` group along ``order``, for any ``n``: rows are numbered, no group meets in one task."""
    if n <= 0:
        raise ValueError("row cap must be positive")
    return positions(df, order, by).filter(F.col("pos") < n).drop("pos")
