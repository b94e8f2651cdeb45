"""Uniform sampling of record lines."""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordqa.session import stage_table

# Equal lines are numbered in runs of this length, so no row holds a list as long as a group of copies.
RUN = 10_000
# Samples up to this size are drawn by one task from the tickets below the cut.
FEW = 100_000


def sample_records(
    lines: DataFrame, n: int = 100, seed: int | None = None, key: tuple[str, ...] = ("file_name", "value")
) -> DataFrame:
    """Exactly min(n, N) rows, uniform without replacement.

    Rows are drawn by a keyed digest of the columns that say what they are and of their number among equal
    rows, so the same seed gives the same rows however the input is split over tasks. Equal rows are drawn
    independently; which of them is returned makes no difference in the key columns.
    """
    if n <= 0:
        raise ValueError("sample size must be positive")
    seed = secrets.randbits(63) if seed is None else seed
    digest = F.md5(F.concat_ws("~", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]).cast("binary"))
    named = lines.withColumn("_digest", digest)
    counts = stage_table(named.groupBy("_digest").agg(F.count("*").alias("_n")), "sample-digests")
    taken = _cut(_low(_tickets(counts, seed), counts, n), n)
    per_digest = taken.groupBy("_digest").agg(F.count("*").alias("_take"))
    marked = named.join(stage_table(per_digest, "sample-taken"), "_digest")
    # the literal bound cuts a hot group in each task before it is shuffled
    rank = F.row_number().over(Window.partitionBy("_digest").orderBy(F.lit(0)))
    drawn = marked.withColumn("_rank", rank).filter((F.col("_rank") <= n) & (F.col("_rank") <= F.col("_take")))
    return drawn.drop("_digest", "_take", "_rank")


def _low(tickets: DataFrame, counts: DataFrame, n: int) -> DataFrame:
    """Tickets below a cut that the ``n`` least lie below: ``n`` and a margin are expected there.

    Tickets are uniform, so fewer than ``n`` below it have a probability of less than 1e-16.
    """
    total = counts.agg(F.sum("_n")).scalar()
    cut = (n + 12 * n**0.5 + 64) / total * float(1 << 60)
    return tickets.filter(F.conv(F.substring("_ticket", 1, 15), 16, 10).cast("double") <= cut)


def _tickets(counts: DataFrame, seed: int) -> DataFrame:
    """One ticket per row: (digest, copies, ticket)."""
    runs = counts.select(
        "_digest", F.col("_n").alias("_copies"), F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / RUN))).alias("_run")
    )
    last = F.least(F.col("_copies") - F.col("_run") * RUN, F.lit(RUN))
    each = runs.select("_digest", "_copies", "_run", F.explode(F.sequence(F.lit(1).cast("bigint"), last)).alias("_i"))
    number = (F.col("_run") * RUN + F.col("_i")).cast("string")
    ticket: Column = F.md5(F.concat_ws("~", F.lit(str(seed)), "_digest", number).cast("binary"))
    return each.select("_digest", "_copies", ticket.alias("_ticket"))


def _cut(tickets: DataFrame, n: int) -> DataFrame:
    """The ``n`` least tickets. Few are ranked by a top-n in each task; many without sorting all: whole prefix buckets below the cut are kept, only the one
    that holds the cut is ranked. The window over prefixes has at most 16**6 rows."""
    if n <= FEW:
        return tickets.orderBy("_ticket", "_digest").limit(n).select("_digest", "_copies")
    prefix = F.substring("_ticket", 1, 6)
    counts = tickets.groupBy(prefix.alias("_prefix")).agg(F.count("*").alias("_n"))
    upto = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    room = counts.select("_prefix", (F.lit(n) - F.coalesce(F.sum("_n").over(upto), F.lit(0))).alias("_room"), "_n")
    marked = tickets.withColumn("_prefix", prefix).join(room.filter("_room > 0"), "_prefix")
    inside = Window.partitionBy("_prefix").orderBy("_ticket")
    cut = marked.filter("_room < _n").withColumn("_rank", F.row_number().over(inside)).filter("_rank <= _room")
    return marked.filter("_room >= _n").select("_digest", "_copies").unionByName(cut.select("_digest", "_copies"))


def sample_summary(lines: DataFrame, n: int) -> DataFrame:
    """Rows seen and rows a sample of size ``n`` keeps."""
    return lines.agg(F.count("*").alias("seen")).withColumn("kept", F.least(F.col("seen"), F.lit(n).cast("bigint")))
