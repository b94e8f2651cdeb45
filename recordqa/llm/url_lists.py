"""URL filters by a temporal list join.

Dated additions and removals become validity intervals; an as-of join evaluates every capture
against the entries that were active when it was fetched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordqa.llm.common import stage
from recordqa.llm.language import page_host

def intervals(events: DataFrame) -> DataFrame:
    """Validity intervals (list, pattern, valid_from, valid_to) of dated events (list, pattern, action, at).

    An addition holds until the pattern's next event in that list; without one it holds on (``valid_to`` null).
    Of events at one time the removal is last. Events with a null list, pattern, action or time are left out;
    repeated events change nothing. The window is one pattern's history in one list.
    """
    known = events.where("list is not null and pattern is not null and action in ('add', 'remove') and at is not null")
    known = known.select("list", F.lower("pattern").alias("pattern"), "action", F.col("at").cast("long").alias("at")).distinct()
    history = Window.partitionBy("list", "pattern").orderBy("at", "action")
    spans = known.withColumn("valid_to", F.lead("at").over(history))
    open_or_long = F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to"))
    return spans.where((F.col("action") == "add") & open_or_long).select("list", "pattern", F.col("at").alias("valid_from"), "valid_to")


def patterns_of(url: Column) -> Column:
    """Patterns a URL can match: its host, the domains above it of two labels or more, and each folder of its path."""
    host = F.regexp_replace(page_host(url), r"\.$", "")
    labels = F.split(host, r"\.")
    tails = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    steps = F.split(path, "/")
    folders = F.when(
        F.size(steps) > 2,
        F.transform(
            F.sequence(F.lit(2), F.size(steps) - 1),
            lambda n: F.concat(host, F.lit("/"), F.lower(F.array_join(F.slice(steps, 2, n - 1), "/")), F.lit("/")),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.when(host.isNotNull(), F.array_distinct(F.concat(tails, folders)))


def dyadic(spans: DataFrame) -> DataFrame:
    """Spans (lo, hi, both included) with ``level`` and ``block``, one or two rows each.

    The level is the least whose blocks of 2**level ticks are as long as the span, so two blocks cover it, whatever
    the unit of the times and however long the span.
    """
    level = F.when(F.col("hi") > F.col("lo"), F.length(F.bin(F.col("hi") - F.col("lo")))).otherwise(0).cast("int")
    blocks = F.expr("sequence(shiftright(lo, level), shiftright(hi, level))")
    return spans.withColumn("level", level).withColumn("block", F.explode(blocks))


def evaluate(captures: DataFrame, events: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """One row per capture: id, fetched, n_active, decision, pattern.

    ``n_active`` counts active entries that match; the longest pattern decides (ties: a list named ``allow`` wins, then the
    first pattern in order), ``decision`` is its list, or ``none``. An entry is active from its addition, that moment included,
    to the moment before its removal. Captures with a null url or time, or a url without a host, match nothing; repeated rows
    get a row each; empty tables give no rows or no matches; other columns are ignored. Urls of any length are read whole.

    Intervals are covered by one or two dyadic blocks, so the join is one on (pattern, level, block) with a range test: of one
    list and pattern, whose intervals are disjoint, three at most meet a block of their level. A capture looks a pattern up
    on the levels that pattern has. A host with a third of all captures meets few intervals, and its join can be
    split on the captures' side. Only ids, patterns and times are shuffled.
    """
    rows = stage(
        captures.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            F.col(time_col).cast("long").alias("fetched"),
            patterns_of(F.col(url_col)).alias("patterns"),
        ),
        "url-captures",
    )
    first, last = (x or 0 for x in rows.agg(F.min("fetched"), F.max("fetched")).first())
    spans = intervals(events).withColumn("lo", F.greatest("valid_from", F.lit(first)))
    spans = spans.withColumn("hi", F.coalesce(F.least(F.col("valid_to") - 1, F.lit(last)), F.lit(last))).where("lo <= hi")
    spans = stage(dyadic(spans).drop("lo", "hi"), "url-spans")
    levels = spans.groupBy("pattern").agg(F.collect_set("level").alias("levels"))  # 64 at most
    keys = rows.where("fetched is not null").select("row", "fetched", F.explode("patterns").alias("pattern")).join(levels, "pattern")
    keys = keys.withColumn("level", F.explode("levels")).withColumn("block", F.expr("shiftright(fetched, level)")).drop("levels")
    active = keys.join(spans, ["pattern", "level", "block"]).where(
        (F.col("valid_from") <= F.col("fetched")) & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    )
    rank = F.struct((-F.length("pattern")).alias("n"), (F.col("list") != "allow").alias("other"), "pattern", "list")
    found = active.groupBy("row").agg(F.count(F.lit(1)).alias("n_active"), F.min(rank).alias("best"))
    return rows.join(found, "row", "left").select(
        F.col("id").alias(id_col),
        "fetched",
        F.coalesce("n_active", F.lit(0)).alias("n_active"),
        F.coalesce("best.list", F.lit("none")).alias("decision"),
        F.col("best.pattern").alias("pattern"),
    )
