"""Duplicate context of an event: how many records tell the same story.

Events are the same when their chosen text has the same normal form. Groups are
never listed per member: counts travel as one row per group, and the spellings
of a group stay rows of their own, so output grows with the input and not with
the square of a hot group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recordqa.functions.text import normal_form


def story_key(col: Column) -> Column:
    """128-bit digest of the normal form; null or empty text has no story."""
    return F.md5(F.nullif(normal_form(col), F.lit("")).cast("binary"))


def story_groups(payload: DataFrame, text: str = "article_sentence") -> DataFrame:
    """Stories told by more than one record: ``story, copies``.

    ``count(story)`` is 0 for rows without one, so no filter on the digest is
    needed; such a filter would compute every digest a second time.
    """
    return (
        payload.select(story_key(F.col(text)).alias("story"))
        .groupBy("story")
        .agg(F.count("story").alias("copies"))
        .filter("copies > 1")
    )


def similar_summaries(payload: DataFrame, text: str = "article_sentence") -> DataFrame:
    """Every distinct summary of every repeated story: ``story, event_summary, cnt``.

    Stories are told apart on the counted summaries; the rows are digested once.
    """
    spread = (
        payload.select(story_key(F.col(text)).alias("story"), "event_summary")
        .groupBy("story", "event_summary")
        .agg(F.count("*").alias("cnt"), F.count("story").alias("_told"))
        .filter("_told > 0")
    )
    repeated = spread.groupBy("story").agg(F.sum("cnt").alias("_n")).filter("_n > 1").select("story")
    return spread.drop("_told").join(repeated, "story", "left_semi")


def duplicate_counts(payload: DataFrame, text: str = "article_sentence") -> DataFrame:
    """Payload rows plus ``story`` and ``possible_duplicate_count``, the other records of the story.

    Only repeated stories are joined back; the left side of the join may be
    split by AQE where a story is hot.
    """
    groups = story_groups(payload, text)
    keyed = payload.withColumn("story", story_key(F.col(text)))
    return keyed.join(groups, "story", "left").withColumn(
        "possible_duplicate_count", F.coalesce(F.col("copies") - 1, F.lit(0)).cast("bigint")
    ).drop("copies")


def dedupe_context(payload: DataFrame, text: str = "article_sentence", threshold: float = 1.0) -> DataFrame:
    """Payload rows plus ``dedupe_context`` for the source check: the count of other records that tell the same
    story, or one whose similarity is at least ``threshold``, and the story's key.

    Summaries of a hot story are no list to repeat in every member's row; ``similar_summaries`` holds them all by story.
    """
    if threshold < 1:
        from recordqa.operators.near_stories import near_duplicate_counts  # which builds on the keys above

        counted = near_duplicate_counts(payload, text, threshold).drop("similar_stories")
    else:
        counted = duplicate_counts(payload, text)
    context = F.struct("possible_duplicate_count", F.col("story").alias("story_key"))
    return counted.withColumn("dedupe_context", context).drop("story", "possible_duplicate_count")
