"""Stories that are nearly the same: MinHash signatures, banded buckets, exact Jaccard.

A story is the normal form of a text; its shingles are runs of five words (the whole text if it has fewer). Stories
whose signatures agree in one band meet in a bucket, and each pair that meets is verified on the shingles themselves, so
bands decide what is compared and never what is reported. A pair at the threshold is missed with a
probability below 4 in 10,000 (``miss_probability``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recordqa.functions.text import normal_form
from recordqa.functions.variants import let
from recordqa.operators.duplicates import story_key
from recordqa.session import stage_table

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 20, 5
#: Stories of a bucket that one task compares with one another; larger buckets are dealt over more tasks.
BUCKET = 500


def miss_probability(similarity: float, bands: int = BANDS, rows: int = ROWS) -> float:
    """Chance that two stories of that Jaccard similarity share no bucket."""
    return (1 - similarity**rows) ** bands


def shingles(text: Column, n_words: int = WORDS) -> Column:
    """Distinct 64-bit hashes of the runs of ``n_words`` words of a normal form."""

    def runs(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (n_words - 1), F.lit(1)))
        return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(words, i, F.lit(n_words)), " "))))

    # bound once: inside the inner function the text would be split again for every run
    return let(F.split(text, " "), runs)


def band_keys(hashes: Column, bands: int = BANDS, rows: int = ROWS) -> Column:
    """One key per band: a hash of the least hashes of its rows under as many hash functions."""

    def least(seed: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(seed))))

    return F.array(*[F.xxhash64(*[least(b * rows + r) for r in range(rows)]) for b in range(bands)])


def stories(payload: DataFrame, text: str = "article_sentence") -> DataFrame:
    """Distinct stories: ``story`` (key), ``copies``, ``hashes`` (shingles). Rows without text have no story."""
    form = F.nullif(normal_form(F.col(text)), F.lit(""))
    told = payload.select(form.alias("_form")).filter(F.col("_form").isNotNull())
    # a form is hashed where it is read, so only keys and shingles travel, and copies fold in each task
    keyed = told.select(F.md5(F.col("_form").cast("binary")).alias("story"), shingles(F.col("_form")).alias("hashes"))
    return keyed.groupBy("story").agg(F.count("*").alias("copies"), F.any_value("hashes").alias("hashes"))


def _meetings(found: DataFrame) -> DataFrame:
    """Distinct pairs of stories (a < b) that share a bucket.

    A bucket of more than ``BUCKET`` stories is dealt by hash into parts: its stories are on the left in one part
    and on the right in all of them, so no task holds more than a part of it against the whole bucket's keys.
    """
    posted = stage_table(
        found.select("story", F.posexplode(band_keys(F.col("hashes"))).alias("band", "key")), "story-bands"
    )
    sizes = posted.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1")
    parts = stage_table(sizes.select("band", "key", F.ceil(F.col("n") / BUCKET).cast("int").alias("parts")), "story-buckets")
    shared = posted.join(parts, ["band", "key"])
    left = shared.select("band", "key", F.pmod(F.xxhash64("story"), F.col("parts")).cast("int").alias("part"), F.col("story").alias("a"))
    right = shared.select("band", "key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("story").alias("b"))
    return left.join(right, ["band", "key", "part"]).filter("a < b").select("a", "b").distinct()


def near_links(payload: DataFrame, text: str = "article_sentence", threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of different stories whose Jaccard similarity is at least ``threshold``: ``a, b, similarity``."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    found = stage_table(stories(payload, text), "stories")
    return _verified(found, threshold)


def _verified(found: DataFrame, threshold: float) -> DataFrame:
    pairs = stage_table(_meetings(found), "story-pairs")
    one = found.select(F.col("story").alias("a"), F.col("hashes").alias("_ha"))
    two = found.select(F.col("story").alias("b"), F.col("hashes").alias("_hb"))
    shared = F.size(F.array_intersect("_ha", "_hb"))
    similarity = shared / (F.size("_ha") + F.size("_hb") - shared)
    both = pairs.join(one, "a").join(two, "b").select("a", "b", similarity.alias("similarity"))
    return both.filter(F.col("similarity") >= threshold)


def near_duplicate_counts(payload: DataFrame, text: str = "article_sentence", threshold: float = THRESHOLD) -> DataFrame:
    """Payload rows plus ``story``, ``possible_duplicate_count`` and ``similar_stories``.

    The count is that of other records whose story is the same or similar; ``similar_stories`` that of other stories.
    Links are summed per story before they meet the records, so a story told by a third of all records is one row there.
    """
    found = stage_table(stories(payload, text), "stories")
    links = _verified(found, threshold).select("a", "b")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    told = found.select(F.col("story").alias("b"), "copies")
    similar = both.join(told, "b").groupBy("a").agg(F.sum("copies").alias("_near"), F.count("*").alias("_stories"))
    counts = found.join(similar.withColumnRenamed("a", "story"), "story", "left").select(
        "story",
        (F.col("copies") - 1 + F.coalesce("_near", F.lit(0))).alias("_others"),
        F.coalesce("_stories", F.lit(0)).alias("_stories"),
    )
    # most stories stand alone: only the others are joined back
    counts = stage_table(counts.filter("_others > 0"), "story-counts")
    keyed = payload.withColumn("story", story_key(F.col(text)))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return keyed.join(counts, "story", "left").withColumns(
        {"possible_duplicate_count": zero("_others"), "similar_stories": zero("_stories")}
    ).drop("_others", "_stories")
