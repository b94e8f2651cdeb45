"""The training-data pipeline: five stages, each over all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result to the shared
folder and reads it again. Decisions are keyed by a digest of the row, so rows that repeat share one
decision, null ids included; decisions that concern few rows are written first, so Catalyst sees their
size when it chooses between broadcasting them and shuffling the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordqa.llm import language, mixing, secrets, simhash, tiling
from recordqa.llm.common import stage, table, text_or_empty

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEY = ["_r1", "_r2"]


def keyed(docs: DataFrame) -> DataFrame:
    """The columns of documents with a 128-bit digest of the row; other columns go."""
    columns = [F.col(c) for c in COLUMNS]
    return docs.select(*COLUMNS, F.xxhash64(*columns).alias("_r1"), F.xxhash64(F.lit("second"), *columns).alias("_r2"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters or without a language of posterior one half; the source is the host.

    The text model learns from the lang column of these documents; without any label nothing can be told, and all stay.
    """
    rows, model = keyed(docs), language.fit(docs)
    if not model.langs:
        return rows.select(*COLUMNS)
    found = language.identify(rows, model, F.col("text"), host=F.col("source"), keep=KEY)
    rejected = stage(found.where("rejected").select(*KEY).distinct(), "pipeline-language")
    return rows.join(rejected, KEY, "left_anti").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, that of the least id (nulls last; of repeated rows one)."""
    rows = keyed(docs)
    named = rows.select("text", F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", *KEY).alias("id"))
    found = simhash.simhash_components(named, id_col="id", n_words=4, max_bits=4)
    kept = stage(found.select("component_id.*").select(*KEY).distinct(), "pipeline-simhash")
    return rows.join(kept, KEY, "left_semi").dropDuplicates(KEY).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose tiles cover half or more of a benchmark item; items of under five tokens, which any text may
    hold, decide nothing."""
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_k1")
    rows = docs.select(*COLUMNS, ident, F.xxhash64(text_or_empty("text")).alias("_k2"))
    named = docs.select(ident.alias("id"), "text")
    found = tiling.contaminated(named, table(spark, sf_dir, "benchmark"), id_col="id", threshold=0.5).where("item_tokens >= 5")
    dropped = stage(found.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).distinct(), "pipeline-tiling")
    return rows.join(dropped, ["_k1", "_k2"], "left_anti").select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every reported span; n_chars follows the text."""
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_k1")
    rows = docs.select(*COLUMNS, ident, F.xxhash64(text_or_empty("text")).alias("_k2"))
    found = secrets.find_secrets(docs, with_key=True).where(F.size("spans") > 0)
    found = found.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("spans").alias("_spans"))
    spans = stage(found.dropDuplicates(["_k1", "_k2"]), "pipeline-secrets")
    joined = rows.join(spans, ["_k1", "_k2"], "left")
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(secrets.masked(F.col("text"), F.col("_spans")))
    n_chars = F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(F.length("_text").cast("long"))
    return joined.withColumn("_text", text).select(
        "doc_id", F.col("_text").alias("text"), "lang", "source", n_chars.alias("n_chars")
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with size and taken (words, repeats counted); those it does not take go.

    Rows that repeat fold into one, whose size and taken are their sums.
    """
    rows = keyed(docs).withColumn("_id", F.concat_ws(":", *[F.col(c).cast("string") for c in KEY]))
    mixed = mixing.mix_documents(rows.select("_id", "text", "source"), id_col="_id")
    taken = mixed.groupBy("_id").agg(F.sum("size").alias("size"), F.sum("taken").alias("taken")).where("taken > 0")
    taken = stage(taken, "pipeline-mix")
    return rows.join(taken, "_id").dropDuplicates(["_id"]).select(*COLUMNS, "size", "taken")


STAGES = [
    ("language", identify_language),
    ("simhash", drop_near_copies),
    ("decontamination", decontaminate),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}-out")
    return docs


#: Hashes of shingles and learned models have no SQL form; the stages are tested against plain Python.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict = {}
