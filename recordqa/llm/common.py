"""Helpers the corpus operators share: words, keys, bounded Arrow batches, staging, components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordqa.session import bounded_batches, shared_dir, stage_table

#: Fixed value: a word is a run of characters other than space and the controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: str | Column) -> Column:
    """A text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def map_rows(df: DataFrame, rows: Callable[[dict[str, list]], Iterable[dict[str, list]]], schema: str) -> DataFrame:
    """``mapInArrow`` over plain lists: ``rows`` turns one batch's columns into some batches' columns."""
    bounded_batches(df.sparkSession)
    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for out in rows({n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}):
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


#: Folder of the corpus operators' tables, beside that of the others, which holds nothing but tables.
AREA = "recordqa-llm"
#: Frees the shuffle files of an execution when it ends (Spark 4.1; unknown to older sessions, which then keep them).
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Writes ``df`` to the shared folder and returns the scan: cuts lineage, survives lost executors.

    What was shuffled to write it is not needed again, so its files go when it is written.
    """
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        return stage_table(df, name, by, None, AREA)
    finally:
        spark.conf.set(_CLEANUP, before)


def empty(*frames: DataFrame) -> None:
    """Frees the files of staged tables that have no reader left, by overwriting them with no rows."""
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]}:
            while "=" in folder.rsplit("/", 1)[1]:  # the folder of a partition
                folder = folder.rsplit("/", 1)[0]
            df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(folder)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    import uuid

    return f"{shared_dir(spark)}/{AREA}/{name}-{uuid.uuid4().hex}"


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of undirected edges (a, b): node, component (its smallest node).

    Contraction: every node hooks to its smallest smaller neighbour, hooks are followed to
    their roots by pointer doubling, and edges are rewritten between roots, until none is
    left. Each round is an aggregation with map-side combining and joins with a side that is
    unique by key, so a hub costs one row per task and skewed joins can be split. A smallest
    node is its own component and not returned, like nodes without an edge to another one;
    null ends are ignored.
    """
    spark = edges.sparkSession
    hi, lo = F.greatest("a", "b"), F.least("a", "b")
    left = stage(edges.where("a <> b").select(hi.alias("a"), lo.alias("b")).distinct(), f"{name}-edges")
    done = None
    while not left.isEmpty():
        hooks = stage(left.groupBy("a").agg(F.min("b").alias("b")), f"{name}-hooks")
        while True:  # a chain of hooks halves each time
            up = hooks.select(F.col("a").alias("b"), F.col("b").alias("up"))
            if hooks.join(up, "b", "left_semi").isEmpty():
                break
            longer = hooks.join(up, "b", "left").select("a", F.coalesce("up", "b").alias("b"))
            hooks = stage(longer, f"{name}-hooks")
        ends = hooks.select(F.col("a").alias("node"), F.col("b").alias("component"))
        if done is None:
            done = ends
        else:
            up = hooks.select(F.col("a").alias("component"), F.col("b").alias("up"))
            moved = done.join(up, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
            done, old = stage(moved.unionByName(ends), f"{name}-nodes"), done
        a = hooks.select("a", F.col("b").alias("ra"))
        b = hooks.select(F.col("a").alias("b"), F.col("b").alias("rb"))
        moved = left.join(a, "a", "left").join(b, "b", "left").select(
            F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y")
        )
        new = moved.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
        left, old = stage(new, f"{name}-edges"), left
        empty(old)
    if done is None:
        kind = dict(edges.dtypes)["a"]
        return spark.createDataFrame([], f"node {kind}, component {kind}")
    return done
