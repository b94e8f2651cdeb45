"""Session settings and the plan-level tools every stage shares.

``stage_table`` cuts lineage with a Parquet table in the shared folder the
cluster names in ``spark.checkpoint.dir``; nothing is kept only on executors,
so a lost executor costs a re-read and no re-run.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F


#: What one Arrow batch on its way to Python may hold.
BATCH_BYTES = 16 << 20
#: Rows that a scan of batches or calls holds at once; a row is the text of all records of a batch.
READ_ROWS = 256
#: Files that a task keeps open where a table is cut into folders; with more folders its rows are sorted by them first.
OPEN_FILES = 16


def build_session(app_name: str = "recordqa", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tested under."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared scratch folder the session names; set here only where it is unset, on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="recordqa-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_open_scratch: ContextVar[list[str] | None] = ContextVar("open_scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Empties the tables staged inside the block when it ends, whether it ends well or not.

    For whole runs, whose results are written elsewhere: what the block returns must not read a staged table.
    """
    paths: list[str] = []
    token = _open_scratch.set(paths)
    try:
        yield
    finally:
        _open_scratch.reset(token)
        for path in paths:
            _empty(spark, path)


def _empty(spark: SparkSession, path: str) -> None:
    spark.range(0).select(F.col("id").cast("int").alias("x")).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def free(staged: DataFrame) -> None:
    """Empties a staged table, not cut into folders, that nobody will read again."""
    for file in staged.inputFiles()[:1]:
        _empty(staged.sparkSession, unquote(file.rsplit("/", 1)[0]))


def stage_table(df: DataFrame, name: str, by: str | None = None, codec: str | None = "zstd", area: str = "recordqa") -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of what was written.

    Used where two consumers must see the same rows (numbering, judge answers):
    recomputation could differ or cost money. Parquet rather than a checkpoint,
    so each consumer reads only the columns it needs, and with ``by`` only the
    values of that column it needs. ``codec`` None leaves the compression to the session; ``area`` is the folder of the tables.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{area}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if codec:
        writer = writer.option("compression", codec)
    if (paths := _open_scratch.get()) is not None:
        paths.append(path)  # also what a failed write leaves there
    with open_files(spark):
        (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Bounds what Python holds at once by bytes, so that very long texts do not add up.

    It sets the session's Arrow batch size, unless that is already smaller.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        now = int(str(spark.conf.get(key)).rstrip("bB"))
    except (TypeError, ValueError):
        now = 0
    if not 0 < now <= size:
        spark.conf.set(key, str(size))


@contextmanager
def _set_to(spark: SparkSession, key: str, value: Callable[[int], int]) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, str(value(int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def bounded_reads(spark: SparkSession, rows: int = READ_ROWS) -> AbstractContextManager[None]:
    """Bounds the rows that a Parquet scan holds at once inside the block, for tables whose rows are long texts."""
    return _set_to(spark, "spark.sql.parquet.columnarReaderBatchSize", lambda n: min(n, rows))


def open_files(spark: SparkSession, files: int = OPEN_FILES) -> AbstractContextManager[None]:
    """Lets a task write to so many folders at once inside the block, so that long rows are not sorted by their folder."""
    return _set_to(spark, "spark.sql.maxConcurrentOutputFileWriters", lambda n: max(n, files))


def pin(df: DataFrame) -> DataFrame:
    """Adds ``_pin``, which keeps later filters above the columns computed so far.

    Catalyst pushes a filter below a projection by repeating the projected
    expression; over a JSON parse that doubles the work. It does not push past a
    row id, as long as the id is part of what is written.
    """
    return df.withColumn("_pin", F.monotonically_increasing_id())
