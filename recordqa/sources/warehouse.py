"""The warehouse: Parquet tables under one root, with appends and keyed upserts.

Append tables grow by partition. Keyed tables (records, labels) are cut by a hash of their key into buckets whose
number follows the table: it is a power of two, stored as the folder ``buckets=<n>``, and doubles when buckets
grow beyond a bound. An upsert reads and rewrites only the buckets its keys fall into.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from recordqa.functions.variants import string_at
from recordqa.operators.loading import to_audit_rows, to_quality_rows, to_remediation_rows, upsert_records
from recordqa.operators.review import backlog_view, upsert_labels
from recordqa.schema import CHECKS, PARTITIONS, TABLE_DDL
from recordqa.session import scratch, stage_table

# Keyed tables and their keys.
KEYED = {"records": "event_id", "human_review_labels": "quality_result_id"}
# Rows of a bucket beyond which a keyed table is cut into twice as many.
BUCKET_ROWS = 1_000_000


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, bucket_rows: int = BUCKET_ROWS):
        """``bucket_rows``: rows of a bucket of a keyed table beyond which the table is cut finer."""
        self.spark, self.root, self.bucket_rows = spark, root.rstrip("/"), bucket_rows

    # ---- layout -----------------------------------------------------------
    def schema(self, name: str) -> T.StructType:
        if name not in TABLE_DDL:
            raise ValueError(f"unknown table {name!r}; known: {', '.join(TABLE_DDL)}")
        return T.StructType.fromDDL(TABLE_DDL[name])

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _exists(self, name: str) -> bool:
        try:
            self.spark.read.schema(self.schema(name)).parquet(self.path(name))
        except AnalysisException:
            return False
        return True

    def init(self) -> None:
        """Create the tables that do not exist yet, empty; running it again changes nothing."""
        for name in TABLE_DDL:
            if not self._exists(name):
                none = self._checked(name, self.spark.createDataFrame([], self.schema(name)))
                if name in KEYED:
                    self._write_layout(name, 1, none.withColumn("bucket", F.lit(0)))
                else:
                    none.write.parquet(self.path(name))

    # ---- keyed layout -----------------------------------------------------
    def buckets(self, name: str) -> int:
        """Buckets of a keyed table as last committed; a table that was never written has one."""
        try:
            log = self.spark.read.schema("name string, buckets int").parquet(f"{self.root}/layouts")
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            return 1
        return log.filter(F.col("name") == name).agg(F.max("buckets")).first()[0] or 1

    def _bucket(self, name: str, buckets: int) -> Column:
        return F.pmod(F.xxhash64(KEYED[name]), F.lit(buckets)).cast("int")

    def _layout(self, name: str, buckets: int) -> str:
        return f"{self.path(name)}/buckets={buckets}"

    def _stored(self, name: str, buckets: int) -> DataFrame:
        """Rows of a layout with their bucket; the other layout of a table that is being cut finer is not seen."""
        schema = T.StructType([*self.schema(name).fields, T.StructField("bucket", T.IntegerType())])
        return self.spark.read.schema(schema).parquet(self._layout(name, buckets))

    # ---- reads ------------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        schema = self.schema(name)
        if name in KEYED:
            return self._stored(name, self.buckets(name)).drop("bucket")
        return self.spark.read.schema(schema).parquet(self.path(name)).select(*schema.fieldNames())

    def _touched(self, name: str, incoming: DataFrame) -> DataFrame:
        """Stored rows of the buckets that keys of ``incoming`` fall into."""
        buckets = self.buckets(name)
        hit = incoming.select(self._bucket(name, buckets).alias("bucket")).distinct()  # at most one row per bucket
        return self._stored(name, buckets).join(hit, "bucket", "left_semi").drop("bucket")

    def create_views(self) -> None:
        """Temp views of all tables and of the stored review backlog."""
        for name in TABLE_DDL:
            self.table(name).createOrReplaceTempView(name)
        backlog_view(self.table("llm_quality_results")).createOrReplaceTempView("human_review_backlog")

    # ---- writes -----------------------------------------------------------
    def _checked(self, name: str, df: DataFrame) -> DataFrame:
        """Columns and types of the table; a null in a NOT NULL column fails the write."""
        cols = []
        for field in self.schema(name).fields:
            value = F.col(field.name) if field.name in df.columns else F.lit(None)
            value = value.cast(field.dataType)
            if not field.nullable:
                message = F.lit(f"{name}.{field.name} must not be null")
                value = F.coalesce(value, F.raise_error(message).cast(field.dataType))
            cols.append(value.alias(field.name))
        return df.select(*cols)

    def _write(self, name: str, df: DataFrame, mode: str = "append") -> None:
        rows = self._checked(name, df)
        if name in KEYED:
            self._replace_buckets(name, rows)
            return
        parts = PARTITIONS.get(name, ())
        writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        (writer.partitionBy(*parts) if parts else writer).parquet(self.path(name))

    def _replace_buckets(self, name: str, rows: DataFrame) -> None:
        """Replaces the buckets that ``rows`` fall into; cuts the table finer first if they would grow too large.

        A finer layout is written beside the present one, which stays the table until the new one is in the log.
        """
        buckets = self.buckets(name)
        # staged, since the buckets to replace are read for it
        rows = stage_table(rows.withColumn("bucket", self._bucket(name, buckets)), f"upsert-{name}")
        replaced = rows.select("bucket").distinct()
        rest = self._stored(name, buckets).join(replaced, "bucket", "left_anti")
        n_rows, finer = rest.count() + rows.count(), buckets
        while n_rows > finer * self.bucket_rows:
            finer *= 2
        if finer == buckets:
            self._write_layout(name, buckets, rows)
            return
        self._write_layout(name, finer, rest.unionByName(rows).withColumn("bucket", self._bucket(name, finer)))
        self.spark.createDataFrame([(name, finer)], "name string, buckets int").coalesce(1).write.mode("append").parquet(f"{self.root}/layouts")
        self._write_layout(name, buckets, rows.limit(0), "static")  # frees what is no longer read

    def _write_layout(self, name: str, buckets: int, rows: DataFrame, overwrite: str = "dynamic") -> None:
        """One task and one file per bucket, sorted by the key so that a look-up reads few row groups."""
        dealt = rows.repartition("bucket").sortWithinPartitions("bucket", KEYED[name])
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", overwrite).partitionBy("bucket")
        writer.parquet(self._layout(name, buckets))

    def load_quality(self, results: DataFrame, replace_runs: bool = False) -> None:
        """Append result rows as read by ``read_all_checks`` and refresh the records.

        Loading the same files again appends them again, with the same ids; ``replace_runs``
        overwrites the (check, run) partitions at hand instead, and labels keep their results.
        """
        with scratch(self.spark):
            lines = self._parsed(results, "llm_check")
            self._write("llm_quality_results", to_quality_rows(lines), "overwrite" if replace_runs else "append")
            self._refresh_records(lines)

    def load_remediations(self, remediations: DataFrame) -> None:
        with scratch(self.spark):
            lines = self._parsed(remediations, "failed_check")
            self._write("llm_remediation_results", to_remediation_rows(lines))
            self._refresh_records(lines)

    def load_audit(self, audit: DataFrame) -> None:
        self._write("llm_call_audit", to_audit_rows(audit))

    def load_triage(self, log: DataFrame) -> None:
        rows = log.withColumn("id", F.xxhash64("run_id", "event_id", "decision", "reason", "created_at"))
        self._write("triage_results", rows)

    def _parsed(self, lines: DataFrame, verdict: str) -> DataFrame:
        """Lines with the event their verdict names, staged: the table and the records read them, and JSON is parsed once."""
        return stage_table(lines.withColumn("_event", string_at(F.col(verdict), "$.event_id")), "loaded-lines")

    def _refresh_records(self, lines: DataFrame) -> None:
        check_no = F.array_position(F.array(*[F.lit(c) for c in CHECKS]), F.col("check_name"))
        incoming = lines.select(
            F.col("_event").alias("event_id"),
            F.coalesce("source_record", F.lit("{}")).alias("source_record_json"),
            F.current_timestamp().alias("seen_at"),
            F.coalesce(F.try_to_timestamp("created_at"), F.timestamp_seconds(F.lit(0))).alias("written_at"),
            F.coalesce("run_id", F.lit("")).alias("run_id"),
            check_no.alias("check_no"),
            "file_name",
            "block_start",
            "line_id",
        )
        merged = upsert_records(
            self._touched("records", incoming), incoming, ("seen_at", "written_at", "run_id", "check_no", "file_name", "block_start", "line_id")
        )
        self._write("records", merged)

    def label(self, new: DataFrame) -> None:
        """Store reviews; a newer label of the same result replaces the older one."""
        stamped = new if "labeled_at" in new.columns else new.withColumn("labeled_at", F.current_timestamp())
        new = self._checked("human_review_labels", stamped)
        with scratch(self.spark):
            self._write("human_review_labels", upsert_labels(self._touched("human_review_labels", new), new))
