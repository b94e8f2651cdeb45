"""Views that derive the library's table shapes from the benchmark tables.

Each has a Spark builder and a DuckDB twin in ``ORACLE_VIEWS``; all read whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def results_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check results from ``events``: ten runs, two versions, repeats inside a run."""
    k = F.get_json_object("props", "$.k").cast("int")
    rn = F.floor((F.dayofmonth("ts") - 1) / F.lit(3.0)).cast("int")
    kind = F.col("event_type")
    check = (
        F.when(kind.isin("view", "signup"), "semantic_accuracy")
        .when(kind.isin("click", "purchase"), "entity_resolution")
        .otherwise("source_credibility")
    )
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("E"), F.col("user_id").cast("string")).alias("event_id"),
        F.col("ts").alias("created_at"),
        check.alias("check_name"),
        F.concat(F.lit("R"), F.lpad(rn.cast("string"), 2, "0")).alias("run_id"),
        F.when(rn % 2 == 0, "v1").otherwise("v2").alias("prompt_version"),
        F.when(k % 20 == 0, F.lit(None)).when(F.col("value") < 34.58, "fail").otherwise("pass").alias("result"),
        F.when(k % 10 == 5, F.lit(None)).otherwise(k.cast("double") / 100).alias("confidence"),
    )


def labels_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Human labels from ``labels``; the label's own check is shifted on every ninth row."""
    d, q, t = F.col("doc_id"), F.col("quality"), F.col("toxic")
    return read(spark, sf_dir, "labels").select(
        (d * 10).alias("quality_result_id"),
        F.when(d % 9 == 0, "source_credibility").otherwise("semantic_accuracy").alias("check_name"),
        F.when((q == 1) & (t == 0), "override_pass")
        .when(q == 1, "needs_changes")
        .when(t == 1, "reject_record")
        .otherwise("approve_fail")
        .alias("human_label"),
        F.when(d % 4 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("reviewer_"), (d % 4).cast("string")))
        .alias("reviewer"),
        F.expr("CAST('2024-02-01 00:00:00' AS TIMESTAMP_NTZ) + make_dt_interval(0, 0, 0, CAST(doc_id AS INT))").alias(
            "labeled_at"
        ),
    )


def audit_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call audit rows from ``conversations``."""
    role, conv, length = F.col("role"), F.col("conv_id"), F.length("text")
    return read(spark, sf_dir, "conversations").select(
        (conv * 1000 + F.col("turn")).alias("call_id"),
        F.when(role == "assistant", "quality_check").when(role == "user", "remediation").alias("stage"),
        F.when(role == "assistant", F.concat(F.lit("R"), F.lpad((conv % 10).cast("string"), 2, "0"))).alias("run_id"),
        F.when(conv % 4 == 0, "gpt-4o-mini")
        .when(conv % 4 == 1, "gpt-4o")
        .when(conv % 4 == 2, "gpt-4.1")
        .otherwise("unpriced")
        .alias("model"),
        F.when(conv % 5 == 0, "anthropic").otherwise("openai").alias("provider"),
        length.cast("bigint").alias("prompt_tokens"),
        F.when(F.col("turn") % 7 == 3, F.lit(None))
        .otherwise(F.floor((length + 3) / F.lit(4.0)).cast("bigint"))
        .alias("completion_tokens"),
        (100 + length % 900).cast("double").alias("latency_ms"),
    )


def flat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat content the nested records below carry."""
    d = F.col("doc_id")
    return read(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(d % 17 == 0, "").otherwise(F.concat(F.lit("D"), d.cast("string"))).alias("event_id"),
        F.when(d % 13 == 0, F.lit(None)).otherwise(F.col("source")).alias("category"),
        F.when(d % 11 == 0, "").otherwise(F.split_part("text", F.lit("\n"), F.lit(1))).alias("article_sentence"),
        F.col("text").alias("summary"),
        F.col("text").alias("body"),
        "lang",
        F.when(F.col("lang") == "en", 2).when(F.col("lang") == "de", 1).otherwise(0).alias("n_companies"),
        (d % 7 == 0).alias("no_article"),
        ((d % 100) / F.lit(100.0)).alias("confidence"),
    )


def nested_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` wrapped into raw record lines, with a line-order key."""
    company = lambda n: F.struct(
        F.concat(F.lit("C"), F.col("doc_id").cast("string"), F.lit(f"_{n}")).alias("id"),
        F.lit("company").alias("type"),
        F.struct(
            F.concat(F.lit("Company "), F.col("lang"), F.lit(f" {n}")).alias("company_name"),
            F.concat(F.col("lang"), F.lit(f"{n}.example")).alias("domain"),
            F.lit(None).cast("string").alias("title"),
            F.lit(None).cast("string").alias("body"),
            F.lit(None).cast("string").alias("url"),
            F.lit(None).cast("string").alias("published_at"),
        ).alias("attributes"),
    )
    article = F.struct(
        F.concat(F.lit("A"), F.col("doc_id").cast("string")).alias("id"),
        F.lit("news_article").alias("type"),
        F.struct(
            F.lit(None).cast("string").alias("company_name"),
            F.lit(None).cast("string").alias("domain"),
            F.substring("body", 1, 60).alias("title"),
            F.col("body").alias("body"),
            F.concat(F.lit("https://news.example/"), F.col("doc_id").cast("string")).alias("url"),
            F.lit("2025-07-07T00:00:00Z").alias("published_at"),
        ).alias("attributes"),
    )
    kept = lambda cond, item: F.when(cond, item)
    included = F.array_compact(
        F.array(
            kept(F.col("n_companies") >= 1, company(1)),
            kept(~F.col("no_article"), article),
            kept(F.col("n_companies") >= 2, company(2)),
        )
    )
    event = F.struct(
        F.col("event_id").alias("id"),
        F.lit("news_event").alias("type"),
        F.struct(
            "summary",
            "category",
            "article_sentence",
            "confidence",
            F.when(F.col("doc_id") % 3 == 0, F.lit("2025-07-01")).alias("effective_date"),
            F.date_format(
                F.timestamp_seconds(F.lit(1751846400) + F.col("doc_id")), "yyyy-MM-dd'T'HH:mm:ss'Z'"
            ).alias("found_at"),
        ).alias("attributes"),
        F.struct(
            F.struct(
                F.when(F.col("n_companies") >= 1, F.struct(
                    F.concat(F.lit("C"), F.col("doc_id").cast("string"), F.lit("_1")).alias("id"),
                    F.lit("company").alias("type"))).alias("data")
            ).alias("company1"),
            F.struct(
                F.transform(F.sequence(F.lit(1), F.greatest(F.col("n_companies"), F.lit(1))), lambda i: F.struct(
                    F.concat(F.lit("C"), F.col("doc_id").cast("string"), F.lit("_"), i.cast("string")).alias("id"),
                    F.lit("company").alias("type"))).alias("data")
            ).alias("mentioned"),
        ).alias("relationships"),
    )
    record = F.to_json(F.struct(F.array(event).alias("data"), included.alias("included")))
    return flat_records(spark, sf_dir).select(
        record.alias("value"),
        F.lit("records.jsonl").alias("file_name"),
        F.lit(0).cast("bigint").alias("block_start"),
        F.col("doc_id").alias("line_id"),
    )


# ---- DuckDB twins ---------------------------------------------------------
K = "CAST(json_extract_string(props,'$.k') AS INT)"
ORACLE_VIEWS = {
    "qr": f"""
select id, event_id, created_at, check_name,
  concat('R', lpad(CAST(rn AS VARCHAR), 2, '0')) run_id,
  case when rn % 2 = 0 then 'v1' else 'v2' end prompt_version,
  case when k % 20 = 0 then null when value < 34.58 then 'fail' else 'pass' end result,
  case when k % 10 = 5 then null else CAST(k AS DOUBLE) / 100 end confidence
from (select event_id id, concat('E', CAST(user_id AS VARCHAR)) event_id, ts created_at, value, {K} k,
        CAST(floor((day(ts) - 1) / 3.0) AS INT) rn,
        case when event_type in ('view','signup') then 'semantic_accuracy'
             when event_type in ('click','purchase') then 'entity_resolution'
             else 'source_credibility' end check_name
      from events) x""",
    "hr": """
select doc_id * 10 quality_result_id,
  case when doc_id % 9 = 0 then 'source_credibility' else 'semantic_accuracy' end check_name,
  case when quality = 1 and toxic = 0 then 'override_pass' when quality = 1 then 'needs_changes'
       when toxic = 1 then 'reject_record' else 'approve_fail' end human_label,
  case when doc_id % 4 = 0 then null else concat('reviewer_', CAST(doc_id % 4 AS VARCHAR)) end reviewer,
  CAST('2024-02-01 00:00:00' AS TIMESTAMP) + INTERVAL '1' SECOND * CAST(doc_id AS INT) labeled_at
from labels""",
    "au": """
select conv_id * 1000 + turn call_id,
  case role when 'assistant' then 'quality_check' when 'user' then 'remediation' end stage,
  case when role = 'assistant' then concat('R', lpad(CAST(conv_id % 10 AS VARCHAR), 2, '0')) end run_id,
  case conv_id % 4 when 0 then 'gpt-4o-mini' when 1 then 'gpt-4o' when 2 then 'gpt-4.1' else 'unpriced' end model,
  case when conv_id % 5 = 0 then 'anthropic' else 'openai' end provider,
  CAST(length(text) AS BIGINT) prompt_tokens,
  case when turn % 7 = 3 then null else CAST(floor((length(text) + 3) / 4.0) AS BIGINT) end completion_tokens,
  CAST(100 + length(text) % 900 AS DOUBLE) latency_ms
from conversations""",
    "rec": """
select doc_id, case when doc_id % 17 = 0 then '' else concat('D', CAST(doc_id AS VARCHAR)) end event_id,
  case when doc_id % 13 = 0 then null else source end category,
  case when doc_id % 11 = 0 then '' else split_part(text, chr(10), 1) end article_sentence,
  text summary, text body, lang,
  case when lang = 'en' then 2 when lang = 'de' then 1 else 0 end n_companies,
  doc_id % 7 = 0 no_article, (doc_id % 100) / 100.0 confidence
from documents""",
}


def with_views(sql: str, *names: str) -> str:
    """``sql`` behind the CTEs it names."""
    return "WITH " + ",\n".join(f"{n} AS ({ORACLE_VIEWS[n]})" for n in names) + "\n" + sql
