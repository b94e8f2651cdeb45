"""Record projections: flat payload, linked companies, check inputs, review context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recordqa.functions.text import first_of_type, is_missing, of_type, truncate_chars
from recordqa.schema import CHECKS, CORE_RECORD_DDL


def company_entities(included: Column) -> Column:
    """Linked companies of a record as an array of structs, never null."""
    linked = F.transform(
        of_type(included, "company"),
        lambda x: F.struct(
            x["id"].alias("entity_id"),
            F.lit("company").alias("entity_type"),
            x["attributes"]["company_name"].alias("entity_name"),
            x["attributes"]["domain"].alias("entity_domain"),
        ),
    )
    empty = F.array().cast(
        "array<struct<entity_id:string,entity_type:string,entity_name:string,entity_domain:string>>"
    )
    return F.coalesce(linked, empty)


def extract_payload(records: DataFrame, keep: tuple = ()) -> DataFrame:
    """One flat payload row per record; only the first event of ``data`` is read.

    ``keep`` names input columns (line order, raw text) to carry along.
    """
    article = first_of_type(F.col("included"), "news_article")["attributes"]
    found = records.select(
        *keep,
        F.get(F.col("data"), F.lit(0)).alias("_event"),
        article.alias("_article"),
        company_entities(F.col("included")).alias("linked_entities"),
    )
    attrs = "_event.attributes"
    fields = {
        "event_id": "_event.id",
        "labeled_event_type": f"{attrs}.category",
        "event_summary": f"{attrs}.summary",
        "article_sentence": f"{attrs}.article_sentence",
        "source_title": "_article.title",
        "source_body": "_article.body",
        "event_date": f"{attrs}.effective_date",
        "source_url": "_article.url",
        "published_at": "_article.published_at",
        "linked_entities": "linked_entities",
    }
    kept = found.columns[: len(keep)]
    return found.select(*kept, *[F.col(path).alias(name) for name, path in fields.items()])


# Fields each check sees beside the shared ones, in the order of its contract.
_SHARED = ("event_id", "labeled_event_type", "event_summary", "article_sentence", "source_title")
_OWN = {
    "semantic_accuracy": ("event_date",),
    "entity_resolution": ("linked_entities",),
    "source_credibility": ("source_url", "published_at"),
}


def empty_dedupe_context() -> Column:
    return F.struct(
        F.lit(0).cast("bigint").alias("possible_duplicate_count"),
        F.lit(None).cast("string").alias("story_key"),
    )


def check_input_struct(
    payload, check_name: str, max_body_chars: int = 0, dedupe_context: Column | None = None
) -> Column:
    """Input of one check as a struct; ``payload`` maps a field name to its Column."""
    if check_name not in CHECKS:
        raise ValueError(f"unknown check {check_name!r}; known: {', '.join(CHECKS)}")
    if max_body_chars < 0:
        raise ValueError("max_body_chars cannot be negative")
    fields = [payload(name).alias(name) for name in _SHARED]
    fields.append(truncate_chars(payload("source_body"), max_body_chars).alias("source_body"))
    fields += [payload(name).alias(name) for name in _OWN[check_name]]
    if check_name == "source_credibility":
        context = empty_dedupe_context() if dedupe_context is None else dedupe_context
        fields.append(context.alias("dedupe_context"))
    return F.struct(*fields)


def check_input(
    payload: DataFrame, check_name: str, max_body_chars: int = 0, context: str | None = None
) -> DataFrame:
    """Payload rows plus ``input``, the struct the named check is asked about.

    ``context`` names a column that holds a filled dedupe context.
    """
    dedupe = F.col(context) if context else None
    return payload.withColumn("input", check_input_struct(F.col, check_name, max_body_chars, dedupe))


def eligible(payload: DataFrame) -> DataFrame:
    """Rows a check can answer for: the event id is present."""
    return payload.filter(~is_missing(F.col("event_id")))


def source_context(
    results: DataFrame, check_name: str, record_col: str = "source_record_json", excerpt_chars: int = 0
) -> DataFrame:
    """What a reviewer sees beside a verdict: core fields, title, body excerpt.

    Companies are filled for the entity check only, article metadata for the source check only.
    """
    if check_name not in CHECKS:
        raise ValueError(f"unknown check {check_name!r}")
    text = F.coalesce(F.nullif(F.col(record_col), F.lit("")), F.lit("{}"))
    parsed = results.withColumn("_rec", F.from_json(text, CORE_RECORD_DDL)).select(
        *[c for c in results.columns if c != record_col], "_rec.*"
    )
    event = F.get(F.col("data"), F.lit(0))
    article = first_of_type(F.col("included"), "news_article")["attributes"]
    extra: list[Column] = []
    if check_name == "entity_resolution":
        extra = [
            F.transform(
                F.coalesce(of_type(F.col("included"), "company"), F.array()),
                lambda x: F.struct(
                    x["id"].alias("id"),
                    x["attributes"]["company_name"].alias("company_name"),
                    x["attributes"]["domain"].alias("domain"),
                ),
            ).alias("companies")
        ]
    elif check_name == "source_credibility":
        extra = [
            F.struct(
                *[article[f].alias(f) for f in ("title", "url", "published_at", "author")]
            ).alias("source_metadata")
        ]
    carried = [c for c in results.columns if c not in (record_col, "event_id")]
    return parsed.select(
        *carried,
        event["id"].alias("event_id"),
        event["attributes"]["category"].alias("category"),
        event["attributes"]["summary"].alias("summary"),
        event["attributes"]["article_sentence"].alias("article_sentence"),
        event["attributes"]["found_at"].alias("found_at"),
        *extra,
        article["title"].alias("source_title"),
        truncate_chars(article["body"], excerpt_chars).alias("source_body"),
    )
