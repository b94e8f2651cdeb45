"""Conformance of raw records to the declared schema, and relationship flattening."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from recordqa.functions.variants import is_object, let
from recordqa.schema import EVENT_INT_FIELDS, EVENT_STRING_FIELDS, EVENT_TAG_FIELDS

# fixed values: required event attributes and the JSON types they accept
REQUIRED = {
    "summary": "STRING",
    "category": "STRING",
    "found_at": "TIMESTAMP",
    "confidence": "NUMBER",
    "article_sentence": "STRING",
    "human_approved": "BOOLEAN",
    "planning": "BOOLEAN",
}
COMPANY_STRINGS = ("domain", "company_name", "ticker")
ARTICLE_STRINGS = ("author", "body", "image_url", "url", "title")


def _fits(value: Column, got: Column, kind: str) -> Column:
    """Whether a non-null value of JSON type ``got`` converts to ``kind``."""
    if kind == "STRING":
        return got == "STRING"
    if kind == "TAGS":
        return got.isin("ARRAY<STRING>", "ARRAY<VOID>", "ARRAY<>")
    if kind == "OBJECTS":
        return F.forall(F.try_variant_get(value, "$", "array<variant>"), is_object)
    if kind == "OBJECT":
        return got.startswith("OBJECT")
    target = {"NUMBER": "double", "BOOLEAN": "boolean", "BIGINT": "bigint"}.get(kind)
    if target:
        return F.try_variant_get(value, "$", target).isNotNull()
    text = F.try_variant_get(value, "$", "string")
    parsed = F.try_to_timestamp(text) if kind == "TIMESTAMP" else text.try_cast("date")
    return parsed.isNotNull()


def _field_rules(value: Column, field: str, path: str, kind: str, required: bool) -> Column:
    """The violation of one field, or null. The field is looked up once."""
    broken = lambda rule: F.struct(F.lit(field).alias("field"), F.lit(rule).alias("rule"))
    absent = broken("missing") if required else F.lit(None)

    def judged(found: Column) -> Column:
        got = F.schema_of_variant(found)
        return (
            F.when(F.coalesce(got, F.lit("VOID")) == "VOID", absent)
            .when(~F.coalesce(_fits(found, got, kind), F.lit(False)), broken("type"))
        )

    return let(F.try_variant_get(value, path, "variant"), judged)


def _resource_rules(value: Column, type_name: str) -> list[Column]:
    """Identity of a resource: text id and the literal type tag."""
    tag = F.try_variant_get(value, "$.type", "string")
    return [
        _field_rules(value, "id", "$.id", "STRING", True),
        F.when(~F.coalesce(tag == type_name, F.lit(False)), F.struct(F.lit("type").alias("field"), F.lit("tag").alias("rule"))),
    ]


def _event_rules(event: Column) -> list[Column]:
    rules = _resource_rules(event, "news_event")
    for name, kind in REQUIRED.items():
        rules.append(_field_rules(event, name, f"$.attributes.{name}", kind, True))
    optional = {
        **{name: "STRING" for name in EVENT_STRING_FIELDS},
        **{name: "BIGINT" for name in EVENT_INT_FIELDS},
        "effective_date": "DATE",
        **{name: "TAGS" for name in EVENT_TAG_FIELDS},
        "location_data": "OBJECTS",
        "product_data": "OBJECT",
    }
    for name, kind in optional.items():
        rules.append(_field_rules(event, name, f"$.attributes.{name}", kind, False))
    rules.append(_field_rules(event, "relationships", "$.relationships", "OBJECT", True))
    return rules


def _included_rules(item: Column) -> Column:
    """Violations of one included resource, by its own tag."""
    tag = F.try_variant_get(item, "$.type", "string")
    company = [_field_rules(item, n, f"$.attributes.{n}", "STRING", False) for n in COMPANY_STRINGS]
    article = [_field_rules(item, n, f"$.attributes.{n}", "STRING", False) for n in ARTICLE_STRINGS]
    article.append(_field_rules(item, "published_at", "$.attributes.published_at", "TIMESTAMP", False))
    shared = [
        _field_rules(item, "id", "$.id", "STRING", True),
        _field_rules(item, "attributes", "$.attributes", "OBJECT", True),
    ]
    unknown = F.array(F.struct(F.lit("type").alias("field"), F.lit("tag").alias("rule")))
    return (
        F.when(tag == "company", F.array_compact(F.array(*shared, *company)))
        .when(tag == "news_article", F.array_compact(F.array(*shared, *article)))
        .otherwise(unknown)
    )


_FOUND = "array<struct<part:string,position:int,field:string,rule:string>>"


def _part_violations(record: Column, part: str, rules: Callable[[Column], Column]) -> Column:
    """Violations of all items of one list of the record, or of the list itself when absent."""

    def located(where: str, position: Column, field: Column, rule: Column) -> Column:
        return F.struct(
            F.lit(where).alias("part"), position.cast("int").alias("position"), field.alias("field"), rule.alias("rule")
        )

    def of_item(item: Column, position: Column) -> Column:
        return F.transform(rules(item), lambda r: located(part, position, r["field"], r["rule"]))

    items = F.try_variant_get(record, f"$.{part}", "array<variant>")
    absent = F.array(located("record", F.lit(0), F.lit(part), F.lit("missing"))).cast(_FOUND)
    return F.coalesce(F.flatten(F.transform(items, of_item)).cast(_FOUND), absent)


def schema_violations(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per violation of the declared record schema: ``event_id, part, position, field, rule``.

    ``rule`` is ``missing``, ``type`` or ``tag``; ``part`` is ``record``, ``data``
    or ``included``. Reads raw text in ``value``, since typed parsing hides what does not convert.
    """

    def judged(record: Column) -> Column:
        return F.struct(
            F.try_variant_get(record, "$.data[0].id", "string").alias("event_id"),
            F.concat(
                _part_violations(record, "data", lambda x: F.array_compact(F.array(*_event_rules(x)))),
                _part_violations(record, "included", _included_rules),
            ).alias("found"),
        )

    found = lines.select(*keep, let(F.try_parse_json("value"), judged).alias("_j"))
    return (
        found.select(*keep, "_j.event_id", F.explode_outer("_j.found").alias("_x"))
        .filter(F.col("_x").isNotNull())
        .select(*keep, "event_id", "_x.*")
    )


# The JSON type each declared attribute has when it is well formed.
DECLARED = {
    **{name: ("DOUBLE" if kind == "NUMBER" else "STRING" if kind == "TIMESTAMP" else kind) for name, kind in REQUIRED.items()},
    **{name: "STRING" for name in EVENT_STRING_FIELDS},
    **{name: "BIGINT" for name in EVENT_INT_FIELDS},
    "effective_date": "STRING",
    **{name: "ARRAY" for name in EVENT_TAG_FIELDS},
    "location_data": "ARRAY",
    "product_data": "OBJECT",
}


def _kind(value: Column) -> Column:
    """JSON type of a VARIANT without its parameters; whole and broken numbers are ``NUMBER``, null is ``NULL``."""
    name = F.regexp_extract(F.schema_of_variant(value), "^([A-Z]+)", 1)
    return F.when(name.isin("BIGINT", "DOUBLE", "FLOAT", "DECIMAL"), "NUMBER").when(name == "VOID", "NULL").otherwise(name)


def schema_drift(lines: DataFrame) -> DataFrame:
    """Attributes of events as they occur: ``attribute, kind, rows, declared, fits``.

    One row per attribute and JSON type found, declared or not, and one with ``kind`` null per declared attribute
    that no event has. ``fits`` says whether the type is the declared one; null values fit. Lines that are
    no JSON and events without attributes count for nothing. Names and types are counted in each task; a
    record's attributes are taken from one parse.
    """
    event = F.try_variant_get(F.try_parse_json("value"), "$.data[0].attributes", "map<string,variant>")
    cells = lines.select(F.explode(event).alias("attribute", "_v")).select("attribute", _kind(F.col("_v")).alias("kind"))
    found = cells.groupBy("attribute", "kind").agg(F.count("*").alias("rows"))
    names = F.create_map(
        *[F.lit(x) for name, kind in DECLARED.items() for x in (name, "NUMBER" if kind in ("DOUBLE", "BIGINT") else kind)]
    )
    wanted = lines.sparkSession.range(1).select(F.explode(names).alias("attribute", "declared_kind"))
    both = found.join(wanted, "attribute", "full_outer")
    fits = F.col("kind").isNotNull() & ((F.col("kind") == "NULL") | (F.col("kind") == F.col("declared_kind")))
    return both.select(
        "attribute",
        "kind",
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
        F.col("declared_kind").isNotNull().alias("declared"),
        F.coalesce(fits, F.lit(False)).alias("fits"),
    )


def relationships(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Relationship targets of the first event: ``event_id, rel, target_id, target_type``.

    A relationship holds one id, a list of ids or null; all become rows (1, n, 0).
    Needs fully parsed records.
    """
    event = F.get(F.col("data"), F.lit(0))
    target = "struct<id string, type string>"
    listed = F.try_variant_get(F.col("_doc"), "$.data", f"array<{target}>")
    single = F.try_variant_get(F.col("_doc"), "$.data", target)
    targets = F.coalesce(listed, F.when(single.isNotNull(), F.array(single)))
    return (
        records.select(*keep, event["id"].alias("event_id"), F.explode_outer(event["relationships"]).alias("rel", "_doc"))
        .select(*keep, "event_id", "rel", F.explode_outer(targets).alias("_t"))
        .filter(F.col("_t").isNotNull())
        .select(*keep, "event_id", "rel", F.col("_t.id").alias("target_id"), F.col("_t.type").alias("target_type"))
    )
