"""Open JSON: typed access to VARIANT values and guarded encode / decode."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A filter pushed below a projection repeats the projected expression for every
    use; naming an expensive value inside the expression keeps it to one parse.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def variant_type(value: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def string_at(value: Column, path: str) -> Column:
    """The value at ``path`` when it is JSON text, else null; numbers are not coerced."""
    return F.when(variant_type(value, path) == "STRING", F.try_variant_get(value, path, "string"))


def number_at(value: Column, path: str, strict: bool = True) -> Column:
    """The value at ``path`` as DOUBLE.

    Strict: JSON numbers and booleans only. Lenient: numeric text converts too,
    as it does once rows sit in a REAL column.
    """
    number = F.try_variant_get(value, path, "double")
    if not strict:
        return number
    return F.when(variant_type(value, path).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL|BOOLEAN)"), number)


def boolean_at(value: Column, path: str) -> Column:
    """The value at ``path`` when it is a JSON boolean; ``"no"`` or 0 do not convert."""
    return F.when(variant_type(value, path) == "BOOLEAN", F.try_variant_get(value, path, "boolean"))


def object_at(value: Column, path: str = "$") -> Column:
    """The object at ``path`` as MAP<STRING, VARIANT>, null for any other JSON type."""
    return F.try_variant_get(value, path, "map<string,variant>")


def encode_json(col: Column) -> Column:
    """JSON text with non-ASCII kept as is and null fields kept."""
    return F.to_json(col, {"ignoreNullFields": "false"})


def printed(text: Column, strict: bool = True) -> Column:
    """JSON text as a VARIANT of it is printed: keys by name, no blanks. No JSON raises, or is null unless ``strict``."""
    return F.to_json((F.parse_json if strict else F.try_parse_json)(text))


def spliced(fields: Sequence[Column | str], raw: dict[str, Column], more: Sequence[Column | str] = ()) -> Column:
    """JSON text of an object: ``fields`` (one at least) as ``encode_json`` has them, ``raw`` ones whose JSON text stands in it as it is, ``more`` fields."""
    head = encode_json(F.struct(*fields))
    parts = [F.substr(head, F.lit(1), F.length(head) - 1)]
    for name, text in raw.items():
        parts += [F.lit(f',"{name}":'), F.coalesce(text, F.lit("null"))]
    tail = [F.lit(","), F.substr(encode_json(F.struct(*more)), F.lit(2))] if more else [F.lit("}")]
    return F.concat(*parts, *tail)


def decode_json(text: Column, ddl: str) -> Column:
    """Decode JSON text; null or empty text reads as an empty object."""
    return F.from_json(F.coalesce(F.nullif(text, F.lit("")), F.lit("{}")), ddl)
