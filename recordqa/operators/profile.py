"""Dataset profiles: completeness, uniqueness, distributions, duplicates, constraints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from recordqa.functions.text import normal_form
from recordqa.functions.variants import let
from recordqa.operators.topk import top_k

# fixed values: bands of the completeness report, and its high-confidence line
COMPLETE_BELOW = 0.01
MOSTLY_NULL_ABOVE = 0.50
HIGH_CONFIDENCE = 0.9
KEY_UNIQUENESS = 0.999


def event_attributes(records: DataFrame) -> DataFrame:
    """Event id and every declared attribute of fully parsed records as flat columns.

    Structs are flattened with a name prefix, lists are kept.
    """
    event = F.get(F.col("data"), F.lit(0))
    flat = records.select(event["id"].alias("id"), event["attributes"].alias("a")).select("id", "a.*")
    cols: list[Column] = []
    for field in flat.schema.fields:
        if isinstance(field.dataType, T.StructType):
            cols += [F.col(f"{field.name}.{n}").alias(f"{field.name}_{n}") for n in field.dataType.fieldNames()]
        else:
            cols.append(F.col(field.name))
    return flat.select(*cols)


def _rows(*structs: Column) -> Column:
    return F.explode(F.array(*structs))


def null_profile(df: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Null share per field from a single aggregate: ``field, rows, nulls, null_share, band``."""
    fields = list(fields or df.columns)
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(F.col(f"`{f}`")).alias(f"_{i}") for i, f in enumerate(fields)])
    cells = _rows(*[F.struct(F.lit(f).alias("field"), F.col(f"_{i}").alias("present")) for i, f in enumerate(fields)])
    share = F.coalesce(F.try_divide(F.col("nulls"), F.col("rows")), F.lit(0.0))
    return (
        counts.select(F.col("_rows").alias("rows"), cells.alias("c"))
        .select(F.col("c.field").alias("field"), "rows", (F.col("rows") - F.col("c.present")).alias("nulls"))
        .withColumn("null_share", share)
        .withColumn("band", null_band(F.col("null_share")))
    )


def null_band(share: Column) -> Column:
    return (
        F.when(share < COMPLETE_BELOW, "complete").when(share > MOSTLY_NULL_ABOVE, "mostly_null").otherwise("partial")
    )


def sparsity_by_category(df: DataFrame, category: str, fields: Sequence[str]) -> DataFrame:
    """Null share of each field within each category, long form."""
    counts = df.groupBy(F.col(category).alias("category")).agg(
        F.count("*").alias("rows"), *[F.count(F.col(f"`{f}`")).alias(f"_{i}") for i, f in enumerate(fields)]
    )
    cells = _rows(*[F.struct(F.lit(f).alias("field"), F.col(f"_{i}").alias("present")) for i, f in enumerate(fields)])
    return counts.select("category", "rows", cells.alias("c")).select(
        "category",
        F.col("c.field").alias("field"),
        "rows",
        F.try_divide(F.col("rows") - F.col("c.present"), F.col("rows")).alias("null_share"),
    )


def uniqueness_profile(df: DataFrame, fields: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Distinct share per field over its non-null values, and whether it can serve as a key.

    Exact: rows become (field, 128-bit digest) cells that are counted map-side
    before one shuffle; long texts never travel and a value that fills a third
    of the rows is one cell per task. Otherwise a single HyperLogLog pass.
    """
    fields = list(fields or df.columns)
    if exact:
        cells = _rows(
            *[
                F.struct(F.lit(f).alias("field"), F.unhex(F.md5(F.col(f"`{f}`").cast("string").cast("binary"))).alias("d"))
                for f in fields
            ]
        )
        per_value = (
            df.select(cells.alias("c")).groupBy("c.field", "c.d").agg(F.count("*").alias("n"))
        )
        has_value = F.col("d").isNotNull()
        stats = per_value.groupBy("field").agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(has_value, F.col("n"))), F.lit(0)).alias("present"),
            F.count_if(has_value).alias("distinct_values"),
        )
    else:
        wide = df.agg(
            F.count("*").alias("_rows"),
            *[F.count(F.col(f"`{f}`")).alias(f"_p{i}") for i, f in enumerate(fields)],
            *[F.approx_count_distinct(F.col(f"`{f}`")).alias(f"_d{i}") for i, f in enumerate(fields)],
        )
        stats = wide.select(
            F.col("_rows").alias("rows"),
            _rows(
                *[
                    F.struct(
                        F.lit(f).alias("field"),
                        F.col(f"_p{i}").alias("present"),
                        F.col(f"_d{i}").alias("distinct_values"),
                    )
                    for i, f in enumerate(fields)
                ]
            ).alias("c"),
        ).select("c.field", "rows", "c.present", "c.distinct_values")
    share = F.try_divide(F.col("distinct_values"), F.col("present"))
    nulls = F.col("rows") - F.col("present")
    verdict = (
        F.when((nulls == 0) & (share >= KEY_UNIQUENESS), "key").when((nulls == 0) & (share >= 0.97), "weak").otherwise("no")
    )
    return stats.select(
        "field", "rows", nulls.alias("nulls"), "distinct_values", share.alias("unique_share"), verdict.alias("key_verdict")
    )


def confidence_profile(df: DataFrame, col: str = "confidence") -> DataFrame:
    c = F.col(col)
    high = F.count_if(c > HIGH_CONFIDENCE)
    return df.agg(
        F.count(c).alias("n"),
        F.min(c).alias("min_confidence"),
        F.max(c).alias("max_confidence"),
        F.avg(c).alias("mean_confidence"),
        high.alias("high_count"),
        F.try_divide(high, F.count(c)).alias("high_share"),
    )


def confidence_histogram(df: DataFrame, bins: int = 10, col: str = "confidence") -> DataFrame:
    """Counts per equal bin of [0, 1]; the value 1.0 falls into the last bin."""
    if bins <= 0:
        raise ValueError("bins must be positive")
    bin_no = F.least(F.width_bucket(F.col(col), F.lit(0.0), F.lit(1.0), F.lit(bins)), F.lit(bins))
    return df.filter(F.col(col).isNotNull()).groupBy(bin_no.cast("int").alias("bin")).agg(F.count("*").alias("cnt"))


def category_profile(df: DataFrame, category: str = "category", k: int | None = 20) -> DataFrame:
    """The ``k`` most frequent categories, or all, with their share of all categorised rows,
    beside the number of categories."""
    if k is not None and k <= 0:
        raise ValueError("k must be positive")
    named = df.filter(F.col(category).isNotNull())
    counts = named.groupBy(F.col(category).alias("category")).agg(F.count("*").alias("cnt"))
    totals = counts.agg(F.sum("cnt").alias("t"), F.count("*").alias("d"))
    top = counts if k is None else top_k(counts, k, F.desc("cnt"), "category")
    return (
        top.withColumn("share", F.col("cnt") / totals.select("t").scalar())
        .withColumn("n_categories", totals.select("d").scalar())
    )


def duplicate_ids(df: DataFrame, key: str = "id") -> DataFrame:
    """Ids that occur more than once, with the rows in excess of the first."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("id"))
        .agg(F.count("*").alias("copies"))
        .filter("copies > 1")
        .withColumn("excess", F.col("copies") - 1)
    )


def duplicate_summary(df: DataFrame, key: str = "id") -> DataFrame:
    return duplicate_ids(df, key).agg(
        F.count("*").alias("duplicated_ids"), F.coalesce(F.sum("excess"), F.lit(0)).alias("excess_rows")
    )


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per composite key along ``order``; null keys group together.

    The rank limit leaves at most one row per key and task before the shuffle. Rows meet and are sorted by a 128-bit
    digest of the keys, not by the keys, which may be whole texts.
    """
    parts = [F.col(k) for k in keys] + [F.col(k).isNull() for k in keys]
    keyed = df.withColumns({"_k1": F.xxhash64(*parts), "_k2": F.xxhash64(F.lit("second"), *parts)})
    first = Window.partitionBy("_k1", "_k2").orderBy(*order)
    return keyed.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank", "_k1", "_k2")


# ---- constraints ----------------------------------------------------------
def not_null(col: str) -> Column:
    return F.col(col).isNotNull()


def in_range(col: str, lo: float, hi: float) -> Column:
    return F.col(col).isNull() | F.col(col).between(lo, hi)


def member_of(col: str, values: Sequence[str]) -> Column:
    """Membership in a closed list (driver-side, so short); nulls are left to ``not_null``."""
    return F.col(col).isNull() | F.col(col).isin(*values)


def is_boolean(col: str) -> Column:
    return F.col(col).try_cast("boolean").isNotNull()


def published_rules(categories: Sequence[str], financing_types: Sequence[str]) -> dict[str, Column]:
    """The published rule set over flat attributes; a taxonomy too long for a list goes through ``unknown_values``."""
    required = ("id", "type", "found_at", "article_sentence", "summary")
    return {
        **{f"{c}_not_null": not_null(c) for c in required},
        "confidence_range": in_range("confidence", 0.0, 1.0),
        "human_approved_boolean": is_boolean("human_approved"),
        "category_taxonomy": member_of("category", categories),
        "financing_type_taxonomy": member_of("financing_type_normalized", financing_types),
    }


def constraint_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Violations per named rule in one pass; a rule is a Column that is true for valid rows."""
    bad = [F.count_if(~F.coalesce(valid, F.lit(False))).alias(f"_{i}") for i, valid in enumerate(rules.values())]
    counts = df.agg(F.count("*").alias("rows"), *bad)
    cells = _rows(*[F.struct(F.lit(name).alias("rule"), F.col(f"_{i}").alias("violations")) for i, name in enumerate(rules)])
    return counts.select("rows", cells.alias("c")).select("c.rule", "rows", "c.violations")


def unknown_values(df: DataFrame, col: str, taxonomy: DataFrame, key: str) -> DataFrame:
    """Values outside a taxonomy table with their counts; values are counted before the anti join."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count("*").alias("cnt"))
    return counts.join(taxonomy.select(F.col(key).alias("value")), "value", "left_anti")


# ---- spelling variants and amounts ----------------------------------------
def variant_groups(df: DataFrame, col: str) -> DataFrame:
    """Spellings that share a normal form with another spelling, one row per spelling.

    Long form instead of one list per group: a group of any size stays spread
    over rows. ``canonical`` is the most frequent spelling.
    """
    spellings = (
        df.filter(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("variant"))
        .agg(F.count("*").alias("cnt"))
        .withColumn("normal_form", normal_form(F.col("variant")))
    )
    groups = (
        spellings.groupBy("normal_form")
        .agg(
            F.count("*").alias("n_variants"),
            F.sum("cnt").alias("n_rows"),
            F.max(F.struct("cnt", "variant"))["variant"].alias("canonical"),
        )
        .filter("n_variants > 1")
    )
    return spellings.join(groups, "normal_form").select(
        "normal_form", "variant", "cnt", "n_variants", "n_rows", "canonical"
    )


def head_token_groups(df: DataFrame, col: str, separator: str = ",") -> DataFrame:
    """Heuristic for ``City, Country`` forms: values counted under the normal form of their head."""
    head = normal_form(F.get(F.split(F.col(col), separator), F.lit(0)))
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(head.alias("head"), F.col(col).alias("variant"))
        .agg(F.count("*").alias("cnt"))
    )


# fixed values: magnitudes, currency signs and names understood in amount text
MAGNITUDES = {
    "thousand": 1e3, "k": 1e3,
    "million": 1e6, "mln": 1e6, "mn": 1e6, "m": 1e6,
    "billion": 1e9, "bln": 1e9, "bn": 1e9, "b": 1e9,
    "trillion": 1e12, "tn": 1e12, "t": 1e12,
}
CURRENCIES = {
    "$": "USD", "us$": "USD", "usd": "USD", "dollar": "USD", "dollars": "USD",
    "€": "EUR", "eur": "EUR", "euro": "EUR", "euros": "EUR",
    "£": "GBP", "gbp": "GBP", "pound": "GBP", "pounds": "GBP",
    "¥": "JPY", "jpy": "JPY", "yen": "JPY",
    "₹": "INR", "inr": "INR", "rupees": "INR",
    "baht": "THB", "thb": "THB", "chf": "CHF", "cad": "CAD", "aud": "AUD", "cny": "CNY", "yuan": "CNY",
    "won": "KRW", "krw": "KRW", "sek": "SEK", "nok": "NOK", "dkk": "DKK", "pln": "PLN", "zloty": "PLN",
}
_AMOUNT = (
    r"(?iu)^\s*(us\$|[$€£¥₹]|[a-z]{3}(?=\s*\d))?\s*(\d[\d,]*(?:\.\d+)?)\s*"
    r"(thousand|million|billion|trillion|mln|bln|mn|bn|tn|k|m|b|t)?\s*([$€£¥₹]|[a-z]+)?\s*$"
)


def parse_amount(df: DataFrame, col: str = "amount") -> DataFrame:
    """Adds ``amount_number, amount_scale, amount_value, currency, amount_parsed``.

    Only forms the rule can read are parsed; others keep nulls and are flagged.
    No exchange rates are applied.
    """
    def lookup(table: dict, key: Column) -> Column:
        return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)

    def parsed(match: Column) -> Column:
        part = lambda i: F.nullif(F.get(match, F.lit(i)), F.lit(""))
        number = F.replace(part(1), F.lit(","), F.lit("")).try_cast("double")
        scale = F.when(part(2).isNull(), F.lit(1.0)).otherwise(lookup(MAGNITUDES, part(2)))
        currency = F.coalesce(lookup(CURRENCIES, part(0)), lookup(CURRENCIES, part(3)))
        bare = part(0).isNull() & part(3).isNull()
        return F.when(
            number.isNotNull() & (bare | currency.isNotNull()),
            F.struct(number.alias("number"), scale.alias("scale"), currency.alias("currency")),
        )

    # One match per row: the groups are joined by a character that no amount holds.
    groups = F.split(F.lower(F.regexp_replace(F.col(col), _AMOUNT, "$1\u001f$2\u001f$3\u001f$4")), "\u001f")
    found = df.withColumn("_a", let(groups, parsed))
    return found.withColumns(
        {
            "amount_number": F.col("_a.number"),
            "amount_scale": F.col("_a.scale"),
            "amount_value": F.col("_a.number") * F.col("_a.scale"),
            "currency": F.col("_a.currency"),
            "amount_parsed": F.col("_a").isNotNull(),
        }
    ).drop("_a")
