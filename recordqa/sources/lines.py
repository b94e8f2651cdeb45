"""JSONL sources: raw lines with a file-order key, parsed records, parsed results."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordqa.functions.text import has_text
from recordqa.functions.variants import let, string_at
from recordqa.operators.topk import top_k
from recordqa.schema import (
    AUDIT_LINE_DDL,
    CHECKS,
    CORE_RECORD_DDL,
    RECORD_DDL,
    REMEDIATION_LINE_DDL,
    RESULT_LINE_DDL,
)

# Position of a line: unique, ascending in the file's full path and then in line order.
LINE_ORDER = ("file_name", "block_start", "line_id")
MODES = ("failfast", "drop", "quarantine")
_BLANK = " \t\r\n\f\u000b"


def _stripped(value: Column) -> Column:
    """``value`` without blanks at its ends; a line that has none there, as most, is not walked through."""
    blank = F.lit(False)
    for c in _BLANK:
        blank = blank | value.startswith(c) | value.endswith(c)
    return F.when(blank, F.btrim(value, F.lit(_BLANK))).otherwise(value)


def _scan(spark: SparkSession, path: str | list[str]) -> DataFrame:
    # The id is taken on the scan itself: inside one file block it rises with the line.
    return (
        spark.read.text(path)
        .select(
            _stripped(F.col("value")).alias("value"),
            F.col("_metadata.file_path").alias("file_name"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("line_id"),
        )
        .filter(F.col("value").startswith("{") | has_text(F.col("value")))
    )


def read_jsonl_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Non-blank stripped lines of all ``*.jsonl`` files; no match raises PATH_NOT_FOUND."""
    return _scan(spark, f"{directory.rstrip('/')}/*.jsonl")


def malformed(value: Column) -> Column:
    return F.try_parse_json(value).isNull()


def parse_json_lines(lines: DataFrame, ddl: str, mode: str = "failfast") -> DataFrame:
    """Parse ``value`` with ``ddl`` into struct column ``parsed``.

    ``failfast`` raises on a malformed line, ``drop`` skips it, ``quarantine``
    keeps it with ``is_malformed`` set. The second, exact parse runs only on
    lines the first parse flagged.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    parsed = F.from_json("value", f"{ddl}, _bad STRING", {"columnNameOfCorruptRecord": "_bad"})
    bad = lambda p: p["_bad"].isNotNull() & malformed(F.col("value"))
    if mode == "failfast":
        # The error sits in ``parsed``: every reader uses it, so it cannot be pruned away.
        kind = lines.select(parsed.alias("p")).schema["p"].dataType.simpleString()
        boom = F.raise_error(F.concat(F.lit("malformed JSON line: "), F.left(F.col("value"), F.lit(200))))
        return lines.withColumn("parsed", let(parsed, lambda p: F.when(bad(p), boom.cast(kind)).otherwise(p)))
    out = lines.withColumn("parsed", parsed)
    if mode == "drop":
        return out.filter(~bad(F.col("parsed")))
    return out.withColumn("is_malformed", bad(F.col("parsed")))


def first_lines(lines: DataFrame, max_records: int) -> DataFrame:
    """First ``max_records`` non-blank lines in file order (a debugging cap, not a filter)."""
    if max_records <= 0:
        raise ValueError("max_records must be positive")
    return top_k(lines, max_records, *LINE_ORDER)


def parse_records(
    lines: DataFrame, max_records: int | None = None, mode: str = "failfast", full: bool = False
) -> DataFrame:
    """Nested records: the line columns plus ``data`` and ``included``.

    ``full`` parses every declared attribute; the default parses only what the
    check, triage and review stages read.
    """
    if max_records is not None:
        lines = first_lines(lines, max_records)
    parsed = parse_json_lines(lines, RECORD_DDL if full else CORE_RECORD_DDL, mode)
    return parsed.select("*", "parsed.data", "parsed.included").drop("parsed")


def read_lines_or_empty(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """As a scan of ``path``, but a missing path is an empty relation."""
    try:
        return _scan(spark, path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame(
            [], "value STRING, file_name STRING, block_start BIGINT, line_id BIGINT"
        )


def _open_parts(parsed: DataFrame, strings: tuple[str, ...], variants: tuple[str, ...]) -> DataFrame:
    """Lift the parsed fields to columns; a ``check_name`` tag on the line outranks the parsed one."""
    out = parsed
    for field in parsed.schema["parsed"].dataType.fieldNames():
        value = F.col(f"parsed.{field}")
        if field == "_bad" or (field == "check_name" and field in parsed.columns):
            continue
        if field in strings:
            value = string_at(value, "$")
        elif field in variants:
            value = F.try_parse_json(value)
        out = out.withColumn(field, value)
    return out.drop("parsed")


def parse_results(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    """Check result lines: envelope columns, ``llm_check`` as VARIANT, the record as raw text.

    ``run_id`` and ``prompt_version`` are null unless the line holds them as JSON text.
    """
    parsed = parse_json_lines(lines, RESULT_LINE_DDL, mode)
    return _open_parts(parsed, ("run_id", "prompt_version"), ("llm_check",))


def parse_remediations(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    parsed = parse_json_lines(lines, REMEDIATION_LINE_DDL, mode)
    return _open_parts(parsed, ("run_id",), ("failed_check",))


def parse_audit(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    parsed = parse_json_lines(lines, AUDIT_LINE_DDL, mode)
    return _open_parts(parsed, ("run_id",), ())


def read_results(spark: SparkSession, path: str, mode: str = "failfast") -> DataFrame:
    """One results file or folder; a missing one is empty."""
    return parse_results(read_lines_or_empty(spark, path), mode)


def _per_check_lines(spark: SparkSession, directory: str, suffix: str) -> DataFrame:
    """Lines of ``<check>_<suffix>.jsonl`` (single files) and ``check_name=<check>`` folders."""
    base = directory.rstrip("/")
    scans = []
    for check in CHECKS:
        for path in (f"{base}/{check}_{suffix}.jsonl", f"{base}/check_name={check}"):
            scans.append(read_lines_or_empty(spark, path).withColumn("check_name", F.lit(check)))
    out = scans[0]
    for scan in scans[1:]:
        out = out.unionByName(scan)
    return out


def read_all_checks(spark: SparkSession, directory: str, mode: str = "failfast") -> DataFrame:
    """Result lines of every check, tagged with ``check_name`` from where they lie."""
    return parse_results(_per_check_lines(spark, directory, "results"), mode)


def read_all_remediations(spark: SparkSession, directory: str, mode: str = "failfast") -> DataFrame:
    return parse_remediations(_per_check_lines(spark, directory, "remediations"), mode)


def read_audit(spark: SparkSession, path: str, mode: str = "failfast") -> DataFrame:
    return parse_audit(read_lines_or_empty(spark, path), mode)
