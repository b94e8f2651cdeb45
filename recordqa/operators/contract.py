"""Contracts: judge output validation, flattened evidence, grounding, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recordqa.functions.text import within_word_limit
from recordqa.functions.variants import boolean_at, is_object, let, number_at, object_at, string_at
from recordqa.schema import CHECKS, EVIDENCE_FIELDS, REASON_WORD_LIMITS, ROLE_FITS, VERDICTS

# ---- fixed values: keys of the judge output contract ----------------------
COMMON_KEYS = ("check_name", "check_version", "event_id", "result", "confidence", "reason")
OWN_KEYS = {
    "semantic_accuracy": ("evidence_spans",),
    "entity_resolution": ("entity_assessments",),
    "source_credibility": ("quality_signals", "evidence_spans"),
}
SIGNALS = ("is_event_bearing", "is_marketing_heavy", "is_likely_duplicate", "is_relevant_to_label")
# ---------------------------------------------------------------------------


def _yes(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _for_check(check: Column, pick) -> Column:
    out = F.lit(None)
    for name in CHECKS:
        out = F.when(check == name, pick(name)).otherwise(out)
    return out


def _spans_ok(spans: Column) -> Column:
    """Every span has text and names a known source field."""
    return F.forall(
        spans,
        lambda s: _yes(
            string_at(s, "$.text").isNotNull() & string_at(s, "$.source_field").isin(*EVIDENCE_FIELDS)
        ),
    )


def _array(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "array<variant>")


def _assessment_ok(a: Column) -> Column:
    return _yes(
        string_at(a, "$.entity_id").isNotNull()
        & boolean_at(a, "$.is_plausibly_linked").isNotNull()
        & string_at(a, "$.role_fit").isin(*ROLE_FITS)
        & _spans_ok(_array(a, "$.evidence_spans"))
    )


def violated_rules(check: Column, answer: Column) -> Column:
    """Names of the contract rules a verdict breaks, as an array that may be empty."""
    allowed = _for_check(check, lambda c: F.array(*[F.lit(k) for k in COMMON_KEYS + OWN_KEYS[c]]))
    limit = _for_check(check, lambda c: F.lit(REASON_WORD_LIMITS[c]))
    wants_spans = check.isin("semantic_accuracy", "source_credibility")

    def rules(body: Column) -> Column:
        keys = F.coalesce(F.map_keys(object_at(body)), F.array().cast("array<string>"))
        signals = [boolean_at(body, f"$.quality_signals.{s}").isNotNull() for s in SIGNALS]
        broken = {
            "not_an_object": ~is_object(body),
            "missing_key": F.size(F.array_except(F.array(*[F.lit(k) for k in COMMON_KEYS]), keys)) > 0,
            "unknown_verdict": ~_yes(string_at(body, "$.result").isin(*VERDICTS)),
            "bad_confidence": ~_yes(number_at(body, "$.confidence").between(0.0, 1.0)),
            "long_reason": ~_yes(within_word_limit(string_at(body, "$.reason"), limit)),
            "bad_spans": wants_spans & ~_yes(_spans_ok(_array(body, "$.evidence_spans"))),
            "bad_assessments": (check == "entity_resolution")
            & ~_yes(F.forall(_array(body, "$.entity_assessments"), _assessment_ok)),
            "bad_signals": (check == "source_credibility")
            & ~_yes(signals[0] & signals[1] & signals[2] & signals[3]),
            "extra_key": F.size(F.array_except(keys, allowed)) > 0,
        }
        return F.array_compact(F.array(*[F.when(cond, F.lit(rule)) for rule, cond in broken.items()]))

    return let(answer, rules)


def contract_violations(answers: DataFrame) -> DataFrame:
    """Answers (``check_name``, ``llm_check`` VARIANT, ...) that break their output contract.

    Adds ``violations``, the names of the broken rules, and keeps only rows with some.
    """
    found = violated_rules(F.col("check_name"), F.col("llm_check"))
    return answers.withColumn("violations", found).filter(F.size("violations") > 0)


def _all_spans(check: Column) -> Column:
    """Evidence of the verdict itself and of each entity assessment: (entity_pos, span_pos, span_text, source_field)."""

    def listed(spans: Column, entity: Column) -> Column:
        return F.transform(
            spans,
            lambda s, i: F.struct(
                entity.alias("entity_pos"),
                i.alias("span_pos"),
                string_at(s, "$.text").alias("span_text"),
                string_at(s, "$.source_field").alias("source_field"),
            ),
        )

    none = F.array().cast("array<variant>")
    own = listed(F.coalesce(_array(check, "$.evidence_spans"), none), F.lit(None).cast("int"))
    per_entity = F.transform(
        F.coalesce(_array(check, "$.entity_assessments"), none),
        lambda a, i: listed(F.coalesce(_array(a, "$.evidence_spans"), none), i),
    )
    return F.concat(own, F.flatten(per_entity))


def evidence_spans(results: DataFrame) -> DataFrame:
    """One row per evidence span: ``entity_pos`` (null for the verdict's own), ``span_pos``, ``span_text``, ``source_field``."""
    keep = [c for c in results.columns if c != "llm_check"]
    found = results.select(*keep, F.explode_outer(_all_spans(F.col("llm_check"))).alias("_s"))
    return found.filter(F.col("_s").isNotNull()).select(*keep, "_s.*")


def explode_assessments(results: DataFrame) -> DataFrame:
    """One row per entity assessment; a verdict without any keeps one row of nulls."""
    a = F.col("_a")
    return (
        results.select("*", F.posexplode_outer(_array(F.col("llm_check"), "$.entity_assessments")).alias("entity_pos", "_a"))
        .withColumns(
            {
                "entity_id": string_at(a, "$.entity_id"),
                "entity_name": string_at(a, "$.entity_name"),
                "is_plausibly_linked": boolean_at(a, "$.is_plausibly_linked"),
                "role_fit": string_at(a, "$.role_fit"),
                "n_spans": F.coalesce(F.size(_array(a, "$.evidence_spans")), F.lit(0)),
            }
        )
        .drop("_a", "llm_check")
    )


def quality_signals(results: DataFrame) -> DataFrame:
    """The four source-quality signals as boolean columns."""
    body = F.col("llm_check")
    return results.withColumns(
        {s: boolean_at(body, f"$.quality_signals.{s}") for s in SIGNALS}
    ).drop("llm_check")


def ungrounded_spans(results: DataFrame, payload: DataFrame) -> DataFrame:
    """Spans, those of entity assessments included, that do not occur literally in the field they name.

    Results meet their payload once per verdict, not once per span; only the
    offending spans are exploded. Unknown fields and missing texts count as ungrounded. Of an id
    that the payload holds several times the least row counts.
    """
    one = payload.groupBy("event_id").agg(F.min(F.struct(*EVIDENCE_FIELDS)).alias("_texts"))
    joined = results.join(one, "event_id", "left")
    haystack = lambda field: F.coalesce(
        *[F.when(field == name, F.col("_texts")[name]) for name in EVIDENCE_FIELDS], F.lit(None)
    )
    loose = F.filter(
        _all_spans(F.col("llm_check")), lambda s: ~_yes(F.contains(haystack(s["source_field"]), s["span_text"]))
    )
    keep = [c for c in results.columns if c != "llm_check"]
    found = joined.select(*keep, F.explode_outer(loose).alias("_s")).filter(F.col("_s").isNotNull())
    return found.select(*keep, "_s.entity_pos", "_s.span_text", "_s.source_field")


def reconcile(expected: DataFrame, actual: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Keys whose rows do not match one to one: ``n_expected, n_actual, status``.

    Both sides are counted in one grouping, so no join is needed and hot keys
    collapse before the shuffle.
    """
    side = lambda df, e, a: df.select(*keys, F.lit(e).alias("e"), F.lit(a).alias("a"))
    counts = (
        side(expected, 1, 0)
        .unionByName(side(actual, 0, 1))
        .groupBy(*keys)
        .agg(F.sum("e").alias("n_expected"), F.sum("a").alias("n_actual"))
    )
    status = (
        F.when(F.col("n_actual") < F.col("n_expected"), "missing")
        .when(F.col("n_expected") == 0, "unexpected")
        .otherwise("duplicated")
    )
    return counts.filter("n_expected <> n_actual").withColumn("status", status)
