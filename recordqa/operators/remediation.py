"""Remediation of failed results: request items, answers by event, routing, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recordqa.functions.variants import boolean_at, is_object, string_at
from recordqa.operators.judging import last_answer, response_text
from recordqa.schema import EVENT_INT_FIELDS, EVENT_STRING_FIELDS, EVENT_TAG_FIELDS, REMEDIATION_DECISIONS

DEFAULT_REASONING = "No valid remediation returned for this row."  # fixed value


def failed_checks(results: DataFrame) -> DataFrame:
    """Result rows whose open ``llm_check`` says fail, with its event id lifted (text ids only)."""
    check = F.col("llm_check")
    return results.filter(F.try_variant_get(check, "$.result", "string") == "fail").withColumn(
        "event_id", string_at(check, "$.event_id")
    )


def remediation_item(event_id: Column, source_record: Column, failed_check: Column) -> Column:
    """One entry of a remediation request."""
    return F.struct(
        event_id.alias("event_id"),
        F.try_parse_json(source_record).alias("source_record"),
        failed_check.alias("failed_check"),
    )


def default_remediation(event_id: Column) -> Column:
    spans = F.array().cast("array<struct<text:string,source_field:string>>")
    return F.to_variant_object(
        F.struct(
            event_id.alias("event_id"),
            F.lit("no_change").alias("decision"),
            F.lit(None).cast("string").alias("proposed_patch"),
            F.lit(DEFAULT_REASONING).alias("reasoning"),
            F.lit(0.0).alias("confidence"),
            spans.alias("evidence_spans"),
            F.lit(True).alias("review_recommended"),
        )
    )


def is_broken(calls: DataFrame, provider: str = "openai") -> Column:
    """Whether a remediation call's response holds no JSON text."""
    return F.try_parse_json(response_text(F.col("response"), provider)).isNull()


def unpack_remediations(calls: DataFrame, provider: str = "openai", mode: str = "failfast") -> DataFrame:
    """Answers of remediation calls: ``check_name, batch_id, position, event_id, item``.

    Text that is no JSON raises (``failfast``), or counts as no answers like JSON without a ``results`` array
    (``quarantine``): its rows get the default, and the audit marks the call.
    """
    if mode not in ("failfast", "quarantine"):
        raise ValueError("mode must be 'failfast' or 'quarantine'")
    body = F.try_parse_json(response_text(F.col("response"), provider))
    if mode == "failfast":
        boom = F.raise_error(F.concat(F.lit("remediation response is not JSON: "), F.col("call_id")))
        body = F.coalesce(body, boom.cast("variant"))
    return calls.select(
        "check_name",
        "batch_id",
        F.posexplode_outer(F.try_variant_get(body, "$.results", "array<variant>")).alias("position", "item"),
    ).filter(F.col("position").isNotNull()).select("check_name", "batch_id", "position", string_at(F.col("item"), "$.event_id").alias("event_id"), "item")


def attach_remediations(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """Failed rows left-joined to the last answer for their (check, event); misses get ``no_change``.

    ``answers`` has one candidate per row with ``batch_id`` and ``position`` giving the order.
    """
    best = last_answer(answers, ("check_name", "event_id"), ("batch_id", "position"))
    usable = F.when(is_object(F.col("item")), F.col("item"))
    return (
        rows.join(best.select("check_name", "event_id", usable.alias("_item")), ["check_name", "event_id"], "left")
        .withColumn("remediation", F.coalesce(F.col("_item"), default_remediation(F.col("event_id"))))
        .drop("_item")
    )


def route(results: DataFrame, hi: float = 0.9, lo: float = 0.7) -> DataFrame:
    """Queue of a verdict: certain fails go to remediation, other fails to a human,
    uncertain passes to a spot check; nothing else is queued."""
    _check_thresholds(hi, lo)
    conf = F.coalesce(F.col("confidence"), F.lit(0.0))
    queue = (
        F.when((F.col("result") == "fail") & (conf >= hi), "remediation")
        .when(F.col("result") == "fail", "human_review")
        .when((F.col("result") == "pass") & (conf < lo), "spot_check")
        .otherwise("none")
    )
    return results.withColumn("queue", queue)


def route_remediation(remediations: DataFrame, hi: float = 0.9, lo: float = 0.7) -> DataFrame:
    """Route of a recommendation; an uncertain one is turned into ``no_change`` and escalated."""
    _check_thresholds(hi, lo)
    conf = F.coalesce(F.col("confidence"), F.lit(0.0))
    acts = F.col("decision") != "no_change"
    return remediations.withColumns(
        {
            "route": F.when(~acts, "escalate").when(conf >= hi, "approval").when(conf >= lo, "manual").otherwise(
                "escalate"
            ),
            "effective_decision": F.when(conf >= lo, F.col("decision")).otherwise("no_change"),
        }
    )


def _check_thresholds(hi: float, lo: float) -> None:
    if not 0 <= lo <= hi <= 1:
        raise ValueError("thresholds must satisfy 0 <= lo <= hi <= 1")


# Raw-record fields a patch may name: every declared attribute of the event.
_PATCH_PATHS = tuple(
    f"attributes.{name}"
    for name in (
        "summary", "category", "found_at", "confidence", "article_sentence", "human_approved", "planning", "effective_date",
        *EVENT_STRING_FIELDS, *EVENT_INT_FIELDS, *EVENT_TAG_FIELDS, "location_data", "product_data",
    )
)


# Links of the event to other objects.
_LINK_PATH = r"^relationships\.[A-Za-z0-9_]+\.data\.id$"


def remediation_violations(remediations: DataFrame) -> DataFrame:
    """Recommendations that break the contract: adds ``violations``, keeps only rows with some.

    Checks the decision, that required parts are present, that an acting decision
    carries a patch, and that the patch's ``old_value`` is the record's value at
    its path (for the paths that can be read). Patches are never applied.
    """
    item = F.col("remediation")
    decision = string_at(item, "$.decision")
    path = string_at(item, "$.proposed_patch.path")
    confidence = F.try_variant_get(item, "$.confidence", "double")
    linked = path.rlike(_LINK_PATH)
    known_path = path.isin(*_PATCH_PATHS) | linked
    # one look-up serves all paths; text, numbers, booleans and lists alike compare by their JSON text
    at = F.concat(F.lit("$.data[0]."), path)
    present = F.when(known_path, F.call_function("get_json_object", F.col("source_record"), at))
    old_value = F.try_variant_get(item, "$.proposed_patch.old_value", "variant")
    nested = F.schema_of_variant(old_value).rlike("^(ARRAY|OBJECT)")
    old = F.when(nested, F.to_json(old_value)).otherwise(F.try_variant_get(item, "$.proposed_patch.old_value", "string"))
    same = F.when(nested, F.to_json(F.try_parse_json(present)).eqNullSafe(old)).otherwise(
        old.eqNullSafe(present) | F.coalesce(old.try_cast("double") == present.try_cast("double"), F.lit(False))
    )
    acts = decision.isin(*REMEDIATION_DECISIONS) & (decision != "no_change")
    rules = {
        "unknown_decision": ~F.coalesce(decision.isin(*REMEDIATION_DECISIONS), F.lit(False)),
        "missing_reasoning": F.coalesce(string_at(item, "$.reasoning"), F.lit("")) == "",
        "bad_confidence": ~F.coalesce(confidence.between(0.0, 1.0), F.lit(False)),
        "missing_patch": F.coalesce(acts, F.lit(False)) & path.isNull(),
        "stale_old_value": F.coalesce(known_path, F.lit(False)) & ~same,
        "missing_spans": F.try_variant_get(item, "$.evidence_spans", "array<variant>").isNull(),
        "missing_review_flag": boolean_at(item, "$.review_recommended").isNull(),
    }
    broken = F.array_compact(F.array(*[F.when(cond, F.lit(rule)) for rule, cond in rules.items()]))
    return remediations.withColumn("violations", broken).filter(F.size("violations") > 0)
