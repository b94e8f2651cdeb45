"""Schemas and closed vocabularies of the record-quality data model.

Raw records are nested documents ``{data: [event], included: [resource]}``.
Dates and timestamps stay strings at parse time: the payload passes them on
untouched and conformance checks judge the raw text.
"""

from __future__ import annotations

# ---- fixed values: vocabularies of the data model -------------------------
CHECKS = ("semantic_accuracy", "entity_resolution", "source_credibility")
TRIAGE_DECISIONS = ("pass", "fail", "escalate")
VERDICTS = ("pass", "fail")
HUMAN_LABELS = ("approve_fail", "override_pass", "needs_changes", "reject_record")
TRUTH_FAIL_LABELS = ("approve_fail", "needs_changes", "reject_record")
REMEDIATION_DECISIONS = (
    "correct_label",
    "correct_entity_link",
    "mark_low_credibility",
    "no_change",
)
ROLE_FITS = ("strong", "partial", "weak", "none")
EVIDENCE_FIELDS = ("article_sentence", "source_title", "source_body")
PROVIDERS = ("openai", "anthropic")
DEFAULT_MODEL_SPEC = "openai:gpt-4o-mini"
# USD per 1,000 tokens: model, input, output
TOKEN_PRICES = (
    ("gpt-4o-mini", 0.00015, 0.00060),
    ("gpt-4o", 0.00500, 0.01500),
    ("gpt-4.1", 0.01000, 0.03000),
)
REASON_WORD_LIMITS = {"semantic_accuracy": 60, "entity_resolution": 80, "source_credibility": 80}
# ---------------------------------------------------------------------------

EVENT_STRING_FIELDS = (
    "amount",
    "assets",
    "award",
    "contact",
    "division",
    "event",
    "financing_type",
    "financing_type_normalized",
    "job_title",
    "location",
    "product",
    "recognition",
    "vulnerability",
)
EVENT_INT_FIELDS = ("amount_normalized", "headcount")
EVENT_TAG_FIELDS = ("assets_tags", "financing_type_tags", "job_title_tags", "product_tags")

LOCATION = (
    "STRUCT<city STRING, state STRING, zip_code STRING, country STRING, region STRING, "
    "continent STRING, fuzzy_match BOOLEAN>"
)
PRODUCT = (
    "STRUCT<full_text STRING, name STRING, release_type STRING, release_version STRING, "
    "fuzzy_match BOOLEAN>"
)
EVENT_ATTRIBUTES = (
    "STRUCT<summary STRING, category STRING, found_at STRING, confidence DOUBLE, "
    "article_sentence STRING, human_approved BOOLEAN, planning BOOLEAN, "
    + ", ".join(f"{name} STRING" for name in EVENT_STRING_FIELDS)
    + ", "
    + ", ".join(f"{name} BIGINT" for name in EVENT_INT_FIELDS)
    + ", effective_date STRING, "
    + ", ".join(f"{name} ARRAY<STRING>" for name in EVENT_TAG_FIELDS)
    + f", location_data ARRAY<{LOCATION}>, product_data {PRODUCT}>"
)
INCLUDED = (
    "ARRAY<STRUCT<id STRING, type STRING, attributes STRUCT<domain STRING, company_name STRING, "
    "ticker STRING, author STRING, body STRING, image_url STRING, url STRING, "
    "published_at STRING, title STRING>>>"
)
RECORD_DDL = (
    f"data ARRAY<STRUCT<id STRING, type STRING, attributes {EVENT_ATTRIBUTES}, "
    f"relationships MAP<STRING, VARIANT>>>, included {INCLUDED}"
)
# Only what triage, the judge stage and the review screen read; a narrower
# parse than the full record, used on the hot path.
CORE_RECORD_DDL = (
    "data ARRAY<STRUCT<id STRING, attributes STRUCT<summary STRING, category STRING, "
    "found_at STRING, article_sentence STRING, effective_date STRING>>>, "
    "included ARRAY<STRUCT<id STRING, type STRING, attributes STRUCT<domain STRING, "
    "company_name STRING, author STRING, body STRING, url STRING, published_at STRING, "
    "title STRING>>>"
)

PAYLOAD_FIELDS = (
    "event_id",
    "labeled_event_type",
    "event_summary",
    "article_sentence",
    "source_title",
    "source_body",
    "event_date",
    "source_url",
    "published_at",
    "linked_entities",
)

# Rows of the result / remediation / audit files. Open parts are kept as the
# raw JSON text of the line; the type-sensitive keys come in as VARIANT.
RESULT_LINE_DDL = (
    "run_id VARIANT, prompt_version VARIANT, prompt_file STRING, created_at STRING, "
    "source_record STRING, llm_check STRING, model STRING, llm_metrics STRING"
)
REMEDIATION_LINE_DDL = (
    "run_id VARIANT, created_at STRING, check_name STRING, model STRING, source_record STRING, "
    "failed_check STRING, remediation STRING, llm_metrics STRING"
)
AUDIT_LINE_DDL = (
    "stage STRING, run_id VARIANT, check_name STRING, model STRING, provider STRING, "
    "prompt_file STRING, prompt_version STRING, latency_ms DOUBLE, usage STRING, "
    "cost_usd DOUBLE, decision STRING, request STRING, response STRING"
)


# Warehouse tables; NOT NULL is asserted on write, Parquet itself does not enforce it.
TABLE_DDL = {
    "records": (
        "event_id STRING NOT NULL, source_record_json STRING NOT NULL, "
        "first_seen_at TIMESTAMP, last_seen_at TIMESTAMP"
    ),
    "triage_results": (
        "id BIGINT, created_at TIMESTAMP, event_id STRING, decision STRING NOT NULL, reason STRING, "
        "run_id STRING NOT NULL"
    ),
    "llm_quality_results": (
        "id BIGINT, created_at TIMESTAMP, prompt_version STRING, prompt_file STRING, model STRING, "
        "event_id STRING NOT NULL, result STRING, confidence DOUBLE, reason STRING, "
        "llm_check_json STRING, llm_metrics_json STRING, source_record_json STRING, "
        "check_name STRING NOT NULL, run_id STRING NOT NULL"
    ),
    "llm_remediation_results": (
        "id BIGINT, run_id STRING, created_at TIMESTAMP, check_name STRING NOT NULL, model STRING, "
        "event_id STRING, failed_check_json STRING, remediation_json STRING, "
        "llm_metrics_json STRING, source_record_json STRING"
    ),
    "llm_call_audit": (
        "id BIGINT, created_at TIMESTAMP, stage STRING, run_id STRING, check_name STRING, "
        "model STRING, provider STRING, prompt_file STRING, prompt_version STRING, "
        "latency_ms DOUBLE, cost_usd DOUBLE, usage_json STRING, decision_json STRING, "
        "request_json STRING, response_json STRING"
    ),
    "human_review_labels": (
        "quality_result_id BIGINT NOT NULL, event_id STRING, check_name STRING, "
        "human_label STRING NOT NULL, reviewer STRING, notes STRING, labeled_at TIMESTAMP"
    ),
}
PARTITIONS = {
    "llm_quality_results": ("check_name", "run_id"),
    "triage_results": ("run_id",),
}
