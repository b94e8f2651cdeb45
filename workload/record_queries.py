"""Queries over nested records built from ``documents``; the SQL twins read the flat content."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordqa.functions.ids import prompt_version, version_number
from recordqa.functions.text import (
    confidence_band,
    empty_to_null,
    valid_iso_timestamp,
    within_word_limit,
    word_count,
)
from recordqa.operators import conformance, duplicates, profile, records, sampling, triage as triage_ops
from recordqa.sources.lines import parse_records
from recordqa.sources.prompts import latest_prompts
from workload.views import flat_records, nested_lines, read, with_views


def _parsed(spark, sf):
    return parse_records(nested_lines(spark, sf))


def _payload(spark, sf):
    return records.extract_payload(_parsed(spark, sf))


def payload(spark, sf):
    return _payload(spark, sf).select(
        "event_id", "labeled_event_type", "event_summary", "article_sentence", "source_title",
        F.md5("source_body").alias("body_md5"), "event_date", "source_url", "published_at",
        F.size("linked_entities").alias("n_entities"),
    )


def company_entities(spark, sf):
    return _payload(spark, sf).select("event_id", F.explode("linked_entities").alias("e")).select("event_id", "e.*")


def check_input_semantic(spark, sf):
    out = records.check_input(records.eligible(_payload(spark, sf)), "semantic_accuracy")
    return out.select("input.*").withColumn("source_body", F.md5("source_body"))


def check_input_entity(spark, sf):
    out = records.check_input(records.eligible(_payload(spark, sf)), "entity_resolution", 0).select("input.*")
    return out.withColumns(
        {"source_body": F.md5("source_body"), "linked_entities": F.size("linked_entities")}
    )


def check_input_source(spark, sf):
    out = records.check_input(records.eligible(_payload(spark, sf)), "source_credibility").select("input.*")
    out = out.withColumn("source_body", F.md5("source_body"))
    return out.withColumn("possible_duplicate_count", F.col("dedupe_context.possible_duplicate_count")).drop(
        "dedupe_context"
    )


def check_input_truncated(spark, sf):
    """The one query of the truncation feature."""
    out = records.check_input(records.eligible(_payload(spark, sf)), "semantic_accuracy", 100)
    return out.select("input.event_id", "input.source_body")


def _context(check):
    def query(spark, sf):
        results = nested_lines(spark, sf).select(F.col("value").alias("source_record_json"))
        out = records.source_context(results, check).withColumn("source_body", F.md5("source_body"))
        if check == "entity_resolution":
            out = out.withColumn("companies", F.array_join(F.transform("companies", lambda c: c["company_name"]), "|"))
        if check == "source_credibility":
            out = out.select("*", F.col("source_metadata.url").alias("url"),
                             F.col("source_metadata.published_at").alias("published_at")).drop("source_metadata")
        return out

    return query


def triage(spark, sf):
    return triage_ops.triage(_parsed(spark, sf)).select("event_id", "decision", "reason")


def triage_counts(spark, sf):
    return triage_ops.triage_counts(triage_ops.triage(_parsed(spark, sf)))


def relationships(spark, sf):
    return conformance.relationships(parse_records(nested_lines(spark, sf), full=True))


def schema_violations(spark, sf):
    """Records with a wrong tag on every 23rd line and unreadable confidence on every 19th."""
    d, v = F.col("line_id"), F.col("value")
    v = F.when(d % 23 == 0, F.replace(v, F.lit('"type":"news_event"'), F.lit('"type":"event"'))).otherwise(v)
    v = F.when(d % 19 == 0, F.regexp_replace(v, '"confidence":[0-9.E-]+', '"confidence":"n/a"')).otherwise(v)
    lines = nested_lines(spark, sf).withColumn("value", v)
    return conformance.schema_violations(lines)


def null_profile(spark, sf):
    flat = empty_to_null(_payload(spark, sf).drop("linked_entities"))
    return profile.null_profile(flat).withColumn("null_share", F.round("null_share", 6))


def attribute_nulls(spark, sf):
    """All declared attributes of the fully parsed records."""
    flat = profile.event_attributes(parse_records(nested_lines(spark, sf), full=True))
    return profile.null_profile(flat).select("field", "rows", "nulls", "band")


FIELDS = ("event_id", "category", "article_sentence", "summary", "body", "lang")


def uniqueness_profile(spark, sf):
    out = profile.uniqueness_profile(empty_to_null(flat_records(spark, sf).select(*FIELDS)))
    return out.withColumn("unique_share", F.round("unique_share", 6))


def confidence_profile(spark, sf):
    out = profile.confidence_profile(flat_records(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in ("mean_confidence", "high_share")})


def confidence_histogram(spark, sf):
    return profile.confidence_histogram(flat_records(spark, sf))


def category_profile(spark, sf):
    out = profile.category_profile(flat_records(spark, sf), "category", None)
    return out.withColumn("share", F.round("share", 6))


def sparsity_by_category(spark, sf):
    flat = empty_to_null(flat_records(spark, sf).select(*FIELDS))
    out = profile.sparsity_by_category(flat, "lang", ("event_id", "category", "article_sentence"))
    return out.withColumn("null_share", F.round("null_share", 6))


def duplicate_ids(spark, sf):
    """Exact copies, by digest of the text."""
    rows = read(spark, sf, "documents").select(F.md5("text").alias("id"))
    return profile.duplicate_ids(rows)


def duplicate_summary(spark, sf):
    return profile.duplicate_summary(read(spark, sf, "documents").select(F.md5("text").alias("id")))


def dedupe(spark, sf):
    return profile.dedupe(flat_records(spark, sf), ("article_sentence", "body"), ("doc_id",)).select("doc_id", "event_id")


def constraint_report(spark, sf):
    flat = empty_to_null(flat_records(spark, sf))
    rules = {
        "id_not_null": profile.not_null("event_id"),
        "category_not_null": profile.not_null("category"),
        "sentence_not_null": profile.not_null("article_sentence"),
        "confidence_range": profile.in_range("confidence", 0.0, 0.5),
        "lang_taxonomy": profile.member_of("lang", ["en", "de"]),
    }
    return profile.constraint_report(flat, rules)


def published_constraints(spark, sf):
    d = F.col("doc_id")
    flat = empty_to_null(flat_records(spark, sf)).withColumns(
        {
            "id": F.col("event_id"), "type": F.when(d % 29 != 0, "news_event"), "found_at": F.when(d % 31 != 0, "2025-07-01"),
            "confidence": F.when(d % 23 == 0, 1.5).otherwise(F.col("confidence")),
            "human_approved": F.when(d % 19 == 0, "maybe").when(d % 2 == 0, "true").otherwise("false"),
            "financing_type_normalized": F.when(d % 5 == 0, "seed").when(d % 7 == 0, "odd"),
        }
    )
    known = [f"src{i}" for i in range(18)]
    return profile.constraint_report(flat, profile.published_rules(known, ["seed", "series_a"]))


def dedupe_published(spark, sf):
    """Both published keys one after the other."""
    rows = flat_records(spark, sf).withColumn("found_at", (F.col("doc_id") % 3).cast("string"))
    once = profile.dedupe(rows, ("found_at", "category", "summary"), ("doc_id",))
    return profile.dedupe(once, ("found_at", "article_sentence"), ("doc_id",)).select("doc_id")


def head_tokens(spark, sf):
    lines = read(spark, sf, "documents").select(F.split_part("text", F.lit("\n"), F.lit(1)).alias("name"))
    return profile.head_token_groups(lines, "name")


def unknown_values(spark, sf):
    known = read(spark, sf, "documents").filter("lang <> 'fr'").select(F.col("lang").alias("known")).distinct()
    return profile.unknown_values(flat_records(spark, sf), "lang", known, "known")


def variant_groups(spark, sf):
    """First lines that differ only in case and punctuation."""
    spelled = read(spark, sf, "documents").select(F.split_part("text", F.lit("\n"), F.lit(1)).alias("name"))
    return profile.variant_groups(spelled, "name").drop("canonical")


def _amounts(spark, sf):
    price, key = F.col("l_extendedprice").cast("double"), F.col("l_linenumber")
    whole = F.floor(price).cast("bigint").cast("string")
    text = (
        F.when(key == 1, F.concat(F.lit("€"), whole, F.lit("M")))
        .when(key == 2, F.concat(whole, F.lit(" billion baht")))
        .when(key == 3, F.concat(F.lit("£"), whole, F.lit(" million")))
        .when(key == 4, F.concat(whole, F.lit("K USD")))
        .when(key == 5, F.lit("undisclosed sum"))
        .otherwise(whole)
    )
    return read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.alias("amount"))


def parse_amount(spark, sf):
    return profile.parse_amount(_amounts(spark, sf)).select(
        "l_orderkey", "l_linenumber", "amount_value", "currency", "amount_parsed"
    )


def latest_prompts_query(spark, sf):
    """Prompt registry rules over one file name per document."""
    d = F.col("doc_id")
    name = F.concat(
        "source", F.lit("_"), "lang", F.when(d % 5 == 0, F.lit("_vfinal")).otherwise(F.concat(F.lit("_v"), (d % 12).cast("string"))),
        F.lit(".txt"),
    )
    version = prompt_version(F.col("file"))
    registry = (
        read(spark, sf, "documents")
        .groupBy(F.concat("source", F.lit("_"), "lang").alias("base"), name.alias("file"))
        .agg(F.max("text").alias("text"))
        .withColumn("version", version)
        .withColumn("version_num", version_number(F.col("version")))
    )
    return latest_prompts(registry).select("base", "version", "version_num", "file", F.md5("text").alias("text"))


def text_rules(spark, sf):
    """Scalar rules side by side: words, word limit, confidence band, timestamp validity."""
    stamp = F.when(F.col("doc_id") % 4 == 0, "2025-13-01T00:00:00Z").when(F.col("doc_id") % 4 == 1, "yesterday").otherwise(
        "2025-07-07T10:00:00Z"
    )
    return flat_records(spark, sf).select(
        "doc_id",
        word_count(F.col("summary")).alias("words"),
        within_word_limit(F.col("summary"), 30).alias("short_enough"),
        confidence_band(F.col("confidence")).alias("band"),
        valid_iso_timestamp(stamp).alias("valid_time"),
    )


def sample(spark, sf):
    return sampling.sample_records(read(spark, sf, "documents"), 100, seed=7, key=("doc_id",)).select("doc_id", "lang")


def sample_summary(spark, sf):
    return sampling.sample_summary(read(spark, sf, "documents"), 100)


def duplicate_counts(spark, sf):
    rows = flat_records(spark, sf).withColumn("event_summary", F.col("summary"))
    return duplicates.duplicate_counts(rows, "body").select("doc_id", "possible_duplicate_count")


def similar_summaries(spark, sf):
    rows = flat_records(spark, sf).withColumn("event_summary", F.col("summary"))
    return duplicates.similar_summaries(rows, "body").select("story", "event_summary", "cnt")


QUERIES = {
    f.__name__: f
    for f in (
        payload, company_entities, check_input_semantic, check_input_entity, check_input_source, check_input_truncated, triage,
        triage_counts, relationships, schema_violations, null_profile, attribute_nulls, uniqueness_profile,
        confidence_profile, confidence_histogram, category_profile, sparsity_by_category, duplicate_ids,
        duplicate_summary, dedupe, constraint_report, published_constraints, dedupe_published, head_tokens, unknown_values, variant_groups, parse_amount, text_rules,
        sample, sample_summary, duplicate_counts, similar_summaries,
    )
}
QUERIES["latest_prompts"] = latest_prompts_query
QUERIES["source_context_semantic"] = _context("semantic_accuracy")
QUERIES["source_context_entity"] = _context("entity_resolution")
QUERIES["source_context_source"] = _context("source_credibility")

# ---- SQL twins ------------------------------------------------------------
_DATE = "case when doc_id % 3 = 0 then '2025-07-01' end"
_ART = "case when not no_article then {} end"
_INPUT = (
    "event_id, category labeled_event_type, summary event_summary, article_sentence, "
    + _ART.format("left(body, 60)")
    + " source_title"
)
_CONTEXT = (
    "event_id, category, summary, article_sentence, "
    "strftime(to_timestamp(1751846400 + doc_id) at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ') found_at, "
    + _ART.format("left(body, 60)") + " source_title, " + _ART.format("md5(body)") + " source_body"
)
_EMPTY = "nullif(event_id, '') event_id, category, nullif(article_sentence, '') article_sentence"
_COMPANY = "select event_id, doc_id, lang, unnest(range(1, n_companies + 1)) i from rec"
_NORMAL = "trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def _unpivot(columns: dict[str, str], source: str) -> str:
    """One row per named column from a one-row aggregate."""
    return " union all ".join(f"select '{k}' field, {v} v, count(*) n from {source}" for k, v in columns.items())


_NULLS = {
    "event_id": "count(*) filter (event_id = '')",
    "labeled_event_type": "count(*) filter (coalesce(category, '') = '')",
    "event_summary": "count(*) filter (coalesce(summary, '') = '')",
    "article_sentence": "count(*) filter (coalesce(article_sentence, '') = '')",
    "source_title": "count(*) filter (no_article or body = '')",
    "source_body": "count(*) filter (no_article or body = '')",
    "event_date": "count(*) filter (doc_id % 3 <> 0)",
    "source_url": "count(*) filter (no_article)",
    "published_at": "count(*) filter (no_article)",
}
_FULL_NULLS = {
    "id": "0",
    "summary": "0",
    "category": "count(*) filter (category is null)",
    "found_at": "0",
    "confidence": "0",
    "article_sentence": "0",
    "effective_date": "count(*) filter (doc_id % 3 <> 0)",
    **{
        name: "count(*)"
        for name in (
            "human_approved planning amount assets award contact division event financing_type "
            "financing_type_normalized job_title location product recognition vulnerability amount_normalized "
            "headcount assets_tags financing_type_tags job_title_tags product_tags location_data "
            "product_data_full_text product_data_name product_data_release_type product_data_release_version "
            "product_data_fuzzy_match"
        ).split()
    },
}
_BAND = "case when {0} < 0.01 then 'complete' when {0} > 0.5 then 'mostly_null' else 'partial' end"
_UNIQUE = " union all ".join(
    f"select '{f}' field, count(*) \"rows\", count(*) - count(nullif({f}, '')) nulls, count(distinct nullif({f}, '')) d from rec"
    for f in FIELDS
)
_FLOOR = "CAST(CAST(floor(CAST(l_extendedprice AS DOUBLE)) AS BIGINT) AS DOUBLE)"

ORACLE = {
    "payload": with_views(
        f"select {_INPUT}, {_ART.format('md5(body)')} body_md5, {_DATE} event_date, "
        + _ART.format("concat('https://news.example/', doc_id)") + " source_url, "
        + _ART.format("'2025-07-07T00:00:00Z'") + " published_at, n_companies n_entities from rec", "rec"),
    "company_entities": with_views(
        "select event_id, concat('C', doc_id, '_', i) entity_id, 'company' entity_type, "
        f"concat('Company ', lang, ' ', i) entity_name, concat(lang, i, '.example') entity_domain from ({_COMPANY})", "rec"),
    "check_input_semantic": with_views(
        f"select {_INPUT}, {_ART.format('md5(body)')} source_body, {_DATE} event_date from rec "
        "where event_id <> ''", "rec"),
    "check_input_entity": with_views(
        f"select {_INPUT}, {_ART.format('md5(body)')} source_body, n_companies linked_entities from rec "
        "where event_id <> ''", "rec"),
    "check_input_source": with_views(
        f"select {_INPUT}, {_ART.format('md5(body)')} source_body, "
        + _ART.format("concat('https://news.example/', doc_id)") + " source_url, "
        + _ART.format("'2025-07-07T00:00:00Z'") + " published_at, CAST(0 AS BIGINT) possible_duplicate_count from rec "
        "where event_id <> ''", "rec"),
    "check_input_truncated": with_views(
        f"select event_id, {_ART.format('left(body, 100)')} source_body from rec where event_id <> ''", "rec"),
    "source_context_semantic": with_views(f"select {_CONTEXT} from rec", "rec"),
    "source_context_entity": with_views(
        f"select {_CONTEXT}, case n_companies when 0 then '' when 1 then concat('Company ', lang, ' 1') "
        "else concat('Company ', lang, ' 1|Company ', lang, ' 2') end companies from rec", "rec"),
    "source_context_source": with_views(
        f"select {_CONTEXT}, " + _ART.format("concat('https://news.example/', doc_id)") + " url, "
        + _ART.format("'2025-07-07T00:00:00Z'") + " published_at from rec", "rec"),
    "triage": with_views(
        "select event_id, case when bad then 'fail' else 'escalate' end decision, case when bad then "
        "'Missing required event fields' else 'Required fields present' end reason from (select *, "
        "(event_id = '' or coalesce(category, '') = '' or article_sentence = '') bad from rec)", "rec"),
    "triage_counts": with_views(
        'select CAST(0 AS BIGINT) "pass", count(*) filter (bad) fail, count(*) filter (not bad) escalate from (select '
        "(event_id = '' or coalesce(category, '') = '' or article_sentence = '') bad from rec)", "rec"),
    "relationships": with_views(
        "select event_id, 'company1' rel, concat('C', doc_id, '_1') target_id, 'company' target_type from rec "
        "where n_companies >= 1 union all select event_id, 'mentioned', concat('C', doc_id, '_', i), 'company' from "
        "(select event_id, doc_id, unnest(range(1, greatest(n_companies, 1) + 1)) i from rec)", "rec"),
    "schema_violations": with_views("""
select event_id, 'data' part, CAST(0 AS INT) "position", field, rule from (
  select event_id, unnest(['human_approved', 'planning']) field, 'missing' rule from rec
  union all select event_id, 'category', 'missing' from rec where category is null
  union all select event_id, 'type', 'tag' from rec where doc_id % 23 = 0
  union all select event_id, 'confidence', 'type' from rec where doc_id % 19 = 0)""", "rec"),
    "null_profile": with_views(
        f"select field, n \"rows\", v nulls, round(v / n, 6) null_share, {_BAND.format('v / n')} band "
        f"from ({_unpivot(_NULLS, 'rec')})", "rec"),
    "attribute_nulls": with_views(
        f"select field, n \"rows\", CAST(v AS BIGINT) nulls, {_BAND.format('v / n')} band from ({_unpivot(_FULL_NULLS, 'rec')})", "rec"),
    "uniqueness_profile": with_views(
        'select field, "rows", nulls, d distinct_values, round(d / ("rows" - nulls), 6) unique_share, '
        'case when nulls = 0 and d / "rows" >= 0.999 then \'key\' when nulls = 0 and d / "rows" >= 0.97 then \'weak\' '
        f"else 'no' end key_verdict from ({_UNIQUE})", "rec"),
    "confidence_profile": with_views(
        "select count(confidence) n, CAST(min(confidence) AS DOUBLE) min_confidence, CAST(max(confidence) AS DOUBLE) "
        "max_confidence, round(CAST(avg(confidence) AS DOUBLE), 6) mean_confidence, count(*) filter (confidence > 0.9) "
        "high_count, round(count(*) filter (confidence > 0.9) / count(confidence), 6) high_share from rec", "rec"),
    "confidence_histogram": with_views(
        "select CAST((doc_id % 100) // 10 + 1 AS INT) bin, count(*) cnt from rec group by 1", "rec"),
    "category_profile": with_views(
        "select category, count(*) cnt, round(count(*) / (select count(category) from rec), 6) share, "
        "(select count(distinct category) from rec) n_categories from rec where category is not null group by 1", "rec"),
    "sparsity_by_category": with_views(
        "select lang category, field, count(*) \"rows\", round(1 - count(v) / count(*), 6) null_share from ("
        "select lang, 'event_id' field, nullif(event_id, '') v from rec union all select lang, 'category', category from "
        "rec union all select lang, 'article_sentence', nullif(article_sentence, '') from rec) group by 1, 2", "rec"),
    "duplicate_ids": "select md5(text) id, count(*) copies, count(*) - 1 excess from documents group by 1 having count(*) > 1",
    "duplicate_summary": "select count(*) duplicated_ids, CAST(coalesce(sum(c - 1), 0) AS BIGINT) excess_rows from "
        "(select count(*) c from documents group by md5(text) having count(*) > 1)",
    "dedupe": with_views(
        "select doc_id, event_id from (select *, row_number() over (partition by article_sentence, body order by doc_id) "
        "r from rec) where r = 1", "rec"),
    "constraint_report": with_views(" union all ".join(
        f"select '{rule}' rule, count(*) \"rows\", count(*) filter ({bad}) violations from rec" for rule, bad in {
            "id_not_null": "event_id = ''", "category_not_null": "category is null",
            "sentence_not_null": "article_sentence = ''", "confidence_range": "confidence > 0.5",
            "lang_taxonomy": "lang not in ('en', 'de')"}.items()), "rec"),
    "published_constraints": with_views(" union all ".join(
        f"select '{rule}' rule, count(*) \"rows\", count(*) filter ({bad}) violations from rec" for rule, bad in {
            "id_not_null": "event_id = ''", "type_not_null": "doc_id % 29 = 0", "found_at_not_null": "doc_id % 31 = 0",
            "article_sentence_not_null": "article_sentence = ''", "summary_not_null": "coalesce(summary, '') = ''",
            "confidence_range": "doc_id % 23 = 0", "human_approved_boolean": "doc_id % 19 = 0",
            "category_taxonomy": "category in ('src18', 'src19')",
            "financing_type_taxonomy": "doc_id % 5 <> 0 and doc_id % 7 = 0"}.items()), "rec"),
    "dedupe_published": with_views("""
select doc_id from (select *, row_number() over (partition by doc_id % 3, article_sentence order by doc_id) r2 from (
  select *, row_number() over (partition by doc_id % 3, category, summary order by doc_id) r from rec) where r = 1) where r2 = 1""", "rec"),
    "head_tokens": f"""
select {_NORMAL.format("split_part(split_part(text, chr(10), 1), ',', 1)")} head, split_part(text, chr(10), 1) variant, count(*) cnt
from documents where text is not null group by 1, 2""",
    "unknown_values": "select lang \"value\", count(*) cnt from documents where lang = 'fr' group by 1",
    "variant_groups": f"""
with s as (select split_part(text, chr(10), 1) variant, count(*) cnt from documents where text is not null group by 1),
n as (select *, {_NORMAL.format("variant")} normal_form from s),
g as (select normal_form, count(*) n_variants, CAST(sum(cnt) AS BIGINT) n_rows from n group by 1 having count(*) > 1)
select normal_form, variant, cnt, n_variants, n_rows from n join g using (normal_form)""",
    "parse_amount": f"""
select l_orderkey, l_linenumber, case when l_linenumber = 5 then null else {_FLOOR} * case l_linenumber
    when 1 then 1e6::DOUBLE when 2 then 1e9::DOUBLE when 3 then 1e6::DOUBLE when 4 then 1e3::DOUBLE else 1::DOUBLE end end amount_value,
  case l_linenumber when 1 then 'EUR' when 2 then 'THB' when 3 then 'GBP' when 4 then 'USD' end currency,
  l_linenumber <> 5 amount_parsed from lineitem""",
    "latest_prompts": """
select base, version, version_num, file, md5(text) "text" from (select *, row_number() over (partition by base order by version_num desc, file desc) r
from (select concat(source, '_', lang) base, max(text) "text",
  case when doc_id % 5 = 0 then 'vfinal' else concat('v', doc_id % 12) end version,
  CAST(case when doc_id % 5 = 0 then 0 else doc_id % 12 end AS INT) version_num,
  concat(source, '_', lang, case when doc_id % 5 = 0 then '_vfinal' else concat('_v', doc_id % 12) end, '.txt') file
from documents group by all)) where r = 1""",
    "text_rules": with_views(r"""
select doc_id, CAST(w AS INT) words, w <= 30 short_enough,
  case when confidence >= 0.9 then 'unambiguous' when confidence >= 0.7 then 'strong' when confidence >= 0.4 then 'mixed'
       else 'unsupported' end band, doc_id % 4 >= 2 valid_time
from (select *, len(list_filter(regexp_split_to_array(summary, '\s+'), lambda x: x <> '')) w from rec)""", "rec"),
    "sample": "select doc_id, lang from documents order by md5(concat('7~', md5(CAST(doc_id AS VARCHAR)), '~1')) limit 100",
    "sample_summary": "select count(*) seen, least(count(*), 100) kept from documents",
    "duplicate_counts": f"""
with k as (select doc_id, nullif({_NORMAL.format("text")}, '') f from documents)
select doc_id, case when f is null then 0 else count(*) over (partition by f) - 1 end possible_duplicate_count from k""",
    "similar_summaries": f"""
with k as (select nullif({_NORMAL.format("text")}, '') f, text event_summary from documents)
select md5(f) story, event_summary, count(*) cnt from k where f in (select f from k group by 1 having count(*) > 1) group by 1, 2""",
}
