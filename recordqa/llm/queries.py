"""Registered queries of the corpus operators, over whole tables, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordqa.llm import (
    conversation_trie, embeddings, filter_audit, language, mixing, personal_data, secrets, simhash, suffixes, tiling, toxicity, url_lists, warc,
)
from recordqa.llm.common import stage, table


def _number(text, of: int):
    """A number below ``of`` that MD5 draws from a text."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % of


def op1_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures are the pages, fetched on a day drawn from the id; every pattern of their URLs has a history of four
    events in each of two lists, with days and actions drawn from the pattern."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", _number(F.concat(F.lit("fetch:"), F.coalesce(F.col("page_id").cast("string"), F.lit(""))), 3650))
    seen = pages.select(F.explode(url_lists.patterns_of(F.col("url"))).alias("pattern")).distinct()
    name = F.concat_ws(":", "list", "pattern", F.col("n").cast("string"))
    events = (
        seen.withColumn("list", F.explode(F.array(F.lit("block"), F.lit("allow"))))
        .withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(4))))
        .select("list", "pattern", _number(name, 3650).alias("at"), F.when(_number(F.concat(F.lit("act:"), name), 3) > 0, "add").otherwise("remove").alias("action"))
    )
    return url_lists.evaluate(captures, events)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), n_words=4, max_bits=4)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write_archive(table(spark, sf_dir, "pages"), min_revisit_bytes=0)
    page = lambda c: F.nullif(F.col(c), F.lit("null")).cast("long")
    return warc.read_records(spark, archive).select(
        page("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to")
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: their source is the host; they declare nothing. Their lang column trains the text model only."""
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs), F.col("text"), host=F.col("source"), keep=["doc_id"])


def language_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages: text, declared language, address suffix and host, with the text model of the documents."""
    html, pages = F.col("html"), table(spark, sf_dir, "pages")
    return language.identify(
        pages, language.fit(table(spark, sf_dir, "documents")), language.page_text(html),
        language.page_declared(html), language.page_host(F.col("url")), keep=["page_id"],
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The removed bytes of every document, and whether there are any."""
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"), length=400)
    return found.withColumn("has_repeats", F.col("n_removed") > 0)


def op10_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("k1").alias("doc_id"), F.col("item").alias("item_id"), "n_tiles", "covered", "item_tokens", "coverage")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the conversations, whose first turns are those of the first conversation of their hundred."""
    turns = table(spark, sf_dir, "conversations")
    return conversation_trie.prefix_trie(stage(conversation_trie.respliced(turns), "trie-paths"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find_personal_data(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_url_lists": op1_url_lists,
    "op2_simhash": op2_simhash,
    "op3_warc": op3_warc,
    "op4_toxicity": op4_toxicity,
    "op5_embeddings": op5_embeddings,
    "op6_mixing": op6_mixing,
    "op7_language": op7_language,
    "language_of_pages": language_of_pages,
    "op8_secrets": op8_secrets,
    "op9_suffixes": op9_suffixes,
    "op10_tiling": op10_tiling,
    "op11_filter_audit": op11_filter_audit,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_personal_data": op13_personal_data,
}

_B32 = " || ".join(f"to_base(CAST('0x' || substr(h, {at}, 5) AS BIGINT), 32, 4)" for at in range(1, 41, 5))


def _spans(rank: int, kind: str, pattern: str, keep: str = "true") -> str:
    """Matches of one kind as rows (row, rank, kind, start_at, end_at) in DuckDB SQL."""
    quoted = pattern.replace("'", "''")
    return f"""
          SELECT row, {rank} AS rank, '{kind}' AS kind, start_at, start_at + length(found[i + 1]) AS end_at FROM (
            SELECT row, found, i, CAST(list_sum(list_transform(gaps[1:i + 1], lambda x: length(x)))
                   + coalesce(list_sum(list_transform(found[1:i], lambda x: length(x))), 0) AS INTEGER) AS start_at
            FROM (SELECT *, unnest(range(len(found))) AS i FROM (
              SELECT row, regexp_extract_all(text, '{quoted}') AS found, string_split_regex(text, '{quoted}') AS gaps
              FROM texts WHERE regexp_matches(text, '{quoted}'))))
          WHERE {keep}"""


_KEEP = f"length(regexp_replace(found[i + 1], '{secrets.ASSIGN_HEAD.replace("'", "''")}', '')) >= 6"

ORACLE = {
    "op3_warc": f"""
        SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
               translate({_B32}, '{warc.CONV32}', '{warc.BASE32}') AS payload_digest,
               CASE WHEN m IS NOT NULL AND page_id IS DISTINCT FROM m THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM m THEN m END AS refers_to
        FROM (SELECT *, sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS m FROM pages)
    """,
    "op8_secrets": f"""
        WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
        base AS ({" UNION ALL ".join(_spans(r, k, p, _KEEP if k == "assign" else "true") for r, (k, p) in enumerate(secrets.BASE))}),
        weak AS ({" UNION ALL ".join(_spans(r, k, p) for r, (k, p) in enumerate(secrets.WEAK, len(secrets.BASE)))}),
        linked AS (
          SELECT w.* FROM weak w
          WHERE (w.kind = 'endpoint' OR NOT EXISTS (
                   SELECT 1 FROM base b WHERE b.row = w.row AND b.start_at < w.end_at AND w.start_at < b.end_at))
            AND EXISTS (SELECT 1 FROM base b WHERE b.row = w.row AND abs(b.start_at - w.start_at) <= 400
                          AND (b.kind = 'access' OR w.kind = 'endpoint' AND b.kind = 'assign'))),
        named AS (
          SELECT row, rank, kind, start_at, kind || ':' || start_at || ':' || end_at AS span, true AS own FROM base
          UNION ALL SELECT row, rank, kind, start_at, kind || ':' || start_at || ':' || end_at, false FROM linked),
        joined AS (
          SELECT row, count(*) FILTER (own AND kind = 'assign') AS n_assign, count(*) FILTER (own AND kind = 'access') AS n_access,
                 count(*) FILTER (own AND kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY start_at, rank) FILTER (own) AS base,
                 string_agg(span, ',' ORDER BY start_at, rank) AS spans
          FROM named GROUP BY row)
        SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM texts t LEFT JOIN joined j ON t.row = j.row
    """,
    "op1_url_lists": r"""
        WITH parsed AS (
          SELECT page_id, CAST('0x' || substr(md5('fetch:' || coalesce(CAST(page_id AS VARCHAR), '')), 1, 8) AS BIGINT) % 3650 AS fetched,
                 nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/:?#]+)', 1)), '\.$', ''), '') AS host,
                 string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') AS steps,
                 row_number() OVER () AS row
          FROM pages),
        keys AS (
          SELECT *, list_distinct(list_concat(
                   list_transform(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1),
                                  lambda i: array_to_string(string_split(host, '.')[i:], '.')),
                   list_transform(range(2, len(steps)),
                                  lambda n: host || '/' || lower(array_to_string(steps[2:n], '/')) || '/'))) AS patterns
          FROM parsed WHERE host IS NOT NULL),
        wanted AS (SELECT row, fetched, unnest(patterns) AS pattern FROM keys),
        events AS (
          SELECT DISTINCT list, pattern,
                 CAST('0x' || substr(md5(list || ':' || pattern || ':' || n), 1, 8) AS BIGINT) % 3650 AS at_day,
                 CASE WHEN CAST('0x' || substr(md5('act:' || list || ':' || pattern || ':' || n), 1, 8) AS BIGINT) % 3 > 0
                      THEN 'add' ELSE 'remove' END AS action
          FROM (SELECT DISTINCT pattern FROM wanted), (VALUES ('block'), ('allow')) l(list), range(1, 5) r(n)),
        spans AS (
          SELECT *, lead(at_day) OVER (PARTITION BY list, pattern ORDER BY at_day, action) AS until FROM events),
        active AS (
          SELECT w.row, s.list, s.pattern,
                 row_number() OVER (PARTITION BY w.row ORDER BY length(s.pattern) DESC, s.list <> 'allow', s.pattern, s.list) AS place,
                 count(*) OVER (PARTITION BY w.row) AS n
          FROM wanted w JOIN spans s ON w.pattern = s.pattern AND s.action = 'add'
            AND s.at_day <= w.fetched AND (s.until IS NULL OR w.fetched < s.until))
        SELECT p.page_id, p.fetched, coalesce(a.n, 0) AS n_active, coalesce(a.list, 'none') AS decision, a.pattern
        FROM parsed p LEFT JOIN active a ON p.row = a.row AND a.place = 1
    """,
    "op5_embeddings": """
        WITH RECURSIVE sound AS (
          SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            AND list_cosine_similarity(a.e, b.e) >= 0.98),
        reach AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
        least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
        SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.vec_id) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
        FROM embeddings v JOIN least c ON v.vec_id = c.vec_id
    """,
    "op6_mixing": r"""
        WITH sized AS (
          SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
          FROM documents),
        sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
        ranked AS (
          SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank,
                 CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS DOUBLE) AS w,
                 2.0::DOUBLE * source_size AS cap
          FROM sources),
        filling AS (
          SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
                     - coalesce(sum(cap) OVER (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
                    / sum(w) OVER (ORDER BY cap / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
          FROM ranked),
        opened AS (
          SELECT *, first(CASE WHEN level * w <= cap THEN level END IGNORE NULLS) OVER (
                      ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS open
          FROM filling),
        targets AS (SELECT source, source_size, greatest(coalesce(least(cap, open * w), cap), 0.0) AS target FROM opened),
        placed AS (
          SELECT d.doc_id, d.size, t.source_size, t.target,
                 coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')),
                   d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_at
          FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
        epochs AS (
          SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(floor(target) / source_size) AS BIGINT) ELSE 0 END AS epochs FROM placed)
        SELECT doc_id, size, source_size, target,
               CAST(epochs * size + greatest(0, least(CAST(floor(target) AS BIGINT) - epochs * source_size - start_at, size)) AS BIGINT) AS taken
        FROM epochs
    """,
    "op11_filter_audit": r"""
        WITH texts AS (
          SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                 coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS again,
                 regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
          FROM documents),
        failing AS (
          SELECT part, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
                 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c,
                 regexp_matches(text, '[#$%&*|]') AS d, again AS e,
                 doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) IS TRUE AS good,
                 doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) IS TRUE AS toxic
          FROM texts),
        cells AS (SELECT part, a, b, c, d, e, good, toxic, count(*) AS n FROM failing GROUP BY ALL),
        letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (
          SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letter p, letter q, letter r, letter s, letter t
          WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
        fates AS (
          SELECT part, filter_order, n, good, toxic, fails, n_fails,
                 list_min(list_transform(fails, lambda x: instr(filter_order, x))) AS gone_at
          FROM (SELECT part, n, good, toxic, list_filter(
                         [CASE WHEN a THEN 'A' END, CASE WHEN b THEN 'B' END, CASE WHEN c THEN 'C' END, CASE WHEN d THEN 'D' END,
                          CASE WHEN e THEN 'E' END], lambda x: x IS NOT NULL) AS fails, len(fails) AS n_fails FROM cells), orders),
        counted AS (
          SELECT part, filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, CAST(step AS INTEGER), 1) AS f,
                 CAST(coalesce(sum(n) FILTER (gone_at IS NULL OR gone_at > step), 0) AS BIGINT) AS kept,
                 CAST(coalesce(sum(n) FILTER (gone_at = step), 0) AS BIGINT) AS removed,
                 CAST(coalesce(sum(n) FILTER (gone_at < step AND list_contains(fails, substr(filter_order, CAST(step AS INTEGER), 1))), 0) AS BIGINT) AS redundant,
                 CAST(coalesce(sum(n) FILTER (n_fails = 1 AND list_contains(fails, substr(filter_order, CAST(step AS INTEGER), 1))), 0) AS BIGINT) AS unique_fails,
                 CAST(coalesce(sum(n) FILTER (gone_at = step AND good), 0) AS BIGINT) AS good_lost,
                 CAST(coalesce(sum(n) FILTER (gone_at = step AND toxic), 0) AS BIGINT) AS toxic_lost
          FROM fates, range(1, 6) s(step) GROUP BY part, filter_order, step)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
        FROM counted
    """,
    "op12_conversation_trie": """
        WITH crc AS (
          SELECT list(c ORDER BY i) AS crc_of FROM (
            SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
            FROM range(256) r(i))),
        said AS (
          SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                               ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS turns
          FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        drawn AS (
          SELECT conv_id, turns, xor(list_reduce(
                   list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                   lambda c, b: xor(c // 256, crc_of[xor(c % 256, b) + 1])), 4294967295) % 6 AS h
          FROM said, crc),
        paths AS (
          SELECT d.conv_id, list_concat(coalesce(b.turns[1:d.h], []), d.turns[d.h + 1:]) AS path
          FROM drawn d LEFT JOIN said b ON b.conv_id = d.conv_id - d.conv_id % 100),
        prefixes AS (SELECT conv_id, len(path) AS n_turns, path[1:d] AS node, d AS depth FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM paths)),
        nodes AS (
          SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n_turns = depth), '')) AS ends_sha256
          FROM prefixes GROUP BY node, depth),
        linked AS (
          SELECT n.*, p.conv_id AS parent_conv_id,
                 (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.node[1:n.depth] = n.node) AS n_children
          FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]),
        below AS (
          SELECT t.node, t.depth, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
                 sum(CASE WHEN u.depth > 0 THEN (u.n_convs - 1) * length(u.node[u.depth].text) ELSE 0 END) AS saved_tokens
          FROM linked t JOIN linked u ON u.depth >= t.depth AND u.node[1:t.depth] = t.node GROUP BY t.node, t.depth)
        SELECT l.conv_id, CAST(l.depth AS BIGINT) AS depth, l.parent_conv_id, l.n_convs, l.n_children,
               CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, l.ends_sha256
        FROM linked l JOIN below b ON l.node = b.node AND l.depth = b.depth
    """,
}
