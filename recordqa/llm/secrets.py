"""Secret scans with multipart credential linking, in Spark SQL only.

Patterns give base findings. Weak parts (opaque strings, endpoints) are no findings on their
own: an interval join over scopes keeps them only where complementary parts co-occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordqa.llm.common import stage, text_or_empty

#: The base kinds. Letters of the names in either case, ASCII only.
ASSIGN = (
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+"
)
#: Fixed value: what stands before the value inside an assignment.
ASSIGN_HEAD = (
    r"^(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?"
)
#: A run that is long enough begins and ends where the shortest form of the pattern does, so
#: the least length can stand in the pattern: no shorter match can hide a longer one.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Weak parts: long runs of base64 letters, and addresses of services.
OPAQUE = r"[A-Za-z0-9+/]{40,}"
ENDPOINT = r"(?:https?|s3|ftp|postgres|mysql|redis|amqp)://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+"

BASE = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX))
WEAK = (("opaque", OPAQUE), ("endpoint", ENDPOINT))
MIN_VALUE = 6
SCOPE_CHARS = 400
SPAN = "struct<start:int,rank:int,kind:string,end:int>"


def spans_of(text: Column, kind: str, rank: int, pattern: str, keep=None) -> Column:
    """Leftmost non-overlapping matches as an array of (start, rank, kind, end), in code points.

    Gaps between matches and matches alternate, so starts are running sums of their lengths.
    ``keep`` tells from the matched text whether a match stands. Both lists are bound once per
    row, in a one-element array: an expression inside a lambda is evaluated at every step. An array that
    grows is copied at every step, so spans are gathered in groups of about the root of their number.
    """
    lists = F.array(
        F.struct(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps")
        )
    )
    none = F.array().cast(f"array<{SPAN}>")

    def walk(row: Column) -> Column:
        n = F.size(row["found"])
        width = F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1))

        def step(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.length(row["gaps"][i])
            end = start + F.length(row["found"][i])
            span = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end")))
            out = F.concat(acc["out"], span)
            if keep is not None:
                out = F.when(keep(row["found"][i]), out).otherwise(acc["out"])
            return F.struct(end.alias("at"), out.alias("out"))

        def group(acc: Column, first: Column) -> Column:
            upto = F.least(first + width, n) - 1
            part = F.aggregate(F.sequence(first, upto), F.struct(acc["at"].alias("at"), none.alias("out")), step)
            return F.transform(F.array(part), lambda p: F.struct(p["at"].alias("at"), F.concat(acc["out"], p["out"]).alias("out")))[0]

        zero = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.aggregate(F.sequence(F.lit(0), n - 1, width), zero, group, lambda acc: acc["out"])

    return F.when(F.rlike(text, F.lit(pattern)), F.transform(lists, walk)[0]).otherwise(none)


def long_enough(found: Column) -> Column:
    """Whether an assignment's value has the least length."""
    return F.length(F.regexp_replace(found, ASSIGN_HEAD, "")) >= MIN_VALUE


def joined(spans: Column) -> Column:
    """kind:start:end, by start, then by kind as listed, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def linked(parts: DataFrame, weak: str, anchors: tuple[str, ...], scope: int) -> DataFrame:
    """Parts of kind ``weak`` that have a part of a kind in ``anchors`` within ``scope`` characters.

    An interval join: every anchor's scope is the interval of starts at most ``scope`` away.
    Starts are cut into buckets as wide as the scope. Anchors in the same bucket are in reach;
    of the bucket before only the last and of the bucket after only the first anchor can decide,
    so two numbers per bucket replace all pairs.
    """
    at = F.floor(F.col("start") / scope)
    near = (
        parts.where(F.col("kind").isin(*anchors))
        .groupBy("k1", "k2", at.alias("bucket"))
        .agg(F.min("start").alias("first"), F.max("start").alias("last"))
    )
    reach = near.select("k1", "k2", "first", "last", F.explode(F.array([F.col("bucket") + d for d in (-1, 0, 1)])).alias("bucket"))
    both = parts.where(F.col("kind") == weak).withColumn("bucket", at).join(reach, ["k1", "k2", "bucket"])
    gap = F.least(F.abs(F.col("start") - F.col("first")), F.abs(F.col("start") - F.col("last")))
    return both.where(gap <= scope).select("k1", "k2", "start", "rank", "kind", "end").distinct()


def uncovered(parts: DataFrame) -> DataFrame:
    """The parts without opaque ones of which a base finding of the same text covers anything.

    One pass over each text's parts in order: a base part that begins no later and ends behind the start
    overlaps, and so does one that begins inside.
    """
    own = F.col("kind").isin(*[k for k, _ in BASE])
    before = Window.partitionBy("k1", "k2").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy("k1", "k2").orderBy("start").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    reach, following = F.max(F.when(own, F.col("end"))).over(before), F.min(F.when(own, F.col("start"))).over(after)
    marked = parts.withColumns({"_reach": reach, "_next": following})
    covered = F.coalesce(F.col("_reach") > F.col("start"), F.lit(False)) | F.coalesce(F.col("_next") < F.col("end"), F.lit(False))
    return marked.where((F.col("kind") != "opaque") | ~covered).drop("_reach", "_next")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE_CHARS, with_key: bool = False) -> DataFrame:
    """One row per document: id (``with_key``: also k1, k2, the id as text and the text's hash), n_assign, n_access, n_hex, base (spans), spans (base and linked).

    Spans are arrays of (start, rank, kind, end), sorted. Base kinds are reported always. An
    opaque string is reported if an access identifier stands within ``scope`` characters and no
    base finding covers any of it; an endpoint if an access identifier or an assignment does.

    Null text is empty and gives no spans; empty tables give no rows; repeated rows get a row
    each, with the same spans; null ids are kept; other columns are ignored. A text of any length is
    scanned whole. Only spans are shuffled, never texts.
    """
    text = text_or_empty(text_col)
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    found = docs.select(
        F.col(id_col).alias("id"),
        key.alias("k1"),
        F.xxhash64(text).alias("k2"),
        *[
            spans_of(text, kind, rank, pattern, long_enough if kind == "assign" else None).alias(kind)
            for rank, (kind, pattern) in enumerate(BASE + WEAK)
        ],
    )
    rows = found.select("*", F.array_sort(F.concat(*[F.col(k) for k, _ in BASE])).alias("base"))
    rows = stage(rows, "secret-spans")
    parts = rows.where((F.size("opaque") > 0) | (F.size("endpoint") > 0)).select(
        "k1", "k2", F.explode(F.concat("base", "opaque", "endpoint")).alias("part")
    )
    parts = uncovered(parts.select("k1", "k2", "part.*").distinct())
    more = linked(parts, "opaque", ("access",), scope).unionByName(linked(parts, "endpoint", ("access", "assign"), scope))
    extra = more.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "rank", "kind", "end")).alias("extra"))
    return rows.join(extra, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col),
        *(("k1", "k2") if with_key else ()),
        *[F.size(k).cast("long").alias(f"n_{k}") for k, _ in BASE],
        "base",
        F.array_sort(F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.concat("base", "extra"))).alias("spans"),
    )


def masked(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every maximal run of overlapping spans replaced by ``mask``."""

    def step(acc: Column, s: Column) -> Column:
        ahead = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        new = F.struct(s["end"].alias("at"), F.concat(acc["out"], ahead, F.lit(mask)).alias("out"))
        grown = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when((s["start"] >= acc["at"]), new).otherwise(grown)

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(spans, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
