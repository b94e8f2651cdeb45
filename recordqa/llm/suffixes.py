"""Exact substring dedup over a logarithmic family of sparse suffix indexes.

Removed is every byte that a string of ``length`` bytes covers which also starts elsewhere. Of each
window of ``length`` bytes the index holds the suffix at the window's minimizer, the ``anchor`` bytes
with the least hash. What a window holds decides its minimizer, so two equal windows index the same
suffix at the same offset, and nothing is lost by holding one suffix in about ``(length - anchor) / 2``.
Suffixes are ordered by a hash of their first ``anchor`` bytes and by a hash of all the bytes their windows
cover; those equal in both are one class, held once with its count and one place.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordqa.llm.common import empty, map_rows, stage, text_or_empty

LENGTH, ANCHOR, BATCHES = 400, 200, 4
#: Windows of a text that are handled at once: bounds memory on very long texts.
PIECE = 1 << 20
#: Bases of the rolling hashes, odd numbers. Two strings are held equal if their hashes by both, mixed, are.
_BASE, _OTHER = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


@functools.lru_cache(maxsize=4)
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    up = np.full(n, base, np.uint64)
    down = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class _Sums:
    """Hashes of any strings of one piece of bytes, from prefix sums."""

    def __init__(self, data: np.ndarray, base: int):
        self.up, down = _powers(1 << max(12, int(len(data)).bit_length()), base)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down[: len(data)], out=self.sums[1:])

    def all_of(self, width: int) -> np.ndarray:
        """Of all strings of ``width`` bytes."""
        n = len(self.sums) - width
        return _mixed((self.sums[width:] - self.sums[:-width]) * self.up[:n])

    def at(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.up[start])


def _entries(data: bytes, length: int, anchor: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By pieces of the text: where the piece begins, and of each anchor its start in it, first and last start
    of the windows it stands for, its hash, and the hash of all bytes of the windows and its place in them."""
    windows, span = len(data) - length + 1, length - anchor + 1
    for base in range(0, windows, PIECE):
        piece = np.frombuffer(data, np.uint8)[base : min(len(data), base + PIECE + length - 1)]
        one, two = _Sums(piece, _BASE), _Sums(piece, _OTHER)
        h = one.all_of(anchor)
        keys = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)  # ties: leftmost
        blocks = -(-len(h) // span)
        padded = np.full(blocks * span, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[: len(h)] = keys
        padded = padded.reshape(blocks, span)
        ahead = np.minimum.accumulate(padded, axis=1).ravel()
        behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(h) - span + 1
        least = np.minimum(behind[:n], ahead[span - 1 : span - 1 + n])
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        last = np.r_[first[1:], n] - 1
        at = (least[first] & np.uint64(0xFFFFFF)).astype(np.int64)
        place = ((at - first) * length * 2 + (last - first)).astype(np.uint64) * np.uint64(_OTHER)
        stretch = _mixed(one.at(first, last + length) + place) ^ two.at(first, last + length)
        yield base, at, first, last, h[at].view(np.int64), stretch.view(np.int64)


def minimizers(data: bytes, length: int, anchor: int) -> Iterator[tuple[int, int, int, int]]:
    """(anchor's start, first and last start of the windows it stands for, anchor's hash)."""
    for base, at, first, last, head, _ in _entries(data, length, anchor):
        yield from zip((base + at).tolist(), (base + first).tolist(), (base + last).tolist(), head.tolist())


#: What tells a class of suffixes, and where one of it stands: the text, the first window's start, how far from
#: there the suffix and the last window start.
CLASS, PLACE = ["head", "stretch"], ["k1", "k2", "first", "lead", "reach"]


def suffix_entries(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """Index entries (head, stretch, k1, k2, first, lead, reach) of texts (k1, k2, text): a hash of the anchor, a
    hash of all the bytes its windows cover and of its place in them, and the place."""

    def rows(batch):
        out: dict = {n: [] for n in CLASS + PLACE}
        held = 0
        for k1, k2, text in zip(batch["k1"], batch["k2"], batch["text"]):
            data = text.encode("utf-8", "surrogatepass")
            for base, at, first, last, head, stretch in _entries(data, length, anchor):
                n = len(at)
                found = (head, stretch, np.full(n, k1), np.full(n, k2), base + first, at - first, last - first)
                for name, v in zip(out, found):
                    out[name].append(v)
                held += n
            if held > 100_000:
                yield joined(out)
                out, held = {n: [] for n in out}, 0
        if held:
            yield joined(out)

    def joined(out):
        return {n: np.concatenate(v).astype(np.int64 if n in CLASS + ["k1", "k2"] else np.int32) for n, v in out.items()}

    return map_rows(docs, rows, "head long, stretch long, k1 long, k2 long, first int, lead int, reach int")


def _level(rows: DataFrame) -> DataFrame:
    """Classes with their counts and one place each, in order."""
    one = [F.first(c).alias(c) for c in PLACE]  # places of one row, as nothing is null
    return stage(rows.groupBy(*CLASS).agg(F.sum("n").alias("n"), *one).sortWithinPartitions(*CLASS), "suffix-level")


class SuffixFamily:
    """Levels of sorted suffix indexes (head, stretch, n and a place); level sizes double.

    A new batch is sorted into an index of its own, scanned together with every level for heads that stand
    in two places, and put in; levels of equal rank merge into one of the next, so a batch is written
    log(batches) times in all. A family can be stored and opened again for the batches of another day.
    """

    def __init__(self, levels: Iterable[tuple[int, DataFrame]] = ()):
        self.levels = list(levels)
        self._stored = [level for _, level in self.levels]

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> SuffixFamily:
        """The family stored at ``path``, which is only read."""
        table = spark.read.parquet(path)
        ranks = sorted((r[0] for r in table.select("rank").distinct().collect()), reverse=True)
        return cls((r, table.where(F.col("rank") == r).drop("rank")) for r in ranks)

    def save(self, path: str) -> None:
        """Writes the levels to a new path, partitioned by rank."""
        if not self.levels:
            raise ValueError("a family without a batch is not stored")
        levels = [level.withColumn("rank", F.lit(rank)) for rank, level in self.levels]
        functools.reduce(DataFrame.unionByName, levels).write.partitionBy("rank").parquet(path)

    def add(self, entries: DataFrame) -> DataFrame:
        """Puts entries in; returns the heads of theirs that stand in at least two places, old or new."""
        run = _level(entries.select(*CLASS, F.lit(1).cast("long").alias("n"), *PLACE))
        sides = [run.select("head", "n", F.lit(True).alias("new"))]
        sides += [level.select("head", "n", F.lit(False).alias("new")) for _, level in self.levels]
        met = functools.reduce(DataFrame.unionByName, sides).groupBy("head").agg(F.sum("n").alias("n"), F.max("new").alias("new"))
        met = stage(met.where("new and n > 1").select("head"), "suffix-matches")
        rank = 0
        while self.levels and self.levels[-1][0] == rank:
            _, level = self.levels.pop()
            merged = _level(level.unionByName(run))
            self._free(level, run)
            run, rank = merged, rank + 1
        self.levels.append((rank, run))
        return met

    def classes(self, heads: DataFrame) -> DataFrame:
        """Classes (head, stretch, n and a place) of the given heads, over all levels."""
        rows = functools.reduce(DataFrame.unionByName, [level for _, level in self.levels]).join(heads, "head", "left_semi")
        return _level(rows)

    def close(self) -> None:
        """Frees the levels, stored ones excepted."""
        self._free(*[level for _, level in self.levels])
        self.levels = []

    def _free(self, *levels: DataFrame) -> None:
        empty(*[level for level in levels if not any(level is kept for kept in self._stored)])


def _windows(reps: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """All windows of representative entries: head, stretch, how far the suffix is from the window's start, hash of the window."""
    lists = reps.groupBy("k1", "k2").agg(F.collect_list(F.struct(*CLASS, "first", "lead", "reach")).alias("entries"))

    def rows(batch):
        out: dict = {n: [] for n in ("head", "stretch", "offset", "window")}
        held = 0
        for text, entries in zip(batch["text"], batch["entries"]):
            data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
            for e in entries:
                n = e["reach"] + 1
                piece = data[e["first"] : e["first"] + e["reach"] + length]
                window = _mixed(_Sums(piece, _BASE).all_of(length)) ^ _Sums(piece, _OTHER).all_of(length)
                offset = e["lead"] - np.arange(n, dtype=np.int32)
                for name, v in zip(out, (np.full(n, e["head"]), np.full(n, e["stretch"]), offset, window.view(np.int64))):
                    out[name].append(v)
                held += n
                if held > 100_000:
                    yield {n: np.concatenate(v) for n, v in out.items()}
                    out, held = {n: [] for n in out}, 0
        if held:
            yield {n: np.concatenate(v) for n, v in out.items()}

    joined = docs.join(lists, ["k1", "k2"]).select("text", "entries")
    return map_rows(joined, rows, "head long, stretch long, offset int, window long")


def matched_spans(entries: DataFrame, family: SuffixFamily, heads: DataFrame, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Byte spans (k1, k2, start, end) that repeated strings cover, of entries that are in the family.

    ``heads`` are those that stand in two places, ``docs`` the texts of all that is in the family.
    Entries of one class have equal windows one by one, so a class of two or more is repeated as a
    whole. Where a head has several classes (a passage ends in their windows) one entry of each gives its
    windows, and windows that two classes share are repeated.
    """
    matched = stage(entries.join(heads, "head", "left_semi"), "suffix-matched")
    classes = family.classes(heads)
    several = classes.groupBy("head").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("head")
    reps = classes.join(several, "head", "left_semi").select(*CLASS, *PLACE)
    windows = stage(_windows(reps, docs, length), "suffix-windows")
    seen = windows.groupBy("head", "window").agg(F.min("stretch").alias("a"), F.max("stretch").alias("b"))
    shared = stage(seen.where("a <> b").select("head", "window"), "suffix-shared")
    parts = (
        windows.join(shared, ["head", "window"], "left_semi")
        .groupBy("head", "stretch")
        .agg(F.array_sort(F.collect_set("offset")).alias("offsets"))
    )
    parts = stage(parts, "suffix-parts")
    empty(windows)
    whole = classes.where("n > 1").select("head", "stretch", F.lit(True).alias("whole"))
    cover = stage(whole.join(parts, ["head", "stretch"], "full_outer"), "suffix-cover")
    empty(classes, shared, parts)
    first, at = F.col("first").cast("long"), F.col("first").cast("long") + F.col("lead")
    one = F.transform("offsets", lambda o: F.struct((at - o).alias("start"), (at - o + length).alias("end")))
    all_of = F.array(F.struct(first.alias("start"), (first + F.col("reach") + length).alias("end")))
    spans = matched.join(cover, ["head", "stretch"]).select(
        "k1", "k2", F.explode(F.when(F.col("whole"), all_of).otherwise(_merged(one))).alias("span")
    )
    return spans.select("k1", "k2", "span.*")


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, batches: int = BATCHES) -> DataFrame:
    """Byte spans (k1, k2, start, end) of texts (k1, k2, text) that repeated strings cover, within the table.

    The texts are put into a new family in ``batches`` parts.
    """
    batch = F.pmod(F.xxhash64("k2"), F.lit(batches)).alias("batch")
    entries = stage(suffix_entries(docs, length, anchor).select("*", batch), "suffix-entries", by="batch")
    family = SuffixFamily()
    matches = [family.add(entries.where(F.col("batch") == b).drop("batch")) for b in range(batches)]
    # sides of joins with hot heads are plain scans, so that skewed ones can be split
    heads = stage(functools.reduce(DataFrame.unionByName, matches).distinct(), "suffix-heads")
    empty(*matches)
    spans = matched_spans(entries.drop("batch"), family, heads, docs, length)
    family.close()
    empty(entries)
    return spans


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts (k1, k2, text) by hashes of id and text; a null text is empty."""
    text = text_or_empty(text_col)
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    return docs.select(F.xxhash64(F.lit("id"), ident).alias("k1"), F.xxhash64(text).alias("k2"), text.alias("text"))


def add_batch(family: SuffixFamily, new: DataFrame, docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """Puts new texts (k1, k2, text) into a family; returns the spans (k1, k2, start, end) of theirs that
    repeated strings cover, whether the other place is old or new. ``docs`` are all texts, the new ones included;
    only those are read again that share an anchor with a new one."""
    entries = stage(suffix_entries(new, length, anchor), "suffix-entries")
    spans = matched_spans(entries, family, family.add(entries), docs, length)
    empty(entries)
    return spans


def _merged(spans: Column) -> Column:
    """Spans in descending order of start, with touching ones made one."""
    last = lambda acc: F.element_at(acc, -1)
    step = lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["start"] <= s["end"]),
        F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(s["start"].alias("start"), last(acc)["end"].alias("end")))),
    ).otherwise(F.concat(acc, F.array(s)))
    return F.aggregate(spans, F.array().cast("array<struct<start:bigint,end:bigint>>"), step)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    anchor: int = ANCHOR,
    batches: int = BATCHES,
    with_text: bool = False,
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, and ``kept`` (bytes) if ``with_text``.

    Texts are UTF-8 bytes; a removed byte may be part of a character. Matches stay within documents; the
    other place may be in the same document and may overlap. All are judged on the input. Null text is
    empty: no bytes, nothing removed. Repeated rows are each other's repetition and get a row each; null ids
    are kept. Empty tables give no rows, other columns are ignored.

    Texts meet spans by (id, digest of the text), so a passage or text that a third of all
    documents share is a matter of narrow rows: entries are counted per task before they meet, and join sides that a hot key
    can swell face a side that is unique by key.
    """
    keyed = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    texts = keyed_texts(keyed, "id")
    spans = repeated_spans(texts, length, anchor, batches)
    lists = stage(spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "suffix-spans")

    def rows(batch):
        out: dict = {n: [] for n in ("id", "n_bytes", "n_removed", "n_spans", "kept_sha256") + (("kept",) if with_text else ())}
        for ident, text, spans in zip(batch["id"], batch["text"], batch["spans"]):
            data, kept, done, n = text.encode("utf-8", "surrogatepass"), [], 0, 0
            reach = None
            for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
                if reach is None or start > reach:
                    n += 1
                    kept.append(data[done:start])
                    done = reach = end
                elif end > reach:
                    done = reach = end
            kept.append(data[done:])
            rest = b"".join(kept)
            row = (ident, len(data), len(data) - len(rest), n, hashlib.sha256(rest).hexdigest(), rest)
            for name, v in zip(out, row):
                out[name].append(v)
        yield out

    kind = keyed.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    ident = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    keyed = keyed.select("id", "text", F.xxhash64(F.lit("id"), ident).alias("k1"), F.xxhash64("text").alias("k2"))
    joined = keyed.join(lists, ["k1", "k2"], "left").select("id", "text", "spans")
    return map_rows(joined, rows, schema).withColumnRenamed("id", id_col)
