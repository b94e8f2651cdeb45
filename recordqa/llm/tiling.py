"""Benchmark decontamination by greedy string tiling.

Seeds of ``min_match`` tokens join documents and test items; per pair the longest
non-overlapping matches are marked first, and the share of the item under tiles decides, so
reordered passages count as much as whole ones.
"""

from __future__ import annotations

import heapq
import itertools
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from recordqa.llm.common import map_rows, stage, text_or_empty

_TOKEN = re.compile(r"\w+")
#: Bits of the seed filter: its broadcast is 1 MB whatever the size of the benchmark.
FILTER_BITS = 23
_BASE = np.uint64(0x9E3779B97F4A7C15)


class TokenHashes:
    """64-bit hashes of tokens; remembers up to ``most`` of them."""

    def __init__(self, most: int = 500_000):
        self.known, self.most = {}, most

    def __call__(self, text: str) -> np.ndarray:
        if len(self.known) > self.most:
            self.known.clear()
        known, out = self.known, []
        for token in _TOKEN.findall(text.lower()):
            h = known.get(token)
            if h is None:
                h = known[token] = xxhash.xxh64_intdigest(token)
            out.append(h)
        return np.array(out, dtype=np.uint64)


def seed_hashes(tokens: np.ndarray, k: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``k`` tokens, as signed longs."""
    n = len(tokens) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * _BASE + tokens[j : j + n]
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return (total ^ total >> np.uint64(32)).view(np.int64)


def tiles(pairs: Iterable[tuple[int, int]], k: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of one document and one item: (document position, item position, length).

    ``pairs`` are positions of equal seeds. Runs along a diagonal are the maximal matches; the
    longest goes first (ties: first in the item, then in the document), what others lose to it is
    cut off, and remainders of at least ``k`` tokens go on.
    """
    runs: list[list[int]] = []
    for diagonal, d in sorted({(d - i, d) for d, i in pairs}):
        if runs and runs[-1][0] == diagonal and runs[-1][1] + runs[-1][2] == d:
            runs[-1][2] += 1
        else:
            runs.append([diagonal, d, 1])
    return greedy(((n, d - diagonal, d) for diagonal, d, n in runs), k)


def diagonal_runs(hits: dict[int, np.ndarray], shape: Sequence[int]) -> Iterator[tuple[int, int, int]]:
    """Maximal runs of equal seeds: (number of seeds, item position, document position).

    ``shape`` names the seed at each position of the item, ``hits`` the sorted document positions of each seed. Lengths are
    carried from the item's last position to its first, so the product of equal seeds is never held.
    """
    none = np.zeros(0, np.int64)
    after, lengths = none, none
    for i in range(len(shape) - 1, -1, -1):
        here = hits.get(shape[i], none)
        at = np.searchsorted(after, here + 1)
        goes_on = np.append(after, -1)[at] == here + 1
        lengths = 1 + np.where(goes_on, np.append(lengths, 0)[at], 0)
        before = hits.get(shape[i - 1], none) if i else none
        first = ~np.isin(here - 1, before)
        yield from zip(lengths[first].tolist(), itertools.repeat(i), here[first].tolist())
        after = here


def _room(taken: set[int], span: int, k: int) -> bool:
    """Whether ``k`` positions in a row below ``span`` are free."""
    last = -1
    for place in [*sorted(taken), span]:
        if place - last > k:
            return True
        last = place
    return False


def greedy(runs: Iterable[tuple[int, int, int]], k: int) -> list[tuple[int, int, int]]:
    """Tiles of maximal runs (number of seeds, item position, document position), see ``tiles``."""
    heap = [(-(n + k - 1), i, d) for n, i, d in runs]
    heapq.heapify(heap)
    span = max((i - length for length, i, _ in heap), default=0)
    in_doc, in_item, out = set(), set(), []
    while heap:
        length, i, d = heapq.heappop(heap)
        free = [j for j in range(-length) if d + j not in in_doc and i + j not in in_item]
        if len(free) == -length:
            out.append((d, i, -length))
            in_doc.update(range(d, d - length))
            in_item.update(range(i, i - length))
            if not _room(in_item, span, k):
                break
            continue
        at = 0
        while at < len(free):
            end = at
            while end + 1 < len(free) and free[end + 1] == free[end] + 1:
                end += 1
            if end - at + 1 >= k:
                heapq.heappush(heap, (-(end - at + 1), i + free[at], d + free[at]))
            at = end + 1
    return sorted(out)


def _by_place(hits: Iterable[dict]) -> dict[int, np.ndarray]:
    """Sorted document positions of each seed, by its first place in the item."""
    at: dict[int, list[int]] = {}
    for hit in hits:
        at.setdefault(hit["place"], []).append(hit["dpos"])
    return {place: np.unique(np.array(v, np.int64)) for place, v in at.items()}


def _seeds(items: DataFrame, k: int) -> DataFrame:
    """Distinct seeds of items, with their positions (``places``): runs of ``k`` tokens, or the whole item where it has fewer.

    ``width`` is the length of a seed.
    """

    def rows(batch):
        hashes = TokenHashes()
        out = {n: [] for n in ("item", "i2", "n_tokens", "width", "seed", "places")}
        for item, i2, text in zip(batch["item"], batch["i2"], batch["text"]):
            tokens = hashes(text)
            width, places = min(k, len(tokens)), {}
            for pos, seed in enumerate(seed_hashes(tokens, width).tolist() if width else ()):
                places.setdefault(seed, []).append(pos)
            for seed, at in places.items():
                for n, v in zip(out, (item, i2, len(tokens), width, seed, at)):
                    out[n].append(v)
        yield out

    kind = items.schema["item"].dataType.simpleString()
    return map_rows(items, rows, f"item {kind}, i2 long, n_tokens int, width int, seed long, places array<int>")


def seed_filter(spark: SparkSession, seeds: DataFrame) -> np.ndarray:
    """A bit per seed hash in a table of fixed size; at most 2**17 words reach the driver."""
    bucket = F.col("seed").bitwiseAND((1 << FILTER_BITS) - 1)
    words = seeds.select(bucket.alias("b")).groupBy(F.shiftright("b", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("bits")
    )
    table = np.zeros(1 << FILTER_BITS - 6, np.int64)
    for w, bits in words.collect():
        table[w] = bits
    return np.unpackbits(table.view(np.uint8), bitorder="little").astype(bool)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    min_match: int = 5,
    threshold: float = 0.5,
) -> DataFrame:
    """Pairs of document and test item whose tiles cover at least ``threshold`` of the item's tokens.

    k1, k2 (keys of the document, see below), id, item id, n_tiles, covered, item_tokens, coverage. Tokens are
    runs of letters, digits and underscores in lower case, so punctuation does not hide a passage.
    Tiles have at least ``min_match`` tokens.

    Null texts are empty, and an item without tokens is covered by nothing. An item with fewer than ``min_match`` tokens
    is covered where a document holds all of it in a row; callers who do not want such matches filter on
    ``item_tokens``. Item ids keep their type. Rows that repeat id and text give one row per item; null ids are kept. Empty tables give no rows, other columns are
    ignored. Items with one id and several texts are judged each on its own.

    Documents are scanned once against a bit table of fixed size that knows all seeds; only seeds that
    pass are shuffled and joined exactly, so its false alarms cost a row and no result. A pair is one row of the
    document's seeds, each once, and the item's: bounded by the sum of the two texts, whatever repeats in both. Equality is that of 64-bit hashes of ``min_match`` tokens.
    """
    spark = docs.sparkSession
    items = items.select(F.col(item_col).alias("item"), text_or_empty(item_text_col).alias("text"))
    seeds = stage(_seeds(items.select("item", F.xxhash64("text").alias("i2"), "text").distinct(), min_match), "tiling-seeds")
    table = spark.sparkContext.broadcast(seed_filter(spark, seeds))
    widths = sorted(r.width for r in seeds.select("width").distinct().collect())  # min_match of them at most
    low = (1 << FILTER_BITS) - 1
    hashes = TokenHashes()

    def hits(batch):
        out = {n: [] for n in ("k1", "k2", "width", "seed", "dpos")}
        known = table.value
        for k1, k2, text in zip(batch["k1"], batch["k2"], batch["text"]):
            tokens = hashes(text)
            for width in widths:
                found = seed_hashes(tokens, width)
                at = np.flatnonzero(known[found & low])
                out["seed"] += found[at].tolist()
                out["dpos"] += at.tolist()
                for name, value in (("k1", k1), ("k2", k2), ("width", width)):
                    out[name] += [value] * len(at)
        yield out

    text = text_or_empty(text_col)
    keyed = docs.select(F.col(id_col).alias("k1"), F.xxhash64(text).alias("k2"), text.alias("text"))
    kind = keyed.schema["k1"].dataType.simpleString()
    found = map_rows(keyed, hits, f"k1 {kind}, k2 long, width int, seed long, dpos int")
    # a seed goes by its first place in the item; where else it stands there is told once per item text
    first, times = F.col("places")[0].alias("place"), F.size("places").alias("times")
    entries = seeds.select("item", "i2", "n_tokens", "width", "seed", first, times)
    pairs = found.join(entries, ["width", "seed"]).groupBy("k1", "k2", "item", "i2", "n_tokens").agg(
        F.collect_list(F.struct("dpos", "place")).alias("hits"), F.collect_set(F.struct("place", "times")).alias("seen")
    )
    # a seed covers min_match tokens at most: pairs that cannot reach the threshold need no tiling
    n_seeds = F.aggregate("seen", F.lit(0), lambda n, s: n + s["times"])
    pairs = pairs.where(n_seeds * min_match >= F.col("n_tokens") * F.lit(threshold))
    shapes = seeds.select("i2", "seed", "places").distinct().groupBy("i2").agg(F.collect_list("places").alias("shape"))
    pairs = pairs.join(shapes, "i2")

    def tile(batch):
        out = {n: [] for n in ("k1", "k2", "item", "n_tiles", "covered", "item_tokens")}
        for k1, k2, item, n, hits, places in zip(*(batch[c] for c in ("k1", "k2", "item", "n_tokens", "hits", "shape"))):
            shape = [0] * sum(map(len, places))
            for same in places:
                for place in same:
                    shape[place] = same[0]
            found = greedy(diagonal_runs(_by_place(hits), shape), min(min_match, n))
            covered = sum(t[2] for t in found)
            for name, v in zip(out, (k1, k2, item, len(found), covered, n)):
                out[name].append(v)
        yield out

    tiled = map_rows(
        pairs.select("k1", "k2", "item", "n_tokens", "hits", "shape"),
        tile,
        f"k1 {kind}, k2 long, item {items.schema['item'].dataType.simpleString()}, n_tiles int, covered int, item_tokens int",
    )
    coverage = F.col("covered") / F.col("item_tokens")
    return tiled.withColumn("coverage", coverage).where(F.col("coverage") >= threshold)
