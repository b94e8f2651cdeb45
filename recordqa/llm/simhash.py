"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints at most 2r bits apart have a common variant at most r bits from each. Every
fingerprint emits its variants within r bits and meets others on equal variants.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from recordqa.llm.common import bounded_batches, components, stage, text_or_empty

#: XXH64 seed of a shingle.
SEED = 42
#: UTF-8 bytes as they are hashed: A-Z in lower case (other letters stay), separators as spaces.
_BYTES = bytes(32 if 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: The bits of each byte, lowest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
#: Bits by which the variants of a crowded head are cut further.
CUT_BITS = 8
#: Fingerprints a head has on average, at most, before variants (as a power of two).
HEAD_ROWS = 12
#: Hashes counted at once: bounds memory on long texts.
CHUNK = 1 << 16


def _joined(text: str) -> bytes:
    """The words of a text in UTF-8, with one space between them."""
    raw = np.frombuffer(text.encode().translate(_BYTES), np.uint8)
    inside = raw != 32
    inside[1:] |= inside[:-1].copy()  # the first space after a word
    return raw[inside].tobytes().rstrip(b" ")


def fingerprint(text: str | None, n_words: int = 4) -> int:
    """64-bit SimHash of a text: a bit is 1 if it is set in over half of the shingle hashes.

    A shingle is a slice of the joined words, so no word and no shingle is built as a string of its own.
    """
    words = _joined(text or "")
    if not words:
        return 0
    gaps = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    n = max(1, len(gaps) + 2 - n_words)
    starts = np.r_[0, gaps + 1]
    ends = np.r_[gaps, len(words)][min(n_words, len(gaps) + 1) - 1 :]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        spans = zip(starts[at : min(n, at + CHUNK)].tolist(), ends[at : at + CHUNK].tolist())
        hashes = np.array([digest(words[i:j], SEED) for i, j in spans], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.concatenate([np.bincount(hashes[:, lane], minlength=256) @ _BITS for lane in range(8)])
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, n_words: int = 4) -> Column:
    """The fingerprint as a long (two's complement)."""

    @F.pandas_udf("long")
    def run(texts):
        import pandas as pd

        values = np.array([fingerprint(t, n_words) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return run(text)


@functools.cache
def masks(bits: int, most: int) -> dict[int, np.ndarray]:
    """XOR masks over ``bits`` bits by number of bits set, 0 to ``most``."""
    out, last = {0: np.zeros(1, np.uint64)}, [(0, -1)]
    for n in range(1, most + 1):
        last = [(m | 1 << b, b) for m, top in last for b in range(top + 1, bits)]
        out[n] = np.array([m for m, _ in last], np.uint64)
    return out


def _forest(groups: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect members of equal groups: each with the next in sorted order, made distinct."""
    ordered = np.sort(groups)
    repeated = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(repeated):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(repeated, groups), len(repeated) - 1)
    hit = repeated[at] == groups
    groups, members = groups[hit], members[hit]
    order = np.lexsort((members, groups))
    g, m = groups[order], members[order]
    same = (g[1:] == g[:-1]) & (m[1:] != m[:-1])
    pairs = np.unique(m[:-1][same] << np.int64(32) | m[1:][same])
    return pairs >> 32, pairs & 0xFFFFFFFF


def _spanning(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of edges a-b over nodes 0..n-1, as (node, root) pairs."""
    parent = np.arange(n)
    while len(a):
        ra, rb = parent[a], parent[b]
        lo, hi = np.minimum(ra, rb), np.maximum(ra, rb)
        keep = lo != hi
        a, b, lo, hi = a[keep], b[keep], lo[keep], hi[keep]
        np.minimum.at(parent, hi, lo)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    nodes = np.flatnonzero(parent != np.arange(n))
    return nodes, parent[nodes]


def _meet(heads: np.ndarray, prints: np.ndarray, spent: np.ndarray, low_bits: int, radius: int, max_rows: int):
    """Links (fingerprint, fingerprint) among rows that share a head, by completing their variants.

    Completed variants are handled in slices of at most ``max_rows``, whole heads together where they
    fit. A head beyond that is cut by the next bits of the variant: for each value of those bits a row goes on if it can reach
    the value within its radius. So every variant is built once, and what is held at a time is bounded by ``max_rows`` and the
    rows of the head, however alike they are.
    """
    low_masks, low = masks(low_bits, radius), np.uint64((1 << low_bits) - 1)
    deltas = {s: np.concatenate([low_masks[n] for n in range(radius - s + 1)]) for s in range(radius + 1)}
    starts = np.flatnonzero(np.r_[True, heads[1:] != heads[:-1]])
    weight = np.add.reduceat(np.array([len(deltas[s]) for s in range(radius + 1)])[spent], starts)
    ends = np.r_[starts[1:], len(heads)]
    i = 0
    while i < len(starts):
        j, total = i, 0
        while j < len(starts) and (j == i or total + weight[j] <= max_rows):
            total += weight[j]
            j += 1
        rows = slice(starts[i], ends[j - 1])
        i, h, p, s = j, heads[rows], prints[rows], spent[rows]
        if total > max_rows and low_bits:
            yield from _cut(h[0], p, s, low_bits, radius, max_rows)
            continue
        uniq, member = np.unique(p, return_inverse=True)
        values, owners = [], []
        for level, delta in deltas.items():
            at = np.flatnonzero(s == level)
            v = (p[at] & low)[:, None] ^ delta[None, :]
            values.append(((h[at].astype(np.uint64) << np.uint64(low_bits))[:, None] | v).ravel())
            owners.append(np.broadcast_to(member[at][:, None], v.shape).ravel())
        a, b = _forest(np.concatenate(values), np.concatenate(owners).astype(np.int64))
        # sharing a variant is a distance of at most 2r; checked all the same
        close = np.bitwise_count(uniq[a] ^ uniq[b]) <= 2 * radius
        nodes, roots = _spanning(len(uniq), a[close], b[close])
        if len(nodes):
            yield uniq[nodes], uniq[roots]


def _cut(head: int, p: np.ndarray, spent: np.ndarray, low_bits: int, radius: int, max_rows: int):
    """Links within one head, by the values of the variant's next ``CUT_BITS`` bits; at most one link per row."""
    step = min(CUT_BITS, low_bits)
    left = low_bits - step
    top = (p >> np.uint64(left)) & np.uint64((1 << step) - 1)
    uniq = np.unique(p)
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for value in range(1 << step):
        cost = spent + np.bitwise_count(top ^ np.uint64(value)).astype(np.int8)
        mine = np.flatnonzero(cost <= radius)
        longer = np.full(len(mine), np.uint64(head) << np.uint64(step) | np.uint64(value))
        for x, y in _meet(longer, p[mine], cost[mine], left, radius, max_rows) if len(mine) > 1 else ():
            a, b = np.r_[a, np.searchsorted(uniq, x)], np.r_[b, np.searchsorted(uniq, y)]
            if len(a) > 2 * len(uniq):
                a, b = _spanning(len(uniq), a, b)
    if len(a):
        nodes, roots = _spanning(len(uniq), a, b)
        yield uniq[nodes], uniq[roots]


def fingerprint_links(prints: DataFrame, max_bits: int = 4, head_bits: int = 16, max_rows: int = 2_000_000) -> DataFrame:
    """Edges (a, b) that connect all fingerprints linked by at most ``max_bits`` differing bits, an even number.

    ``prints`` has one column ``fp`` of distinct longs. A variant is a head (its high ``head_bits`` bits) and a low
    part. The shuffle is on the head: a fingerprint travels once per variant head, with the bits already spent, and the low
    parts within the rest of the radius are completed where the rows meet. All fingerprints with one variant are
    within ``max_bits`` of each other, so a chain per variant connects what all its pairs would, and a spanning forest
    per task is what is emitted: never more edges than rows.
    """
    if max_bits % 2:
        raise ValueError("max_bits must be even: variants within half of it decide")
    radius, low_bits = max_bits // 2, 64 - head_bits
    spark = prints.sparkSession
    bounded_batches(spark)
    head_masks = masks(head_bits, radius)
    flips = np.concatenate([head_masks[n] for n in range(radius + 1)]).astype(np.int64)
    costs = np.concatenate([np.full(len(head_masks[n]), n, np.int8) for n in range(radius + 1)])
    schema = pa.schema([("head", pa.int32()), ("fp", pa.int64()), ("spent", pa.int8())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(values), 4096):
                v = values[at : at + 4096]
                heads = (v.view(np.uint64) >> np.uint64(low_bits)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((heads[:, None] ^ flips).ravel().astype(np.int32)),
                        pa.array(np.repeat(v, len(flips))),
                        pa.array(np.tile(costs, len(v))),
                    ],
                    schema=schema,
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        weight, held, rows = max_rows // 16, [], 0

        def flush(whole: bool):
            nonlocal held, rows
            if not held:
                return
            h, p, s = (np.concatenate(x) for x in zip(*held))
            cut = len(h) if whole else int(np.searchsorted(h, h[-1]))  # the last head may go on
            held, rows = ([] if cut == len(h) else [(h[cut:], p[cut:], s[cut:])]), len(h) - cut
            if cut:
                for a, b in _meet(h[:cut], p[:cut].view(np.uint64), s[:cut], low_bits, radius, max_rows):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=out)

        for batch in batches:
            held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
            rows += batch.num_rows
            if rows >= weight:
                yield from flush(False)
        yield from flush(True)

    # a row becomes many: its narrow input is spread, so that emitting is not left to the few tasks it would fit into
    spread = prints.select("fp").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    variants = spread.mapInArrow(emit, "head int, fp long, spent byte")
    met = variants.repartition("head").sortWithinPartitions("head")
    return met.mapInArrow(meet, "a long, b long").distinct()


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = 4, max_bits: int = 4
) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id.

    Documents link if their fingerprints differ in at most ``max_bits`` bits; the component is the smallest id
    reachable, the document's own included. Null, empty and blank texts have fingerprint zero and link like any other;
    repeated rows get a row each; a null id is kept, never becomes a component of others and gets the
    component of its fingerprint. Empty tables give no rows; other columns are ignored.

    Copies fold into one fingerprint before anything meets, so groups of copies cost their size, not its square.
    The heads on which variants meet get longer as documents grow, so that what shares a head does not.
    """
    bounded_batches(docs.sparkSession)
    rows = stage(
        docs.select(F.col(id_col).alias("id"), fingerprint_column(text_or_empty(text_col), n_words).alias("fp")), "simhash-prints"
    )
    prints = rows.groupBy("fp").agg(F.min("id").alias("least"))
    head_bits = min(max(16, rows.count().bit_length() - HEAD_ROWS), 30)
    links = fingerprint_links(prints.select("fp"), max_bits, head_bits)
    classes = components(links, "simhash")
    named = prints.join(classes, prints.fp == classes.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("class")
    )
    least = named.groupBy("class").agg(F.min("least").alias("component_id"))
    by_print = named.join(least, "class").select("fp", "component_id")
    return rows.join(by_print, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
