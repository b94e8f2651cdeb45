"""Embedding near-dedup with a pivot-permutation index.

A vector is described by its nearest reference points in order. Inverted lists hold the vectors
that share pivots; vectors that share enough of their first pivots are compared exactly.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recordqa.llm.common import bounded_batches, components, stage
from recordqa.llm.simhash import _spanning

#: Reference points at most.
PIVOTS = 64
#: Vectors they are chosen from, about; the bound of what the driver holds.
SAMPLE = 2_048
#: Pivots of a vector's description; two of them must be shared.
PREFIX = 5
#: Vectors of one list that are compared in one block.
BLOCK = 1_024


def draw_pivots(classes: DataFrame, pivots: int, threshold: float, sample: int = SAMPLE) -> np.ndarray:
    """At most ``pivots`` unit vectors of the most common length, far from one another.

    About ``sample`` vectors are drawn by hash; each next pivot is the one least similar to those chosen. It ends at
    twice the angle of a link, so vectors that all link with one another hold one pivot, however many they are: among
    several, their order would be chance. Fewer pivots make longer lists, not fewer links.
    """
    sizes = classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return np.zeros((0, 0))
    share = int(min(1.0, sample / sizes[1]) * (1 << 40))
    drawn = classes.where(F.col("dim") == sizes[0]).select("class", "embedding")
    if share < 1 << 40:
        drawn = drawn.where(F.pmod(F.xxhash64("class"), F.lit(1 << 40)) < share)
    rows = sorted(drawn.collect()) or [classes.where(F.col("dim") == sizes[0]).select("class", "embedding").first()]
    x = np.array([r[1] for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    chosen, nearest = [0], x @ x[0]
    while len(chosen) < min(pivots, len(x)):
        at = int(nearest.argmin())
        if nearest[at] >= 2 * threshold * threshold - 1:
            break
        chosen.append(at)
        nearest = np.maximum(nearest, x @ x[at])
    return x[chosen]


def describe(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each row, nearest first (ties: lower number)."""
    if x.shape[1] != pivots.shape[1]:
        return np.zeros((len(x), min(prefix, 2)), np.int32) + np.arange(min(prefix, 2), dtype=np.int32)
    similar = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ pivots.T
    return np.argsort(-similar, axis=1, kind="stable")[:, :prefix].astype(np.int32)


def list_keys(described: np.ndarray, n_pivots: int) -> np.ndarray:
    """Keys of the inverted lists of each row: one per pair of its pivots, so two rows share a
    list if they share two pivots; the lowest shared key is the same for both."""
    if described.shape[1] < 2:
        return described[:, :1].astype(np.int64)
    ordered = np.sort(described, axis=1).astype(np.int64)
    return np.stack([ordered[:, i] * n_pivots + ordered[:, j] for i, j in combinations(range(described.shape[1]), 2)], axis=1)


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
    pivots: int = PIVOTS,
    prefix: int = PREFIX,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Vectors link if their labels are equal and not null and their cosine, in double precision, is at least
    ``threshold``. Pairs are found through shared pivots, so some can be missed (recall is measured in the tests);
    none below the threshold is linked. Equal vectors fold into one row before anything is compared and always link.

    Vectors that are null, empty or zero, hold nulls, NaN or infinities, or have a null label, link with
    nothing. Vectors of different lengths do not link. A null id is kept: it links, and only where all ids of a component are
    null is its component null. Repeated rows link with each other like any equal vectors. ``kept`` is whether the id is its
    component's. Empty tables give no rows, other columns are ignored.

    A list with more than ``block`` vectors is cut into blocks, and blocks are compared pair by pair in tasks of
    their own. A pair is counted in the lowest list it shares, so nothing has to be made distinct, and a task returns
    sums and a spanning forest, not pairs.
    """
    spark = vectors.sparkSession
    bounded_batches(spark, 4 << 20)
    v = F.col("embedding")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("embedding")
    )
    sound = F.col("label").isNotNull() & v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0)
    # positive and negative zero are one value
    clean = F.when(sound, F.transform(v, lambda x: x + F.lit(0.0)))
    rows = rows.select(
        "id",
        F.when(sound, F.col("label")).alias("label"),
        clean.alias("embedding"),
        F.size(clean).alias("dim"),
        F.xxhash64(clean).alias("h1"),
        F.xxhash64(F.lit("second"), clean).alias("h2"),
        sound.alias("sound"),
    )
    key = ["label", "dim", "h1", "h2"]
    classes = stage(
        rows.where("sound").groupBy(*key).agg(F.first("embedding").alias("embedding"), F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
        .withColumn("class", F.xxhash64(*key)),
        "vector-classes",
    )
    chosen = spark.sparkContext.broadcast(draw_pivots(classes, pivots, threshold))
    n = len(chosen.value)
    label_kind = dict(classes.dtypes)["label"]

    def described(batches):
        for batch in batches:
            for dim in set(batch.column("dim").to_pylist()):
                part = batch.filter(pa.array([d == dim for d in batch.column("dim").to_pylist()]))
                x = part.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                keys = list_keys(describe(x, chosen.value, prefix), n)
                take = np.repeat(np.arange(len(x)), keys.shape[1])
                names = [c for c in part.schema.names if c != "lists"]
                out = [part.column(c).take(pa.array(take)) for c in names]
                lists = pa.array(list(keys[take]), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*out, lists, pa.array(keys.ravel())], names=[*names, "lists", "list"])

    flat = classes.select("label", "dim", "class", "copies", "embedding")
    posted = flat.mapInArrow(
        described, f"label {label_kind}, dim int, class long, copies long, embedding array<double>, lists array<long>, list long"
    )
    posted = stage(posted, "vector-lists")
    where = ["label", "dim", "list"]
    sizes = posted.groupBy(*where).count().where("count > 1")
    blocks = F.ceil(F.col("count") / block).cast("int")
    mine = F.pmod(F.col("class"), F.col("blocks")).cast("int")
    dealt = (
        posted.join(sizes.withColumn("blocks", blocks), where)
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("unit", F.xxhash64(*where, F.least("mine", "other"), F.greatest("mine", "other")))
        .select("unit", "list", "mine", (F.col("mine") == F.col("other")).alias("same"), "dim", "class", "copies", "lists", "embedding")
    )

    def compare(batches):
        held: list = []

        def flush(whole):
            nonlocal held
            if not held:
                return None
            joined = pa.Table.from_batches(held).combine_chunks()
            units = joined.column("unit").to_numpy()
            cut = len(units) if whole else int(np.flatnonzero(np.r_[True, units[1:] != units[:-1]])[-1])
            held = joined.slice(cut).to_batches() if cut < len(units) else []
            return _compared(joined.slice(0, cut), units[:cut], threshold) if cut else None

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 2 * block:
                if (out := flush(False)) is not None:
                    yield out
        if (out := flush(True)) is not None:
            yield out

    met = dealt.repartition("unit").sortWithinPartitions("unit").mapInArrow(compare, "a long, b long, links long")
    met = stage(met, "vector-met")
    degrees = met.where("links > 0").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    roots = components(met.where("b is not null").select("a", "b"), "vectors")
    named = classes.select("class", *key, "least", "copies").join(degrees, "class", "left").join(
        roots.withColumnRenamed("node", "class"), "class", "left"
    )
    named = named.withColumn("root", F.coalesce("component", "class"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    facts = named.join(least, "root").select(*key, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.drop("embedding").join(facts, key, "left")
    component = F.when(F.col("sound"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _compared(table: pa.Table, units: np.ndarray, threshold: float) -> pa.RecordBatch:
    """Degrees and spanning edges of whole units: (a, b, links); b is null in a degree row."""
    starts = np.flatnonzero(np.r_[True, units[1:] != units[:-1]])
    ends = np.r_[starts[1:], len(units)]
    get = lambda name: table.column(name).combine_chunks()
    lists, mine, same, dims = (get(c).to_numpy(zero_copy_only=False) for c in ("list", "mine", "same", "dim"))
    classes, copies = (get(c).to_numpy(zero_copy_only=False) for c in ("class", "copies"))
    keys, vectors = get("lists"), get("embedding")
    degree: dict[int, int] = {}
    left, right = [], []
    for s, e in zip(starts, ends):
        if e - s < 2:
            continue
        x = vectors.slice(s, e - s).flatten().to_numpy(zero_copy_only=False).reshape(e - s, dims[s])
        norms = np.sqrt((x * x).sum(axis=1))
        cosine = (x @ x.T) / norms[:, None] / norms[None, :]
        close = np.triu(cosine >= threshold, 1)
        if not same[s : e].any():  # two blocks: pairs inside a block belong to its own unit
            close &= mine[s:e][:, None] != mine[s:e][None, :]
        a, b = np.nonzero(close)
        if not len(a):
            continue
        k = keys.slice(s, e - s).flatten().to_numpy(zero_copy_only=False).reshape(e - s, -1)
        lowest = np.full(len(a), np.iinfo(np.int64).max)
        for i in range(k.shape[1]):
            shared = (k[a, i][:, None] == k[b]).any(axis=1)
            lowest = np.where(shared, np.minimum(lowest, k[a, i]), lowest)
        first = lowest == lists[s]
        own, mult = classes[s:e], copies[s:e]
        links = np.zeros(e - s, np.int64)
        np.add.at(links, a[first], mult[b[first]])
        np.add.at(links, b[first], mult[a[first]])
        for c, n in zip(own[links > 0].tolist(), links[links > 0].tolist()):
            degree[c] = degree.get(c, 0) + n
        nodes, roots = _spanning(e - s, a, b)
        left.append(own[nodes])
        right.append(own[roots])
    a = np.concatenate([np.array(list(degree), np.int64), *left])
    b = np.concatenate([np.zeros(len(degree), np.int64), *right])
    blank = np.arange(len(a)) < len(degree)
    links = np.concatenate([np.array(list(degree.values()), np.int64), *(np.zeros(len(x), np.int64) for x in left)])
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, mask=blank), pa.array(links)], names=["a", "b", "links"])
