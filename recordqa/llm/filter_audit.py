"""Audit of how filters interact: what each removes at each place of each order, and what it repeats.

A document that fails a set of filters goes at the first of them in the order applied. Over a mask matrix
(documents x filters: 0 where the filter fails, infinite where it passes) and a position matrix (filters x
orders: the inverse permutations), that step is their min-plus product. Documents with equal outcomes are one
row with a weight, so the product is over outcome classes, never over documents.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from recordqa.llm.common import WORD, stage, text_or_empty

LETTERS = "ABCDE"
#: Fixed value: characters that documents of filter D may not hold.
SYMBOLS = r"[#$%&*|]"
REPORT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def text_rules(text: Column) -> list[Column]:
    """Whether a text fails filters A (short), B (repetitive), C (shouting), D (symbols)."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n_words = F.size(words)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return [
        n_words < 100,
        100 * F.size(F.array_distinct(words)) < 80 * n_words,
        100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
        F.rlike(text, F.lit(SYMBOLS)),
    ]


def outcomes(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcome classes of documents: part, mask (bit n: filter n fails), good, toxic, n (documents).

    Filter E fails where any smaller doc_id has the same text, whatever becomes of that one. Texts are told
    apart by SHA-256 and never shuffled. Rows that repeat id, text and part are counted before they meet anything, so no
    join key but an id with many different texts can be hot. Null ids are neither smaller nor larger than
    others and carry no label; null texts are empty; null lang is the part ''. An id with several label rows has what any of
    them says.
    """
    text = text_or_empty("text")
    bits = [F.when(fails, F.lit(1 << n)).otherwise(0) for n, fails in enumerate(text_rules(text))]
    rows = docs.select(
        F.col("doc_id"),
        F.coalesce(F.col("lang"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        sum(bits[1:], bits[0]).alias("mask"),
    )
    rows = stage(rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n")), "audit-rows")
    known = rows.where("doc_id IS NOT NULL")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    again = F.when(F.col("first"), 0).otherwise(1 << 4)
    marks = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    known = known.join(first, ["digest", "doc_id"], "left").withColumn("mask", F.col("mask") + again)
    known = known.join(marks, "doc_id", "left").select("part", "mask", "good", "toxic", "n")
    zero = F.lit(None).cast("int")
    unknown = rows.where("doc_id IS NULL").select("part", "mask", zero.alias("good"), zero.alias("toxic"), "n")
    flag = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    both = known.unionByName(unknown).select("part", "mask", flag("good"), flag("toxic"), "n")
    return both.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def removal_steps(fails: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Min-plus product: the step (from 0) at which each class goes under each order, the number of filters if never.

    fails: classes x filters, whether it fails. positions: filters x orders, where the filter stands.
    """
    never = positions.shape[0]
    mask = np.where(fails, 0, never).astype(np.int64)
    steps = np.full((fails.shape[0], positions.shape[1]), never, np.int64)
    for f in range(never):  # a plane at a time: no classes x filters x orders block
        np.minimum(steps, mask[:, f, None] + positions[f], out=steps)
    return steps


def orders_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    """All permutations of n filters (orders x steps) and their inverses (filters x orders)."""
    orders = np.array(list(itertools.permutations(range(n))), np.int64)
    return orders, np.argsort(orders, axis=1).T


def interaction(masks: np.ndarray, weights: np.ndarray, n_filters: int) -> dict[str, np.ndarray]:
    """Counts by order and step from outcome classes. weights: classes x 3 (all, good, toxic)."""
    orders, positions = orders_of(n_filters)
    fails = (masks[:, None] >> np.arange(n_filters)) & 1
    steps = removal_steps(fails.astype(bool), positions)
    gone = np.zeros((len(orders), n_filters + 1, weights.shape[1]), np.int64)
    which = np.broadcast_to(np.arange(len(orders)), steps.shape)
    np.add.at(gone, (which, steps), np.broadcast_to(weights[:, None, :], (*steps.shape, weights.shape[1])))
    gone = gone[:, :n_filters]  # what passes all goes nowhere
    removed = gone[..., 0]
    failing = (fails * weights[:, :1]).sum(axis=0)
    alone = (fails * weights[:, :1] * (fails.sum(axis=1) == 1)[:, None]).sum(axis=0)
    by_filter = np.zeros(n_filters, np.int64)
    np.add.at(by_filter, orders, removed)
    return {
        "orders": orders,
        "kept": weights[:, 0].sum() - removed.cumsum(axis=1),
        "removed": removed,
        "redundant": failing[orders] - removed,  # a filter that fails goes at its step, or went before
        "unique_fails": alone[orders],
        "good_lost": gone[..., 1],
        "toxic_lost": gone[..., 2],
        "shapley": by_filter[orders],
    }


def _report(cells: pd.DataFrame) -> pd.DataFrame:
    n = cells["n"].to_numpy(np.int64)
    weights = np.stack([n, n * cells["good"].to_numpy(np.int64), n * cells["toxic"].to_numpy(np.int64)], axis=1)
    counts = interaction(cells["mask"].to_numpy(np.int64), weights, len(LETTERS))
    orders = counts.pop("orders")
    names = ["".join(LETTERS[f] for f in order) for order in orders]
    return pd.DataFrame(
        {
            "part": cells["part"].iloc[0],
            "filter_order": np.repeat(names, len(LETTERS)),
            "step": np.tile(np.arange(1, len(LETTERS) + 1, dtype=np.int32), len(orders)),
            **{name: values.ravel() for name, values in counts.items()},
        }
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (lang), order of the five filters and step, zeros included.

    kept, removed, redundant (fails the step's filter, went earlier), unique_fails (fails nothing else),
    good_lost, toxic_lost (removed here and so labelled), shapley (what the filter removes, over all orders, at
    any step). Empty documents give no rows; an empty label table loses nothing; other columns are ignored.

    A part is one group of at most 128 outcome classes, however many documents it has.
    """
    cells = stage(outcomes(docs, labels), "audit-cells")
    return cells.groupBy("part").applyInPandas(_report, REPORT)
