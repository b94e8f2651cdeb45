"""Prefix trie of conversations by truncation peeling.

A conversation is a path of fixed-width turn records (16 bytes of a turn's SHA-256, 4 bytes of its length). From the
greatest depth down, conversations that end at a depth merge with the nodes that survive from below, every
node loses its last turn, and equal ones are grouped: a node's totals are complete when it is discovered.

Paths are range-sorted, so a task holds an interval of them and peels it in blocks of bounded size. Only nodes
on the path before or after the interval can have members elsewhere: a task leaves at most two such spines, which
the next round peels in the same way, over a few thousand times fewer rows. The number of jobs grows with the
logarithm of the number of conversations and not with their depth, and a turn that begins a third of them is no hot key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from recordqa.llm.common import _arrow_schema, bounded_batches, stage, text_or_empty

RECORD = 20
#: Decimal ids of members that end in one node are joined in pieces of about this many bytes, and hashed in order.
PIECE_BYTES = 1 << 18
#: Bytes of paths that are peeled at once.
BLOCK_BYTES = 4 << 20
#: Spines that one task of a later round takes.
SPINES = 4096
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

#: Partial nodes of one path, by depth: members, smallest member, children, leaves below, saved tokens below, ends.
SPINE = (
    "path binary, at array<int>, n array<long>, least array<long>, children array<long>, leaves array<long>, saved array<long>, "
    "ends array<string>"
)
NODE = (
    "key binary, parent binary, conv_id long, depth int, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string"
)


def conversations(turns: DataFrame, group=None) -> DataFrame:
    """(base, conv_id, records): the turns of a conversation in order, as hex records; base is ``group`` of the id.

    Turns go by number, null first; equal numbers by role, then by SHA-256 of the text. Null role or text is
    empty. Rows of a null conv_id belong to no conversation and are left out. Only records are shuffled, not
    texts; a conversation's records meet in one row.
    """
    role, text = text_or_empty("role"), text_or_empty("text")
    said = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    record = F.concat(F.substring(said, 1, 32), F.lpad(F.hex(F.length(text).cast("long")), 8, "0"))
    rows = turns.where("conv_id IS NOT NULL").select(
        (group(F.col("conv_id")) if group else F.col("conv_id")).alias("base"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("known"), F.col("turn"), role.alias("role"), F.sha2(text, 256).alias("sha"), record.alias("record")
        ).alias("turn"),
    )
    # by base, so that one shuffle serves the conversations and those they share turns with
    lists = rows.repartition("base").groupBy("base", "conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return lists.select("base", "conv_id", F.col("turns.record").alias("records"))


def respliced(turns: DataFrame, every: int = 100, choices: int = 6) -> DataFrame:
    """(conv_id, path): each conversation c with its first h turns replaced by those of conversation c - c % ``every``,
    h = crc32(c) % ``choices``; all turns of that one if it has fewer, none if it does not exist."""
    rows = conversations(turns, lambda c: c - c % every)
    own = F.when(F.col("conv_id") == F.col("base"), F.slice("records", 1, choices))
    shared = F.max(own).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % choices).cast("int")
    none = F.array().cast("array<string>")
    rows = rows.withColumn("shared", F.coalesce(shared, none)).withColumn("h", h)
    records = F.concat(F.slice("shared", F.lit(1), F.col("h")), F.slice("records", F.col("h") + 1, F.size("records")))
    return rows.select("conv_id", F.unhex(F.array_join(records, "")).alias("path"))


def _batches(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` over the rows of a whole partition, as an iterator; ``run`` yields rows."""
    bounded_batches(df.sparkSession, BLOCK_BYTES)
    arrow = _arrow_schema(df.sparkSession, schema)

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))

        out, size = [], 0
        for row in run(rows()):
            out.append(row)
            size += sum(len(v) for v in row if isinstance(v, (bytes, str, list)))
            if len(out) >= 10_000 or size > BLOCK_BYTES:
                yield _batch(out, arrow)
                out, size = [], 0
        if out:
            yield _batch(out, arrow)

    return df.mapInArrow(partition, schema)


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)


def member_pieces(paths: DataFrame) -> DataFrame:
    """(path, first, n, ids) from (conv_id, path): decimal ids of equal paths, in numeric order, comma-joined in pieces.

    The range sort is by path and id, so that conversations that a third of all repeat are spread over tasks.
    """

    def run(rows):
        now, first, ids, size = None, None, [], 0
        for path, conv in rows:
            path = path or b""
            if ids and (path != now or size > PIECE_BYTES):
                yield now, first, len(ids), ",".join(ids)
                ids, size = [], 0
            if not ids:
                now, first = path, conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if ids:
            yield now, first, len(ids), ",".join(ids)

    spread = paths.select("path", "conv_id").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    return _batches(spread, run, "path binary, first long, n long, ids string")


class Node:
    """What an interval knows of a node: sums over its ended members and its finished children."""

    __slots__ = ("n", "least", "children", "leaves", "saved", "ends")

    def __init__(self, n=0, least=None, children=0, leaves=0, saved=0, ends=None):
        self.n, self.least, self.children, self.leaves, self.saved, self.ends = n, least, children, leaves, saved, ends

    def add(self, other: Node) -> None:
        self.n += other.n
        if self.least is None or other.least is not None and other.least < self.least:
            self.least = other.least
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends = self.ends or other.ends


class Interval:
    """Peels an interval of the sorted paths, block by block.

    A row is (path, nodes by depth): a conversation knows its last node, a spine knows several. Nodes on the first
    path of the interval stay open, as an interval before may hold members, and so do those on the last path of
    each block; all others are finished. ``last``: nothing lies outside the interval, so all is finished at its end.
    """

    def __init__(self, last: bool):
        self.last = last
        self.first_path = self.last_path = b""
        self.first_keys: frozenset | None = None
        self.left: dict[bytes, Node] = {}  # open because of what may lie before
        self.right: dict[bytes, Node] = {}  # open because of what may follow

    @staticmethod
    def chain(path: bytes) -> list[bytes]:
        """Keys of the nodes of a path, by depth, from the root."""
        out, h = [b""], hashlib.blake2b(digest_size=16)
        for at in range(0, len(path), RECORD):
            h.update(path[at : at + RECORD])
            out.append(h.digest())
        return out

    def block(self, rows: list[tuple[bytes, dict[int, Node]]], end: bool = False) -> Iterator[tuple]:
        """Finished nodes of the interval's next block, deepest first. ``end``: no block follows."""
        if self.right:  # what the block before left open
            chain = self.chain(self.last_path)
            rows = [(self.last_path, {d: self.right[k] for d, k in enumerate(chain) if k in self.right}), *rows]
        if not rows:
            return
        chains = [self.chain(path) for path, _ in rows]
        if self.first_keys is None:
            self.first_path, self.first_keys = rows[0][0], frozenset(() if self.last else chains[0])
        ahead = frozenset(() if end and self.last else chains[-1])
        ended: dict[int, list[int]] = {}
        known: dict[int, list[tuple[bytes, Node]]] = {}
        for i, (_, nodes) in enumerate(rows):
            ended.setdefault(len(chains[i]) - 1, []).append(i)
            for depth, node in nodes.items():
                known.setdefault(depth, []).append((chains[i][depth], node))
        open_right: dict[bytes, Node] = {}
        living: dict[bytes, tuple[int, Node]] = {}
        for depth in range(max(ended), -1, -1):
            for i in ended.get(depth, ()):  # those that end here join those that survive from below
                living.setdefault(chains[i][depth], (i, Node()))
            for key, node in known.get(depth, ()):
                living[key][1].add(node)
            above: dict[bytes, tuple[int, Node]] = {}
            for key, (i, node) in living.items():
                parent = chains[i][depth - 1] if depth else None
                if depth:  # strip the last turn and regroup
                    above.setdefault(parent, (i, Node()))
                if key in ahead:
                    open_right[key] = node
                elif key in self.first_keys:
                    self.left.setdefault(key, Node()).add(node)
                else:
                    chars = int.from_bytes(rows[i][0][depth * RECORD - 4 : depth * RECORD], "big") if depth else 0
                    leaves, saved = node.leaves if node.children else 1, node.saved + (node.n - 1) * chars
                    yield key, parent, node.least, depth, node.n, node.children, leaves, saved, node.ends or EMPTY_SHA
                    if depth:
                        above[parent][1].add(Node(node.n, node.least, 1, leaves, saved))
            living = above
        self.right, self.last_path = open_right, rows[-1][0]

    def spines(self) -> Iterator[tuple]:
        """What stays open, as rows of the next round."""
        for path, held in ((self.first_path, self.left), (self.last_path, self.right)):
            own = [(d, held[k]) for d, k in enumerate(self.chain(path)) if k in held]
            if own:
                sums = [[getattr(node, name) for _, node in own] for name in Node.__slots__]
                yield path, [d for d, _ in own], *sums


def _conversations_of(pieces: Iterable[tuple]) -> Iterator[tuple[bytes, dict[int, Node]]]:
    """Rows of an interval from sorted pieces (path, first, n, ids): equal paths become one row."""
    now, node, sha = None, Node(), None
    for path, first, n, ids in pieces:
        path = path or b""
        if path != now:
            if now is not None:
                node.ends = sha.hexdigest()
                yield now, {len(now) // RECORD: node}
            now, node, sha = path, Node(0, first), hashlib.sha256()
        elif node.n:
            sha.update(b",")
        sha.update(ids.encode())
        node.n += n
    if now is not None:
        node.ends = sha.hexdigest()
        yield now, {len(now) // RECORD: node}


def _spines_of(rows: Iterable[tuple]) -> Iterator[tuple[bytes, dict[int, Node]]]:
    for path, at, *sums in rows:
        yield path or b"", {d: Node(*values) for d, *values in zip(at, *sums)}


def _peeled(df: DataFrame, rows_of, last: bool) -> DataFrame:
    """Finished nodes and open spines of the partitions of sorted rows."""

    def run(rows):
        interval, block, size = Interval(last), [], 0
        nothing = (None,) * len(SPINE.split(", "))
        for path, nodes in rows_of(rows):
            if size > BLOCK_BYTES:
                for node in interval.block(block):
                    yield node + nothing
                block, size = [], 0
            block.append((path, nodes))
            size += len(path) + 200
        for node in interval.block(block, end=True):
            yield node + nothing
        for spine in interval.spines():
            yield (None,) * len(NODE.split(", ")) + spine

    return stage(_batches(df, run, f"{NODE}, {SPINE}"), "trie-peeled")


def prefix_trie(paths: DataFrame) -> DataFrame:
    """One row per node of the trie of (conv_id, path): conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256 (of the ids of members that end there, ascending, comma-joined).

    The root has depth 0 and no text. saved_tokens: over the subtree, each node's (n_convs - 1) times the code
    points of its last text. Without conversations there is no root and no row. Conversations that
    repeat are members one by one; ids are taken to be distinct.
    """
    pieces = stage(member_pieces(paths), "trie-members")
    sorted_rows = pieces.repartitionByRange("path").sortWithinPartitions("path", "first")
    rounds = [_peeled(sorted_rows, _conversations_of, last=False)]
    while n_spines := (spines := rounds[-1].where("path IS NOT NULL").select(*[c.split()[0] for c in SPINE.split(", ")])).count():
        tasks = -(-n_spines // SPINES)
        dealt = spines.coalesce(1) if tasks == 1 else spines.repartitionByRange(tasks, "path")
        rounds.append(_peeled(dealt.sortWithinPartitions("path"), _spines_of, last=tasks == 1))
    names = [c.split()[0] for c in NODE.split(", ")]
    nodes = rounds[0].where("key IS NOT NULL").select(*names)
    for more in rounds[1:]:
        nodes = nodes.unionByName(more.where("key IS NOT NULL").select(*names))
    parents = nodes.where("n_children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(parents, "parent", "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
