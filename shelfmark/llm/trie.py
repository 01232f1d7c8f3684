"""Trie of conversation prefixes in flat arrays behind minimal perfect hashes.

Each distinct prefix is a node with a chained 128-bit digest. Nodes are dealt to
units (all prefixes that share their first turn), several units make a shard,
and a shard's digests get the slots 0 to n-1 by a minimal perfect hash, checked
against the digest kept in the slot. Counts are scattered into arrays by slot,
each node's parent slot is looked up once, and subtree sums run through the
parent slots from the deepest nodes up.

A unit of too many nodes is opened: its upper levels, as many as fit, are its
crown, and what lies below each node under them is a unit of its own. Crowns
are summed after all that hangs from them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.llm.common import run_starts
from shelfmark.llm.ordering import by_id_ranges, id_bounds
from shelfmark.operators.settle import settle

FAMILY, SHARES = 5, 9
#: Nodes of a unit that are summed in one task; units above it are opened. Shards hold up to twice as many.
UNIT_NODES = 1 << 17
#: Rows a worker puts out at once.
ROWS_OUT = 1 << 16
ROOT = bytes(16)


class Slots:
    """A minimal perfect hash of distinct 128-bit keys: each key has one of the slots 0 to n-1.

    Level by level, keys that land alone in a table a half larger than their
    number take that place; the others try again with another mix. A key's slot
    is the number of taken places before its own. ``find`` checks the key in
    the slot, so a key that isn't there has none (-1).
    """

    SPARE, MOST_LEVELS = 1.5, 64

    def __init__(self, one: np.ndarray, two: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        rest, taken_before = np.arange(len(one)), 0
        slot = np.full(len(one), -1, np.int64)
        while len(rest):
            if len(self.levels) == self.MOST_LEVELS:
                raise ValueError("two nodes share a digest")
            at = self._places(one[rest], two[rest], len(self.levels), max(8, int(self.SPARE * len(rest))))
            alone = np.bincount(at, minlength=max(8, int(self.SPARE * len(rest)))) == 1
            rank = np.cumsum(alone) - 1 + taken_before
            mine = alone[at]
            slot[rest[mine]] = rank[at[mine]]
            self.levels.append((alone, rank))
            rest, taken_before = rest[~mine], taken_before + int(alone.sum())
        self.slot = slot
        self.one, self.two = np.empty_like(one), np.empty_like(two)
        self.one[slot], self.two[slot] = one, two

    @staticmethod
    def _places(one: np.ndarray, two: np.ndarray, level: int, size: int) -> np.ndarray:
        x = one.view(np.uint64) + two.view(np.uint64) * np.uint64(2 * level + 1) + np.uint64(level)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        return (x % np.uint64(size)).astype(np.int64)

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        found = np.full(len(one), -1, np.int64)
        open_ = np.arange(len(one))
        for level, (alone, rank) in enumerate(self.levels):
            at = self._places(one[open_], two[open_], level, len(alone))
            hit = alone[at]
            found[open_[hit]] = rank[at[hit]]
            open_ = open_[~hit]
        there = found >= 0
        there[there] = (self.one[found[there]] == one[there]) & (self.two[found[there]] == two[there])
        return np.where(there, found, -1)


def rebuilt(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turns): the first turns of the family's first conversation, then the own turns after as many.

    A turn is the digest of its role and text, and its text's UTF-8 bytes, so no text is shuffled.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    said = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "digest", "bytes")))
    own = said.groupBy("conv").agg(turns.alias("turns")).select(
        "conv", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes"))).alias("turns"))
    own = settle(own, "conversations")
    first = own.filter(F.col("conv") % FAMILY == 0).select(F.col("conv").alias("family"), F.col("turns").alias("shared"))
    share = (F.crc32(F.col("conv").cast("string").cast("binary")) % SHARES).cast("int")
    rows = (own.withColumn("family", F.col("conv") - F.col("conv") % FAMILY).join(first, "family", "left")
            .withColumn("h", share))
    nothing = F.slice("turns", 1, 0)
    return rows.select("conv", F.concat(
        F.slice(F.coalesce("shared", nothing), F.lit(1), F.col("h")),
        F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


STEPS = "k1 long, k2 long, p1 long, p2 long, unit long, depth int, bytes long, conv long, is_end boolean"


def _steps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each prefix of each conversation, the empty one too: its digest, its parent's, and its first turn's as unit."""
    def rows() -> pa.RecordBatch:
        keys = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        above = np.frombuffer(b"".join(parents), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [*map(pa.array, (keys[:, 0], keys[:, 1], above[:, 0], above[:, 1])), pa.array(units, pa.int64()), pa.array(depths, pa.int32()),
             pa.array(sizes, pa.int64()), pa.array(convs, pa.int64()), pa.array(ends)], [c.split()[0] for c in STEPS.split(", ")])

    digests, parents, units, depths, sizes, convs, ends = ([] for _ in range(7))
    for batch in batches:
        for conv, turns in zip(batch.column("conv").to_pylist(), batch.column("turns")):
            turns = turns.as_py()
            digest = above = ROOT
            unit = None
            for depth in range(len(turns) + 1):
                if depth:
                    above, digest = digest, xxhash.xxh3_128_digest(digest + turns[depth - 1]["digest"])
                if depth == 1:
                    unit = int.from_bytes(digest[:8], "little", signed=True)
                digests.append(digest)
                parents.append(above)
                units.append(unit)
                depths.append(depth)
                sizes.append(turns[depth - 1]["bytes"] if depth else 0)
                convs.append(conv)
                ends.append(depth == len(turns))
            if len(digests) >= ROWS_OUT:
                yield rows()
                digests, parents, units, depths, sizes, convs, ends = ([] for _ in range(7))
    if digests:
        yield rows()


def node_table(steps: DataFrame) -> DataFrame:
    """One row for each distinct digest, with its members and the smallest of them; raises where prefixes share a digest."""
    told = ("p1", "p2", "depth", "bytes")
    nodes = steps.groupBy("k1", "k2").agg(
        F.count("*").alias("n"), F.min("conv").alias("conv"), F.min("unit").alias("unit"), *[F.min(c).alias(c) for c in told],
        *[F.max(c).alias(f"most_{c}") for c in told])
    clash = reduce(Column.__or__, [F.col(c) != F.col(f"most_{c}") for c in told])
    nodes = settle(nodes.withColumn("clash", clash).drop(*[f"most_{c}" for c in told]), "nodes")
    if not nodes.filter("clash").isEmpty():
        raise ValueError("two prefixes share a digest")
    return nodes.drop("clash")


def by_units(nodes: DataFrame, steps: DataFrame, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """(nodes in units of at most ``most``, crowns from the root down), all with their ``unit``.

    Each round opens the units that are too large. A node's next unit is its
    ancestor right below the crown, found through its smallest member. A crown
    has at most ``most`` nodes or is one node, so that each round takes at least
    a level and mostly many.
    """
    crowns, waiting, kept = [nodes.filter("depth = 0").withColumn("unit", F.lit(0).cast("long"))], nodes.filter("depth > 0"), []
    while True:
        levels = waiting.groupBy("unit", "depth").agg(F.count("*").alias("here"))
        upper = levels.withColumn("so_far", F.sum("here").over(Window.partitionBy("unit").orderBy("depth")))
        large = settle(upper.groupBy("unit").agg(
            F.sum("here").alias("n"), F.greatest(F.min(F.when(F.col("so_far") > most, F.col("depth"))), F.min("depth") + 1).alias("below"))
            .filter(F.col("n") > most).select("unit", "below"), "units")
        if large.isEmpty():
            kept.append(waiting)
            break
        kept.append(waiting.join(large, "unit", "left_anti").select(*nodes.columns))
        opened = settle(waiting.join(large, "unit"), "opened")
        crowns.append(opened.filter("depth < below").select(*nodes.columns))
        ancestors = steps.select("conv", F.col("depth").alias("below"), F.col("k1").alias("next"))
        deeper = opened.filter("depth >= below").join(ancestors, ["conv", "below"])
        waiting = settle(deeper.withColumn("unit", F.col("next")).select(*nodes.columns), "units")
    inside = kept[0]
    for more in kept[1:]:
        inside = inside.unionByName(more)
    return inside, crowns


MORE = ["more_children", "more_leaves", "more_saved"]
IN = ["k1", "k2", "p1", "p2", "depth", "conv", "n", "bytes", *MORE]
OUT = ("k1 long, k2 long, p1 long, p2 long, conv long, depth long, parent_conv_id long, n_convs long, n_children long, "
       "n_leaves long, saved_tokens long")


def summed(k1, k2, p1, p2, depth, conv, n, size, more_children, more_leaves, more_saved) -> pa.RecordBatch:
    """Sums over the subtrees of a shard's nodes; ``more_`` is what children in other shards add."""
    slots = Slots(k1, k2)
    put = lambda values: values[np.argsort(slots.slot)].astype(np.int64)
    k1, k2, p1, p2, depth, conv, n, size = map(put, (k1, k2, p1, p2, depth, conv, n, size))
    parent = slots.find(p1, p2)
    parent[depth == 0] = -1
    children = put(more_children) + np.bincount(parent[parent >= 0], minlength=len(k1))
    leaves = put(more_leaves) + (children == 0)
    saved = put(more_saved) + (n - 1) * size
    order = np.argsort(depth, kind="stable")
    cuts = np.append(run_starts(depth[order]), len(order))
    for a, b in list(zip(cuts, cuts[1:]))[::-1]:
        at = order[a:b]
        at = at[parent[at] >= 0]
        np.add.at(leaves, parent[at], leaves[at])
        np.add.at(saved, parent[at], saved[at])
    parent_conv = pa.array(np.where(parent >= 0, conv[parent], 0), mask=parent < 0)
    return pa.RecordBatch.from_arrays(
        [*map(pa.array, (k1, k2, p1, p2, conv, depth)), parent_conv, *map(pa.array, (n, children, leaves, saved))],
        [c.split()[0] for c in OUT.split(", ")])


def _shards(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sums of whole units, about ``most`` nodes at a time; rows come sorted by unit."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held = rows if held is None else [np.concatenate(pair) for pair in zip(held, rows)]
        last = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
        if last >= most:
            yield summed(*(c[:last] for c in held[1:]))
            held = [c[last:] for c in held]
    if held is not None and len(held[0]):
        yield summed(*held[1:])


def _tops(sums: list[DataFrame]) -> DataFrame:
    """Rows whose parent is in a crown."""
    rows = sums[0]
    for more in sums[1:]:
        rows = rows.unionByName(more)
    return rows.filter("parent_conv_id IS NULL AND depth > 0")


def subtree_sums(inside: DataFrame, crowns: list[DataFrame], most: int) -> DataFrame:
    """The columns ``OUT`` of every node: units first, then crowns from the lowest up, each with what hangs from it."""
    kinds = OUT

    def shards(rows: DataFrame) -> DataFrame:
        return settle(rows.select("unit", *IN).repartition("unit").sortWithinPartitions("unit")
                      .mapInArrow(lambda b: _shards(b, most), kinds), "subtrees")

    sums = [shards(inside.withColumns({c: F.lit(0).cast("long") for c in MORE}))]
    for crown in crowns[::-1]:
        hanging = _tops(sums).groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
            F.count("*").alias("more_children"), F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        sums.append(shards(crown.join(hanging, ["k1", "k2"], "left").na.fill(0, MORE)))
    names, rows = sums[1], sums[0]
    for more in sums[2:]:
        names = names.unionByName(more)
    for more in sums[1:]:
        rows = rows.unionByName(more)
    names = names.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("own_parent"))
    tops = _tops(sums).join(names, ["p1", "p2"]).withColumn("parent_conv_id", F.col("own_parent")).select(*rows.columns)
    return rows.filter("parent_conv_id IS NOT NULL OR depth = 0").unionByName(tops)


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of one range that end at a node, as one text; rows (conv, k1, k2, part) come sorted by node and id."""
    node, ids = None, []
    for batch in batches:
        out = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "part", "conv"))):
            if node is not None and row[:3] != node:
                out.append((*node, ",".join(ids)))
                ids = []
            node = row[:3]
            ids.append(str(row[3]))
        yield _texts(out)
    if node is not None:
        yield _texts([(*node, ",".join(ids))])


def _texts(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 4, types)], ["k1", "k2", "part", "ids"])


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each node's ids over all ranges, one text after the other; rows come sorted by node and range."""
    node, digest = None, None
    for batch in batches:
        out = []
        for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
            if node == (k1, k2):
                digest.update(b",")
            else:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = (k1, k2), hashlib.sha256()
            digest.update(ids.encode())
        yield _ends(out)
    if node is not None:
        yield _ends([(*node, digest.hexdigest())])


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 3, types)], ["k1", "k2", "ends_sha256"])


def ends_of_nodes(steps: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256): ids of the conversations that end at a node, ascending.

    Ids are joined in their own ranges first, so that a node where very many
    conversations end is one text for each range, hashed in a stream.
    """
    ends = steps.filter("is_end").select("conv", "k1", "k2")
    ranged = by_id_ranges(ends, id_bounds(ends, "conv")).sortWithinPartitions("k1", "k2", "conv")
    texts = ranged.select("conv", "k1", "k2", "part").mapInArrow(_joined, "k1 long, k2 long, part int, ids string")
    return (texts.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "part")
            .mapInArrow(_digests, "k1 long, k2 long, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """One row for each distinct prefix of the rebuilt conversations.

    Returns conv_id (its smallest member), depth, parent_conv_id (null for the
    root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    Turns stand by number, null first; equal numbers by role, then by a digest
    of role and text; repeated rows are turns of their own. Null roles and texts
    are empty. Rows of a null conversation belong to none and are left out. An
    empty table gives no rows, not even a root. Other columns are not read. A
    conversation's turns, 24 bytes each, meet in one row, however many.
    """
    turns = rebuilt(conversations, conv_col, turn_col, role_col, text_col)
    steps = settle(turns.mapInArrow(_steps, STEPS), "steps")
    nodes = node_table(steps)
    inside, crowns = by_units(nodes, steps, UNIT_NODES)
    rows = subtree_sums(inside, crowns, UNIT_NODES)
    return rows.join(ends_of_nodes(steps), ["k1", "k2"], "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
