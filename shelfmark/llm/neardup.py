"""Near duplicates by fingerprint: one-wildcard segment variants, equality join, check.

A fingerprint of 64 bits is the bit-wise majority of its shingles' hashes. Cut
into two segments, two fingerprints that differ in at most three bits have a
segment that differs in at most one. Every segment is therefore indexed once
for each of its bits with that bit struck out; partners meet under an equal key
and are checked in full.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh64_intdigest

from shelfmark.llm.common import NULL_ID, column_name, id_or_last, run_starts, slices, whole_runs
from shelfmark.llm.components import components
from shelfmark.operators.settle import settle

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Fingerprints compared directly under one key. With three bits struck out of
#: all but eight, the last level's keys can't hold more than these.
RUN_ROWS = 2048
BLOCK = 1 << 16


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the 64-bit hashes."""
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[i:i + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A text's fingerprint: A-Z in lower case, shingles of words, repeats included; no words give 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    return majority(np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64))


def _fingerprints(batches: Iterable[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        marks = np.array([fingerprint(t.as_py(), shingle) for t in part.column(1)], np.uint64)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(marks.view(np.int64))], ["id", "mark"])


def _without_bit(value: Column, bits: int, bit: Column) -> Column:
    """The low ``bits`` of a value, one of them struck out."""
    return value.bitwiseAND(F.lit((1 << bits) - 1)).bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), bit)))


def variants(rows: DataFrame, bits: int, within: list[str]) -> DataFrame:
    """Each row once for each bit of its two segments of ``bits`` bits; the low bits come first.

    ``within`` names columns whose values a partner must share.
    """
    n = F.col("_n")
    value = F.when(n < bits, F.col("part")).otherwise(F.shiftrightunsigned("part", bits))
    exploded = rows.withColumn("_n", F.explode(F.sequence(F.lit(0), F.lit(2 * bits - 1))))
    struck = _without_bit(value, bits, (n % bits).cast("int"))
    if within:
        key = F.xxhash64(*within, n, struck)
    else:
        key = F.shiftleft(n.cast("long"), bits).bitwiseOR(struck)
    # What stays free under this key is the other segment: the next level's part.
    rest = F.when(n < bits, F.shiftrightunsigned("part", bits)).otherwise(F.col("part")).bitwiseAND(F.lit((1 << bits) - 1))
    return exploded.select(key.alias("key"), "mark", rest.alias("part"))


def _linked(marks: np.ndarray) -> np.ndarray:
    """For each mark the first one of its component under the radius, by index."""
    near = np.bitwise_count(marks[:, None] ^ marks[None, :]) <= RADIUS
    root = np.arange(len(marks))
    while True:
        now = np.where(near, root[None, :], len(marks)).min(axis=1)
        if (now == root).all():
            return root
        root = now


def _links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that join what lies within the radius under a key, as stars; rows of too long runs go on.

    Rows come sorted by key. A run's links are at most its rows.
    """
    for (key, mark, part), whole in whole_runs(batches, RUN_ROWS):
        if not whole:
            yield _link_rows(np.full(len(key), True), mark, key, part)
            continue
        starts = run_starts(key)
        sizes = np.diff(np.append(starts, len(key)))
        a, b = [], []
        two = starts[sizes == 2]
        close = two[np.bitwise_count((mark[two] ^ mark[two + 1]).view(np.uint64)) <= RADIUS]
        a.append(mark[close])
        b.append(mark[close + 1])
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            group = mark[s:s + n]
            root = _linked(group.view(np.uint64))
            a.append(group)
            b.append(group[root])
        a, b = np.concatenate(a), np.concatenate(b)
        other = a != b
        if other.any():
            yield _link_rows(np.zeros(int(other.sum()), bool), a[other], b[other], None)


def _link_rows(more, a, b, part) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(more), pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64()) if part is None else pa.array(part)],
        ["more", "a", "b", "part"])


def link_marks(marks: DataFrame) -> DataFrame:
    """Links (a, b) between distinct 64-bit ``mark`` values that differ in at most three bits.

    Not all pairs: in each group the links join exactly what is connected. A
    key that too many marks share is cut again, by variants of the segment
    that is still free: 2 of 32 bits, then 2 of 16, then 2 of 8. At the last
    level eight bits and the three struck out are free, so a run can't be
    longer than ``RUN_ROWS``.
    """
    rows, found = marks.select("mark", F.col("mark").alias("part")), []
    for bits, within in ((32, []), (16, ["key"]), (8, ["key"])):
        keyed = variants(rows, bits, within)
        out = settle(keyed.repartition("key").sortWithinPartitions("key", "mark")
                     .mapInArrow(_links, "more boolean, a long, b long, part long"), "near-links")
        found.append(out.filter("NOT more").select("a", "b"))
        rows = out.filter("more").select(F.col("a").alias("mark"), F.col("b").alias("key"), "part")
        if rows.isEmpty():
            break
    else:
        raise ValueError("two keys of the near-duplicate search share a hash")
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links.distinct()


def component_of_marks(rows: DataFrame, marks: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` (id, mark) with ``component``, the smallest id that links (a, b) of marks lead to; ``marks`` has each one's first id."""
    found = components(links)
    least = (found.join(marks, found.node == marks.mark).groupBy("root").agg(F.min("first").alias("least")))
    known = found.join(least, "root").select(F.col("node").alias("mark"), "least")
    classes = marks.join(known, "mark", "left").select("mark", F.coalesce("least", "first").alias("component"))
    return rows.join(classes, "mark")


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE) -> DataFrame:
    """(``id_col``, fingerprint, component_id) for each row; documents are linked within three bits.

    ``fingerprint`` has 16 hexadecimal digits; ``component_id`` is the smallest
    id reachable. Equal fingerprints are one node, so a group of any number of
    copies is one row in all that follows. Null, empty and blank texts have
    fingerprint 0, which links like any other. A null id stands after all
    others; a component of null ids alone has a null component_id. Repeated
    rows come back as often as they came. Other columns are not read.
    """
    id_type = documents.schema[id_col].dataType
    texts = documents.select(id_or_last(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = settle(texts.mapInArrow(lambda b: _fingerprints(b, shingle), "id long, mark long"), "fingerprints")
    marks = settle(rows.groupBy("mark").agg(F.min("id").alias("first")), "marks")
    own = lambda c: F.when(F.col(c) != NULL_ID, F.col(c)).cast(id_type)
    return (component_of_marks(rows, marks, link_marks(marks))
            .select(own("id").alias(id_col), F.lpad(F.lower(F.hex("mark")), 16, "0").alias("fingerprint"),
                    own("component").alias("component_id")))


def one_of_each(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The documents that are the smallest id of their component, with all their columns.

    Of rows that share an id each stays or goes with it; rows of a null id
    stay only if no other id is in their component.
    """
    classes = near_duplicates(documents, id_col, text_col, shingle)
    name = column_name(documents, "kept")
    kept = classes.filter(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias(name)).distinct()
    return documents.join(kept, F.col(id_col).eqNullSafe(F.col(name)), "left_semi")
