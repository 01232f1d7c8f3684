"""SimHash fingerprints, and a search for all fingerprints within a Hamming radius by permuted block tables.

A text's terms are its shingles of words; each votes with its weight, the
number of times it occurs, for the set bits of its hash and against the others.
The 64 bits are cut into twice as many blocks as the radius; a table for every
half of the blocks is keyed by those blocks' bits. Two fingerprints within the
radius differ in at most half of the blocks, so they share a key of some table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.common import (
    NULL_ID, Windows, id_or_last, run_starts, slices, split_words, whole_runs, word_hashes)
from shelfmark.llm.ordering import by_id_ranges, id_bounds
from shelfmark.operators.settle import settle

BITS = 64
SHINGLE = 3
RADIUS = 3
#: Rows of one key held at once; of longer runs only the fingerprints asked for are held.
RUN_ROWS = 1 << 18
PAIRS = 1 << 20
VOTES = 1 << 16


def simhash(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text; no words give 0, fewer words than a shingle are one term."""
    starts, codes, words = split_words(texts)
    counts = np.diff(starts)
    out = np.zeros(len(counts), np.uint64)
    hashes = Windows(word_hashes(words)[0][codes])
    terms = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    ends = np.cumsum(terms)
    full = np.flatnonzero(terms)
    at = 0
    while at < len(full):
        # As many texts as give VOTES terms, or one longer text in pieces.
        room = (ends[full[at]] - terms[full[at]]) + VOTES
        stop = max(at + 1, int(np.searchsorted(ends[full], room, "right")))
        rows = full[at:stop]
        at = stop
        n = terms[rows]
        begin = np.repeat(starts[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        marks = np.empty(len(begin), np.uint64)
        whole = np.repeat(counts[rows] >= shingle, n)
        marks[whole] = hashes.at(begin[whole], shingle)
        for short in np.flatnonzero(~whole):
            marks[short] = hashes.at(begin[short:short + 1], int(counts[np.searchsorted(starts, begin[short], "right") - 1]))[0]
        sums = np.zeros((len(rows), BITS), np.int64)
        for cut in range(0, len(marks), VOTES):
            bits = np.unpackbits(marks[cut:cut + VOTES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            firsts = np.maximum(np.cumsum(n) - n - cut, 0)
            inside = (np.cumsum(n) > cut) & (firsts < len(bits))
            sums[inside] += np.add.reduceat(bits, firsts[inside], axis=0, dtype=np.int64)
        signed = 2 * sums - n[:, None]
        out[rows] = np.packbits(signed > 0, axis=1, bitorder="little").reshape(-1, 8).copy().view("<u8").ravel()
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal bits."""
    return 1 - np.bitwise_count(a ^ b) / BITS


def _marked(batches: Iterable[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        marks = pa.array(simhash(part.column(part.num_columns - 1), shingle).view(np.int64))
        yield pa.RecordBatch.from_arrays([*part.columns, marks], [*part.schema.names, "mark"])


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(``id_col``, mark): the 64-bit SimHash of every row's text, as a long.

    Null, empty and blank texts have mark 0; equal texts have equal marks.
    Repeated rows are kept, null ids too.
    """
    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(lambda b: _marked(b, shingle), "id long, text string, mark long")
    return out.select(F.col("id").alias(id_col), "mark")


def block_masks(radius: int) -> list[int]:
    """One mask for each table: half of the blocks."""
    edges = [round(i * BITS / (2 * radius)) for i in range(2 * radius + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(kept) for kept in combinations(blocks, radius)] if radius else [(1 << BITS) - 1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _near_counts(asked: np.ndarray, marks: np.ndarray, copies: np.ndarray, table: int, masks: np.ndarray, radius: int) -> np.ndarray:
    """Of each asked mark the rows within the radius that no earlier table finds."""
    out = np.zeros(len(asked), np.int64)
    step = max(1, PAIRS // max(1, len(marks)))
    for i in range(0, len(asked), step):
        for j in range(0, len(marks), PAIRS):
            differ = asked[i:i + step, None] ^ marks[None, j:j + PAIRS]
            near = np.bitwise_count(differ) <= radius
            a, b = np.nonzero(near)
            first = ((differ[a, b][:, None] & masks[None, :table]) != 0).all(axis=1)
            out[i:i + step] += np.bincount(a[first], copies[j + b[first]], minlength=len(out[i:i + step])).astype(np.int64)
    return out


def _search(batches: Iterable[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """(mark, n) for marks asked for; rows come sorted by key, those asked for first."""
    masks = np.array(block_masks(radius), np.uint64)
    giant, held = None, []

    def out(asked, n):
        return pa.RecordBatch.from_arrays([pa.array(asked.view(np.int64)), pa.array(n)], ["mark", "n"])
    for (key, table, mark, copies, asked), whole in whole_runs(batches, RUN_ROWS):
        mark, wanted = mark.view(np.uint64), asked.astype(bool)
        starts = run_starts(key)
        ends = np.append(starts[1:], len(key))
        # Most keys have one row, which needs no comparing.
        alone = (ends - starts == 1) & wanted[starts] & whole
        if alone.any():
            at = starts[alone]
            yield out(mark[at], np.where(table[at] == 0, copies[at], 0).astype(np.int64))
        for s, e in zip(starts.tolist(), ends.tolist()):
            if whole and (e - s == 1 or not wanted[s]):
                continue
            own, t = wanted[s:e], int(table[s])
            new, n_new = mark[s:e][own], copies[s:e][own]
            if not whole:
                if giant != key[s]:
                    giant, held = key[s], []
                for old, n_old in held:
                    yield out(old, _near_counts(old, mark[s:e], copies[s:e], t, masks, radius))
                    if len(new):
                        yield out(new, _near_counts(new, old, n_old, t, masks, radius))
                if len(new):
                    held.append((new, n_new))
            if len(new):
                yield out(new, _near_counts(new, mark[s:e], copies[s:e], t, masks, radius))


def near_counts(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(mark, n) for each mark asked for: rows (other or the same) whose mark is within the radius.

    ``rows`` has one row for each mark, its number of ``copies`` and whether
    it is ``asked`` for. Every mark stands in every table; each pair is counted
    in the first table that holds it, in the task, so no pairs are shuffled.
    """
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("mark").bitwiseAND(F.lit(_signed(m))).alias("kept"))
                       for i, m in enumerate(block_masks(radius))])
    keyed = (rows.select("mark", "copies", "asked", F.explode(tables).alias("x"))
             .select(F.xxhash64("x.t", "x.kept").alias("key"), F.col("x.t").alias("t"), "mark", "copies", "asked"))
    return (keyed.repartition("key").sortWithinPartitions("key", F.desc("asked"))
            .mapInArrow(lambda b: _search(b, radius), "mark long, n long")
            .groupBy("mark").agg(F.sum("n").alias("n")))


def _edited(batches: Iterable[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """Of rows in order: each with its edited text's digest and mark, and the next row's mark. The last guest ends it."""
    before = None
    for batch in slices(batches):
        rows = list(zip(batch.column("guest").to_pylist(), batch.column("id").to_pylist(),
                        batch.column("text").to_pylist(), batch.column("mark").to_pylist()))
        out, texts = [], []
        for row in rows:
            if before is not None and not before[0]:
                own, following = before[2] or "", row[2] or ""
                n = len(own) // 3
                texts.append(own[:len(own) - n] + following[:n])
                out.append((before[1], len(own), hashlib.sha256(texts[-1].encode()).hexdigest(), before[3], row[3]))
            before = row
        if out:
            edited = simhash(pa.array(texts), shingle)
            ids, n_chars, digests, marks, following = zip(*out)
            marks, following = np.array(marks, np.int64).view(np.uint64), np.array(following, np.int64).view(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n_chars, pa.int64()), pa.array(digests), pa.array(marks.view(np.int64)),
                 pa.array(edited.view(np.int64)), pa.array(likeness(marks, edited)), pa.array(likeness(marks, following))],
                ["id", "n_chars", "edited_sha256", "mark", "edited_mark", "near_edited", "near_next"])


def edit_likeness(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Every row's fingerprint beside that of its edited text and of the next row.

    The edited text's last third (rounded down, in code points) is the start
    of the next row's text; next is the next smaller id, after the last the
    first. Rows of equal ids stand in order of their texts; a null id stands
    above all others; a null text is empty. A single row is its own next one.
    Texts move once, dealt out by ranges of ids; fingerprints are made before.
    """
    rows = documents.select(id_or_last(id_col).alias("id"), F.col(text_col).alias("text"))
    bounds = id_bounds(rows, "id")
    marked = rows.mapInArrow(lambda b: _marked(b, shingle), "id long, text string, mark long")
    return (by_id_ranges(marked, bounds, ahead=True).sortWithinPartitions("guest", F.desc("id"), "text")
            .mapInArrow(lambda b: _edited(b, shingle), "id long, n_chars long, edited_sha256 string, mark long, "
                        "edited_mark long, near_edited double, near_next double"))


def _hex(column: str) -> Column:
    return F.lpad(F.lower(F.hex(column)), 16, "0")


def compare(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", ask_every: int = 50,
            radius: int = RADIUS) -> DataFrame:
    """``edit_likeness`` with fingerprints as 16 hexadecimal digits, and ``near_documents``.

    That is the number of other rows whose fingerprint lies within ``radius``
    bits, for rows whose id is divisible by ``ask_every``; null for others.
    """
    id_type = documents.schema[id_col].dataType
    rows = settle(edit_likeness(documents, id_col, text_col), "fingerprints")
    asked = (F.col("id") != NULL_ID) & (F.col("id") % ask_every == 0)
    counts = near_counts(rows.groupBy("mark").agg(F.count("*").alias("copies"), F.max(asked).alias("asked")), radius)
    return (rows.join(counts, "mark", "left")
            .select(F.when(F.col("id") != NULL_ID, F.col("id")).cast(id_type).alias(id_col), "n_chars", "edited_sha256",
                    _hex("mark").alias("fingerprint"), _hex("edited_mark").alias("edited_fingerprint"),
                    "near_edited", "near_next", F.when(asked, F.col("n") - 1).alias("near_documents")))
