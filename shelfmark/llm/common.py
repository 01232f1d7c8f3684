"""Helpers the operators share: words of a batch of texts, runs of equal keys, hashes."""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, functions as F

SLICE_BYTES = 8 << 20
NULL_ID = (1 << 63) - 1
WORD = r"[^\x20\x09-\x0D]+"


def id_or_last(column: str) -> Column:
    """A document id for ordering and joining: a null id stands after all others."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece holds about ``SLICE_BYTES`` of text, or one longer text."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths).tolist()
        start = 0
        while start < batch.num_rows:
            room = (ends[start - 1] if start else 0) + SLICE_BYTES
            stop = max(start + 1, bisect.bisect_right(ends, room))
            yield batch.slice(start, stop - start)
            start = stop


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between ASCII white space: first word of each text (and the end), word codes, the distinct words.

    A null text has no words.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    values = lists.flatten()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    filled = pc.not_equal(values, "")
    if not pc.all(filled).as_py():
        kept = np.concatenate(([0], np.cumsum(filled.to_numpy(zero_copy_only=False))))
        ends = np.cumsum(counts)
        counts = kept[ends] - kept[ends - counts]
        values = values.filter(filled)
    coded = values.dictionary_encode()
    starts = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
    return starts, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def word_hashes(words: pa.Array) -> np.ndarray:
    """Two independent 64-bit hashes of each word, as two rows."""
    digests = b"".join(map(xxhash.xxh3_128_digest, words.to_pylist()))
    return np.frombuffer(digests, np.uint64).reshape(-1, 2).T if digests else np.zeros((2, 0), np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n, modulo 2**64."""
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Windows:
    """Hashes of any window of consecutive hashed words, from prefix sums.

    With an odd base a prefix sum of ``hash[i] * base**i`` can be shifted back
    by the inverse of the base, so a window's hash costs two look-ups.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, hashes: np.ndarray, base: int = BASE):
        up = powers(base, len(hashes))
        self.down = powers(pow(base, -1, 1 << 64), len(hashes))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[:-1], dtype=np.uint64)))

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        mixed = (self.sums[starts + length] - self.sums[starts]) * self.down[starts]
        mixed ^= mixed >> np.uint64(32)
        return mixed * np.uint64(0xD6E8FEB86659FD93)


def columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in batch.columns]


def whole_runs(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[tuple[list[np.ndarray], bool]]:
    """Rows sorted by the first column, as pieces that never cut a run of equal keys.

    Yields (columns, True) for whole runs of at most ``limit`` rows, and
    (columns, False) for rows of longer runs, which are passed on unheld.
    """
    held: list[np.ndarray] | None = None
    giant = None
    for batch in batches:
        rows = columns(batch)
        if giant is not None and len(rows[0]):
            n = int(np.searchsorted(rows[0], giant, "right"))
            if n:
                yield [c[:n] for c in rows], False
                rows = [c[n:] for c in rows]
        if not len(rows[0]):
            continue
        giant = None
        if held is not None:
            rows = [np.concatenate(pair) for pair in zip(held, rows)]
        last = int(np.searchsorted(rows[0], rows[0][-1], "left"))
        if last:
            yield from _by_length([c[:last] for c in rows], limit)
        held = [c[last:] for c in rows]
        if len(held[0]) > limit:
            yield held, False
            giant, held = held[0][0], None
    if held is not None:
        yield from _by_length(held, limit)


def _by_length(rows: list[np.ndarray], limit: int) -> Iterator[tuple[list[np.ndarray], bool]]:
    starts = run_starts(rows[0])
    lengths = np.diff(np.append(starts, len(rows[0])))
    long = np.repeat(lengths > limit, lengths)
    if long.any():
        yield [c[long] for c in rows], False
        rows = [c[~long] for c in rows]
    if len(rows[0]):
        yield rows, True


def run_starts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal sorted keys begin."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)


def column_name(df, wanted: str) -> str:
    """A name no column of the frame has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
