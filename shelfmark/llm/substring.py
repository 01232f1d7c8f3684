"""Removal of repeated passages: difference-cover anchors, extended to whole windows.

Only windows that start at cover positions (modulo a period) are hashed and
shuffled. In a cover every difference of two positions occurs, so any two equal
passages of ``window`` words share an anchor of ``window - period + 1`` words
at the same offset. Anchors that occur again are extended to the whole windows
around them, which are compared by 80 bits of two hashes; every occurrence but the
first (smallest id, then earliest start) is removed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.common import NULL_ID, Windows, id_or_last, slices, split_words, word_hashes
from shelfmark.operators.keys import assign_ids_sorted
from shelfmark.operators.settle import settle

#: Perfect difference sets, by period.
COVERS = {1: (0,), 3: (0, 1), 7: (1, 2, 4), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}
WINDOW = 20
#: Buckets of hashes for each shuffle partition; a task sorts one bucket at a time.
BUCKETS = 4
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def period_for(window: int) -> int:
    """The longest period that leaves anchors of at least a third of a window."""
    return max(p for p in COVERS if window - p + 1 >= max(1, window // 3))


def narrow(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 on in the fewest bytes that hold the largest, after a byte that tells how many."""
    top = int(numbers.max()) if len(numbers) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    return bytes([width]) + numbers.astype(f"<u{width}").tobytes()


def wide(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype(np.int64)


#: A pack holds rows of one bucket: the first id, hashes, steps between ids, positions, and whether
#: the row's repeats are settled. Rows without ``marks`` hold settled positions of one document.
PACK = "bucket int, id long, positions binary, marks binary, checks binary, steps binary, known binary"
PACK_NAMES = [c.split()[0] for c in PACK.split(", ")]
PACK_TYPES = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
PACKED_TYPES = "id long, packed binary"


def _packs(hashes: np.ndarray, checks: np.ndarray | None, ids: np.ndarray, position: np.ndarray, known: np.ndarray,
           buckets: int) -> list[tuple]:
    """The rows as one pack for each bucket. Within a bucket 32 bits of an anchor's hash do, since its match is checked."""
    bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((ids, bucket))
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    out = []
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        at = order[cuts[b]:cuts[b + 1]]
        marks = hashes[at].astype("<u4") if checks is None else hashes[at]
        out.append((b, int(ids[at[0]]), narrow(position[at]), marks.tobytes(),
                    None if checks is None else checks[at].astype("<u2").tobytes(),
                    narrow(np.diff(ids[at], prepend=ids[at[0]])), np.packbits(known[at]).tobytes()))
    return out


def _by_document(ids: np.ndarray, position: np.ndarray) -> list[tuple[int, bytes]]:
    """(id, packed positions), for rows in any order."""
    order = np.lexsort((position, ids))
    ids, small = ids[order], position[order].astype("<i4")
    cuts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))) if len(ids) else []
    return [(int(ids[a]), small[a:b].tobytes()) for a, b in zip(cuts, [*cuts[1:], len(ids)])]


def _settled(ids: np.ndarray, position: np.ndarray, buckets: int) -> list[tuple]:
    """Positions settled in the map task, one row for each document, spread by document."""
    return [(hash(i) % buckets, i, packed, None, None, None, None) for i, packed in _by_document(ids, position)]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), PACK_TYPES)], PACK_NAMES)


def _anchors(batches: Iterable[pa.RecordBatch], window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Anchors of each document, in packs.

    Equal anchors of one piece are known to be repeated: their positions are
    settled here and one anchor stands for them all, so that a passage of very
    many copies stays a few rows for each task.
    """
    period = period_for(window)
    cover = np.zeros(period, bool)
    cover[list(COVERS[period])] = True
    length = window - period + 1
    for part in slices(batches):
        starts, codes, words = split_words(part.column(1))
        ids = part.column(0).to_numpy(zero_copy_only=False)
        counts = np.diff(starts)
        position = np.arange(len(codes)) - np.repeat(starts[:-1], counts)
        room = np.repeat(counts, counts)
        at = np.flatnonzero(cover[position % period] & (position + length <= room) & (room >= window))
        if not len(at):
            continue
        ids = np.repeat(ids, counts)[at]
        hashes = Windows(word_hashes(words)[0][codes]).at(at, length)
        order = np.argsort(hashes, kind="stable")
        first = np.concatenate(([True], hashes[order][1:] != hashes[order][:-1]))
        sizes = np.diff(np.append(np.flatnonzero(first), len(order)))
        stands = order[first]
        again = order[np.repeat(sizes > 1, sizes)]
        yield _batch(_packs(hashes[stands], None, ids[stands], position[at[stands]], sizes > 1, buckets)
                     + _settled(ids[again], position[at[again]], buckets))


def _windows(batches: Iterable[pa.RecordBatch], window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Whole windows around repeated anchors, in packs; those that start earlier in the same piece are settled here."""
    reach = period_for(window)
    for part in slices(batches):
        starts, codes, words = split_words(part.column(1))
        ids = part.column(0).to_numpy(zero_copy_only=False)
        counts = np.diff(starts)
        opens = np.zeros(len(codes) + 1, np.int64)
        for row, anchors in enumerate(part.column(2)):
            at = np.frombuffer(b"".join(anchors.as_py()), "<i4").astype(np.int64)
            at = at[at < counts[row]] + starts[row]
            np.add.at(opens, np.maximum(at - reach + 1, starts[row]), 1)
            np.add.at(opens, at + 1, -1)
        position = np.arange(len(codes)) - np.repeat(starts[:-1], counts)
        at = np.flatnonzero((np.cumsum(opens[:-1]) > 0) & (position + window <= np.repeat(counts, counts)))
        if not len(at):
            continue
        ids, position = np.repeat(ids, counts)[at], position[at]
        one, two = word_hashes(words)
        hashes = Windows(one[codes]).at(at, window)
        checks = Windows(two[codes], 0xC2B2AE3D27D4EB4F).at(at, window) >> np.uint64(48)
        first, later = _first_and_later(hashes, checks, ids, position)
        yield _batch(_packs(hashes[first], checks[first], ids[first], position[first], np.zeros(len(first), bool), buckets)
                     + _settled(ids[later], position[later], buckets))


def _first_and_later(hashes, checks, ids, position) -> tuple[np.ndarray, np.ndarray]:
    """Of each window the first row, and the rows of later starts."""
    order = np.lexsort((position, ids, checks, hashes))
    h, c = hashes[order], checks[order]
    opens = np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1]))) if len(h) else np.zeros(0, bool)
    first = order[opens]
    its = first[np.cumsum(opens) - 1]
    return first, order[(ids[order] != ids[its]) | (position[order] != position[its])]


def _singles(ids: np.ndarray, position: np.ndarray) -> pa.RecordBatch:
    """One row for each position. Packs by document would be one for each bucket too: more than the input grows."""
    order = np.argsort(ids, kind="stable")
    raw = pa.py_buffer(position[order].astype("<i4").tobytes())
    packed = pa.Array.from_buffers(pa.binary(4), len(order), [None, raw]).cast(pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(ids[order], pa.int64()), packed], ["id", "packed"])


def _buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[tuple], pa.RecordBatch | None]]:
    """(the packs of one whole bucket, None), and (no packs, settled rows); rows come sorted by bucket."""
    held: list[tuple] = []
    for batch in batches:
        settled = batch.filter(batch.column("marks").is_null())
        if settled.num_rows:
            yield [], pa.RecordBatch.from_arrays([settled.column("id"), settled.column("positions")], ["id", "packed"])
        packs = batch.filter(batch.column("marks").is_valid())
        for row in zip(*(c.to_pylist() for c in packs.columns)):
            if held and held[0][0] != row[0]:
                yield held, None
                held = []
            held.append(row)
    if held:
        yield held, None


def _rows(packs: list[tuple]) -> tuple[np.ndarray, ...]:
    """(hashes, checks, ids, positions, known) of a bucket's packs."""
    _, first, position, marks, checks, steps, known = zip(*packs)
    position = [wide(p) for p in position]
    kind = "<u4" if checks[0] is None else "<u8"
    return (np.concatenate([np.frombuffer(m, kind) for m in marks]),
            np.concatenate([np.frombuffer(c or b"", "<u2") for c in checks]),
            np.concatenate([np.cumsum(wide(s)) + i for s, i in zip(steps, first)]), np.concatenate(position),
            np.concatenate([np.unpackbits(np.frombuffer(k, np.uint8), count=len(p)) for k, p in zip(known, position)]).astype(bool))


def _repeated(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions of anchors that occur more than once."""
    for packs, settled in _buckets(batches):
        if settled is not None:
            yield settled
            continue
        hashes, _, ids, position, known = _rows(packs)
        order = np.argsort(hashes, kind="stable")
        same = hashes[order][1:] == hashes[order][:-1]
        again = order[(np.concatenate((same, [False])) | np.concatenate(([False], same))) & ~known[order]]
        yield _singles(ids[again], position[again])


def _later(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Starts of windows that also start earlier."""
    for packs, settled in _buckets(batches):
        if settled is not None:
            yield settled
            continue
        hashes, checks, ids, position, _ = _rows(packs)
        _, later = _first_and_later(hashes, checks, ids, position)
        yield _singles(ids[later], position[later])


def _cut(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for text, later in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            raw = (text or "").encode()
            words = raw.split()
            n, kept_text, runs = len(words), text, 0
            if later:
                at = np.frombuffer(b"".join(later), "<i4")
                edge = np.zeros(n + window + 1, np.int64)
                at = at[at + window <= n]
                np.add.at(edge, at, 1)
                np.add.at(edge, at + window, -1)
                gone = np.cumsum(edge[:n]) > 0
                runs = int(gone.sum())
            if runs:
                keep = np.flatnonzero(~gone)
                words = [words[i] for i in keep.tolist()]
                spans = [m.span() for m in WORDS.finditer(raw)]
                breaks = np.flatnonzero(np.diff(keep) > 1)
                heads = keep[np.concatenate(([0], breaks + 1))].tolist() if len(keep) else []
                tails = keep[np.concatenate((breaks, [len(keep) - 1]))].tolist() if len(keep) else []
                kept_text = b" ".join(raw[spans[a][0]:spans[b][1]] for a, b in zip(heads, tails)).decode()
            out.append((kept_text, n, runs, hashlib.sha256(b" ".join(words)).hexdigest()))
        made = [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 4, (pa.string(), pa.int64(), pa.int64(), pa.string()))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *batch.columns[3:], *made],
            ["id", *batch.schema.names[3:], "kept_text", "n_words", "n_removed", "kept_sha256"])


def repeated_starts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(texts by id, starts of windows that occur earlier, packed as 4-byte integers by id)."""
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = parts * BUCKETS

    def by_bucket(packs: DataFrame) -> DataFrame:
        return packs.repartitionById(parts, F.col("bucket") % parts).sortWithinPartitions("bucket")
    texts = documents.select(id_or_last(id_col).alias("id"), F.col(text_col).alias("text"), *keep)
    anchors = (texts.filter(F.col("text").isNotNull()).select("id", "text")
               .mapInArrow(lambda b: _anchors(b, window, buckets), PACK))
    repeated = (by_bucket(anchors).mapInArrow(_repeated, PACKED_TYPES)
                .groupBy("id").agg(F.collect_list("packed").alias("packed")))
    windows = (texts.join(repeated, "id").select("id", "text", "packed")
               .mapInArrow(lambda b: _windows(b, window, buckets), PACK))
    later = (by_bucket(windows).mapInArrow(_later, PACKED_TYPES)
             .groupBy("id").agg(F.collect_list("packed").alias("packed")))
    return texts, later


def numbered(rows: DataFrame) -> DataFrame:
    """The rows (id, text and others) with numbers in the ids' place, and ``own_id``.

    Pairs of id and text are numbered in order of id, then of a hash of the
    text, so that rows of an id with different texts become documents of their
    own, and null ids are as many as they have texts.
    """
    marked = rows.withColumns({"text_mark": F.xxhash64("text"), "text_check": F.hash("text")})
    marks = ["id", "text_mark", "text_check"]
    numbers = settle(assign_ids_sorted(marked.select(*marks).distinct(), "number", marks), "numbers")
    made = marked.join(numbers, marks).withColumnsRenamed({"id": "own_id", "number": "id"})
    return made.select("id", *[c for c in rows.columns if c != "id"], "own_id")


def remove_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Each document without the words of windows that also start earlier.

    Returns ``id_col``, the columns ``keep``, ``kept_text``, ``n_words``,
    ``n_removed`` and ``kept_sha256`` (digest of the kept words joined by one
    space). What is left of a changed text keeps its white space, except where
    words went.

    A null text has no words and stays null; texts of fewer than ``window``
    words are never changed; an empty table gives an empty result. A null id
    stands after all others. Rows that share an id, or have none, are documents
    of their own where their texts differ, in order of a hash of the text; equal
    rows are one document and come back as often as they came. Columns not in
    ``keep`` are not read, whatever their names.
    """
    names = [f"kept_column_{i}" for i in range(len(keep))]
    plain = documents.select(id_or_last(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(n) for c, n in zip(keep, names)])
    own = "id"
    if not plain.groupBy("id").count().filter("count > 1").isEmpty():
        plain, own = numbered(plain), "own_id"
        names = [*names, own]
    texts, later = repeated_starts(plain, "id", "text", window, tuple(names))
    kinds = "".join(f"{n} {plain.schema[n].dataType.simpleString()}, " for n in names)
    cut = (texts.join(later, "id", "left").select("id", "text", "packed", *names)
           .mapInArrow(lambda b: _cut(b, window),
                       f"id long, {kinds}kept_text string, n_words long, n_removed long, kept_sha256 string"))
    own_id = F.when(F.col(own) != NULL_ID, F.col(own)).cast(documents.schema[id_col].dataType)
    return cut.select(own_id.alias(id_col), *[F.col(n).alias(c) for c, n in zip(keep, names)],
                      "kept_text", "n_words", "n_removed", "kept_sha256")
