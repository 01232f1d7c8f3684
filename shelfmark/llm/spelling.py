"""Words one edit apart, by bit-sliced position indexes, and the frequent form each rare word stands for.

Two words one edit apart share what stands before the edit and what stands
after it. So the words are dealt to groups that share a half: all but a range
of their letters. A group's words are indexed by bits: for each position and
letter a bitset of the words that have it there. One pass over a word's letters
keeps four bitsets of the group: words equal so far, words with one letter
replaced, with one letter more (compared one position further on) and with one
letter less (one position back). Each step handles 64 words at once.

A group of too many words is cut again: the range is halved, and the edit lies
in one half or the other. With a range of one letter a group has at most as
many words as there are letters, and pairs of them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.common import run_starts, slices
from shelfmark.operators.settle import settle

SHORTEST, LEAST, TIMES, TYPO_EVERY = 7, 2, 10, 31
RUNS = re.compile(rb"[a-z\xc0-\xff]{%d,}" % SHORTEST)
#: Words of a group that are compared at once; longer groups are cut again.
GROUP = 2_048
#: Entries of a batch's bitset index, and pairs of a word and 64 others, that are held at once.
INDEX_ROOM, PAIR_ROOM = 4 << 20, 1 << 18
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def count_words(total: Counter, doc_id: str, text: str) -> None:
    """Adds the document's words of at least ``SHORTEST`` letters, in Latin-1, as it spells them: some lose a letter, by a checksum."""
    # What isn't in Latin-1 ends a run, as "?" does; lower() of bytes changes A-Z alone.
    runs = Counter(RUNS.findall(text.encode("latin-1", "replace").lower()))
    before = zlib.crc32(f"{doc_id}:".encode())
    for run, n in runs.items():
        check = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), before)
        if check % TYPO_EVERY == 0:
            if len(run) == SHORTEST:
                continue
            at = check % len(run)
            run = run[:at] + run[at + 1:]
        total[run] += n


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        total: Counter = Counter()
        for doc_id, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
            if text:
                count_words(total, doc_id, text)
        words = pa.array([w.decode("latin-1") for w in total], pa.string())
        yield pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], ["word", "n"])


def vocabulary(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words that occur at least twice. A null text has none; a null id counts as empty text."""
    rows = documents.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= LEAST))


# A group's key is (shorter, start, stop, before, after): words of ``shorter`` letters, or one more, that share
# ``before`` (the first ``start`` letters) and ``after`` (as many letters at the end as the shorter word has from ``stop``).
ROWS = "key string, start int, stop int, shorter int, word string, n long"
ROW_NAMES = [c.split()[0] for c in ROWS.split(", ")]
ROW_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()]


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows (word, n, shorter, start, stop) with their group's key."""
    behind = F.col("shorter") - F.col("stop")
    after = F.substring("word", F.length("word") - behind + 1, behind)
    key = F.concat_ws(",", "shorter", "start", "stop", F.substring("word", F.lit(1), F.col("start")), after)
    return rows.select(key.alias("key"), *ROW_NAMES[1:])


def _halves(rows: DataFrame) -> DataFrame:
    """Each row with its range's first half and its second."""
    middle = F.floor((F.col("start") + F.col("stop")) / 2).cast("int")
    both = F.array(F.struct("start", middle.alias("stop")), F.struct(middle.alias("start"), "stop"))
    return rows.withColumn("half", F.explode(both)).select("word", "n", "shorter", "half.start", "half.stop")


def _opened(words: DataFrame) -> DataFrame:
    """Each word in the groups of its length and of one letter less, with the edit in the first half or the second."""
    rows = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("shorter"))
    rows = rows.filter(F.col("shorter") >= SHORTEST).withColumns({"start": F.lit(0), "stop": F.col("shorter")})
    return _dealt(_halves(rows))


class Index:
    """Bitsets of the words of many groups: bit b of lane l is a word, in order of its group's words."""

    def __init__(self, letters: np.ndarray, lengths: np.ndarray, lane: np.ndarray, bit: np.ndarray, lanes: int, width: int):
        self.alphabet, coded = np.unique(letters, return_inverse=True)
        self.codes = coded.reshape(letters.shape).astype(np.int64)
        kinds = len(self.alphabet)
        mine = np.uint64(1) << bit.astype(np.uint64)
        # Position -1 and the one after the last hold no word.
        self.at = np.zeros((letters.shape[1] + 2, lanes * kinds), np.uint64)
        for i in range(letters.shape[1]):
            there = np.flatnonzero(lengths > i)
            np.add.at(self.at[i + 1], lane[there] * kinds + self.codes[there, i], mine[there])
        self.short, self.long = (np.zeros(lanes, np.uint64) for _ in range(2))
        np.add.at(self.short, lane[lengths == width], mine[lengths == width])
        np.add.at(self.long, lane[lengths > width], mine[lengths > width])
        self.kinds = kinds

    def having(self, position: int, lane: np.ndarray, code: np.ndarray) -> np.ndarray:
        return self.at[position + 1][lane * self.kinds + code]


def one_edit(index: Index, word: np.ndarray, lane: np.ndarray, is_long: np.ndarray, width: int, shares_no_more: np.ndarray) -> np.ndarray:
    """For each pair of a word and a lane the bitset of the lane's words one edit from it.

    Words have ``width`` letters (short) or one more (long). Pairs of long words
    belong to other groups. Where ``shares_no_more`` is set, words equal in their
    first ``width`` letters do too.
    """
    whole = index.short[lane] | index.long[lane]
    equal, replaced, more, less = whole.copy(), np.zeros_like(whole), whole.copy(), np.zeros_like(whole)
    found = np.zeros_like(whole)
    for i in range(width + 1):
        if i == width:
            near = (replaced & index.short[lane]) | (more & index.long[lane])
            found = np.where(shares_no_more, near & ~equal, near)
            first = equal
        code = index.codes[word, min(i, index.codes.shape[1] - 1)]
        here, further, back = (index.having(i + d, lane, code) for d in (0, 1, -1))
        replaced = (replaced & here) | (equal & ~here)
        less = (less & back) | equal
        equal = equal & here
        more = (more & further) | equal
    near = less & index.short[lane]
    return np.where(is_long, np.where(shares_no_more, near & ~first, near), found)


NEAR = "word string, n_near long, best_n long, best string"


def _compared(groups: list[tuple], width: int) -> pa.RecordBatch | None:
    """What is near each word of some groups of (start, stop, shorter, words, counts); words stand by falling count, then in order."""
    words = [w for g in groups for w in g[3]]
    counts = np.array([n for g in groups for n in g[4]], np.int64)
    sizes = np.array([len(g[3]) for g in groups])
    group = np.repeat(np.arange(len(groups)), sizes)
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    per_group = -(-sizes // 64)
    first_lane = np.cumsum(per_group) - per_group
    start = np.repeat([g[0] for g in groups], sizes).tolist()
    end = np.repeat([g[2] - g[1] for g in groups], sizes).tolist()
    inner = [w[a:len(w) - b].encode("latin-1") for w, a, b in zip(words, start, end)]
    lengths = np.array([len(x) for x in inner])
    letters = np.frombuffer(b"".join(x.ljust(width + 1, b"\0") for x in inner), np.uint8).reshape(-1, width + 1)
    index = Index(letters, lengths, first_lane[group] + place // 64, place % 64, int(per_group.sum()), width)
    cut = np.array([g[1] < g[2] for g in groups])
    out = []
    pairs = per_group[group]
    ends = np.cumsum(pairs)
    begin = 0
    while begin < len(words):
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PAIR_ROOM, "right")))
        some = np.repeat(np.arange(begin, stop), pairs[begin:stop])
        opens = np.cumsum(pairs[begin:stop]) - pairs[begin:stop]
        own = np.arange(len(some)) - np.repeat(opens, pairs[begin:stop])
        near = one_edit(index, some, first_lane[group[some]] + own, lengths[some] > width, width, cut[group[some]])
        n = np.add.reduceat(np.bitwise_count(near).astype(np.int64), opens)
        lowest = np.where(near > 0, own * 64 + np.bitwise_count((near & -near) - np.uint64(1)), 1 << 40)
        best = np.minimum.reduceat(lowest, opens)
        hit = np.flatnonzero(n)
        at = begin + hit
        other = at - place[at] + best[hit]
        out += list(zip([words[i] for i in at.tolist()], n[hit].tolist(), counts[other].tolist(), [words[i] for i in other.tolist()]))
        begin = stop
    if not out:
        return None
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                      ["word", "n_near", "best_n", "best"])


def _groups(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.RecordBatch | None, tuple | None]]:
    """(rows of a too long group, None) and (None, (start, stop, shorter, words, counts)); rows come sorted by key.

    At most ``limit`` rows of a group are held before it counts as too long.
    """
    held: tuple[str, list[pa.RecordBatch]] | None = None
    passing = None
    for batch in batches:
        keys = batch.column("key")
        starts = run_starts(keys.dictionary_encode().indices.to_numpy())
        stops = np.append(starts[1:], batch.num_rows)
        # Between the batch's first key and its last, a key of one row is a word alone.
        whole = stops - starts > 1
        whole[:1] = whole[-1:] = True
        for a, b in zip(starts[whole].tolist(), stops[whole].tolist()):
            key, piece = keys[a].as_py(), batch.slice(a, b - a)
            if key == passing:
                yield piece, None
                continue
            passing = None
            if held is not None and held[0] != key:
                yield from _closed(held[1])
                held = None
            pieces = [*(held[1] if held else []), piece]
            if limit and sum(p.num_rows for p in pieces) > limit and _can_halve(piece):
                yield from ((p, None) for p in pieces)
                held, passing = None, key
            else:
                held = (key, pieces)
    if held is not None:
        yield from _closed(held[1])


def _can_halve(piece: pa.RecordBatch) -> bool:
    return piece.column("stop")[0].as_py() - piece.column("start")[0].as_py() > 1


def _closed(pieces: list[pa.RecordBatch]) -> Iterator[tuple[None, tuple]]:
    if sum(p.num_rows for p in pieces) == 1:
        return
    start, stop, shorter = (pieces[0].column(c)[0].as_py() for c in ("start", "stop", "shorter"))
    words = [w for p in pieces for w in p.column("word").to_pylist()]
    if any(len(w) == shorter for w in words):
        yield None, (start, stop, shorter, words, [n for p in pieces for n in p.column("n").to_pylist()])


def _near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of whole groups, compared many groups at once by the width of their range; rows of too long groups go on."""
    waiting: dict[int, list[tuple]] = {}
    room: Counter = Counter()
    for piece, group in _groups(batches, GROUP):
        if piece is not None:
            yield _wide(piece, None)
            continue
        width = group[1] - group[0]
        waiting.setdefault(width, []).append(group)
        # An index holds at most 100 letters or so for each lane and position.
        room[width] += -(-len(group[3]) // 64) * (width + 3) * 100
        if room[width] > INDEX_ROOM:
            yield _wide(None, _compared(waiting.pop(width), width))
            room[width] = 0
    for width, groups in waiting.items():
        yield _wide(None, _compared(groups, width))


WIDE = f"{ROWS}, {NEAR.replace('word string', 'found string')}"


def _wide(rows: pa.RecordBatch | None, near: pa.RecordBatch | None) -> pa.RecordBatch:
    """Rows to cut again, or near words, in the columns of both."""
    n = rows.num_rows if rows is not None else near.num_rows if near is not None else 0
    types = [*ROW_TYPES, pa.string(), pa.int64(), pa.int64(), pa.string()]
    made = (rows.columns if rows is not None else [pa.nulls(n, t) for t in ROW_TYPES]) + (
        near.columns if near is not None else [pa.nulls(n, t) for t in types[len(ROW_TYPES):]])
    return pa.RecordBatch.from_arrays([pc.cast(c, t) for c, t in zip(made, types)], [c.split()[0] for c in WIDE.split(", ")])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) that have near ones.

    ``best`` is the near word of largest n, of equal ones the first in
    code-point order. Each pair is found in exactly one group. Groups above
    ``GROUP`` words go to a next round, at most one for each halving of the
    longest word; in all rounds together no pair is left out.
    """
    rows, found = _opened(words), []
    while True:
        out = settle(rows.repartition("key").sortWithinPartitions("key", F.desc("n"), "word").mapInArrow(_near, WIDE), "near-words")
        found.append(out.filter("found IS NOT NULL").select(F.col("found").alias("word"), "n_near", "best_n", "best"))
        large = out.filter("key IS NOT NULL")
        if large.isEmpty():
            break
        rows = _dealt(_halves(large))
    all_found = found[0]
    for more in found[1:]:
        all_found = all_found.unionByName(more)
    first = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return (all_found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first"))
            .select("word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.word").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words (word, form): where following forms ends.

    A form occurs ``TIMES`` times as often as its word, so a chain of forms has
    as many steps as a count has digits. Each round doubles the steps taken.
    """
    known = settle(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = known.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went"))
        moved = settle(moved, "forms")
        known = moved.select("word", "root")
        if moved.filter("went").isEmpty():
            return known


def group_variants(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the documents.

    Words are runs of Latin letters in lower case (A-Z alone), after a few lose
    a letter by a checksum of the document's id and the run; at least
    ``SHORTEST`` letters long and there ``LEAST`` times. ``form`` is the near
    word of largest n if that is at least ``TIMES`` the word's n, else null;
    ``root`` is the last form that forms lead to. Null and empty texts and
    texts without letters give no words, an empty table an empty result; a null
    id counts as empty text; repeated rows count as often as they come. Other
    columns are not read. Words of any length are compared whole.
    """
    words = settle(vocabulary(documents, id_col, text_col), "words")
    near = near_words(words)
    rows = words.join(near, "word", "left")
    has_form = F.col("best_n") >= TIMES * F.col("n")
    rows = settle(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                              F.when(has_form, F.col("best")).alias("form"), F.when(has_form, F.col("best_n")).alias("form_n")), "near")
    ends = roots(rows.filter("form IS NOT NULL").select("word", "form"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
