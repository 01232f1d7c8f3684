"""Quality scores by a factorisation machine over hashed words, structure statistics and metadata.

A text's features are its hashed words, weighted by their counts and brought to
unit length, and one bin of each statistic: of its structure (shares of capital
letters, digits, symbols, repeated words, ...) and of its length. All pairs of
features interact through low-rank factors; their sum is half the difference of
the squared sum and the sum of squares, which takes linear time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.common import slices, split_words

BUCKETS = 1 << 16
RANK = 8
BINS = 8
#: Labelled documents the machine is fitted on: the bound of what the driver holds of them.
SAMPLE_ROWS = 8_000
STEPS = 1_200
BATCH = 64
RATE = 0.08
DECAY = 2e-5
THRESHOLD = 0.3
FOLDS = 5
STATISTICS = ["words", "bytes_per_word", "capitals", "digits", "symbols", "stops", "beyond_ascii", "distinct", "most_frequent", "lines"]


def _classes() -> np.ndarray:
    """For each byte whether it is a capital, a digit, a symbol, a stop or comma, or beyond ASCII."""
    out = np.zeros((5, 256), np.int64)
    out[0, ord("A"):ord("Z") + 1] = 1
    out[1, ord("0"):ord("9") + 1] = 1
    out[3, [ord(c) for c in ".,;:'\"()-"]] = 1
    printed = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])
    out[2] = printed & (out[3] == 0)
    out[4, 128:] = 1
    return out


CLASSES = _classes()


@dataclass
class Features:
    """Hashed words as (row, bucket, value), and the statistics of each row."""

    row: np.ndarray
    bucket: np.ndarray
    value: np.ndarray
    statistics: np.ndarray


def features(texts: pa.Array) -> Features:
    """Features of whole texts; a null or blank text has no words and statistics of 0."""
    starts, codes, words = split_words(texts)
    counts = np.diff(starts)
    n = len(counts)
    row = np.repeat(np.arange(n), counts)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words))
    bucket = (hashed % np.uint64(BUCKETS)).astype(np.int64)
    key, times = np.unique(row * len(words) + codes, return_counts=True)
    own_row, own_word = (key // max(1, len(words)), key % max(1, len(words)))
    key, first = np.unique(own_row * BUCKETS + bucket[own_word], return_inverse=True)
    value = np.log1p(np.bincount(first, times, minlength=len(key)))
    at = key // BUCKETS
    value /= np.sqrt(np.maximum(np.bincount(at, value * value, minlength=n), 1e-12))[at]

    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if len(words) else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    length = np.diff(offsets)

    def summed(of_word: np.ndarray) -> np.ndarray:
        return np.bincount(row, of_word[codes], minlength=n) if len(codes) else np.zeros(n)
    some, size = np.maximum(counts, 1), np.maximum(summed(length), 1)
    share = [summed(np.add.reduceat(kind[data], offsets[:-1]) if len(data) else length) / size for kind in CLASSES]
    distinct, most = np.bincount(own_row, minlength=n), np.zeros(n)
    np.maximum.at(most, own_row, times)
    lines = pc.count_substring(pc.fill_null(texts, ""), "\n").to_numpy(zero_copy_only=False)
    statistics = np.stack([np.log1p(counts), size / some, *share, distinct / some, most / some, lines / some], axis=1)
    return Features(at, key % BUCKETS, value, np.where(counts[:, None] > 0, statistics, 0))


@dataclass
class Machine:
    """Weights and factors of all features, and the edges of the statistics' bins."""

    edges: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def rows(self, f: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All features as (row, index, value), by row."""
        n, m = f.statistics.shape
        bins = np.stack([np.searchsorted(e, f.statistics[:, i], "right") for i, e in enumerate(self.edges)], axis=1)
        index = BUCKETS + np.arange(m) * (BINS + 1) + bins
        row = np.concatenate((f.row, np.repeat(np.arange(n), m)))
        order = np.argsort(row, kind="stable")
        index, value = np.concatenate((f.bucket, index.ravel())), np.concatenate((f.value, np.full(n * m, m ** -0.5)))
        return row[order], index[order], value[order]

    def score(self, f: Features) -> np.ndarray:
        row, index, value = self.rows(f)
        n = len(f.statistics)
        out = self.bias + np.bincount(row, self.weights[index] * value, minlength=n)
        for factor in self.factors.T:
            x = factor[index] * value
            out += 0.5 * (np.bincount(row, x, minlength=n) ** 2 - np.bincount(row, x * x, minlength=n))
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def train(f: Features, labels: np.ndarray, seed: int = 11) -> Machine:
    """Logistic loss, batches of documents, step sizes that shrink for each feature as it is seen."""
    n, m = len(labels), len(STATISTICS)
    quantiles = np.linspace(0, 1, BINS + 1)[1:]
    edges = np.stack([np.quantile(f.statistics[:, i], quantiles) if n else np.zeros(BINS) for i in range(m)])
    rng = np.random.default_rng(seed)
    size = BUCKETS + m * (BINS + 1)
    machine = Machine(edges, 0.0, np.zeros(size), rng.normal(0, 0.02, (size, RANK)))
    if not n:
        return machine
    rate = (labels.sum() + 1) / (n + 2)
    machine.bias = float(np.log(rate / (1 - rate)))
    row, index, value = machine.rows(f)
    begin = np.searchsorted(row, np.arange(n + 1))
    seen_w, seen_v = np.full(size, 1e-6), np.full((size, RANK), 1e-6)
    for _ in range(-(-STEPS * BATCH // n)):
        order = rng.permutation(n)
        for i in range(0, n, BATCH):
            some = order[i:i + BATCH]
            counts = begin[some + 1] - begin[some]
            at = np.repeat(begin[some] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            idx, x, own = index[at], value[at][:, None], np.repeat(np.arange(len(some)), counts)
            vx = machine.factors[idx] * x
            ends = np.cumsum(counts) - counts
            sums = np.add.reduceat(vx, ends, axis=0)
            out = machine.bias + np.add.reduceat(machine.weights[idx] * x[:, 0], ends) + 0.5 * (
                sums ** 2 - np.add.reduceat(vx * vx, ends, axis=0)).sum(1)
            wrong = 1 / (1 + np.exp(-np.clip(out, -30, 30))) - labels[some]
            by_feature = np.argsort(idx, kind="stable")
            used, first = np.unique(idx[by_feature], return_index=True)
            step = np.column_stack((wrong[own] * x[:, 0], wrong[own, None] * x * (sums[own] - vx)))
            step = np.add.reduceat(step[by_feature], first, axis=0) / len(some)
            step[:, 0] += DECAY * machine.weights[used]
            step[:, 1:] += DECAY * machine.factors[used]
            seen_w[used] += step[:, 0] ** 2
            seen_v[used] += step[:, 1:] ** 2
            machine.weights[used] -= RATE * step[:, 0] / np.sqrt(seen_w[used])
            machine.factors[used] -= RATE / 4 * step[:, 1:] / np.sqrt(seen_v[used])
            machine.bias -= RATE * wrong.mean()
    return machine


def held_out(id_col: str) -> Column:
    """Whether a row is held out: crc32 of its id as text leaves no rest by ``FOLDS``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


SAMPLED = "id long, label int, row array<int>, value array<float>, statistics array<double>"


def _sampled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        f = features(part.column("text"))
        ends = np.searchsorted(f.row, np.arange(part.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            part.column("id"), part.column("label"), pa.ListArray.from_arrays(pa.array(ends), pa.array(f.bucket, pa.int32())),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(f.value, pa.float32())),
            pa.array(f.statistics.tolist(), pa.list_(pa.float64()))], ["id", "label", "row", "value", "statistics"])


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        most: int = SAMPLE_ROWS) -> Machine:
    """Fits on at most ``most`` labelled rows that aren't held out: those of the smallest hash of their id.

    The bound is for fitting alone; scores cover all rows. Rows without id or
    label take no part; without any labelled row every score is one half.
    """
    wanted = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
              .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).distinct()
              .orderBy(F.xxhash64("id"), "id", "label").limit(most))
    texts = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # Of rows that share a sampled id the one whose text has the smallest hash stands for it.
    chosen = texts.join(F.broadcast(wanted), "id").groupBy("id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("mark"), "text")).alias("first"))
    rows = chosen.select("id", "label", "first.text").mapInArrow(_sampled, SAMPLED).toArrow()
    rows = rows.take(pc.sort_indices(rows, [("id", "ascending"), ("label", "ascending")])).combine_chunks()
    counts = pc.list_value_length(rows["row"]).to_numpy().astype(np.int64)
    flat = lambda name: rows[name].combine_chunks().flatten().to_numpy()
    made = Features(np.repeat(np.arange(len(rows)), counts), flat("row").astype(np.int64), flat("value").astype(float),
                    flat("statistics").reshape(-1, len(STATISTICS)))
    return train(made, (rows["label"].to_numpy() > 0).astype(float))


def _scored(batches: Iterable[pa.RecordBatch], machine) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "scored_text"):
        score = machine.value.score(features(part.column("scored_text")))
        yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(score)], [*part.schema.names[:-1], "score"])


def _score(documents: DataFrame, machine: Machine, keep: list[str], text_col: str) -> tuple[DataFrame, list[Column]]:
    """(rows with ``score`` and the kept columns under other names, those columns under their own)."""
    names = [f"kept_column_{i}" for i in range(len(keep))]
    rows = documents.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text_col).alias("scored_text"))
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    shared = documents.sparkSession.sparkContext.broadcast(machine)
    scored = rows.mapInArrow(lambda b: _scored(b, shared), f"{kinds}score double")
    return scored, [F.col(n).alias(c) for c, n in zip(keep, names)]


def score(documents: DataFrame, machine: Machine, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and ``score`` (0 to 1) of every row; empty and null texts have a score too.

    Nothing but the text is read for the score. Rows may repeat.
    """
    scored, kept = _score(documents, machine, keep, text_col)
    return scored.select(*kept, "score")


def judge(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, held_out, score, predicted) for every row; predicted is 1 from a score of ``THRESHOLD`` on."""
    scored = score(documents, fit(documents, labels, id_col, text_col), [id_col], text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with a score of at least ``THRESHOLD``, with all their columns."""
    scored, kept = _score(documents, fit(documents, labels, id_col, text_col), documents.columns, text_col)
    return scored.filter(F.col("score") >= THRESHOLD).select(*kept)
