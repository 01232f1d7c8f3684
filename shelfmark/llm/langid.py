"""Language of each text: a bidirectional gated recurrent network over bytes, fitted in numpy.

Two chains of gated units read the bytes of a segment, one from each end. Their
states at a byte give it a probability of each language, and a text's
probability is the mean over all its letter bytes. The network is fitted by
backpropagation through time on a bounded sample of labelled segments; after
that every byte of every text is labelled.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.common import slices
from shelfmark.llm.quality import held_out

UNKNOWN = "und"
#: States of each chain; bytes of a segment; segments that go through the network at once.
STATES, SEGMENT, TOGETHER = 12, 128, 1024
#: Labelled rows the network is fitted on at most, with one segment of each, and how long it learns.
SAMPLE_ROWS = 4_000
EPOCHS, BATCH, RATE = 5, 128, 0.02
ASCII_LETTER = re.compile("[A-Za-z]")
#: Bytes of letters: ASCII letters, and all bytes of longer UTF-8 sequences.
OF_LETTERS = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])


def has_letter(text: str | None) -> bool:
    return bool(text) and (ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


class Chain:
    """One direction: gates for each byte and from the state before. Columns of a gate matrix: update, reset, candidate."""

    def __init__(self, rng: np.random.Generator):
        self.of_byte = rng.normal(0, 0.3, (256, 3 * STATES)).astype(np.float32)
        self.of_state = rng.normal(0, 1 / np.sqrt(STATES), (STATES, 3 * STATES)).astype(np.float32)

    def run(self, codes: np.ndarray, there: np.ndarray | None, keep: list | None = None) -> np.ndarray:
        """States after each byte; ``codes`` is (time, segment). Where nothing is there the state is zero."""
        steps, n = codes.shape
        states = np.empty((steps, n, STATES), np.float32)
        h = np.zeros((n, STATES), np.float32)
        for t in range(steps):
            x, u = self.of_byte[codes[t]], h @ self.of_state
            gates = x[:, :2 * STATES] + u[:, :2 * STATES]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            z, r = gates[:, :STATES], gates[:, STATES:]
            from_state = u[:, 2 * STATES:]
            c = from_state * r
            c += x[:, 2 * STATES:]
            np.tanh(c, out=c)
            new = states[t]
            np.subtract(h, c, out=new)
            new *= z
            new += c
            if there is not None:
                new *= there[t][:, None]
            if keep is not None:
                keep.append((h, z, r, c, from_state))
            h = new
        return states

    def back(self, codes: np.ndarray, there: np.ndarray, kept: list, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of both matrices, from those of the states after each byte."""
        by_byte, by_state = np.zeros_like(self.of_byte), np.zeros_like(self.of_state)
        later = np.zeros_like(wanted[0])
        for t in range(len(codes) - 1, -1, -1):
            h, z, r, c, from_state = kept[t]
            dh = (wanted[t] + later) * there[t][:, None]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * z * (1 - z)
            dr = dc * from_state * r * (1 - r)
            of_x = np.concatenate((dz, dr, dc), axis=1)
            of_u = np.concatenate((dz, dr, dc * r), axis=1)
            np.add.at(by_byte, codes[t], of_x)
            by_state += h.T @ of_u
            later = dh * z + of_u @ self.of_state.T
        return by_byte, by_state


class Tagger:
    """Labels each byte of segments with a probability of each language."""

    def __init__(self, languages: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.behind = Chain(rng), Chain(rng)
        self.out = rng.normal(0, 0.3, (2 * STATES, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.ahead.of_byte, self.ahead.of_state, self.behind.of_byte, self.behind.of_state, self.out, self.bias]

    def label(self, codes: np.ndarray, lengths: np.ndarray, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, ...]:
        """(probabilities (time, segment, language), states of both chains) for ``codes`` (time, segment) of some lengths."""
        there = None
        if keep is not None or int(lengths.min()) < len(codes):
            there = (np.arange(len(codes))[:, None] < lengths).astype(np.float32)
        reverse = None if there is None else there[::-1]
        states = np.concatenate((self.ahead.run(codes, there, keep and keep[0]),
                                 self.behind.run(codes[::-1], reverse, keep and keep[1])[::-1]), axis=2)
        p = states @ self.out
        p += self.bias
        p -= p.max(axis=2, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=2, keepdims=True)
        return p, states

    def gradients(self, codes: np.ndarray, lengths: np.ndarray, wanted: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """(mean loss, gradients of ``weights``): every byte of a segment should get the segment's language."""
        kept: tuple[list, list] = ([], [])
        p, states = self.label(codes, lengths, kept)
        there = (np.arange(len(codes))[:, None] < lengths).astype(np.float32)
        n = max(1.0, float(there.sum()))
        at = np.arange(len(wanted))
        loss = float(-(np.log(np.maximum(p[:, at, wanted], 1e-12)) * there).sum() / n)
        wrong = p.copy()
        wrong[:, at, wanted] -= 1
        wrong *= (there / n)[:, :, None]
        flat = wrong.reshape(-1, wrong.shape[2])
        of_states = wrong @ self.out.T
        one = self.ahead.back(codes, there, kept[0], of_states[:, :, :STATES])
        two = self.behind.back(codes[::-1], there[::-1], kept[1], of_states[::-1, :, STATES:])
        return loss, [*one, *two, states.reshape(-1, 2 * STATES).T @ flat, flat.sum(axis=0)]

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean probability of each language over the letter bytes of each text; zeros for a text without any."""
        pools = np.zeros((len(texts), len(self.languages)))
        counts = np.zeros(len(texts))
        raw = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        per_text = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), per_text)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        starts = (np.cumsum(sizes) - sizes)[owner] + nth * SEGMENT
        lengths = np.minimum(SEGMENT, sizes[owner] - nth * SEGMENT)
        order = np.argsort(-lengths, kind="stable")
        for i in range(0, len(order), TOGETHER):
            some = order[i:i + TOGETHER]
            longest = int(lengths[some[0]])
            at = starts[some] + np.arange(longest)[:, None]
            inside = np.arange(longest)[:, None] < lengths[some]
            codes = np.where(inside, raw[np.minimum(at, len(raw) - 1)], 0)
            p, _ = self.label(codes, lengths[some])
            weigh = (OF_LETTERS[codes] & inside).astype(np.float32)
            np.add.at(pools, owner[some], np.einsum("tnk,tn->nk", p, weigh))
            np.add.at(counts, owner[some], weigh.sum(axis=0))
        return pools / np.maximum(counts, 1)[:, None]


def train(tagger: Tagger, segments: list[bytes], wanted: np.ndarray, seed: int = 12) -> Tagger:
    """Fits by gradients with momentum and their running squares; the rate falls to nothing."""
    rng = np.random.default_rng(seed)
    codes = np.frombuffer(b"".join(s.ljust(SEGMENT, b"\0") for s in segments), np.uint8).reshape(-1, SEGMENT).T
    lengths = np.array([len(s) for s in segments])
    mean = [np.zeros_like(w) for w in tagger.weights()]
    square = [np.zeros_like(w) for w in tagger.weights()]
    steps, step = EPOCHS * -(-len(segments) // BATCH), 0
    for _ in range(EPOCHS):
        shuffled = rng.permutation(len(segments))
        for i in range(0, len(segments), BATCH):
            some = shuffled[i:i + BATCH]
            _, found = tagger.gradients(codes[:, some], lengths[some], wanted[some])
            rate = RATE * (1 - step / steps)
            step += 1
            for w, m, s, g in zip(tagger.weights(), mean, square, found):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-6)
    return tagger


def labelled_segments(documents: DataFrame, id_col: str, text_col: str, lang_col: str, most: int) -> DataFrame:
    """(lang, segment): at most ``most`` rows that may be learnt from, about equally many of each language.

    A row's place in its language is guessed from a hash of its id and text and
    the language's number of rows, so that no language meets in one task. The
    rows of the first places are taken; a language of few rows gives them all.
    Languages beyond the ``most`` most frequent ones are not learnt. The segment
    starts anywhere in the text, by the same hash.
    """
    raw = F.col("text").cast("binary")
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
                            held_out(id_col).alias("kept_back"))
    rows = rows.filter(F.col("lang").isNotNull() & (F.length("text") > 0) & ~F.col("kept_back"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "lang").limit(most)
    rows = rows.join(F.broadcast(counts), "lang").withColumn("mark", F.xxhash64("id", "text"))
    place = F.col("count") * (F.shiftrightunsigned("mark", 32) / F.lit(2.0 ** 32))
    room = F.greatest(F.octet_length("text") - SEGMENT, F.lit(0)) + 1
    start = F.col("mark").bitwiseAND(F.lit((1 << 31) - 1)) % room
    return (rows.withColumn("place", place).filter(F.col("place") < most)
            .select("lang", "place", "mark", F.substring(raw, start.cast("int") + 1, F.lit(SEGMENT)).alias("segment"))
            .orderBy("place", "mark", "lang", "segment").limit(most).select("lang", "segment"))


def fit(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = SAMPLE_ROWS) -> Tagger:
    """A network fitted on at most ``most`` segments (the bound is for fitting alone) of rows that aren't held out.

    Rows with a null language or text are not learnt from. Without any row to
    learn from it knows no language.
    """
    rows = labelled_segments(documents, id_col, text_col, lang_col, most).toArrow().to_pydict()
    languages = sorted(set(rows["lang"]))
    tagger = Tagger(languages)
    if languages:
        train(tagger, rows["segment"], np.array([languages.index(x) for x in rows["lang"]]))
    return tagger


def _predicted(batches: Iterable[pa.RecordBatch], tagger) -> Iterator[pa.RecordBatch]:
    own = tagger.value
    for part in slices(batches, "read_text"):
        texts = [t if has_letter(t) else "" for t in part.column("read_text").to_pylist()]
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if own.languages:
            pools = own.pooled([t.encode() for t in texts])
            lang = [own.languages[k] if t else UNKNOWN for k, t in zip(pools.argmax(axis=1), texts)]
            score = np.clip(pools.max(axis=1), 0, 1)
        yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                         [*part.schema.names[:-1], "lang_pred", "score"])


def predict(documents: DataFrame, tagger: Tagger, keep: list[str | Column], text_col: str = "text") -> DataFrame:
    """The columns ``keep``, ``lang_pred`` and ``score`` of every row.

    A text that is null or has no letter is ``und`` with a score of 0. Texts
    are read whole, whatever their length. Rows may repeat; an empty table
    gives an empty result. Nothing but the text is read for the prediction.
    """
    kept = documents.select(*keep)
    names = [f"kept_column_{i}" for i in range(len(keep))]
    rows = documents.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(keep, names)],
                            F.col(text_col).alias("read_text"))
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    shared = documents.sparkSession.sparkContext.broadcast(tagger)
    found = rows.mapInArrow(lambda b: _predicted(b, shared), f"{kinds}lang_pred string, score double")
    return found.select(*[F.col(n).alias(c) for n, c in zip(names, kept.columns)], "lang_pred", "score")


def judge(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(``id_col``, held_out, lang_pred, score) of every row, learnt from the rows that aren't held out."""
    tagger = fit(documents, id_col, text_col, lang_col)
    return predict(documents, tagger, [id_col, held_out(id_col).alias("held_out")], text_col)
