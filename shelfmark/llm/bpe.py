"""BPE encoding through a minimal acyclic transducer of frequent words, and decoding.

Texts are cut at ASCII white space. The frequent pieces are counted over the
whole corpus and compiled into a minimal acyclic automaton: words share
prefixes and suffixes, and the numbers of words passed on the way to a word add
up to its index, under which its ids stand. The file is sent to every executor
once and memory-mapped there, and looked up for many words at a time. All other
words are merged exactly, so the lexicon's size changes speed, never results.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import tempfile
import unicodedata
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.common import slices, split_words
from shelfmark.operators.settle import settle

#: Words compiled into the lexicon at most, and their bytes. An automaton has at most a state for each byte
#: and one more, so the bytes bound what the driver holds, the file and the state numbers (below 2**24).
LEXICON_WORDS = 1 << 17
LEXICON_BYTES = 1 << 21
#: Longer words, such as whole texts without spaces, are neither counted nor remembered.
WORD_BYTES = 64
#: Pieces of unseen words that a Python worker remembers.
REMEMBERED = 300_000
#: Words with more symbols are merged with a heap.
SHORT = 200
NONE = 1 << 40


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else one from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


class WordBpe:
    """BPE over lower-cased words with an end-of-word mark, from a tokenizer file's JSON text."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, byte_level = spec["pre_tokenizer"]["pretokenizers"]
        if (kinds != ["NFC", "Replace", "Lowercase"] or not split["invert"] or split["behavior"] != "Removed"
                or byte_level["use_regex"] or byte_level["add_prefix_space"] or spec["decoder"] or spec["post_processor"]):
            raise ValueError("not a tokenizer of lower-cased words")
        vocabulary = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocabulary.values(), *self.specials.values()]) + 1
        self.tokens = [""] * self.size
        for token, i in [*vocabulary.items(), *self.specials.items()]:
            self.tokens[i] = token
        end = model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = [vocabulary[c] for c in letters]
        self.last = [vocabulary[c + end] for c in letters]
        self.ranks, self.merged = {}, []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault(vocabulary[a] * self.size + vocabulary[b], rank)
            self.merged.append(vocabulary[a + b])
        # \s of the file means Unicode's White_Space, which Python's own \s goes beyond.
        pattern = split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.pieces = regex.compile("\n|" + pattern)
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        self.known: dict[str, list[int]] = {}

    def merge(self, ids: list[int]) -> list[int]:
        """Applies the merges: lowest rank first, leftmost first."""
        if len(ids) > SHORT:
            return self._merge_long(ids)
        rank, size, merged = self.ranks.get, self.size, self.merged
        ranks = [rank(a * size + b, NONE) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == NONE:
                break
            i = ranks.index(best)
            ids[i] = merged[best]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(ids[i - 1] * size + ids[i], NONE)
            if i < len(ranks):
                ranks[i] = rank(ids[i] * size + ids[i + 1], NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same in n log n steps."""
        n, rank, size = len(ids), self.ranks.get, self.size
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        queue = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := rank(a * size + b, NONE)) != NONE]
        heapq.heapify(queue)
        while queue:
            best, i, a, b = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.merged[best], -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else -1
                if right >= 0 and (r := rank(ids[left] * size + ids[right], NONE)) != NONE:
                    heapq.heappush(queue, (r, left, ids[left], ids[right]))
        return [i for i in ids if i >= 0]

    def piece(self, text: str) -> list[int]:
        found = self.known.get(text)
        if found is None:
            raw = text.encode()
            found = self.merge([*map(self.inner.__getitem__, raw[:-1]), self.last[raw[-1]]])
            if len(raw) <= WORD_BYTES:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[text] = found
        return found

    @staticmethod
    def normal(text: str) -> str:
        """NFC, then each letter in lower case on its own: a final sigma is a sigma like any."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, all ids); words hold no line feed."""
        counts, ids = np.zeros(len(words), np.int64), []
        marked_at = {i for i, w in enumerate(words) if self.special.search(w)} if self.special.search("\n".join(words)) else set()
        plain = ["" if i in marked_at else w for i, w in enumerate(words)] if marked_at else words
        at, begun = 0, 0
        for piece in self.pieces.findall(self.normal("\n".join(plain)) + "\n" if plain else ""):
            if piece != "\n":
                ids += self.piece(piece)
                continue
            if at in marked_at:
                for part in self.special.split(words[at]):
                    if part in self.specials:
                        ids.append(self.specials[part])
                    else:
                        for own in self.pieces.findall(self.normal(part)):
                            ids += self.piece(own)
            counts[at] = len(ids) - begun
            at, begun = at + 1, len(ids)
        return counts, np.array(ids, np.uint32)


class Lexicon:
    """A minimal acyclic automaton in flat arrays; ``find`` gives each word's index or -1."""

    MAGIC = b"LEX1"

    def __init__(self, raw: np.ndarray):
        head = raw[:64].view(np.int64)
        if raw[:4].tobytes() != self.MAGIC:
            raise ValueError("not a lexicon file")
        self.slots, states, words, ids, self.longest = head[1:6].tolist()
        at = 64

        def take(kind, n):
            nonlocal at
            out = raw[at:at + n * np.dtype(kind).itemsize].view(kind)
            at += -(-n * np.dtype(kind).itemsize // 8) * 8
            return out
        self.keys, self.targets, self.skips = (take(np.uint32, self.slots) for _ in range(3))
        self.final = take(np.uint8, states)
        self.starts, self.ids = take(np.uint32, words + 1), take(np.uint32, ids)

    @staticmethod
    def _slot(keys: np.ndarray, slots: int) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - (slots.bit_length() - 1))).astype(np.int64)

    @classmethod
    def build(cls, words: list[bytes], counts: np.ndarray, ids: np.ndarray) -> bytes:
        """Compiles distinct words, given in byte order with the number of their ids, into a file's bytes."""
        registered: dict[tuple, int] = {}
        final, below = [0], [0]  # state 0 is no state
        edges: list[tuple[int, int, int]] = []
        path: list[tuple[bool, list]] = [(False, [])]  # the states of the last word that may still get edges

        def freeze(ends: bool, out: list) -> int:
            """The state with these edges, one for all that are alike."""
            state = registered.get(key := (ends, *out))
            if state is None:
                state = registered[key] = len(final)
                total = int(ends)
                for byte, target in out:
                    edges.append((state << 8 | byte, target, total))
                    total += below[target]
                final.append(int(ends))
                below.append(total)
            return state

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                ends, out = path.pop()
                path[-1][1].append((last[len(path) - 1], freeze(ends, out)))

        last = b""
        for word in words:
            common = len(os.path.commonprefix([last, word]))
            close(common)
            path += [(False, []) for _ in word[common:]]
            path[-1] = (True, path[-1][1])
            last = word
        close(0)
        root = freeze(*path[0])
        slots = 1 << max(4, (2 * len(edges)).bit_length())
        table = np.array(edges, np.uint32).reshape(-1, 3)
        keys, targets, skips = (np.zeros(slots, np.uint32) for _ in range(3))
        left, at = np.arange(len(edges)), cls._slot(table[:, 0], slots)
        while len(left):  # each round one edge takes each free slot; the others try the next one
            free = keys[at[left]] == 0
            _, first = np.unique(at[left[free]], return_index=True)
            put = left[free][first]
            keys[at[put]], targets[at[put]], skips[at[put]] = table[put].T
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = (at[left] + 1) % slots
        head = np.zeros(8, np.int64)
        head[0] = int.from_bytes(cls.MAGIC, "little")
        head[1:7] = slots, len(final), len(words), len(ids), max(map(len, words), default=0), root
        starts = np.concatenate(([0], np.cumsum(counts)))
        parts = [head, keys, targets, skips, np.array(final, np.uint8), starts.astype(np.uint32), ids.astype(np.uint32)]
        return b"".join(p.tobytes() + bytes(-p.nbytes % 8) for p in parts)

    @property
    def root(self) -> int:
        return len(self.final) - 1  # frozen last

    def find(self, words: pa.Array) -> np.ndarray:
        """Walks all words at once, a byte at a time."""
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
        data = np.frombuffer(words.buffers()[2], np.uint8) if len(words) and words.buffers()[2] else np.zeros(1, np.uint8)
        lengths = np.diff(offsets)
        out = np.full(len(words), -1, np.int64)
        alive = np.flatnonzero((lengths > 0) & (lengths <= self.longest))
        state, index = np.full(len(alive), self.root, np.uint32), np.zeros(len(alive), np.int64)
        for step in range(self.longest + 1):
            done = lengths[alive] == step
            if done.any():
                ends = done & (self.final[state] == 1)
                out[alive[ends]] = index[ends]
                alive, state, index = alive[~done], state[~done], index[~done]
            if not len(alive):
                break
            key = state << np.uint32(8) | data[offsets[alive] + step]
            slot = self._slot(key, self.slots)
            found = self.keys[slot]
            while (miss := (found != key) & (found != 0)).any():
                slot[miss] = (slot[miss] + 1) % self.slots
                found = np.where(miss, self.keys[slot], found)
            ok = found == key
            alive, slot = alive[ok], slot[ok]
            state, index = self.targets[slot], index[ok] + self.skips[slot]
        return out


_OPEN: dict[str, object] = {}


def _tokenizer(definition: str) -> WordBpe:
    """The worker's tokenizer, with what it remembers."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _OPEN:
        _OPEN[key] = WordBpe(definition)
    return _OPEN[key]


def _lexicon(name: str) -> Lexicon:
    if name not in _OPEN:
        _OPEN[name] = Lexicon(np.memmap(SparkFiles.get(name), np.uint8, "r"))
    return _OPEN[name]


def encode_texts(texts: pa.Array, bpe: WordBpe, lexicon: Lexicon) -> pa.LargeListArray:
    """The ids of each text; a null text has none."""
    starts, codes, words = split_words(texts)
    index = lexicon.find(words)
    unseen = np.flatnonzero(index < 0)
    counts, merged = bpe.words(words.take(pa.array(unseen)).to_pylist())
    length, begin = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    seen = np.flatnonzero(index >= 0)
    begin[seen] = lexicon.starts[index[seen]]
    length[seen] = lexicon.starts[index[seen] + 1] - lexicon.starts[index[seen]]
    length[unseen] = counts
    begin[unseen] = len(lexicon.ids) + np.cumsum(counts) - counts
    pool = np.concatenate((lexicon.ids, merged))
    each = length[codes]
    ends = np.concatenate(([0], np.cumsum(each)))
    ids = pool[np.repeat(begin[codes] - ends[:-1], each) + np.arange(ends[-1])]
    return pa.LargeListArray.from_arrays(pa.array(ends[starts]), pa.array(ids, pa.uint32()))


def _joined(ids: pa.LargeListArray, strings: pa.Array) -> pa.Array:
    return pc.binary_join(pa.LargeListArray.from_arrays(ids.offsets, strings.take(ids.values)), pa.scalar(" ", pa.large_string()))


def decode_ids(ids: pa.LargeListArray, bpe: WordBpe) -> pa.Array:
    """The texts of lists of ids: their tokens joined by spaces, since the file names no decoder."""
    return _joined(ids, pa.array(bpe.tokens, pa.large_string()))


def _encoded(batches: Iterable[pa.RecordBatch], definition, name: str, digests: bool) -> Iterator[pa.RecordBatch]:
    bpe, lexicon = _tokenizer(definition.value), _lexicon(name)
    numbers = pa.array([str(i) for i in range(bpe.size)], pa.large_string())
    for part in slices(batches):
        ids = encode_texts(part.column(part.num_columns - 1), bpe, lexicon)
        rest = part.columns[:-1]
        names = part.schema.names[:-1]
        if digests:
            hashed = lambda strings: pa.array([hashlib.sha256(s.as_buffer()).hexdigest() for s in strings])
            out = [pc.list_value_length(ids).cast(pa.int64()), hashed(_joined(ids, numbers)), hashed(decode_ids(ids, bpe))]
            yield pa.RecordBatch.from_arrays([*rest, *out], [*names, "n_tokens", "ids_sha256", "decoded_sha256"])
        else:
            yield pa.RecordBatch.from_arrays(
                [*rest, pc.list_value_length(ids).cast(pa.int64()), ids.cast(pa.list_(pa.int32()))], [*names, "n_tokens", "ids"])


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        _, codes, words = split_words(part.column(0))
        counted = pa.RecordBatch.from_arrays([words, pa.array(np.bincount(codes, minlength=len(words)))], ["word", "n"])
        yield counted.filter(pc.less_equal(pc.binary_length(words), WORD_BYTES))


def frequent_words(documents: DataFrame, text_col: str, most: int) -> list[str]:
    """The most frequent words over all texts: as many whole classes of equal counts as ``most`` leaves room for.

    Words of over ``WORD_BYTES`` are left out. Words are counted in the tasks
    before they move; the driver gets a histogram of counts, then at most
    ``most`` words of at most ``LEXICON_BYTES`` together.
    """
    counts = (documents.select(text_col).mapInArrow(_counted, "word string, n long")
              .groupBy("word").agg(F.sum("n").alias("n")).filter("n > 1"))
    counts = settle(counts, "word-counts")
    sizes = (counts.groupBy(F.least("n", F.lit(1 << 20)).alias("n"))
             .agg(F.count("*").alias("words"), F.sum(F.octet_length("word")).alias("bytes")).orderBy(F.desc("n")).collect())
    room, left, least = most, LEXICON_BYTES, None
    for n, words, size in sizes:
        room, left = room - words, left - size
        if room < 0 or left < 0:
            break
        least = n
    return [] if least is None else [r.word for r in counts.filter(F.col("n") >= least).select("word").collect()]


def send_lexicon(documents: DataFrame, definition: str, text_col: str = "text", most: int = LEXICON_WORDS) -> str:
    """Compiles the frequent words and sends the file to the executors; returns its name there."""
    words = sorted(w.encode() for w in frequent_words(documents, text_col, most))
    counts, ids = WordBpe(definition).words([w.decode() for w in words])
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    # The driver's own copy, served to executors by Spark; nothing reads it by this path.
    path = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
    with open(path, "wb") as f:
        f.write(Lexicon.build(words, counts, ids))
    documents.sparkSession.sparkContext.addFile(path)
    return name


def _run(documents: DataFrame, path: str, keep: list[str], text_col: str, most: int, digests: bool, types: str) -> DataFrame:
    with open(path, encoding="utf-8") as f:
        definition = f.read()
    name = send_lexicon(documents, definition, text_col, most)
    shared = documents.sparkSession.sparkContext.broadcast(definition)
    names = [f"kept_column_{i}" for i in range(len(keep))]
    rows = documents.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text_col).alias("text"))
    kept = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    made = rows.mapInArrow(lambda b: _encoded(b, shared, name, digests), f"{kept}{types}")
    return made.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], *made.columns[len(names):])


def encode(documents: DataFrame, path: str, keep: list[str] = ["doc_id"], text_col: str = "text",  # noqa: B006
           most: int = LEXICON_WORDS) -> DataFrame:
    """The columns ``keep``, ``n_tokens`` and ``ids`` for every row, as the tokenizer file at ``path`` encodes its text.

    Marks of the tokenizer inside a text become their ids. Null, empty and
    blank texts have no ids; rows may repeat, and ids (``keep``) may be null.
    An empty table gives an empty result. Columns not kept aren't read.
    """
    return _run(documents, path, keep, text_col, most, False, "n_tokens long, ids array<int>")


def _decoded(batches: Iterable[pa.RecordBatch], definition) -> Iterator[pa.RecordBatch]:
    bpe = _tokenizer(definition.value)
    for batch in batches:
        ids = pc.fill_null(batch.column(batch.num_columns - 1), []).cast(pa.large_list(pa.uint32()))
        texts = decode_ids(pa.LargeListArray.from_arrays(ids.offsets, ids.values), bpe)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts.cast(pa.string())], [*batch.schema.names[:-1], "decoded"])


def decode(encoded: DataFrame, path: str, keep: list[str] = ["doc_id"], ids_col: str = "ids") -> DataFrame:  # noqa: B006
    """The columns ``keep`` and ``decoded``: the text of each list of ids; a null list is read as empty."""
    with open(path, encoding="utf-8") as f:
        shared = encoded.sparkSession.sparkContext.broadcast(f.read())
    names = [f"kept_column_{i}" for i in range(len(keep))]
    rows = encoded.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(ids_col).alias("ids"))
    kept = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    made = rows.mapInArrow(lambda b: _decoded(b, shared), f"{kept}decoded string")
    return made.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], "decoded")


def round_trip(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
               most: int = LEXICON_WORDS) -> DataFrame:
    """(``id_col``, n_tokens, ids_sha256, decoded_sha256): each text encoded, and its ids decoded, in one pass.

    The digests are of the ids in decimal, joined by one space, and of the
    decoded text. Cases as for ``encode``.
    """
    return _run(documents, path, [id_col], text_col, most, True, "n_tokens long, ids_sha256 string, decoded_sha256 string")
