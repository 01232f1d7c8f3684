"""Token ids in length-delimited binary records, with an offset index for reads in any order.

A file is a row of records: the payload's length (8 bytes), the masked checksum
of those 8 bytes (4), the payload, its masked checksum (4), all little-endian.
A payload is the id of the document (8), the number of ids before it in the
file (8), its number of ids (8), their width (1: 2 bytes where all tokens are
below 65,536, else 4), and the ids, compressed. Checksums are CRC-32, rotated
and shifted by a constant, so that a checksum of data that holds checksums
stays sound.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.common import NULL_ID, id_or_last, slices
from shelfmark.llm.ordering import by_id_ranges, id_bounds
from shelfmark.operators.settle import settle, shared_folder

#: Fixed value: what masked checksums are shifted by.
MASK = 0xA282EAD8
HEAD = struct.Struct("<QI")
TAIL = struct.Struct("<I")
OWN = struct.Struct("<qQQB")
FRAME = HEAD.size + TAIL.size
#: Bytes of pieces and ids a Python worker remembers in each of two generations (with what an entry takes beside them),
#: letters of the longest piece it remembers, and pieces encoded as one text.
REMEMBERED, ENTRY, LONGEST = 128 << 20, 220, 64
TOGETHER = 200
#: Bytes read at once where wanted records are neighbours.
READ = 8 << 20
#: Fixed value: Unicode's White_Space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Latin letters, and ASCII's marks but the apostrophe, which opens tokens such as 's.
LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha())
STOPS = re.escape("".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'"))
#: A single white space before other characters opens a new token of byte-level BPE, and so does a mark after letters,
#: so these pieces are independent: words, the stops after them, other runs between white space, and white space.
PIECES = re.compile(f"[{SPACE}]?[{LETTERS}]+(?=[{STOPS}]*(?:[{SPACE}]|\\Z))|(?<=[{LETTERS}])[{STOPS}]+(?=[{SPACE}]|\\Z)"
                    f"|[{SPACE}]?[^{SPACE}]+|[{SPACE}]+(?=[{SPACE}][^{SPACE}])|[{SPACE}]+")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + TAIL.pack(masked(length)) + payload + TAIL.pack(masked(payload))


def unframe(data: bytes | memoryview) -> memoryview:
    """The payload of a framed record; raises ValueError if it isn't whole."""
    view = memoryview(data)
    length, check = HEAD.unpack_from(view)
    if check != masked(view[:8]) or len(view) != length + FRAME:
        raise ValueError("a record's length is damaged")
    payload = view[HEAD.size:HEAD.size + length]
    if TAIL.unpack_from(view, HEAD.size + length)[0] != masked(payload):
        raise ValueError("a record's payload is damaged")
    return payload


class Encoder:
    """The tokenizers library, asked once for each distinct piece of text.

    Ids are bytes of little-endian unsigned integers of the record's width.
    """

    def __init__(self, definition: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else "<u4")
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.end = np.array([end_id], self.kind).tobytes()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def _ask(self, texts: list[str]) -> Iterator[bytes]:
        """The library's ids of texts without special tokens; many at once, with a special token between them."""
        if not self.specials:
            yield from (np.array(e.ids, self.kind).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False))
            return
        width, between = self.kind.itemsize, self.library.token_to_id(self.specials[0])
        joined = [self.specials[0].join(texts[i:i + TOGETHER]) for i in range(0, len(texts), TOGETHER)]
        for encoded in self.library.encode_batch_fast(joined, add_special_tokens=False):
            ids = np.array(encoded.ids, self.kind)
            cuts, raw = (np.flatnonzero(ids == between) * width).tolist(), ids.tobytes()
            yield from (raw[a:b] for a, b in zip([0, *(c + width for c in cuts)], [*cuts, len(raw)]))

    def _pieces(self, text: str) -> list[str]:
        # White space before a special token is a case of its own; the library gets such a text whole.
        if any(s in text for s in self.specials):
            return [text]
        return PIECES.findall(text)

    def _learn(self, pieces: set[str]) -> None:
        """Ids of pieces that aren't known: from the older generation, else from the library."""
        again = {p: self.older[p] for p in pieces if p in self.older}
        asked = [p for p in pieces if p not in again]
        plain = [p for p in asked if not any(s in p for s in self.specials)]
        again.update(zip(plain, self._ask(plain)))
        for whole in set(asked) - set(plain):
            again[whole] = np.array(self.library.encode(whole, add_special_tokens=False).ids, self.kind).tobytes()
        self.known.update(again)
        self.held += sum(len(p) + len(ids) + ENTRY for p, ids in again.items())

    def _forget(self, pieces: set[str]) -> None:
        """Drops long pieces, and the older generation once the newer one is full."""
        for p in pieces:
            if len(p) > LONGEST:
                self.held -= len(p) + len(self.known.pop(p)) + ENTRY
        if self.held > REMEMBERED:
            self.older, self.known, self.held = self.known, {}, 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, with the end id. Known pieces are looked up once, only the others again."""
        pieces = [self._pieces(t) for t in texts]
        found = [[*map(self.known.get, own)] for own in pieces]
        late = [[i for i, ids in enumerate(own) if ids is None] for own in found]
        fresh = {own[i] for own, places in zip(pieces, late) for i in places}
        if fresh:
            self._learn(fresh)
            for own, ids, places in zip(pieces, found, late):
                for i in places:
                    ids[i] = self.known[own[i]]
        out = [b"".join([*ids, self.end]) for ids in found]
        self._forget(fresh)
        return out


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(definition: str, end_id: int) -> Encoder:
    key = (zlib.crc32(definition.encode()), len(definition), end_id)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(definition, end_id)
    return _ENCODERS[key]


INDEX = "part int, row long, id long, first long, n_tokens long, file string, offset long, length long"
INDEX_NAMES = [c.split()[0] for c in INDEX.split(", ")]
INDEX_TYPES = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[c.split()[1]] for c in INDEX.split(", ")]


def _write(batches: Iterable[pa.RecordBatch], definition, end_id: int, folder: str) -> Iterator[pa.RecordBatch]:
    """Writes a range's file; yields its index. A run task writes a file of its own name, and only the index counts."""
    encoder, out, row, first, offset = _encoder(definition.value, end_id), None, 0, 0, 0
    for batch in slices(batches):
        if out is None:
            part = batch.column("part")[0].as_py()
            file = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.rec"
            store, path = pyarrow.fs.FileSystem.from_uri(file)
            out = store.open_output_stream(path)
        rows = []
        for doc_id, ids in zip(batch.column("id").to_pylist(), encoder.encode([t or "" for t in batch.column("text").to_pylist()])):
            n = len(ids) // encoder.kind.itemsize
            record = frame(OWN.pack(doc_id, first, n, encoder.kind.itemsize) + pa.compress(ids, codec="zstd", asbytes=True))
            out.write(record)
            rows.append((part, row, doc_id, first, n, file, offset, len(record)))
            row, first, offset = row + 1, first + n, offset + len(record)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), INDEX_TYPES)], INDEX_NAMES)
    if out is not None:
        out.close()


def write_records(documents: DataFrame, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes every row's ids in ascending id order; returns the stored offset index.

    ``path`` is the tokenizer file; ``end_id`` ends each document. Files lie
    in the folder all executors share, one for each range of ids, and are
    named in the index, one row for each record: part, row, id, first (ids
    before it in its file), n_tokens, file, offset, length. Files of failed or
    repeated tasks are in no index. A null text is empty and has the end id
    alone; a null id stands after all others; rows of equal ids stand in order
    of their texts; an empty table gives an empty index.
    """
    spark = documents.sparkSession
    with open(path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    folder = f"{shared_folder(spark)}/records-{uuid.uuid4().hex}"
    store, inside = pyarrow.fs.FileSystem.from_uri(folder)
    store.create_dir(inside)
    rows = documents.select(id_or_last(id_col).alias("id"), F.col(text_col).alias("text"))
    ordered = by_id_ranges(rows, id_bounds(rows, "id")).sortWithinPartitions("id", "text")
    return settle(ordered.mapInArrow(lambda b: _write(b, shared, end_id, folder), INDEX), "record-index")


def _ids(payload: memoryview) -> tuple[int, int, np.ndarray]:
    """(document, first, ids) of a payload."""
    doc_id, first, n, width = OWN.unpack_from(payload)
    raw = pa.decompress(payload[OWN.size:], n * width, codec="zstd", asbytes=True)
    return doc_id, first, np.frombuffer(raw, f"<u{width}").astype("<u4")


def _neighbours(rows: list[tuple]) -> Iterator[list[tuple]]:
    """Groups of index rows that one read of at most ``READ`` bytes (or one record) covers."""
    group: list[tuple] = []
    for row in rows:
        if group and (row[0] != group[0][0] or row[1] != group[-1][1] + group[-1][2] or row[1] + row[2] - group[0][1] > READ):
            yield group
            group = []
        group.append(row)
    if group:
        yield group


def _read(batches: Iterable[pa.RecordBatch], digests: bool) -> Iterator[pa.RecordBatch]:
    """Index rows (file, offset, length, part) as records, checked."""
    opened, name = None, None
    for batch in batches:
        out = []
        for group in _neighbours(list(zip(*(c.to_pylist() for c in batch.columns)))):
            file, begin = group[0][0], group[0][1]
            if file != name:
                if opened is not None:
                    opened.close()
                store, path = pyarrow.fs.FileSystem.from_uri(file)
                opened, name = store.open_input_file(path), file
            data = memoryview(opened.read_at(group[-1][1] + group[-1][2] - begin, begin))
            for _, offset, length, part in group:
                doc_id, first, ids = _ids(unframe(data[offset - begin:offset - begin + length]))
                out.append((part, doc_id, first, len(ids), zlib.crc32(ids.tobytes()) if digests else ids))
        kind = pa.int64() if digests else pa.list_(pa.int32())
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), kind]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 5, types)],
                                         ["part", "id", "first", "n_tokens", "ids"])


def read_records(index: DataFrame, digests: bool = False) -> DataFrame:
    """(part, id, first, n_tokens, ids) of the index's records, read from their files in the index's own order.

    Any subset or order of index rows can be read; neighbours are read at
    once. With ``digests`` the column ``ids`` is the unsigned CRC-32 of the ids
    as little-endian unsigned 32-bit integers. A damaged record raises.
    """
    rows = index.select("file", "offset", "length", "part")
    return rows.mapInArrow(lambda b: _read(b, digests),
                           f"part int, id long, first long, n_tokens long, ids {'long' if digests else 'array<int>'}")


def starts_of_files(index: DataFrame) -> DataFrame:
    """(part, base): the ids in all files before; one row for each file, of which there are at most as many as ranges."""
    base, rows = 0, []
    for part, n in index.groupBy("part").agg(F.sum("n_tokens")).orderBy("part").collect():
        rows.append((part, base))
        base += n
    return index.sparkSession.createDataFrame(rows, "part int, base long")


def through_files(documents: DataFrame, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, start, n_tokens, ids_crc32) of every row, as read back from the files."""
    index = write_records(documents, path, end_id, id_col, text_col)
    back = read_records(index, digests=True)
    own_id = F.when(F.col("id") != NULL_ID, F.col("id")).cast(documents.schema[id_col].dataType)
    return (back.join(F.broadcast(starts_of_files(index)), "part")
            .select(own_id.alias(id_col), (F.col("base") + F.col("first")).alias("start"), "n_tokens", F.col("ids").alias("ids_crc32")))
