"""Encoding, fingerprints and record files against the library and brute force."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm import bpe, fingerprints, records

WORD_FILE, BYTE_FILE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n\n a  b\t", "Hello, World's 123 it'S we'LL", "ÀÉ é é İstanbul ΣΊΣΥΦΟΣ ς", "a<|endoftext|>b <|startoftext|>",
       "  <|endoftext|>  x", "日本語 の テキスト", "x y z\u0085w", "\x1c\x1f a\x1cb \x00", "😀👍🏽 fin", "<|endoftext", "a" * 5000,
       "ab1!" * 3000, "́́ x", "ſ K Å ﬁ Ⅷ ²", "don't 'tis '''s", "\r\n\r\nx", "café " * 500, "퟿ \U0010ffff",
       "  trailing  ", "tab\t\ttab", "a 　 b", "İİ 'S", "नमस्ते दुनिया", "​‍ x­x"]


def documents(spark, texts):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "null id", "x", "y"), (3, texts[3], "x", "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, ID string, n_tokens string").repartition(3)


def mixed_texts(seed, n):
    rng = random.Random(seed)
    alphabet = "abcdefghij éèñçß ÀΣ漢字😀 \n\t 0123 .,!?'-"
    return ODD + ["".join(rng.choices(alphabet, k=rng.randint(0, 120))) for _ in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("most", [0, 40, bpe.LEXICON_WORDS])
def test_round_trip_matches_the_library(spark, most):
    texts = mixed_texts(1, 300)
    library = Tokenizer.from_file(WORD_FILE)

    def want(doc_id, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        return doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))
    df = documents(spark, texts)
    got = sorted(map(tuple, bpe.round_trip(df, WORD_FILE, most=most).collect()), key=str)
    assert got == sorted((want(r.doc_id, r.text) for r in df.collect()), key=str)


def test_long_unspaced_texts_stay_out_of_the_lexicon(spark, monkeypatch):
    rng = random.Random(4)
    long = ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(20_000)), "".join(rng.choices("abcXYZ019+/", k=60_000))]
    df = documents(spark, [*long, *long, "some words some words", "", "b" * 64 + " " + "b" * 64 + " " + "c" * 65 + " " + "c" * 65])
    words = bpe.frequent_words(df, "text", bpe.LEXICON_WORDS)
    assert {"some", "words", "b" * 64} <= set(words) and max(len(w.encode()) for w in words) <= 64
    library = Tokenizer.from_file(WORD_FILE)
    for row in bpe.encode(df, WORD_FILE).collect():
        if row.doc_id in (0, 1, 2, 3):
            assert row.ids == library.encode(long[row.doc_id % 2], add_special_tokens=False).ids
    monkeypatch.setattr(bpe, "LEXICON_BYTES", 12)
    assert sum(len(w) for w in bpe.frequent_words(df, "text", bpe.LEXICON_WORDS)) <= 12


def test_encode_and_decode(spark):
    df = documents(spark, ODD)
    library = Tokenizer.from_file(WORD_FILE)
    encoded = bpe.encode(df, WORD_FILE, keep=["doc_id", "ID"])
    assert encoded.columns == ["doc_id", "ID", "n_tokens", "ids"]
    for row in encoded.collect():
        text = "null id" if row.doc_id is None else ODD[row.doc_id]
        assert row.ids == library.encode(text or "", add_special_tokens=False).ids
    back = bpe.decode(encoded, WORD_FILE)
    assert {(r.doc_id, r.decoded) for r in back.collect()} == {
        (r.doc_id, library.decode(r.ids, skip_special_tokens=False)) for r in encoded.collect()}
    assert bpe.round_trip(df.limit(0), WORD_FILE).count() == 0


def test_long_words_merge_alike(monkeypatch):
    with open(WORD_FILE) as f:
        tokenizer = bpe.WordBpe(f.read())
    rng = random.Random(4)
    for _ in range(200):
        raw = "".join(rng.choices("abenorst", k=rng.randint(2, 60))).encode()
        ids = [*map(tokenizer.inner.__getitem__, raw[:-1]), tokenizer.last[raw[-1]]]
        assert tokenizer._merge_long(list(ids)) == tokenizer.merge(list(ids))


def test_lexicon_is_a_minimal_automaton():
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(1, 7))).encode() for _ in range(500)})
    counts = np.array([len(w) % 3 for w in words])
    ids = np.arange(counts.sum())
    lexicon = bpe.Lexicon(np.frombuffer(bpe.Lexicon.build(words, counts, ids), np.uint8))
    asked = words + [b"", b"abcabcabcabc", b"zz", b"ab\xff"]
    found = lexicon.find(pa.array([w.decode("latin1") for w in asked]))
    want = {w: i for i, w in enumerate(words)}
    assert found.tolist() == [want.get(w, -1) for w in asked[:-1]] + [-1]
    assert lexicon.starts.tolist() == np.concatenate(([0], np.cumsum(counts))).tolist()
    suffixes = {tuple(sorted(w[i:] for w in words if w[:i] == p)) for p in {w[:j] for w in words for j in range(len(w) + 1)}
                for i in [len(p)]}
    assert len(lexicon.final) - 1 == len(suffixes)  # as many states as different right languages
    empty = bpe.Lexicon(np.frombuffer(bpe.Lexicon.build([], np.zeros(0, int), np.zeros(0, int)), np.uint8))
    assert empty.find(pa.array(["a"])).tolist() == [-1]


def brute_mark(text):
    words = [w for w in (text or "").encode().split()]
    n = len(words)
    terms = [words[i:i + 3] for i in range(n - 2)] or ([words] if words else [])
    base, votes = 0x9E3779B97F4A7C15, [0] * 64
    for term in terms:
        h = sum(int.from_bytes(xxhash.xxh3_128_digest(w)[:8], "little") * pow(base, i, 1 << 64) for i, w in enumerate(term)) % (1 << 64)
        h ^= h >> 32
        h = h * 0xD6E8FEB86659FD93 % (1 << 64)
        for b in range(64):
            votes[b] += 1 if h >> b & 1 else -1
    return sum(1 << b for b in range(64) if votes[b] > 0)


def near_texts(seed):
    rng = random.Random(seed)
    base = [" ".join(rng.choices("abcdefghijklmnopqrst", k=300)) for _ in range(4)]
    return [" ".join("Z" if rng.random() < 0.004 else w for w in rng.choice(base).split()) for _ in range(120)]


@pytest.mark.parametrize("rows", [1 << 18, 4])
def test_fingerprints_and_edits(spark, monkeypatch, rows):
    monkeypatch.setattr(fingerprints, "RUN_ROWS", rows)
    monkeypatch.setattr(fingerprints, "VOTES", 512)
    texts = ODD + near_texts(3)
    df = documents(spark, texts)
    ordered = sorted(df.collect(), key=lambda r: (r.doc_id is not None, -(r.doc_id or 0), r.text or ""))
    marks = [brute_mark(r.text) for r in ordered]
    want = []
    for i, row in enumerate(ordered):
        j = (i + 1) % len(ordered)
        own, following = row.text or "", ordered[j].text or ""
        n = len(own) // 3
        edited = own[:len(own) - n] + following[:n]
        mark = brute_mark(edited)
        near = sum((marks[i] ^ m).bit_count() <= 3 for m in marks) - 1 if row.doc_id is not None and row.doc_id % 50 == 0 else None
        want.append((row.doc_id, len(own), sha(edited), f"{marks[i]:016x}", f"{mark:016x}", 1 - (marks[i] ^ mark).bit_count() / 64,
                     1 - (marks[i] ^ marks[j]).bit_count() / 64, near))
    got = fingerprints.compare(df)
    assert got.columns[0] == "doc_id"
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert any(w[-1] for w in want)


def test_fingerprints_of_few_rows(spark):
    df = spark.createDataFrame([(5, "one two three four five six")], "doc_id long, text string")
    row = fingerprints.compare(df).first()
    assert row.edited_sha256 == sha("one two three four" + " five six"[:0] + "one two t") and row.near_next == 1
    assert fingerprints.compare(df.limit(0)).count() == 0
    assert {r.mark for r in fingerprints.fingerprints(documents(spark, ["", None, " ", "\n"])).collect()} >= {0}


def test_records_match_the_library(spark):
    texts = mixed_texts(2, 200)
    library = Tokenizer.from_file(BYTE_FILE)
    df = documents(spark, texts)
    ordered = sorted(df.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text or ""))
    start, want = 0, []
    for row in ordered:
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, 0]
        want.append((row.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = records.through_files(df, BYTE_FILE).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert records.through_files(df.limit(0), BYTE_FILE).count() == 0


def test_records_are_read_in_any_order_and_checked(spark):
    index = records.write_records(documents(spark, ODD), BYTE_FILE, end_id=70_000)
    library = Tokenizer.from_file(BYTE_FILE)
    some = index.filter("id % 3 = 1 AND id < 1000").orderBy("id", ascending=False)
    got = [(r.id, r.ids) for r in records.read_records(some).collect()]
    assert got == [(r.id, [*library.encode(ODD[r.id] or "", add_special_tokens=False).ids, 70_000]) for r in some.collect()]
    record = records.frame(b"payload")
    assert bytes(records.unframe(record)) == b"payload"
    for i in range(len(record)):
        damaged = bytearray(record)
        damaged[i] ^= 4
        with pytest.raises(ValueError):
            records.unframe(damaged)


def test_kept_columns_keep_their_names(spark):
    df = spark.createDataFrame([(1, "a b", 5, 7)], "doc_id long, text string, n_tokens int, ids int")
    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe.encode(df, path, keep=["doc_id", "text"])
    assert encoded.columns == ["doc_id", "text", "n_tokens", "ids"] and encoded.first().text == "a b"
    # Two columns of one name, as asked for.
    assert tuple(bpe.encode(df, path, keep=["doc_id", "n_tokens"]).first())[:2] == (1, 5)
    assert bpe.decode(encoded.withColumn("decoded", F.lit("x")), path, keep=["doc_id", "text", "ids"]).columns == ["doc_id", "text", "ids", "decoded"]


def test_long_unspaced_texts_are_not_remembered(spark, monkeypatch):
    monkeypatch.setattr(records, "REMEMBERED", 20_000)
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        encoder = records.Encoder(f.read(), 0)
    rng = random.Random(2)
    for _ in range(30):
        texts = ["".join(rng.choices("abcdef漢é.,'", k=30_000)) for _ in range(3)] + [" ".join(rng.choices("abcdefgh", k=50)) for _ in range(20)]
        got = encoder.encode(texts)
        want = encoder.library.encode_batch(texts, add_special_tokens=False)
        assert [np.frombuffer(g, encoder.kind).tolist() for g in got] == [[*w.ids, 0] for w in want]
        assert encoder.held <= 20_000 and max(map(len, [*encoder.known, *encoder.older])) <= records.LONGEST


def test_known_pieces_are_looked_up_once(monkeypatch):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        encoder = records.Encoder(f.read(), 0)
    texts = ["the quick brown fox, and so on", "", "the fox"]
    first = encoder.encode(texts)
    monkeypatch.setattr(encoder, "_learn", lambda pieces: pytest.fail("nothing is left to learn"))
    assert encoder.encode(texts[::-1]) == first[::-1]
