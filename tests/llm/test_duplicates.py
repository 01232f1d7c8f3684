"""Substring and near-duplicate removal against brute force."""

import hashlib
import random
import re

import pytest
import xxhash

from pyspark.sql import functions as F

from shelfmark.llm import neardup, substring
from shelfmark.llm.components import components

DOCUMENTS = "doc_id long, text string, KEY string, mark string"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def documents(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], DOCUMENTS).repartition(3)


def brute_substring(rows, window):
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        words = WORD.findall((text or "").encode())
        gone = set()
        for s in range(len(words) - window + 1):
            w = tuple(words[s:s + window])
            if w in seen:
                gone.update(range(s, s + window))
            seen.add(w)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc_id] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def passages(seed, n):
    rng = random.Random(seed)
    shared = [" ".join(rng.choices("abcdefgh", k=rng.randint(15, 70))) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(rng.choice(shared) if rng.random() < 0.5 else " ".join(rng.choices("abcdefghijklmnop", k=rng.randint(1, 40))))
        rows.append((i, rng.choice([" ", "\n", "  \t"]).join(parts)))
    return rows


@pytest.mark.parametrize("window", [20, 5, 40])
def test_repeats_match_brute_force(spark, window):
    rows = passages(window, 120) + [
        (500, None), (501, ""), (502, " \n "), (503, "a " * 3000), (504, "a " * 3000), (505, "one word"), (None, "a " * 50)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in substring.remove_repeats(documents(spark, rows), window=window).collect()}
    assert got == brute_substring(rows, window)


def test_many_copies_of_a_passage(spark):
    passage = " ".join(f"w{i}" for i in range(25))
    rows = [(i, f"{passage} own{i}") for i in range(40)]
    df = documents(spark, rows).repartition(12)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.remove_repeats(df).collect()}
    assert got == brute_substring(rows, 20)
    assert got[39][1] == 25


def test_kept_text_keeps_its_white_space(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    rows = [(1, f"head\n\n{passage}"), (2, f"an  other\nline {passage}\ttail \n end")]
    kept = {r.doc_id: r.kept_text for r in substring.remove_repeats(documents(spark, rows), keep=("mark", "KEY")).collect()}
    assert kept == {1: f"head\n\n{passage}", 2: "an  other\nline tail \n end"}


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    p, q, r = (" ".join(f"{c}{i}" for i in range(30)) for c in "pqr")
    rows = [(1, p), (2, p), (2, q), (None, r), (None, q), (None, p), (None, "x " * 5), (None, None), (None, r)]
    got = sorted(((x.doc_id, x.n_words, x.n_removed, x.kept_text) for x in substring.remove_repeats(documents(spark, rows)).collect()), key=repr)
    assert got == sorted([(1, 30, 0, p), (2, 30, 30, ""), (2, 30, 0, q), (None, 30, 0, r), (None, 30, 0, r), (None, 30, 30, ""), (None, 30, 30, ""),
                          (None, 5, 0, "x " * 5), (None, 0, 0, None)], key=repr)


def test_a_third_of_the_ids_null(spark):
    rng = random.Random(6)
    rows = [(None if i % 3 == 0 else i, " ".join(rng.choices("abc", k=rng.randint(0, 60)))) for i in range(90)]
    # A null id stands after all others; among those, texts stand by their hash: number them alike for brute force.
    hashes = {r.text: (r.a, r.b) for r in documents(spark, rows).selectExpr("text", "xxhash64(text) AS a", "hash(text) AS b").collect()}
    last = {t: 1000 + k for k, t in enumerate(sorted({t for i, t in rows if i is None}, key=hashes.get))}
    want = brute_substring([(last[t] if i is None else i, t) for i, t in dict.fromkeys(rows)], 20)
    got = {(last[t] if i is None else i): (n, gone, sha) for i, t, n, gone, sha in (
        (r.doc_id, r.mark, r.n_words, r.n_removed, r.kept_sha256) for r in substring.remove_repeats(
            documents(spark, rows).withColumn("mark", F.col("text")), keep=("mark",)).collect())}
    assert got == want


def test_rows_that_share_an_id_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(30))
    got = substring.remove_repeats(documents(spark, [(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (1, 0), (2, 30)]
    assert substring.remove_repeats(documents(spark, [])).count() == 0
    assert neardup.near_duplicates(documents(spark, [])).count() == 0


def brute_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode())
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(marks):
    ids = sorted(marks, key=lambda i: (i is None, i or 0))
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (marks[i] ^ marks[j]).bit_count() <= 3:
                a, b = sorted((top(i), top(j)), key=ids.index)
                root[b] = a
    return {i: top(i) for i in ids}


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=80)) for _ in range(6)]
    rows = [(i, None if i == 7 else "" if i == 8 else "ÀB c" if i == 9 else "one two" if i == 10 else
             " ".join("X" if rng.random() < 0.02 else w for w in rng.choice(base).split())) for i in range(150)]
    rows.append((None, base[0]))
    marks = {i: brute_fingerprint(t) for i, t in rows}
    want = brute_components(marks)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in neardup.near_duplicates(documents(spark, rows)).collect()}
    assert got == {i: (f"{marks[i]:016x}", want[i]) for i in marks}
    assert len(set(want.values())) < 150
    kept = neardup.one_of_each(documents(spark, rows))
    assert kept.columns == ["doc_id", "text", "KEY", "mark"]
    assert {r.doc_id for r in kept.collect()} == set(want.values())


@pytest.mark.parametrize("limit", [2, 8, 2048])
def test_links_through_all_levels(spark, monkeypatch, limit):
    # All marks within a few bits share most keys; a low limit sends them to the next levels.
    monkeypatch.setattr(neardup, "RUN_ROWS", limit)
    rng = random.Random(limit)
    center = rng.getrandbits(64)
    marks = {center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 9))) for _ in range(150 if limit > 2 else 12)}
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    found = neardup.link_marks(spark.createDataFrame([(m,) for m in signed], "mark long"))
    roots = {r.node: r.root for r in components(found).collect()}
    want = brute_components({m: m & (2**64 - 1) for m in signed})
    if limit > 2:  # a limit under a last-level run loses what it must not hold
        assert {m: roots.get(m, m) for m in signed} == want


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 11), (5, 5), (3, 2), (7, 6), (6, 8), (8, 9), (9, 4), *((i, i + 1) for i in range(100, 140))]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 4: 4, 6: 4, 7: 4, 8: 4, 9: 4, **{i: 100 for i in range(100, 141)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
