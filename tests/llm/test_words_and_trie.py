"""Language, spelling variants and the prefix trie against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from shelfmark.llm import langid, spelling, trie

LETTERS = {"aa": "abcde", "bb": "fghij", "cc": "éèçàö"}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(LETTERS[lang]) for _ in range(rng.randint(1, 9))) for _ in range(n))


# Language

def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    tagger = langid.Tagger(["a", "b", "c"])
    for w in tagger.weights():
        w[...] = rng.normal(0, 0.4, w.shape)
    codes = rng.integers(97, 101, (6, 4)).astype(np.uint8)
    lengths, wanted = np.array([6, 6, 3, 1]), np.array([0, 1, 2, 1])
    _, found = tagger.gradients(codes, lengths, wanted)
    for w, g in zip(tagger.weights(), found):
        for _ in range(4):
            # A weight that the bytes at hand read.
            at = tuple(rng.integers(0, n) for n in w.shape) if w.shape[0] != 256 else (int(rng.integers(97, 101)), int(rng.integers(0, w.shape[1])))
            kept, step = w[at], np.float32(5e-3)
            w[at] = kept + step
            up, _ = tagger.gradients(codes, lengths, wanted)
            w[at] = kept - step
            down, _ = tagger.gradients(codes, lengths, wanted)
            w[at] = kept
            assert (up - down) / (2 * step) == pytest.approx(g[at], abs=2e-3)


def test_segments_of_a_text_are_labelled_alike_in_any_company():
    tagger = langid.Tagger(["a", "b"])
    texts = [b"", b"x", b"abc " * 100, b"12 34", "é".encode() * 200]
    alone = np.concatenate([tagger.pooled([t]) for t in texts])
    assert np.allclose(tagger.pooled(texts), alone, atol=1e-5)
    assert alone[0].sum() == alone[3].sum() == 0 and alone[2].sum() == pytest.approx(1, abs=1e-5)


def test_language_of_held_out_rows(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 600)
    rng = random.Random(5)
    rows = [(i, prose(rng, lang := rng.choice(list(LETTERS)), rng.randint(3, 300)), lang, 1) for i in range(500)]
    odd = [(None, prose(rng, "aa", 30), "aa", 1), (9001, None, "aa", 1), (9002, "", "bb", 1), (9003, "12 !? \n", "cc", 1),
           (9004, "日本", None, 1), (9005, prose(rng, "cc", 60_000), None, 1), (9006, rows[0][1], None, 1), (9006, rows[0][1], None, 1)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, SCORE int").repartition(3)
    got = langid.judge(df).collect()
    assert len(got) == 508 and got[0].asDict().keys() == {"doc_id", "held_out", "lang_pred", "score"}
    want = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.doc_id in want and r.held_out]
    assert {r.doc_id for r in held} == {i for i in want if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.lang_pred == want[r.doc_id] for r in held) > 0.95 * len(held)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (9001, 9002, 9003)] == ["und"] * 3 and by_id[9001].score == 0
    assert by_id[9004].lang_pred in LETTERS and by_id[9005].lang_pred == "cc" and by_id[None].held_out
    assert all(0 <= r.score <= 1 for r in got)
    assert langid.judge(df.limit(0)).collect() == []
    nothing = langid.judge(df.withColumn("lang", df.lang.substr(9, 1)).filter("doc_id < 3 AND false")).collect()
    assert nothing == []


def test_without_labels_no_language_is_known(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in langid.judge(df).collect()] == [("und", 0.0)]


# Spelling

def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_near(words):
    out = {}
    for a in words:
        near = [b for b in words if one_edit(a, b)]
        if near:
            out[a] = (len(near), *min((-words[b], b) for b in near))
    return out


@pytest.mark.parametrize("most", [2048, 3])
@pytest.mark.parametrize("alphabet", ["ab", "abcÿ"])
def test_near_words_in_groups_of_any_size(spark, monkeypatch, most, alphabet):
    monkeypatch.setattr(spelling, "GROUP", most)
    rng = random.Random(2)
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randint(7, 10))): rng.choice([2, 2, 3, 40]) for _ in range(250)}
    words |= {"a" * 60: 9, "a" * 59: 9, "a" * 30 + "b" + "a" * 29: 2}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = {r.word: (r.n_near, -r.best_n, r.best) for r in spelling.near_words(df).collect()}
    assert got == brute_near(words)


def test_pairs_and_lanes_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PAIR_ROOM", 7)
    monkeypatch.setattr(spelling, "INDEX_ROOM", 1)
    words = {"aaaaaaa" + chr(97 + i % 26) * (i // 26 + 1): 2 + i for i in range(200)}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(2)
    assert {r.word: (r.n_near, -r.best_n, r.best) for r in spelling.near_words(df).collect()} == brute_near(words)


def brute_variants(rows):
    counts = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] = counts.get(run, 0) + 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near, out = brute_near(words), {}
    forms = {w: b for w, (_, n, b) in near.items() if -n >= 10 * words[w]}
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        out[w] = (forms.get(w), root, n, near[w][0] if w in near else 0, words[forms[w]] if w in forms else None)
    return out


def test_variants_of_whole_documents(spark):
    rng = random.Random(4)
    stems = ["spelling", "variants", "variantes", "Éclairage", "éclairage", "grouping", "short", "xxxxxxx"]
    rows = [(i, " ".join(rng.choice(stems) if rng.random() < 0.7 else rng.choice(stems)[:-1] + rng.choice("sxé") for _ in range(60)))
            for i in range(150)]
    rows += [(900, "abcdefgh " * 2000 + "abcdefgx " * 150 + "abcdefxx " * 2), (901, "z" * 50_000 + " 漢字spelling漢"), (902, "z" * 50_000)]
    rows += [(None, None), (None, "Spelling"), (903, ""), (903, ""), (904, "12 - 3"), (5, rows[5][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, WORD int").repartition(4)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group_variants(df).collect()}
    assert got == brute_variants(rows)
    assert got["abcdefxx"][:2] == ("abcdefgx", "abcdefgh")
    assert spelling.group_variants(df.limit(0)).collect() == []


# Trie

def brute_trie(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0), role, digest, text))
    own = {c: [(t[1], t[3]) for t in sorted(turns)] for c, turns in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for prefix, members in nodes.items():
        below = [p for p in nodes if p[:len(prefix)] == prefix]
        kids = [p for p in below if len(p) == len(prefix) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in below)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in members if len(made[c]) == len(prefix))))
        out.append((min(members), len(prefix), min(nodes[prefix[:-1]]) if prefix else None, len(members), len(kids), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def talk(seed, n):
    rng = random.Random(seed)
    says = ["hi", "", None, "wie geht's?", "é" * 40]
    rows = []
    for c in range(n):
        # A third of all conversations are the same, many share their first turns.
        turns = [("system", "be kind"), ("user", "hi")] if c % 3 else [("user", "same"), ("assistant", "same too")] * 3
        if c % 3:
            turns = turns + [(rng.choice(["user", "assistant", None]), rng.choice(says)) for _ in range(rng.randint(0, 9))]
        rows += [(c, None if t == 0 else t, role, text) for t, (role, text) in enumerate(turns)]
    return rows


@pytest.mark.parametrize("most", [1 << 17, 12])
def test_prefix_trie(spark, monkeypatch, most):
    monkeypatch.setattr(trie, "UNIT_NODES", most)
    monkeypatch.setattr(trie, "ROWS_OUT", 100)
    rows = talk(3, 60) + [(None, 1, "user", "nobody's"), (101, 1, "user", "hi"), (202, 1, "user", "a"), (202, 1, "user", "a"),
                          (202, 1, "assistant", "b"), (10**12, 5, None, None)]
    rows += [(303, t, "user", str(t)) for t in range(30)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn int, role string, text string, DEPTH int").repartition(3)
    got = sorted((tuple(r) for r in trie.prefix_trie(df).collect()), key=repr)
    assert got == brute_trie(rows)


def test_no_conversations_no_nodes(spark):
    df = spark.createDataFrame([(None, 1, "user", "x")], "conv_id long, turn int, role string, text string")
    assert trie.prefix_trie(df).collect() == []
    assert trie.prefix_trie(df.limit(0)).collect() == []


def test_slots_are_minimal_perfect_and_verified():
    rng = np.random.default_rng(1)
    one, two = rng.integers(-2**63, 2**63, (2, 5000))
    slots = trie.Slots(one, two)
    assert sorted(slots.slot) == list(range(5000))
    assert (slots.find(one, two) == slots.slot).all()
    assert (slots.find(one, two + 1) == -1).all()
    with pytest.raises(ValueError):
        trie.Slots(np.zeros(2, np.int64), np.zeros(2, np.int64))
