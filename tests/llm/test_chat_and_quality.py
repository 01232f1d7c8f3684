"""Chat formatting by round trips; the quality classifier by brute force and held-out accuracy."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import chat, quality

NASTY = ["", None, "<|turn|>", "<|end|>\\", "<\\|text|>", "<\\\\|", "<<|", "<|", "|>", "</s>[INST] ok [/INST]", "a\\|b <\\", "é<|ñ|>",
         "\n\n", "x" * 5000, "<|image|>", "$1 \\1 $0", "😀<\\\\\\|"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_of_texts(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "<|text|>"]), rng.choice(NASTY)) for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(None, 0, "assistant", "null conversation"), (7, None, "assistant", "null turn"), (7, None, "assistant", "null turn")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, TURNS string").repartition(3)
    formatted = chat.format_conversations(df.withColumn("parts", chat.text_part(F.col("text"))))
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    whole = {r.conv_id: r for r in formatted.collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, row in got.items():
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        # Ties of turn and role stand by escaped text, which for these rows is the order of the text.
        learnt = "".join(x for _, _, r, x in turns if r == "assistant")
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns))
        assert (row.loss_chars, row.loss_sha256) == (len(learnt), sha(learnt))
        assert row.formatted_chars == len(whole[conv].formatted)
        raw = whole[conv].formatted.encode()
        spans = [raw[s.start:s.start + s.length].decode() for s in whole[conv].loss_spans]
        assert "".join(spans).count("<|") == 0 and len(spans) == sum(whole[conv].loss_mask)
        assert whole[conv].formatted.count("<|turn|>") == whole[conv].formatted.count("<|end|>") == len(turns)
    assert chat.read_back(chat.format_conversations(df.limit(0).withColumn("parts", chat.text_part(F.col("text"))))).count() == 0


def test_escapes_are_reversible(spark):
    df = spark.createDataFrame([(t,) for t in NASTY if t is not None] + [("<" + "\\" * i + "|",) for i in range(6)], "t string")
    for t, e, back in df.select("t", chat.escape(F.col("t")), chat.unescape(chat.escape(F.col("t")))).collect():
        assert back == t and "<|" not in e


def test_attachments(spark):
    parts = [("text", "see <|image|> ", None, None, None, None, None), ("image", None, "a.png", 28, 15, None, None),
             None, ("audio", None, "b.wav", None, None, 2.01, None), (None, "no type", None, None, None, None, None),
             ("document", "ignored", "c.pdf", None, None, None, 3), ("image", None, None, None, None, None, None),
             ("video", "of another type", "d", None, None, None, None), ("text", None, None, None, None, None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None), (1, 2, "assistant", [])],
                               f"conv_id long, turn int, role string, parts {chat.PARTS}")
    row = chat.format_conversations(df).first()
    assert row.formatted == ("<|turn|>user<|text|>see <\\|image|> <|image|><|audio|>no type<|document|><|image|>of another type<|end|>"
                             "<|turn|>assistant<|text|><|end|>" * 1 + "<|turn|>assistant<|text|><|end|>")
    assert [tuple(a) for a in row.attachments] == [("image", "a.png", 4), ("audio", "b.wav", 51), ("document", "c.pdf", 2400), ("image", None, 1)]
    assert row.expanded_tokens == 2456 and row.loss_mask == [False, True, True]


def test_parts_cut_anywhere_read_back(spark):
    rng, rows = random.Random(9), []
    controls = ["<|turn|>", "<|text|>", "<|end|>", "<|image|>", "<\\|audio|>", "x <|document|> y"]
    for c, control in enumerate(controls):
        for cut in range(len(control) + 1):
            rows.append((len(rows), [("text", control[:cut]), ("text", control[cut:])]))
    for _ in range(60):
        whole = "".join(rng.choice(controls) for _ in range(3))
        cuts = sorted(rng.sample(range(len(whole)), 4))
        parts = [("text", whole[a:b]) for a, b in zip([0, *cuts], [*cuts, None])]
        parts.insert(rng.randint(0, 5), ("image", None))
        rows.append((len(rows), parts))
    full = [(i, 0, "user", [(kind, text, None, None, None, None, None) for kind, text in parts]) for i, parts in rows]
    df = spark.createDataFrame(full, f"conv_id long, turn int, role string, parts {chat.PARTS}")
    read = chat.format_conversations(df).select("conv_id", chat.read_turns(F.col("formatted")).alias("turns")).collect()
    got = {r.conv_id: r.turns for r in read}
    for i, parts in rows:
        want = []
        for kind, text in parts:
            if kind == "text" and want and want[-1][0] == "text":
                want[-1] = ("text", want[-1][1] + text)
            elif kind != "text" or text:
                want.append((kind, text))
        assert len(got[i]) == 1
        assert [tuple(p) for p in got[i][0].parts] == [w for w in want if w != ("text", "")]
        assert got[i][0].text == "".join(t or "" for _, t in parts)


def test_scores_equal_the_sum_over_all_pairs():
    texts = pa.array(["some words words here, AND 12 more###", "", None, "x " * 300, "é"])
    f = quality.features(texts)
    rng = np.random.default_rng(0)
    size = quality.BUCKETS + len(quality.STATISTICS) * (quality.BINS + 1)
    machine = quality.Machine(np.sort(rng.random((len(quality.STATISTICS), quality.BINS)), axis=1), 0.1, rng.normal(size=size), rng.normal(size=(size, 3)))
    row, index, value = machine.rows(f)
    for n, got in enumerate(machine.score(f)):
        i, x = index[row == n], value[row == n]
        out = machine.bias + machine.weights[i] @ x
        out += sum(machine.factors[i[a]] @ machine.factors[i[b]] * x[a] * x[b] for a in range(len(i)) for b in range(a))
        assert got == pytest.approx(1 / (1 + np.exp(-out)))


def labelled(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(1500):
        words = ["".join(rng.choices("abcdefghijkl", k=rng.randint(2, 8))) for _ in range(rng.randint(1, 120))]
        good = rng.random() < 0.8
        if not good:
            kind = rng.randrange(3)
            words = [w.upper() + "!!" for w in words] if kind == 0 else [w + rng.choice(["***", "%%%"]) for w in words] if kind == 1 else [words[0]] * 80
        rows.append((i, " ".join(words), "s", 0.5))
        if i % 2:
            labels.append((i, int(good)))
    rows += [(5000, None, "s", 0.5), (5001, "", None, None), (None, "words without id", "s", 0.5), (3, rows[3][1], "s", 0.5)]
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, SCORE double").repartition(3),
            spark.createDataFrame(labels + [(None, 1), (8, None)], "doc_id long, quality int"))


def test_held_out_accuracy(spark):
    documents, labels = labelled(spark)
    got = quality.judge(documents, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == documents.count()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    right, asked = 0, 0
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 5 == 0)
        if r.held_out and truth.get(r.doc_id) is not None and r.doc_id is not None:
            asked, right = asked + 1, right + (r.predicted == truth[r.doc_id])
    assert asked > 100 and right / asked > 0.95
    again = quality.judge(documents.repartition(5), labels).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    kept = quality.accepted(documents, labels)
    assert kept.columns == documents.columns
    assert kept.count() == sum(r.predicted for r in rows)


def test_labels_held_out_or_absent_do_not_matter(spark):
    documents, labels = labelled(spark)
    turned = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(map(str, quality.judge(documents, turned).collect())) == sorted(map(str, quality.judge(documents, labels).collect()))
    none = quality.judge(documents, labels.limit(0)).collect()
    assert all(abs(r.score - 0.5) < 0.2 for r in none)
    assert quality.judge(documents.limit(0), labels).count() == 0
