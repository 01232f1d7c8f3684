"""The pipeline, stage by stage, against brute force on a small corpus."""

import random
import uuid

import public_tokenizers
from test_duplicates import brute_components, brute_fingerprint, brute_substring
from tokenizers import Tokenizer

import corpus_pipeline
from shelfmark.llm import mixing, quality
from shelfmark.operators.settle import shared_folder


def corpus(spark):
    rng = random.Random(8)
    passage = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(60))
    rows, labels = [], []
    for i in range(240):
        words = ["".join(rng.choices("abcdefghijkl", k=rng.randint(2, 7))) for _ in range(rng.randint(30, 90))]
        good = i % 4 != 0
        if not good:
            words = [w.upper() + "!!" for w in words]
        elif i % 7 == 1:
            words[10:10] = passage.split()
        rows.append([i, " ".join(words), "en", f"src{i % 3}", 0])
        if i % 3:
            labels.append((i, int(good)))
    for i in (21, 22, 23):  # copies of document 2
        rows[i][1] = rows[2][1]
    rows[33][1] = rows[5][1] + " tail"  # a near copy
    rows[39][1], rows[42][1] = None, ""
    for r in rows:
        r[4] = len(r[1] or "")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_match_brute_force(spark):
    folder = corpus(spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "simhash_near_dedup", "substring_dedup", "mix_sources", "bpe_encoding"]
    columns, labels = docs.columns, spark.read.parquet(f"{folder}/labels.parquet")

    want = {r.doc_id for r in quality.judge(docs, labels).collect() if r.predicted}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in want}
    docs = stored(corpus_pipeline.STAGES[0][1](spark, docs, folder))
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == texts
    assert len([i for i in texts if i % 4]) >= 175 and len([i for i in texts if i % 4 == 0 and i]) < 12

    marks = {i: brute_fingerprint(t) for i, t in texts.items()}
    roots = brute_components(marks)
    docs = stored(corpus_pipeline.STAGES[1][1](spark, docs, folder))
    texts = {i: t for i, t in texts.items() if roots[i] == i}
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == texts
    assert not {21, 22, 23} & set(texts)

    docs = stored(corpus_pipeline.STAGES[2][1](spark, docs, folder))
    brute = brute_substring(list(texts.items()), 20)
    got = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns and set(got) == set(texts)
    for i, (n, gone, _) in brute.items():
        assert len((got[i].text or "").split()) == n - gone and (gone or got[i].text == texts[i])
        assert got[i].n_chars == (None if got[i].text is None else len(got[i].text))
    assert sum(gone for _, gone, _ in brute.values()) > 500

    copies = {r.doc_id: r.copies for r in mixing.copies(docs).collect()}
    mixed = stored(corpus_pipeline.STAGES[3][1](spark, docs, folder))
    assert mixed.columns == columns
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(i for i, n in copies.items() for _ in range(n))

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    encoded = corpus_pipeline.STAGES[4][1](spark, mixed, folder)
    rows = encoded.collect()
    assert len(rows) == sum(copies.values())
    for r in rows:
        assert list(r.ids) == library.encode(got[r.doc_id].text or "", add_special_tokens=False).ids
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, whole.collect())) == sorted(map(str, rows))


def stored(df):
    path = f"{shared_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
