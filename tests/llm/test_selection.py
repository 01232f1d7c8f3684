"""Mixing, top-k and shards against brute force."""

import math
import random
import zlib

import pytest

from shelfmark.llm import mixing, sharding, topk


def documents(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, SIZE string, copies int").repartition(3)


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight; what stands above its limit is reshared among the others until nothing does."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        left = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[t] for t in left) for s in left}
        over = {s: most * sizes[s] for s in left if share[s] > most * sizes[s]}
        if not over:
            return capped | share
        capped |= over


def corpus(seed, n, sources):
    rng = random.Random(seed)
    return [(i, " ".join("w" * (1 + int(rng.paretovariate(1.2)) % 400)) if rng.random() < 0.95 else rng.choice([None, "", " "]),
             sources[min(int(rng.expovariate(0.7)), len(sources) - 1)]) for i in range(n)]


@pytest.mark.parametrize("group_rows", [16_384, 20])
def test_mix_meets_its_targets(spark, monkeypatch, group_rows):
    monkeypatch.setattr(mixing, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    rows = corpus(1, 900, ["b", "a", "é", None, "\U0001f600", "￿"]) + [(None, "one two", "a")]
    rows += [(5000 + i, "\n", "blank") for i in range(3)]
    df = documents(spark, rows)
    got = mixing.copies(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = brute_targets(sizes)
    by_id = {i: s for i, _, s in rows}
    taken, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in got:
        s = by_id[r.doc_id]
        assert (r.source_size, r.target) == (sizes[s], pytest.approx(want[s]))
        assert r.taken == r.copies * r.size <= 3 * r.size
        assert r.size == 0 or r.copies in (math.floor(want[s] / sizes[s]), math.ceil(want[s] / sizes[s]))
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    again = mixing.copies(df.repartition(7)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)
    mixed = mixing.mixed(df)
    assert mixed.columns == df.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {r.doc_id: r.copies for r in got if r.copies}


def test_fractions_keep_their_expectation():
    n, p = 4000, [0.3, 0.7, 0.5, 0.25, 0.9]
    sums = [0.0] * len(p)
    for seed in range(n):
        out = mixing.settle_pairs(list(range(5)), [10, 7, 5, 3, 1], list(p), 0, seed, last=True)
        assert set(out) <= {0.0, 1.0}
        sums = [a + b for a, b in zip(sums, out)]
    assert all(abs(s / n - x) < 0.04 for s, x in zip(sums, p))


def test_mix_of_nothing(spark):
    assert mixing.copies(documents(spark, [])).count() == 0
    blank = mixing.copies(documents(spark, [(1, None, None), (1, None, None)])).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 2


def brute_top(rows, k, scale=1024):
    whole = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in whole:
        if q is None or q % 100:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(a, b)), i is None, i) for i, b in whole if i != q),)
        out += [(q, n + 1, i, -s) for n, (s, _, i) in enumerate(scored[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("cell_rows,pivots", [(8192, 64), (30, 5)])
def test_top_k_matches_brute_force(spark, monkeypatch, cell_rows, pivots):
    monkeypatch.setattr(topk, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(topk, "PIVOTS", pivots)
    rng = random.Random(7)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)]) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # many ties
    rows += [(2000, None), (2100, [None] * 8), (2200, [math.nan] * 8), (2300, [math.inf] * 8), (None, rows[3][1]), (2400, [1.5, -2.0]), (2500, [])]
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<float>, VEC double").repartition(4)
    exact = [(r.vec_id, None if r.embedding is None else list(r.embedding)) for r in df.collect()]
    got = topk.top_k(df, F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, got), key=str) == brute_top(exact, 10)


def test_top_k_with_few_rows(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (0, [1.0, 0.0])], "vec_id long, embedding array<float>")
    got = topk.top_k(df, F.col("vec_id") % 100 == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 1024 * 512)]
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert topk.top_k(df.filter("vec_id = 1"), F.col("vec_id") % 100 == 0).count() == 0


def brute_minimax(sizes, shards):
    best = [0] + [math.inf] * len(sizes)
    for _ in range(shards):
        best = [min([best[j] if j == i else max(best[j], sum(sizes[j:i])) for j in range(i + 1)]) for i in range(len(sizes) + 1)]
    return best[-1]


def test_cuts_are_minimax():
    rng = random.Random(3)
    for _ in range(60):
        sizes = [rng.randint(1, 50) for _ in range(rng.randint(1, 18))]
        shards = rng.randint(1, 6)
        cuts = sharding.minimax_cuts(sizes, shards)
        assert len(cuts) == shards and cuts[-1] == len(sizes) and cuts == sorted(cuts)
        assert max(sum(sizes[a:b]) for a, b in zip([0, *cuts], cuts)) == brute_minimax(sizes, shards)


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 16)
    rng = random.Random(9)
    rows = [(i, rng.choice([None, "", "same é text", "another"]) if rng.random() < 0.4 else "x" * rng.randint(0, 300), "s") for i in range(700)]
    rows += [(None, "null id", "s"), (None, "null id", "s"), (3, rows[3][1], "s")]
    df = documents(spark, rows)
    got = sharding.shards_by_bytes(df)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = got.collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows if i is not None)
    sums, slots, home = [0] * 8, [[] for _ in range(8)], {}
    for r in got:
        sums[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert home.setdefault((r.size, r.text_crc32), r.shard) == r.shard
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    largest = max(sum(r.size for r in got if r.text_crc32 == c) for c in {r.text_crc32 for r in got})
    assert max(sums) <= sum(sums) / 8 + largest
    again = sharding.shards_by_bytes(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert sharding.shards_by_bytes(df.limit(0)).count() == 0


@pytest.mark.parametrize("group_rows", [16_384, 20])
def test_rows_without_ids_of_their_own_are_mixed_one_by_one(spark, monkeypatch, group_rows):
    monkeypatch.setattr(mixing, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    rows = [(i, text, source) for i, text, source in corpus(2, 300, ["a", "b"])]
    rows += [(None, "five words are in here", "a") for _ in range(150)] + [(7, "x y", "b")] * 40
    df = documents(spark, rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want, most = brute_targets(sizes), max(len((t or "").split()) for _, t, _ in rows)
    each = mixing.copies(df).collect()
    assert len(each) == len(rows) and sum(r.doc_id is None for r in each) == 150
    for total in (sum(r.taken for r in each), sum(len((r.text or "").split()) for r in mixing.mixed(df).collect())):
        assert abs(total - sum(want.values())) <= 2 * most
    assert len({r.copies for r in each if r.doc_id is None and want["a"] % sizes["a"]}) == 2
    assert mixing.mixed(df).columns == df.columns
