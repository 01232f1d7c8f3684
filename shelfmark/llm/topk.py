"""Exact top-k by inner product with a pivot-distance index.

Vectors get one more component that makes all norms equal; then the larger
inner product with a query is the smaller distance. Every vector is keyed by
its nearest pivot and its distance from it. A query first looks at a cell of
its nearest pivot, which bounds the distance r of its k-th neighbour; by the
triangle inequality only vectors at pivot distances within r of its own can be
nearer. Cells are sorted by pivot distance, so that is one slice of a cell, or
none. All scores are computed on integers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.common import NULL_ID, id_or_last, run_starts
from shelfmark.operators.settle import settle

PIVOTS = 64
#: Vectors the pivots are fitted on: the bound of what the driver holds of them.
SAMPLE_ROWS = 4096
ROUNDS = 6
#: Vectors of a cell; a pivot with more is split by a hash of the ids.
CELL_ROWS = 8192
#: Queries scored against a cell at once.
TOGETHER = 64
SLACK = 1e-6


def whole_vectors(table: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, vec): floor(scale * x) of each component; vectors that are null or hold null or non-finite values are left out."""
    x = F.col(vector_col)
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (table.filter(x.isNotNull()).filter(~odd)
            .select(id_or_last(id_col).alias("id"), F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("vec")))


def _norm2(vec: Column) -> Column:
    return F.aggregate(vec, F.lit(0).cast("long"), lambda s, v: s + v * v)


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows; shorter ones are filled with zeros."""
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    if len(values) == len(lengths) * width and (lengths == width).all():
        return values.reshape(-1, width).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _lifted(vectors: np.ndarray, norm2: float) -> np.ndarray:
    """One more component, so that every row has the squared norm ``norm2``."""
    rest = norm2 - np.einsum("ij,ij->i", vectors.astype(float), vectors.astype(float))
    return np.column_stack([vectors, np.sqrt(np.maximum(rest, 0))])


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (points ** 2).sum(1)[:, None] + (pivots ** 2).sum(1)[None, :] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def fit_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Centres of a few rounds of k-means, from points far from each other; at most ``n``."""
    points = np.unique(sample, axis=0)
    chosen, near = [0], _distances(points, points[:1])[:, 0]
    while len(chosen) < min(n, len(points)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _distances(points, points[chosen[-1:]])[:, 0])
    pivots = points[chosen].astype(float)
    for _ in range(ROUNDS):
        own = _distances(points, pivots).argmin(1)
        for i in range(len(pivots)):
            if (own == i).any():
                pivots[i] = points[own == i].mean(0)
    return pivots


INDEX = "cell long, asked boolean, id long, vec binary, at double, radius double"
NAMES = [c.split()[0] for c in INDEX.split(", ")]


def _rows(cell, asked, ids, vec, at, radius) -> pa.RecordBatch:
    n = len(cell)
    return pa.RecordBatch.from_arrays([
        pa.array(cell, pa.int64()), pa.array(np.full(n, asked)), pa.array(ids, pa.int64()), vec,
        pa.array(at, pa.float64()), pa.array(np.broadcast_to(np.asarray(radius, float), n))], NAMES)


def _bytes(vectors: np.ndarray) -> pa.Array:
    width = vectors.shape[1] * 8
    offsets = np.arange(len(vectors) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(vectors), [
        None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(vectors, "<i8").tobytes())])


def _numbers(vectors: pa.Array, width: int) -> np.ndarray:
    raw = b"".join(vectors.to_pylist())
    return np.frombuffer(raw, "<i8").reshape(-1, width)


def _keyed(batches: Iterable[pa.RecordBatch], plan) -> Iterator[pa.RecordBatch]:
    """Vectors keyed by nearest pivot (in ``cell``) and distance."""
    for batch in batches:
        vectors = _matrix(batch.column(1), plan.value["width"])
        far = _distances(_lifted(vectors, plan.value["norm2"]), plan.value["pivots"])
        own = far.argmin(1)
        yield _rows(own, False, batch.column(0).to_numpy(zero_copy_only=False), _bytes(vectors), far[np.arange(len(own)), own], 0.0)


def _first_cell(batches: Iterable[pa.RecordBatch], plan) -> Iterator[pa.RecordBatch]:
    """Each query at a cell of its nearest pivot."""
    p = plan.value
    for batch in batches:
        vectors = _numbers(batch.column(1), p["width"])
        far = _distances(np.column_stack([vectors, np.zeros(len(vectors))]), p["pivots"])
        far[:, p["rows"] == 0] = np.inf
        own = far.argmin(1)
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        cell = own * (1 << 32) + ids % p["ways"][own]
        yield _rows(cell, True, ids, batch.column(1), far[np.arange(len(own)), own], np.inf)


def _all_cells(batches: Iterable[pa.RecordBatch], plan) -> Iterator[pa.RecordBatch]:
    """Each query, with the radius found for it, at every cell that can hold a nearer vector."""
    p = plan.value
    for batch in batches:
        ids, radius = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "radius"))
        vectors = _numbers(batch.column("vec"), p["width"])
        far = _distances(np.column_stack([vectors, np.zeros(len(vectors))]), p["pivots"])
        reach = radius[:, None] + SLACK * (1 + np.sqrt(p["norm2"]))
        query, pivot = np.nonzero((p["rows"] > 0) & (far - reach <= p["most"]) & (far + reach >= p["least"]))
        ways = p["ways"][pivot]
        query, pivot = np.repeat(query, ways), np.repeat(pivot, ways)
        salt = np.arange(len(query)) - np.repeat(np.cumsum(ways) - ways, ways)
        for i in range(0, len(query), 4096):
            q, v = query[i:i + 4096], pivot[i:i + 4096]
            yield _rows(v * (1 << 32) + salt[i:i + 4096], True, ids[q], batch.column("vec").take(pa.array(q)), far[q, v], radius[q])


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _scan(batches: Iterable[pa.RecordBatch], plan, k: int, radii: bool) -> Iterator[pa.RecordBatch]:
    """Queries against their cells; rows come sorted by cell, vectors first, then pivot distance.

    With ``radii`` each query comes back with the distance of its k-th best in
    the cell (infinite with fewer), else with its k best.
    """
    p = plan.value
    exact = float if p["norm2"] < 2**52 else object
    cell, ids, vectors, at = None, [], [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        cells, asked = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "asked"))
        starts = run_starts(cells * 2 + asked)
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(cells)]):
            part = batch.slice(s, e - s)
            own_ids, own_at, radius = (part.column(c).to_numpy(zero_copy_only=False) for c in ("id", "at", "radius"))
            matrix = _numbers(part.column("vec"), p["width"]).astype(exact)
            if cells[s] != cell:
                cell, ids, vectors, at = cells[s], [np.zeros(0, np.int64)], [np.zeros((0, p["width"]), exact)], [np.zeros(0)]
            if not asked[s]:
                ids.append(own_ids)
                vectors.append(matrix)
                at.append(own_at)
                continue
            if len(ids) > 1:
                ids, vectors, at = [np.concatenate(ids)], [np.concatenate(vectors)], [np.concatenate(at)]
            yield from _scored(part, ids[0], vectors[0], at[0], own_ids, matrix, own_at, radius, p, k, radii)


def _scored(part, ids, vectors, at, asked, matrix, asked_at, radius, p, k, radii) -> Iterator[pa.RecordBatch]:
    slack = SLACK * (1 + np.sqrt(p["norm2"]))
    found = []
    for i in range(0, len(asked), TOGETHER):
        low = np.searchsorted(at, (asked_at[i:i + TOGETHER] - radius[i:i + TOGETHER] - slack).min(), "left")
        high = np.searchsorted(at, (asked_at[i:i + TOGETHER] + radius[i:i + TOGETHER] + slack).max(), "right")
        scores = (matrix[i:i + TOGETHER] @ vectors[low:high].T).astype(np.int64)
        for j, row in enumerate(scores):
            other = ids[low:high] != asked[i + j]
            own_ids, own = (ids[low:high][other], row[other]) if not other.all() else (ids[low:high], row)
            best = _top(own_ids, own, k)
            if radii:
                norm2 = float((matrix[i + j] * matrix[i + j]).sum())
                found.append(np.sqrt(max(0.0, norm2 + p["norm2"] - 2 * float(own[best[-1]]))) if len(best) == k else np.inf)
            elif len(best):
                found.append((np.full(len(best), asked[i + j]), np.full(len(best), i + j), own_ids[best], own[best]))
    if radii:
        yield pa.RecordBatch.from_arrays([part.column("id"), part.column("vec"), pa.array(found, pa.float64())], ["id", "vec", "radius"])
    elif found:
        query, row, near, score = (np.concatenate(c) for c in zip(*found))
        yield pa.RecordBatch.from_arrays([pa.array(query), part.column("vec").take(pa.array(row)), pa.array(near), pa.array(score)],
                                         ["query", "vec", "id", "score"])


def top_k(table: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of all other rows for the rows that ``queries`` holds for.

    Scores are integer inner products of floor(scale * x); ties go to the
    smaller id. Rows with a query's id are its own and no candidates. Vectors
    that are null or hold null or non-finite components take no part; shorter
    vectors count as filled with zeros. A null id is no query, and stands after
    all others. Repeated rows are candidates as often as they come; repeated
    query rows are asked once. An empty table, or no query, gives no rows.
    """
    spark = table.sparkSession
    rows = whole_vectors(table, id_col, vector_col, scale)
    width, norm2, n = rows.agg(F.max(F.size("vec")), F.max(_norm2(F.col("vec"))), F.count("*")).first()
    width, norm2 = max(1, width or 1), float(norm2 or 0)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("vec").toArrow().column(0).combine_chunks()
    sample = _matrix(sample, width) if n else np.zeros((1, width), np.int64)
    plan = {"width": width, "norm2": norm2, "pivots": fit_pivots(_lifted(sample, norm2), PIVOTS)}
    first = spark.sparkContext.broadcast(plan)
    index = settle(rows.mapInArrow(lambda b: _keyed(b, first), INDEX), "pivot-index")
    sizes = np.zeros(len(plan["pivots"]), np.int64)
    least, most = np.full(len(sizes), np.inf), np.full(len(sizes), -np.inf)
    for pivot, count, low, high in index.groupBy("cell").agg(F.count("*"), F.min("at"), F.max("at")).collect():
        sizes[pivot], least[pivot], most[pivot] = count, low, high
    ways = np.maximum(1, -(-sizes // CELL_ROWS))
    shared = spark.sparkContext.broadcast(plan | {"rows": sizes, "least": least, "most": most, "ways": ways})
    ways_of = F.element_at(F.array(*[F.lit(int(w)) for w in ways]), (F.col("cell") + 1).cast("int"))
    cells = index.withColumn("cell", F.col("cell") * (1 << 32) + F.pmod(F.xxhash64("id"), ways_of))
    wanted = whole_vectors(table.filter(queries), id_col, vector_col, scale).filter(F.col("id") != NULL_ID)
    wanted = wanted.mapInArrow(lambda b: _keyed(b, first), INDEX).select("id", "vec").distinct()

    def meet(asked: DataFrame, radii: bool, types: str) -> DataFrame:
        both = cells.unionByName(asked).repartition("cell").sortWithinPartitions("cell", "asked", "at")
        return both.mapInArrow(lambda b: _scan(b, shared, k, radii), types)
    radii = settle(meet(wanted.mapInArrow(lambda b: _first_cell(b, shared), INDEX), True, "id long, vec binary, radius double"), "radii")
    best = meet(radii.mapInArrow(lambda b: _all_cells(b, shared), INDEX), False, "query long, vec binary, id long, score long")
    ranked = best.groupBy("query", "vec").agg(
        F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("score"), F.col("id").alias("id")))), 1, k).alias("best"))
    id_type = table.schema[id_col].dataType
    exploded = ranked.select("query", F.posexplode("best").alias("rank", "x"))
    own = lambda c: F.when(c != NULL_ID, c).cast(id_type)
    return exploded.select(own(F.col("query")).alias("query_id"), (F.col("rank") + 1).cast("int").alias("rank"),
                           own(F.col("x.id")).alias(id_col), (-F.col("x.score")).alias("score"))
