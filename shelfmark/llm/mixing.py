"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is wanted target / source size times, a whole number
of copies and a fraction. Fractions are settled in pairs: words of expectation
move at random from one document to the other, until one fraction is 0 or 1;
the other goes on. The words expected from a source stay exactly the same
through all steps, so the result misses the target by less than the document
left at the end. Pairs are settled in groups of bounded size, and what each
group has left is settled in a tree over the groups.
"""

from __future__ import annotations

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.llm.common import NULL_ID, WORD, column_name, id_or_last
from shelfmark.operators.settle import settle

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
#: Documents of one source settled by one task's call, and groups whose rests meet in the next level.
GROUP_ROWS = 2_048
FAN_IN = 64
EXACT = 1e-9


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """(source, source_size, documents, target) from one row for each source.

    Sources in code point order, null last, have the weights in turn and share
    the sum of all sizes; a target stops at ``most`` times its source's size,
    and the others share the rest by weight: each gets level * weight. The
    level is found from running sums over the sources in the order in which
    they are filled; both windows run over one row for each source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(most))
    fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
                           / F.sum("weight").over(after))
    rows = rows.withColumn("level", F.max(F.when(F.col("level") <= F.col("most") / F.col("weight"), F.col("level"))).over(everything))
    return rows.select("source", "source_size", "documents",
                       F.least("most", F.col("level") * F.col("weight")).alias("target"))


def _draw(seed: int, level: int, a: int, b: int) -> float:
    return xxhash.xxh64_intdigest(f"{level}:{a}:{b}", seed & (2**64 - 1)) / 2**64


def settle_pairs(ids: list[int], sizes: list[int], shares: list[float], level: int, seed: int,
                 last: bool) -> list[float]:
    """Fractions of copies, each 0 or 1 but for one at most; with ``last`` that one is drawn too.

    In each pair ``size * fraction`` summed over both stays the same, and the
    expectation of each fraction too.
    """
    out = list(shares)
    held = None
    for i, share in enumerate(out):
        if share < EXACT or share > 1 - EXACT:
            out[i] = float(round(share))
            continue
        if held is None:
            held = i
            continue
        a, b = sizes[held], sizes[i]
        up = min(a * (1 - out[held]), b * out[i])     # words that can move to the held one
        down = min(a * out[held], b * (1 - out[i]))   # and from it
        moved = up if _draw(seed, level, ids[held], ids[i]) * (up + down) < down else -down
        for at, now in ((held, out[held] + moved / a), (i, out[i] - moved / b)):
            out[at] = float(round(now)) if now < EXACT or now > 1 - EXACT else now
        open_ = [at for at in (held, i) if 0 < out[at] < 1]
        held = open_[0] if open_ else None
    if last and held is not None:
        out[held] = float(_draw(seed, level, ids[held], ids[held]) < out[held])
    return out


def _settler(level: int, seed: int, last: bool):
    def settled(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "id"], ascending=[False, True], kind="stable")
        return group.assign(share=settle_pairs(
            group["id"].tolist(), group["size"].tolist(), group["share"].tolist(), level, seed, last))
    return settled


def copies(documents: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
           weights: tuple[int, ...] = WEIGHTS, most: float = MOST_COPIES, seed: int = 7) -> DataFrame:
    """(``id_col``, size, source_size, target, copies, taken) for every row; ``taken`` is size * copies.

    A null or blank text has size 0 and gives no words; its copies are the
    expected number, rounded at random by its id. A source without words has
    target 0. Null sources are one source. No document is taken more than
    ``most`` times (rounded up). Draws depend on ids, sizes and the seed alone,
    so reruns and other partitionings agree. Rows that share an id, or have
    none, are documents of their own: their draws depend on their place in the
    stored sizes too, so that any number of them is spread over groups. An empty
    table gives an empty result.
    """
    id_type = documents.schema[id_col].dataType
    rows = settle(documents.select(id_or_last(id_col).alias("own_id"), F.col(source_col).alias("source"),
                                   n_words(F.col(text_col)).alias("size")).withColumn("place", F.monotonically_increasing_id()), "sizes")
    shared = settle(rows.groupBy("own_id").count().filter("count > 1").select("own_id", F.lit(True).alias("shared")), "shared-ids")
    alone = F.col("own_id") if shared.isEmpty() else F.when(F.col("shared"), F.xxhash64("own_id", "place")).otherwise(F.col("own_id"))
    if not shared.isEmpty():
        rows = rows.join(shared, "own_id", "left")
    rows = rows.select("own_id", "source", "size", alone.alias("id"))
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    wanted = targets(totals, weights, most).withColumn("source_", F.col("source")).drop("source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    lot = F.pmod(F.xxhash64("id", "size", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    share = rate - F.floor(rate)
    ways = F.ceil(F.col("documents") / GROUP_ROWS)
    rows = (rows.join(wanted, F.col("source").eqNullSafe(F.col("source_")), "left").drop("source_")
            .withColumn("whole", F.floor(rate).cast("double"))
            .withColumn("share", F.when(F.col("size") > 0, share).otherwise((lot < share).cast("double")))
            .withColumn("cell", F.pmod(F.xxhash64("id", F.lit(seed + 1)), ways)).drop("documents"))
    groups = -(-(totals.agg(F.max("documents")).first()[0] or 0) // GROUP_ROWS)
    decided, left, level = [], rows, 0
    while True:
        last = groups <= 1
        done = settle(left.groupBy("source", "cell").applyInPandas(_settler(level, seed, last), left.schema), "mix")
        whole = (F.col("share") == 0) | (F.col("share") == 1)
        decided.append(done.filter(whole))
        if last:
            break
        left = done.filter(~whole).withColumn("cell", F.floor(F.col("cell") / FAN_IN).cast("long"))
        groups, level = -(-groups // FAN_IN), level + 1
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    n = (F.col("whole") + F.col("share")).cast("long")
    return out.select(F.when(F.col("own_id") != NULL_ID, F.col("own_id")).cast(id_type).alias(id_col), "size", "source_size",
                      F.col("target").cast("double").alias("target"), n.alias("copies"), (n * F.col("size")).alias("taken"))


def mixed(documents: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
          weights: tuple[int, ...] = WEIGHTS, most: float = MOST_COPIES, seed: int = 7) -> DataFrame:
    """The documents, each as often as the mix takes it, with all their columns.

    Rows that share an id, or have none, are documents of their own: the table
    is then written once with a number for each row, and mixed by that.
    """
    id_name, n_name = column_name(documents, "mixed_id"), column_name(documents, "mixed_copies")
    rows, by = documents, id_col
    if not documents.groupBy(F.col(id_col).alias(id_name)).count().filter("count > 1").isEmpty():
        by = column_name(documents, "mixed_row")
        rows = settle(documents.withColumn(by, F.monotonically_increasing_id()), "rows")
    each = (copies(rows, by, source_col, text_col, weights, most, seed)
            .select(F.col(by).alias(id_name), F.col("copies").alias(n_name)).filter(F.col(n_name) > 0))
    taken = rows.join(each, F.col(by).eqNullSafe(F.col(id_name)))
    return taken.withColumn(n_name, F.explode(F.sequence(F.lit(1), F.col(n_name).cast("int")))).select(*documents.columns)
