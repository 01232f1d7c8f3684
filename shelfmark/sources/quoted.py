"""CSV whose quoted cells hold line breaks, read in splits of files.

Whether a line begins inside a quoted cell depends on all lines before it. A
line is therefore taken as a step from one state (outside or inside a cell) to
another; steps are followed within each split, then over the splits of a file,
which are one row each. So a file is the work of as many tasks as it has splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfmark.operators.settle import settle

# Ends inside a quoted cell, for a text that begins outside one: a cell is quoted
# only if its first character is a quote, and a doubled quote doesn't end it.
QUOTED_TEXT = r'"(?:[^"]++|"")*+'
ENDS_INSIDE = rf'\A(?:(?:[^",][^,]*+|{QUOTED_TEXT}"[^,]*+)?+,)*+{QUOTED_TEXT}\z'

SPLIT = ["_file", "_split"]


def states_after(df: DataFrame, part: list[str], order: str) -> DataFrame:
    """State after each row of a part, by the state the part begins in.

    ``_from_out`` and ``_from_in`` tell of each row whether it ends inside when
    it begins outside, or inside. Where both agree the row settles the state;
    else it keeps it or turns it. So the state is that of the last settling row,
    turned as often as rows have turned it since.
    """
    so_far = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    turned = F.sum((F.col("_from_out") & ~F.col("_from_in")).cast("bigint")).over(so_far)
    settling = F.when(F.col("_from_out") == F.col("_from_in"), F.struct(F.col("_from_out").alias("inside"), F.col("_turns").alias("turns")))
    odd = (F.col("_turns") - F.coalesce(F.col("_settled.turns"), F.lit(0))) % 2 == 1
    return (df.withColumn("_turns", turned)
            .withColumn("_settled", F.last(settling, ignorenulls=True).over(so_far))
            .withColumns({f"_after_{name}": F.coalesce("_settled.inside", F.lit(begins)) != odd
                          for name, begins in (("out", False), ("in", True))})
            .drop("_turns", "_settled", "_from_out", "_from_in"))


def split_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place in the split (``_at``, from 1), and the state before and after each, by the split's first state."""
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.regexp_replace("value", r"\r\z", "").alias("_line"), F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_id")))
    steps = lines.withColumns({"_from_out": F.col("_line").rlike(ENDS_INSIDE),
                               "_from_in": F.concat(F.lit('"'), "_line").rlike(ENDS_INSIDE)})
    order = Window.partitionBy(*SPLIT).orderBy("_id")
    return (states_after(steps, SPLIT, "_id")
            .withColumns({"_at": F.row_number().over(order).cast("bigint"),
                          "_before_out": F.lag("_after_out", 1, False).over(order),
                          "_before_in": F.lag("_after_in", 1, True).over(order)}))


def splits_of(lines: DataFrame) -> DataFrame:
    """One row per split: state and lines before it, and the line at which the record open there begins."""
    ends = lines.groupBy(*SPLIT).agg(
        F.count("*").alias("_lines"),
        *[F.max_by(f"_after_{name}", "_at").alias(f"_from_{name}") for name in ("out", "in")],
        *[F.max(F.when(~F.col(f"_before_{name}"), F.col("_at"))).alias(f"_last_{name}") for name in ("out", "in")])
    order = Window.partitionBy("_file").orderBy("_split")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return (states_after(ends, ["_file"], "_split")
            .withColumns({"_inside": F.lag("_after_out", 1, False).over(order),
                          "_skipped": F.coalesce(F.sum("_lines").over(before), F.lit(0))})
            .withColumn("_begins", F.col("_skipped") + by_state("_last"))
            .withColumn("_open_at", F.last("_begins", ignorenulls=True).over(before))
            .select(*SPLIT, "_inside", "_skipped", "_open_at"))


def by_state(name: str) -> Column:
    """The column that holds for the state the split begins in."""
    return F.when(F.col("_inside"), F.col(f"{name}_in")).otherwise(F.col(f"{name}_out"))


def joined_lines(order: str, text: str) -> Column:
    pieces = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return F.array_join(F.transform(pieces, lambda p: p["t"]), "\n").alias("_record")


def records(spark: SparkSession, path: str) -> DataFrame:
    """Records as text: ``_file``, ``_place`` (its first line in the file, from 1), ``_record``.

    The files are read twice: for the states, which are a few bytes a line, and
    for the text, which is shuffled once, by split. Lines are put together
    within their split; only records that go over its edge, at most two pieces
    a split, are shuffled again. A cell's line breaks become ``\\n``. A quote
    that is never closed makes the rest of its file one record.
    """
    edges = settle(splits_of(split_lines(spark, path)), "splits")
    order = Window.partitionBy(*SPLIT).orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    numbered = split_lines(spark, path).withColumns(
        {f"_number_{name}": F.sum((~F.col(f"_before_{name}")).cast("bigint")).over(order) for name in ("out", "in")})
    lines = numbered.join(edges, SPLIT).withColumns({"_number": by_state("_number"), "_after": by_state("_after")})
    pieces = lines.groupBy(*SPLIT, "_number").agg(
        joined_lines("_at", "_line"), F.max_by("_after", "_at").alias("_goes_on"),
        F.min(F.when(F.col("_number") == 0, F.col("_open_at")).otherwise(F.col("_skipped") + F.col("_at"))).alias("_place"))
    cut = (F.col("_number") == 0) | F.col("_goes_on")
    pieces = settle(pieces.select(*SPLIT, "_place", "_record", cut.alias("_cut")), "records")
    over_edges = pieces.filter("_cut").groupBy("_file", "_place").agg(joined_lines("_split", "_record"))
    whole = pieces.filter("NOT _cut").select("_file", "_place", "_record")
    return whole.unionByName(over_edges).filter(F.trim("_record") != "")
