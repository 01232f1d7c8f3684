"""Lookups where one key holds a third of the rows."""

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import skew
from shelfmark.operators.settle import settle
from shelfmark.plans import reports

ROWS = 60_000


@pytest.fixture
def plain_joins(spark):
    """Eight partitions as they are shuffled: no broadcast by size, nothing split or merged at run time."""
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def rows(spark):
    """A third with key 1, a sixth without key, the rest over 5,000 keys, 500 of which the lookup lacks."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 6 == 1, F.lit(None)).otherwise(F.col("id") % 5000)
    return settle(spark.range(ROWS).select(F.col("id").alias("row_id"), key.cast("bigint").alias("key")), "skewed")


@pytest.fixture(scope="module")
def lookup(spark):
    return settle(spark.range(4500).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name")), "names")


def loads(df):
    """Rows in each of the join's partitions."""
    counts = df.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    return sorted(r["count"] for r in counts)


def test_a_sketch_finds_every_hot_key(rows):
    hot = {r["key"]: r["_salts"] for r in skew.hot_keys(skew.key_sketch(rows, ["key"], 64), "key", 64).collect()}
    values = rows.filter("key IS NOT NULL").count()
    assert set(hot) == {1} and hot[1] >= rows.filter("key = 1").count() * 64 // values


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_rows_match_as_in_a_plain_join(rows, lookup, how):
    sketch = skew.key_sketch(rows, ["key"], 64)
    got = skew.spread_lookup(rows, lookup, "key", "row_id", sketch, how, 64)
    want = rows.join(lookup, "key", how)
    assert got.columns == want.columns and got.count() == want.count()
    assert got.exceptAll(want).isEmpty()


def test_no_partition_holds_twice_the_median(rows, lookup, plain_joins):
    even = loads(skew.spread_lookup(rows, lookup, "key", "row_id", skew.key_sketch(rows, ["key"])))
    plain = loads(rows.join(lookup, "key", "left"))
    assert len(even) == 8 and even[-1] <= 2 * even[4]
    assert plain[-1] > 2 * plain[4]


def test_copies_of_the_lookup_are_bounded(rows, lookup):
    hot = skew.hot_keys(skew.key_sketch(rows, ["key"], 64), "key", 64)
    assert hot.agg(F.sum("_salts")).first()[0] <= 2 * 64


def test_tables_without_rows_or_keys(spark, rows, lookup):
    for some in (rows.limit(0), rows.filter("key IS NULL")):
        out = skew.spread_lookup(some, lookup, "key", "row_id", skew.key_sketch(some, ["key"]))
        assert out.count() == some.count() and out.filter("name IS NOT NULL").isEmpty()


def test_reports_spread_the_unknown_author(spark, plain_joins):
    """R4, R8 and R21: the plan joins by key and salt, and the last join of R4 is even."""
    bridge = settle(spark.range(ROWS).select(
        F.col("id").alias("author_isbn_id"), (F.col("id") % 20_000).alias("book_isbn_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7000).cast("bigint").alias("author_id"),
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 12).cast("bigint").alias("role_id")), "bridge")
    t = {
        "author_isbn": bridge,
        "author": settle(spark.range(7000).select(F.col("id").alias("author_id"), F.concat(F.lit("a"), "id").alias("full_name"))),
        "role": settle(spark.range(11).select(F.col("id").alias("role_id"), F.concat(F.lit("r"), "id").alias("role"))),
        "book": settle(spark.range(20_000).select(F.col("id").alias("book_id"), F.lit("t").alias("title"))),
        "format": settle(spark.range(3).select(F.col("id").alias("format_id"), F.lit("f").alias("format"))),
        "book_isbn": settle(spark.range(20_000).select(
            F.col("id").alias("book_isbn_id"), F.col("id").alias("book_id"), F.col("id").cast("string").alias("isbn13"),
            (F.col("id") % 3).alias("format_id"), (F.col("id") % 5 == 0).alias("is_boxset"))),
    }
    contributors = reports.contributors(t)
    even = loads(contributors)
    assert contributors.count() == ROWS and len(even) == 8 and even[-1] <= 2 * even[4]
    sales = t["book_isbn"].select("isbn13", F.lit(1).alias("month"))
    for report, n in ((reports.box_sets(t), ROWS // 5), (reports.raw_sales_listing(sales, t), ROWS)):
        assert "_salt" in report._jdf.queryExecution().executedPlan().toString() and report.count() == n
