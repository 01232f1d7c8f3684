"""Generic relational operators over the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from queries import duck
from queries.registry import query
from shelfmark.functions import dates, formats, names, numbers
from shelfmark.functions.text import first_match
from shelfmark.operators import aggregates, dedup, joins, keys, sets
from shelfmark.operators.skew import salted_lookup
from shelfmark.sources import tables

MONEY = "decimal(12,2)"


def money(c: str):
    return F.col(c).cast(MONEY)


# Predicates, projections, scans

@query("s6_preview", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 100""")
def _(t):
    return tables.preview(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"),
                          [F.desc("o_orderdate"), F.asc("o_orderkey")], 100)


@query("s7_table_round_trip", "SELECT o_orderpriority, count(*) AS n, sum(o_orderkey) AS key_sum FROM orders GROUP BY 1")
def _(t):
    import uuid
    from shelfmark.operators.settle import shared_folder
    store = tables.TableStore(t.spark, f"{shared_folder(t.spark)}/store-{uuid.uuid4().hex}")
    store.publish({"orders": t.orders.limit(0)})
    store.publish({"orders": t.orders})
    return store.read("orders").groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query("f7_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%red%'")
def _(t):
    return t.part.filter(F.col("p_name").like("%red%")).select("p_partkey", "p_name")


@query("f8_negated_regex", "SELECT p_partkey, p_brand FROM part WHERE NOT regexp_full_match(p_brand, 'Brand#[0-9]')")
def _(t):
    return t.part.filter(~F.col("p_brand").rlike(r"\ABrand#[0-9]\z")).select("p_partkey", "p_brand")


@query("f9_predicates", """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_custkey IS NOT NULL""")
def _(t):
    return t.orders.filter((F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
                           & (F.col("o_orderdate") >= F.lit(dt.datetime(1997, 1, 1)))
                           & F.col("o_custkey").isNotNull()).select("o_orderkey", "o_orderdate")


@query("f10_head", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 10")
def _(t):
    return tables.preview(t.customer.select("c_custkey", "c_name"), [F.asc("c_custkey")], 10)


# Columns

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


@query("c23_genre_columns", "SELECT p_partkey, " + ", ".join(
    f"nullif(trim(replace(string_split(p_name || ', ' || p_type || ',it''s', ',')[{i}], '''', '')), '') AS genre_{i}"
    for i in range(1, 11)) + " FROM part")
def _(t):
    from shelfmark.functions.genres import genre_columns
    listed = t.part.withColumn("g", F.array(F.concat("p_name", F.lit(", "), "p_type"), F.lit("it's")))
    return listed.select("p_partkey", *[c.alias(n) for n, c in genre_columns(F.col("g")).items()])


@query("c24_month_number", """
SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE concat('', month(o_orderdate)) END AS month_number FROM orders""")
def _(t):
    named = F.when(F.col("o_orderkey") % 13 == 0, F.month("o_orderdate").cast("string")).otherwise(
        F.concat(F.lit(" "), F.date_format("o_orderdate", "MMM"), F.lit(" ")))
    return t.orders.select("o_orderkey", dates.month_number(named).alias("month_number"))


@query("c25_strip_currency", "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(10,2)) AS amount FROM orders")
def _(t):
    shown = F.concat(F.lit(" $"), F.format_number("o_totalprice", 2))
    return t.orders.select("o_orderkey", numbers.strip_currency(shown).alias("amount"))


FORMATS = ["hardcover", "ebook", "audio", "board_book", "mass_market_paperback", "paperback", "comic"]


@query("c26_bestseller_category", "SELECT p_partkey, " + duck.case(
    [(f"p_partkey % 8 = {i}", duck.category(duck.lit(f))) for i, f in enumerate(FORMATS)], "'Best Paperback'")
    + " AS category FROM part")
def _(t):
    picked = first_match([(F.col("p_partkey") % 8 == i, F.lit(f)) for i, f in enumerate(FORMATS)],
                         otherwise=F.lit(None).cast("string"))
    return t.part.withColumn("f", picked).select("p_partkey", formats.bestseller_category(F.col("f")).alias("category"))


@query("c27_casts", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, CAST(o_totalprice AS DECIMAL(10,2)) AS price,
       CAST(substring(o_orderpriority, 1, 1) AS INT) AS priority, o_orderstatus = 'O' AS is_open FROM orders""")
def _(t):
    return t.orders.select(
        "o_orderkey", F.to_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("price"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        numbers.flag(F.col("o_orderstatus"), "O").alias("is_open"))


@query("c28_all_authors", """
SELECT p_partkey, concat_ws(', ', p_name, nullif(p_type, 'SMALL'), p_brand) AS all_names FROM part""")
def _(t):
    return t.part.select("p_partkey", names.all_authors(
        F.col("p_name"), F.nullif("p_type", F.lit("SMALL")), F.col("p_brand")).alias("all_names"))


@query("c29_null_propagating_concat", """
SELECT p_partkey, 'Book Updated from ' || p_name || ' to ' || nullif(p_type, 'SMALL') AS message FROM part""")
def _(t):
    return t.part.select("p_partkey", F.concat(F.lit("Book Updated from "), "p_name", F.lit(" to "),
                                               F.nullif("p_type", F.lit("SMALL"))).alias("message"))


@query("c30_guarded_ratio", """
SELECT l_orderkey, round(CAST(sum(CAST(l_quantity AS INT)) AS DOUBLE) / nullif(sum(l_linenumber - 1), 0), 2) AS ratio
FROM lineitem GROUP BY 1""")
def _(t):
    sums = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(F.col("l_quantity").cast("int")).alias("a"), F.sum(F.col("l_linenumber") - 1).alias("b"))
    return sums.select("l_orderkey", F.round(numbers.guarded_ratio(F.col("a"), F.col("b")), 2).cast("double").alias("ratio"))


# Duplicate removal

@query("d1_first_document_per_text", """
SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text""")
def _(t):
    return dedup.first_per_key(t.documents.select("doc_id", "text"), ["text"], ["doc_id"]).select("text", "doc_id")


@query("d3_first_document_per_source_lang", """
SELECT source, lang, min(doc_id) AS doc_id FROM documents GROUP BY ALL""")
def _(t):
    return dedup.first_per_key(t.documents.select("doc_id", "source", "lang"), ["source", "lang"], ["doc_id"])


@query("d4_distinct_on", """
SELECT l_orderkey, arg_min(l_partkey, l_partkey * 100 + l_linenumber) AS l_partkey FROM lineitem GROUP BY 1""")
def _(t):
    lines = t.lineitem.withColumn("_pos", F.col("l_partkey") * 100 + F.col("l_linenumber"))
    return dedup.first_value_per_key(lines, "l_orderkey", "l_partkey", "_pos")


@query("d5_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def _(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


# Keys

@query("k1_part_identifier", """
WITH f AS (SELECT p_name || '-' || p_brand AS key, min(p_partkey) AS first, count(*) AS n FROM part GROUP BY 1),
u AS (SELECT key, n, row_number() OVER (ORDER BY first) AS uid FROM f)
SELECT p_partkey, key AS book_key, uid AS book_uid, n AS edition_count, CAST(n > 1 AS INT) AS has_multiple_editions
FROM part JOIN u ON key = p_name || '-' || p_brand""")
def _(t):
    named = t.part.withColumnsRenamed({"p_name": "title_norm", "p_brand": "primary_author_name"})
    return keys.book_identifier(named, "p_partkey").select(
        "p_partkey", "book_key", "book_uid", "edition_count", "has_multiple_editions")


@query("k3_assign_ids", """
SELECT o_orderkey, 1000 + row_number() OVER (ORDER BY o_orderkey) AS id FROM orders""")
def _(t):
    return keys.assign_ids(t.orders.select("o_orderkey"), "id", ["o_orderkey"], start_after=1000)


@query("k3_assign_ids_sorted", """
SELECT p_name, row_number() OVER (ORDER BY p_name) AS id FROM (SELECT DISTINCT p_name FROM part)""")
def _(t):
    return keys.assign_ids_sorted(t.part.select("p_name").distinct(), "id", ["p_name"])


@query("k3_restart_above_max", """
SELECT s_suppkey, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey) AS id FROM supplier""")
def _(t):
    return keys.assign_ids(t.supplier.select("s_suppkey"), "id", ["s_suppkey"], keys.max_id(t.customer, "c_custkey"))


# Joins

@query("j1_inner_join", """
SELECT o_orderkey, c_name, l_partkey, l_quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey""")
def _(t):
    return (t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
            .join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
            .select("o_orderkey", "c_name", "l_partkey", "l_quantity"))


@query("j2_lookup_chain", """
SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey""")
def _(t):
    nations = t.nation.withColumnRenamed("n_nationkey", "c_nationkey")
    regions = t.region.withColumnRenamed("r_regionkey", "n_regionkey")
    rows = t.customer.select("c_custkey", "c_nationkey").join(nations, "c_nationkey", "left")
    return rows.join(regions, "n_regionkey", "left").select("c_custkey", "n_name", "r_name")


@query("j2_salted_lookup", """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, n AS rows_of_flag FROM lineitem
LEFT JOIN (SELECT l_returnflag AS f, count(*) AS n FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1) ON f = l_returnflag""")
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    counts = lines.filter("l_returnflag <> 'N'").groupBy("l_returnflag").agg(F.count("*").alias("rows_of_flag"))
    return salted_lookup(lines, counts, "l_returnflag", "rows_of_flag", spread="l_orderkey", hot_rows=1000)


@query("j3_composite_key", """
SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, id, count(*) AS n FROM orders JOIN (
SELECT y, m, row_number() OVER (ORDER BY y, m) AS id FROM
(SELECT DISTINCT year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders)) d ON y = year(o_orderdate) AND m = month(o_orderdate)
GROUP BY ALL""")
def _(t):
    from shelfmark.plans.warehouse import init_month_year_dim
    dated = t.orders.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    dim = init_month_year_dim(dated)
    return dated.join(dim, ["year", "month"]).groupBy(
        F.col("year").alias("y"), F.col("month").alias("m"), F.col("month_year_dim_id").alias("id")).agg(F.count("*").alias("n"))


@query("j4_either_key_join", """
SELECT o_orderkey, c_custkey FROM orders JOIN customer ON o_custkey = c_custkey OR o_orderkey = c_custkey * 7""")
def _(t):
    right = t.customer.select("c_custkey", (F.col("c_custkey") * 7).alias("seventh"))
    left = t.orders.select("o_orderkey", "o_custkey")
    return joins.either_key_join(left, right, [("o_custkey", "c_custkey"), ("o_orderkey", "seventh")]).select(
        "o_orderkey", "c_custkey")


SLOTS = [f"s{i}" for i in range(1, 6)]

SUPPLIER_SLOTS = """
WITH r AS (SELECT l_orderkey, l_suppkey, l_quantity,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem),
w AS (SELECT l_orderkey, max(CASE WHEN rn = 1 THEN l_suppkey END) AS s1, max(CASE WHEN rn = 2 THEN l_suppkey END) AS s2,
  max(CASE WHEN rn = 3 THEN l_suppkey END) AS s3, max(CASE WHEN rn = 4 THEN l_suppkey END) AS s4,
  max(CASE WHEN rn = 5 THEN l_suppkey END) AS s5, CAST(sum(l_quantity) AS BIGINT) AS units FROM r GROUP BY 1)"""


def supplier_slots(t):
    """Up to five suppliers per order as columns, ranked by line."""
    from pyspark.sql import Window
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    ranked = (t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
              .withColumn("rn", F.row_number().over(order)).filter("rn <= 5"))
    units = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").cast("bigint").alias("units"))
    return joins.pivot_ranks(ranked, ["l_orderkey"], "rn", "l_suppkey", SLOTS).join(units, "l_orderkey")


@query("w1_g10_ranked_pivot", SUPPLIER_SLOTS + " SELECT * FROM w")
def _(t):
    return supplier_slots(t)


@query("j5_membership_join", SUPPLIER_SLOTS + """
SELECT l_orderkey, s_suppkey, units FROM w JOIN supplier ON s_suppkey IN (s1, s2, s3, s4, s5)""")
def _(t):
    return joins.membership_join(supplier_slots(t), t.supplier.select("s_suppkey"), SLOTS, "s_suppkey").select(
        "l_orderkey", "s_suppkey", "units")


@query("j6_same_lookup_five_times", SUPPLIER_SLOTS + " SELECT l_orderkey, " + ", ".join(
    f"n{i}.s_name AS name_{i}" for i in range(1, 6)) + " FROM w " + " ".join(
    f"LEFT JOIN supplier n{i} ON n{i}.s_suppkey = s{i}" for i in range(1, 6)))
def _(t):
    wanted = {s: f"name_{i}" for i, s in enumerate(SLOTS, 1)}
    return joins.slots_lookup(supplier_slots(t), "l_orderkey", wanted, t.supplier, "s_suppkey", "s_name").select(
        "l_orderkey", *wanted.values())


EVENT_CLASS = {"view": 1, "click": 2, "purchase": 3, "signup": 4, "error": 5}

EVENT_COUNTS = "WITH e AS (SELECT user_id AS book_isbn_id, " + duck.case(
    [(f"event_type = '{k}'", str(v)) for k, v in EVENT_CLASS.items()], "0") + """ AS review_type_id, count(*) AS count
FROM events GROUP BY ALL)"""


def event_counts(t):
    types = first_match([(F.col("event_type") == k, F.lit(v)) for k, v in EVENT_CLASS.items()], otherwise=F.lit(0))
    return t.events.groupBy(F.col("user_id").alias("book_isbn_id"), types.alias("review_type_id")).agg(
        F.count("*").alias("count"))


@query("j7_rating_pivot", EVENT_COUNTS + " SELECT book_isbn_id, " + ", ".join(
    f"max(CASE WHEN review_type_id = {i} THEN count END) AS count_{i}" for i in range(1, 6)) + " FROM e GROUP BY 1")
def _(t):
    return joins.rating_pivot(event_counts(t))


@query("g11_average_rating", EVENT_COUNTS + """
SELECT b.book_isbn_id, CAST(CAST(f5.count * 5 + f4.count * 4 + f3.count * 3 + f2.count * 2 + f1.count AS DECIMAL(18,6))
 / nullif(f5.count + f4.count + f3.count + f2.count + f1.count, 0) AS DECIMAL(3,2)) AS avg_rating
FROM (SELECT DISTINCT book_isbn_id FROM e) b
LEFT JOIN e f5 ON f5.book_isbn_id = b.book_isbn_id AND f5.review_type_id = 1
LEFT JOIN e f4 ON f4.book_isbn_id = b.book_isbn_id AND f4.review_type_id = 2
LEFT JOIN e f3 ON f3.book_isbn_id = b.book_isbn_id AND f3.review_type_id = 3
LEFT JOIN e f2 ON f2.book_isbn_id = b.book_isbn_id AND f2.review_type_id = 4
LEFT JOIN e f1 ON f1.book_isbn_id = b.book_isbn_id AND f1.review_type_id = 5""")
def _(t):
    return joins.average_ratings(event_counts(t))


@query("j8_missing_rows", """
SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = o_custkey)""")
def _(t):
    there = t.supplier.select(F.col("s_suppkey").alias("o_custkey"))
    return joins.missing_rows(t.orders.select("o_orderkey", "o_custkey"), there, ["o_custkey"])


@query("j9_update_from", """
SELECT c_custkey, c_name, coalesce(p, c_mktsegment) AS c_mktsegment FROM customer LEFT JOIN
(SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS p FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def _(t):
    source = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("c_mktsegment"), "o_orderkey")
    return joins.update_from(t.customer.select("c_custkey", "c_name", "c_mktsegment"), source, "c_custkey",
                             ["c_mktsegment"], "o_orderkey")


@query("j10_group_count_on_rows", """
SELECT o_orderkey, n AS orders_of_customer FROM orders JOIN (SELECT o_custkey AS c, count(*) AS n FROM orders GROUP BY 1)
ON c = o_custkey""")
def _(t):
    per_customer = t.orders.groupBy("o_custkey").agg(F.count("*").alias("orders_of_customer"))
    return salted_lookup(t.orders.select("o_orderkey", "o_custkey"), per_customer, "o_custkey",
                         "orders_of_customer", spread="o_orderkey").select("o_orderkey", "orders_of_customer")


# Aggregations

@query("g1_global_totals", """
SELECT count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total,
 CAST(round(avg(CAST(o_totalprice AS DECIMAL(12,2))), 2) AS DECIMAL(10,2)) AS avg_price FROM orders""")
def _(t):
    return t.orders.agg(F.count("*").alias("n"), F.sum(money("o_totalprice")).alias("total"),
                        F.avg(money("o_totalprice")).cast("decimal(10,2)").alias("avg_price"))


@query("g2_group_totals", """
SELECT l_returnflag, l_linestatus, sum(CAST(l_quantity AS DECIMAL(12,2))) AS units,
 round(avg(CAST(l_discount AS DECIMAL(12,2))), 4) AS avg_discount, count(*) AS n FROM lineitem GROUP BY ALL""")
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(money("l_quantity")).alias("units"),
        F.round(F.avg(money("l_discount")).cast("double"), 4).alias("avg_discount"), F.count("*").alias("n"))


@query("g3_grouped_distinct", """
SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1""")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_orderkey").alias("orders"))


@query("g4_distinct_tuples", """
SELECT count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT (l_suppkey, nullif(l_linenumber, 1))) AS pairs FROM lineitem""")
def _(t):
    lines = t.lineitem.withColumn("ln", F.nullif("l_linenumber", F.lit(1)))
    return lines.agg(F.count_distinct("l_suppkey").alias("suppliers"),
                     aggregates.distinct_tuples(["l_suppkey", "ln"]).alias("pairs"))


@query("g5_null_profile", """
SELECT count(*) AS total_records, count(nullif(p_type, 'SMALL')) AS has_t, count(nullif(p_brand, 'Brand#2')) AS has_b FROM part""")
def _(t):
    return aggregates.null_profile(t.part.select(F.nullif("p_type", F.lit("SMALL")).alias("t"),
                                                 F.nullif("p_brand", F.lit("Brand#2")).alias("b")), ["t", "b"])


@query("g6_conditional_counts", """
SELECT count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) FILTER (WHERE value > 10) AS big,
 count(*) FILTER (WHERE user_id % 2 = 0) AS even_users FROM events""")
def _(t):
    return aggregates.conditional_counts(t.events, {
        "clicks": F.col("event_type") == "click", "big": F.col("value") > 10, "even_users": F.col("user_id") % 2 == 0})


@query("g7_having", """
SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total FROM orders GROUP BY 1
HAVING sum(CAST(o_totalprice AS DECIMAL(12,2))) > 2000000""")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("total")).filter("total > 2000000")


@query("g8_distinct_versions", "SELECT source, lang FROM documents GROUP BY source, lang")
def _(t):
    return t.documents.select("source", "lang").distinct()


@query("g9_value_counts_priority", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return dedup.value_counts(t.orders, "o_orderpriority")


@query("g12_maximum", "SELECT max(o_orderdate) AS last_date, max(o_orderkey) AS top FROM orders")
def _(t):
    return t.orders.agg(F.max("o_orderdate").alias("last_date"), F.max("o_orderkey").alias("top"))


# Windows, order, sets

@query("w1_row_number", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
 row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS place
FROM lineitem""")
def _(t):
    from pyspark.sql import Window
    order = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                             F.row_number().over(order).alias("place"))


@query("o1_ordered_with_nulls", """
SELECT p_partkey, nullif(p_type, 'SMALL') AS kind FROM part ORDER BY kind DESC NULLS FIRST, p_partkey""")
def _(t):
    return t.part.select("p_partkey", F.nullif("p_type", F.lit("SMALL")).alias("kind")).orderBy(
        F.desc_nulls_first("kind"), "p_partkey")


@query("o2_top_k", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def _(t):
    return tables.preview(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 20)


@query("u1_distinct_over_columns", """
SELECT word, row_number() OVER (ORDER BY min(seen)) AS id FROM (
 SELECT p_type AS word, p_partkey * 64 AS seen FROM part UNION ALL SELECT p_brand, p_partkey * 64 + 1 FROM part
 UNION ALL SELECT p_name, p_partkey * 64 + 2 FROM part) GROUP BY word""")
def _(t):
    seen = sets.distinct_by_appearance(sets.slot_values(t.part, ["p_type", "p_brand", "p_name"], "word", "p_partkey"), "word")
    return keys.assign_ids(seen, "id", ["_seen"]).select("word", "id")


@query("u2_concat_rows", """
SELECT s_name AS name, s_nationkey AS nation FROM supplier UNION ALL SELECT c_name, c_nationkey FROM customer""")
def _(t):
    return t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")).unionByName(
        t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")))


@query("u3_fixed_rows_join", EVENT_COUNTS + """
SELECT review_type, sum(count) AS n FROM e JOIN (VALUES (1, '5_star'), (2, '4_star'), (3, '3_star'), (4, '2_star'), (5, '1_star'))
 AS v(id, review_type) ON id = review_type_id GROUP BY 1""")
def _(t):
    from shelfmark.plans.normalise import build_review_type
    types = F.broadcast(build_review_type(t.spark))
    return event_counts(t).join(types, "review_type_id").groupBy("review_type").agg(F.sum("count").alias("n"))
