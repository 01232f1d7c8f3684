"""Tables in ranges of keys: what a change leaves alone."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.settle import settle, shared_folder
from shelfmark.plans import constraints, deletions, monthly, snapshot
from shelfmark.sources import tables
from shelfmark.sources.tables import WHOLE, StagedTables, TableStore

FIRST, LATER = dt.datetime(2026, 1, 15, 12, 0), dt.datetime(2026, 2, 1)
KEYS = {"book": "book_id"}


def books(spark, *rows):
    return spark.createDataFrame(list(rows), "book_id long, title string, updated_at timestamp")


def some(spark, n=25, **changed):
    return books(spark, *[(i, changed.get(f"b{i}", f"t{i}"), FIRST) for i in range(1, n + 1)])


def new_store(spark, part_rows=10):
    return TableStore(spark, f"{shared_folder(spark)}/ranges-{uuid.uuid4().hex}", part_rows)


@pytest.fixture
def store(spark):
    store = new_store(spark)
    store.publish({"book": some(spark)}, KEYS)
    return store


def parts(store, table="book"):
    return {part: paths for (name, part), paths in store.paths().items() if name == table and paths}


def titles(store):
    return sorted((r.book_id, r.title) for r in store.read("book").collect())


def test_a_table_is_cut_into_ranges(spark, store):
    assert list(sorted(parts(store))) == ["00000000x10", "00000001x10", "00000002x10"]
    again = TableStore(spark, store.root, part_rows=777)
    assert again.range_size("book") == 10
    assert [r.book_id for r in again.read_last("book").orderBy("book_id").collect()] == [21, 22, 23, 24, 25]
    assert again.parts_with("book", spark.range(9, 12).select(F.col("id").alias("book_id")), "book_id") == ["00000000x10", "00000001x10"]


@pytest.mark.parametrize("change, differ", [
    ({}, []), ({"b1": "x"}, ["00000000x10"]), ({"b10": "x", "b11": "y"}, ["00000000x10", "00000001x10"]), ({"b25": None}, ["00000002x10"])])
def test_differing_ranges_are_found_without_reading_stored_rows(spark, store, change, differ):
    again = TableStore(spark, store.root)
    assert again.differing_parts("book", some(spark, **change), "book_id") == differ
    # A new stamp alone is no change, and neither is another order.
    assert again.differing_parts("book", some(spark, **change).withColumn("updated_at", F.lit(LATER)).orderBy(F.desc("book_id")), "book_id") == differ


def test_added_removed_and_moved_values_differ(spark, store):
    assert store.differing_parts("book", some(spark, 31), "book_id") == ["00000002x10", "00000003x10"]
    assert store.differing_parts("book", some(spark, 20), "book_id") == ["00000002x10"]
    assert store.differing_parts("book", some(spark, b1="t2", b2="t1"), "book_id") == ["00000000x10"]
    assert store.differing_parts("book", some(spark).unionByName(some(spark, 1)), "book_id") == ["00000000x10"]
    # A value that moves to another column, where the rest is null.
    pair = spark.createDataFrame([(1, "a", None)], "book_id long, title string, subtitle string")
    other = new_store(spark)
    other.publish({"book": pair}, KEYS)
    assert other.differing_parts("book", pair.select("book_id", F.col("subtitle").alias("title"), F.col("title").alias("subtitle")), "book_id") == ["00000000x10"]
    # Other types, or a table kept whole, can't be told by digest.
    assert store.differing_parts("book", some(spark).withColumn("book_id", F.col("book_id").cast("int")), "book_id") is None
    store.publish({"book": some(spark)})
    assert list(parts(store)) == [WHOLE] and store.differing_parts("book", some(spark), "book_id") is None


def test_snapshot_rewrites_only_ranges_that_differ(spark, store):
    before = parts(store)
    snapshot.publish_snapshot(store, {"book": some(spark, 31, b12="new")}, LATER)
    again = TableStore(spark, store.root)
    after = parts(again)
    assert after["00000000x10"] == before["00000000x10"] and len(after) == 4
    assert all(after[part] != before[part] for part in ("00000001x10", "00000002x10"))
    assert titles(again) == sorted((i, "new" if i == 12 else f"t{i}") for i in range(1, 32))
    assert [r.book_id for r in again.read("book").filter(F.col("updated_at") == LATER).collect()] == [12]
    assert again.read("book_logs").count() == 7
    unchanged = again.paths()
    snapshot.publish_snapshot(again, {"book": again.read("book")}, LATER)
    assert again.paths() == unchanged
    # Only the differing range is joined: the plan of its rows opens no other.
    opened = again.read("book", again.differing_parts("book", some(spark, 31, b12="t12"), "book_id")).inputFiles()
    assert opened and all("00000001x10" in path for path in opened)


def test_all_rows_gone_and_back(spark, store):
    snapshot.publish_snapshot(store, {"book": some(spark).limit(0)}, LATER)
    assert titles(TableStore(spark, store.root)) == []
    snapshot.publish_snapshot(store, {"book": some(spark, 12)}, LATER)
    assert len(titles(TableStore(spark, store.root))) == 12
    empty = new_store(spark)
    empty.publish({"book": some(spark).limit(0)}, KEYS)
    assert "book" in empty and titles(empty) == []
    snapshot.publish_snapshot(empty, {"book": some(spark, 3)}, LATER)
    assert len(titles(empty)) == 3


def test_appended_rows_go_to_their_range_and_its_digest_grows(spark, store):
    before = parts(store)
    store.append("book", books(spark, (26, "t26", FIRST), (31, "t31", FIRST)), "book_id")
    after = parts(store)
    assert after["00000002x10"][:1] == before["00000002x10"] and len(after["00000002x10"]) == 2 and len(after) == 4
    whole = some(spark, 26).unionByName(books(spark, (31, "t31", FIRST)))
    assert TableStore(spark, store.root).differing_parts("book", whole, "book_id") == []


def test_deletes_rewrite_only_their_ranges(spark, store):
    before = parts(store)
    assert deletions.delete_rows(store, {"book": spark.range(24, 26).select(F.col("id").alias("book_id"))}, LATER) == {"book": 2}
    after = parts(TableStore(spark, store.root))
    assert {part for part in before if before[part] == after.get(part)} == {"00000000x10", "00000001x10"}
    assert len(titles(store)) == 23


def test_rows_since_a_time_open_only_paths_with_newer_stamps(spark, store):
    store.append("book", books(spark, (26, "t26", LATER), (31, "t31", None)), "book_id")
    again = TableStore(spark, store.root)
    since = again.read_since("book", FIRST)
    assert [r.book_id for r in since.collect()] == [26]
    (opened,) = since.inputFiles()
    assert "00000002x10" in opened
    assert again.read_since("book", LATER).collect() == [] and again.read_since("book", LATER).columns == ["book_id", "title", "updated_at"]
    assert again.read_since("book", None).count() == 27
    assert again.read_since("book", FIRST - dt.timedelta(microseconds=1)).count() == 26
    # Whole tables know their newest stamp too.
    again.publish({"book": some(spark)})
    assert TableStore(spark, store.root).read_since("book", FIRST).inputFiles() == []


def test_publisher_rename_leaves_other_ranges(spark):
    store = new_store(spark, 2)
    columns = "book_dim_id long, book_isbn_id long, publisher string, effective_date date, expire_date date, current_flag boolean"
    day = dt.date(2025, 1, 1)
    rows = [(i, i, "tor" if i in (3, 4, 7) else "ace", day, None, True) for i in range(1, 8)]
    store.publish({"book_dim": spark.createDataFrame(rows, columns), "publisher": spark.createDataFrame(
        [(1, "ace"), (2, "tor"), (3, "daw")], "publisher_id long, publisher string")}, {"book_dim": "book_dim_id", "publisher": "publisher_id"})
    dim, houses = parts(store, "book_dim"), parts(store, "publisher")
    snapshot.store_publisher_rename(store, "tor", "tor books", LATER)
    again = TableStore(spark, store.root)
    after = parts(again, "book_dim")
    assert {part for part in dim if dim[part] == after[part]} == {"00000000x2", "00000002x2"}
    assert {part for part in houses if houses[part] == parts(again, "publisher")[part]} == {"00000001x2"}
    got = sorted((r.book_dim_id, r.book_isbn_id, r.publisher, r.current_flag) for r in again.read("book_dim").collect())
    assert got == sorted([(i, i, "tor" if i in (3, 4, 7) else "ace", i not in (3, 4, 7)) for i in range(1, 8)]
                         + [(8, 3, "tor books", True), (9, 4, "tor books", True), (10, 7, "tor books", True)])
    assert sorted(r.publisher for r in again.read("publisher").collect()) == ["ace", "daw", "tor books"]
    paths = again.paths()
    snapshot.store_publisher_rename(again, "nobody", "somebody", LATER)
    assert {key: value for key, value in again.paths().items() if key[0] != "etl_log"} == {k: v for k, v in paths.items() if k[0] != "etl_log"}


def test_changed_authors_rewrite_their_ranges(spark):
    store = new_store(spark, 2)
    author = [(i, f"a{i}", FIRST) for i in range(1, 6)]
    schema = "author_id long, full_name string, updated_at timestamp"
    dim = [(i, i, f"a{i}") for i in range(1, 6)]
    store.publish({"author": spark.createDataFrame(author, schema), "author_dim": spark.createDataFrame(dim, "author_dim_id long, author_id long, author_name string")},
                  {"author": "author_id", "author_dim": "author_dim_id"})
    log = spark.createDataFrame([(FIRST, "oltp", "load_author_dim", 5, 5, 0, 0)], monthly.ETL_LOG)
    store.append("etl_log", log)
    store.replace_parts("author", ["00000000x2"], spark.createDataFrame([(1, "a1", FIRST), (2, "b2", LATER)], schema), "author_id")
    store.append("author", spark.createDataFrame([(7, "a7", LATER)], schema), "author_id")
    before, run = parts(store, "author_dim"), monthly.MonthlyRun(store, LATER)
    assert run.author_dim() == 2
    run.store.commit()
    after = parts(store, "author_dim")
    assert after["00000001x2"] == before["00000001x2"] and after["00000000x2"] != before["00000000x2"]
    assert after["00000002x2"][:1] == before["00000002x2"]
    assert sorted(tuple(r) for r in store.read("author_dim").collect()) == [(1, 1, "a1"), (2, 2, "b2"), (3, 3, "a3"), (4, 4, "a4"), (5, 5, "a5"), (6, 7, "a7")]


def test_nothing_is_current_before_the_switch(spark, store):
    before, staged = store.paths(), StagedTables(store)
    staged.replace_parts("book", ["00000000x10"], some(spark, 10, b1="x"), "book_id")
    assert TableStore(spark, store.root).paths() == before and dict(titles(staged))[1] == "x"
    staged.commit()
    again = TableStore(spark, store.root)
    assert dict(titles(again))[1] == "x" and again.differing_parts("book", some(spark, b1="x"), "book_id") == []


def test_sparse_keys_give_few_ranges(spark):
    store = new_store(spark)
    sparse = spark.range(1, 201).select((F.col("id") * 1_000_003).alias("book_id"), F.lit("t").alias("title"), F.lit(FIRST).alias("updated_at"))
    store.publish({"book": sparse}, KEYS)
    assert 10 <= len(parts(store)) <= 2 * 20 + 16 and store.read("book").exceptAll(sparse).count() == 0
    again = TableStore(spark, store.root)
    one = F.when(F.col("book_id") == 1_000_003, F.lit("x")).otherwise(F.col("title"))
    (differing,) = again.differing_parts("book", sparse.withColumn("title", one), "book_id")
    before = parts(again)
    snapshot.publish_snapshot(again, {"book": sparse.withColumn("title", one)}, LATER)
    assert {part for part, paths in parts(again).items() if paths != before[part]} == {differing}
    assert again.read("book").count() == 200 and again.read("book_logs").count() == 1


def test_a_few_far_keys_leave_dense_ranges_as_they_are(spark):
    store = new_store(spark)
    store.publish({"book": some(spark, 25).unionByName(books(spark, (10**15, "far", FIRST), (-(10**12), "low", FIRST), (None, "none", FIRST)))}, KEYS)
    assert store.range_size("book") == 10 and len(parts(store)) == 6
    assert store.read("book").count() == 28


def test_dense_keys_need_no_sketches(spark, monkeypatch):
    def sketch(*_):
        raise AssertionError("ranges of dense keys are counted by their ends")

    monkeypatch.setattr(tables.F, "approx_count_distinct", sketch)
    dense = spark.range(1, 101).withColumnRenamed("id", "book_id")
    assert tables.width_of(dense, "book_id", 10) == 10
    assert tables.width_of(dense.filter("false"), "book_id", 10) == 10


def test_generations_hold_no_table_with_its_parents():
    seen = set()
    for generation in deletions.parents_first():
        for name in generation:
            assert set(constraints.CONSTRAINTS[name].parents.values()) <= seen
        seen |= set(generation)
    assert seen == set(constraints.CONSTRAINTS)


def test_own_files_are_read_without_asking_them_for_their_columns(spark, store):
    spark.sparkContext.setJobGroup("reads", "reads of own files")
    try:
        rows = store.read("book", ["00000001x10"])
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("reads")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(r.book_id for r in rows.collect()) == list(range(11, 21))
    assert rows.schema == TableStore(spark, store.root).read("book").schema


def test_labels_and_digests_are_those_of_stored_manifests(spark):
    keys = [1, 10, 11, -5, -(10**12), 10**15, None]
    df = books(spark, *[(k, f"t{k}", FIRST) for k in keys for _ in range(3)])
    number = F.floor((F.col("book_id") - 1) / 10)
    label = F.concat(F.coalesce(F.format_string("%08d", number), F.lit("null")), F.lit("x10"))
    assert df.filter(~label.eqNullSafe(tables.part_of("book_id", 10))).count() == 0
    marks = [mark for c in ("book_id", "title") for mark in (F.col(c).isNull(), F.col(c))]
    sums = [F.sum(F.xxhash64(F.lit(seed), *marks).cast("decimal(20,0)")).cast("string") for seed in (1, 2)]
    want = df.groupBy(label.alias("part")).agg(F.array(*sums).alias("sums"))
    got = tables.facts(df, tables.part_of("book_id", 10), df.columns)
    assert sorted((r.part, tuple(r.sums)) for r in got.collect()) == sorted((r.part, tuple(r.sums)) for r in want.collect())


def test_unique_keys_are_written_only_where_they_repeat(spark, monkeypatch):
    written = {}
    monkeypatch.setattr(constraints, "settle", lambda rows, name: written.setdefault(name, settle(rows, name)))
    rejected = constraints.check_table("book", {"book": some(spark).unionByName(some(spark, 1))}, FIRST.date())
    assert [(r.rule, r.row_id) for r in rejected.collect()] == [("unique book_id", 1)] * 2
    assert written["keys"].count() == 1 and written["broken"].count() == 1
