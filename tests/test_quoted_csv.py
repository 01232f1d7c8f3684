"""CSV with line breaks in cells, read in splits: the same rows as a reader of whole files finds."""

import csv
import random

import pytest

from shelfmark.sources import files, quoted

COLUMNS = ["a", "b", "c d"]


def write(path, rows, end="\n"):
    with open(path, "w", encoding="utf-8", newline="") as out:
        csv.writer(out, lineterminator=end).writerows([COLUMNS, *rows])


def read(spark, path):
    rows = files.read_quoted_csv(spark, str(path)).orderBy("_src_pos").collect()
    return [tuple(r[c] or "" for c in COLUMNS) for r in rows]


@pytest.fixture
def small_splits(spark):
    """Splits of some 300 bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 300)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def cell(draw):
    return "".join(draw.choice(['"', '""', "\n", ",", "x", "é", " ", '",', ',"', "long word " * 3]) for _ in range(draw.randrange(7)))


@pytest.mark.parametrize("seed", range(4))
def test_rows_and_order_are_those_of_the_files(spark, tmp_path, small_splits, seed):
    draw = random.Random(seed)
    want = []
    for name in ("p", "q", "r"):
        rows = [(f"{name}{i}", cell(draw), cell(draw)) for i in range(draw.choice([0, 5, 120]))]
        write(tmp_path / f"{name}.csv", rows)
        want += rows
    assert read(spark, tmp_path) == want


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    rows = [("1", "x", "y"), ("2", "line, \"with\" quotes\n" * 200, "end"), ("3", "\n" * 50, ""), ("4", "", "z" * 2000)]
    write(tmp_path / "one.csv", rows)
    assert read(spark, tmp_path / "one.csv") == rows
    assert quoted.split_lines(spark, str(tmp_path)).select("_file", "_split").distinct().count() > 5


def test_stray_quotes_line_ends_and_short_rows(spark, tmp_path):
    text = 'a,b,c d\r\n5" disk,x,y\r\n\r\n"1\r\n2",say "hi",z\r\nshort\r\nlong,1,2,3\r\n"",,"no end'
    (tmp_path / "odd.csv").write_text(text, newline="")
    assert read(spark, tmp_path) == [('5" disk', "x", "y"), ("1\n2", 'say "hi"', "z"), ("short", "", ""), ("long", "1", "2"), ("", "", "no end")]


def test_positions_follow_files_then_rows(spark, tmp_path):
    write(tmp_path / "b.csv", [("3", "", "")])
    write(tmp_path / "a.csv", [("1", "x\ny", ""), ("2", "", "")])
    rows = files.read_quoted_csv(spark, str(tmp_path)).orderBy("_src_pos").collect()
    assert [(r["a"], r["_src_pos"] >> files.FILE_ROW_BITS) for r in rows] == [("1", 0), ("2", 0), ("3", 1)]


def test_files_without_rows(spark, tmp_path):
    write(tmp_path / "empty.csv", [])
    assert read(spark, tmp_path) == []


def test_text_is_shuffled_once_by_split(spark, tmp_path):
    """Beside the small table of splits, the join and the grouping take the windows' partitioning."""
    write(tmp_path / "a.csv", [("1", "x\ny", "")])
    lines = quoted.split_lines(spark, str(tmp_path))
    text = lines.groupBy(*quoted.SPLIT, "_before_out").agg(quoted.joined_lines("_at", "_line"))
    assert text._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
