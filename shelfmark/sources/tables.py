"""Named Parquet tables in versions, switched together by one manifest."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from shelfmark.operators.settle import WRITERS

WHOLE = ""
STAMP = "updated_at"
PART_ROWS = 1_000_000
#: Ranges a table may have over twice those its rows would fill.
SPARE_PARTS = 16
#: Bits of a row hash that are added up as one whole number.
PIECE = 22
FOLDER = "_key_part"
RANGE_LABEL = re.compile(r"(-?\d+|null)x(\d+)")


def part_of(key: str, size: int) -> Column:
    """Label of the part a key belongs to: ``size`` keys in a row, counted from 1. Null keys have a part of their own."""
    number = F.floor((F.col(key).cast("bigint") - 1) / size)
    digits = F.abs(number).cast("string")

    def padded(width: int) -> Column:
        return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))

    label = F.when(number < 0, F.concat(F.lit("-"), padded(7))).otherwise(padded(8))
    # As wide as the others, which is how stored manifests name it.
    return F.concat(F.coalesce(label, F.lit("    null")), F.lit(f"x{size}"))


def width_of(df: DataFrame, key: str, part_rows: int) -> int:
    """Keys in a range: ``part_rows``, doubled until the ranges that hold keys are about as many as the rows need.

    Sparse keys so give few ranges, while far-off keys beside dense ones only
    add ranges of their own. Where the lowest and the highest key are not far
    apart for the rows between them that is enough to tell; else ranges are
    counted by sketches, in one row, for the widths between.
    """
    number = F.col(key).cast("bigint")
    seen = df.agg(F.count("*").alias("rows"), F.min(number).alias("low"), F.max(number).alias("high")).first()
    if seen["low"] is None:
        return part_rows
    enough = SPARE_PARTS + 2 * -(-seen["rows"] // part_rows)
    low, high = ((seen[end] - 1) // part_rows for end in ("low", "high"))
    surely = next(i for i in range(64) if (high >> i) - (low >> i) < enough)
    if not surely:
        return part_rows
    cells = df.select(F.floor((number - 1) / part_rows).alias("cell")).distinct()
    ranges = cells.agg(*[F.approx_count_distinct(F.shiftright("cell", i)) for i in range(surely)]).first()
    return part_rows << next((i for i in range(surely) if ranges[i] <= enough), surely)


def facts(df: DataFrame, part: Column, columns: list[str]) -> DataFrame:
    """By part: rows, two digests that don't depend on the rows' order, and the newest stamp in microseconds.

    A row's hash covers names in order, nulls and values of all columns but the
    stamp. Hashes are added up, so files' digests add up to their part's; they
    are added up in pieces, as whole numbers, and put together by part.
    """
    marks = [mark for c in sorted(columns) if c != STAMP for mark in (F.col(c).isNull(), F.col(c))]
    stamp = F.unix_micros(F.col(STAMP).cast("timestamp")) if STAMP in columns else F.lit(None).cast("bigint")
    hashed = df.select(part.alias("part"), stamp.alias("stamp"), *[F.xxhash64(F.lit(seed), *marks).alias(f"hash{seed}") for seed in (1, 2)])

    def total(c: str) -> Column:
        low, middle = (F.shiftright(c, shift).bitwiseAND(F.lit((1 << PIECE) - 1)) for shift in (0, PIECE))
        pieces = [(F.shiftright(c, 2 * PIECE), 2 * PIECE), (middle, PIECE), (low, 0)]
        return reduce(Column.__add__, [F.sum(piece).cast("decimal(20,0)") * F.lit(1 << shift).cast("decimal(14,0)") for piece, shift in pieces])

    return hashed.groupBy("part").agg(F.count("*").alias("rows"), F.max("stamp").alias("newest"),
                                      F.array(*[total(c).cast("string") for c in ("hash1", "hash2")]).alias("sums"))


def newest_stamp(columns: list[str]) -> Column:
    return F.max(F.unix_micros(F.col(STAMP).cast("timestamp"))) if STAMP in columns else F.lit(None).cast("bigint")


def columns_of(df: DataFrame) -> StructType:
    """Names and types, as they are read back: any column may hold nulls."""
    return StructType([StructField(f.name, f.dataType) for f in df.schema])


def added_up(digests: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    return tuple(sum(values) for values in zip(*digests)) if digests else (0, 0, 0)


class TableStore:
    """Tables under one root; a reader sees what the last switch made current.

    Spark cannot overwrite a path it reads, and there is no transaction over
    several tables. So a job writes new paths first and then switches all of
    them with one manifest file; one that dies earlier has changed nothing.
    A table may be kept in parts, such as months, so that a load rewrites or
    adds one part and leaves the others alone. Tables with a whole-number key
    may be kept in ranges of ``part_rows`` keys, or of more where keys are
    sparse; a range is one manifest row. The manifest also holds what is known of each path: a
    digest of its rows, by which a part is known to be unchanged without being
    read, and its newest stamp. One job writes at a time; the manifest is read
    once and kept up to date by the job's own switches.
    """

    MANIFEST = ("version bigint, table string, part string, paths array<string>, "
                "facts map<string, struct<rows: bigint, sums: array<string>, newest: bigint>>")

    def __init__(self, spark: SparkSession, root: str, part_rows: int = PART_ROWS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.part_rows = part_rows
        self._current: dict[tuple[str, str], list[str]] | None = None
        self._since: dict[tuple[str, str], int] = {}
        self._facts: dict[str, tuple[int | None, list[str] | None, int | None]] = {}
        self._schemas: dict[str, StructType] = {}
        self._version = 0

    def _load(self) -> None:
        """One manifest row per table and part is current, the one of the last version."""
        self._current = {}
        try:
            manifest = self.spark.read.schema(self.MANIFEST).json(f"{self.root}/_manifest")
        except AnalysisException:
            return
        latest = manifest.groupBy("table", "part").agg(
            F.max_by(F.struct("paths", "facts"), "version").alias("entry"), F.max("version").alias("version"))
        for row in latest.select("table", "part", "version", "entry.*").collect():
            self._current[row["table"], row["part"]] = list(row["paths"])
            self._since[row["table"], row["part"]] = row["version"]
            self._facts.update({path: tuple(known) for path, known in (row["facts"] or {}).items()})
            self._version = max(self._version, row["version"])

    def paths(self) -> dict[tuple[str, str], list[str]]:
        """Current paths by (table, part)."""
        if self._current is None:
            self._load()
        return dict(self._current)

    def __contains__(self, table: str) -> bool:
        return any(name == table for name, _ in self.paths())

    def read(self, table: str, parts: list[str] | None = None) -> DataFrame:
        """The table, or only the given parts of it."""
        wanted = None if parts is None else set(parts)
        return self._open(table, lambda part, path: wanted is None or part in wanted)

    def read_since(self, table: str, since: dt.datetime | None) -> DataFrame:
        """Rows stamped after a time, all rows without one. Paths whose newest stamp isn't after it aren't opened."""
        if since is None:
            return self.read(table)
        limit = round(since.timestamp() * 1_000_000)

        def after(part: str, path: str) -> bool:
            if path not in self._facts:
                return True
            newest = self._facts[path][2]
            return newest is not None and newest > limit

        return self._open(table, after).filter(F.col(STAMP) > F.lit(since))

    def _open(self, table: str, wanted) -> DataFrame:
        """The table's paths that are wanted; none of them gives no rows.

        Files are asked for their columns only if another job wrote some of them.
        """
        every = [(part, path) for (name, part), paths in self.paths().items() if name == table for path in paths]
        chosen = [path for part, path in every if wanted(part, path)]
        opened = chosen or [path for _, path in every[:1]]
        written = [self._schemas.get(path) for path in opened]
        alike = written and all(schema is not None and schema == written[0] for schema in written)
        reader = self.spark.read.schema(written[0]) if alike else self.spark.read
        rows = reader.parquet(*opened)
        return rows if chosen or not every else rows.filter(F.lit(False))

    def read_newest(self, table: str) -> DataFrame:
        """The rows added last to a table that only grows."""
        parts = [key for key, paths in self.paths().items() if key[0] == table and paths]
        return self.spark.read.parquet(self.paths()[max(parts, key=self._since.get)][-1])

    def read_all(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in {name for name, _ in self.paths()}}

    def write(self, table: str, df: DataFrame, partition_by: list[str] | None = None, label: str = "") -> str:
        """Write rows to a new path nobody reads yet; a ``label`` begins its name."""
        path = f"{self.root}/{table}/{label}{uuid.uuid4().hex}"
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        if not partition_by:
            self._schemas[path] = columns_of(df)
        if STAMP in df.columns and not partition_by:
            newest = self.spark.read.schema(df.select(STAMP).schema).parquet(path).agg(newest_stamp([STAMP]).alias("newest")).first()
            self._facts[path] = (None, None, newest["newest"])
        return path

    # Ranges of keys

    def range_size(self, table: str) -> int | None:
        """Keys in a range of the table; None for one that isn't kept in ranges."""
        for (name, part), paths in self.paths().items():
            if name == table and paths and RANGE_LABEL.fullmatch(part):
                return int(RANGE_LABEL.fullmatch(part)[2])
        return None

    def label(self, table: str, key: str) -> Column:
        """Part of a row by its key; tables that aren't kept in ranges are one part."""
        size = self.range_size(table)
        return F.lit(WHOLE) if size is None else part_of(key, size)

    def parts_with(self, table: str, rows: DataFrame, key: str) -> list[str]:
        """Parts that hold the keys of the rows: one label a part reaches the driver."""
        return sorted(r["part"] for r in rows.select(self.label(table, key).alias("part")).distinct().collect())

    def read_last(self, table: str) -> DataFrame:
        """The range with the highest keys, or the whole of a table that isn't kept in ranges."""
        labels = [(RANGE_LABEL.fullmatch(part), part) for (name, part), paths in self.paths().items() if name == table and paths]
        ranges = [(int(found[1]), part) for found, part in labels if found and found[1] != "null"]
        return self.read(table, [max(ranges)[1]]) if ranges else self.read(table)

    def differing_parts(self, table: str, new: DataFrame, key: str) -> list[str] | None:
        """Parts whose rows differ from those of a whole new snapshot, by digest; None where that can't be told.

        The snapshot is hashed and added up by part, before a shuffle of one row
        a part and task; stored rows aren't read. Stamps don't count.
        """
        size, entries = self.range_size(table), {part: paths for (name, part), paths in self.paths().items() if name == table and paths}
        if size is None or any(self._facts.get(path, (None,))[0] is None for paths in entries.values() for path in paths):
            return None
        if {(f.name, f.dataType) for f in self.read(table).schema} != {(f.name, f.dataType) for f in new.schema}:
            return None
        there = {part: added_up([self._digest(path) for path in paths]) for part, paths in entries.items()}
        found = facts(new, part_of(key, size), new.columns).collect()
        now = {r["part"]: (r["rows"], *map(int, r["sums"])) for r in found}
        return sorted(part for part in there.keys() | now.keys() if there.get(part, (0, 0, 0)) != now.get(part, (0, 0, 0)))

    def _digest(self, path: str) -> tuple[int, int, int]:
        rows, sums, _ = self._facts[path]
        return (rows, *map(int, sums)) if rows else (0, 0, 0)

    def write_ranges(self, table: str, df: DataFrame, key: str) -> dict[str, str]:
        """Write rows in ranges of keys; the new path of each part, and one without rows for an empty frame.

        Large ranges are written by several tasks, as several files of one folder.
        """
        size = self.range_size(table) or width_of(df, key, self.part_rows)
        root = f"{self.root}/{table}/{uuid.uuid4().hex}"
        labelled = df.withColumn(FOLDER, part_of(key, size))
        labelled.hint("rebalance", FOLDER).write.mode("errorifexists").partitionBy(FOLDER).parquet(root)
        made = {}
        for row in facts(self.spark.read.schema(labelled.schema).parquet(root), F.col(FOLDER), df.columns).collect():
            path = made[row["part"]] = f"{root}/{FOLDER}={row['part']}"
            self._facts[path] = (row["rows"], list(row["sums"]), row["newest"])
            self._schemas[path] = columns_of(df)
        if not made:
            made[WHOLE] = self.write(table, df.limit(0))
            self._facts[made[WHOLE]] = (0, None, None)
        return made

    def replace_parts(self, table: str, parts: list[str] | None, df: DataFrame, key: str) -> None:
        """Put rows in the place of the given parts, of all parts for None; rows of other parts are added to those."""
        entries = {part: paths for (name, part), paths in self.paths().items() if name == table}
        replaced = set(entries if parts is None or WHOLE in parts else parts)
        self._put(table, replaced, self.write_ranges(table, df, key))

    def _put(self, table: str, replaced: set[str], made: dict[str, str]) -> None:
        entries = {part: paths for (name, part), paths in self.paths().items() if name == table}
        changed = {part: [] for part in replaced if entries.get(part)}
        for part, path in made.items():
            changed[part] = [path] if part in replaced else [*entries.get(part, []), path]
        self.switch({(table, part): paths for part, paths in changed.items()})

    def switch(self, parts: dict[tuple[str, str], list[str]]) -> None:
        """Make the given paths current, all at once."""
        self.paths()
        rows = [(self._version + 1, table, part, paths, {path: self._facts[path] for path in paths if path in self._facts})
                for (table, part), paths in parts.items()]
        (self.spark.createDataFrame(rows, self.MANIFEST).coalesce(1)
         .write.mode("append").json(f"{self.root}/_manifest"))
        self._version += 1
        self._current.update(parts)
        self._since.update(dict.fromkeys(parts, self._version))

    def publish(self, tables: dict[str, DataFrame], keys: dict[str, str] | None = None) -> None:
        """Replace whole tables, some at a time; those with a key are kept in ranges of it."""
        staged = StagedTables(self)

        def replace(table: str) -> None:
            if keys and table in keys:
                staged.replace_parts(table, None, tables[table], keys[table])
            else:
                others = {(name, part): [] for (name, part), paths in staged.paths().items() if name == table and paths}
                staged.switch(others | {(table, WHOLE): [staged.write(table, tables[table])]})

        with ThreadPoolExecutor(WRITERS) as pool:
            list(pool.map(replace, tables))
        staged.commit()

    def add(self, table: str, df: DataFrame, key: str) -> DataFrame | None:
        """Add rows as ``append`` does and read them back from their files; None for no rows, which change nothing.

        The rows are made once, for the files that are kept.
        """
        ranged = self.range_size(table) is not None
        made = self.write_ranges(table, df, key) if ranged else {WHOLE: self.write(table, df)}
        rows = self.spark.read.schema(columns_of(df)).parquet(*made.values())
        if (ranged and WHOLE in made) or rows.isEmpty():
            return None
        self._put(table, set(), made)
        return rows

    def append(self, table: str, df: DataFrame, key: str | None = None) -> None:
        """Add rows to a table that grows, such as a log; with its key, to the ranges of one that is kept in ranges."""
        if key is not None and self.range_size(table) is not None:
            self.replace_parts(table, [], df, key)
        else:
            kept, path = self.paths().get((table, WHOLE), []), self.write(table, df)
            self.switch({(table, WHOLE): [*kept, path]})


class StagedTables(TableStore):
    """A store's tables with changes that only this job sees until ``commit`` makes all of them current at once."""

    def __init__(self, store: TableStore):
        super().__init__(store.spark, store.root, store.part_rows)
        self._store, self._changes = store, {}
        self._current, self._since, self._version = store.paths(), dict(store._since), store._version
        self._facts, self._schemas = dict(store._facts), store._schemas

    def switch(self, parts: dict[tuple[str, str], list[str]]) -> None:
        self._changes.update(parts)
        self._current.update(parts)
        self._since.update(dict.fromkeys(parts, self._version + 1))

    def commit(self) -> None:
        if self._changes:
            self._store._facts.update(self._facts)
            self._store.switch(self._changes)
            self._changes = {}


def preview(df: DataFrame, order_by: list[Column], n: int) -> DataFrame:
    """First ``n`` rows in a stated order."""
    return df.orderBy(*order_by).limit(n)


def column_names(df: DataFrame) -> DataFrame:
    """Name, type and nullability of every column, one row each."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string, is_nullable boolean")
