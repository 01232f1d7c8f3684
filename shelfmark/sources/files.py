"""Raw catalogue and sales files in, staging table out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from shelfmark.schemas import DROPPED_CATALOGUE_COLUMNS, SALES_COLUMNS
from shelfmark.sources.quoted import records

# Cells that stand for a missing value.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
           "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Low bits of a row position: the line within its file.
FILE_ROW_BITS = 36
CSV = {"quote": '"', "escape": '"'}


def read_text_csv(spark: SparkSession, path: str, line_breaks: bool = False) -> DataFrame:
    """CSV with header, every column text.

    Only the header line is looked at before the scan; no type is inferred.
    With quoted line breaks Spark takes a file as one task's work; see
    ``read_quoted_csv`` for large ones.
    """
    return spark.read.options(**CSV, header=True, multiLine=line_breaks, encoding="UTF-8").csv(path, inferSchema=False)


def read_quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header whose cells may hold line breaks, every column text, and the row position; files are split.

    ``_src_pos`` follows the files by name, then the rows of each: the file's
    number, from one row for each file, before the number of the line a row
    begins at. Column names are those of the first file; each file's first row
    is its header. Rows with too few cells get nulls, further cells are left out.
    """
    names = read_text_csv(spark, path, line_breaks=True).columns
    rows = records(spark, path)
    files = rows.groupBy("_file").agg(F.min("_place").alias("_first"), F.max("_place").alias("_last"))
    files = files.filter("_last > _first").drop("_last")  # files of a header alone have no rows to number
    files = files.withColumn("_number", F.row_number().over(Window.orderBy("_file")) - 1)
    place = F.shiftleft(F.col("_number").cast("bigint"), FILE_ROW_BITS) + F.col("_place") - F.col("_first") - 1
    cells = F.from_csv("_record", ", ".join(f"`{name.replace('`', '``')}` string" for name in names), CSV)
    return (rows.join(files, "_file").filter(F.col("_place") > F.col("_first"))
            .select(cells.alias("_cells"), place.alias("_src_pos")).select("_cells.*", "_src_pos"))


def load_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Raw catalogue without the seven unused columns, and the row position (``_src_pos``)."""
    raw = read_quoted_csv(spark, path)
    absent = [c for c in DROPPED_CATALOGUE_COLUMNS if c not in raw.columns]
    if absent:
        raise ValueError(f"catalogue lacks the columns {absent}")
    kept = raw.drop(*DROPPED_CATALOGUE_COLUMNS)
    return kept.withColumns({c: F.when(~F.col(c).isin(*MISSING), F.col(c)) for c in kept.columns if c != "_src_pos"})


def load_sales(spark: SparkSession, path: str) -> DataFrame:
    """Raw monthly sales as text under snake-case names."""
    return rename_sales(read_text_csv(spark, path))  # no quoted line breaks, so files are split


def rename_sales(raw: DataFrame) -> DataFrame:
    return raw.select([F.col(f"`{header}`").alias(name) for header, name in SALES_COLUMNS.items()])


def as_text(df: DataFrame) -> DataFrame:
    """Arrays as JSON text, so that a row fits a CSV line."""
    return df.select([
        (F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f"`{f.name}`"))
        for f in df.schema.fields])


def write_staging(df: DataFrame, path: str, csv_path: str | None = None) -> None:
    """Publish the staging table as Parquet, and as CSV where a path is given."""
    df.write.mode("errorifexists").parquet(path)
    if csv_path is not None:
        written = df.sparkSession.read.schema(df.schema).parquet(path)
        options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        as_text(written).write.mode("errorifexists").options(**options).csv(csv_path)
