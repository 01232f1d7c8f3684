"""Where queries and their check SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
STORED: dict[tuple[str, str, str], object] = {}


class Inputs:
    """Driver tables and tables derived from them, read as they are asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, table: str) -> DataFrame:
        if table not in TABLES:
            raise AttributeError(table)
        df = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
        setattr(self, table, df)
        return df

    def stored(self, name: str, make: Callable[[Inputs], object]):
        """Tables several queries start from, made once per session and folder."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in STORED:
            STORED[key] = make(self)
        return STORED[key]

    def sql(self, text: str) -> DataFrame:
        """SQL both engines read alike; driver tables in braces."""
        used = {t: getattr(self, t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)


def plain(text: str) -> str:
    """The same SQL with plain table names."""
    return text.format(**{t: t for t in TABLES})


def with_tables(derived: dict[str, str], select: str) -> str:
    """Check SQL: derived tables as common table expressions, then the query."""
    ctes = ",\n".join(f"{name} AS ({plain(text)})" for name, text in derived.items())
    return f"WITH {ctes}\n{select}"


def query(name: str, sql: str | None = None):
    """Register ``fn(inputs)`` under a name, with the SQL that gives the same rows."""
    def register(fn: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register
