"""Connected components of links between long node ids, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfmark.operators.settle import settle


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _fingerprint(links: DataFrame):
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), the root being the component's smallest node.

    Rounds of large star and small star: every node hands its neighbours to
    the smallest one it knows, until all components are stars. Minima are
    aggregated before they move, and joins are on keys alone, so that
    adaptive execution can split the hub of a large star. Each round is
    written to the shared folder; only a count and a hash reach the driver.
    Links of a node with itself and repeated links change nothing; no links
    give no nodes. Null ends are left out.
    """
    links = (links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    links = settle(links, "links")
    seen = _fingerprint(links)
    while seen[0]:
        both = _both_ways(links)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
        links = settle(small.filter("a <> b").distinct(), "links")
        now = _fingerprint(links)
        if now == seen:
            break
        seen = now
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
