"""Connected components by alternating large-star and small-star steps.

Each step groups edges by one end and links its neighbours to the smallest of
them; no task ever holds a component. The edge table is written to the shared
folder after each round, so lineage stays short and survives lost executors; the
table before it is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segstream.llm.common import delete_shared, written


def _stars(arcs: DataFrame, least: str) -> DataFrame:
    """``arcs`` (u, v) with the smallest v (or u itself) of each u as ``m``."""
    smallest = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = arcs.join(smallest, "u")
    if least == "large":
        return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(smallest.select("u", F.col("m").alias("v")))


def checksum(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of ``edges`` (a, b) with the smallest node of
    its component; the two columns may have any ordered type."""
    return kept_components(edges)[0]


def kept_components(edges: DataFrame) -> tuple[DataFrame, str]:
    """``components`` and the folder that holds them, for the caller to delete."""
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(F.col("u") != F.col("v"))
    pairs, folder = written(pairs.distinct(), "edges")
    before, now = None, checksum(pairs)
    while now != before and now[0]:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both, "large").where(F.col("u") != F.col("v")).distinct()
        small = _stars(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "small")
        (pairs, folder), older = written(small.where(F.col("u") != F.col("v")).distinct(), "edges"), folder
        delete_shared(edges.sparkSession, older)
        before, now = now, checksum(pairs)
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    ), folder
