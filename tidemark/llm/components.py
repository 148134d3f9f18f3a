"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def _stars(links: DataFrame, large: bool, name: str) -> DataFrame:
    """Hang every node's larger (``large``) or smaller neighbours, and itself, on its smallest neighbour."""
    ends = links.select("a", "b")
    if large:
        ends = ends.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Written before the join: then both sides of it are plain exchanges, of which a hub's can be split.
    least = written(ends.groupBy("a").agg(F.min("b").alias("m")), f"{name}-least")
    hung = ends.join(least, "a")
    if large:
        rows = hung.where(F.col("b") > F.col("a")).select("b", F.least("a", "m").alias("m"))
    else:
        rows = hung.where(F.col("b") != F.col("m")).select("b", "m").unionByName(
            least.select(F.col("a").alias("b"), "m")
        )
    return written(rows.distinct().select(F.col("b").alias("a"), F.col("m").alias("b")), name)


def connected_components(links: DataFrame, name: str = "links") -> DataFrame:
    """(``node``, ``root``): every node of the links (``a``, ``b``, comparable, no nulls) with the smallest node that
    it reaches; nodes that are their own root and loops have no row.

    Each round halves paths: larger neighbours, then smaller ones, move to the smallest neighbour (Kiveris and
    others, 2014).  Rounds end when links stay as they are.  Nothing is gathered: a hub's links lie in many tasks.
    """
    now = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name
    )
    mark = None
    while True:
        row = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (row["n"], row["s"]) == mark or not row["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = (row["n"], row["s"])
        now = _stars(_stars(now, True, name), False, name)
