"""Connected components of a distributed link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import saved


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step: neighbours of a node are linked to the smallest node among them.

    The large step moves the larger neighbours, the small step the smaller ones and the node itself.
    Neighbourhoods are never gathered: each is its minimum and a join.
    """
    around = _both_ways(links) if large else links.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    least = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    found = around.join(least, "a")
    if large:
        out = found.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = found.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            least.select("a", F.col("least").alias("b"))
        )
    return out.filter("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of every end of ``links(a, b)``: the smallest id that can be reached.

    Alternating star steps until nothing changes, each written to the shared folder. The number of
    steps grows with the logarithm of the longest chain; only the change of two sums is read by the
    driver. An empty link table gives no rows.
    """
    now, mark = saved(links.select("a", "b").filter("a != b").distinct()), None
    while True:
        now = saved(_star(_star(now, large=True), large=False))
        sums = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(sums) == mark:
            break
        mark = tuple(sums)
    tops = now.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(tops)
