"""Running totals and global numbering that never sort one group, or everything, in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.session import cut

# Width of an order-column range handled by one task of a running total.
BLOCK = 1_000_000


def running_totals(
    rows: DataFrame,
    group: list[str],
    order: str,
    measures: dict[str, Column],
    include_current: bool = True,
    block: int = BLOCK,
) -> DataFrame:
    """Add running sums of ``measures`` within ``group`` along the integer column ``order``.

    ``order`` is unique within a group. It is cut into ranges of ``block`` values, so a window task
    sees at most ``block`` rows of a group however large the group is. What came before a range is
    a running sum over per-range totals, one small row each.
    """
    ranged = rows.withColumn("_block", F.floor(F.col(order) / F.lit(block)).cast("bigint"))
    names = list(measures)
    end = Window.currentRow if include_current else -1
    inside = (
        Window.partitionBy(*group, "_block")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, end)
    )
    earlier = (
        Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    per_block = ranged.groupBy(*group, "_block").agg(
        *[F.sum(measures[m]).alias(f"_sum_{m}") for m in names]
    )
    before = per_block.select(
        *group,
        "_block",
        *[F.coalesce(F.sum(f"_sum_{m}").over(earlier), F.lit(0)).alias(f"_before_{m}") for m in names],
    )
    local = ranged.withColumns(
        {f"_in_{m}": F.coalesce(F.sum(measures[m]).over(inside), F.lit(0)) for m in names}
    )
    # Rows without a group value are a group of their own; the plain key lets hot groups be split.
    keys = [*group, "_block"]
    named = before.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = [local[k].eqNullSafe(named[f"_of_{k}"]) for k in keys]
    joined = local.join(named, same)
    return joined.select(
        *rows.columns,
        *[(F.col(f"_in_{m}") + F.col(f"_before_{m}")).cast("bigint").alias(m) for m in names],
    )


def running_domain_counts(rows: DataFrame, order: str = "seq", block: int = BLOCK) -> DataFrame:
    """Pages seen so far, this row included, in the row's domain and in its superdomain."""
    one = F.lit(1).cast("bigint")
    by_domain = running_totals(
        rows, ["log", "domain"], order, {"domain_count": one}, block=block
    )
    return running_totals(
        by_domain, ["log", "superdomain"], order, {"super_count": one}, block=block
    )


def running_backoff(
    rows: DataFrame,
    failed: Column,
    threshold: int = 5,
    order: str = "seq",
    block: int = BLOCK,
) -> DataFrame:
    """Failures of the row's domain before the row, and whether they reach ``threshold``."""
    counted = running_totals(
        rows,
        ["log", "domain"],
        order,
        {"earlier_failures": failed.cast("bigint")},
        include_current=False,
        block=block,
    )
    return counted.withColumn("blocked", F.col("earlier_failures") >= threshold)


def numbered(
    rows: DataFrame, keys: list[str | Column], name: str = "rank", partitions: int | None = None
) -> DataFrame:
    """Number rows from 1 in the global order of ``keys``, materialised on the way.

    Rows are range-partitioned and sorted, written out once, and numbered by their place in their
    partition plus the sizes of the partitions before. The table of sizes has one row per partition,
    so it is small whatever the data. ``keys`` should end in a unique column.
    """
    spark = rows.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(
        rows.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    # monotonically_increasing_id: partition in the upper bits, row in the lower 33.
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = sizes.select(
        "_part",
        F.coalesce(
            F.sum("_size").over(
                Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_before"),
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(before), "_part")
        .withColumn(
            name,
            (F.col("_before") + F.col("_place") - F.shiftleft("_part", 33) + 1).cast("bigint"),
        )
        .drop("_part", "_place", "_before")
    )
