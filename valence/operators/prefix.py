"""Running values over one total order of all rows, without bringing the rows together.

Rows are dealt out by ranges of the order and numbered across the ranges. Blocks of
neighbouring numbers have a bounded size whatever the data; sums over blocks are small,
and what a block begins with is a sum over the blocks before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sinks.writers import stage

#: Rows of a block, and blocks of a group of blocks, as powers of two.
BLOCK_BITS = 13


def numbered(rows: DataFrame, *order: Column, into: str = "pos") -> DataFrame:
    """Rows with their place in ``order``, from 0 without a gap. The result reads a written table.

    Equal rows differ by their place in the scan, so that a value which many rows share is
    dealt out as well. The counts of the ranges, one row each, are all that is summed up.
    """
    by = [*order, F.col("__scan")]
    dealt = rows.withColumn("__scan", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    dealt = dealt.withColumns({"__part": F.spark_partition_id(), "__id": F.monotonically_increasing_id()})
    dealt = stage(dealt.drop("__scan"), "ranges")
    counts = dealt.groupBy("__part").agg(F.count("*").alias("n"), F.min("__id").alias("first"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("__part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return dealt.join(counts, "__part").withColumn(into, F.col("__id") + F.col("shift")).drop("__part", "__id", "shift")


def block_of(pos: str = "pos") -> Column:
    return F.shiftright(pos, BLOCK_BITS)


def before_blocks(sums: DataFrame, names: list[str], *keys: str, least: tuple[str, ...] = ()) -> DataFrame:
    """For each ``block`` (and ``keys``) the sums of ``names`` over all blocks before it, and the smallest values of ``least``.

    Two steps, so that no window holds all blocks: within a group of blocks, and over the groups.
    """
    add = lambda name: F.min(name) if name in least else F.sum(name)
    grouped = sums.withColumn("group", F.shiftright("block", BLOCK_BITS))
    columns = [*names, *least]
    groups = grouped.groupBy("group", *keys).agg(*[add(n).alias(n) for n in columns])
    earlier = Window.partitionBy(*keys).orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("group", *keys, *[add(n).over(earlier).alias(f"__{n}") for n in columns])
    inside = Window.partitionBy("group", *keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    near = grouped.select("block", "group", *keys, *[add(n).over(inside).alias(n) for n in columns])
    both = near.join(groups, ["group", *keys])
    total = lambda n: F.coalesce(F.col(n), F.lit(0)) + F.coalesce(F.col(f"__{n}"), F.lit(0))
    return both.select(
        "block", *keys, *[total(n).alias(n) for n in names], *[F.least(n, f"__{n}").alias(n) for n in least]
    )
