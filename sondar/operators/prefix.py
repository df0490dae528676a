"""Dense ordinals and running sums within groups of any size, without sending a group to one task.

A group is cut into parts by a hash of its rows (or by ranges of the order); counts or sums per part, then per part's
offset, then rows within their part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import Scratch
from .skew import sized_join

#: Rows that one part of a group should have.
PART_ROWS = 20_000
#: Hash values lie below this.
TOP = 1 << 52


def even_hash(*cols: Column | str) -> Column:
    """A hash below 2**52, even, the same everywhere."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 12)


def parts_of(rows: Column) -> Column:
    """How many parts a group of so many rows is cut into."""
    return F.ceil(rows / F.lit(PART_ROWS)).cast("bigint")


def running(df: DataFrame, group: list[str], order: str, ties: list[str], value: Column, parts: Column, scratch: Scratch, name: str = "start") -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over all rows of its group that come before it.

    The order within a group is by ``order`` (a hash below 2**52), then ``ties``; ``parts`` (at least 1) is the number of
    ranges of the hash that the group is cut into. Rows equal in all of these follow each other in no fixed order.
    """
    df = df.withColumn("__part", F.floor(F.col(order) / F.lit(float(TOP)) * parts).cast("bigint")).withColumn("__v", value)
    sums = df.groupBy(*group, "__part").agg(F.sum("__v").alias("__s"))
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*group, "__part", F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__offset"))
    joined = sized_join(df, offsets, [*group, "__part"], "inner", ties, scratch)
    within = Window.partitionBy(*group, "__part").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumn(name, F.col("__offset") + F.coalesce(F.sum("__v").over(within), F.lit(0))).drop("__part", "__v", "__offset")


def ordinal(df: DataFrame, order: list[str], name: str = "ordinal", start: int = 1) -> DataFrame:
    """``df`` with a dense ordinal by ``order``, over all rows: range partitions, their counts, row numbers within.

    The order must be total for the ordinals to be reproducible; NULLs come first. Counts (one a partition) go through
    the driver's plan as a table of as many rows as there are partitions.
    """
    keys = [F.col(c).asc_nulls_first() for c in order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    spark = df.sparkSession
    scratch = Scratch(spark, "ordinal")
    # the ranges come from a sample, so they are written once: counts and numbers must see the same ones
    fixed = scratch.keep(ranged.withColumn("__pid", F.spark_partition_id()).withColumn("__pos", F.monotonically_increasing_id()))
    counts = fixed.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))  # a row a partition
    local = F.col("__pos") - F.shiftleft(F.col("__pid").cast("bigint"), 33)
    return fixed.join(F.broadcast(offsets), "__pid").withColumn(name, (F.col("__offset") + local + F.lit(start)).cast("bigint")).drop("__pid", "__pos", "__offset")
