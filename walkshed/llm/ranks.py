"""Gapless ranks inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walkshed.llm.common import stage


def numbered_parts(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``df``, staged, with ``part__`` and ``place__``: ranges of rows by group and order, numbered within.

    Rows are dealt by range, so a group that holds most rows is divided among parts in its
    order; rows equal in ``order`` are dealt out by chance. ``place__`` counts from 1 in each
    part of a group. Columns of ``group`` hold no nulls.
    """
    keyed = df.withColumn("tie__", F.xxhash64(F.monotonically_increasing_id()))
    dealt = keyed.repartitionByRange(*group, *order, "tie__").withColumn("part__", F.spark_partition_id())
    within = Window.partitionBy("part__", *group).orderBy(*order, "tie__")
    return stage(dealt.withColumn("place__", F.row_number().over(within)).drop("tie__"), "numbered")


def part_offsets(numbered: DataFrame, group: Sequence[str]) -> DataFrame:
    """(part__, group, before__, total__): of every part of a group the rows before it, and the group's size."""
    counts = numbered.groupBy("part__", *group).agg(F.count("*").alias("n__"))
    every = Window.partitionBy(*group)
    upto = every.orderBy("part__").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.select(
        "part__", *group, (F.sum("n__").over(upto) - F.col("n__")).alias("before__"), F.sum("n__").over(every).alias("total__")
    )
