"""Dense row numbers over a total order, without bringing the rows together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from temporal_tree.sources.scratch import Scratch

# monotonically_increasing_id puts the partition above these bits and the row below
_ROW_BITS = 33


def dense_keys(df: DataFrame, order: list[str], name: str, scratch: Scratch) -> DataFrame:
    """`df` with `name` = 1..n in the given order, nulls first. The order columns must tell rows
    apart; that also lets the range partitioning split any of their prefixes."""
    return number_in_place(
        df.repartitionByRange(*order).sortWithinPartitions(*order), name, scratch
    )


def number_in_place(df: DataFrame, name: str, scratch: Scratch) -> DataFrame:
    """Numbers rows that already stand in order, within and across partitions.

    The rows are written once with their partition and position; the key is the position plus the
    size of the partitions before. Since it is read from the written rows, a task that runs again
    cannot change a number. Partition sizes are one row per task, hence small enough to broadcast.
    """
    placed = df.withColumn("_id", F.monotonically_increasing_id())
    table = scratch.stage("ordered", lambda: placed)
    partition = F.shiftright("_id", _ROW_BITS)
    position = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    before = F.sum("rows").over(
        Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    )
    sizes = (
        table.groupBy(partition.alias("_partition"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("_partition", F.coalesce(before, F.lit(0)).alias("_offset"))
    )
    offsets = scratch.stage("offsets", lambda: sizes)
    return (
        table.withColumn("_partition", partition)
        .join(F.broadcast(offsets), "_partition")
        .withColumn(name, F.col("_offset") + position + 1)
        .drop("_partition", "_offset", "_id")
    )
