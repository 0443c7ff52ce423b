"""An inner join that splits keys whose output would be too much for one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# edges that one task may get: some tens of MB. What is left of a graph is counted before it is compared with this
TASK_EDGES = 100_000
# rows of output that one task makes where they are counted beforehand
_TASK_ROWS = 4_000_000


def grid_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    *,
    left_id: list[str],
    right_id: list[str],
    cell_rows: int,
    right_weight: Column | None = None,
    task_rows: int = _TASK_ROWS,
) -> DataFrame:
    """Inner join on `key`, exact for any distribution.

    A key with l rows left and r rows right produces l*r rows. Skew handling by input size cannot
    see that, since few input bytes may multiply into a huge output. Keys over `cell_rows` are
    cut into a grid: left rows fall into one of ceil(l/s) bands and are copied across the right
    bands, right rows the other way round, with s = sqrt(cell_rows). A cell then yields about
    `cell_rows` rows, and the copies add 2/s of the output. All other keys join unchanged.

    `left_id` and `right_id` name columns that tell the rows of a side apart: they choose the
    band, so equal rows would share one. `right_weight` is how many rows a right row stands for, if
    the caller multiplies it after the join; cells are then of `cell_rows` rows after that, and where the output
    is more than `task_rows` rows, tasks are as many as it takes for that many each: by the bytes of the
    inputs Spark would make few tasks, of any output. Both inputs are read several times when there are hot
    keys: pass scans, not computations.
    """
    side = max(1, math.isqrt(cell_rows))
    sizes = (
        left.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_l"))
        .join(
            right.groupBy(key).agg(
                F.sum(F.lit(1) if right_weight is None else right_weight).alias("_r")
            ),
            key,
        )
        .withColumn("_n", (F.col("_l") * F.col("_r")).cast("double"))
    )
    hot = sizes.where(F.col("_n") > cell_rows).select(
        key,
        F.ceil(F.col("_l") / side).alias("_left_bands"),
        F.ceil(F.col("_r") / side).alias("_right_bands"),
    )
    tasks = 0
    if right_weight is None:
        any_hot = not hot.isEmpty()
    else:
        total, greatest = sizes.agg(F.sum("_n"), F.max("_n")).first()
        any_hot = (greatest or 0) > cell_rows
        if (total or 0) > task_rows:
            least = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            tasks = max(least, math.ceil(total / task_rows))

    def joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        if tasks:
            left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
        return left.join(right, keys)

    if not any_hot:
        return joined(left, right, [key])

    def banded(df: DataFrame, own: str, other: str, ids: list[str]) -> DataFrame:
        sized = df.join(hot, key, "left").na.fill(1, ["_left_bands", "_right_bands"])
        return sized.withColumns(
            {
                f"_{own}": F.pmod(F.xxhash64(*ids), F.col(f"_{own}_bands")),
                f"_{other}": F.explode(F.sequence(F.lit(0), F.col(f"_{other}_bands") - 1)),
            }
        ).drop("_left_bands", "_right_bands")

    return joined(
        banded(left, "left", "right", left_id),
        banded(right, "right", "left", right_id),
        [key, "_left", "_right"],
    ).drop("_left", "_right")
