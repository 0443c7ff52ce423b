"""Data checks. Each is one pass over its input and returns `metric`, `value` rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from temporal_tree.schemas import open_end


def _report(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """The measures of one aggregation as rows; an absent measure (no rows) is 0."""
    values = df.agg(
        *[F.coalesce(c, F.lit(0)).cast("long").alias(name) for name, c in measures.items()]
    )
    return values.unpivot([], list(measures), "metric", "value")


def relationships(edges: DataFrame, clean: DataFrame | None = None) -> DataFrame:
    """Size of the edge table, self-references and missing ends, best of the edges as they came in; with
    `clean` also the number of edges that are left."""
    parent, child = F.col("parent_account_id"), F.col("child_account_id")
    report = _report(
        edges,
        {
            "total_relationships": F.count(F.lit(1)),
            "self_references": F.count_if(parent == child),
            "null_parents": F.count_if(parent.isNull()),
            "null_children": F.count_if(child.isNull()),
        },
    )
    if clean is None:
        return report
    return report.unionByName(_report(clean, {"clean_relationships": F.count(F.lit(1))}))


def mappings(clean: DataFrame) -> DataFrame:
    """Size of the mapping table and dates after the open end, which invert the last period."""
    late = (F.col("effective_start_date") > open_end()) | (
        F.col("effective_end_date") > open_end()
    )
    return _report(
        clean,
        {"total_mappings": F.count(F.lit(1)), "dates_after_open_end": F.count_if(late)},
    )


def hierarchy(counts: DataFrame, on_cycles: DataFrame, max_depth: int = 12) -> DataFrame:
    """Size, depth and roots of the hierarchy, edges on cycles, and the paths that the depth limit leaves out
    (`beyond_max_depth`: those one edge longer), from counts of paths (`parts.path_counts`) and the
    edges inside strongly connected parts: no path is made."""
    within = F.col("level_depth") <= max_depth
    shape = _report(
        counts,
        {
            "total_nodes": F.sum(F.when(within, F.col("paths"))),
            "max_depth": F.max(F.when(within, F.col("level_depth"))),
            # a path repeats no account, so its last parent is its root at level 1 only
            "root_managers": F.sum(F.when(F.col("level_depth") == 1, F.col("paths"))),
            "beyond_max_depth": F.sum(F.when(~within, F.col("paths"))),
        },
    )
    return shape.unionByName(_report(on_cycles, {"edges_on_cycles": F.count(F.lit(1))}))


def levels(counts: DataFrame, max_depth: int = 12) -> DataFrame:
    """Paths per level, from counts: how fast the closure would grow."""
    return (
        counts.where(F.col("level_depth") <= max_depth)
        .groupBy("level_depth")
        .agg(F.sum("paths").cast("long").alias("path_count"))
    )


def segments(
    counts: DataFrame, managed: DataFrame, mappings: DataFrame, max_depth: int = 12
) -> DataFrame:
    """Segments (`total_segments`), pairs of parent and entity with more than one, and mappings' groups of
    manager, entity and marketplace of which two date ranges overlap.

    A segment is a path in a period of a span of its parent (`temporal.managed_spans`), so segments are
    counted as products of paths per parent and periods per parent and entity, without making them.
    """
    paths = (
        counts.where(F.col("level_depth") <= max_depth)
        .groupBy("parent_account_id")
        .agg(F.sum("paths").cast("decimal(38,0)").alias("paths"))
    )
    counts = (
        managed.groupBy("parent_account_id", "entity_id")
        .agg(F.sum((F.col("hi") - F.col("lo") + 1).cast("long")).alias("periods"))
        .join(paths, "parent_account_id")
        .select((F.col("paths") * F.col("periods")).alias("n"))
    )
    group = ["manager_account_id", "entity_id", "marketplace_id"]
    # starts of a group are distinct, so its size is bounded by the days of the calendar
    earlier = (
        Window.partitionBy(*group)
        .orderBy("effective_start_date")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    overlap = F.max("effective_end_date").over(earlier) >= F.col("effective_start_date")
    overlapping = mappings.select(*group, overlap.alias("overlaps")).where("overlaps").select(*group)
    return _report(
        counts,
        {
            "total_segments": F.sum("n"),
            "accounts_with_multiple_segments": F.count_if(F.col("n") > 1),
        },
    ).unionByName(_report(overlapping.distinct(), {"overlapping_groups": F.count(F.lit(1))}))


def fact(rows: DataFrame, n_rows: int | None = None, *, task_rows: int = 1_000_000) -> DataFrame:
    """Rows, keys that occur more than once (with marketplace, and without as
    `duplicates_ignoring_marketplace`) and ranges that end before they start.

    There are about as many keys as rows, so nothing is saved by counting them where they are read: rows go
    by key to tasks of about `task_rows`, which one shuffle serves both counts. `n_rows` is their number or
    a little more, if it is known; else they are counted first.
    """
    if n_rows is None:
        n_rows = rows.count()
    tasks = max(
        math.ceil(n_rows / task_rows), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    )
    keyed = rows.repartition(
        tasks, "account_id", "entity_id", "effective_start_date", "effective_end_date"
    )
    per_key = (
        keyed.groupBy(
            "account_id",
            "entity_id",
            "marketplace_id",
            "effective_start_date",
            "effective_end_date",
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    coarse = per_key.groupBy(
        "account_id", "entity_id", "effective_start_date", "effective_end_date"
    ).agg(F.sum("n").alias("n"))
    inverted = F.col("effective_start_date") > F.col("effective_end_date")
    return (
        _report(
            rows,
            {"total_records": F.count(F.lit(1)), "inverted_ranges": F.count_if(inverted)},
        )
        .unionByName(_report(per_key, {"duplicates": F.count_if(F.col("n") > 1)}))
        .unionByName(
            _report(coarse, {"duplicates_ignoring_marketplace": F.count_if(F.col("n") > 1)})
        )
    )
