"""Connected components and cycles of the account graph, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temporal_tree.operators import closure, parts
from temporal_tree.operators.joins import TASK_EDGES
from temporal_tree.sources.scratch import Scratch


def on_cycles(
    edges: DataFrame,
    *,
    scratch: Scratch | None = None,
    cell_rows: int = 1_000_000,
    task_edges: int = TASK_EDGES,
) -> DataFrame:
    """The edges that lie on a cycle, of any length, with the length of the shortest one.

    Those are the edges inside strongly connected parts (`parts.cycle_parts`, linear in accounts and edges).
    Where a part is one ring its size is the length; only inside the others is it asked how far each
    edge's child is from its parent.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    members = parts.cycle_parts(edges, scratch=scratch, task_edges=task_edges)
    inside = scratch.save(parts.inside_parts(edges, members), "inside")
    sizes = members.groupBy("part_id").agg(F.count(F.lit(1)).alias("accounts"))
    rings = (
        inside.groupBy("part_id")
        .agg(F.count(F.lit(1)).alias("edges"))
        .join(sizes, "part_id")
        .where("edges = accounts")
        .select("part_id", F.col("edges").cast("int").alias("shortest_cycle"))
    )
    rings = scratch.save(rings, "rings")
    ends = ["parent_account_id", "child_account_id"]
    on_rings = inside.join(rings, "part_id").select(*ends, "shortest_cycle")
    knotted = inside.join(rings, "part_id", "left_anti").select(*ends)
    levels = closure.shortest_levels(knotted, scratch=scratch, cell_rows=cell_rows)
    back = levels.select(
        F.col("child_account_id").alias("parent_account_id"),
        F.col("root_account_id").alias("child_account_id"),
        (F.col("shortest_level") + 1).alias("shortest_cycle"),
    )
    return on_rings.unionByName(knotted.join(back, ends).select(*ends, "shortest_cycle"))


def cycles(
    edges: DataFrame,
    max_length: int,
    *,
    scratch: Scratch | None = None,
    cell_rows: int = 1_000_000,
) -> DataFrame:
    """Every simple cycle of at most `max_length` edges, once, from its least account.

    Their number may be exponential, hence the limit. `on_cycles` has none: an edge that it lists with
    a longer shortest cycle is on cycles that are left out here. A cycle is a path of edges on cycles
    plus an edge from its end to its root. That join is on both accounts, which at most one edge
    matches, so it neither multiplies rows nor gathers a hub in one task.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    inside = on_cycles(edges, scratch=scratch, cell_rows=cell_rows)
    inside = scratch.save(
        inside.where(F.col("shortest_cycle") <= max_length).drop("shortest_cycle"), "on-cycles"
    )
    closing = inside.select(
        F.col("parent_account_id").alias("child_account_id"),
        F.col("child_account_id").alias("root_account_id"),
    )
    if max_length < 2:
        open_paths = closure.paths(inside.limit(0), 1, scratch=scratch)
    else:
        open_paths = closure.paths(
            inside, max_length - 1, scratch=scratch, cell_rows=cell_rows
        ).where(F.col("root_account_id") == F.array_min("path"))
    return open_paths.join(closing, ["child_account_id", "root_account_id"]).select(
        "root_account_id",
        (F.col("level_depth") + 1).alias("cycle_length"),
        F.array_append("path", F.col("root_account_id")).alias("path"),
    )


def components(edges: DataFrame, *, scratch: Scratch | None = None) -> DataFrame:
    """`account_id`, `component_id`: the least account that is connected to it, in any direction.

    Alternates the large-star and small-star steps of Kiveris et al., "Connected Components in
    MapReduce and Beyond" (2014), which shorten every path to the least account in a number of
    rounds that is logarithmic in practice, not proportional to the diameter. A round is two
    grouped minima, combined before their shuffles, and two joins against them with one row per
    account, which AQE can split on the edge side.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    accounts = (
        edges.select(F.explode(F.array("parent_account_id", "child_account_id")).alias("account_id"))
        .distinct()
    )
    # links point from the greater to the lesser account
    links = edges.select(
        F.greatest("parent_account_id", "child_account_id").alias("hi"),
        F.least("parent_account_id", "child_account_id").alias("lo"),
    ).where("hi <> lo")

    def save(df: DataFrame) -> tuple[DataFrame, tuple]:
        # the fingerprint tells whether a round changed the set of links
        return scratch.save_measured(
            df,
            "links",
            rows=F.count(F.lit(1)),
            digest=F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")),
        )

    links, before = save(links.distinct())
    while True:
        links, after = save(_small_star(_large_star(links)))
        if after == before:
            break
        before = after
    return accounts.join(
        links.select(F.col("hi").alias("account_id"), F.col("lo").alias("component_id")),
        "account_id",
        "left",
    ).select("account_id", F.coalesce("component_id", "account_id").alias("component_id"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every account hands its least neighbour to its greater neighbours."""
    both = links.select(
        F.inline(
            F.array(
                F.struct(F.col("hi").alias("center"), F.col("lo").alias("near")),
                F.struct(F.col("lo").alias("center"), F.col("hi").alias("near")),
            )
        )
    )
    least = both.groupBy("center").agg(F.least(F.min("near"), F.col("center")).alias("lo"))
    return (
        both.where("near > center")
        .join(least, "center")
        .select(F.col("near").alias("hi"), "lo")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every account and its lesser neighbours move to the least of them."""
    least = links.groupBy("hi").agg(F.min("lo").alias("least"))
    moved = links.join(least, "hi").where("lo <> least").select(F.col("lo").alias("hi"), "least")
    return moved.unionByName(least.select("hi", "least")).toDF("hi", "lo").distinct()
