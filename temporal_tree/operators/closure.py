"""Every acyclic path below every parent, up to a depth limit, with partner and root flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temporal_tree.operators.joins import grid_join
from temporal_tree.operators.normalize import partner_ids
from temporal_tree.sources.scratch import Scratch, setting

_NODE = ["parent_account_id", "child_account_id", "root_account_id", "level_depth", "path"]
_EDGE_FLAGS = ["parent_is_partner", "child_is_partner"]


def flag_edges(edges: DataFrame, entity_types: DataFrame) -> DataFrame:
    """Edges with the partner status of both ends.

    Done before the closure, this makes the three flags of a path a by-product: the last edge
    gives parent and child, the first edge gives the root. The closure, which is many times
    larger than its edges, needs no join of its own.
    """
    partners = partner_ids(entity_types)
    for end in ("parent", "child"):
        known = partners.select(
            F.col("account_id").alias(f"{end}_account_id"), F.lit(1).alias(f"{end}_is_partner")
        )
        edges = edges.join(known, f"{end}_account_id", "left")
    return edges.na.fill(0, _EDGE_FLAGS)


def paths(
    edges: DataFrame,
    max_depth: int = 12,
    method: str = "doubling",
    *,
    scratch: Scratch | None = None,
    cell_rows: int = 1_000_000,
    name: str = "paths",
) -> DataFrame:
    """All acyclic paths of 1..max_depth edges, one row per path. Tables written on the way are named `name`.

    `path` is the array of accounts from the root down. Flags on the edges (`flag_edges`) carry
    over, plus `root_is_partner`.
    """
    if method not in ("doubling", "cte"):
        raise ValueError("method must be 'doubling' or 'cte'")
    scratch = scratch or Scratch(edges.sparkSession)
    if method == "cte":
        return _saved_recursion(_paths_by_cte(edges, max_depth), scratch, name)
    return _paths_by_doubling(edges, max_depth, scratch, cell_rows, name)


def _single_edges(edges: DataFrame) -> DataFrame:
    base = edges.select(
        "parent_account_id",
        "child_account_id",
        F.col("parent_account_id").alias("root_account_id"),
        F.lit(1).alias("level_depth"),
        F.array("parent_account_id", "child_account_id").alias("path"),
        *[c for c in _EDGE_FLAGS if c in edges.columns],
    )
    if "parent_is_partner" in base.columns:
        base = base.withColumn("root_is_partner", F.col("parent_is_partner"))
    return base


def _paths_by_doubling(
    edges: DataFrame, max_depth: int, scratch: Scratch, cell_rows: int, name: str
) -> DataFrame:
    """A path longer than k edges is, in exactly one way, a path of k edges followed by a shorter
    or equal one. With all paths up to k known, one join therefore gives all up to 2k: four
    joins reach depth 12, where growing by one edge takes eleven and shuffles every level."""

    def save(part: DataFrame, reach: int) -> tuple[DataFrame, int]:
        at_reach = F.coalesce(F.sum((F.col("level_depth") == reach).cast("long")), F.lit(0))
        table, seen = scratch.save_measured(part, f"{name}-to-{reach}", longest=at_reach)
        return table, seen["longest"]

    part, longest = save(_single_edges(edges), 1)
    parts, reach = {1: part}, 1  # by least level
    while reach < max_depth and longest:
        target = min(2 * reach, max_depth)
        heads = part.where(F.col("level_depth") == reach)
        short = [p for least, p in parts.items() if least <= target - reach]
        tails = reduce(DataFrame.unionByName, short).where(
            F.col("level_depth") <= target - reach
        )
        part, longest = save(_concatenate(heads, tails, cell_rows), target)
        parts[reach + 1] = part
        reach = target
    return reduce(DataFrame.unionByName, parts.values())


def _concatenate(heads: DataFrame, tails: DataFrame, cell_rows: int) -> DataFrame:
    """Paths made of a head and a tail that starts where the head ends and repeats none of its
    accounts."""
    first = heads.select(
        F.col("child_account_id").alias("joint"),
        "root_account_id",
        F.col("level_depth").alias("head_depth"),
        F.col("path").alias("head"),
        *[c for c in ("root_is_partner",) if c in heads.columns],
    )
    second = tails.select(
        F.col("root_account_id").alias("joint"),
        "parent_account_id",
        "child_account_id",
        F.col("level_depth").alias("tail_depth"),
        F.expr("slice(path, 2, level_depth)").alias("tail"),
        *[c for c in _EDGE_FLAGS if c in tails.columns],
    )
    joined = grid_join(
        first, second, "joint", left_id=["head"], right_id=["tail"], cell_rows=cell_rows
    )
    return (
        joined.where(~F.arrays_overlap("head", "tail"))
        .withColumns(
            {
                "level_depth": F.col("head_depth") + F.col("tail_depth"),
                "path": F.concat("head", "tail"),
            }
        )
        .select(*heads.columns)
    )


def _paths_by_cte(edges: DataFrame, max_depth: int) -> DataFrame:
    """The same rows as one recursive query."""
    base = _single_edges(edges)
    flags = [c for c in base.columns if c not in _NODE]
    grown = {
        "parent_account_id": "e.parent_account_id",
        "child_account_id": "e.child_account_id",
        "root_account_id": "p.root_account_id",
        "level_depth": "p.level_depth + 1",
        "path": "array_append(p.path, e.child_account_id)",
        "root_is_partner": "p.root_is_partner",
    }
    step = ", ".join(grown.get(c, f"e.{c}") for c in _NODE + flags)
    return edges.sparkSession.sql(
        f"""
        WITH RECURSIVE p({", ".join(_NODE + flags)}) AS (
          SELECT {", ".join(_NODE + flags)} FROM {{base}}
          UNION ALL
          SELECT {step} FROM p JOIN {{edges}} e ON e.parent_account_id = p.child_account_id
          WHERE p.level_depth < {int(max_depth)} AND NOT array_contains(p.path, e.child_account_id)
        )
        SELECT * FROM p
        """,
        base=base,
        edges=edges,
    )


def _saved_recursion(found: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """What a recursive query finds, written without Spark's limits on its rows and rounds, which would end it
    with an error. They are settings of the session when it runs, hence the write; `level_depth` ends it."""
    with (
        setting(scratch.spark, "spark.sql.cteRecursionRowLimit", "-1"),
        setting(scratch.spark, "spark.sql.cteRecursionLevelLimit", "-1"),
    ):
        return scratch.save(found, name)


def partner_flags(hierarchy: DataFrame, entity_types: DataFrame) -> DataFrame:
    """Whether parent, child and root are partners, for a hierarchy that was built without flags.

    Each join has one row per account on its right side and the hierarchy on its left, so a root
    or parent that owns a large share of the rows is split at runtime like any left join."""
    partners = partner_ids(entity_types)
    flags = []
    for role in ("parent", "child", "root"):
        known = partners.select(
            F.col("account_id").alias(f"{role}_account_id"), F.lit(1).alias(f"{role}_is_partner")
        )
        hierarchy = hierarchy.join(known, f"{role}_account_id", "left")
        flags.append(f"{role}_is_partner")
    return hierarchy.na.fill(0, flags)


def root_flags(hierarchy: DataFrame) -> DataFrame:
    """`is_root_manager`: the row's parent is the root. `is_root_partner_manager`: in addition the
    parent is a partner, at level 1 or as the root itself."""
    at_root = F.col("parent_account_id") == F.col("root_account_id")
    partner_parent = (F.col("parent_is_partner") == 1) & (F.col("level_depth") == 1)
    partner_root = (F.col("root_is_partner") == 1) & at_root
    return hierarchy.withColumns(
        {
            "is_root_manager": at_root.cast("int"),
            "is_root_partner_manager": (partner_parent | partner_root).cast("int"),
        }
    )


def shortest_levels(
    edges: DataFrame, *, scratch: Scratch | None = None, cell_rows: int = 1_000_000
) -> DataFrame:
    """The least number of edges from every account to every account below it, without a limit.

    Only pairs are kept, never paths. With the levels of all pairs up to k edges apart known, a
    shortest way of up to 2k edges is one of exactly k and one of at most k, so each round doubles
    the reach until no pair is that far apart: the rounds are logarithmic in the longest one.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    pair = ["root_account_id", "child_account_id"]

    def save(part: DataFrame, reach: int) -> tuple[DataFrame, int]:
        at_reach = F.coalesce(F.sum((F.col("shortest_level") == reach).cast("long")), F.lit(0))
        table, seen = scratch.save_measured(part, f"levels-to-{reach}", longest=at_reach)
        return table, seen["longest"]

    known, longest = save(
        edges.where("parent_account_id <> child_account_id")
        .select(
            F.col("parent_account_id").alias("root_account_id"),
            "child_account_id",
            F.lit(1).alias("shortest_level"),
        )
        .distinct(),
        1,
    )
    reach = 1
    while longest:
        heads = known.where(F.col("shortest_level") == reach).select(
            F.col("child_account_id").alias("joint"), "root_account_id"
        )
        tails = known.select(
            F.col("root_account_id").alias("joint"), "child_account_id", "shortest_level"
        )
        farther = (
            grid_join(
                heads, tails, "joint",
                left_id=["root_account_id"], right_id=["child_account_id"], cell_rows=cell_rows,
            )
            .where("root_account_id <> child_account_id")
            .groupBy(*pair)
            .agg((F.min("shortest_level") + reach).alias("shortest_level"))
            .join(known.select(*pair), pair, "left_anti")
        )
        found, longest = save(farther, 2 * reach)
        known, reach = known.unionByName(found), 2 * reach
    return known


def root_levels(edges: DataFrame, *, scratch: Scratch | None = None) -> DataFrame:
    """`account_id`, `level`: the least number of edges from any root, an account without a parent, to each account
    below one. Roots are at level 0; accounts that no root leads to, which takes a cycle, are left out.

    A search from all roots at once: a round takes the edges of the accounts found last and keeps those of
    their children that are not settled. All rounds together write a row per account and look up each
    edge once, whatever the number of pairs or paths.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    pairs = edges.where("parent_account_id <> child_account_id").select("parent_account_id", "child_account_id")
    children = pairs.select(F.col("child_account_id").alias("account_id"))
    roots = pairs.select(F.col("parent_account_id").alias("account_id")).distinct().join(children, "account_id", "left_anti")

    def save(accounts: DataFrame, level: int) -> tuple[DataFrame, int]:
        table, seen = scratch.save_measured(
            accounts.withColumn("level", F.lit(level)), f"level-{level}", n=F.count(F.lit(1))
        )
        return table, seen["n"]

    found, n = save(roots, 0)
    levels = [found]
    while n:
        settled = reduce(DataFrame.unionByName, levels).select("account_id")
        below = (
            pairs.join(found.select(F.col("account_id").alias("parent_account_id")), "parent_account_id", "left_semi")
            .select(F.col("child_account_id").alias("account_id"))
            .distinct()
            .join(settled, "account_id", "left_anti")
        )
        found, n = save(below, len(levels))
        levels.append(found)
    return reduce(DataFrame.unionByName, levels)
