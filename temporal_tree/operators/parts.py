"""Strongly connected parts of the account graph: where its cycles are, without asking which account reaches
which.

Almost all accounts of a hierarchy are on no cycle. They are cut off first, from both sides, in rounds that
contract whole trees at once; what is left is what lies between cycles, and only that is coloured.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temporal_tree.operators import closure, graph
from temporal_tree.operators.joins import TASK_EDGES
from temporal_tree.sources.scratch import Scratch


# a round of cutting off is worth another one if it leaves no more than this part of the edges
_WORTH = 0.5
# steps over edges or pointers in one job: with small rounds a job costs more than what it does
_STEPS = 3


def _rows() -> Column:
    return F.count(F.lit(1))


def _pairs(edges: DataFrame) -> DataFrame:
    """Distinct edges `a` -> `b` between different accounts."""
    return (
        edges.select(F.col("parent_account_id").alias("a"), F.col("child_account_id").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _tops(links: DataFrame, n: int, scratch: Scratch) -> tuple[DataFrame, int]:
    """Follows the pointers `account` -> `top` to their ends: `account`, `top`, `open`, and how many are open for
    ever, because they run in a cycle. Each step doubles the reach; a round writes only what was open before it."""
    done: list[DataFrame] = []
    going = links.select("account", "top", F.lit(True).alias("open"))
    while True:
        pointers = going
        for _ in range(_STEPS):
            known = reduce(DataFrame.unionByName, [*done, pointers.select("account", "top")])
            onward = known.select(F.col("account").alias("top"), F.col("top").alias("next"))
            pointers = pointers.join(onward, "top", "left").select(
                "account", F.coalesce("next", "top").alias("top"), F.col("next").isNotNull().alias("open")
            )
        table, seen = scratch.save_measured(pointers, "tops", open=F.count_if("open"))
        done.append(table.where("not open").select("account", "top"))
        going = table.where("open")
        left = seen["open"] or 0
        # a pointer that ends further off has others before it that end at every shorter distance
        if not left or left == n:
            break
        n = left
    going = going.select("account", "top")
    ended = reduce(DataFrame.unionByName, done).withColumn("open", F.lit(False))
    return ended.unionByName(going.withColumn("open", F.lit(True))), left


def _fed_by_cycles(pairs: DataFrame, scratch: Scratch) -> DataFrame | None:
    """`account`: those that a cycle leads to, or is made of; None if there are none.

    An account with one account before it is fed by a cycle if and only if that one is. So each tree of
    such accounts is contracted to its top, found by doubling pointers, and its further edges become the
    top's. Tops that nothing leads to are dropped with all they hold. Contracting makes new accounts with one
    account before them, so a chain or a ladder of any length takes few rounds; a round holds a row per account
    and edge at most. Rounds end when they leave more than `_WORTH` of the edges: what is left then counts as
    fed, which costs work later, not correctness.
    """
    left, size = pairs, None
    contracted: list[DataFrame] = []
    fed: list[DataFrame] = []
    while True:
        before = left.groupBy("b").agg(_rows().alias("n"), F.min("a").alias("top"))
        # an edge from an account to itself stands for a cycle that was found before
        links = before.where("n = 1 and top <> b").select(F.col("b").alias("account"), "top")
        links, seen = scratch.save_measured(links, "links", rows=_rows())
        n = seen["rows"]
        if n:
            links, looped = _tops(links, n, scratch)
            contracted.append(links.where("not open").select("account", "top"))
            if looped:
                fed.append(links.where("open").select("account"))
            tops = links.select(F.col("account").alias("a"), "top", "open")
            left = (
                left.join(links.select(F.col("account").alias("b")), "b", "left_anti")
                .join(tops, "a", "left")
                .select(F.when(F.col("open"), F.col("b")).otherwise(F.coalesce("top", "a")).alias("a"), "b")
                .distinct()
            )
        ends = left.select(F.col("b").alias("a")).distinct()
        left, seen = scratch.save_measured(left.join(ends, "a", "left_semi").select("a", "b"), "fed", rows=_rows())
        if not seen["rows"]:
            left = None
            break
        if size is not None and seen["rows"] > _WORTH * size:
            break
        size = seen["rows"]
    if left is not None:
        fed.append(left.select(F.col("b").alias("account")).distinct())
    if not fed:
        return None
    known = scratch.save(reduce(DataFrame.unionByName, fed).distinct(), "fed-by-cycles")
    # what was contracted last is resolved first; every account is contracted once
    for links in reversed(contracted):
        tops = known.select(F.col("account").alias("top"))
        more = links.join(tops, "top", "left_semi").select("account")
        known = scratch.save(known.unionByName(more).distinct(), "fed-by-cycles")
    return known


def _between_cycles(pairs: DataFrame, scratch: Scratch) -> DataFrame | None:
    """The edges between accounts that cycles lead to and that lead to cycles."""

    def within(pairs: DataFrame, accounts: DataFrame) -> DataFrame:
        for end in ("a", "b"):
            pairs = pairs.join(accounts.select(F.col("account").alias(end)), end, "left_semi")
        return scratch.save(pairs.select("a", "b"), "between")

    fed = _fed_by_cycles(pairs, scratch)
    if fed is None:
        return None
    pairs = within(pairs, fed)
    feeding = _fed_by_cycles(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")), scratch)
    return within(pairs, feeding)


def _coloured(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """`account`, `above`, `below`: the greatest accounts that lead to it and that it leads to, itself included. A
    round passes both on over several edges."""
    state = pairs.select(F.explode(F.array("a", "b")).alias("account")).distinct()
    state = state.select("account", F.col("account").alias("above"), F.col("account").alias("below"))

    def passed_on(state: DataFrame) -> DataFrame:
        down = pairs.join(state.select(F.col("account").alias("a"), "above"), "a")
        up = pairs.join(state.select(F.col("account").alias("b"), "below"), "b")
        nothing = F.lit(None).cast(state.schema["account"].dataType)
        return (
            state.unionByName(down.select(F.col("b").alias("account"), "above", nothing.alias("below")))
            .unionByName(up.select(F.col("a").alias("account"), nothing.alias("above"), "below"))
            .groupBy("account")
            .agg(F.max("above").alias("above"), F.max("below").alias("below"))
        )

    before = None
    while True:
        for _ in range(_STEPS):
            state = passed_on(state)
        digest = F.sum(F.xxhash64("account", "above", "below").cast("decimal(38,0)"))
        state, seen = scratch.save_measured(state, "colours", digest=digest)
        if seen["digest"] == before:
            return state
        before = seen["digest"]


def _rings(pairs: DataFrame, scratch: Scratch) -> DataFrame | None:
    """Parts that are one ring: components whose accounts have one edge in and one out. They would take as many
    rounds to colour as they are long."""

    def single(end: str) -> DataFrame:
        return pairs.groupBy(F.col(end).alias("account_id")).agg(_rows().alias("n")).where("n = 1").select("account_id")

    plain = single("a").join(single("b"), "account_id")
    for end in ("a", "b"):
        pairs = pairs.join(plain.select(F.col("account_id").alias(end)), end, "left_semi")
    pairs, seen = scratch.save_measured(pairs.select("a", "b"), "plain", rows=_rows())
    if not seen["rows"]:
        return None
    whole = graph.components(pairs.toDF("parent_account_id", "child_account_id"), scratch=scratch)
    whole = scratch.save(whole, "weak")
    sizes = whole.groupBy("component_id").agg(_rows().alias("accounts"), F.max("account_id").alias("part_id"))
    edges = pairs.join(whole, pairs["a"] == whole["account_id"]).groupBy("component_id").agg(_rows().alias("edges"))
    closed = sizes.join(edges, "component_id").where("accounts = edges")
    rings, seen = scratch.save_measured(
        whole.join(closed, "component_id").select("account_id", "part_id"), "rings", rows=_rows()
    )
    return rings if seen["rows"] else None


def _parts_in_one_task(pairs: DataFrame) -> DataFrame:
    """`account_id`, `part_id` of at most `task_edges` edges, which the caller has counted."""

    # nested, so that workers get it by value
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = [edge for batch in batches for edge in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())]
        if not edges:
            return
        onward: dict = {account: [] for edge in edges for account in edge}
        for a, b in edges:
            onward[a].append(b)
        # Gabow's path-based search: `open_` holds accounts without a part, `starts` where parts may begin in it
        place: dict = {}
        settled: set = set()
        open_: list = []
        starts: list[int] = []
        accounts, parts = [], []
        for root in onward:
            if root in place:
                continue
            way = [(root, iter(onward[root]))]
            place[root] = len(open_)
            starts.append(len(open_))
            open_.append(root)
            while way:
                account, rest = way[-1]
                for after in rest:
                    if after not in place:
                        place[after] = len(open_)
                        starts.append(len(open_))
                        open_.append(after)
                        way.append((after, iter(onward[after])))
                        break
                    if after not in settled:
                        while starts[-1] > place[after]:
                            starts.pop()
                else:
                    way.pop()
                    if starts[-1] == place[account]:
                        part = open_[starts.pop() :]
                        del open_[len(open_) - len(part) :]
                        settled.update(part)
                        if len(part) > 1:
                            accounts += part
                            parts += [max(part)] * len(part)
        yield pa.RecordBatch.from_arrays([pa.array(accounts, kind), pa.array(parts, kind)], ["account_id", "part_id"])

    name = pairs.schema["a"].dataType.simpleString()
    kind = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[name]
    return pairs.repartition(1).mapInArrow(find, f"account_id {name}, part_id {name}")


def cycle_parts(
    edges: DataFrame, *, scratch: Scratch | None = None, task_edges: int = TASK_EDGES
) -> DataFrame:
    """`account_id`, `part_id`: the accounts that are on cycles, and the greatest account of their strongly
    connected part. Two accounts are of one part if each can be reached from the other; parts of one account
    are left out.

    Accounts that no cycle leads to, or that lead to none, are cut off (`_fed_by_cycles`, in either direction), and
    rings come out at once. In the rest every account takes two colours, the greatest account that leads to it
    and the greatest that it leads to. If they are the same, that is its part's greatest account; accounts of
    one part share both, so edges between other pairs of colours go and the rest is coloured again (after
    Fleischer, Hendrickson and Pinar, 2000, and Orzan, 2004). Everything saved is a row per account or edge.

    Edges are counted before and between these steps. Once no more than `task_edges` are left, one task searches
    them depth first instead, since further rounds would cost more than what they do; 0 never does.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    parts: list[DataFrame] = []

    def saved(pairs: DataFrame, name: str) -> DataFrame | None:
        """What is still to be divided; None if that is nothing, or little enough for one task."""
        table, seen = scratch.save_measured(pairs.select("a", "b"), name, rows=_rows())
        if not seen["rows"]:
            return None
        if seen["rows"] <= task_edges:
            parts.append(_parts_in_one_task(table))
            return None
        return table

    pairs = saved(_pairs(edges), "pairs")
    if pairs is not None:
        pairs = _between_cycles(pairs, scratch)
    if pairs is not None:
        pairs = saved(pairs, "knots")
    if pairs is not None:
        rings = _rings(pairs, scratch)
        if rings is not None:
            parts.append(rings)
            pairs = pairs.join(rings.select(F.col("account_id").alias("a")), "a", "left_anti")
            pairs = saved(pairs, "open")
    while pairs is not None:
        colours = _coloured(pairs, scratch)
        found = colours.where("above = below")
        sizes = found.groupBy("above").agg(_rows().alias("n")).where("n > 1")
        parts.append(found.join(sizes, "above").select(F.col("account").alias("account_id"), F.col("above").alias("part_id")))
        open_ = colours.where("above <> below").select("account", F.struct("above", "below").alias("colours"))
        pairs = saved(
            pairs.join(open_.select(F.col("account").alias("a"), F.col("colours").alias("_of_a")), "a")
            .join(open_.select(F.col("account").alias("b"), "colours"), "b")
            .where("_of_a = colours"),
            "open",
        )
    if not parts:
        nobody = F.col("parent_account_id")
        return edges.select(nobody.alias("account_id"), nobody.alias("part_id")).limit(0)
    return scratch.save(reduce(DataFrame.unionByName, parts), "parts")


def inside_parts(edges: DataFrame, parts: DataFrame) -> DataFrame:
    """The distinct edges between two accounts of one part, with its `part_id`: exactly those on cycles."""
    return (
        edges.select("parent_account_id", "child_account_id")
        .where("parent_account_id <> child_account_id")
        .distinct()
        .join(parts.select(F.col("account_id").alias("parent_account_id"), "part_id"), "parent_account_id")
        .join(parts.select(F.col("account_id").alias("child_account_id"), F.col("part_id").alias("_other")), "child_account_id")
        .where("part_id = _other")
        .select("parent_account_id", "child_account_id", "part_id")
    )


def path_counts(
    edges: DataFrame,
    max_depth: int,
    *,
    members: DataFrame | None = None,
    scratch: Scratch | None = None,
    cell_rows: int = 1_000_000,
) -> DataFrame:
    """`parent_account_id`, `level_depth`, `paths`: how many acyclic paths of 1..`max_depth` + 1 edges end with an
    edge of that parent, without making them.

    A path enters a strongly connected part once and leaves it once. Outside of parts any walk is a path, so
    paths are counted level by level as grouped sums over edges, a row per account and level. Only inside
    of parts are paths enumerated, and there only as counts by first account, last account and length. Edges
    must be distinct.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    far = max_depth + 1
    ends = ["parent_account_id", "child_account_id"]
    edges = scratch.save(edges.select(*ends).where("parent_account_id <> child_account_id"), "edges")
    if members is None:
        members = cycle_parts(edges, scratch=scratch)
    inner, seen = scratch.save_measured(inside_parts(edges, members).select(*ends), "inside", rows=_rows())
    inside, longest, outer = None, 0, edges
    big = "decimal(38,0)"
    if seen["rows"]:
        outer = scratch.save(edges.join(inner, ends, "left_anti"), "outside")
        found = closure.paths(inner, far, scratch=scratch, cell_rows=cell_rows, name="inside")
        inside, seen = scratch.save_measured(
            found.groupBy(
                F.col("root_account_id").alias("account"), "parent_account_id", "child_account_id", F.col("level_depth").alias("length")
            ).agg(_rows().cast(big).alias("ways")),
            "inside-counts",
            longest=F.max("length"),
        )
        longest = seen["longest"]

    def times(*factors: str) -> Column:
        return reduce(Column.__mul__, map(F.col, factors)).cast(big)

    def total(column: str) -> Column:
        return F.sum(column).cast(big).alias(column)

    # paths of k edges by their last account: all of them, and those that came to it from outside of its part
    one = F.lit(1).cast(big)
    accounts = edges.select(F.explode(F.array(*ends)).alias("account")).distinct()
    here = [scratch.save(accounts.select("account", one.alias("n"), one.alias("entered")), "here-0")]
    for k in range(1, far):
        came = outer.join(here[-1].withColumnRenamed("account", "parent_account_id"), "parent_account_id").select(
            F.col("child_account_id").alias("account"), "n", F.col("n").alias("entered")
        )
        if inside is not None:
            nobody = F.lit(0).cast(big).alias("entered")
            for j in range(max(0, k - longest), k):
                went = here[j].where("entered > 0").join(inside.where(F.col("length") == k - j), "account")
                came = came.unionByName(
                    went.select(F.col("child_account_id").alias("account"), times("entered", "ways").alias("n"), nobody)
                )
        table, seen = scratch.save_measured(
            came.groupBy("account").agg(total("n"), total("entered")), f"here-{k}", rows=_rows()
        )
        if not seen["rows"]:
            break
        here.append(table)
    ending = reduce(DataFrame.unionByName, (t.withColumn("at", F.lit(k)) for k, t in enumerate(here)))
    onward = outer.groupBy(F.col("parent_account_id").alias("account")).agg(_rows().cast(big).alias("edges"))
    counts = ending.join(onward, "account").select(
        F.col("account").alias("parent_account_id"), (F.col("at") + 1).alias("level_depth"), times("n", "edges").alias("paths")
    )
    if inside is not None:
        within = ending.where("entered > 0").join(inside, "account").where(F.col("at") + F.col("length") <= far)
        counts = counts.unionByName(
            within.select("parent_account_id", (F.col("at") + F.col("length")).alias("level_depth"), times("entered", "ways").alias("paths"))
        )
    return counts.groupBy("parent_account_id", "level_depth").agg(total("paths"))
