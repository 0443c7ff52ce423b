"""Periods, the periods each mapping covers, and who manages what in each of them.

Periods are numbered 0..n-1, and what a mapping covers is kept as a span of numbers until rows per
period are asked for. A mapping finds its span with two lookups by date instead of a comparison
with every period. The lookup tables hold distinct calendar dates, so their size is bounded by the
range of the DATE type and in practice by the days of the data's history, whatever the row count:
they are the only tables in this module that are broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from temporal_tree.operators.joins import grid_join
from temporal_tree.operators.normalize import partner_ids
from temporal_tree.schemas import open_end
from temporal_tree.sources.scratch import Scratch

MAPPED = ["manager_account_id", "entity_id", "marketplace_id", "source"]


def periods(mappings: DataFrame, relationships: DataFrame, half_open: bool = False) -> DataFrame:
    """Consecutive periods cut at every mapping start and end and every edge creation date.

    With `half_open` the cut is the day after an end, so that the last day stays in the period
    that ends with it. The window has no partition key, but its rows are distinct dates.
    """
    end = F.col("effective_end_date")
    cut = F.date_add(end, 1) if half_open else end
    days = mappings.select(
        F.explode(
            F.array("effective_start_date", F.when(end != open_end(), cut))
        ).alias("period_start")
    ).unionByName(relationships.select(F.to_date("created_at").alias("period_start")))
    days = days.where(F.col("period_start").isNotNull()).distinct()
    following = F.lead("period_start").over(Window.orderBy("period_start"))
    return days.select(
        "period_start",
        F.coalesce(F.date_sub(following, 1), open_end()).alias("period_end"),
    )


def calendar(periods: DataFrame) -> DataFrame:
    """Everything a span needs to know about dates, one row per day that may be asked for.

    Days listed are every period start, the day before it (an end date is one of the two) and the
    open end. A day that starts a period has the period's number `start_idx`, its end and the end
    of the period before. Every day has `last_idx`, the last period that ends by then, leaving out
    the final one, and `n_periods`. A period ends by day e when the next one starts by e+1.
    """
    in_order = Window.orderBy("period_start")
    start = F.col("period_start")
    numbered = periods.select(
        "period_start",
        (F.row_number().over(in_order) - 1).alias("start_idx"),
        "period_end",
        F.lag("period_end").over(in_order).alias("previous_end"),
    )

    def event(at: Column, starts: int, day: Column, described: bool = False) -> Column:
        about = [
            (F.col(c) if described else F.lit(None)).alias(c)
            for c in ("start_idx", "period_end", "previous_end")
        ]
        return F.struct(at.alias("at"), F.lit(starts).alias("starts"), day.alias("day"), *about)

    nothing = F.lit(None).cast("date")
    events = numbered.select(
        F.inline(
            F.array(
                event(F.date_add(start, 1), 0, start, described=True),
                event(start, 1, nothing),
                event(start, 0, F.date_sub(start, 1)),
            )
        )
    )
    last = periods.sparkSession.range(1).select(
        F.date_add(open_end(), 1).alias("at"), F.lit(0).alias("starts"), open_end().alias("day")
    )
    so_far = Window.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        events.unionByName(last, allowMissingColumns=True)
        .withColumn("last_idx", (F.sum("starts").over(so_far) - 2).cast("int"))
        .withColumn("n_periods", F.sum("starts").over(Window.partitionBy()).cast("int"))
        .where(F.col("day").isNotNull())
        .groupBy("day")
        .agg(
            *[
                F.max(c).alias(c)
                for c in ("last_idx", "n_periods", "start_idx", "period_end", "previous_end")
            ]
        )
    )


def numbered_periods(calendar: DataFrame) -> DataFrame:
    """The periods in a calendar, with their numbers."""
    return calendar.where(F.col("start_idx").isNotNull()).select(
        F.col("start_idx").alias("idx"),
        F.col("day").alias("period_start"),
        "period_end",
        "previous_end",
    )


def coverage(mappings: DataFrame, calendar: DataFrame) -> DataFrame:
    """The spans `lo`..`hi` of periods that lie wholly inside each mapping.

    The final period ends at the open end whatever its start, so it is covered exactly by mappings
    that end no earlier. With dates beyond the open end it need not adjoin the rest of the span and
    becomes a span of its own.
    """
    starts = calendar.select(
        F.col("day").alias("effective_start_date"), F.col("start_idx").alias("lo")
    )
    ends = calendar.select(
        F.col("day").alias("effective_end_date"), F.col("last_idx").alias("hi"), "n_periods"
    )
    final = F.col("n_periods") - 1
    reaches_final = F.col("effective_end_date") >= open_end()
    adjoins = F.col("hi") >= final - 1

    def span(lo: Column, hi: Column) -> Column:
        return F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))

    body = span(F.col("lo"), F.when(reaches_final & adjoins, final).otherwise(F.col("hi")))
    apart = span(final, final)
    return (
        mappings.join(F.broadcast(starts), "effective_start_date")
        .join(F.broadcast(ends), "effective_end_date")
        .select(
            *MAPPED,
            F.inline(
                F.when(reaches_final & ~adjoins, F.array(body, apart)).otherwise(F.array(body))
            ),
        )
        .where("hi >= lo")
    )


def merge_spans(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping and adjoining spans of a key joined into maximal ones.

    With a key that includes manager, entity and marketplace of deduplicated mappings, starts
    are distinct, so no key has more rows than there are periods and none can overload the
    window. The final grouping reuses the window's partitioning.
    """
    by_start = Window.partitionBy(*keys).orderBy("lo")
    reached = F.max("hi").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("lo") <= F.col("_reached") + 1, 0).otherwise(1)
    so_far = by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        spans.withColumn("_reached", reached)
        .withColumn("_island", F.sum(opens).over(so_far))
        .groupBy(*keys, "_island")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .drop("_island")
    )


def uncovered(parents: DataFrame, spans: DataFrame, calendar: DataFrame) -> DataFrame:
    """The spans of periods in which a parent manages nothing: the gaps between its spans.

    Each parent gets a closing span just after the final period, so that every gap, and a parent
    without any mapping, is found by looking at the span that follows. Spans are first reduced to
    the longest per start, within map tasks too: what is left of any parent is bounded by the
    number of periods before the join and the window gather it.
    """
    n_periods = calendar.where(F.col("day") == open_end()).select(
        F.col("day").alias("_open"), F.col("n_periods").alias("lo")
    )
    closing = (
        parents.select("parent_account_id")
        .distinct()
        .withColumn("_open", open_end())
        .join(F.broadcast(n_periods), "_open")
        .select("parent_account_id", "lo", F.col("lo").alias("hi"))
    )
    longest = (
        spans.groupBy(F.col("manager_account_id").alias("parent_account_id"), "lo")
        .agg(F.max("hi").alias("hi"))
        .join(closing.select("parent_account_id"), "parent_account_id", "left_semi")
        .unionByName(closing)
    )
    before = (
        Window.partitionBy("parent_account_id")
        .orderBy("lo")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return longest.select(
        "parent_account_id",
        (F.coalesce(F.max("hi").over(before), F.lit(-1)) + 1).alias("lo"),
        (F.col("lo") - 1).alias("hi"),
    ).where("hi >= lo")


def per_period(spans: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row per period of each span, with the period's dates."""
    dates = numbered_periods(calendar).drop("previous_end")
    return (
        spans.withColumn("idx", F.explode(F.sequence("lo", "hi")))
        .join(F.broadcast(dates), "idx")
        .drop("lo", "hi", "idx")
    )


_SEGMENT = [
    "parent_account_id",
    "child_account_id",
    "root_account_id",
    "level_depth",
    "parent_is_partner",
    "child_is_partner",
    "is_root_manager",
    "is_root_partner_manager",
]


def segments(
    hierarchy: DataFrame,
    periods: DataFrame,
    mappings: DataFrame,
    *,
    keep_unmapped: bool = True,
    cell_rows: int = 100_000,
    days: DataFrame | None = None,
    scratch: Scratch | None = None,
    spread: bool = True,
) -> DataFrame:
    """Every hierarchy row in every period, with each mapping of its parent that spans the period.

    Periods in which the parent manages nothing appear once with NULL mapping columns, unless
    `keep_unmapped` is off. What a parent manages and its gaps are one table of spans, which is written
    and joined once; a cell of that join gets `cell_rows` rows after its spans are spread over periods.
    Pass the calendar as `days` if there is a saved one. A column `root_order` (see `root_order`) is kept.

    With `spread` off, periods of one path and mapping that adjoin stay one row, with their numbers
    `lo`..`hi` in place of dates: what is kept of segments. `spread_segments` makes the others of it.
    """
    scratch = scratch or Scratch(hierarchy.sparkSession)
    if days is None:
        days = scratch.save(calendar(periods), "calendar")
    managed = managed_spans(hierarchy, mappings, days, keep_unmapped=keep_unmapped)
    managed = scratch.save(managed, "managed")
    ordered = [c for c in ("root_order",) if c in hierarchy.columns]
    rows = hierarchy.select(
        *_SEGMENT, *ordered, *[c for c in ("path",) if c in hierarchy.columns]
    )
    identity = ["path"] if "path" in rows.columns else ["parent_account_id", "child_account_id"]
    joined = grid_join(
        rows,
        managed,
        "parent_account_id",
        left_id=identity,
        right_id=["entity_id", "marketplace_id", "lo"],
        cell_rows=cell_rows,
        right_weight=F.col("hi") - F.col("lo") + 1 if spread else F.lit(1),
    )
    if spread:
        return spread_segments(joined.select(*_SEGMENT, "lo", "hi", *MAPPED, "is_mapped", *ordered), days)
    return joined.select(*_SEGMENT, "lo", "hi", *MAPPED, "is_mapped", *ordered)


def spread_segments(spans: DataFrame, days: DataFrame) -> DataFrame:
    """One segment per period of each row that `segments` makes with `spread` off."""
    held = {"lo": "period_start", "hi": "period_end"}
    return per_period(spans, days).select(*[held.get(c, c) for c in spans.columns])


def root_order(hierarchy: DataFrame) -> DataFrame:
    """`hierarchy` with the place of each row's root among the roots of its parent, from 1. It lets segments,
    of which a path has many, be compared by numbers. Each pair of parent and root is placed once."""
    pair = ["parent_account_id", "root_account_id"]
    in_order = Window.partitionBy("parent_account_id").orderBy("root_account_id")
    placed = hierarchy.select(*pair).distinct().withColumn("root_order", F.row_number().over(in_order))
    return hierarchy.join(placed, pair)


def managed_spans(
    hierarchy: DataFrame, mappings: DataFrame, days: DataFrame, *, keep_unmapped: bool = True
) -> DataFrame:
    """The spans of periods of what each manager manages and, unless `keep_unmapped` is off, of the gaps
    in which a parent of the hierarchy manages nothing."""
    spans = coverage(mappings, days)
    mapped = spans.withColumns(
        {"parent_account_id": F.col("manager_account_id"), "is_mapped": F.lit(1)}
    )
    if not keep_unmapped:
        return mapped
    # every parent has an edge, which is the part of the hierarchy at level 1
    gaps = uncovered(hierarchy.where("level_depth = 1"), spans, days)
    nothing = {
        name: F.lit(None).cast("int" if name == "marketplace_id" else "string") for name in MAPPED
    }
    return mapped.unionByName(gaps.withColumns({**nothing, "is_mapped": F.lit(0)}))


def inherit(segments: DataFrame, unmapped_flags: str = "partner") -> DataFrame:
    """Segments with final flags: mapped rows keep theirs. Where nothing is mapped a partner parent
    becomes its own root, and a partner root if the child is one too ('partner'), or every row is
    both ('always')."""
    if unmapped_flags == "always":
        alone = together = F.lit(1)
    else:
        alone = F.col("parent_is_partner")
        together = F.col("parent_is_partner") * F.col("child_is_partner")
    mapped = F.col("is_mapped") == 1
    return segments.withColumns(
        {
            "calculated_root_flag": F.when(mapped, F.col("is_root_manager")).otherwise(alone),
            "calculated_partner_flag": F.when(mapped, F.col("is_root_partner_manager")).otherwise(
                together
            ),
        }
    )


def succession(
    segments: DataFrame,
    entity_types: DataFrame,
    key: str = "child",
    days: DataFrame | None = None,
) -> DataFrame:
    """Partners that stand alone from the day after their last mapped period.

    `key` says whose periods count: those of an account's parents ('child') or its own
    ('manager'). For segments that are not spread over periods pass the calendar as `days`."""
    account = {"child": "child_account_id", "manager": "parent_account_id"}[key]
    mapped = segments.where("is_mapped = 1")
    if days is not None:
        last = _last_ends(mapped, F.col(account).alias("account_id"), days)
    else:
        last = mapped.groupBy(F.col(account).alias("account_id")).agg(
            F.max("period_end").alias("hierarchy_end_date")
        )
    return _stand_alone(last, entity_types)


def _last_ends(spans: DataFrame, account: Column, calendar: DataFrame) -> DataFrame:
    """The latest end of a period in the spans of each account."""
    # within a span ends grow, except that the final period may end before the one it follows
    ends = numbered_periods(calendar).select(
        F.col("idx").alias("hi"), "period_end", "previous_end"
    )
    reach = F.when(F.col("lo") < F.col("hi"), F.greatest("period_end", "previous_end")).otherwise(
        F.col("period_end")
    )
    spans = spans.groupBy(account, "hi").agg(F.min("lo").alias("lo"))
    return (
        spans.join(F.broadcast(ends), "hi")
        .groupBy(spans.columns[0])
        .agg(F.max(reach).alias("hierarchy_end_date"))
    )


def succession_from_spans(
    edges: DataFrame,
    spans: DataFrame,
    calendar: DataFrame,
    entity_types: DataFrame,
    key: str = "child",
) -> DataFrame:
    """`succession` without segments: deeper rows repeat the parent of some edge, so edges and each
    manager's last covered period decide. Managers are reduced to one row before the edges join."""
    last = _last_ends(spans, F.col("manager_account_id").alias("parent_account_id"), calendar)
    if key == "manager":
        owners = edges.select("parent_account_id").distinct()
        last = last.join(owners, "parent_account_id", "left_semi").withColumnRenamed(
            "parent_account_id", "account_id"
        )
    else:
        last = (
            edges.select("parent_account_id", "child_account_id")
            .join(last, "parent_account_id")
            .groupBy(F.col("child_account_id").alias("account_id"))
            .agg(F.max("hierarchy_end_date").alias("hierarchy_end_date"))
        )
    return _stand_alone(last, entity_types)


def _stand_alone(last: DataFrame, entity_types: DataFrame) -> DataFrame:
    return (
        last.where(F.col("hierarchy_end_date") < open_end())
        .join(partner_ids(entity_types), "account_id")
        .select(
            "account_id",
            F.date_add("hierarchy_end_date", 1).alias("inherit_start_date"),
            open_end().alias("inherit_end_date"),
            F.lit(1).alias("inherited_root_flag"),
        )
    )
