"""The star schema: consolidation, the fact table and its dimensions."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from temporal_tree.functions import fact_source_rank, moment
from temporal_tree.operators.normalize import first_per
from temporal_tree.operators.numbering import dense_keys, number_in_place
from temporal_tree.operators.temporal import (
    merge_spans,
    numbered_periods,
    per_period,
    uncovered,
)
from temporal_tree.schemas import (
    DIM_ACCOUNTS,
    DIM_DATE,
    FACT,
    HIERARCHY,
    INHERITANCE,
    PARTNER,
    STANDALONE,
    UNKNOWN,
    conform,
    open_end,
)
from temporal_tree.sources.scratch import Scratch

FACT_KEY = [
    "account_id",
    "entity_id",
    "marketplace_id",
    "effective_start_date",
    "effective_end_date",
]
# the order of hierarchy_key: account and start, then the rest of the key so that it is fixed
FACT_ORDER = [
    "account_id",
    "effective_start_date",
    "entity_id",
    "marketplace_id",
    "effective_end_date",
]
_FACT_ROW = [
    *FACT_KEY,
    "level_depth",
    "root_account_id",
    "is_root_manager",
    "is_root_partner_manager",
    "source",
    "record_type",
]


def _preference() -> list[Column]:
    """Which of the rows with one fact key to keep; the source's name settles ties."""
    return [
        F.desc("is_root_partner_manager"),
        fact_source_rank(),
        F.asc("level_depth"),
        F.asc_nulls_last("source"),
    ]


def consolidate(
    segments: DataFrame,
    standalone: DataFrame,
    *,
    keep_unmapped: bool = False,
    days: DataFrame | None = None,
) -> DataFrame:
    """Segments with final flags and standalone periods, one row per fact key.

    Where segments have the `root_order` of their paths, the best row per key and source is a least
    number, which map tasks find by hashing: the many paths of an account do not reach a sort.

    Segments that are not spread over periods (`segments` with `spread` off) need the calendar as `days`.
    The paths of an account that share a span are reduced while it is one row, and what is left is
    spread inside the tasks that choose among rows with one key.
    """
    if keep_unmapped:
        account = F.col("parent_account_id")
        source = F.coalesce("source", F.lit(HIERARCHY))
    else:
        segments = segments.where("is_mapped = 1")
        account, source = F.col("manager_account_id"), F.col("source")
    if days is None:
        when = [
            F.col("period_start").alias("effective_start_date"),
            F.col("period_end").alias("effective_end_date"),
        ]
    else:
        when = [F.col("lo"), F.col("hi")]
    managed = segments.select(
        account.alias("account_id"),
        "entity_id",
        "marketplace_id",
        *when,
        "level_depth",
        "root_account_id",
        F.col("calculated_root_flag").alias("is_root_manager"),
        F.col("calculated_partner_flag").alias("is_root_partner_manager"),
        source.alias("source"),
        F.lit(HIERARCHY).alias("record_type"),
        *[c for c in ("root_order",) if c in segments.columns],
    )
    if "root_order" in segments.columns:
        managed = _best_per_source(managed)
    alone = _standalone_rows(standalone)
    if days is None:
        rows = managed.unionByName(alone)
    else:
        rows = _spread_by_entity(managed.unionByName(alone, allowMissingColumns=True), days)
    return first_per(rows, FACT_KEY, *_preference(), F.asc("root_account_id"))


def _spread_by_entity(spans: DataFrame, days: DataFrame) -> DataFrame:
    """Rows with a span `lo`..`hi` once per period of it, and those without one with the dates they have.

    Spans are exchanged by account, entity and marketplace, which is all that the choice per key needs.
    The number of tasks is the session's: by the bytes of spans Spark would make few of them.
    """
    tasks = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dates = numbered_periods(days).drop("previous_end")
    return (
        spans.repartition(tasks, *FACT_KEY[:3])
        .withColumn("idx", F.explode_outer(F.sequence("lo", "hi")))
        .join(F.broadcast(dates), "idx", "left")
        .withColumns(
            {
                "effective_start_date": F.coalesce("period_start", "effective_start_date"),
                "effective_end_date": F.coalesce("period_end", "effective_end_date"),
            }
        )
        .select(*_FACT_ROW)
    )


# places of the parts of a row's number: the partner flag above the level above the root's place above the root flag
_LEVEL_UNIT, _FLAG_UNIT = 1 << 32, 1 << 62


def _best_per_source(managed: DataFrame) -> DataFrame:
    """The preferred rows of each fact key and source. Among them flag, level and root decide, in this order."""
    unflagged, unrooted = (
        1 - F.col(flag).cast("long") for flag in ("is_root_partner_manager", "is_root_manager")
    )
    place = F.col("root_order").cast("long") * 2 + unrooted
    number = unflagged * _FLAG_UNIT + F.col("level_depth") * F.lit(_LEVEL_UNIT) + place
    below = F.col("_best") % _FLAG_UNIT
    roots = managed.select("account_id", "root_order", "root_account_id").distinct()
    decided = ("is_root_partner_manager", "level_depth", "root_account_id", "root_order", "is_root_manager")
    return (
        managed.groupBy(*[c for c in managed.columns if c not in decided])
        .agg(F.min(number).alias("_best"))
        .withColumns(
            {
                "is_root_partner_manager": F.when(F.col("_best") < _FLAG_UNIT, 1).otherwise(0),
                "level_depth": F.shiftright(below, 32).cast("int"),
                "root_order": F.shiftright(below % _LEVEL_UNIT, 1).cast("int"),
                "is_root_manager": (1 - below % 2).cast("int"),
            }
        )
        .join(roots, ["account_id", "root_order"])
        .select(*[c for c in managed.columns if c != "root_order"])
    )


def _standalone_rows(standalone: DataFrame) -> DataFrame:
    return standalone.select(
        "account_id",
        F.lit(None).cast("string").alias("entity_id"),
        F.lit(None).cast("int").alias("marketplace_id"),
        F.col("inherit_start_date").alias("effective_start_date"),
        F.col("inherit_end_date").alias("effective_end_date"),
        F.lit(0).alias("level_depth"),
        F.col("account_id").alias("root_account_id"),
        F.col("inherited_root_flag").alias("is_root_manager"),
        F.col("inherited_root_flag").alias("is_root_partner_manager"),
        F.lit(INHERITANCE).alias("source"),
        F.lit(STANDALONE).alias("record_type"),
    )


def fact(consolidated: DataFrame, scratch: Scratch, load_ts: datetime | None = None) -> DataFrame:
    """Consolidated rows with a dense key in FACT_ORDER and the load time."""
    keyed = dense_keys(consolidated, FACT_ORDER, "hierarchy_key", scratch)
    return _stamped(keyed, load_ts)


def _stamped(keyed: DataFrame, load_ts: datetime | None) -> DataFrame:
    return conform(keyed.withColumn("created_at", moment(load_ts)), FACT)


def fact_spans(
    edges: DataFrame,
    spans: DataFrame,
    calendar: DataFrame,
    standalone: DataFrame,
    *,
    keep_unmapped: bool = False,
    unmapped_flags: str = "partner",
) -> DataFrame:
    """What the fact table says, before it is spread over periods.

    A path of several edges joins the same periods and mappings as its last edge does alone, and
    loses every deduplication against it: the key names neither root nor child, and the edge has
    the lesser level and no lesser partner flag. So flagged edges are enough, and for mapped
    rows their parents are. What a fact row takes from the mapping is only its source, so spans
    of one source are merged. Standalone rows, marked by `open_tail`, start with a period and end
    at the open end. Every account is its own root.
    """
    parents = edges.groupBy("parent_account_id").agg(
        F.max("parent_is_partner").alias("parent_is_partner"),
        F.max("child_is_partner").alias("any_partner_child"),
    )
    if keep_unmapped:
        spans = spans.na.fill(HIERARCHY, ["source"])
    # managers without children go first. The repartitioning is what the merge needs, stated so that
    # the join by manager need not provide it and may split a manager with many mappings
    keys = ["manager_account_id", "entity_id", "marketplace_id", "source"]
    owned = spans.join(
        parents.select(F.col("parent_account_id").alias(keys[0]), "parent_is_partner"), keys[0]
    ).repartition(*keys)
    managed = (
        merge_spans(owned, [*keys, "parent_is_partner"])
        .withColumnRenamed("manager_account_id", "account_id")
        .select(
            "account_id",
            "entity_id",
            "marketplace_id",
            "lo",
            "hi",
            F.lit(False).alias("open_tail"),
            F.lit(1).alias("level_depth"),
            F.lit(1).alias("is_root_manager"),
            F.col("parent_is_partner").alias("is_root_partner_manager"),
            "source",
        )
    )
    nobody = {
        "entity_id": F.lit(None).cast("string"),
        "marketplace_id": F.lit(None).cast("int"),
    }
    begins = numbered_periods(calendar).select(
        F.col("period_start").alias("inherit_start_date"), F.col("idx").alias("lo")
    )
    alone = (
        standalone.join(F.broadcast(begins), "inherit_start_date")
        .withColumns(
            {
                **nobody,
                "hi": F.col("lo"),
                "open_tail": F.lit(True),
                "level_depth": F.lit(0),
                "is_root_manager": F.col("inherited_root_flag"),
                "is_root_partner_manager": F.col("inherited_root_flag"),
                "source": F.lit(INHERITANCE),
            }
        )
        .select(*managed.columns)
    )
    result = managed.unionByName(alone)
    if keep_unmapped:
        if unmapped_flags == "always":
            own = both = F.lit(1)
        else:
            own = F.col("parent_is_partner")
            both = F.col("parent_is_partner") * F.col("any_partner_child")
        idle = (
            uncovered(parents, spans, calendar)
            .join(parents, "parent_account_id")
            .withColumns(
                {
                    **nobody,
                    "account_id": F.col("parent_account_id"),
                    "open_tail": F.lit(False),
                    "level_depth": F.lit(1),
                    "is_root_manager": own,
                    "is_root_partner_manager": both,
                    "source": F.lit(HIERARCHY),
                }
            )
            .select(*managed.columns)
        )
        result = result.unionByName(idle)
    return result


def fact_from_spans(
    spans: DataFrame,
    calendar: DataFrame,
    scratch: Scratch,
    *,
    total_rows: int,
    total_spans: int,
    load_ts: datetime | None = None,
    hot_account_rows: int = 1_000_000,
    rows_per_task: int = 10_000_000,
) -> DataFrame:
    """The fact table from `fact_spans`: spread over periods, deduplicated and numbered with one
    shuffle, of spans instead of rows.

    Spans are range partitioned by account and spread inside the task that gets them. One sort
    per task then serves the choice among rows with the same key and the numbering. An account
    with more rows than `hot_account_rows` is spread first and ranged by its whole key, so that
    it takes as many tasks as it needs; there are at most total_rows / hot_account_rows of those.

    `spans` and `calendar` are read more than once: pass scans. `total_rows` is the number of
    rows after spreading. Ranges are drawn by pieces: spans are cut into ones of at most the mean
    number of rows, which at most doubles them, so that a range of pieces is a range of rows wherever
    the long spans are. Spread accounts have a piece per row.
    """
    hot = (
        spans.groupBy("account_id")
        .agg(
            F.sum(F.col("hi") - F.col("lo") + 1).alias("_rows"),
            F.count(F.lit(1)).alias("_spans"),
        )
        .where(F.col("_rows") > hot_account_rows)
    )
    hot_rows = hot_spans = 0
    if total_rows > hot_account_rows:
        hot_rows, hot_spans = (n or 0 for n in hot.agg(F.sum("_rows"), F.sum("_spans")).first())
    other_rows, other_spans = total_rows - hot_rows, total_spans - hot_spans
    longest = max(1, math.ceil(other_rows / max(1, other_spans)))
    placed, place, step = spans, ["account_id"], F.lit(longest)
    if hot_rows:
        placed = placed.join(
            hot.select("account_id", F.lit(True).alias("_hot")), "account_id", "left"
        ).na.fill(False, ["_hot"])
        step = F.when(F.col("_hot"), 1).otherwise(longest)
        place += ["_slot", "_entity", "_marketplace"]
    pieces = F.transform(
        F.sequence("lo", "hi", step.cast("int")),
        lambda i: F.struct(i.alias("lo"), F.least(i + step.cast("int") - 1, F.col("hi")).alias("hi")),
    )
    placed = placed.select(
        *[c for c in placed.columns if c not in ("lo", "hi")], F.inline(pieces)
    )
    if len(place) > 1:
        placed = placed.withColumns(
            {
                "_slot": F.when(F.col("_hot"), F.col("lo")),
                "_entity": F.when(F.col("_hot"), F.col("entity_id")),
                "_marketplace": F.when(F.col("_hot"), F.col("marketplace_id")),
            }
        )
    tasks = max(
        # no piece has more than `longest` rows, also where those of one row are the most
        math.ceil((other_rows + (other_spans + hot_rows) * longest) / rows_per_task),
        int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions")),
    )
    rows = per_period(placed.repartitionByRange(tasks, *place), calendar).withColumns(
        {
            "effective_start_date": F.col("period_start"),
            "effective_end_date": _end_date(),
        }
    )
    # the window's keys begin with the range columns, so it needs no shuffle, and continue with
    # the order of the key, so its sort is the one the numbering needs
    ordered = [*place, *FACT_ORDER[1:]]
    kept = first_per(rows, ordered, *_preference()).withColumns(
        {
            "root_account_id": F.col("account_id"),
            "record_type": F.when(F.col("open_tail"), STANDALONE).otherwise(HIERARCHY),
        }
    )
    return _stamped(number_in_place(kept.select(*_FACT_ROW), "hierarchy_key", scratch), load_ts)


def dim_accounts(
    consolidated: DataFrame,
    entity_types: DataFrame,
    load_ts: datetime | None = None,
    *,
    one_row_per_account: bool = False,
) -> DataFrame:
    """Accounts of the fact with their kinds: a row per kind, or only PARTNER where there are both.
    Accounts of no kind are UNKNOWN."""
    if one_row_per_account:
        entity_types = first_per(
            entity_types,
            ["account_id"],
            (F.col("entity_type") != PARTNER).cast("int"),
            F.desc("is_approved"),
            F.desc("is_external"),
        )
    accounts = consolidated.select("account_id").distinct()
    described = (
        accounts.join(entity_types, "account_id", "left")
        .na.fill({"entity_type": UNKNOWN, "is_approved": 0, "is_external": 0})
        .withColumn("created_at", moment(load_ts))
    )
    return conform(described, DIM_ACCOUNTS)


def dim_date(consolidated: DataFrame) -> DataFrame:
    """The dates at which fact rows start or end."""
    days = consolidated.select(
        F.explode(F.array("effective_start_date", "effective_end_date")).alias("date_key")
    )
    return _with_parts(days)


def dim_date_from_spans(spans: DataFrame, calendar: DataFrame) -> DataFrame:
    """`dim_date` from `fact_spans`: distinct spans first, which are few, then their periods."""
    few = spans.select("lo", "hi", "open_tail").distinct()
    days = per_period(few, calendar).select(
        F.explode(F.array("period_start", _end_date())).alias("date_key")
    )
    return _with_parts(days)


def _end_date() -> Column:
    return F.when(F.col("open_tail"), open_end()).otherwise(F.col("period_end"))


def _with_parts(days: DataFrame) -> DataFrame:
    parts = days.where(F.col("date_key").isNotNull()).distinct().withColumns(
        {
            "year_num": F.year("date_key"),
            "month_num": F.month("date_key"),
            "day_num": F.dayofmonth("date_key"),
            "quarter_num": F.quarter("date_key"),
        }
    )
    return conform(parts, DIM_DATE)


def by_account(df: DataFrame) -> DataFrame:
    """Rows gathered by account and kept in memory or on disk, for repeated joins on account_id.
    The rebalance hint splits an account that would make a partition oversized."""
    return df.hint("rebalance", "account_id").persist()
