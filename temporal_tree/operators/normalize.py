"""Deduplication and classification.

Both top-1 windows are planned with a group limit on either side of their shuffle, so copies of
one key, however many, leave each map task as a single row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from temporal_tree.functions import mapping_source_rank
from temporal_tree.schemas import ENTITY_TYPES, MANAGER, PARTNER, conform


def first_per(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """The first row of every key in the given order. NULL keys form groups of their own."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_relationships(relationships: DataFrame) -> DataFrame:
    """The newest row of every edge, without self-edges and empty ids."""
    usable = relationships.where(
        (F.col("parent_account_id") != F.col("child_account_id"))
        & (F.length("parent_account_id") > 0)
        & (F.length("child_account_id") > 0)
    )
    return first_per(
        usable,
        ["parent_account_id", "child_account_id"],
        F.desc_nulls_last("updated_at"),
        F.desc_nulls_last("created_at"),
    )


def entity_types(partners: DataFrame, mappings: DataFrame) -> DataFrame:
    """PARTNER rows from registrations and MANAGER rows from mappings; an account may have both."""
    registered = partners.select(
        F.col("partner_account_id").alias("account_id"),
        F.lit(PARTNER).alias("entity_type"),
        "is_approved",
        "is_external",
    ).distinct()
    managing = (
        mappings.select(F.col("manager_account_id").alias("account_id"))
        .distinct()
        .withColumns(
            {
                "entity_type": F.lit(MANAGER),
                "is_approved": F.lit(1),
                "is_external": F.lit(0),
            }
        )
    )
    return conform(registered.unionByName(managing), ENTITY_TYPES)


def best_mappings(mappings: DataFrame) -> DataFrame:
    """Per manager, entity, marketplace and start date the mapping of the best source, then the
    latest end. Ties are settled by source and advertiser so that the result is fixed."""
    return first_per(
        mappings.where(F.col("effective_start_date") <= F.col("effective_end_date")),
        ["manager_account_id", "entity_id", "marketplace_id", "effective_start_date"],
        mapping_source_rank(),
        F.desc("effective_end_date"),
        F.asc_nulls_last("source"),
        F.asc_nulls_last("advertiser_id"),
    )


def partner_ids(entity_types: DataFrame) -> DataFrame:
    """Distinct partner accounts: one row each, so joining them never multiplies rows."""
    return entity_types.where(F.col("entity_type") == PARTNER).select("account_id").distinct()
