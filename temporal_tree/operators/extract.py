"""Cleaning the raw tables: one scan each, filters that reach the scan, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from temporal_tree.functions import yes
from temporal_tree.schemas import MAPPINGS, PARTNER_ACCOUNTS, RELATIONSHIPS, conform, open_end


def relationships(raw: DataFrame) -> DataFrame:
    """Edges that are not deleted and have both ends. A NULL flag counts as unusable."""
    kept = raw.where(
        (F.col("delete_flag") != "Y")
        & F.col("entity_id_one").isNotNull()
        & F.col("entity_id_two").isNotNull()
    )
    named = kept.withColumnsRenamed(
        {"entity_id_one": "parent_account_id", "entity_id_two": "child_account_id"}
    )
    # the filter leaves only flag values other than 'Y'
    return conform(named.withColumn("is_deleted", F.lit(0)), RELATIONSHIPS)


def partners(raw: DataFrame) -> DataFrame:
    """Partner accounts that are not disabled, with 0/1 flags."""
    flagged = raw.where(F.col("is_disabled") != "Y").withColumns(
        {
            "is_approved": yes("is_registration_approved"),
            "is_external": yes("is_external_partner_account"),
            "is_disabled": F.lit(0),
        }
    )
    return conform(flagged, PARTNER_ACCOUNTS)


def mappings(raw: DataFrame) -> DataFrame:
    """Linked mappings with a start date; an absent end becomes the open-ended date."""
    kept = raw.where((F.col("is_linked") == "Y") & F.col("effective_start_date").isNotNull())
    cleaned = kept.withColumns(
        {
            "effective_end_date": F.coalesce("effective_end_date", open_end()),
            "source": F.upper("source"),
            "is_linked": F.lit(1),
        }
    )
    return conform(cleaned, MAPPINGS)
