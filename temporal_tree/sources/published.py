"""A star schema that is published as a whole and stays laid out by account.

Every publication writes tables of its own, named by a version. Which version is valid is one property of the
database, set when all tables are complete: readers see the three tables of one run, before and after,
and a write that fails or is killed leaves the old ones in use.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from temporal_tree.schemas import STAR_TABLES, conform

_PROPERTY = "star.version"
# the tables that are joined on it again and again
_BY_ACCOUNT = ("fact_account_hierarchy", "dim_accounts")


def _version(spark: SparkSession, database: str) -> str | None:
    rows = spark.sql(f"DESCRIBE DATABASE EXTENDED {database}").where("info_name = 'Properties'").collect()
    listed = rows[0]["info_value"] if rows else ""
    # shown as ((name,value), (name,value))
    for entry in listed.strip("()").split("), ("):
        name, _, value = entry.partition(",")
        if name.strip() == _PROPERTY:
            return value.strip()
    return None


def _names(database: str, version: str) -> dict[str, str]:
    return {name: f"{database}.{name}_{version}" for name in STAR_TABLES}


def publish_star(
    star: Mapping[str, DataFrame],
    database: str,
    *,
    buckets: int = 64,
    keep: int = 1,
    task_rows: int = 2_000_000,
) -> str:
    """Write the star into tables of a new version, then make it the one that `read_published` reads.

    Fact and account dimension are bucketed and sorted by account, so a join or grouping on account_id reads
    them without an exchange, in this session and in any other. `buckets` should be about the number of
    cores that read; an account lies in one bucket. Rows go to their bucket's tasks before the write: one, which writes
    one file, or as many as it takes for each to sort about `task_rows` rows of the fact; an account lies
    in one of their files. `keep` versions before the new one stay, for readers that began with them; older ones and
    those of failed writes are dropped. Returns the version.
    """
    spark = next(iter(star.values())).sparkSession
    # no table by account has many more rows than the fact
    pieces = max(1, math.ceil(star["fact_account_hierarchy"].count() / buckets / task_rows))
    old = _version(spark, database)
    version = f"v{uuid.uuid4().hex}"
    for name, table in _names(database, version).items():
        df = conform(star[name], STAR_TABLES[name])
        if name in _BY_ACCOUNT:
            # buckets and tasks go by remainders of one hash: a multiple of the buckets divides each of them
            df = df.repartition(buckets * pieces, "account_id")
            writer = df.write.bucketBy(buckets, "account_id").sortBy("account_id")
        else:
            writer = df.write
        writer.option("compression", "zstd").saveAsTable(table)
    history = [v for v in (version, *(old or "").split(" ")) if v]
    spark.sql(f"ALTER DATABASE {database} SET DBPROPERTIES ('{_PROPERTY}' = '{' '.join(history[: keep + 1])}')")
    valid = {t.partition(".")[2] for v in history[: keep + 1] for t in _names(database, v).values()}
    for row in spark.sql(f"SHOW TABLES IN {database}").where(~F.col("isTemporary")).collect():
        kind, _, suffix = row["tableName"].rpartition("_v")
        if kind in STAR_TABLES and len(suffix) == 32 and row["tableName"] not in valid:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{row['tableName']}")
    return version


def read_published(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The star tables of the version that is valid now. They stay those of that version."""
    found = _version(spark, database)
    if found is None:
        raise LookupError(f"no star has been published in {database}")
    tables = _names(database, found.split(" ")[0])
    return {name: spark.table(table) for name, table in tables.items()}
