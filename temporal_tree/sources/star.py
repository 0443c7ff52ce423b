"""Writing the star schema, and reading it back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from temporal_tree.schemas import STAR_TABLES, conform


def write_star(
    star: Mapping[str, DataFrame],
    *,
    path: str | None = None,
    database: str | None = None,
    jdbc_url: str | None = None,
    jdbc_properties: Mapping[str, str] | None = None,
    jdbc_connections: int = 16,
) -> None:
    """Overwrite the three star tables as parquet below `path`, as catalog tables in `database`,
    or over JDBC.

    A database takes a bounded number of connections: `jdbc_connections` caps them, without a
    shuffle.
    """
    if sum(x is not None for x in (path, database, jdbc_url)) != 1:
        raise ValueError("give exactly one of path, database, jdbc_url")
    for name, schema in STAR_TABLES.items():
        df = conform(star[name], schema)
        if path is not None:
            df.write.mode("overwrite").parquet(f"{path}/{name}")
        elif database is not None:
            df.write.mode("overwrite").saveAsTable(f"{database}.{name}")
        else:
            writer = df.write.mode("overwrite").option("numPartitions", jdbc_connections)
            writer.jdbc(jdbc_url, name, properties=dict(jdbc_properties or {}))


def read_star(
    spark: SparkSession, path: str | None = None, *, database: str | None = None
) -> dict[str, DataFrame]:
    """The star tables that `write_star` wrote below a path or into a catalog database."""
    if (path is None) == (database is None):
        raise ValueError("give exactly one of path, database")
    if database is not None:
        return {name: conform(spark.table(f"{database}.{name}"), s) for name, s in STAR_TABLES.items()}
    return {
        name: spark.read.schema(schema).parquet(f"{path}/{name}")
        for name, schema in STAR_TABLES.items()
    }
