"""Reading the three raw tables from a catalog, files or a database."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from temporal_tree.schemas import RAW_MAPPINGS, RAW_PARTNERS, RAW_RELATIONSHIPS, RAW_TABLES, conform


class RawInputs(NamedTuple):
    relationships: DataFrame
    partners: DataFrame
    mappings: DataFrame

    def conformed(self) -> RawInputs:
        return RawInputs(
            conform(self.relationships, RAW_RELATIONSHIPS),
            conform(self.partners, RAW_PARTNERS),
            conform(self.mappings, RAW_MAPPINGS),
        )


def load_raw(
    spark: SparkSession,
    *,
    tables: Mapping[str, str] | None = None,
    paths: Mapping[str, str] | None = None,
    jdbc: Mapping[str, str] | None = None,
    partitioning: Mapping[str, Mapping[str, str]] | None = None,
) -> RawInputs:
    """The raw inputs, lazily, with the declared schemas.

    tables        raw table name -> catalog table (default: the same names in the catalog)
    paths         raw table name -> parquet path
    jdbc          options of the JDBC source (url, user, password, driver, ...), never stored
    partitioning  raw table name -> JDBC read options partitionColumn, lowerBound, upperBound,
                  numPartitions; without them Spark reads a table over one connection
    """
    if sum(x is not None for x in (tables, paths, jdbc)) > 1:
        raise ValueError("give one of tables, paths, jdbc")

    def read(name: str) -> DataFrame:
        if paths is not None:
            return spark.read.parquet(paths[name])
        if jdbc is not None:
            extra = (partitioning or {}).get(name, {})
            if not extra and name != "raw_partner_accounts":
                warnings.warn(f"{name} has no partitioning: one task reads all of it", stacklevel=3)
            return spark.read.format("jdbc").options(**jdbc, dbtable=name, **extra).load()
        return spark.table((tables or {}).get(name, name))

    return RawInputs(*[read(name) for name in RAW_TABLES]).conformed()
