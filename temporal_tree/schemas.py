"""Table contracts: the three raw inputs, the stage tables and the star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The open-ended date, entity kinds, record kinds and source names.
OPEN_END = date(2099, 12, 31)
PARTNER = "PARTNER"
MANAGER = "MANAGER"
UNKNOWN = "UNKNOWN"
HIERARCHY = "HIERARCHY"
STANDALONE = "STANDALONE"
INHERITANCE = "INHERITANCE"


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(columns: str) -> T.StructType:
    named = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in named])


RAW_RELATIONSHIPS = _struct(
    "entity_id_one string, entity_id_two string, created_at timestamp_ntz, "
    "updated_at timestamp_ntz, delete_flag string"
)
RAW_PARTNERS = _struct(
    "partner_account_id string, group_account_id string, is_registration_approved string, "
    "is_external_partner_account string, is_disabled string"
)
RAW_MAPPINGS = _struct(
    "manager_account_id string, entity_id string, marketplace_id int, effective_start_date date, "
    "effective_end_date date, source string, advertiser_id string, is_linked string"
)
RAW_TABLES = {
    "raw_entity_relationships": RAW_RELATIONSHIPS,
    "raw_partner_accounts": RAW_PARTNERS,
    "raw_partner_adv_entity_mapping": RAW_MAPPINGS,
}

RELATIONSHIPS = _struct(
    "parent_account_id string, child_account_id string, created_at timestamp_ntz, "
    "updated_at timestamp_ntz, is_deleted int"
)
PARTNER_ACCOUNTS = _struct(
    "partner_account_id string, group_account_id string, is_approved int, is_external int, "
    "is_disabled int"
)
MAPPINGS = _struct(
    "manager_account_id string, entity_id string, marketplace_id int, effective_start_date date, "
    "effective_end_date date, source string, advertiser_id string, is_linked int"
)
ENTITY_TYPES = _struct("account_id string, entity_type string, is_approved int, is_external int")

# hierarchy_key is wider than an int: a dense key over a large fact passes 2**31 rows.
FACT = _struct(
    "hierarchy_key long, account_id string, entity_id string, marketplace_id int, "
    "root_account_id string, level_depth int, effective_start_date date, effective_end_date date, "
    "is_root_manager int, is_root_partner_manager int, source string, record_type string, "
    "created_at timestamp_ntz"
)
DIM_ACCOUNTS = _struct(
    "account_id string, entity_type string, is_approved int, is_external int, "
    "created_at timestamp_ntz"
)
DIM_DATE = _struct("date_key date, year_num int, month_num int, day_num int, quarter_num int")
STAR_TABLES = {
    "fact_account_hierarchy": FACT,
    "dim_accounts": DIM_ACCOUNTS,
    "dim_date": DIM_DATE,
}


def open_end() -> Column:
    """The open-ended date as a typed literal."""
    return F.lit(OPEN_END)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns in the declared types; a missing column is an error."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; got {df.columns}")
    return df.select(
        *[_typed(df, f.name, f.dataType).alias(f.name) for f in schema]
    )


def _typed(df: DataFrame, name: str, kind: T.DataType) -> Column:
    """The column in a type. A moment becomes the wall time of UTC, whatever the session's zone."""
    column, given = F.col(name), df.schema[name].dataType
    if isinstance(given, T.TimestampType) and isinstance(kind, (T.TimestampNTZType, T.DateType)):
        micros = F.unix_micros(column).cast("decimal(20,0)")
        seconds = (micros / F.lit(1_000_000)).cast("decimal(18,6)")
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        column = epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return column.cast(kind)
