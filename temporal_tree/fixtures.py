"""Test inputs: the published sample rows, and raw tables derived from the TPC-H-like test data."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from temporal_tree.schemas import RAW_MAPPINGS, RAW_PARTNERS, RAW_RELATIONSHIPS
from temporal_tree.sources.raw import RawInputs

# Sample rows.
_SAMPLE_EDGES = [
    ("MA_ROOT_001", "MA_CHILD_001", datetime(2024, 1, 1)),
    ("MA_ROOT_001", "MA_CHILD_002", datetime(2024, 1, 1)),
    ("MA_CHILD_001", "MA_GRANDCHILD_001", datetime(2024, 2, 1)),
    ("MA_PARTNER_001", "MA_SUB_001", datetime(2024, 1, 15)),
]
_SAMPLE_PARTNERS = [
    ("MA_ROOT_001", "GROUP_001", "Y", "N", "N"),
    ("MA_PARTNER_001", "GROUP_002", "Y", "Y", "N"),
    ("MA_CHILD_001", "GROUP_001", "Y", "N", "N"),
]
_SAMPLE_MAPPINGS = [
    ("MA_ROOT_001", "ADV_001", 1, date(2024, 1, 1), date(2024, 6, 30), "API", "ADVERTISER_001", "Y"),
    ("MA_ROOT_001", "ADV_002", 1, date(2024, 7, 1), date(2099, 12, 31), "API", "ADVERTISER_002", "Y"),
    ("MA_CHILD_001", "ADV_003", 1, date(2024, 1, 1), date(2024, 3, 31), "MANUAL", "ADVERTISER_003", "Y"),
    ("MA_PARTNER_001", "ADV_004", 2, date(2024, 1, 15), date(2099, 12, 31), "API", "ADVERTISER_004", "Y"),
]


_CUSTOMER = "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"
_ORDERS = (
    "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, "
    "o_orderpriority string"
)


def sample_raw(spark: SparkSession) -> RawInputs:
    """The sample rows as raw inputs."""
    edges = [(parent, child, at, at, "N") for parent, child, at in _SAMPLE_EDGES]
    return RawInputs(
        spark.createDataFrame(edges, RAW_RELATIONSHIPS),
        spark.createDataFrame(_SAMPLE_PARTNERS, RAW_PARTNERS),
        spark.createDataFrame(_SAMPLE_MAPPINGS, RAW_MAPPINGS),
    )


def raw_from_star(spark: SparkSession, sf_dir: str) -> RawInputs:
    """Raw inputs projected from every row of `customer` and `orders`.

    Remainders of the keys only decide which accounts get a second parent, a back edge, a dirty
    row or a flag; no row of the tables is left out. FIXTURES.md has the same rules in words.
    """
    customer = spark.read.schema(_CUSTOMER).parquet(f"{sf_dir}/customer.parquet")
    orders = spark.read.schema(_ORDERS).parquet(f"{sf_dir}/orders.parquet")
    return RawInputs(_edges(customer), _partners(customer), _mappings(orders))


def _account(number: Column, prefix: str = "A") -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _rows(df: DataFrame, keep: list[str], *cases: tuple[Column, dict[str, Column]]) -> DataFrame:
    """For each row of `df` one row per case whose condition holds."""
    structs = [
        F.when(condition, F.struct(*[c.alias(name) for name, c in fields.items()]))
        for condition, fields in cases
    ]
    chosen = F.filter(F.array(*structs), lambda s: s.isNotNull())
    return df.select(*keep, F.inline(chosen))


def _edges(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    above = F.floor(k / 3)
    created = F.make_date(
        (F.lit(1995) + k % 6).cast("int"), (F.lit(1) + k % 12).cast("int"), F.lit(1)
    )
    deleted = F.when(k % 17 == 3, "Y").when(k % 53 == 5, None).otherwise("N")

    def edge(parent: Column, child: Column, flag: Column | None = None, age: int = 0):
        return {
            "entity_id_one": parent,
            "entity_id_two": child,
            "created_at": F.date_sub(created, age).cast("timestamp_ntz"),
            "updated_at": F.date_add(created, 30 - age).cast("timestamp_ntz"),
            "delete_flag": F.lit("N") if flag is None else flag,
        }

    child, parent = _account(k), _account(above)
    return _rows(
        customer,
        [],
        (k > 0, edge(parent, child, deleted)),
        (k % 25 == 0, edge(_account(above + 1), child)),
        (k % 40 == 11, edge(child, _account(F.floor(above / 3)))),
        (k % 200 < 20, edge(_account(k, "L"), _account(k + 1, "L"))),
        ((k > 0) & (k % 7 == 0), edge(parent, child, deleted, age=10)),
        (k % 97 == 0, edge(child, child)),
        (k % 101 == 50, edge(child, F.lit(""))),
        (k % 103 == 7, edge(child, F.lit(None).cast("string"))),
    )


def _partners(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    disabled = (
        F.when((k % 3 != 0) | (F.col("c_nationkey") == 0), "Y").when(k % 59 == 0, None).otherwise("N")
    )

    def partner(external: Column):
        return {
            "partner_account_id": _account(k),
            "group_account_id": _account(k % 10, "G"),
            "is_registration_approved": F.when(F.col("c_acctbal") > 0, "Y").otherwise("N"),
            "is_external_partner_account": F.when(external, "Y").otherwise("N"),
            "is_disabled": disabled,
        }

    building = F.col("c_mktsegment") == "BUILDING"
    return _rows(
        customer, [], (F.lit(True), partner(building)), (k % 33 == 0, partner(~building))
    )


def _mappings(orders: DataFrame) -> DataFrame:
    o = F.col("o_orderkey")
    start = F.trunc(F.to_date("o_orderdate"), "month")
    end = F.last_day(F.add_months(start, (o % 9).cast("int")))
    level = F.substring("o_orderpriority", 1, 1)
    source = (
        F.when(o % 97 == 0, None)
        .when(level.isin("1", "5"), "api")
        .when(level == "2", "Manual")
        .otherwise("feed")
    )

    def mapping(end_date: Column):
        return {
            "manager_account_id": _account(F.col("o_custkey")),
            "entity_id": F.when(o % 211 != 0, _account(o % 200, "E")),
            "marketplace_id": F.when(o % 211 != 0, (o % 5).cast("int")),
            "effective_start_date": F.when(o % 223 != 0, start),
            "effective_end_date": end_date,
            "source": source,
            "advertiser_id": _account(o, "ADV"),
            "is_linked": F.when(F.col("o_orderstatus") == "P", "N").otherwise("Y"),
        }

    return _rows(
        orders,
        [],
        (F.lit(True), mapping(F.when(o % 10 != 0, end))),
        (o % 67 == 0, mapping(F.date_sub(start, 5))),
    )
