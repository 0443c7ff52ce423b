"""Times the fact over generated raw tables in which single keys hold a third of all rows.

python tools/skew_trial.py [MAPPINGS]: so many mappings (3,000,000), of which one manager has a third, and
a tenth as many edges, of which one parent and one child have a third each.
"""

from __future__ import annotations

import sys
import time
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from temporal_tree import PipelineOptions, RawInputs, run  # noqa: E402


def raw_tables(spark: SparkSession, mappings: int) -> RawInputs:
    accounts = mappings // 30

    def account(seed: str) -> str:
        return f"concat('A', pmod(hash(id, '{seed}'), {accounts}))"

    edges = spark.range(mappings // 10).selectExpr(
        f"if(id % 3 = 0, 'A0', {account('p')}) AS entity_id_one",
        f"if(id % 3 = 1, 'A1', {account('c')}) AS entity_id_two",
        "timestamp_ntz '2020-01-01 00:00:00' + make_dt_interval(cast(id % 900 as int)) AS created_at",
        "timestamp_ntz '2023-01-01 00:00:00' AS updated_at",
        "'N' AS delete_flag",
    )
    partners = spark.range(accounts // 10).selectExpr(
        "concat('A', id * 10) AS partner_account_id", "'g' AS group_account_id",
        "'Y' AS is_registration_approved", "'N' AS is_external_partner_account", "'N' AS is_disabled",
    )
    held: DataFrame = spark.range(mappings).selectExpr(
        f"if(id % 3 = 0, 'A0', {account('m')}) AS manager_account_id",
        "concat('E', id % 100000) AS entity_id",
        "cast(id % 5 as int) AS marketplace_id",
        "trunc(date_add(date '2020-01-01', cast(pmod(hash(id), 1400) as int)), 'MM') AS effective_start_date",
        "if(id % 10 = 0, null, trunc(date_add(date '2020-03-01', cast(pmod(hash(id), 1400) + id % 200 as int)), 'MM'))"
        " AS effective_end_date",
        "'api' AS source", "'x' AS advertiser_id", "'Y' AS is_linked",
    )
    return RawInputs(edges, partners, held)


def main() -> None:
    mappings = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    begin = time.perf_counter()
    options = PipelineOptions(load_ts=datetime(2024, 1, 1), rows_per_task=1_000_000)
    with run(raw_tables(spark, mappings), options) as result:
        rows = result.star.fact.count()
        seconds = time.perf_counter() - begin
        written = spark.read.parquet(f"{result.run.scratch.path}/*-ordered")
        tasks = written.groupBy(F.shiftright("_id", 33)).count().agg(F.count("count"), F.max("count")).first()
        print(f"{mappings} mappings: {rows} fact rows in {seconds:.0f} s, {tasks[0]} tasks, largest {tasks[1]} rows")
    spark.stop()


if __name__ == "__main__":
    main()
