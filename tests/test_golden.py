"""The published sample rows through every stage, in both readings of the rules."""

from __future__ import annotations

from datetime import date, datetime

import pytest

from model import rows
from temporal_tree import PipelineOptions, run
from temporal_tree.fixtures import sample_raw
from temporal_tree.functions import trace

LOAD_TS = datetime(2024, 5, 1, 12, 30)
KEEP = {"keep_unmapped": True, "unmapped_flags": "always", "succession_key": "manager"}


@pytest.mark.parametrize(
    "options, periods, facts, standalone, days",
    [
        ({}, 6, 14, 0, 11),
        ({"half_open": True}, 5, 12, 0, 10),
        (KEEP, 6, 19, 1, 11),
        ({**KEEP, "half_open": True}, 5, 16, 1, 10),
        ({"collapse": False, "persist": "cache"}, 6, 14, 0, 11),
        ({**KEEP, "collapse": False}, 6, 19, 1, 11),
    ],
)
def test_row_counts(spark, options, periods, facts, standalone, days):
    result = run(sample_raw(spark), PipelineOptions(load_ts=LOAD_TS, **options))
    fact = rows(result.star.fact)
    assert result.temporal.periods.count() == periods
    assert len(fact) == facts
    assert [r[0] for r in fact] == list(range(1, facts + 1))
    assert sum(r[11] == "STANDALONE" for r in fact) == standalone
    assert result.star.dim_date.count() == days
    assert result.star.dim_accounts.count() == 6
    assert {r[12] for r in fact} == {LOAD_TS}
    result.close()


def test_stages_of_the_default_run(spark):
    result = run(sample_raw(spark))
    nodes = result.hierarchy.select(
        "root_account_id", "level_depth", trace().alias("t"), "is_root_manager",
        "is_root_partner_manager",
    )
    assert rows(nodes) == [
        ("MA_CHILD_001", 1, "MA_CHILD_001/MA_GRANDCHILD_001", 1, 1),
        ("MA_PARTNER_001", 1, "MA_PARTNER_001/MA_SUB_001", 1, 1),
        ("MA_ROOT_001", 1, "MA_ROOT_001/MA_CHILD_001", 1, 1),
        ("MA_ROOT_001", 1, "MA_ROOT_001/MA_CHILD_002", 1, 1),
        ("MA_ROOT_001", 2, "MA_ROOT_001/MA_CHILD_001/MA_GRANDCHILD_001", 0, 0),
    ]
    assert rows(result.temporal.periods) == [
        (date(2024, 1, 1), date(2024, 1, 14)),
        (date(2024, 1, 15), date(2024, 1, 31)),
        (date(2024, 2, 1), date(2024, 3, 30)),
        (date(2024, 3, 31), date(2024, 6, 29)),
        (date(2024, 6, 30), date(2024, 6, 30)),
        (date(2024, 7, 1), date(2099, 12, 31)),
    ]
    by_account = result.star.fact.groupBy("account_id", "source").count()
    assert rows(by_account) == [
        ("MA_CHILD_001", "MANUAL", 3),
        ("MA_PARTNER_001", "API", 5),
        ("MA_ROOT_001", "API", 6),
    ]
    checks = {n: dict(rows(df)) for n, df in result.checks.items()}
    assert checks["relationships"] == {
        "total_relationships": 4, "self_references": 0, "null_parents": 0, "null_children": 0,
        "clean_relationships": 4,
    }
    assert checks["segments"] == {
        "total_segments": 30, "accounts_with_multiple_segments": 5, "overlapping_groups": 0,
    }
    assert checks["hierarchy"] == {
        "total_nodes": 5, "max_depth": 2, "root_managers": 4, "edges_on_cycles": 0,
        "beyond_max_depth": 0,
    }
    assert checks["fact"]["total_records"] == 14 and checks["fact"]["duplicates"] == 0


def test_succession_story(spark):
    """The child manages until its mapping ends, then stands alone, in either reading of the
    last day."""
    for half_open, first in ((False, date(2024, 3, 31)), (True, date(2024, 4, 1))):
        result = run(
            sample_raw(spark), PipelineOptions(succession_key="manager", half_open=half_open)
        )
        assert rows(result.temporal.standalone) == [
            ("MA_CHILD_001", first, date(2099, 12, 31), 1)
        ]


def test_validation_off(spark):
    assert run(sample_raw(spark), PipelineOptions(validate=False)).checks == {}


def test_views_for_sql(spark):
    result = run(sample_raw(spark))
    assert len(result.create_views()) == 13
    by_level = spark.sql("SELECT level_depth, count(*) AS n FROM hierarchy GROUP BY level_depth")
    assert rows(by_level) == [(1, 4), (2, 1)]
    segments = spark.sql("SELECT count(*), count_if(is_mapped = 1) FROM temporal_segments")
    assert rows(segments) == [(30, 23)]
    joined = spark.sql(
        "SELECT count(*) FROM fact_account_hierarchy JOIN dim_accounts USING (account_id) "
        "JOIN dim_date ON date_key = effective_start_date WHERE entity_type = 'PARTNER'"
    )
    assert rows(joined) == [(14,)]


def test_command_line(spark, tmp_path):
    from temporal_tree.__main__ import main

    paths = []
    for df, name in zip(sample_raw(spark), ("edges", "partners", "mappings")):
        df.write.parquet(str(tmp_path / name))
        paths += [f"--{name}", str(tmp_path / name)]
    out = str(tmp_path / "star")
    main([*paths, "--out", out, "--keep-unmapped", "--succession-key", "manager"])
    fact = spark.read.parquet(out + "/fact_account_hierarchy")
    assert fact.where("record_type = 'STANDALONE'").count() == 1
