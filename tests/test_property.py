"""Random dirty inputs against the model, in every form the pipeline can take."""

from __future__ import annotations

import pytest

from model import Model, ordered, random_raw, rows
from temporal_tree import PipelineOptions, RawInputs, run
from temporal_tree.schemas import RAW_MAPPINGS, RAW_PARTNERS, RAW_RELATIONSHIPS

FAR = "dates beyond the open end"
ALWAYS = {"keep_unmapped": True, "unmapped_flags": "always", "succession_key": "manager"}


def raw_inputs(spark, raw) -> RawInputs:
    schemas = (RAW_RELATIONSHIPS, RAW_PARTNERS, RAW_MAPPINGS)
    return RawInputs(*[spark.createDataFrame(r, s) for r, s in zip(raw, schemas)])


@pytest.mark.parametrize(
    "seed, hub, semantics, form",
    [
        (31, FAR, {}, {}),
        (32, FAR, {"keep_unmapped": True}, {"hot_account_rows": 4}),
        (33, FAR, {"half_open": True, "succession_key": "manager"}, {}),
        (34, FAR, ALWAYS, {}),
        (1, False, {}, {}),
        (2, False, {"half_open": True}, {}),
        (3, True, {}, {"hot_account_rows": 3, "cell_rows": 4}),
        (4, True, {"keep_unmapped": True}, {"hot_account_rows": 5, "rows_per_task": 3}),
        (5, True, ALWAYS, {"hot_account_rows": 1, "persist": "cache"}),
        (7, True, {"succession_key": "manager"}, {"persist": "none"}),
        (8, True, {}, {"collapse": False, "cell_rows": 4}),
        (9, False, {"keep_unmapped": True, "half_open": True}, {"collapse": False}),
        (10, True, ALWAYS, {"collapse": False, "closure_method": "cte"}),
    ],
)
def test_fact_matches_the_model(spark, seed, hub, semantics, form):
    raw = random_raw(seed, hub=bool(hub), far=hub is FAR)
    model = Model(raw, **semantics)
    assert model.segments and model.fact
    result = run(raw_inputs(spark, raw), PipelineOptions(**semantics, **form))
    assert rows(result.temporal.periods) == model.periods
    assert [tuple(r)[:12] for r in rows(result.star.fact)] == model.fact
    standalone = result.temporal.standalone.select("account_id", "inherit_start_date")
    assert rows(standalone) == sorted(model.standalone.items())
    dates = {d for r in model.fact for d in (r[6], r[7])}
    assert [r[0] for r in rows(result.star.dim_date)] == sorted(dates)
    accounts = result.star.dim_accounts.select("account_id").distinct()
    assert [r[0] for r in rows(accounts)] == sorted({r[1] for r in model.fact})


@pytest.mark.parametrize(
    "seed, depth, form",
    [
        (11, 12, {}),
        (11, 12, {"cell_rows": 1}),
        (12, 3, {}),
        (13, 5, {"closure_method": "cte"}),
        (14, 1, {}),
    ],
)
def test_hierarchy_matches_the_model(spark, seed, depth, form):
    raw = random_raw(seed, accounts=8)
    model = Model(raw, max_depth=depth)
    nodes = run(raw_inputs(spark, raw), PipelineOptions(max_depth=depth, **form)).hierarchy
    wanted = ordered((p,) for p in model.paths)
    assert rows(nodes.selectExpr("path")) == [(list(p[0]),) for p in wanted]
    for row in nodes.collect():
        assert row.root_account_id == row.path[0]
        assert (row.parent_account_id, row.child_account_id) == tuple(row.path[-2:])
        assert row.level_depth == len(row.path) - 1 <= depth
        for role in ("parent", "child", "root"):
            account = row[f"{role}_account_id"]
            assert row[f"{role}_is_partner"] == int(account in model.partners)


def test_segments_match_the_model(spark):
    from temporal_tree.operators import temporal

    raw = random_raw(21, hub=True)
    model = Model(raw)
    result = run(raw_inputs(spark, raw))
    wanted = ordered(model.segments)
    for cell_rows in (100_000, 2):
        got = temporal.inherit(
            temporal.segments(
                result.hierarchy,
                result.temporal.periods,
                result.normalized.mappings,
                cell_rows=cell_rows,
            )
        ).select(
            "parent_account_id", "child_account_id", "root_account_id", "level_depth",
            "period_start", "period_end", "is_mapped", "entity_id", "marketplace_id", "source",
            "calculated_root_flag", "calculated_partner_flag",
        )
        assert rows(got) == wanted


@pytest.mark.parametrize("seed, hub, semantics", [(41, True, {}), (42, FAR, ALWAYS), (43, False, {"half_open": True})])
def test_literal_segments_are_kept_as_spans(spark, seed, hub, semantics):
    """What the literal form writes has a row per path and span, not per period, and says the same."""
    from temporal_tree.operators import star, temporal

    raw = random_raw(seed, hub=bool(hub), far=hub is FAR)
    result = run(raw_inputs(spark, raw), PipelineOptions(collapse=False, cell_rows=4, **semantics))
    times, kept = result.temporal, result.temporal.segments
    spread = temporal.spread_segments(kept, times.calendar)
    assert {"lo", "hi"} < set(kept.columns) and "period_start" not in kept.columns
    assert 0 < kept.count() < spread.count() == times.all_segments.where(
        "true" if result.run.options.keep_unmapped else "is_mapped = 1"
    ).count()
    for key in ("child", "manager"):
        by_span = temporal.succession(kept, result.normalized.entity_types, key, times.calendar)
        assert rows(by_span) == rows(temporal.succession(spread, result.normalized.entity_types, key))
    unmapped = {"keep_unmapped": result.run.options.keep_unmapped}
    got = star.consolidate(kept, times.standalone, days=times.calendar, **unmapped)
    assert rows(got) == rows(star.consolidate(spread, times.standalone, **unmapped))
    # paths are reduced before their spans are spread, and what is spread is not exchanged
    plan = got._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = {word: next(i for i, line in enumerate(plan) if word in line) for word in ("explode", "Exchange", "partial_min")}
    assert depth["explode"] < depth["Exchange"] < depth["partial_min"]
