"""One test per operator, on the rows that decide its edge cases."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from model import ordered, rows
from temporal_tree import PipelineOptions, RawInputs, Scratch, run
from temporal_tree.fixtures import raw_from_star, sample_raw
from temporal_tree.operators import closure, extract, graph, normalize, parts, quality, star, temporal
from temporal_tree.operators.joins import grid_join
from temporal_tree.operators.numbering import dense_keys
from temporal_tree.schemas import (
    ENTITY_TYPES,
    FACT,
    MAPPINGS,
    RAW_MAPPINGS,
    RAW_PARTNERS,
    RAW_RELATIONSHIPS,
    RELATIONSHIPS,
    conform,
)

D1, D2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
EDGE = "parent_account_id string, child_account_id string"


def edges_of(spark, *pairs):
    return spark.createDataFrame(list(pairs), EDGE)


def names(df) -> list[str]:
    return ["/".join(r.path) for r in df.orderBy("path").collect()]


# extraction


def test_relationships_drop_deleted_and_open_ends(spark):
    raw = spark.createDataFrame(
        [
            ("a", "kept", D1, D1, "N"),
            ("a", "lower case", D1, D1, "y"),
            ("a", "deleted", D1, D1, "Y"),
            ("a", "no flag", D1, D1, None),
            (None, "no parent", D1, D1, "N"),
            ("no child", None, D1, D1, "N"),
            ("empty is not null", "", D1, D1, "N"),
        ],
        RAW_RELATIONSHIPS,
    )
    got = extract.relationships(raw)
    assert got.columns == RELATIONSHIPS.names
    assert [r[1] for r in rows(got)] == ["kept", "lower case", ""]
    assert {r[4] for r in rows(got)} == {0}


def test_partners_drop_disabled(spark):
    raw = spark.createDataFrame(
        [
            ("kept", "g", "Y", "N", "N"),
            ("flags", "g", None, "Y", "n"),
            ("disabled", "g", "Y", "Y", "Y"),
            ("no flag", "g", "Y", "Y", None),
        ],
        RAW_PARTNERS,
    )
    assert rows(extract.partners(raw)) == [("flags", "g", 0, 1, 0), ("kept", "g", 1, 0, 0)]


def test_mappings_keep_linked_with_a_start(spark):
    begin, end = date(2024, 1, 1), date(2024, 2, 1)
    raw = spark.createDataFrame(
        [
            ("open end", "e", 1, begin, None, "api", "x", "Y"),
            ("closed", "e", 1, begin, end, None, "x", "Y"),
            ("unlinked", "e", 1, begin, end, "api", "x", "N"),
            ("no start", "e", 1, None, end, "api", "x", "Y"),
        ],
        RAW_MAPPINGS,
    )
    assert rows(extract.mappings(raw)) == [
        ("closed", "e", 1, begin, end, None, "x", 1),
        ("open end", "e", 1, begin, date(2099, 12, 31), "API", "x", 1),
    ]


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "mappings")
    sample_raw(spark).mappings.write.parquet(path)
    plan = extract.mappings(spark.read.parquet(path)).select("manager_account_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(is_linked,Y)" in text and "IsNotNull(effective_start_date)" in text
    assert "advertiser_id" not in text.split("ReadSchema")[1]


def test_conform_reports_missing_columns(spark):
    with pytest.raises(ValueError, match="delete_flag"):
        conform(spark.createDataFrame([("a",)], "entity_id_one string"), RAW_RELATIONSHIPS)


# normalisation


def test_latest_relationship_wins(spark):
    rel = spark.createDataFrame(
        [
            ("a", "b", D2, D1, 0),
            ("a", "b", D1, D2, 0),
            ("a", "b", D2, D2, 0),
            ("a", "b", D2, None, 0),
            ("a", "a", D1, D1, 0),
            ("a", "", D1, D1, 0),
            ("", "b", D1, D1, 0),
        ],
        RELATIONSHIPS,
    )
    assert rows(normalize.latest_relationships(rel)) == [("a", "b", D2, D2, 0)]


def test_top_one_is_limited_before_its_shuffle(spark):
    mappings = extract.mappings(sample_raw(spark).mappings)
    text = normalize.best_mappings(mappings)._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Exchange") < text.index("Partial")


def test_entity_types_are_distinct_per_kind(spark):
    partners = spark.createDataFrame(
        [("a", "g", 1, 0, 0), ("a", "h", 1, 0, 0), ("a", "g", 0, 0, 0)],
        "partner_account_id string, group_account_id string, is_approved int, is_external int, "
        "is_disabled int",
    )
    mappings = spark.createDataFrame(
        [("a", "e", 1, None, None, None, None, 1), ("m", "e", 1, None, None, None, None, 1)],
        MAPPINGS,
    )
    kinds = normalize.entity_types(partners, mappings)
    assert rows(kinds) == [
        ("a", "MANAGER", 1, 0),
        ("a", "PARTNER", 0, 0),
        ("a", "PARTNER", 1, 0),
        ("m", "MANAGER", 1, 0),
    ]
    assert rows(normalize.partner_ids(kinds)) == [("a",)]


def test_best_mapping_by_source_then_end(spark):
    day = lambda n: date(2024, 1, n)
    mappings = spark.createDataFrame(
        [
            ("m", "e", 1, day(1), day(9), "MANUAL", "later but manual", 1),
            ("m", "e", 1, day(1), day(5), "api", "best source", 1),
            ("m", "e", 1, day(1), day(8), "OTHER", "other", 1),
            ("m", "e", 1, day(2), day(5), "API", "shorter", 1),
            ("m", "e", 1, day(2), day(6), "API", "longer", 1),
            ("m", None, None, day(2), day(6), "B", "nulls group, b", 1),
            ("m", None, None, day(2), day(6), "A", "nulls group, a", 1),
            ("m", "e", 1, day(5), day(4), "API", "inverted", 1),
        ],
        MAPPINGS,
    )
    got = normalize.best_mappings(mappings).select("advertiser_id")
    assert rows(got) == [("best source",), ("longer",), ("nulls group, a",)]


# hierarchy


def test_recursive_query_passes_the_limits_of_the_session(spark, scratch):
    chain = spark.range(14).selectExpr(
        "concat('A', id) AS parent_account_id", "concat('A', id + 1) AS child_account_id"
    )
    limits = {"spark.sql.cteRecursionRowLimit": "20", "spark.sql.cteRecursionLevelLimit": "5"}
    before = {name: spark.conf.get(name) for name in limits}
    try:
        for name, value in limits.items():
            spark.conf.set(name, value)
        levels = closure.paths(chain, 9, "cte", scratch=scratch).groupBy("level_depth").count()
        assert dict(levels.collect()) == {k: 15 - k for k in range(1, 10)}
        assert {name: spark.conf.get(name) for name in limits} == limits
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("form", [{}, {"method": "cte"}, {"cell_rows": 1}])
def test_cycle_and_diamond(spark, form):
    loop = edges_of(spark, ("A", "B"), ("B", "C"), ("C", "A"), ("B", "D"))
    assert names(closure.paths(loop, **form)) == [
        "A/B", "A/B/C", "A/B/D", "B/C", "B/C/A", "B/D", "C/A", "C/A/B", "C/A/B/D",
    ]
    diamond = edges_of(spark, ("A", "B"), ("A", "C"), ("B", "D"), ("C", "D"))
    assert names(closure.paths(diamond, **form)) == [
        "A/B", "A/B/D", "A/C", "A/C/D", "B/D", "C/D",
    ]


def test_depth_limit(spark):
    chain = edges_of(spark, *[(f"L{i:02}", f"L{i + 1:02}") for i in range(20)])
    counts = parts.path_counts(chain, 12)
    assert rows(quality.levels(counts)) == [(level, 21 - level) for level in range(1, 13)]
    report = dict(rows(quality.hierarchy(counts, chain.limit(0))))
    assert report["max_depth"] == 12 and report["beyond_max_depth"] == 8


def test_paths_beyond_the_limit(spark):
    edges = edges_of(
        spark, ("A", "B"), ("B", "C"), ("C", "A"), ("C", "D"), ("D", "B"), ("D", "E"), ("X", "C")
    )
    for depth in (1, 3):
        report = dict(rows(quality.hierarchy(parts.path_counts(edges, depth), edges, depth)))
        deeper = closure.paths(edges, depth + 1).where(F.col("level_depth") == depth + 1)
        assert report["beyond_max_depth"] == deeper.count() > 0


def random_pairs(seed, n, m):
    rng = random.Random(seed)
    return {(f"v{rng.randrange(n):02}", f"v{rng.randrange(n):02}") for _ in range(m)}


def parts_of(pairs):
    """Strongly connected parts of two accounts or more, from who reaches whom."""
    accounts = {v for pair in pairs for v in pair}
    reach = {v: {b for a, b in pairs if a == v} for v in accounts}
    for k in accounts:
        for v in accounts:
            if k in reach[v]:
                reach[v] |= reach[k]
    with_ = {v: {w for w in reach[v] if v in reach[w]} - {v} for v in accounts}
    return sorted((v, max(ws | {v})) for v, ws in with_.items() if ws)


@pytest.mark.parametrize("seed, n, m", [(2, 40, 60)])
def test_cycle_parts_and_path_counts(spark, seed, n, m):
    pairs = random_pairs(seed, n, m)
    edges = edges_of(spark, *pairs)
    for task_edges in (0, 100_000):
        assert rows(parts.cycle_parts(edges, task_edges=task_edges)) == parts_of(pairs)
    clean = edges.where("parent_account_id <> child_account_id")
    counted = {tuple(r) for r in parts.path_counts(clean, 3).select("parent_account_id", "level_depth", F.col("paths").cast("long")).collect()}
    listed = closure.paths(clean, 4).groupBy("parent_account_id", "level_depth").count()
    assert {r for r in counted if r[2]} == {tuple(r) for r in listed.collect()}


def test_parts_that_hang_together(spark):
    """Rings of all sizes, in each other's way, on long stems, and knotted."""
    pairs = ring("r", 2) + ring("s", 17) + ring("t", 5) + [("r01", "s03"), ("s09", "t00"), ("t02", "end"), ("x", "r00")]
    pairs += ring("k", 6) + [("k00", "k03"), ("k04", "k01"), ("s00", "k00"), ("q", "q")] + ring("alone", 9)
    for task_edges in (0, 100_000):
        assert rows(parts.cycle_parts(edges_of(spark, *pairs), task_edges=task_edges)) == parts_of(pairs)


class Counted(Scratch):
    """Scratch tables whose rows are counted while they are written."""

    @property
    def rows(self):
        return self.spark.read.option("recursiveFileLookup", "true").schema("_none int").parquet(self.path).count()


def test_long_graphs_without_cycles_write_linear_rows(spark):
    n = 3_000
    chain = spark.range(n).selectExpr("format_string('a%06d', id) AS parent_account_id", "format_string('a%06d', id + 1) AS child_account_id")
    other = chain.select(*(F.regexp_replace(c, "a", "b").alias(c) for c in chain.columns))
    rungs = chain.selectExpr("parent_account_id", "replace(parent_account_id, 'a', 'b') AS child_account_id")
    for edges, m in ((chain, n), (chain.unionByName(other).unionByName(rungs), 3 * n)):
        scratch = Counted(spark)
        assert graph.on_cycles(edges, scratch=scratch, task_edges=0).count() == 0
        assert scratch.rows < 12 * m
    ring_ = chain.unionByName(spark.createDataFrame([(f"a{n:06}", "a000000")], chain.schema))
    assert graph.on_cycles(ring_, task_edges=n).agg(F.count("*"), F.min("shortest_cycle"), F.max("shortest_cycle")).first()[:] == (n + 1,) * 3


def test_root_levels(spark):
    pairs = [("A", "B"), ("B", "C"), ("A", "C"), ("C", "D"), ("R", "D"), ("D", "C"), ("x", "y"), ("y", "x"), ("z", "z")]
    scratch = Counted(spark)
    levels = closure.root_levels(edges_of(spark, *pairs), scratch=scratch)
    assert rows(levels) == [("A", 0), ("B", 1), ("C", 1), ("D", 1), ("R", 0)]
    assert scratch.rows == 5


def test_checks_make_no_paths(spark, tmp_path):
    result = run(raw_from_star(spark, "/root/testdata/sf0.001"), PipelineOptions())
    with result:
        for report in result.checks.values():
            report.collect()
        written = [p.name for p in Path(result.run.scratch.path.removeprefix("file:")).iterdir()]
    assert written and not [name for name in written if "paths-to-" in name]


def test_ids_with_wildcards_and_separators(spark):
    odd = edges_of(spark, ("X", "MA_1"), ("MA_1", "MA-1"), ("MA-1", "a/MA_1"))
    assert "X/MA_1/MA-1/a/MA_1" in names(closure.paths(odd))


def test_no_edges(spark):
    none = spark.createDataFrame([], EDGE)
    assert closure.paths(none).count() == 0
    assert graph.components(none).count() == 0


def test_partner_flags_do_not_multiply_rows(spark):
    kinds = spark.createDataFrame(
        [("A", "PARTNER", 1, 0), ("A", "PARTNER", 0, 1), ("B", "MANAGER", 1, 0)], ENTITY_TYPES
    )
    edges = edges_of(spark, ("A", "B"), ("B", "C"))
    late = closure.root_flags(closure.partner_flags(closure.paths(edges), kinds))
    early = closure.root_flags(closure.paths(closure.flag_edges(edges, kinds)))
    shown = [
        "path", "parent_is_partner", "child_is_partner", "root_is_partner", "is_root_manager",
        "is_root_partner_manager",
    ]
    assert rows(late.select(shown)) == rows(early.select(shown)) == [
        (["A", "B"], 1, 0, 1, 1, 1),
        (["A", "B", "C"], 0, 0, 1, 0, 0),
        (["B", "C"], 0, 0, 0, 1, 0),
    ]


def test_shortest_levels(spark):
    edges = edges_of(spark, ("A", "B"), ("B", "C"), ("A", "C"), ("C", "A"))
    levels = rows(closure.shortest_levels(edges))
    assert levels == [("A", "B", 1), ("A", "C", 1), ("B", "A", 2), ("B", "C", 1), ("C", "A", 1), ("C", "B", 2)]
    chain = edges_of(spark, *[(f"n{i:02}", f"n{i + 1:02}") for i in range(40)])
    assert rows(closure.shortest_levels(chain)) == [
        (f"n{i:02}", f"n{j:02}", j - i) for i in range(41) for j in range(i + 1, 41)
    ]


def ring(name, n):
    return [(f"{name}{i:02}", f"{name}{(i + 1) % n:02}") for i in range(n)]


def test_cycles_once_each(spark):
    edges = edges_of(
        spark, ("B", "C"), ("C", "A"), ("A", "B"), ("B", "A"), ("X", "A"), ("C", "Y")
    )
    assert names(graph.cycles(edges, 12)) == ["A/B/A", "A/B/C/A"]
    assert names(graph.cycles(edges, 2)) == ["A/B/A"]
    assert names(graph.cycles(edges, 1)) == []


def test_cycles_of_any_length(spark):
    pairs = ring("r", 13) + ring("s", 40) + [("r00", "x"), ("x", "s00"), ("y", "r00"), ("x", "x")]
    found = rows(graph.on_cycles(edges_of(spark, *pairs)))
    assert found == ordered([(*e, 13) for e in ring("r", 13)] + [(*e, 40) for e in ring("s", 40)])
    lengths = graph.cycles(edges_of(spark, *pairs), 13).select("cycle_length")
    assert rows(lengths) == [(13,)]


def test_components(spark):
    pairs = [(f"n{i:03}", f"n{(i * 7 + 1) % 60:03}") for i in range(0, 60, 3)]
    pairs += [(f"p{i:02}", f"p{i + 1:02}") for i in range(40)] + [("self", "self")]
    pairs += [("hub", f"leaf{i}") for i in range(50)]
    label = {a: a for pair in pairs for a in pair}
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    assert rows(graph.components(edges_of(spark, *pairs))) == ordered(label.items())


def test_grid_join_equals_plain_join(spark):
    left = spark.range(400).selectExpr("if(id < 150, 'hot', concat('k', id % 40)) AS k", "id AS l")
    right = spark.range(300).selectExpr("if(id < 90, 'hot', concat('k', id % 50)) AS k", "id AS r")
    plain = rows(left.join(right, "k"))
    for cell_rows in (1, 16, 1000, 10**9):
        joined = grid_join(left, right, "k", left_id=["l"], right_id=["r"], cell_rows=cell_rows)
        assert joined.columns == ["k", "l", "r"]
        assert rows(joined) == plain


def test_grid_join_bounds_every_cell(spark):
    """Output rows per cell, counted from the cells themselves, with and without weights."""
    hub = spark.range(1000).selectExpr("'hot' AS k", "id AS l")
    other = spark.range(500).selectExpr("'hot' AS k", "id AS r", "1 + id % 7 AS w")
    for weight in (None, F.col("w")):
        joined = grid_join(
            hub, other, "k", left_id=["l"], right_id=["r"], cell_rows=10_000, right_weight=weight
        )
        per_row = F.lit(1) if weight is None else weight
        joins = [n for n in plan_lines(joined) if "Join" in n and "_left" in n and "_right" in n]
        assert joins, "the join is on the cell"
        bands = joined.sparkSession.createDataFrame(
            [(i,) for i in range(1000)], "l long"
        ).select("l", F.pmod(F.xxhash64("l"), F.lit(10)).alias("band"))
        largest = (
            joined.join(bands, "l").groupBy("band").agg(F.sum(per_row).alias("n")).agg(F.max("n"))
        ).first()[0]
        total = joined.agg(F.sum(per_row)).first()[0]
        assert joined.count() == 500_000 and largest < 1.5 * total / 10


def plan_lines(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_segment_cells_count_spread_rows(spark, scratch):
    """A parent with long spans is cut by the rows after spreading, and the rows stay the same."""
    days = [(date(2020, 1, 1) + timedelta(days=i), date(2020, 1, 1) + timedelta(days=i)) for i in range(300)]
    periods = spark.createDataFrame(days, "period_start date, period_end date")
    nodes = spark.createDataFrame(
        [("P", f"c{i}", "P", 1, 0, 0, 1, 0) for i in range(50)],
        "parent_account_id string, child_account_id string, root_account_id string, level_depth int, "
        "parent_is_partner int, child_is_partner int, is_root_manager int, is_root_partner_manager int",
    )
    held = spark.createDataFrame(
        [("P", f"e{i}", 1, date(2020, 1, 1), date(2020, 10, 26), "API", "x", 1) for i in range(40)], MAPPINGS
    )
    whole = temporal.segments(nodes, periods, held, cell_rows=10**9, scratch=scratch)
    cut = temporal.segments(nodes, periods, held, cell_rows=10_000, scratch=scratch)
    assert any("_left" in line for line in plan_lines(cut))
    assert not any("_left" in line for line in plan_lines(whole))
    shown = ["child_account_id", "entity_id", "period_start", "is_mapped"]
    assert cut.count() == whole.count() > 500_000
    assert cut.select(shown).exceptAll(whole.select(shown)).isEmpty()


def test_fact_ranges_hold_where_long_spans_are_neighbours(spark, scratch):
    """Open-ended spans of neighbouring accounts do not make tasks larger than asked for."""
    starts = [date(2020, 1, 1) + timedelta(days=i) for i in range(200)]
    days = scratch.save(
        temporal.calendar(
            spark.createDataFrame(
                [(d, e - timedelta(days=1)) for d, e in zip(starts, [*starts[1:], date(2099, 12, 31)])],
                "period_start date, period_end date",
            )
        ),
        "days",
    )
    spans = scratch.save(
        spark.range(10_000).selectExpr(
            "format_string('a%06d', id) AS account_id", "'e' AS entity_id", "1 AS marketplace_id", "0 AS lo",
            "if(id < 500, 199, 0) AS hi", "false AS open_tail", "1 AS level_depth", "1 AS is_root_manager",
            "0 AS is_root_partner_manager", "'API' AS source",
        ),
        "spans",
    )
    total = 500 * 200 + 9_500
    fact = star.fact_from_spans(
        spans, days, scratch, total_rows=total, total_spans=10_000, rows_per_task=10_000
    )
    assert fact.count() == total
    written = scratch.spark.read.parquet(f"{scratch.path}/*-ordered")
    largest = written.groupBy(F.shiftright("_id", 33)).count().agg(F.max("count")).first()[0]
    assert largest <= 20_000


# time


def test_end_date_reading(spark):
    """A mapping of one day covers it only in the half-open reading, unless the next day is a cut
    anyway."""
    mapping = [("A", "E", 1, date(2024, 1, 5), date(2024, 1, 5), "API", "x", "Y")]
    raw = RawInputs(
        spark.createDataFrame([("A", "B", D1, D1, "N")], RAW_RELATIONSHIPS),
        spark.createDataFrame([], RAW_PARTNERS),
        spark.createDataFrame(mapping, RAW_MAPPINGS),
    )
    assert run(raw).star.fact.count() == 0
    covered = run(raw, PipelineOptions(half_open=True)).star.fact
    assert [tuple(r)[6:8] for r in rows(covered)] == [(date(2024, 1, 5), date(2024, 1, 5))]


def test_succession_of_a_partner_child(spark):
    raw = RawInputs(
        spark.createDataFrame([("A", "P", D1, D1, "N"), ("A", "Q", D1, D1, "N")], RAW_RELATIONSHIPS),
        spark.createDataFrame([("P", "g", "Y", "N", "N"), ("P", "g", "N", "N", "N")], RAW_PARTNERS),
        spark.createDataFrame(
            [("A", "E", 1, date(2024, 1, 5), date(2024, 2, 5), "API", "x", "Y")], RAW_MAPPINGS
        ),
    )
    fact = run(raw).star.fact.where("record_type = 'STANDALONE'").drop("hierarchy_key", "created_at")
    assert rows(fact) == [
        ("P", None, None, "P", 0, date(2024, 2, 5), date(2099, 12, 31), 1, 1, "INHERITANCE",
         "STANDALONE")
    ]


def test_merge_spans(spark):
    spans = spark.createDataFrame(
        [("a", 0, 2), ("a", 1, 5), ("a", 6, 7), ("a", 9, 9), ("a", 9, 9), (None, 3, 3), ("b", 0, 9),
         ("b", 2, 3), ("b", 5, 6)],
        "k string, lo int, hi int",
    )
    assert rows(temporal.merge_spans(spans, ["k"])) == [
        (None, 3, 3), ("a", 0, 7), ("a", 9, 9), ("b", 0, 9),
    ]


# star


def test_dense_keys(spark, scratch):
    df = spark.range(500).selectExpr("id % 7 AS a", "if(id % 11 = 0, null, id) AS b", "id AS c")
    keyed = dense_keys(df.repartition(6), ["a", "b", "c"], "n", scratch)
    wanted = sorted(df.collect(), key=lambda r: (r.a, (r.b is not None, r.b), r.c))
    assert [(r.a, r.b, r.c) for r in keyed.orderBy("n").collect()] == [tuple(r) for r in wanted]
    assert [r.n for r in keyed.orderBy("n").collect()] == list(range(1, 501))


def test_fact_is_built_with_one_shuffle_of_spans(spark, scratch, monkeypatch):
    plans = {}
    save = type(scratch).save

    def spy(self, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return save(self, df, name)

    monkeypatch.setattr(type(scratch), "save", spy)
    run(sample_raw(spark)).star.fact.count()
    plan = plans["ordered"]
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan
    assert plan.index("Generate explode") < plan.index("rangepartitioning")
    # the merge of spans gets its partitioning from the stated shuffle, after the join by manager
    merge = plans["spans"].split("REPARTITION_BY_COL")
    assert len(merge) == 2 and merge[0].count("Window [") == 2
    assert merge[0].count("Exchange") == 1 and "Join" not in merge[0]
    run(sample_raw(spark), PipelineOptions(hot_account_rows=2)).star.fact.count()
    assert plans["ordered"].count("rangepartitioning") == 1


def test_consolidation_sorts_no_paths(spark):
    """The paths of an account are reduced by hashing in map tasks: what is sorted has a row per key and source."""
    rnd = random.Random(5)
    paths = [
        (parent, f"c{i}", rnd.choice([parent, "r10", "r9", "r1"]), rnd.randint(1, 3), rnd.randint(0, 1))
        for parent in ("a", "b")
        for i in range(30)
    ]
    hierarchy = spark.createDataFrame(
        paths, EDGE + ", root_account_id string, level_depth int, calculated_partner_flag int"
    )
    spans = spark.createDataFrame(
        [
            (account, entity, 1, source, date(2024, month, 1), date(2024, month, 28), 1)
            for account in ("a", "b")
            for entity in ("e", None)
            for source in ("MANUAL", "x", "w", None)
            for month in range(1, rnd.randint(2, 6))
        ],
        "manager_account_id string, entity_id string, marketplace_id int, source string, "
        "period_start date, period_end date, is_mapped int",
    )
    alone = spark.createDataFrame(
        [("b", date(2024, 7, 1), date(2099, 12, 31), 1)],
        "account_id string, inherit_start_date date, inherit_end_date date, inherited_root_flag int",
    )

    def spread(paths):
        managed = spans.withColumn("parent_account_id", F.col("manager_account_id"))
        return paths.withColumn("calculated_root_flag", F.lit(1)).join(managed, "parent_account_id")

    ranked = temporal.root_order(hierarchy)
    assert ranked.count() == len(paths)
    got = star.consolidate(spread(ranked), alone)
    plain = star.consolidate(spread(hierarchy), alone)
    assert got.columns == plain.columns
    assert rows(got) == rows(plain)
    assert "partial_min" in got._jdf.queryExecution().executedPlan().toString()


def test_literal_segments_hold_the_order_of_roots(spark):
    result = run(sample_raw(spark), PipelineOptions(collapse=False))
    assert "root_order" in result.temporal.segments.columns
    assert "root_order" not in result.temporal.all_segments.columns


def test_dim_accounts_grain(spark):
    facts = spark.createDataFrame([("A",), ("A",), ("B",), ("C",)], "account_id string")
    kinds = spark.createDataFrame(
        [("A", "MANAGER", 1, 0), ("A", "PARTNER", 0, 1), ("B", "MANAGER", 1, 0)], ENTITY_TYPES
    )
    every = star.dim_accounts(facts, kinds, D1)
    assert rows(every.drop("created_at")) == [
        ("A", "MANAGER", 1, 0), ("A", "PARTNER", 0, 1), ("B", "MANAGER", 1, 0), ("C", "UNKNOWN", 0, 0),
    ]
    single = star.dim_accounts(facts, kinds, D1, one_row_per_account=True)
    assert [r[:2] for r in rows(single)] == [("A", "PARTNER"), ("B", "MANAGER"), ("C", "UNKNOWN")]


def test_fact_gathered_by_account(spark):
    plain = run(sample_raw(spark)).star.fact
    with run(sample_raw(spark), PipelineOptions(partition_by_account=True)) as result:
        gathered = result.star.fact
        assert gathered.is_cached and rows(gathered.drop("created_at")) == rows(plain.drop("created_at"))


def test_tables_are_made_when_they_are_used(spark):
    """The scratch tables that each use leaves, by name."""

    def tables(use):
        with run(sample_raw(spark)) as result:
            use(result)
            folder = Path(result.run.scratch.path.removeprefix("file:"))
            return {p.name.partition("-")[2].rstrip("-0123456789") for p in folder.glob("*")}

    assert tables(lambda r: r.normalized.entity_types) == set()
    assert tables(lambda r: r.hierarchy) == {"edges", "paths-to"}
    assert tables(lambda r: graph.components(r.normalized.edges, scratch=r.run.scratch)) == {"edges", "links"}
    assert tables(lambda r: r.temporal.periods) == {"edges", "best_mappings", "calendar"}
    assert tables(lambda r: (r.star.dim_accounts, r.star.dim_date)) == {"edges", "best_mappings", "calendar", "spans"}


def test_moments_are_read_in_utc(spark):
    """TIMESTAMP columns mean the same days in every session time zone."""
    raw = sample_raw(spark)
    late = raw.relationships.selectExpr(
        "entity_id_one", "entity_id_two", "timestamp_seconds(1704074400) AS created_at",
        "timestamp_micros(1704074400123456) AS updated_at", "delete_flag",
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    seen = []
    try:
        for name in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", name)
            result = run(raw._replace(relationships=late), PipelineOptions(load_ts=D1))
            first = result.extracted.relationships.select(F.col("updated_at").cast("string")).first()[0]
            assert first == "2024-01-01 02:00:00.123456"
            seen.append((rows(result.temporal.periods), rows(result.star.fact)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert seen[0] == seen[1]


def test_one_definition_of_the_segment_view(spark):
    counts = set()
    for collapse in (True, False):
        for keep in (True, False):
            options = PipelineOptions(collapse=collapse, keep_unmapped=keep, load_ts=D1)
            with run(sample_raw(spark), options) as result:
                result.create_views("temporal_segments")
                counts.add(spark.table("temporal_segments").count())
    assert len(counts) == 1


# checks


def test_quality_counts_dirty_rows(spark):
    dirty = spark.createDataFrame(
        [("a", "a"), (None, "b"), ("a", None), ("a", "b"), ("a", "b")], EDGE
    )
    assert dict(rows(quality.relationships(dirty))) == {
        "total_relationships": 5, "self_references": 1, "null_parents": 1, "null_children": 1,
    }
    day = lambda n: date(2024, 1, n)

    def row(account, place, begin, end):
        return (1, account, "E", place, account, 1, begin, end, 1, 1, "API", "HIERARCHY", D1)

    facts = spark.createDataFrame(
        [
            row("a", 1, day(1), day(5)),
            row("a", 1, day(1), day(5)),
            row("a", 2, day(1), day(5)),
            row("b", 1, day(1), day(5)),
            row("b", 1, day(5), day(6)),
            row("c", 1, day(1), day(5)),
            row("c", 1, day(6), day(7)),
            row("d", 1, day(7), day(6)),
        ],
        FACT,
    )
    assert dict(rows(quality.fact(facts))) == {
        "total_records": 8, "inverted_ranges": 1, "duplicates": 1,
        "duplicates_ignoring_marketplace": 1,
    }
    late = spark.createDataFrame(
        [("m", "e", 1, day(1), date(2100, 1, 1), "API", "x", 1)], MAPPINGS
    )
    assert dict(rows(quality.mappings(late)))["dates_after_open_end"] == 1
    held = [("m", "e", 1, 1, 3), ("m", "e", 1, 3, 5), ("m", "f", 1, 1, 3), ("m", "f", 1, 4, 5), ("n", "e", 1, 1, 3)]
    mapped = spark.createDataFrame(
        [(m, e, p, day(a), day(b), "API", "x", 1) for m, e, p, a, b in held], MAPPINGS
    )
    managed = spark.createDataFrame(
        [("m", "e", 0, 1), ("m", "f", 2, 2), ("n", "e", 0, 0), ("n", None, 1, 2)],
        "parent_account_id string, entity_id string, lo int, hi int",
    )
    nodes = edges_of(spark, ("m", "x"), ("m", "y"), ("n", "z"))
    assert dict(rows(quality.segments(parts.path_counts(nodes, 12), managed, mapped))) == {
        "total_segments": 2 * 2 + 2 + 1 + 2, "accounts_with_multiple_segments": 3, "overlapping_groups": 1,
    }
    nothing = facts.where(F.lit(False))
    assert set(dict(rows(quality.fact(nothing))).values()) == {0}


def test_derived_inputs_use_every_row(spark):
    raw = raw_from_star(spark, "/root/testdata/sf0.001")
    customers = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").count()
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    assert raw.partners.select("partner_account_id").distinct().count() == customers
    assert raw.mappings.select("advertiser_id").distinct().count() == orders


def test_counted_output_sets_the_tasks_of_a_join(spark):
    left = spark.range(300).selectExpr("id % 30 AS k", "id AS a")
    right = spark.range(60).selectExpr("id % 30 AS k", "id AS b")
    ids = {"left_id": ["a"], "right_id": ["b"], "right_weight": F.lit(5)}
    for cell_rows in (10, 1_000_000):
        got = grid_join(left, right, "k", cell_rows=cell_rows, task_rows=100, **ids)
        assert got.rdd.getNumPartitions() == 30  # 600 rows, 5 times each
        assert rows(got) == rows(left.join(right, "k"))


def test_fact_check_counts_keys_in_tasks_of_bounded_rows(spark):
    facts = spark.range(40).selectExpr(
        "concat('A', id % 20) AS account_id", "cast(null AS string) AS entity_id", "cast(id DIV 20 AS int) AS marketplace_id",
        "date'2024-01-01' AS effective_start_date", "date'2024-01-31' AS effective_end_date",
    )
    report = quality.fact(facts.union(facts.limit(1)), task_rows=4)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "effective_end_date" in plan and ", 11), REPARTITION_BY_NUM" in plan
    assert dict(rows(report)) == {
        "total_records": 41, "inverted_ranges": 0, "duplicates": 1, "duplicates_ignoring_marketplace": 20,
    }
