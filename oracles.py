"""SQL that computes each registered query in another way, from the test tables alone.

The statements share one chain of common table expressions: the derived raw tables, the stages in
their literal form (every path, every period, every segment) and the fact. An engine that skips
unreferenced expressions, as DuckDB does, evaluates only what a query needs.
"""

from __future__ import annotations

LOAD_TS = "2024-01-01 00:00:00"

_RAW = """
cust AS (
  SELECT c_custkey AS k, c_custkey // 3 AS up, c_nationkey, c_acctbal, c_mktsegment,
         make_date(1995 + c_custkey % 6, 1 + c_custkey % 12, 1) AS made,
         CASE WHEN c_custkey % 17 = 3 THEN 'Y' WHEN c_custkey % 53 = 5 THEN NULL ELSE 'N' END AS gone
  FROM customer
),
drawn AS (
  SELECT 'A' || up AS one, 'A' || k AS two, made AS made, 0 AS age, gone FROM cust WHERE k > 0
  UNION ALL SELECT 'A' || up, 'A' || k, made, 10, gone FROM cust WHERE k > 0 AND k % 7 = 0
  UNION ALL SELECT 'A' || (up + 1), 'A' || k, made, 0, 'N' FROM cust WHERE k % 25 = 0
  UNION ALL SELECT 'A' || k, 'A' || (up // 3), made, 0, 'N' FROM cust WHERE k % 40 = 11
  UNION ALL SELECT 'L' || k, 'L' || (k + 1), made, 0, 'N' FROM cust WHERE k % 200 < 20
  UNION ALL SELECT 'A' || k, 'A' || k, made, 0, 'N' FROM cust WHERE k % 97 = 0
  UNION ALL SELECT 'A' || k, '', made, 0, 'N' FROM cust WHERE k % 101 = 50
  UNION ALL SELECT 'A' || k, NULL, made, 0, 'N' FROM cust WHERE k % 103 = 7
),
raw_rel AS (
  SELECT one AS entity_id_one, two AS entity_id_two,
         CAST(made - age AS TIMESTAMP) AS created_at,
         CAST(made + (30 - age) AS TIMESTAMP) AS updated_at,
         gone AS delete_flag
  FROM drawn
),
raw_par AS (
  SELECT 'A' || k AS partner_account_id, 'G' || (k % 10) AS group_account_id,
         CASE WHEN c_acctbal > 0 THEN 'Y' ELSE 'N' END AS is_registration_approved,
         CASE WHEN (c_mktsegment = 'BUILDING') = plain THEN 'Y' ELSE 'N' END
           AS is_external_partner_account,
         CASE WHEN k % 3 <> 0 OR c_nationkey = 0 THEN 'Y'
              WHEN k % 59 = 0 THEN NULL ELSE 'N' END AS is_disabled
  FROM cust CROSS JOIN (VALUES (true), (false)) AS copies(plain)
  WHERE plain OR k % 33 = 0
),
bill AS (
  SELECT o_orderkey AS o, o_custkey, o_orderstatus, substr(o_orderpriority, 1, 1) AS prio,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS begun
  FROM orders
),
raw_map AS (
  SELECT 'A' || o_custkey AS manager_account_id,
         CASE WHEN o % 211 <> 0 THEN 'E' || (o % 200) END AS entity_id,
         CASE WHEN o % 211 <> 0 THEN CAST(o % 5 AS INTEGER) END AS marketplace_id,
         CASE WHEN o % 223 <> 0 THEN begun END AS effective_start_date,
         CASE WHEN inverted THEN begun - 5
              WHEN o % 10 <> 0
              THEN last_day(CAST(begun + to_months(CAST(o % 9 AS INTEGER)) AS DATE))
         END AS effective_end_date,
         CASE WHEN o % 97 = 0 THEN NULL WHEN prio IN ('1', '5') THEN 'api'
              WHEN prio = '2' THEN 'Manual' ELSE 'feed' END AS source,
         'ADV' || o AS advertiser_id,
         CASE WHEN o_orderstatus = 'P' THEN 'N' ELSE 'Y' END AS is_linked
  FROM bill CROSS JOIN (VALUES (false), (true)) AS copies(inverted)
  WHERE NOT inverted OR o % 67 = 0
)"""

_STAGES = """
rel AS (
  SELECT entity_id_one AS parent_account_id, entity_id_two AS child_account_id, created_at,
         updated_at, CAST(0 AS INTEGER) AS is_deleted
  FROM raw_rel
  WHERE delete_flag <> 'Y' AND entity_id_one IS NOT NULL AND entity_id_two IS NOT NULL
),
par AS (
  SELECT partner_account_id, group_account_id,
         CAST(is_registration_approved = 'Y' AS INTEGER) AS is_approved,
         CAST(is_external_partner_account = 'Y' AS INTEGER) AS is_external,
         CAST(0 AS INTEGER) AS is_disabled
  FROM raw_par WHERE is_disabled <> 'Y'
),
map AS (
  SELECT manager_account_id, entity_id, marketplace_id, effective_start_date,
         coalesce(effective_end_date, DATE '2099-12-31') AS effective_end_date,
         upper(source) AS source, advertiser_id, CAST(1 AS INTEGER) AS is_linked
  FROM raw_map WHERE is_linked = 'Y' AND effective_start_date IS NOT NULL
),
edge AS (
  SELECT DISTINCT ON (parent_account_id, child_account_id) *
  FROM rel
  WHERE parent_account_id <> child_account_id AND parent_account_id <> ''
    AND child_account_id <> ''
  ORDER BY parent_account_id, child_account_id, updated_at DESC NULLS LAST,
           created_at DESC NULLS LAST
),
kind AS (
  SELECT DISTINCT partner_account_id AS account_id, 'PARTNER' AS entity_type, is_approved,
         is_external
  FROM par
  UNION ALL
  SELECT DISTINCT manager_account_id, 'MANAGER', CAST(1 AS INTEGER), CAST(0 AS INTEGER) FROM map
),
partner AS (SELECT DISTINCT account_id FROM kind WHERE entity_type = 'PARTNER'),
best AS (
  SELECT DISTINCT ON (manager_account_id, entity_id, marketplace_id, effective_start_date) *
  FROM map WHERE effective_start_date <= effective_end_date
  ORDER BY manager_account_id, entity_id, marketplace_id, effective_start_date,
           CASE WHEN source = 'API' THEN 1 WHEN source = 'MANUAL' THEN 2 ELSE 3 END,
           effective_end_date DESC, source NULLS LAST, advertiser_id NULLS LAST
),
walk AS (
  SELECT parent_account_id, child_account_id, parent_account_id AS root_account_id,
         CAST(1 AS INTEGER) AS level_depth, [parent_account_id, child_account_id] AS path
  FROM edge
  UNION ALL
  SELECT e.parent_account_id, e.child_account_id, w.root_account_id,
         CAST(w.level_depth + 1 AS INTEGER), list_append(w.path, e.child_account_id)
  FROM walk w JOIN edge e ON e.parent_account_id = w.child_account_id
  WHERE w.level_depth < 12 AND NOT list_contains(w.path, e.child_account_id)
),
node AS (
  SELECT w.*,
         CAST(parent_account_id IN (FROM partner) AS INTEGER) AS parent_is_partner,
         CAST(child_account_id IN (FROM partner) AS INTEGER) AS child_is_partner,
         CAST(root_account_id IN (FROM partner) AS INTEGER) AS root_is_partner,
         CAST(parent_account_id = root_account_id AS INTEGER) AS is_root_manager,
         CASE WHEN level_depth = 1 AND parent_account_id IN (FROM partner) THEN 1
              WHEN parent_account_id = root_account_id AND root_account_id IN (FROM partner)
              THEN 1 ELSE 0 END AS is_root_partner_manager
  FROM walk w
),
cut AS (
  SELECT effective_start_date AS d FROM best
  UNION SELECT effective_end_date FROM best WHERE effective_end_date <> DATE '2099-12-31'
  UNION SELECT CAST(created_at AS DATE) FROM edge WHERE created_at IS NOT NULL
),
period AS (
  SELECT d AS period_start,
         coalesce(lead(d) OVER (ORDER BY d) - 1, DATE '2099-12-31') AS period_end
  FROM cut
),
cut_after AS (
  SELECT effective_start_date AS d FROM best
  UNION SELECT effective_end_date + 1 FROM best WHERE effective_end_date <> DATE '2099-12-31'
  UNION SELECT CAST(created_at AS DATE) FROM edge WHERE created_at IS NOT NULL
),
period_half_open AS (
  SELECT d AS period_start,
         coalesce(lead(d) OVER (ORDER BY d) - 1, DATE '2099-12-31') AS period_end
  FROM cut_after
),
held AS (
  SELECT b.manager_account_id, b.entity_id, b.marketplace_id, b.source, p.period_start,
         p.period_end
  FROM best b JOIN period p
    ON p.period_start >= b.effective_start_date AND p.period_end <= b.effective_end_date
),
seg AS (
  SELECT n.parent_account_id, n.child_account_id, n.root_account_id, n.level_depth,
         n.parent_is_partner, n.child_is_partner, n.is_root_manager, n.is_root_partner_manager,
         p.period_start, p.period_end, h.manager_account_id, h.entity_id, h.marketplace_id,
         h.source, CAST(h.manager_account_id IS NOT NULL AS INTEGER) AS is_mapped
  FROM node n CROSS JOIN period p
  LEFT JOIN held h
    ON h.manager_account_id = n.parent_account_id AND h.period_start = p.period_start
),
flagged AS (
  SELECT *,
         CASE WHEN is_mapped = 1 THEN is_root_manager ELSE parent_is_partner END
           AS calculated_root_flag,
         CASE WHEN is_mapped = 1 THEN is_root_partner_manager
              ELSE parent_is_partner * child_is_partner END AS calculated_partner_flag
  FROM seg
),
after_child AS (
  SELECT child_account_id AS account_id, CAST(max(period_end) + 1 AS DATE) AS inherit_start_date,
         DATE '2099-12-31' AS inherit_end_date, CAST(1 AS INTEGER) AS inherited_root_flag
  FROM seg WHERE is_mapped = 1 AND child_account_id IN (FROM partner)
  GROUP BY child_account_id HAVING max(period_end) < DATE '2099-12-31'
),
after_manager AS (
  SELECT parent_account_id AS account_id, CAST(max(period_end) + 1 AS DATE) AS inherit_start_date,
         DATE '2099-12-31' AS inherit_end_date, CAST(1 AS INTEGER) AS inherited_root_flag
  FROM seg WHERE is_mapped = 1 AND parent_account_id IN (FROM partner)
  GROUP BY parent_account_id HAVING max(period_end) < DATE '2099-12-31'
)"""


def _consolidated(name: str, managed: str, standalone: str) -> str:
    return f"""
{name} AS (
  SELECT DISTINCT ON (account_id, entity_id, marketplace_id, effective_start_date,
                      effective_end_date) *
  FROM (
    {managed}
    UNION ALL
    SELECT account_id, NULL, NULL, inherit_start_date, inherit_end_date, 0, account_id,
           inherited_root_flag, inherited_root_flag, 'INHERITANCE', 'STANDALONE'
    FROM {standalone}
  )
  ORDER BY account_id, entity_id, marketplace_id, effective_start_date, effective_end_date,
           is_root_partner_manager DESC,
           CASE source WHEN 'API' THEN 1 WHEN 'INHERITANCE' THEN 2 WHEN 'MANUAL' THEN 3 ELSE 4 END,
           level_depth, source NULLS LAST
)"""


_FINAL = _consolidated(
    "final",
    """SELECT manager_account_id AS account_id, entity_id, marketplace_id,
           period_start AS effective_start_date, period_end AS effective_end_date, level_depth,
           root_account_id, calculated_root_flag AS is_root_manager,
           calculated_partner_flag AS is_root_partner_manager, source,
           'HIERARCHY' AS record_type
    FROM flagged WHERE is_mapped = 1""",
    "after_child",
)
_VARIANT = _consolidated(
    "variant",
    """SELECT parent_account_id AS account_id, entity_id, marketplace_id,
           period_start AS effective_start_date, period_end AS effective_end_date, level_depth,
           root_account_id,
           CASE WHEN is_mapped = 1 THEN is_root_manager ELSE 1 END AS is_root_manager,
           CASE WHEN is_mapped = 1 THEN is_root_partner_manager ELSE 1 END
             AS is_root_partner_manager,
           coalesce(source, 'HIERARCHY') AS source, 'HIERARCHY' AS record_type
    FROM seg""",
    "after_manager",
)

_UNMAPPED = _consolidated(
    "unmapped",
    """SELECT parent_account_id AS account_id, entity_id, marketplace_id,
           period_start AS effective_start_date, period_end AS effective_end_date, level_depth,
           root_account_id, calculated_root_flag AS is_root_manager,
           calculated_partner_flag AS is_root_partner_manager,
           coalesce(source, 'HIERARCHY') AS source, 'HIERARCHY' AS record_type
    FROM flagged""",
    "after_child",
)
_HALF_OPEN = """
held_half_open AS (
  SELECT b.manager_account_id, b.entity_id, b.marketplace_id, b.source, p.period_start,
         p.period_end
  FROM best b JOIN period_half_open p
    ON p.period_start >= b.effective_start_date AND p.period_end <= b.effective_end_date
),
after_half_open AS (
  SELECT n.child_account_id AS account_id, CAST(max(h.period_end) + 1 AS DATE) AS inherit_start_date,
         DATE '2099-12-31' AS inherit_end_date, CAST(1 AS INTEGER) AS inherited_root_flag
  FROM node n JOIN held_half_open h ON h.manager_account_id = n.parent_account_id
  WHERE n.child_account_id IN (FROM partner)
  GROUP BY n.child_account_id HAVING max(h.period_end) < DATE '2099-12-31'
)""" + "," + _consolidated(
    "half_open",
    """SELECT h.manager_account_id AS account_id, entity_id, marketplace_id,
           period_start AS effective_start_date, period_end AS effective_end_date, level_depth,
           root_account_id, is_root_manager, is_root_partner_manager, source,
           'HIERARCHY' AS record_type
    FROM node n JOIN held_half_open h ON h.manager_account_id = n.parent_account_id""",
    "after_half_open",
)

_WITH = "WITH RECURSIVE" + ",".join([_RAW, _STAGES, _FINAL, _VARIANT, _UNMAPPED, _HALF_OPEN])

_FACT_COLUMNS = """CAST(row_number() OVER (
         ORDER BY account_id, effective_start_date, entity_id NULLS FIRST,
                  marketplace_id NULLS FIRST, effective_end_date) AS BIGINT) AS hierarchy_key,
       account_id, entity_id, marketplace_id, root_account_id,
       CAST(level_depth AS INTEGER) AS level_depth, effective_start_date, effective_end_date,
       CAST(is_root_manager AS INTEGER) AS is_root_manager,
       CAST(is_root_partner_manager AS INTEGER) AS is_root_partner_manager, source, record_type"""


def _metrics(source: str, **measures: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS metric, CAST(coalesce({value}, 0) AS BIGINT) AS value FROM {source}"
        for name, value in measures.items()
    )


def _fact(table: str) -> str:
    return f"SELECT {_FACT_COLUMNS}, TIMESTAMP '{LOAD_TS}' AS created_at FROM {table}"


_PATHS = """SELECT parent_account_id, child_account_id, root_account_id, level_depth,
       array_to_string(path, '/') AS path_trace"""
_SEGMENT = """SELECT parent_account_id, child_account_id, root_account_id, level_depth,
       parent_is_partner, child_is_partner, is_root_manager,
       CAST(is_root_partner_manager AS INTEGER) AS is_root_partner_manager, period_start,
       period_end, manager_account_id, entity_id, marketplace_id, source, is_mapped"""
_KEY = "account_id, entity_id, marketplace_id, effective_start_date, effective_end_date"

# breadth first: a pair that is known already is not reached again
_NEAREST = """, nearest(root, child, level) USING KEY (root, child) AS (
         SELECT parent_account_id, child_account_id, 1 FROM edge
         UNION
         SELECT n.root, e.child_account_id, min(n.level + 1)
         FROM nearest n JOIN edge e ON e.parent_account_id = n.child
         LEFT JOIN recurring.nearest k ON k.root = n.root AND k.child = e.child_account_id
         WHERE k.root IS NULL AND n.root <> e.child_account_id
         GROUP BY n.root, e.child_account_id
       )"""

_QUERIES = {
    "extract_relationships": "SELECT * FROM rel",
    "extract_partners": "SELECT * FROM par",
    "extract_mappings": "SELECT * FROM map",
    "latest_relationships": "SELECT * FROM edge",
    "entity_types": "SELECT * FROM kind",
    "best_mappings": "SELECT * FROM best",
    "closure_paths": f"{_PATHS} FROM walk",
    "closure_paths_cte": f"{_PATHS} FROM walk",
    "partner_flags": f"{_PATHS}, parent_is_partner, child_is_partner, root_is_partner FROM node",
    "root_flags": f"""{_PATHS}, parent_is_partner, child_is_partner, root_is_partner,
       is_root_manager, CAST(is_root_partner_manager AS INTEGER) AS is_root_partner_manager
       FROM node""",
    "date_periods": "SELECT * FROM period",
    "date_periods_half_open": "SELECT * FROM period_half_open",
    "temporal_segments": f"{_SEGMENT} FROM seg",
    "inheritance_flags": f"""{_SEGMENT},
       CAST(calculated_root_flag AS INTEGER) AS calculated_root_flag,
       CAST(calculated_partner_flag AS INTEGER) AS calculated_partner_flag FROM flagged""",
    "succession_child": "SELECT * FROM after_child",
    "succession_manager": "SELECT * FROM after_manager",
    "consolidated": f"""SELECT {_KEY}, CAST(level_depth AS INTEGER) AS level_depth,
       root_account_id, CAST(is_root_manager AS INTEGER) AS is_root_manager,
       CAST(is_root_partner_manager AS INTEGER) AS is_root_partner_manager, source, record_type
       FROM final""",
    "fact_hierarchy": _fact("final"),
    "dim_accounts": f"""SELECT a.account_id, coalesce(k.entity_type, 'UNKNOWN') AS entity_type,
       coalesce(k.is_approved, 0) AS is_approved, coalesce(k.is_external, 0) AS is_external,
       TIMESTAMP '{LOAD_TS}' AS created_at
       FROM (SELECT DISTINCT account_id FROM final) a LEFT JOIN kind k USING (account_id)""",
    "dim_accounts_single": f"""SELECT a.account_id, coalesce(k.entity_type, 'UNKNOWN') AS entity_type,
       coalesce(k.is_approved, 0) AS is_approved, coalesce(k.is_external, 0) AS is_external,
       TIMESTAMP '{LOAD_TS}' AS created_at
       FROM (SELECT DISTINCT account_id FROM final) a LEFT JOIN (
         SELECT DISTINCT ON (account_id) * FROM kind
         ORDER BY account_id, entity_type <> 'PARTNER', is_approved DESC, is_external DESC
       ) k USING (account_id)""",
    "dim_date": """SELECT d AS date_key, CAST(year(d) AS INTEGER) AS year_num,
       CAST(month(d) AS INTEGER) AS month_num, CAST(day(d) AS INTEGER) AS day_num,
       CAST(quarter(d) AS INTEGER) AS quarter_num
       FROM (SELECT effective_start_date AS d FROM final
             UNION SELECT effective_end_date FROM final)""",
    "star_roundtrip": _fact("final"),
    "quality_relationships": _metrics(
        "raw_rel",
        total_relationships="count(*)",
        self_references="count(*) FILTER (entity_id_one = entity_id_two)",
        null_parents="count(*) FILTER (entity_id_one IS NULL)",
        null_children="count(*) FILTER (entity_id_two IS NULL)",
    )
    + " UNION ALL "
    + _metrics("edge", clean_relationships="count(*)"),
    "quality_mappings": _metrics(
        "best",
        total_mappings="count(*)",
        dates_after_open_end="""count(*) FILTER (
          effective_start_date > DATE '2099-12-31' OR effective_end_date > DATE '2099-12-31')""",
    ),
    "quality_hierarchy": (
        _NEAREST
        + " "
        + _metrics(
            "walk",
            total_nodes="count(*)",
            max_depth="max(level_depth)",
            root_managers="count(*) FILTER (parent_account_id = root_account_id)",
        )
        + " UNION ALL "
        + _metrics(
            """(SELECT 1 FROM edge e JOIN nearest n
                ON n.root = e.child_account_id AND n.child = e.parent_account_id)""",
            edges_on_cycles="count(*)",
        )
        + " UNION ALL "
        + _metrics(
            """(SELECT 1 FROM walk w JOIN edge e ON e.parent_account_id = w.child_account_id
                WHERE w.level_depth = 12 AND NOT list_contains(w.path, e.child_account_id))""",
            beyond_max_depth="count(*)",
        )
    ),
    "hierarchy_levels": "SELECT level_depth, count(*) AS path_count FROM walk GROUP BY level_depth",
    "quality_segments": (
        _metrics("flagged", total_segments="count(*)")
        + " UNION ALL "
        + _metrics(
            "(SELECT 1 FROM flagged GROUP BY parent_account_id, entity_id HAVING count(*) > 1)",
            accounts_with_multiple_segments="count(*)",
        )
        + " UNION ALL "
        + _metrics(
            """(SELECT DISTINCT manager_account_id, entity_id, marketplace_id FROM (
                 SELECT *, max(effective_end_date) OVER (
                   PARTITION BY manager_account_id, entity_id, marketplace_id
                   ORDER BY effective_start_date
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
                 FROM best) WHERE before >= effective_start_date)""",
            overlapping_groups="count(*)",
        )
    ),
    "quality_fact": (
        _metrics(
            "final",
            total_records="count(*)",
            inverted_ranges="count(*) FILTER (effective_start_date > effective_end_date)",
        )
        + " UNION ALL "
        + _metrics(f"(SELECT 1 FROM final GROUP BY {_KEY} HAVING count(*) > 1)", duplicates="count(*)")
        + " UNION ALL "
        + _metrics(
            f"""(SELECT 1 FROM final GROUP BY {_KEY.replace('marketplace_id, ', '')}
                 HAVING count(*) > 1)""",
            duplicates_ignoring_marketplace="count(*)",
        )
    ),
    "pipeline_full": _fact("final"),
    "pipeline_literal": _fact("final"),
    "pipeline_variant": _fact("variant"),
    "pipeline_resumed": _fact("final"),
    "pipeline_half_open": _fact("half_open"),
    "pipeline_unmapped_partner": _fact("unmapped"),
    "fact_by_account": _fact("final"),
    "star_catalog": _fact("final"),
    "star_published": _fact("final"),
    "components": """, tie AS (
         SELECT parent_account_id AS a, child_account_id AS b FROM edge
         UNION SELECT child_account_id, parent_account_id FROM edge
       ),
       spread AS (
         SELECT DISTINCT a AS account_id, a AS label FROM tie
         UNION
         SELECT t.b, s.label FROM spread s JOIN tie t ON t.a = s.account_id WHERE s.label < t.b
       )
       SELECT account_id, min(label) AS component_id FROM spread GROUP BY account_id""",
    "cycles": """SELECT w.root_account_id, CAST(w.level_depth + 1 AS INTEGER) AS cycle_length,
       array_to_string(w.path, '/') || '/' || w.root_account_id AS path_trace
       FROM walk w JOIN edge e
         ON e.parent_account_id = w.child_account_id AND e.child_account_id = w.root_account_id
       WHERE w.level_depth < 12 AND w.root_account_id = list_min(w.path)""",
    "edges_on_cycles": f"""{_NEAREST}
       SELECT e.parent_account_id, e.child_account_id,
              CAST(n.level + 1 AS INTEGER) AS shortest_cycle
       FROM edge e JOIN nearest n
         ON n.root = e.child_account_id AND n.child = e.parent_account_id""",
    "shortest_levels": f"""{_NEAREST}
       SELECT root AS root_account_id, child AS child_account_id,
              CAST(level AS INTEGER) AS shortest_level FROM nearest""",
    "cycle_parts": f"""{_NEAREST}
       SELECT a.root AS account_id, greatest(a.root, max(a.child)) AS part_id
       FROM nearest a JOIN nearest b ON b.root = a.child AND b.child = a.root
       GROUP BY a.root""",
    "root_levels": """, root_level(account_id, level) USING KEY (account_id) AS (
         SELECT DISTINCT parent_account_id, 0 FROM edge
         WHERE parent_account_id NOT IN (SELECT child_account_id FROM edge)
         UNION
         SELECT e.child_account_id, min(r.level + 1)
         FROM root_level r JOIN edge e ON e.parent_account_id = r.account_id
         LEFT JOIN recurring.root_level k ON k.account_id = e.child_account_id
         WHERE k.account_id IS NULL
         GROUP BY e.child_account_id
       )
       SELECT account_id, CAST(level AS INTEGER) AS level FROM root_level""",
}


def statements() -> dict[str, str]:
    return {name: f"{_WITH}{'' if q.startswith(',') else ' '}{q}" for name, q in _QUERIES.items()}
