"""Independent DuckDB SQL for every registered query (the correctness oracle).

The driver registers the test tables as views and runs these strings next to
the Spark DataFrame plans.  ``BASE`` rebuilds the service-request stages in
plain SQL; each query appends its final SELECT.
"""

from __future__ import annotations

# Stage CTEs shared by the oracle queries.
BASE = r"""
WITH records AS (
  SELECT l.*, o.o_orderdate, c.c_mktsegment, r.r_name, p.p_type,
    l.l_orderkey * 10 + l.l_linenumber AS unique_key, (l.l_orderkey * 10 + l.l_linenumber) % 29 AS kind
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
rule_texts(kind, words) AS (VALUES
  (0, ' Noise - Residential '), (1, 'noise / RESIDENTIAL (loud)'), (2, 'Heat request'), (3, 'no HOT WATER'),
  (4, 'Unsanitary Condition'), (5, 'illegal parking'), (6, 'Water Leak'), (7, 'rodent sighting'),
  (8, 'Street Condition'), (9, 'Sidewalk Condition'), (10, 'street condition '), (11, 'Broken Parking Meter')
),
raw_requests AS (
  SELECT
    unique_key,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS created_date,
    CASE WHEN l_linestatus <> 'F' THEN NULL WHEN unique_key % 101 = 0 THEN 'n/a'
         ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%g') END AS closed_date,
    CASE WHEN kind = 19 THEN ' ' || c_mktsegment || '  ' ELSE c_mktsegment END AS agency,
    coalesce(t.words, CASE WHEN kind < 16 THEN p_type || ' ' || l_partkey % 4 WHEN kind = 16 THEN '  ' || lower(p_type) || ' ' ELSE p_type END) AS complaint_type,
    CASE WHEN l_quantity < 2 THEN NULL WHEN unique_key % 331 = 0 THEN '   ' WHEN kind = 18 THEN ' ' || lower(r_name) ELSE r_name END AS borough,
    l_linestatus AS status,
    CASE WHEN l_tax = 0 THEN NULL WHEN unique_key % 53 = 0 THEN 'unknown' ELSE CAST(l_tax AS VARCHAR) END AS latitude,
    CASE WHEN l_tax = 0 THEN NULL ELSE CAST(l_discount AS VARCHAR) END AS longitude,
    CAST(l_suppkey % 4 AS INTEGER) AS load_id
  FROM records LEFT JOIN rule_texts t USING (kind)
),
typed AS (
  SELECT
    unique_key,
    try_strptime(created_date, '%Y-%m-%dT%H:%M:%S.%g') AS created_date,
    try_strptime(closed_date, '%Y-%m-%dT%H:%M:%S.%g') AS closed_date,
    trim(agency) AS agency,
    trim(complaint_type) AS complaint_type,
    upper(trim(borough)) AS borough,
    trim(status) AS status,
    TRY_CAST(latitude AS DOUBLE) AS latitude,
    TRY_CAST(longitude AS DOUBLE) AS longitude,
    load_id
  FROM raw_requests
),
-- Fixed values: the category rules by priority (a pattern over lower-case text, or an exact text), and the anomaly reasons
category_rules(priority, pattern, exact, label) AS (VALUES
  (1, '%noise%residential%', NULL, 'NOISE - RESIDENTIAL'),
  (2, '%heat%', NULL, 'HEAT/HOT WATER'),
  (2, '%hot water%', NULL, 'HEAT/HOT WATER'),
  (3, '%unsanitary%', NULL, 'UNSANITARY CONDITION'),
  (4, '%illegal parking%', NULL, 'ILLEGAL PARKING'),
  (5, '%water leak%', NULL, 'WATER LEAK'),
  (6, '%rodent%', NULL, 'RODENT'),
  (7, NULL, 'Street Condition', 'STREET CONDITION'),
  (8, NULL, 'Sidewalk Condition', 'SIDEWALK CONDITION'),
  (9, '%broken parking meter%', NULL, 'BROKEN MUNI METER')
),
reasons(priority, reason) AS (VALUES
  (1, 'retroactively merged case'), (2, 'abandoned case never properly closed'), (3, 'missing borough value')
),
category_labels AS (
  SELECT c.complaint_type, coalesce(arg_min(k.label, k.priority), upper(trim(c.complaint_type))) AS label
  FROM (SELECT DISTINCT complaint_type FROM typed) c
  LEFT JOIN category_rules k ON lower(c.complaint_type) LIKE k.pattern OR c.complaint_type = k.exact
  GROUP BY c.complaint_type
),
measured AS (
  SELECT *, CAST(closed_date AS DATE) - CAST(created_date AS DATE) AS days,
    list_min(list_filter([
      if(closed_date < created_date, 1, NULL),
      if(CAST(closed_date AS DATE) - CAST(created_date AS DATE) > 730, 2, NULL),
      if(coalesce(trim(borough), '') = '', 3, NULL)], lambda x: x IS NOT NULL)) AS cause
  FROM typed
),
staged AS (
  SELECT m.unique_key, m.created_date, m.closed_date, m.borough, m.complaint_type, m.agency, m.status,
    l.label AS complaint_type_normalized, m.days AS resolution_days, m.cause IS NOT NULL AS is_anomaly, r.reason AS anomaly_reason
  FROM measured m
  LEFT JOIN category_labels l ON l.complaint_type IS NOT DISTINCT FROM m.complaint_type
  LEFT JOIN reasons r ON r.priority = m.cause
),
targets(complaint_type, responsible_agency, target_days) AS (VALUES
  ('STANDARD', 'HOUSEHOLD', 200), ('ECONOMY', 'BUILDING', 400), ('MEDIUM', 'BUILDING', 30), ('SMALL', 'MACHINERY', 600),
  ('LARGE', 'FURNITURE', 100), ('NOISE - RESIDENTIAL', 'POLICE', 1), ('HEAT/HOT WATER', 'HOUSING', 30),
  ('UNSANITARY CONDITION', 'HOUSING', 60), ('ILLEGAL PARKING', 'POLICE', 1), ('WATER LEAK', 'HOUSING', 14),
  ('RODENT', 'HEALTH', 45), ('STREET CONDITION', 'STREETS', 90), ('SIDEWALK CONDITION', 'STREETS', 120),
  ('BROKEN MUNI METER', 'STREETS', 7)
),
enriched AS (
  SELECT * EXCLUDE (late), NOT late AS is_within_sla, late AS is_sla_breach,
    greatest(resolution_days, target_days) - target_days + 0 * resolution_days AS days_over_sla, year(created_date) AS calendar_year
  FROM (
    SELECT r.unique_key, r.created_date, r.closed_date, r.borough, r.complaint_type_normalized, r.resolution_days,
      r.is_anomaly, r.anomaly_reason, s.responsible_agency, s.target_days,
      if(r.anomaly_reason IS NULL, r.resolution_days > s.target_days, NULL) AS late
    FROM staged r, targets s WHERE s.complaint_type = r.complaint_type_normalized
  )
),
perf AS (
  SELECT
    complaint_type_normalized AS complaint_type,
    responsible_agency,
    calendar_year,
    target_days,
    COUNT(*) AS total_requests,
    COUNT(*) FILTER (WHERE closed_date IS NOT NULL) AS closed_requests,
    COUNT(*) FILTER (WHERE is_sla_breach) AS sla_breach_count,
    (COUNT(*) FILTER (WHERE is_sla_breach))::DOUBLE
      / NULLIF(COUNT(*) FILTER (WHERE closed_date IS NOT NULL), 0) AS sla_breach_rate,
    AVG(CASE WHEN NOT is_anomaly THEN resolution_days END) AS avg_resolution_days,
    round(quantile_cont(CASE WHEN NOT is_anomaly THEN resolution_days END, 0.5), 6) AS p50_resolution_days,
    round(quantile_cont(CASE WHEN NOT is_anomaly THEN resolution_days END, 0.9), 6) AS p90_resolution_days
  FROM enriched
  GROUP BY 1, 2, 3, 4
),
dated AS (SELECT *, max(calendar_year) FILTER (WHERE calendar_year <= 2000) OVER () - calendar_year AS years_back FROM perf),
placed AS (
  SELECT *, row_number() OVER (ORDER BY sla_breach_rate DESC NULLS LAST, complaint_type, responsible_agency) AS place
  FROM dated WHERE years_back = 0
),
top_current AS (SELECT complaint_type, responsible_agency, calendar_year, sla_breach_rate, place FROM placed WHERE place <= 10),
trend_rows AS (
  SELECT *, CASE sign(breach_rate_current - breach_rate_y_minus_4) WHEN -1 THEN 'improving' WHEN 1 THEN 'worsening' ELSE 'stable' END AS trend_direction
  FROM (
    SELECT complaint_type, responsible_agency, target_days,
      max(sla_breach_rate) FILTER (WHERE years_back = 4) AS breach_rate_y_minus_4,
      max(sla_breach_rate) FILTER (WHERE years_back = 3) AS breach_rate_y_minus_3,
      max(sla_breach_rate) FILTER (WHERE years_back = 2) AS breach_rate_y_minus_2,
      max(sla_breach_rate) FILTER (WHERE years_back = 1) AS breach_rate_y_minus_1,
      max(sla_breach_rate) FILTER (WHERE years_back = 0) AS breach_rate_current
    FROM dated SEMI JOIN top_current USING (complaint_type, responsible_agency)
    WHERE years_back <= 4 GROUP BY ALL
  )
)
"""

QUERIES: dict[str, str] = {}


def q(name: str, body: str) -> None:
    QUERIES[name] = BASE + body


q("typed_requests", "SELECT * FROM typed")

q("staged_requests", "SELECT * FROM staged")

q(
    "normalized_category",
    """
SELECT complaint_type, complaint_type_normalized, COUNT(*) AS requests
FROM staged GROUP BY 1, 2
""",
)

q(
    "anomaly_flags",
    """
SELECT is_anomaly, anomaly_reason, COUNT(*) AS requests,
       MIN(resolution_days) AS min_resolution_days, MAX(resolution_days) AS max_resolution_days
FROM staged GROUP BY 1, 2
""",
)

q(
    "coordinate_nulls",
    """
SELECT COUNT(*) AS total_rows,
       COUNT(*) FILTER (WHERE latitude IS NULL) AS null_coordinates,
       100.0 * (COUNT(*) FILTER (WHERE latitude IS NULL)) / NULLIF(COUNT(*), 0) AS null_pct
FROM typed
""",
)

q("sla_enriched", "SELECT * FROM enriched")

q("sla_performance", "SELECT * FROM perf")

q("sla_trends", "SELECT * FROM trend_rows")

_RATES = ["breach_rate_y_minus_4", "breach_rate_y_minus_3", "breach_rate_y_minus_2", "breach_rate_y_minus_1", "breach_rate_current"]
_PCTS = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN printf('%.1f', {c} * 100) || '%' END AS {c}_pct" for c in _RATES)
q(
    "trend_report",
    f"""
SELECT complaint_type, responsible_agency, {", ".join(_RATES)}, {_PCTS}, upper(trend_direction) AS trend
FROM trend_rows
""",
)

q("top_breach", "SELECT * EXCLUDE (place), place - 1 AS position FROM top_current")

q(
    "agency_year_breach",
    """
SELECT responsible_agency, calendar_year,
       CAST(SUM(total_requests) AS BIGINT) AS total_requests,
       CAST(SUM(closed_requests) AS BIGINT) AS closed_requests,
       CAST(SUM(sla_breach_count) AS BIGINT) AS sla_breach_count,
       SUM(sla_breach_count)::DOUBLE / NULLIF(SUM(closed_requests), 0) AS sla_breach_rate
FROM perf GROUP BY 1, 2
""",
)

q(
    "borough_compare",
    """
SELECT complaint_type_normalized AS complaint_type, borough, calendar_year,
       COUNT(*) AS total_requests,
       COUNT(*) FILTER (WHERE closed_date IS NOT NULL) AS closed_requests,
       COUNT(*) FILTER (WHERE is_sla_breach) AS sla_breach_count,
       (COUNT(*) FILTER (WHERE is_sla_breach))::DOUBLE
         / NULLIF(COUNT(*) FILTER (WHERE closed_date IS NOT NULL), 0) AS sla_breach_rate
FROM enriched GROUP BY 1, 2, 3
""",
)

# --- keys / paging -------------------------------------------------------------

DEDUPE_ORDER_SQL = (
    "closed_date DESC NULLS LAST, created_date DESC NULLS LAST, agency DESC NULLS LAST, "
    "complaint_type DESC NULLS LAST, borough DESC NULLS LAST, status DESC NULLS LAST, "
    "latitude DESC NULLS LAST, longitude DESC NULLS LAST, load_id DESC NULLS LAST"
)


def _dedupe(where: str = "TRUE") -> str:
    return f"""(
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY unique_key ORDER BY {DEDUPE_ORDER_SQL}) AS _rn
    FROM typed WHERE {where}
  ) WHERE _rn = 1
)"""


PAGE_SQL = """(
  SELECT * FROM events
  WHERE ts > TIMESTAMP '2024-01-10 00:00:00' OR (ts = TIMESTAMP '2024-01-10 00:00:00' AND event_id > 5000)
  ORDER BY ts, event_id LIMIT 1000
)"""

q(
    "window_slice",
    "SELECT * FROM typed WHERE created_date >= TIMESTAMP '1997-01-01' AND created_date < TIMESTAMP '1998-01-01'",
)
q("keyset_page", f"SELECT * FROM {PAGE_SQL}")
q("page_cursor", f"SELECT ts, event_id FROM {PAGE_SQL} p ORDER BY ts DESC, event_id DESC LIMIT 1")
q(
    "page_summary",
    """
SELECT year(created_date) AS year, COUNT(*) AS rows, CAST(ceil(COUNT(*) / 1000.0) AS BIGINT) AS pages
FROM typed GROUP BY 1
""",
)
q(
    "pending_chunks",
    """
, chunks AS (SELECT DISTINCT year(created_date) AS year FROM typed),
ledger AS (
  SELECT DISTINCT year(created_date) AS year FROM typed
  WHERE year(created_date) < (SELECT max(year(created_date)) FROM typed)
)
SELECT c.year FROM chunks c WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.year = c.year)
""".replace("\n, chunks", ", chunks", 1),
)
q("dedupe_latest", f"SELECT * FROM {_dedupe()}")
q("as_of_load", f"SELECT * FROM {_dedupe('load_id <= 1')}")

# --- incremental / merge -----------------------------------------------------

q(
    "incremental_select",
    """
SELECT * FROM typed
WHERE created_date > (SELECT max(created_date) FROM typed WHERE created_date < TIMESTAMP '2000-01-01')
""",
)
q(
    "upsert_requests",
    f"""
, t AS {_dedupe('load_id <= 1')},
s AS {_dedupe('load_id >= 2')}
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.unique_key = t.unique_key)
UNION ALL
SELECT * FROM s
""".replace("\n, t AS", ", t AS", 1),
)
q(
    "changed_rows",
    f"""
, o AS {_dedupe('load_id <= 1')},
n AS {_dedupe()}
SELECT n.*,
  CASE WHEN o.unique_key IS NULL THEN 'inserted' ELSE 'updated' END AS change_kind
FROM n LEFT JOIN o ON n.unique_key = o.unique_key
WHERE o.unique_key IS NULL
   OR n.created_date IS DISTINCT FROM o.created_date
   OR n.closed_date IS DISTINCT FROM o.closed_date
   OR n.status IS DISTINCT FROM o.status
""".replace("\n, o AS", ", o AS", 1),
)

# --- quality -------------------------------------------------------------------

_FIX_BOROUGHS = "('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')"
_REF_BOROUGHS = "('BRONX', 'BROOKLYN', 'MANHATTAN', 'QUEENS', 'STATEN ISLAND', 'UNSPECIFIED')"


def _row(check, table, metric, threshold, severity, passed, src):
    return (
        f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", CAST({metric} AS DOUBLE) AS metric, "
        f"'{threshold}' AS threshold, '{severity}' AS severity, {passed} AS passed FROM {src}"
    )


_checks = [
    _row("Minimum row count check", "stg_requests", "COUNT(*)", "> 1000", "error", "COUNT(*) > 1000", "staged"),
    _row("No missing primary keys", "stg_requests", "COUNT(*) FILTER (WHERE unique_key IS NULL)", "= 0", "error",
         "COUNT(*) FILTER (WHERE unique_key IS NULL) = 0", "staged"),
    _row("No missing created dates", "stg_requests", "COUNT(*) FILTER (WHERE created_date IS NULL)", "= 0", "error",
         "COUNT(*) FILTER (WHERE created_date IS NULL) = 0", "staged"),
    _row("Borough values mostly valid", "stg_requests",
         f"100.0::DOUBLE * COUNT(*) FILTER (WHERE borough IS NOT NULL AND borough NOT IN {_FIX_BOROUGHS}) / NULLIF(COUNT(*), 0)",
         "< 1%", "error",
         f"coalesce(100.0::DOUBLE * COUNT(*) FILTER (WHERE borough IS NOT NULL AND borough NOT IN {_FIX_BOROUGHS}) / NULLIF(COUNT(*), 0) < 1.0, TRUE)",
         "staged"),
    _row("Data freshness check", "stg_requests",
         "date_diff('second', max(created_date), TIMESTAMP '2001-08-31 00:00:00') / 86400.0", "< 30d", "error",
         "coalesce(date_diff('second', max(created_date), TIMESTAMP '2001-08-31 00:00:00') / 86400.0 < 30.0, FALSE)",
         "staged"),
    _row("borough accepted values", "stg_requests",
         f"COUNT(*) FILTER (WHERE borough IS NOT NULL AND borough NOT IN {_FIX_BOROUGHS})", "= 0", "warn",
         f"COUNT(*) FILTER (WHERE borough IS NOT NULL AND borough NOT IN {_FIX_BOROUGHS}) = 0", "staged"),
    _row("resolution_days between", "stg_requests",
         "COUNT(*) FILTER (WHERE resolution_days IS NOT NULL AND (resolution_days < -365 OR resolution_days > 3650))",
         "= 0", "warn",
         "COUNT(*) FILTER (WHERE resolution_days IS NOT NULL AND (resolution_days < -365 OR resolution_days > 3650)) = 0",
         "staged"),
    _row("unique_key unique", "stg_requests", "COUNT(*)", "= 0", "error", "COUNT(*) = 0",
         "(SELECT unique_key FROM staged WHERE unique_key IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"),
    _row("Minimum aggregated rows", "fct_sla_performance", "COUNT(*)", "> 20", "error", "COUNT(*) > 20", "perf"),
    _row("No missing breach rates", "fct_sla_performance", "COUNT(*) FILTER (WHERE sla_breach_rate IS NULL)", "= 0",
         "error", "COUNT(*) FILTER (WHERE sla_breach_rate IS NULL) = 0", "perf"),
    _row("Breach rate bounds check", "fct_sla_performance",
         "100.0::DOUBLE * COUNT(*) FILTER (WHERE sla_breach_rate IS NOT NULL AND (sla_breach_rate < 0 OR sla_breach_rate > 1)) / NULLIF(COUNT(*), 0)",
         "< 5%", "error",
         "coalesce(100.0::DOUBLE * COUNT(*) FILTER (WHERE sla_breach_rate IS NOT NULL AND (sla_breach_rate < 0 OR sla_breach_rate > 1)) / NULLIF(COUNT(*), 0) < 5.0, TRUE)",
         "perf"),
    _row("complaint_type not null", "sla_targets", "COUNT(*) FILTER (WHERE complaint_type IS NULL)", "= 0", "error",
         "COUNT(*) FILTER (WHERE complaint_type IS NULL) = 0", "targets"),
    _row("target_days not null", "sla_targets", "COUNT(*) FILTER (WHERE target_days IS NULL)", "= 0", "error",
         "COUNT(*) FILTER (WHERE target_days IS NULL) = 0", "targets"),
    _row("complaint_type unique", "sla_targets", "COUNT(*)", "= 0", "error", "COUNT(*) = 0",
         "(SELECT complaint_type FROM targets WHERE complaint_type IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"),
]
_checks += [
    _row("unique_key not null", "silver_requests", "COUNT(*) FILTER (WHERE unique_key IS NULL)", "= 0", "error", "COUNT(*) FILTER (WHERE unique_key IS NULL) = 0", "typed"),
    _row("created_date not null", "silver_requests", "COUNT(*) FILTER (WHERE created_date IS NULL)", "= 0", "error", "COUNT(*) FILTER (WHERE created_date IS NULL) = 0", "typed"),
    _row("borough accepted values", "silver_requests", f"COUNT(*) FILTER (WHERE borough NOT IN {_FIX_BOROUGHS})", "= 0", "warn", f"COUNT(*) FILTER (WHERE borough NOT IN {_FIX_BOROUGHS}) = 0", "typed"),
    _row("unique_key unique", "silver_requests", "COUNT(*)", "= 0", "warn", "COUNT(*) = 0", "(SELECT unique_key FROM typed GROUP BY 1 HAVING COUNT(*) > 1)"),
    _row("breach_rate_current not null", "fct_sla_trends", "COUNT(*) FILTER (WHERE breach_rate_current IS NULL)", "= 0", "error", "COUNT(*) FILTER (WHERE breach_rate_current IS NULL) = 0", "trend_rows"),
]
q("quality_results", "\n" + "\nUNION ALL\n".join(_checks))

q(
    "duplicate_keys",
    "SELECT unique_key, COUNT(*) AS copies FROM staged WHERE unique_key IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1",
)
q(
    "invalid_values",
    f"SELECT borough, COUNT(*) AS rows FROM staged WHERE borough IS NOT NULL AND borough NOT IN {_REF_BOROUGHS} GROUP BY 1",
)
q(
    "freshness",
    """
SELECT max(created_date) AS newest, TIMESTAMP '2001-08-31 00:00:00' AS as_of,
  date_diff('second', max(created_date), TIMESTAMP '2001-08-31 00:00:00') / 86400.0 AS age_days,
  coalesce(date_diff('second', max(created_date), TIMESTAMP '2001-08-31 00:00:00') / 86400.0 < 30.0, FALSE) AS passed
FROM staged
""",
)

# --- schema drift --------------------------------------------------------------

_PY_TYPE = """CASE jt
    WHEN 'NULL' THEN 'NoneType' WHEN 'BOOLEAN' THEN 'bool' WHEN 'VARCHAR' THEN 'str'
    WHEN 'BIGINT' THEN 'int' WHEN 'UBIGINT' THEN 'int' WHEN 'HUGEINT' THEN 'int'
    WHEN 'DOUBLE' THEN 'float' WHEN 'ARRAY' THEN 'list' WHEN 'OBJECT' THEN 'dict'
    ELSE lower(jt) END"""


def _key_types(src: str, json_col: str, order: list[str]) -> str:
    """First non-null JSON type per key, records ordered newest first."""
    order_by = ", ".join(f"{c} DESC" for c in order)
    return f"""(
  SELECT column_name,
    coalesce(
      (array_agg(t ORDER BY {order_by}) FILTER (WHERE t <> 'NoneType'))[1],
      'NoneType') AS type_name
  FROM (
    SELECT {", ".join(order)}, k AS column_name,
      {_PY_TYPE.replace("jt", "json_type(" + json_col + ", '$.\"' || k || '\"')")} AS t
    FROM {src}, unnest(json_keys({json_col})) AS u(k)
    WHERE NOT starts_with(k, ':')
  ) GROUP BY column_name
)"""


q("json_key_types", f"SELECT * FROM {_key_types('events', 'props', ['ts', 'event_id'])}")

_RAW_JSON = """(SELECT unique_key, load_id, to_json(r) AS record FROM (
    SELECT * EXCLUDE (status), unique_key AS ":id", 'code ' || load_id AS legacy_code FROM raw_requests) r)"""
_TYPED_JSON = """(SELECT unique_key, load_id, to_json(r) AS record FROM (SELECT *, TRUE AS ":updated" FROM typed) r)"""
_DIFF = f"""(
  SELECT coalesce(o.column_name, n.column_name) AS column_name, o.type_name AS old_type, n.type_name AS new_type,
    CASE WHEN n.type_name IS NULL THEN 'removed' WHEN o.type_name IS NULL THEN 'added'
         WHEN o.type_name <> n.type_name THEN 'type_changed' END AS change
  FROM {_key_types(_RAW_JSON, 'record', ['unique_key', 'load_id'])} o
  FULL OUTER JOIN {_key_types(_TYPED_JSON, 'record', ['unique_key', 'load_id'])} n
    ON o.column_name = n.column_name
)"""
q("schema_diff", f"SELECT * FROM {_DIFF} d WHERE change IS NOT NULL")
q(
    "drift_verdict",
    f"""
, d AS (SELECT * FROM {_DIFF} x WHERE change IS NOT NULL),
lists AS (
  SELECT
    coalesce(list_sort(list(column_name) FILTER (WHERE change = 'removed')), []) AS removed,
    coalesce(list_sort(list(column_name) FILTER (WHERE change = 'added')), []) AS added,
    coalesce(list_sort(list(column_name || ': ' || old_type || ' -> ' || new_type) FILTER (WHERE change = 'type_changed')), []) AS retyped
  FROM d
)
SELECT
  len(removed) > 0 OR len(retyped) > 0 AS is_breaking,
  CASE
    WHEN len(removed) > 0 OR len(retyped) > 0 THEN array_to_string(list_filter([
        CASE WHEN len(removed) > 0 THEN 'columns removed: [' || array_to_string(list_transform(removed, lambda x: '''' || x || ''''), ', ') || ']' END,
        CASE WHEN len(retyped) > 0 THEN 'type changes: ' || array_to_string(retyped, ', ') END
      ], lambda x: x IS NOT NULL), '; ')
    WHEN len(added) > 0 THEN 'new optional columns added: [' || array_to_string(list_transform(added, lambda x: '''' || x || ''''), ', ') || ']'
    ELSE 'no schema changes detected'
  END AS description,
  removed, added, retyped
FROM lists
""".replace("\n, d AS", ", d AS", 1),
)

# --- benchmark queries -----------------------------------------------------------

q(
    "bench_a",
    """
SELECT complaint_type, COUNT(*) AS volume,
  AVG(datediff('day', CAST(created_date AS DATE), CAST(closed_date AS DATE))) AS avg_resolution_days
FROM typed WHERE closed_date IS NOT NULL
GROUP BY complaint_type QUALIFY row_number() OVER (ORDER BY volume DESC, complaint_type) <= 20
""".replace("AS volume,", "AS volume, row_number() OVER (ORDER BY COUNT(*) DESC, complaint_type) - 1 AS position,"),
)
q(
    "bench_b",
    """
SELECT CAST(date_trunc('month', CAST(created_date AS DATE)) AS DATE) AS month, borough, COUNT(*) AS requests
FROM typed WHERE created_date >= TIMESTAMP '1998-01-01' GROUP BY 1, 2
""",
)
q(
    "bench_c",
    """
SELECT * FROM typed
WHERE borough = 'ASIA' AND complaint_type = 'ECONOMY'
  AND created_date >= TIMESTAMP '1998-01-01' AND created_date < TIMESTAMP '1999-01-01'
""",
)
q(
    "bench_a_raw",
    """
SELECT complaint_type, COUNT(*) AS volume,
  AVG(datediff('day', TRY_CAST(created_date AS DATE), TRY_CAST(closed_date AS DATE))) AS avg_resolution_days
FROM raw_requests WHERE closed_date IS NOT NULL
GROUP BY complaint_type ORDER BY volume DESC, complaint_type LIMIT 20
""",
)
q(
    "bench_b_raw",
    """
SELECT CAST(date_trunc('month', TRY_CAST(created_date AS DATE)) AS DATE) AS month, borough, COUNT(*) AS requests
FROM raw_requests WHERE TRY_CAST(created_date AS DATE) >= DATE '1998-01-01' GROUP BY 1, 2
""",
)
q(
    "bench_c_raw",
    """
SELECT * FROM raw_requests
WHERE borough = 'ASIA' AND complaint_type = 'ECONOMY'
  AND TRY_CAST(created_date AS DATE) >= DATE '1998-01-01' AND TRY_CAST(created_date AS DATE) < DATE '1999-01-01'
""",
)

# --- layouts (content read back from the written files) -----------------------

q(
    "partition_rows",
    """
SELECT CAST(date_trunc('month', created_date) AS DATE) AS created_month,
  nullif(substr(borough, 1, 1), '') AS borough_truncated, COUNT(*) AS rows
FROM typed GROUP BY 1, 2
""",
)
q("partitioned_bench_c", QUERIES["bench_c"][len(BASE):])
q("zorder_content", "SELECT * FROM typed")

# --- verification --------------------------------------------------------------

q(
    "validate_only",
    """
SELECT COUNT(*) AS total_rows,
  COUNT(*) FILTER (WHERE latitude IS NULL) AS null_coordinates,
  100.0::DOUBLE * (COUNT(*) FILTER (WHERE latitude IS NULL)) / NULLIF(COUNT(*), 0) AS null_pct,
  10 AS columns
FROM typed
""",
)
q(
    "coordinate_disagreement",
    f"""
, p AS {_dedupe()},
c AS {_dedupe('load_id <= 1')}
SELECT COUNT(*) AS parent_rows,
  COUNT(c.unique_key) AS matched_rows,
  COUNT(*) FILTER (WHERE c.unique_key IS NOT NULL AND p.latitude IS NOT NULL AND c.latitude IS NOT NULL
                   AND p.longitude IS NOT NULL AND c.longitude IS NOT NULL) AS compared_rows,
  COUNT(*) FILTER (WHERE c.unique_key IS NOT NULL AND p.latitude IS NOT NULL AND c.latitude IS NOT NULL
                   AND p.longitude IS NOT NULL AND c.longitude IS NOT NULL
                   AND (p.latitude <> c.latitude OR p.longitude <> c.longitude)) AS disagreements
FROM p LEFT JOIN c ON p.unique_key = c.unique_key
""".replace("\n, p AS", ", p AS", 1),
)

# --- streaming -----------------------------------------------------------------

q("ingest_available", "SELECT * FROM events")

# --- further inventory items ---------------------------------------------------

q(
    "backfill_window",
    "SELECT * FROM typed WHERE created_date >= TIMESTAMP '1999-01-01' AND created_date < TIMESTAMP '1999-07-01'",
)
q(
    "newest_key_types",
    "SELECT * FROM "
    + _key_types("(SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 100)", "props", ["ts", "event_id"]),
)
q("raw_row_count", "SELECT COUNT(*) AS total_rows FROM raw_requests")
q("reader_parity", "SELECT COUNT(*) AS left_rows, COUNT(*) AS right_rows, TRUE AS equal FROM typed")
q("failed_checks", "SELECT * FROM (" + QUERIES["quality_results"][len(BASE):] + ") r WHERE NOT passed")

# --- files (a layout of this size holds one file for each partition) -----------

_PARTS = """(SELECT CAST(date_trunc('month', created_date) AS DATE) AS created_month, substr(borough, 1, 1) AS borough_truncated, COUNT(*) AS rows,
  min(whole) AS borough_min, max(whole) AS borough_max, min(created_date) AS created_date_min, max(created_date) AS created_date_max,
  COUNT(DISTINCT load_id >= 2) AS appends FROM (SELECT * EXCLUDE (borough), borough AS whole, nullif(borough, '') AS borough FROM typed) GROUP BY 1, 2)"""
q("partition_file_counts", f"SELECT created_month, borough_truncated, 1 AS files, rows FROM {_PARTS}")
q("file_index", f"SELECT created_month, borough_truncated, rows, created_date_min, created_date_max FROM {_PARTS}")
q(
    "skip_report",
    f"""
SELECT COUNT(*) AS total_files, COUNT(*) FILTER (WHERE 'ASIA' BETWEEN borough_min AND borough_max) AS candidate_files,
  100.0::DOUBLE * (COUNT(*) - COUNT(*) FILTER (WHERE 'ASIA' BETWEEN borough_min AND borough_max)) / COUNT(*) AS skip_pct,
  100.0::DOUBLE * (COUNT(*) - COUNT(*) FILTER (WHERE 'ASIA' BETWEEN borough_min AND borough_max)) / COUNT(*) > 50 AS passed
FROM {_PARTS}
""",
)
q("compaction_needed", f"SELECT COUNT(*) AS files, 0 AS mergeable_files, FALSE AS needs_compaction FROM {_PARTS}")
q("compaction_report", f"SELECT unnest(['before', 'after']) AS stage, COUNT(*) AS files FROM {_PARTS}")
q(
    "partition_compaction_report",
    f"SELECT unnest(['before', 'after']) AS stage, unnest([SUM(appends)::BIGINT, COUNT(*)]) AS files FROM {_PARTS}",
)
q("layer_parity", "SELECT COUNT(*) AS left_rows, COUNT(*) AS right_rows, TRUE AS equal FROM typed")
