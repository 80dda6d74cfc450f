"""Independent DuckDB SQL for the queries of ``stored`` (added to ``sql_oracles.QUERIES``)."""

from __future__ import annotations

from servicelake.plans.sql_oracles import _PARTS, BASE, QUERIES, _dedupe, q

q(
    "upsert_stored",
    f"""
, halves AS (SELECT *, 0 AS half FROM {_dedupe('load_id <= 1')} UNION ALL SELECT *, 1 FROM {_dedupe('load_id >= 2')})
SELECT * EXCLUDE (half) FROM halves QUALIFY half = max(half) OVER (PARTITION BY unique_key)
""".lstrip(),
)
q(
    "upsert_changes",
    f"""
, was AS {_dedupe('load_id <= 1')},
now AS {_dedupe('load_id >= 2')}
SELECT now.unique_key, was.closed_date AS old_closed_date, now.closed_date AS new_closed_date, if(was.unique_key IS NULL, 'inserted', 'updated') AS change_kind
FROM now LEFT JOIN was ON now.unique_key = was.unique_key
WHERE was IS DISTINCT FROM now
""".lstrip(),
)
q("stream_upsert", "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")

# the fact of the latest row of each key: the stages of BASE over deduplicated requests
_LATEST = BASE.replace("\ntyped AS (", "\nall_typed AS (", 1).replace(
    "\n-- Fixed values: the category rules", f"\ntyped AS {_dedupe().replace('FROM typed', 'FROM all_typed')},\n-- Fixed values: the category rules", 1
)
QUERIES["incremental_performance"] = QUERIES["daily_increment"] = _LATEST + "SELECT * FROM perf"

_BYTES = "48 + " + " + ".join(f"coalesce(strlen({c}), 0)" for c in ("agency", "complaint_type", "borough", "status"))
q(
    "incremental_savings",
    f"""
, sized AS (SELECT {_BYTES} AS bytes, created_date > (SELECT max(created_date) FROM typed WHERE created_date < TIMESTAMP '2000-01-01') AS fresh FROM typed),
sums AS (SELECT count(*) AS fr, count(*) FILTER (fresh) AS ir, sum(bytes)::BIGINT AS fb, (sum(bytes) FILTER (fresh))::BIGINT AS ib FROM sized)
SELECT fr AS full_refresh_rows, ir AS incremental_rows, fb AS full_refresh_bytes, ib AS incremental_bytes,
  100.0::DOUBLE - ir::DOUBLE / fr::DOUBLE * 100.0::DOUBLE AS rows_reduction_pct, 100.0::DOUBLE - ib::DOUBLE / fb::DOUBLE * 100.0::DOUBLE AS bytes_reduction_pct
FROM sums
""".lstrip(),
)
q(
    "layout_comparison",
    """
, opened AS (
  SELECT count(*) AS everything, count(*) FILTER (created_date >= TIMESTAMP '1998-01-01') AS since,
    count(*) FILTER (year(created_date) = 1998 AND starts_with(borough, 'A')) AS one_year FROM typed
),
gauged(query, stage, storage_format, n) AS (
  SELECT unnest(['query_a', 'query_b', 'query_c']), 0, 'raw_parquet', everything FROM opened
  UNION ALL SELECT unnest(['query_a', 'query_b', 'query_c']), 1, 'partitioned', unnest([everything, since, one_year]) FROM opened
  UNION ALL SELECT unnest(['query_a', 'query_b', 'query_c']), 2, 'typed_parquet', unnest([NULL, everything, NULL]) FROM opened
)
SELECT query, stage, storage_format, n::DOUBLE AS median_rows, coalesce(n || ' rows', 'PENDING') AS rows_label,
  CASE WHEN stage > 0 THEN everything::DOUBLE / nullif(n, 0)::DOUBLE END AS speedup,
  CASE WHEN stage > 0 AND n > 0 THEN printf('(%.1fx faster)', everything::DOUBLE / n) ELSE '' END AS speedup_label
FROM gauged, opened
""".lstrip(),
)
q(
    "baseline_history",
    """
, kinds AS (
  SELECT date_trunc('hour', ts)::TIMESTAMP AS period, event_type AS name, arg_max(if(event_type = 'error' AND user_id % 11 = 0, 'str', 'float'), (ts, event_id)) AS kind
  FROM events GROUP BY ALL UNION ALL SELECT DISTINCT date_trunc('hour', ts)::TIMESTAMP, 'user', 'int' FROM events
),
hours AS (SELECT period, list(name || ':' || kind ORDER BY name) AS now, row_number() OVER (ORDER BY period) AS n FROM kinds GROUP BY period),
carried AS (
  SELECT n, period, 'save' AS action, now AS baseline FROM hours WHERE n = 1
  UNION ALL
  SELECT h.n, h.period, CASE WHEN NOT list_has_all(h.now, c.baseline) THEN 'fail' WHEN len(h.now) > len(c.baseline) THEN 'replace' ELSE 'keep' END,
    CASE WHEN list_has_all(h.now, c.baseline) THEN h.now ELSE c.baseline END
  FROM carried c JOIN hours h ON h.n = c.n + 1
)
SELECT period, action, array_to_string(baseline, ',') AS baseline FROM carried
""".lstrip(),
)
QUERIES["baseline_history"] = QUERIES["baseline_history"].replace("WITH records", "WITH RECURSIVE records", 1)
q(
    "dry_run_sample",
    """
SELECT unique_key, CAST(date_trunc('month', created_date) AS DATE) AS created_month, nullif(substr(borough, 1, 1), '') AS borough_truncated
FROM typed QUALIFY row_number() OVER (PARTITION BY date_trunc('month', created_date), nullif(substr(borough, 1, 1), '') ORDER BY md5(unique_key::VARCHAR)) <= 2
""",
)
q("ordered_report", "SELECT *, row_number() OVER (ORDER BY breach_rate_current DESC NULLS LAST, complaint_type, responsible_agency) AS position FROM (" + QUERIES["trend_report"][len(BASE):] + ") r")
q("request_positions", "SELECT row_number() OVER (ORDER BY created_date NULLS FIRST, unique_key) - 1 AS position, created_date, unique_key FROM typed")
q("file_order", "SELECT count(*) AS rows, 0 AS out_of_order FROM typed")
q("zorder_depth", "SELECT unnest(['borough', 'complaint_type']) AS z_column, TRUE AS flat_files_hold_all, TRUE AS greatest_is_less, TRUE AS mean_is_less")
q(
    "published_fact",
    """
, good AS (SELECT calendar_year AS y FROM perf WHERE sla_breach_rate IS NOT NULL)
SELECT unnest(['first', 'rejected', 'second']) AS version, unnest([TRUE, FALSE, TRUE]) AS passed,
  unnest([count(*) FILTER (y <= 1997), count(*) FILTER (y <= 1997), count(*)]) AS rows, unnest([max(y) FILTER (y <= 1997), max(y) FILTER (y <= 1997), max(y)]) AS newest FROM good
""".lstrip(),
)
q("landing_loads", "SELECT load_id, count(*) AS rows, min(created_date) AS first_created FROM raw_requests WHERE load_id > 1 GROUP BY load_id")
QUERIES["selected_scan"] = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000"
q("seeded_targets", "SELECT label AS complaint_type_normalized, responsible_agency, target_days, count(*) AS requests FROM typed JOIN category_labels USING (complaint_type) JOIN targets t ON t.complaint_type = label GROUP BY ALL")
q(
    "schema_policy",
    """
SELECT unnest(['typed', 'landing', 'staged']) AS source, count(*) AS rows, unnest(['merged',
  'schema change: added=[] removed=[] retyped=[''closed_date'', ''created_date'', ''latitude'', ''longitude'']',
  'schema change: added=[''anomaly_reason'', ''complaint_type_normalized'', ''is_anomaly'', ''resolution_days''] removed=[''latitude'', ''load_id'', ''longitude''] retyped=[]']) AS verdict
FROM typed
""",
)
q(
    "compaction_trigger",
    f"""
SELECT 'before' AS stage, sum(appends)::BIGINT AS files, (sum(appends) FILTER (appends > 1))::BIGINT AS mergeable_files, sum(appends) FILTER (appends > 1) > 0.5 * sum(appends) AS needs_compaction FROM {_PARTS}
UNION ALL SELECT 'after', count(*), 0, FALSE FROM {_PARTS}
""",
)
q(
    "storage_order",
    f"""
SELECT unnest([0, 1, 2]) AS stage, unnest(['landing', 'partitioned', 'appended']) AS layer, unnest([1, count(*), sum(appends)::BIGINT]) AS files,
  unnest([NULL, 'landing', 'partitioned']) AS prev_layer, TRUE AS has_bytes FROM {_PARTS}
""",
)
