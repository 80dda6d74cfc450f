"""Registered queries over stored tables that grow by increments (added to ``registry.REGISTRY``).

Each writes what it needs under the shared folder and derives it from the given tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servicelake.operators import benchmarks, drift, increments, keyed, layout, merge, numbering, quality, run_metrics, sla
from servicelake.plans import gold
from servicelake.plans.increment import IncrementConfig, run_increment
from servicelake.plans.publish import publish
from servicelake.plans import registry
from servicelake.plans.registry import B_SINCE, C_BOROUGH, C_END, C_START, DEDUPE_ORDER, TYPED_COLUMNS, _partitioned, _raw, _stored_performance, _typed, _typed_once, _typed_path, register
from servicelake.session import materialize, shared_path, split_session
from servicelake.sources.fixtures import FIXTURE_YEAR_CAP, fixture_targets, raw_requests, table
from servicelake.sources.tables import load_targets, read_raw, read_table, register_view
from servicelake.streaming import upsert as streams

LOADS = range(4)

ANY_ROWS = [quality.Check("any rows", "row_count_gt", None, 0)]

#: Rows of a keyed table's bucket: what a task of a merge sorts.
BUCKET_ROWS = 500_000


def _dealt(rows: DataFrame) -> dict[str, int]:
    """Few slots, as every merge here touches them all, and buckets that follow the rows (of a stored table: counted from footers)."""
    return {"slots": 4, "buckets": max(4, -(-rows.count() // BUCKET_ROWS))}


def _once(name: str, write: Callable[[SparkSession, str, str], None]) -> Callable[[SparkSession, str], str]:
    """The path of a table that several queries read, written once for each session and folder."""

    def path_of(spark: SparkSession, sf_dir: str) -> str:
        def write_new(spark: SparkSession, sf_dir: str) -> str:
            path = shared_path(spark, "stored", name)
            write(spark, sf_dir, path)
            return path

        return registry._once(name, spark, sf_dir, write_new)

    return path_of


def _append_twice(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Two appends leave two files in most partitions."""
    typed = _typed(spark, sf_dir)
    for loads in ("load_id <= 1", "load_id >= 2"):
        layout.write_partitioned(typed.where(loads), path, mode="append")


_appended = _once("appended", _append_twice)


def _requests_table(spark, typed) -> keyed.KeyedTable:
    """A table dealt for all of ``typed`` with its first half of the loads."""
    return keyed.create(spark, shared_path(spark, "stored", "requests"), typed.where("load_id <= 1"), ["unique_key"], DEDUPE_ORDER, **_dealt(typed))


@register("upsert_stored")
def upsert_stored(spark, sf_dir):
    """M2: a stored table after the merge of a second half of the loads."""
    typed = _typed_once(spark, sf_dir)
    requests = _requests_table(spark, typed)
    requests.merge(typed.where("load_id >= 2"), "second half")
    return requests.read()


@register("upsert_changes")
def upsert_changes(spark, sf_dir):
    """M2/M6: what that merge changed."""
    typed = _typed_once(spark, sf_dir)
    requests = _requests_table(spark, typed)
    changes = requests.merge(typed.where("load_id >= 2"), "second half")
    kind = F.when(F.col("old").isNull(), F.lit("inserted")).otherwise(F.lit("updated"))
    return changes.select("new.unique_key", F.col("old.closed_date").alias("old_closed_date"), F.col("new.closed_date").alias("new_closed_date"), kind.alias("change_kind"))


@register("stream_upsert")
def stream_upsert(spark, sf_dir):
    """I7 with M2: the newest event of each user and type, from a stream of files of which one comes again."""
    events = table(spark, sf_dir, "events")
    arrived = shared_path(spark, "stored", "arriving-events")
    for k in LOADS:
        events.where(F.pmod("event_id", F.lit(len(LOADS))) == k).coalesce(1).write.mode("append").parquet(arrived)
    newest = keyed.KeyedTable(spark, shared_path(spark, "stored", "newest-events"), events.schema, ["user_id", "event_type"], ["ts", "event_id"], **_dealt(events))
    for checkpoint in ("first", "lost and begun again"):  # the second run hands the same batches over under the same numbers
        streams.upsert_available(spark, arrived, events.schema, newest, shared_path(spark, "stored", f"events-{checkpoint.split()[0]}"), "events", max_files_per_trigger=1)
    again = shared_path(spark, "stored", "copied-events")
    events.where(F.pmod("event_id", F.lit(len(LOADS))) == 1).write.parquet(again)
    streams.upsert_available(spark, again, events.schema, newest, shared_path(spark, "stored", "events-copied"), "copies")
    return newest.read()


@register("incremental_performance")
def incremental_performance(spark, sf_dir):
    """M4/A3: the performance fact from counts that followed three increments and a repeated one."""
    typed = _typed_once(spark, sf_dir)
    targets = fixture_targets(spark)
    requests = keyed.KeyedTable(spark, shared_path(spark, "stored", "followed"), typed.schema, ["unique_key"], list(DEDUPE_ORDER), **_dealt(typed))
    state = shared_path(spark, "stored", "performance-counts")

    def enrich(rows):
        return sla.enrich(sla.stage_requests(rows), targets)

    for name, loads in (("a", [0, 1]), ("b", [2]), ("c", [3]), ("b", [2])):
        increments.follow(requests, typed.where(F.col("load_id").isin(loads)), name, state, enrich)
    fact = increments.performance(spark, state)
    return fact.withColumns({c: F.round(c, 6) for c in ("p50_resolution_days", "p90_resolution_days")})


@register("incremental_savings")
def incremental_savings(spark, sf_dir):
    """What an incremental run reads and a full one, counted by the runs themselves and read back from their records."""
    typed = _typed_once(spark, sf_dir)
    target = typed.where("created_date < TIMESTAMP_NTZ '2000-01-01 00:00:00'")
    fresh = merge.incremental_select(typed, target, "created_date")
    records = shared_path(spark, "stored", "run-metrics")
    for mode, rows in (("full_refresh", typed), ("incremental", fresh)):
        to = shared_path(spark, "stored", f"run-{mode}")
        found = run_metrics.measured(rows, mode, lambda read, to=to: sla.stage_requests(read).write.parquet(to))
        layout.write_metrics(spark.createDataFrame([found], run_metrics.SCHEMA), records)
    return run_metrics.run_savings(run_metrics.read_metrics(spark, records))


@register("layout_comparison")
def layout_comparison(spark, sf_dir):
    """R-8/J7/A7/P20/P21: the rows in the folders that each query must open, by layout; what was not measured is pending."""
    raw, parts = raw_requests(spark, sf_dir), read_table(spark, _partitioned(spark, sf_dir))
    since = layout.partition_predicates((B_SINCE, None))
    selective = layout.partition_predicates((C_START, C_END), {"borough": C_BOROUGH})
    rows = F.count(F.lit(1))
    records = raw.agg(*[rows.alias(f"query_{k}") for k in "abc"]).withColumn("storage_format", F.lit("raw_parquet"))
    again = records  # a second run of the same measure
    opened = parts.agg(rows.alias("query_a"), F.count_if(since).alias("query_b"), F.count_if(selective).alias("query_c")).withColumn("storage_format", F.lit("partitioned"))
    some = read_table(spark, _typed_path(spark, sf_dir)).agg(F.lit(None).cast("bigint").alias("query_a"), rows.alias("query_b"), F.lit(None).cast("bigint").alias("query_c")).withColumn("storage_format", F.lit("typed_parquet"))
    wide = records.unionByName(again).unionByName(opened).unionByName(some)
    medians = benchmarks.median_values(benchmarks.unpivoted(wide, ["query_a", "query_b", "query_c"]))
    return benchmarks.stage_comparison(medians, ["raw_parquet", "partitioned", "typed_parquet"], "raw_parquet", "%.0f rows").withColumnsRenamed({"median_seconds": "median_rows", "time_label": "rows_label"})


@register("baseline_history")
def baseline_history(spark, sf_dir):
    """The baseline of the events' keys through all hours."""
    events = table(spark, sf_dir, "events")
    odd = (F.col("event_type") == "error") & (F.col("user_id") % 11 == 0)
    value = F.when(odd, F.lit('"none"')).otherwise(F.format_string("%.2f5", "value"))
    record = F.concat(F.lit('{"'), "event_type", F.lit('": '), value, F.lit(', "user": '), F.col("user_id").cast("string"), F.lit("}"))
    hours = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    found = drift.baseline_history(drift.period_snapshots(events.withColumn("record", record), hours, "record", ["ts", "event_id"]))
    named = F.transform("baseline", lambda c: F.concat(c["column_name"], F.lit(":"), c["type_name"]))
    return found.select("period", "action", F.array_join(named, ",").alias("baseline"))


@register("dry_run_sample")
def dry_run_sample(spark, sf_dir):
    """The rows of a dry run, two of every partition value."""
    path = layout.write_partitioned(gold.fixture_typed(spark, sf_dir), shared_path(spark, "stored", "dry-run"), sample_per_partition=2)
    return layout.read_partitioned(spark, path).select("unique_key", *layout.PARTITION_COLS)


@register("ordered_report")
def ordered_report(spark, sf_dir):
    """K3: the trend report with each row's place."""
    report = sla.trend_report(sla.sla_trends(_stored_performance(spark, sf_dir), FIXTURE_YEAR_CAP))
    return numbering.with_positions(report, [F.desc_nulls_last("breach_rate_current"), F.asc("complaint_type"), F.asc("responsible_agency")], first=1)


@register("request_positions")
def request_positions(spark, sf_dir):
    """K3: every request's place by time and key, numbered over ranges."""
    typed = gold.fixture_typed(spark, sf_dir)
    rest = [c for c in TYPED_COLUMNS if c not in ("created_date", "unique_key")]
    return numbering.with_positions(typed, ["created_date", "unique_key", *rest]).select("position", "created_date", "unique_key")


@register("file_order")
def file_order(spark, sf_dir):
    """K5: rows out of order of time within the files of the partitioned layout."""
    found = materialize(numbering.disorder_in_files(split_session(spark).read.parquet(_partitioned(spark, sf_dir)), "created_date"))  # a row for each file
    return found.agg(F.sum("rows").alias("rows"), F.sum("out_of_order").alias("out_of_order"))


@register("zorder_depth")
def zorder_depth(spark, sf_dir):
    """L3: whether files of the Z-ordered requests overlap less, by Z column, than files of the same number in order of arrival."""
    typed = _typed_once(spark, sf_dir)
    columns, files = ["borough", "complaint_type"], 16
    flat, clustered = (shared_path(spark, "stored", f"{name}-files") for name in ("flat", "clustered"))
    typed.repartition(files, "unique_key").write.parquet(flat)
    layout.with_zorder(typed, columns).repartitionByRange(files, layout.Z_COL, F.xxhash64("unique_key")).drop(layout.Z_COL).write.parquet(clustered)
    out = None
    for column in columns:
        # one row for each layout and column
        depth = [materialize(layout.overlap_depth(layout.file_index(spark, path, [column]), f"{column}_min", f"{column}_max").select(F.lit(column).alias("z_column"), F.col("greatest_depth").alias(f"greatest_{name}"), F.col("mean_depth").alias(f"mean_{name}"))) for name, path in (("flat", flat), ("clustered", clustered))]
        both = depth[0].join(depth[1], "z_column")
        out = both if out is None else out.unionByName(both)
    return out.select("z_column", (F.col("greatest_flat") == files).alias("flat_files_hold_all"), (F.col("greatest_clustered") < F.col("greatest_flat")).alias("greatest_is_less"), (F.col("mean_clustered") < F.col("mean_flat")).alias("mean_is_less"))


@register("published_fact")
def published_fact(spark, sf_dir):
    """What readers of a published fact see after a passing, a failing and another passing version."""
    perf = _stored_performance(spark, sf_dir)
    view, checks = "fct_published", quality.gold_suite(min_rows=1)[1:]
    root = shared_path(spark, "stored", "published")
    versions = [
        ("first", perf.where("calendar_year <= 1997 AND sla_breach_rate IS NOT NULL")),
        ("rejected", perf.withColumn("sla_breach_rate", F.lit(None).cast("double"))),
        ("second", perf.where("sla_breach_rate IS NOT NULL")),
    ]
    out = None
    for name, rows in versions:
        try:
            publish(rows, view, checks, root)
            passed = True
        except quality.QualityGateError:
            passed = False
        seen = spark.sql(f"SELECT count(*) AS rows, max(calendar_year) AS newest FROM {view}") if passed else spark.table(view).agg(F.count(F.lit(1)).alias("rows"), F.max("calendar_year").alias("newest"))
        row = spark.createDataFrame([(name, passed, *seen.first())], "version string, passed boolean, rows bigint, newest bigint")
        out = row if out is None else out.unionByName(row)
    return out


@register("landing_loads")
def landing_loads(spark, sf_dir):
    """Rows of each load in a landing folder that two loads were appended to."""
    raw, path = raw_requests(spark, sf_dir), shared_path(spark, "stored", "landing")
    for load in (2, 3):
        layout.append_raw(raw.where(F.col("load_id") == load).drop("load_id"), path, load)
    return read_raw(spark, path).groupBy("load_id").agg(F.count(F.lit(1)).alias("rows"), F.min("created_date").alias("first_created"))


@register("selected_scan")
def selected_scan(spark, sf_dir):
    """A table by format, two columns and a filter that reach the scan, read through a view."""
    rows = read_table(spark, f"{sf_dir.rstrip('/')}/orders.parquet", "parquet", ["o_orderkey", "o_totalprice"], F.col("o_totalprice") > 200_000)
    register_view(rows, "large_orders")
    return spark.sql("SELECT o_orderkey, o_totalprice FROM large_orders")


@register("seeded_targets")
def seeded_targets(spark, sf_dir):
    """S5 with J1: requests by target, the targets from a seed file with declared types."""
    path = shared_path(spark, "stored", "seed")
    fixture_targets(spark).coalesce(1).write.option("header", True).csv(path)
    enriched = sla.enrich(gold.fixture_staged(spark, sf_dir), load_targets(spark, path))
    return enriched.groupBy("complaint_type_normalized", "responsible_agency", "target_days").agg(F.count(F.lit(1)).alias("requests"))


@register("schema_policy")
def schema_policy(spark, sf_dir):
    """M3: what the policy says of loads with the columns of the landing, typed and staged requests, against the typed table."""
    typed = gold.fixture_typed(spark, sf_dir)
    out = None
    for name, rows in (("typed", typed), ("landing", raw_requests(spark, sf_dir)), ("staged", gold.fixture_staged(spark, sf_dir))):
        try:
            merge.assert_same_schema(rows, typed)
            verdict = "merged"
        except merge.SchemaChangeError as change:
            verdict = str(change)
        row = rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("source"), F.lit(verdict).alias("verdict"), "rows")
        out = row if out is None else out.unionByName(row)
    return out


@register("compaction_trigger")
def compaction_trigger(spark, sf_dir):
    """The trigger before and after a compaction that has files to merge."""
    path = _appended(spark, sf_dir)
    before = layout.needs_compaction(spark, path).drop("bytes").withColumn("stage", F.lit("before"))
    compacted = shared_path(spark, "stored", "compacted")
    layout.compact(spark, path, compacted, partition_cols=layout.PARTITION_COLS)
    return before.unionByName(layout.needs_compaction(spark, compacted).drop("bytes").withColumn("stage", F.lit("after")))


@register("storage_order")
def storage_order(spark, sf_dir):
    """Files of the landing, partitioned and appended layouts, and whether the later one takes fewer bytes than the landing."""
    raw = layout.write_landing(_raw(spark, sf_dir), shared_path(spark, "stored", "raw"))
    report = layout.storage_report(spark, [("landing", raw), ("partitioned", _partitioned(spark, sf_dir)), ("appended", _appended(spark, sf_dir))])
    return report.select("stage", "layer", "files", "prev_layer", (F.col("bytes") > 0).alias("has_bytes"))


@register("daily_increment")
def daily_increment(spark, sf_dir):
    """I7, M2, M4, A3, Q9, S8 together: the published fact after three runs over arriving files, the loads out of order and one twice."""
    raw, root = _raw(spark, sf_dir), shared_path(spark, "stored", "daily-increment")
    views = tuple(f"{name}_{root.rsplit('/', 1)[-1]}" for name in ("performance", "trends"))
    cfg = IncrementConfig(f"{root}/incoming", raw.schema, root, views, FIXTURE_YEAR_CAP, **_dealt(raw), performance_checks=ANY_ROWS, trends_checks=ANY_ROWS)
    for loads in ([3, 0], [1], [2, 1]):
        raw.where(F.col("load_id").isin(loads)).write.mode("append").parquet(cfg.incoming_path)
        run_increment(spark, cfg, fixture_targets(spark))
    return spark.table(views[0]).withColumns({c: F.round(c, 6) for c in ("p50_resolution_days", "p90_resolution_days")})
