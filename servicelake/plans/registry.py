"""Registered queries: name -> ``(spark, sf_dir) -> DataFrame``.

Each reads the driver's test tables (via the fixture views) in full and
returns a DataFrame whose columns match the oracle SQL by name.  Queries over
written layouts, stored facts and streams run their writes while they are
built; the others are lazy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servicelake.functions.clean import type_requests
from servicelake.operators import benchmarks, drift, keys, layout, merge, quality, sla, verify
from servicelake.plans import gold
from servicelake.session import ROW_GROUP_BYTES, materialize, partitions_for, shared_path, split_session
from servicelake.sources.fixtures import FIXTURE_YEAR_CAP, raw_requests, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def wrap(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return wrap


_WRITTEN: dict[tuple[str, str, str], str] = {}


def _once(name: str, spark, sf_dir, write: Callable[[SparkSession, str], str]) -> str:
    """The path of a table that several queries read, written once for each session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        _WRITTEN[key] = write(spark, sf_dir)
    return _WRITTEN[key]


#: Shuffled bytes that a task joins and writes of the landing records.
LANDING_TASK_BYTES = 16 << 20

_ROWS: dict[tuple[str, str], int] = {}


def _sized(spark, sf_dir, advisory_bytes: int | None = None) -> SparkSession:
    """A session whose shuffle partitions follow the landing records (one for each row of ``lineitem``, counted from its footers)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ROWS:
        _ROWS[key] = table(spark, sf_dir, "lineitem").count()
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return split_session(spark, partitions=max(own, partitions_for(_ROWS[key])), advisory_bytes=advisory_bytes)


def _landed(spark, sf_dir) -> str:
    """The landing records as a stored table, so that the joins under them run once for all layers made of them."""

    def write(spark, sf_dir):
        path = shared_path(spark, "layouts", "raw")
        raw_requests(_sized(spark, sf_dir, LANDING_TASK_BYTES), sf_dir).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
        return path

    return _once("raw", spark, sf_dir, write)


def _raw(spark, sf_dir) -> DataFrame:
    """The stored landing records."""
    return _sized(spark, sf_dir).read.schema(raw_requests(spark, sf_dir).schema).parquet(_landed(spark, sf_dir))


def _typed(spark, sf_dir) -> DataFrame:
    """The stored landing records, typed."""
    return type_requests(_raw(spark, sf_dir))


def _typed_path(spark, sf_dir) -> str:
    """The typed records as a stored table, so that texts are parsed once for all that is made of them."""

    def write(spark, sf_dir):
        path = shared_path(spark, "stored", "typed")
        _typed(spark, sf_dir).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
        return path

    return _once("typed", spark, sf_dir, write)


def _typed_once(spark, sf_dir) -> DataFrame:
    """The stored typed records."""
    return _sized(spark, sf_dir).read.schema(_typed(spark, sf_dir).schema).parquet(_typed_path(spark, sf_dir))


def _with_position(ordered):
    """Rows of an ordered top-k with their place in its order (from 0), so that a comparison sees the order."""
    return ordered.withColumn("position", F.monotonically_increasing_id())


# --- cleaning / staging ------------------------------------------------------


@register("typed_requests")
def typed_requests(spark, sf_dir):
    return gold.fixture_typed(spark, sf_dir)


@register("staged_requests")
def staged_requests(spark, sf_dir):
    return gold.fixture_staged(spark, sf_dir)


@register("normalized_category")
def normalized_category(spark, sf_dir):
    return (
        gold.fixture_staged(spark, sf_dir)
        .groupBy("complaint_type", "complaint_type_normalized")
        .agg(F.count(F.lit(1)).alias("requests"))
    )


@register("anomaly_flags")
def anomaly_flags(spark, sf_dir):
    return (
        gold.fixture_staged(spark, sf_dir)
        .groupBy("is_anomaly", "anomaly_reason")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.min("resolution_days").alias("min_resolution_days"),
            F.max("resolution_days").alias("max_resolution_days"),
        )
    )


@register("coordinate_nulls")
def coordinate_nulls(spark, sf_dir):
    from servicelake.operators.verify import coordinate_null_share

    return coordinate_null_share(gold.fixture_typed(spark, sf_dir))


# --- SLA facts ---------------------------------------------------------------


@register("sla_enriched")
def sla_enriched(spark, sf_dir):
    return gold.fixture_enriched(spark, sf_dir)


@register("sla_performance")
def sla_performance(spark, sf_dir):
    """Percentiles are compared to 6 decimals of a day: engines interpolate by
    equal formulas whose last bit differs."""
    perf = gold.fixture_performance(spark, sf_dir)
    return perf.withColumns({c: F.round(c, 6) for c in ("p50_resolution_days", "p90_resolution_days")})


def _stored_performance(spark, sf_dir):
    # The trends/report models read the stored performance fact; a reliable
    # checkpoint plays that table here so the requests pipeline runs once.
    return materialize(gold.fixture_performance(spark, sf_dir))


@register("sla_trends")
def sla_trends(spark, sf_dir):
    return sla.sla_trends(_stored_performance(spark, sf_dir), FIXTURE_YEAR_CAP)


@register("top_breach")
def top_breach(spark, sf_dir):
    return _with_position(sla.top_breach(_stored_performance(spark, sf_dir), FIXTURE_YEAR_CAP))


@register("agency_year_breach")
def agency_year_breach(spark, sf_dir):
    return sla.agency_year_breach(gold.fixture_performance(spark, sf_dir))


@register("trend_report")
def trend_report(spark, sf_dir):
    return sla.trend_report(sla.sla_trends(_stored_performance(spark, sf_dir), FIXTURE_YEAR_CAP))


@register("borough_compare")
def borough_compare(spark, sf_dir):
    return sla.borough_compare(gold.fixture_enriched(spark, sf_dir))


# --- keys / paging -------------------------------------------------------------


PAGE_CURSOR = ("2024-01-10 00:00:00", 5000)
PAGE_SIZE = 1000
DEDUPE_ORDER = ("closed_date",)


def _events_page(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    cursor = (F.lit(PAGE_CURSOR[0]).cast("timestamp_ntz"), F.lit(PAGE_CURSOR[1]).cast("bigint"))
    return keys.keyset_page(ev, ["ts", "event_id"], cursor, PAGE_SIZE)


@register("window_slice")
def window_slice(spark, sf_dir):
    return keys.in_window(
        gold.fixture_typed(spark, sf_dir),
        "created_date",
        F.lit("1997-01-01").cast("timestamp_ntz"),
        F.lit("1998-01-01").cast("timestamp_ntz"),
    )


@register("keyset_page")
def keyset_page(spark, sf_dir):
    return _events_page(spark, sf_dir)


@register("page_cursor")
def page_cursor(spark, sf_dir):
    return keys.page_cursor(_events_page(spark, sf_dir), ["ts", "event_id"])


@register("page_summary")
def page_summary(spark, sf_dir):
    return keys.page_summary(gold.fixture_typed(spark, sf_dir), "created_date", PAGE_SIZE)


@register("pending_chunks")
def pending_chunks(spark, sf_dir):
    typed = gold.fixture_typed(spark, sf_dir)
    return keys.pending_chunks(
        keys.chunk_years(typed, "created_date"), keys.completed_year_ledger(typed, "created_date")
    )


@register("dedupe_latest")
def dedupe_latest(spark, sf_dir):
    return keys.dedupe_latest(gold.fixture_typed(spark, sf_dir), "unique_key", DEDUPE_ORDER)


@register("as_of_load")
def as_of_load(spark, sf_dir):
    return keys.as_of(gold.fixture_typed(spark, sf_dir), "unique_key", "load_id", 1, DEDUPE_ORDER)


# --- incremental / merge -----------------------------------------------------


@register("incremental_select")
def incremental_select(spark, sf_dir):
    typed = gold.fixture_typed(spark, sf_dir)
    target = keys.in_window(typed, "created_date", None, F.lit("2000-01-01").cast("timestamp_ntz"))
    return merge.incremental_select(typed, target, "created_date")


@register("upsert_requests")
def upsert_requests(spark, sf_dir):
    typed = gold.fixture_typed(spark, sf_dir)
    target = keys.as_of(typed, "unique_key", "load_id", 1, DEDUPE_ORDER)
    source = typed.where(F.col("load_id") >= 2)
    return merge.upsert(target, source, "unique_key", DEDUPE_ORDER)


@register("changed_rows")
def changed_rows(spark, sf_dir):
    typed = gold.fixture_typed(spark, sf_dir)
    old = keys.as_of(typed, "unique_key", "load_id", 1, DEDUPE_ORDER)
    new = keys.dedupe_latest(typed, "unique_key", DEDUPE_ORDER)
    return merge.changed_rows(old, new, "unique_key", ["created_date", "closed_date", "status"])


# --- quality -------------------------------------------------------------------

FIXTURE_BOROUGHS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
FIXTURE_MIN_ROWS = 1000
FRESHNESS_AS_OF = "2001-08-31 00:00:00"


@register("quality_results")
def quality_results(spark, sf_dir):
    from servicelake.sources.fixtures import fixture_targets

    staged = gold.fixture_staged(spark, sf_dir)
    perf = _stored_performance(spark, sf_dir)
    return (
        quality.run_checks(staged, "stg_requests", quality.staging_suite(FIXTURE_BOROUGHS, FIXTURE_MIN_ROWS), FRESHNESS_AS_OF)
        .unionByName(quality.run_checks(perf, "fct_sla_performance", quality.gold_suite()))
        .unionByName(quality.run_checks(fixture_targets(spark), "sla_targets", quality.seed_suite()))
        .unionByName(quality.run_checks(gold.fixture_typed(spark, sf_dir), "silver_requests", quality.source_suite(FIXTURE_BOROUGHS, unique=True)))
        .unionByName(quality.run_checks(sla.sla_trends(perf, FIXTURE_YEAR_CAP), "fct_sla_trends", quality.trends_suite()))
    )


@register("duplicate_keys")
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_values(gold.fixture_staged(spark, sf_dir), "unique_key")


@register("invalid_values")
def invalid_values(spark, sf_dir):
    chk = quality.Check("borough accepted values", "accepted_values", "borough", values=quality.ACCEPTED_BOROUGHS)
    return quality.invalid_values(gold.fixture_staged(spark, sf_dir), chk)


@register("freshness")
def freshness(spark, sf_dir):
    return quality.freshness(gold.fixture_staged(spark, sf_dir), "created_date", FRESHNESS_AS_OF, 30)


# --- schema drift --------------------------------------------------------------


@register("json_key_types")
def json_key_types(spark, sf_dir):
    return drift.json_key_types(table(spark, sf_dir, "events"), "props", ["ts", "event_id"])


def _layer_snapshots(spark, sf_dir):
    order = ["unique_key", "load_id"]

    def snap(df):
        rec = drift.records_as_json(df, keep=order)
        return drift.json_key_types(rec, "record", order)

    old = _raw(spark, sf_dir).drop("status")
    old = old.withColumns({":id": F.col("unique_key"), "legacy_code": F.concat(F.lit("code "), F.col("load_id"))})
    return snap(old), snap(_typed(spark, sf_dir).withColumn(":updated", F.lit(True)))


@register("schema_diff")
def schema_diff(spark, sf_dir):
    old, new = _layer_snapshots(spark, sf_dir)
    return drift.schema_diff(old, new)


@register("drift_verdict")
def drift_verdict(spark, sf_dir):
    old, new = _layer_snapshots(spark, sf_dir)
    return drift.drift_verdict(drift.schema_diff(old, new))


# --- benchmark queries A/B/C -------------------------------------------------


# Fixture literals in the role of the production ones (data spans 1995-2001).
B_SINCE = "1998-01-01"
C_BOROUGH, C_CATEGORY, C_START, C_END = "ASIA", "ECONOMY", "1998-01-01", "1999-01-01"


@register("bench_a")
def bench_a(spark, sf_dir):
    return _with_position(benchmarks.query_a(gold.fixture_typed(spark, sf_dir)))


@register("bench_b")
def bench_b(spark, sf_dir):
    return benchmarks.query_b(gold.fixture_typed(spark, sf_dir), B_SINCE)


@register("bench_c")
def bench_c(spark, sf_dir):
    return benchmarks.query_c(gold.fixture_typed(spark, sf_dir), C_BOROUGH, C_CATEGORY, C_START, C_END)


@register("bench_a_raw")
def bench_a_raw(spark, sf_dir):
    return benchmarks.query_a(raw_requests(spark, sf_dir), typed=False)


@register("bench_b_raw")
def bench_b_raw(spark, sf_dir):
    return benchmarks.query_b(raw_requests(spark, sf_dir), B_SINCE, typed=False)


@register("bench_c_raw")
def bench_c_raw(spark, sf_dir):
    return benchmarks.query_c(raw_requests(spark, sf_dir), C_BOROUGH, C_CATEGORY, C_START, C_END, typed=False)


# --- layouts -----------------------------------------------------------------

TYPED_COLUMNS = (
    "unique_key", "created_date", "closed_date", "agency", "complaint_type", "borough",
    "status", "latitude", "longitude", "load_id",
)


def _partitioned(spark, sf_dir) -> str:
    """The fixture's partitioned layout, written once for each session and folder."""
    return _once("partitioned", spark, sf_dir, _write_layout)


def _write_layout(spark, sf_dir) -> str:
    return layout.write_partitioned(_typed_once(spark, sf_dir), shared_path(spark, "layouts", "partitioned"))


def _zordered(spark, sf_dir) -> str:
    return layout.write_zordered(_typed_once(spark, sf_dir), shared_path(spark, "layouts", "zordered"), stored=True)


@register("partition_rows")
def partition_rows(spark, sf_dir):
    return layout.partition_rows(spark, _partitioned(spark, sf_dir))


@register("partition_file_counts")
def partition_file_counts(spark, sf_dir):
    return layout.partition_file_counts(spark, _partitioned(spark, sf_dir))


@register("partitioned_bench_c")
def partitioned_bench_c(spark, sf_dir):
    df = spark.read.parquet(_partitioned(spark, sf_dir))
    return benchmarks.query_c(df, C_BOROUGH, C_CATEGORY, C_START, C_END, partitioned=True, columns=list(TYPED_COLUMNS))


@register("zorder_content")
def zorder_content(spark, sf_dir):
    return spark.read.parquet(_zordered(spark, sf_dir)).select(*TYPED_COLUMNS)


@register("file_index")
def file_index(spark, sf_dir):
    index = layout.file_index(spark, _partitioned(spark, sf_dir), ["created_date"], layout.PARTITION_COLS)
    return index.drop("file_path")


@register("skip_report")
def skip_report(spark, sf_dir):
    index = layout.file_index(spark, _partitioned(spark, sf_dir), ["borough", "created_date"])
    return layout.skip_report(index, equals={"borough": C_BOROUGH})


@register("storage_report")
def storage_report(spark, sf_dir):
    return layout.storage_report(
        spark,
        [("raw_parquet", _landed(spark, sf_dir)), ("partitioned", _partitioned(spark, sf_dir)), ("zordered", _zordered(spark, sf_dir))],
    )


@register("compaction_report")
def compaction_report(spark, sf_dir):
    src = _partitioned(spark, sf_dir)
    report = layout.compact(spark, src, shared_path(spark, "layouts", "compacted"), partition_cols=layout.PARTITION_COLS)
    return report.select("stage", "files")


# --- verification --------------------------------------------------------------


@register("layer_parity")
def layer_parity(spark, sf_dir):
    typed = _typed(spark, sf_dir)
    z = spark.read.parquet(_zordered(spark, sf_dir)).select(*TYPED_COLUMNS)
    return verify.content_parity(typed, z).select("left_rows", "right_rows", "equal")


@register("validate_only")
def validate_only(spark, sf_dir):
    return verify.validate_only(gold.fixture_typed(spark, sf_dir))


@register("coordinate_disagreement")
def coordinate_disagreement(spark, sf_dir):
    typed = gold.fixture_typed(spark, sf_dir)
    parents = keys.dedupe_latest(typed, "unique_key", DEDUPE_ORDER)
    child = keys.as_of(typed, "unique_key", "load_id", 1, DEDUPE_ORDER)
    return verify.coordinate_disagreement(
        parents, child, "unique_key", [("latitude", "latitude"), ("longitude", "longitude")]
    )


# --- streaming -----------------------------------------------------------------


@register("ingest_available")
def ingest_available(spark, sf_dir):
    from servicelake.streaming.ingest import ingest_available as run, read_sink

    schema = table(spark, sf_dir, "events").schema
    sink = shared_path(spark, "streams", "events_sink")
    ckpt = shared_path(spark, "streams", "events_ckpt")
    run(spark, sf_dir, schema, sink, ckpt, glob="events.parquet")
    return read_sink(spark, sink)


# --- further inventory items ---------------------------------------------------

SCHEMA_SAMPLE_SIZE = 100  # newest records sampled by the drift detector


@register("backfill_window")
def backfill_window(spark, sf_dir):
    return keys.backfill(gold.fixture_typed(spark, sf_dir), "created_date", "1999-01-01", "1999-07-01")


@register("newest_key_types")
def newest_key_types(spark, sf_dir):
    return drift.json_key_types(table(spark, sf_dir, "events"), "props", ["ts", "event_id"], sample=SCHEMA_SAMPLE_SIZE)


@register("raw_row_count")
def raw_row_count(spark, sf_dir):
    return raw_requests(spark, sf_dir).agg(F.count(F.lit(1)).alias("total_rows"))


@register("reader_parity")
def reader_parity(spark, sf_dir):
    typed = _typed(spark, sf_dir)
    silver = spark.read.parquet(_partitioned(spark, sf_dir))
    return verify.count_parity(typed, silver)


@register("failed_checks")
def failed_checks(spark, sf_dir):
    return quality.failed_checks(quality_results(spark, sf_dir))


@register("compaction_needed")
def compaction_needed(spark, sf_dir):
    return layout.needs_compaction(spark, _partitioned(spark, sf_dir)).drop("bytes")


@register("partition_compaction_report")
def partition_compaction_report(spark, sf_dir):
    # Two appends (loads 0-1, then 2-3) leave two files in most partitions;
    # only those partitions are rewritten, in place.
    typed = _typed(spark, sf_dir)
    path = shared_path(spark, "layouts", "appended")
    layout.write_partitioned(typed.where(F.col("load_id") <= 1), path, mode="append")
    layout.write_partitioned(typed.where(F.col("load_id") >= 2), path, mode="append")
    return layout.compact_partitions(spark, path, shared_path(spark, "layouts", "compaction_scratch")).select("stage", "files")
