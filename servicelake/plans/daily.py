"""The daily run: ingest -> drift gate -> silver append -> compaction branch
-> staging merge -> gold -> quality gate -> commit, as sequential Spark jobs.

A run's work is the landing rows of all runs that are not committed yet: the
append-only landing table is the ingest stream's sink, partitioned by the run
that ingested the rows, and a run is entered in the ledger only after its
quality gate.  So the rows of a run that failed anywhere -- the stream's
checkpoint has long moved on -- are taken up by the next one.  The drift gate
reads the footers of just the files those rows came from.  Silver gets the rows
of runs that it does not hold yet; once appends leave too many small files, the
fragmented partitions alone are rewritten.  Staging re-decides only the keys of
the pending rows (over those keys' full history) before merging them into the
previous staging table -- a broadcast anti join when the pending keys are
measured to be few, so the large previous table is streamed, not shuffled.

Silver history, the staging table and gold are read in full by a run; what
follows the increment is what is typed, appended and re-decided.  Staging and
gold are written to fresh versioned paths and the run returns them (the caller
switches its pointers after the run succeeds), so a failed step never leaves a
table half-overwritten while it is being read; versions beyond the newest few
are expired after the commit.  Each stage reads the previous stage's *written*
output, which bounds lineage: a lost executor costs at most one stage.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicelake.functions.clean import type_requests
from servicelake.operators import drift, keys, layout, merge, quality, sla
from servicelake.operators.joins import MAX_BROADCAST_BYTES, size_in_bytes
from servicelake.plans.gold import GoldTables, build_gold
from servicelake.session import keep_newest_versions, path_exists
from servicelake.streaming.ingest import decoded_path, ingest_available


class SchemaDriftError(RuntimeError):
    """Breaking change in the incoming records; the baseline is kept."""


@dataclass
class DailyConfig:
    incoming_path: str
    incoming_schema: T.StructType
    landing_path: str
    ingest_checkpoint: str
    silver_path: str
    staging_root: str
    gold_root: str
    baseline_schema_path: str
    year_cap: int
    key: str = "unique_key"
    dedupe_order: tuple[str, ...] = ("closed_date",)
    small_file_share: float = 0.5
    target_file_bytes: int = 128 << 20
    keep_versions: int = 3
    incoming_glob: str | None = None
    staging_checks: list[quality.Check] = field(default_factory=quality.staging_suite)
    gold_checks: list[quality.Check] = field(default_factory=quality.gold_suite)
    as_of: str | None = None
    seed_checks: list[quality.Check] = field(default_factory=quality.seed_suite)
    source_checks: list[quality.Check] = field(default_factory=quality.source_suite)
    trends_checks: list[quality.Check] = field(default_factory=quality.trends_suite)
    ledger_path: str | None = None

    @property
    def ledger(self) -> str:
        """Where committed runs are entered: one small file for each."""
        return self.ledger_path or f"{self.landing_path.rstrip('/')}_runs"


@dataclass
class DailyReport:
    run_id: str
    started_at: str
    drift_action: str
    drift_description: str
    ingested_rows: int
    compacted: bool
    landing_path: str
    silver_path: str
    staging_path: str
    gold: GoldTables
    touched_keys: int
    checks: DataFrame
    step_seconds: dict[str, float] = field(default_factory=dict)


RUN_COL = "_ingest_run"
SOURCE_COL = "_source_file"


def _version(root: str) -> str:
    return f"{root.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"


def committed_runs(spark: SparkSession, ledger: str) -> DataFrame:
    """(run): the runs whose rows have reached gold through the gate."""
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], "run string")
    return spark.read.schema("run string").json(ledger)


def pending_runs(spark: SparkSession, landing_path: str, ledger: str) -> list[str]:
    """Runs in landing that are not committed: the latest one, and those that failed before it."""
    if not path_exists(spark, landing_path):
        return []
    runs = spark.read.schema(f"{RUN_COL} string").parquet(landing_path).select(F.col(RUN_COL).alias("run")).distinct()
    return sorted(r["run"] for r in runs.join(committed_runs(spark, ledger), "run", "left_anti").collect())


def _runs_in(spark: SparkSession, table_path: str, runs: list[str]) -> set[str]:
    """Which of the runs a table holds rows of (file statistics skip files of others)."""
    if not runs or not path_exists(spark, table_path):
        return set()
    held = spark.read.parquet(table_path).where(F.col(RUN_COL).isin(runs)).select(RUN_COL).distinct()
    return {r[RUN_COL] for r in held.collect()}


def run_daily(
    spark: SparkSession,
    cfg: DailyConfig,
    targets: DataFrame,
    previous: DailyReport | None = None,
) -> DailyReport:
    """One daily run; pass the previous successful run's report to continue from it."""
    run_id = uuid.uuid4().hex[:12]
    steps: dict[str, float] = {}
    clock = [time.perf_counter()]

    def mark(step: str) -> None:
        now = time.perf_counter()
        steps[step] = round(now - clock[0], 3)
        clock[0] = now

    started_at = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
    silver_path = previous.silver_path if previous else cfg.silver_path
    layout.recover_compaction(spark, silver_path)

    # 1. exactly-once ingest of files not seen before into the append-only
    #    landing table (the stream's sink), a partition for each run
    ingest_available(
        spark,
        cfg.incoming_path,
        cfg.incoming_schema,
        cfg.landing_path,
        cfg.ingest_checkpoint,
        glob=cfg.incoming_glob,
        transform=lambda s: s.withColumns({SOURCE_COL: F.col("_metadata.file_path"), RUN_COL: F.lit(run_id)}),
        partition_by=[RUN_COL],
    )
    pending = pending_runs(spark, cfg.landing_path, cfg.ledger)
    if not pending and previous is None and not path_exists(spark, silver_path):
        raise ValueError(f"no records have arrived in {cfg.incoming_path} yet")
    schema = T.StructType([*cfg.incoming_schema.fields, T.StructField(SOURCE_COL, T.StringType()), T.StructField(RUN_COL, T.StringType())])
    landing = spark.read.schema(schema).parquet(cfg.landing_path)
    increment = landing.where(F.col(RUN_COL).isin(pending)) if pending else landing.limit(0)
    ingested = increment.count() if pending else 0
    mark("ingest")

    # 2. schema drift gate on the files the pending rows came from (their
    #    footers only: the cost follows files, not rows)
    files = [r[0] for r in increment.select(decoded_path(F.col(SOURCE_COL))).distinct().collect()]
    snapshot = drift.file_schema_snapshot(spark, files)
    if snapshot is None:
        action, description = "keep", "no new files"
    else:
        action, description = drift.apply_baseline(spark, snapshot, cfg.baseline_schema_path)
        if action == "fail":
            raise SchemaDriftError(description)
    mark("drift_gate")

    # 3. silver: append the pending rows that it does not hold, typed, month
    #    x letter partitioned (a run's append is committed as one job)
    held = _runs_in(spark, silver_path, pending)
    fresh = [r for r in pending if r not in held]
    if fresh:
        layout.write_partitioned(type_requests(increment.where(F.col(RUN_COL).isin(fresh)).drop(SOURCE_COL)), silver_path, mode="append")
    mark("silver_append")

    # 4. small-file branch: per-run appends add files to every touched
    #    partition; rewrite the partitions that hold several small ones once
    #    those make up a large part of the table's files
    stats = layout.needs_compaction(spark, silver_path, cfg.target_file_bytes, cfg.small_file_share).first()
    compacted = bool(stats["needs_compaction"])
    if compacted:
        layout.compact_partitions(spark, silver_path, _version(f"{cfg.silver_path.rstrip('/')}_scratch"), target_file_bytes=cfg.target_file_bytes)
    mark("compaction")
    silver = layout.read_partitioned(spark, silver_path).drop(*layout.PARTITION_COLS, RUN_COL)

    # 5. staging: re-decide only the pending keys, over their full history in
    #    silver, then merge them into the previous staging table
    staging_path = previous.staging_path if previous else None
    touched_keys = 0
    if staging_path is None:
        staging_path = _version(cfg.staging_root)
        sla.stage_requests(keys.dedupe_latest(silver, cfg.key, list(cfg.dedupe_order))).write.parquet(staging_path)
        touched_keys = spark.read.parquet(staging_path).count()  # Parquet footers only
    elif ingested:
        touched = increment.select(cfg.key).distinct()
        small = size_in_bytes(increment.select(cfg.key)) <= MAX_BROADCAST_BYTES
        if small:
            touched = F.broadcast(touched)
        history = silver.join(touched, cfg.key, "left_semi")
        delta_path = _version(f"{cfg.staging_root.rstrip('/')}_delta")
        sla.stage_requests(keys.dedupe_latest(history, cfg.key, list(cfg.dedupe_order))).write.parquet(delta_path)
        staged_touched = spark.read.parquet(delta_path)
        prev = spark.read.parquet(staging_path)
        staging_path = _version(cfg.staging_root)
        merge.upsert(prev, staged_touched, cfg.key, list(cfg.dedupe_order), source_is_small=small).write.parquet(
            staging_path
        )
        # One staged row per touched key; counted from the small delta table.
        touched_keys = staged_touched.count()
    staged = spark.read.parquet(staging_path)
    mark("staging_merge")

    # 6. gold facts (performance written first, trends read from it)
    gold_dir = _version(cfg.gold_root)
    gold = build_gold(spark, staged, targets, gold_dir, cfg.year_cap)
    mark("gold")

    # 7. quality gate over seed, silver, staging and gold; warnings only report
    suites = [
        (targets, "sla_targets", cfg.seed_checks),
        (silver, "silver_requests", cfg.source_checks),
        (staged, "stg_requests", cfg.staging_checks),
        (spark.read.parquet(gold.performance_path), "fct_sla_performance", cfg.gold_checks),
        (spark.read.parquet(gold.trends_path), "fct_sla_trends", cfg.trends_checks),
    ]
    checks = [row for df, name, suite in suites if suite for row in quality.run_checks(df, name, suite, cfg.as_of).collect()]
    results = spark.createDataFrame(checks, quality.RESULT_SCHEMA)  # one row per check
    quality.gate(results)
    mark("quality_gate")

    # 8. commit: only now are the pending rows done with
    if pending:
        spark.createDataFrame([(r,) for r in pending], "run string").coalesce(1).write.mode("append").json(cfg.ledger)
    keep_newest_versions(spark, cfg.staging_root, cfg.keep_versions, using=(staging_path,))
    keep_newest_versions(spark, f"{cfg.staging_root.rstrip('/')}_delta", 1)
    keep_newest_versions(spark, cfg.gold_root, cfg.keep_versions, using=(gold_dir,))
    keep_newest_versions(spark, f"{cfg.silver_path.rstrip('/')}_scratch", 0)
    mark("commit")
    return DailyReport(
        run_id, started_at, action, description, ingested, compacted, cfg.landing_path, silver_path, staging_path, gold,
        touched_keys, results, steps,
    )


def run_backfill(spark: SparkSession, cfg: DailyConfig, targets: DataFrame, source: DataFrame, start: str, end: str, ts_col: str = "created_date") -> DailyReport:
    """I6 as a plan: validate the range, land its records that silver lacks, then rebuild staging and gold in full.

    ``source`` holds landing-shaped records; those whose typed ``ts_col`` lies
    in [start, end) are taken.  Records that silver already holds (all columns
    equal) are not landed again, so a rerun adds nothing.
    """
    typed = type_requests(source.select(*[f.name for f in cfg.incoming_schema.fields]))
    rows = keys.backfill(typed, ts_col, start, end)
    if path_exists(spark, cfg.silver_path):
        layout.recover_compaction(spark, cfg.silver_path)
        there = layout.read_partitioned(spark, cfg.silver_path)
        same = [rows[c].eqNullSafe(there[c]) for c in rows.columns]
        on = same[0]
        for cond in same[1:]:
            on = on & cond
        rows = rows.join(there, on, "left_anti")
    layout.write_partitioned(rows.withColumn(RUN_COL, F.lit(f"backfill-{uuid.uuid4().hex[:12]}")), cfg.silver_path, mode="append")
    return run_daily(spark, cfg, targets)
