import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from servicelake.functions.clean import type_requests
from servicelake.operators import drift, keys, layout, quality, sla, verify
from servicelake.plans.daily import DailyConfig, SchemaDriftError, pending_runs, run_backfill, run_daily
from servicelake.sources.fixtures import FIXTURE_YEAR_CAP, fixture_targets, raw_requests
from tests.conftest import SF_SMALL

BOROUGHS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def _cfg(tmp_dir, schema):
    return DailyConfig(
        incoming_path=f"{tmp_dir}/incoming",
        incoming_schema=schema,
        landing_path=f"{tmp_dir}/landing",
        ingest_checkpoint=f"{tmp_dir}/ckpt",
        silver_path=f"{tmp_dir}/silver",
        staging_root=f"{tmp_dir}/staging",
        gold_root=f"{tmp_dir}/gold",
        baseline_schema_path=f"{tmp_dir}/baseline",
        year_cap=FIXTURE_YEAR_CAP,
        staging_checks=quality.staging_suite(BOROUGHS, 100)[:4],
        source_checks=quality.source_suite(BOROUGHS),
        as_of="2001-08-31",
    )


def test_daily_run_end_to_end_and_rerun(spark, tmp_dir):
    raw = raw_requests(spark, SF_SMALL)
    # one file set per load arrives in the incoming folder (append-only)
    for lid in (0, 1):
        raw.where(F.col("load_id") == lid).write.mode("append").parquet(f"{tmp_dir}/incoming")
    cfg = _cfg(tmp_dir, raw.schema)
    first = run_daily(spark, cfg, fixture_targets(spark))
    assert first.drift_action == "save"
    assert first.ingested_rows == raw.where(F.col("load_id") <= 1).count()
    staged = spark.read.parquet(first.staging_path)
    assert staged.count() == staged.select("unique_key").distinct().count()
    assert spark.read.parquet(first.gold.performance_path).count() > 0

    # new arrivals: loads 2 and 3; rerun merges them into the previous staging
    for lid in (2, 3):
        raw.where(F.col("load_id") == lid).write.mode("append").parquet(f"{tmp_dir}/incoming")
    second = run_daily(spark, cfg, fixture_targets(spark), previous=first)
    assert second.drift_action == "keep"
    assert second.ingested_rows == raw.where(F.col("load_id") >= 2).count()
    assert second.compacted  # appends left two small files in most partitions
    assert spark.read.parquet(second.silver_path).count() == raw.count()
    staged2 = spark.read.parquet(second.staging_path)
    assert staged2.count() == raw.select("unique_key").distinct().count()
    assert second.touched_keys == raw.where(F.col("load_id") >= 2).select("unique_key").distinct().count()
    # the incremental merge equals a full rebuild from all landing rows
    full = sla.stage_requests(keys.dedupe_latest(type_requests(raw), "unique_key", ["closed_date"]))
    assert verify.content_difference(staged2.select(*full.columns), full).count() == 0

    # a rerun with nothing new ingests nothing and changes nothing
    third = run_daily(spark, cfg, fixture_targets(spark), previous=second)
    assert third.ingested_rows == 0 and third.touched_keys == 0
    assert third.drift_action == "keep"
    assert spark.read.parquet(third.staging_path).count() == staged2.count()


def test_breaking_drift_stops_the_run(spark, tmp_dir):
    raw = raw_requests(spark, SF_SMALL)
    raw.write.parquet(f"{tmp_dir}/incoming")
    cfg = _cfg(tmp_dir, raw.schema)
    drift.save_baseline(spark.createDataFrame([("unique_key", "str"), ("gone", "str")], "column_name string, type_name string"), cfg.baseline_schema_path)
    with pytest.raises(SchemaDriftError):
        run_daily(spark, cfg, fixture_targets(spark))


def _rebuilt(raw):
    return sla.stage_requests(keys.dedupe_latest(type_requests(raw), "unique_key", ["closed_date"]))


def _arrive(raw, tmp_dir, load):
    raw.where(F.col("load_id") == load).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/incoming")


class Lost(RuntimeError):
    pass


def _lost(*args, **kwargs):
    raise Lost("a step was lost")


@pytest.mark.parametrize("where", ["before silver", "after silver", "in the gate"])
@pytest.mark.parametrize("first_run", [True, False])
def test_rows_of_a_failed_run_are_taken_up(spark, tmp_dir, monkeypatch, where, first_run):
    raw = raw_requests(spark, SF_SMALL).where("unique_key % 10 < 3").cache()
    cfg = _cfg(tmp_dir, raw.schema)
    cfg.gold_checks = cfg.trends_checks = []  # so few rows leave groups without a closed request
    previous = None
    if not first_run:
        _arrive(raw, tmp_dir, 0)
        previous = run_daily(spark, cfg, fixture_targets(spark))
    _arrive(raw, tmp_dir, 1)
    with monkeypatch.context() as m:
        if where == "before silver":
            m.setattr(layout, "write_partitioned", _lost)
        elif where == "after silver":
            m.setattr(keys, "dedupe_latest", _lost)
        else:
            m.setattr(quality, "gate", _lost)
        with pytest.raises(Lost):
            run_daily(spark, cfg, fixture_targets(spark), previous=previous)
    again = run_daily(spark, cfg, fixture_targets(spark), previous=previous)  # nothing new has arrived
    _arrive(raw, tmp_dir, 2)
    last = run_daily(spark, cfg, fixture_targets(spark), previous=again)
    loads = [1, 2] if first_run else [0, 1, 2]
    there = raw.where(F.col("load_id").isin(loads))
    assert last.ingested_rows == raw.where("load_id = 2").count()
    assert layout.read_partitioned(spark, last.silver_path).count() == there.count()
    full = _rebuilt(there)
    assert verify.content_difference(spark.read.parquet(last.staging_path).select(*full.columns), full).count() == 0
    assert pending_runs(spark, cfg.landing_path, cfg.ledger) == []


def test_old_file_with_a_lacking_column_is_gated(spark, tmp_dir):
    raw = raw_requests(spark, SF_SMALL)
    cfg = _cfg(tmp_dir, raw.schema)
    _arrive(raw, tmp_dir, 0)
    cfg.gold_checks = cfg.trends_checks = []
    first = run_daily(spark, cfg, fixture_targets(spark))
    before = set(os.listdir(cfg.incoming_path))
    raw.where("load_id = 1").drop("borough").coalesce(1).write.mode("append").parquet(cfg.incoming_path)
    for name in set(os.listdir(cfg.incoming_path)) - before:
        os.utime(f"{cfg.incoming_path}/{name}", (time.time() - 86400,) * 2)
    for _ in range(2):  # it stays pending, and so stays gated
        with pytest.raises(SchemaDriftError, match="borough"):
            run_daily(spark, cfg, fixture_targets(spark), previous=first)
    assert layout.read_partitioned(spark, cfg.silver_path).count() == raw.where("load_id = 0").count()


def test_files_of_any_name_are_gated(spark, tmp_dir):
    raw = raw_requests(spark, SF_SMALL)
    cfg = _cfg(tmp_dir, raw.schema)
    cfg.gold_checks = cfg.trends_checks = []
    raw.where("load_id = 0").coalesce(1).write.parquet(f"{tmp_dir}/out")
    part = next(n for n in os.listdir(f"{tmp_dir}/out") if n.endswith(".parquet"))
    os.makedirs(cfg.incoming_path)
    shutil.copy(f"{tmp_dir}/out/{part}", f"{cfg.incoming_path}/day 1+2 50% %20 #3.parquet")
    first = run_daily(spark, cfg, fixture_targets(spark))
    assert first.drift_action == "save"
    assert first.ingested_rows == raw.where("load_id = 0").count()


def test_old_versions_are_expired(spark, tmp_dir):
    raw = raw_requests(spark, SF_SMALL).where("unique_key % 10 < 2").cache()
    cfg = _cfg(tmp_dir, raw.schema)
    cfg.keep_versions = 2
    cfg.gold_checks = cfg.trends_checks = []
    previous = None
    for load in range(4):
        _arrive(raw, tmp_dir, load)
        previous = run_daily(spark, cfg, fixture_targets(spark), previous=previous)
    assert len(os.listdir(cfg.staging_root)) == len(os.listdir(cfg.gold_root)) == 2
    assert spark.read.parquet(previous.staging_path).count() == raw.select("unique_key").distinct().count()


def test_backfill_lands_a_range_once(spark, tmp_dir):
    raw = raw_requests(spark, SF_SMALL).cache()
    cfg = _cfg(tmp_dir, raw.schema)
    os.makedirs(cfg.incoming_path)
    with pytest.raises(ValueError):
        run_backfill(spark, cfg, fixture_targets(spark), raw, "1999-01-01", "1999-01-01")
    cfg.staging_checks = cfg.staging_checks[1:3]
    cfg.gold_checks = cfg.trends_checks = []
    report = run_backfill(spark, cfg, fixture_targets(spark), raw, "1998-01-01", "1999-01-01")
    within = raw.where("created_date >= '1998-01-01' and created_date < '1999-01-01'")
    full = _rebuilt(within)
    assert verify.content_difference(spark.read.parquet(report.staging_path).select(*full.columns), full).count() == 0
    rows = layout.read_partitioned(spark, cfg.silver_path).count()
    assert rows == within.count()
    run_backfill(spark, cfg, fixture_targets(spark), raw, "1998-01-01", "1999-01-01")
    assert layout.read_partitioned(spark, cfg.silver_path).count() == rows
