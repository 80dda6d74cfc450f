import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from servicelake.functions.sla import days_over, safe_ratio, sla_breach, trend_direction, within_sla
from servicelake.operators import sla
from servicelake.sources.tables import targets_frame


def _staged(spark, rows):
    return spark.createDataFrame(
        rows,
        "unique_key bigint, created_date timestamp_ntz, closed_date timestamp_ntz, borough string, "
        "complaint_type string, agency string, status string",
    ).transform(sla.stage_requests)


def test_tristate_flags_and_days_over(spark):
    df = spark.createDataFrame(
        [(None, False, None, 3), (dt.datetime(2024, 1, 1), True, 9, 3), (dt.datetime(2024, 1, 1), False, 3, 3),
         (dt.datetime(2024, 1, 1), False, 4, 3)],
        "closed timestamp_ntz, anom boolean, days bigint, target int",
    )
    rows = df.select(
        within_sla("closed", "anom", "days", "target").alias("w"),
        sla_breach("closed", "anom", "days", "target").alias("b"),
        days_over("days", "target").alias("o"),
    ).collect()
    assert [(r.w, r.b, r.o) for r in rows] == [(None, None, None), (None, None, 6), (True, False, 0), (False, True, 1)]


def test_safe_ratio_and_trend(spark):
    df = spark.createDataFrame([(1, 0, 0.5, 0.2), (1, 4, None, 0.2), (3, 4, 0.2, 0.2), (0, None, 0.1, 0.3)],
                               "n bigint, d bigint, cur double, old double")
    rows = df.select(safe_ratio("n", "d").alias("r"), trend_direction("cur", "old").alias("t")).collect()
    assert [r.r for r in rows] == [None, 0.25, 0.75, None]
    assert [r.t for r in rows] == ["worsening", "stable", "stable", "improving"]


def test_performance_asymmetry_and_percentiles(spark):
    d = dt.datetime
    base = d(2023, 3, 1)
    rows = []
    days = [0, 1, 2, 5, 8, 13, 21]
    for i, n in enumerate(days):
        rows.append((i, base, base + dt.timedelta(days=n), "BRONX", "Rodent", "DOHMH", "Closed"))
    rows.append((100, base, base - dt.timedelta(days=1), "BRONX", "Rodent", "DOHMH", "Closed"))  # anomalous, closed
    rows.append((101, base, None, "BRONX", "Rodent", "DOHMH", "Open"))  # open
    rows.append((102, base, base, "BRONX", "Unknown Thing", "X", "Closed"))  # no target -> dropped
    enriched = sla.enrich(_staged(spark, rows), targets_frame(spark))
    perf = sla.sla_performance(enriched).collect()
    assert len(perf) == 1
    p = perf[0]
    assert p.complaint_type == "RODENT" and p.target_days == 7 and p.calendar_year == 2023
    assert p.total_requests == 9 and p.closed_requests == 8
    assert p.sla_breach_count == 3  # 8, 13, 21 > 7; the anomaly is not counted
    assert p.sla_breach_rate == 3 / 8  # denominator includes the anomalous closed row
    assert p.avg_resolution_days == np.mean(days)
    assert p.p50_resolution_days == pytest.approx(float(np.percentile(days, 50)), abs=1e-9)
    assert p.p90_resolution_days == pytest.approx(float(np.percentile(days, 90)), abs=1e-9)


def test_zero_closed_group_has_null_rate(spark):
    base = dt.datetime(2023, 1, 1)
    staged = _staged(spark, [(1, base, None, "BRONX", "Rodent", "DOHMH", "Open")])
    p = sla.sla_performance(sla.enrich(staged, targets_frame(spark))).first()
    assert p.closed_requests == 0 and p.sla_breach_rate is None


def _perf(spark, rows):
    return spark.createDataFrame(
        rows, "complaint_type string, responsible_agency string, calendar_year bigint, target_days int, sla_breach_rate double"
    )


def test_trends_ties_nulls_and_missing_endpoint(spark):
    rows = []
    # 12 categories in the current year 2025; two tie at rank 10.
    rates = [0.9, 0.85, 0.8, 0.75, 0.7, 0.65, 0.6, 0.55, 0.5, 0.4, 0.4, 0.1]
    for i, r in enumerate(rates):
        rows.append((f"T{i:02d}", "AG", 2025, 1, r))
        if i != 0:
            rows.append((f"T{i:02d}", "AG", 2021, 1, 0.5))
    rows.append(("TNULL", "AG", 2025, 1, None))  # NULL rate ranks last, not first
    rows.append(("T00", "AG", 2026, 1, 0.01))  # partial year beyond the cap
    perf = _perf(spark, rows)
    top = sla.top_breach(perf, 2025).collect()
    assert [r.complaint_type for r in top] == [f"T{i:02d}" for i in range(10)]  # T09 beats T10 on name
    trends = {r.complaint_type: r for r in sla.sla_trends(perf, 2025).collect()}
    assert set(trends) == {f"T{i:02d}" for i in range(10)}
    assert trends["T00"].breach_rate_y_minus_4 is None and trends["T00"].trend_direction == "stable"
    assert trends["T01"].trend_direction == "worsening"
    assert trends["T09"].breach_rate_current == 0.4 and trends["T09"].trend_direction == "improving"
    assert trends["T00"].breach_rate_current == 0.9


def test_gold_pipeline_writes_both_facts(spark, tmp_dir):
    from servicelake.plans.gold import build_gold, fixture_staged
    from servicelake.sources.fixtures import FIXTURE_YEAR_CAP, fixture_targets

    staged = fixture_staged(spark, "/root/testdata/sf0.001")
    out = build_gold(spark, staged, fixture_targets(spark), tmp_dir, FIXTURE_YEAR_CAP)
    perf = spark.read.parquet(out.performance_path)
    trends = spark.read.parquet(out.trends_path)
    assert perf.count() > 0 and trends.count() > 0
    assert trends.where(F.col("breach_rate_current").isNull()).count() == 0


def test_last_complete_year(spark):
    partial = spark.createDataFrame([(dt.datetime(2025, 12, 31, 8),), (dt.datetime(2026, 3, 1),)], "created_date timestamp_ntz")
    full = spark.createDataFrame([(dt.datetime(2025, 12, 31, 8),)], "created_date timestamp_ntz")
    assert partial.select(sla.last_complete_year(partial).alias("y")).first().y == 2025
    assert full.select(sla.last_complete_year(full).alias("y")).first().y == 2025


def test_borough_compare_one_category(spark):
    from servicelake.plans.gold import fixture_enriched

    enriched = fixture_enriched(spark, "/root/testdata/sf0.001")
    one = sla.borough_compare(enriched, "ECONOMY")
    every = sla.borough_compare(enriched)
    assert {r.complaint_type for r in one.collect()} == {"ECONOMY"}
    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))

    assert rows(one) == rows(every.where(F.col("complaint_type") == "ECONOMY").select(*one.columns))


def test_register_views_for_sql(spark):
    from servicelake.plans.gold import fixture_staged, register_views
    from servicelake.sources.fixtures import FIXTURE_YEAR_CAP, fixture_targets

    register_views(spark, fixture_staged(spark, "/root/testdata/sf0.001"), fixture_targets(spark), FIXTURE_YEAR_CAP)
    n = spark.sql("SELECT COUNT(*) FROM fct_sla_performance WHERE calendar_year <= 2000").first()[0]
    assert n > 0
    assert spark.sql("SELECT COUNT(*) FROM fct_sla_trends").first()[0] > 0
