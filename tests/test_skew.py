"""Hot-key inputs (one key holds a third of the rows) against brute force."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from servicelake.operators import keys, merge, sla
from servicelake.sources.tables import targets_frame

N = 3000


def _hot_frame(spark):
    # key 7 holds one third of the rows; the rest are spread over 500 keys
    df = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500 + 1000).alias("k"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.timestamp_seconds(F.col("id") * 3600)).cast("timestamp_ntz").alias("closed"),
        (F.col("id") % 97).cast("string").alias("payload"),
    )
    return df.repartition(8)


def test_dedupe_with_hot_key_matches_brute_force(spark):
    df = _hot_frame(spark)
    got = {r.k: (r.closed, r.payload) for r in keys.dedupe_latest(df, "k", ["closed"]).collect()}
    pdf = df.toPandas()
    pdf["_nn"] = pdf["closed"].notna()
    want = {}
    for k, g in pdf.groupby("k"):
        g = g.sort_values(["_nn", "closed", "payload"], ascending=False, na_position="last")
        row = g.iloc[0]
        want[k] = (None if pd.isna(row["closed"]) else row["closed"].to_pydatetime(), row["payload"])
    assert got == want
    plan = keys.dedupe_latest(df, "k", ["closed"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Aggregate") >= 2  # partial + final


def test_upsert_with_hot_key(spark):
    df = _hot_frame(spark)
    target = keys.dedupe_latest(df.where(F.col("k") != 7), "k", ["closed"])
    out = merge.upsert(target, df, "k", ["closed"])
    assert out.count() == out.select("k").distinct().count() == df.select("k").distinct().count()


def test_performance_with_hot_group_matches_numpy(spark):
    base = dt.datetime(2022, 1, 1)
    rng = np.random.default_rng(7)
    rows = []
    for i in range(N):
        cat = "Rodent" if i % 3 == 0 else ("Water Leak" if i % 2 else "Elevator")
        days = int(rng.integers(0, 40))
        closed = None if i % 13 == 0 else base + dt.timedelta(days=days, hours=int(rng.integers(0, 23)))
        rows.append((i, base, closed, "BRONX", cat, "X", "S"))
    staged = spark.createDataFrame(
        rows,
        "unique_key bigint, created_date timestamp_ntz, closed_date timestamp_ntz, borough string, "
        "complaint_type string, agency string, status string",
    ).transform(sla.stage_requests)
    perf = {r.complaint_type: r for r in sla.sla_performance(sla.enrich(staged, targets_frame(spark))).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "created", "closed", "b", "cat", "a", "s"])
    pdf["days"] = (pdf["closed"].dt.normalize() - pdf["created"].dt.normalize()).dt.days
    for cat, label, target in (("Rodent", "RODENT", 7), ("Water Leak", "WATER LEAK", 14), ("Elevator", "ELEVATOR", 1)):
        g = pdf[pdf["cat"] == cat]
        closed = g["days"].dropna()
        p = perf[label]
        assert p.total_requests == len(g) and p.closed_requests == len(closed)
        assert p.sla_breach_count == int((closed > target).sum())
        assert abs(p.p50_resolution_days - np.percentile(closed, 50)) < 1e-9
        assert abs(p.p90_resolution_days - np.percentile(closed, 90)) < 1e-9
        assert abs(p.avg_resolution_days - closed.mean()) < 1e-9
