"""Property-based checks against brute force (hypothesis)."""

import bisect
import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from servicelake.operators import keys, layout

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(
    bounds=st.lists(st.integers(-50, 50), max_size=20, unique=True).map(sorted),
    values=st.lists(st.one_of(st.none(), st.integers(-60, 60)), min_size=1, max_size=30),
)
def test_bucket_tree_counts_bounds_below(spark, bounds, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    fb = [float(b) for b in bounds]
    got = [r[0] for r in df.select(F.coalesce(layout._bucket(F.col("v").cast("double"), fb), F.lit(0))).collect()]
    want = [0 if v is None else bisect.bisect_left(fb, float(v)) for v in values]
    assert got == want


rows = st.lists(
    st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["a", "b", "c"])),
    min_size=1,
    max_size=40,
)


@SETTINGS
@given(data=rows)
def test_dedupe_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, o int, p string")
    got = sorted(tuple(r) for r in keys.dedupe_latest(df, "k", ["o"]).collect())
    best = {}
    for k, o, p in data:
        rank = (o is not None, o if o is not None else 0, p)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, o, p))
    assert got == sorted(v[1] for v in best.values())


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(0, 20), st.integers(0, 1000)), min_size=1, max_size=60, unique=True),
       page=st.integers(1, 7))
def test_paging_covers_sorted_whole(spark, data, page):
    df = spark.createDataFrame(data, "a int, b int")
    out, after = [], None
    while True:
        chunk = [tuple(r) for r in keys.keyset_page(df, ["a", "b"], after, page).collect()]
        out.extend(chunk)
        if len(chunk) < page:
            break
        after = chunk[-1]
    assert out == sorted(data)


@pytest.fixture(scope="module")
def partitioned(spark, tmp_path_factory):
    from servicelake.plans.gold import fixture_typed
    from tests.conftest import SF_SMALL

    path = str(tmp_path_factory.mktemp("part") / "silver")
    layout.write_partitioned(fixture_typed(spark, SF_SMALL), path)
    return spark.read.parquet(path)


@SETTINGS
@given(
    start=st.dates(min_value=dt.date(1994, 6, 1), max_value=dt.date(2002, 1, 1)),
    days=st.integers(0, 900),
    hour=st.integers(0, 23),
    borough=st.sampled_from(["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "NOWHERE"]),
)
def test_partition_predicates_never_drop_rows(spark, partitioned, start, days, hour, borough):
    lo = dt.datetime.combine(start, dt.time(hour))
    hi = lo + dt.timedelta(days=days, hours=hour)
    cond = (
        (F.col("borough") == borough)
        & (F.col("created_date") >= F.lit(lo.isoformat(sep=" ")).cast("timestamp_ntz"))
        & (F.col("created_date") < F.lit(hi.isoformat(sep=" ")).cast("timestamp_ntz"))
    )
    plain = partitioned.where(cond).count()
    pruned = partitioned.where(cond & layout.partition_predicates((lo.isoformat(sep=" "), hi.isoformat(sep=" ")), {"borough": borough})).count()
    assert plain == pruned


req_rows = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 8)),                      # key
        st.integers(0, 2),                                            # created day offset
        st.one_of(st.none(), st.integers(-3, 800)),                   # closed offset (days)
        st.sampled_from(["BRONX", "QUEENS", " ", None, "bogus"]),     # borough
        st.sampled_from(["Rodent", "Water Leak", "Elevator", "Other"]),
    ),
    min_size=1,
    max_size=40,
)


def _requests(spark, data):
    base = dt.datetime(2023, 1, 1)
    rows = [
        (k, base + dt.timedelta(days=c), None if cl is None else base + dt.timedelta(days=c + cl), b, t, "A", "S")
        for k, c, cl, b, t in data
    ]
    return spark.createDataFrame(
        rows,
        "unique_key int, created_date timestamp_ntz, closed_date timestamp_ntz, borough string, "
        "complaint_type string, agency string, status string",
    )


@SETTINGS
@given(data=req_rows)
def test_quality_suite_matches_brute_force(spark, data):
    from servicelake.operators import quality, sla

    staged = sla.stage_requests(_requests(spark, data))
    res = {r.check: r.metric for r in quality.run_checks(staged, "t", quality.staging_suite(min_rows=3), "2023-03-01").collect()}
    rows = staged.collect()
    n = len(rows)
    keys_ = [r.unique_key for r in rows]
    valid = set(quality.ACCEPTED_BOROUGHS)
    bad_borough = sum(1 for r in rows if r.borough is not None and r.borough not in valid)
    newest = max(r.created_date for r in rows)
    assert res["Minimum row count check"] == n
    assert res["No missing primary keys"] == sum(k is None for k in keys_)
    assert res["Borough values mostly valid"] == pytest.approx(100.0 * bad_borough / n)
    assert res["borough accepted values"] == bad_borough
    assert res["unique_key unique"] == sum(1 for k in set(keys_) if k is not None and keys_.count(k) > 1)
    assert res["resolution_days between"] == sum(
        1 for r in rows if r.resolution_days is not None and not (-365 <= r.resolution_days <= 3650)
    )
    assert res["Data freshness check"] == pytest.approx((dt.datetime(2023, 3, 1) - newest).total_seconds() / 86400)


@SETTINGS
@given(data=req_rows)
def test_performance_fact_matches_brute_force(spark, data):
    import numpy as np

    from servicelake.operators import sla
    from servicelake.sources.tables import targets_frame

    enriched = sla.enrich(sla.stage_requests(_requests(spark, data)), targets_frame(spark))
    got = {r.complaint_type: r for r in sla.sla_performance(enriched).collect()}
    rows = enriched.collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.complaint_type_normalized, []).append(r)
    assert set(got) == set(groups)
    for cat, rs in groups.items():
        p = got[cat]
        clean = [r.resolution_days for r in rs if not r.is_anomaly and r.resolution_days is not None]
        closed = sum(r.closed_date is not None for r in rs)
        breaches = sum(bool(r.is_sla_breach) for r in rs)
        assert (p.total_requests, p.closed_requests, p.sla_breach_count) == (len(rs), closed, breaches)
        assert p.sla_breach_rate == (breaches / closed if closed else None)
        if clean:
            assert p.avg_resolution_days == pytest.approx(float(np.mean(clean)))
            assert p.p50_resolution_days == pytest.approx(float(np.percentile(clean, 50)), abs=1e-6)
            assert p.p90_resolution_days == pytest.approx(float(np.percentile(clean, 90)), abs=1e-6)
        else:
            assert p.avg_resolution_days is None and p.p50_resolution_days is None
