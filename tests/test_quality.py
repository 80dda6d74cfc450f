import datetime as dt

import pytest

from servicelake.operators import quality
from servicelake.operators.quality import Check


def _df(spark):
    d = dt.datetime
    return spark.createDataFrame(
        [(1, d(2024, 1, 30), "BRONX", 3), (2, d(2024, 1, 29), "bogus", 5000), (2, None, None, -1), (None, d(2024, 1, 1), "QUEENS", 1)],
        "unique_key bigint, created_date timestamp_ntz, borough string, resolution_days bigint",
    )


def test_suite_metrics(spark):
    res = {r.check: r for r in quality.run_checks(_df(spark), "t", quality.staging_suite(min_rows=3), "2024-02-10").collect()}
    assert res["Minimum row count check"].metric == 4 and res["Minimum row count check"].passed
    assert res["No missing primary keys"].metric == 1 and not res["No missing primary keys"].passed
    assert res["No missing created dates"].metric == 1
    assert res["Borough values mostly valid"].metric == 25.0 and not res["Borough values mostly valid"].passed
    assert res["Data freshness check"].metric == pytest.approx(11.0) and res["Data freshness check"].passed
    assert res["unique_key unique"].metric == 1 and not res["unique_key unique"].passed
    assert res["borough accepted values"].metric == 1 and res["borough accepted values"].severity == "warn"
    assert res["resolution_days between"].metric == 1


def test_gate_raises_on_error_only(spark):
    df = _df(spark)
    warn_only = quality.run_checks(df, "t", [Check("w", "between", "resolution_days", severity="warn", min=-365, max=3650)])
    assert quality.failed_checks(warn_only).count() == 1
    quality.gate(warn_only)  # does not raise
    err = quality.run_checks(df, "t", [Check("e", "missing_count_eq", "unique_key", 0)])
    with pytest.raises(quality.QualityGateError):
        quality.gate(err)


def test_duplicate_and_invalid_values(spark):
    df = _df(spark)
    assert [(r.unique_key, r.copies) for r in quality.duplicate_values(df, "unique_key").collect()] == [(2, 2)]
    chk = Check("b", "accepted_values", "borough", values=quality.ACCEPTED_BOROUGHS)
    assert [(r.borough, r.rows) for r in quality.invalid_values(df, chk).collect()] == [("bogus", 1)]
