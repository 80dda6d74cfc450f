import datetime as dt

import pytest

from servicelake.operators import merge

SCHEMA = "k bigint, created timestamp_ntz, closed timestamp_ntz, status string"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_matched_new_and_duplicate_source(spark):
    d = dt.datetime
    target = spark.createDataFrame([(1, d(2024, 1, 1), None, "Open"), (2, d(2024, 1, 2), None, "Open")], SCHEMA)
    source = spark.createDataFrame(
        [(2, d(2024, 1, 2), d(2024, 1, 5), "Closed"), (2, d(2024, 1, 2), None, "Open"), (3, d(2024, 1, 3), None, "Open")],
        SCHEMA,
    )
    out = merge.upsert(target, source, "k", ["closed"])
    assert _rows(out) == [
        (1, d(2024, 1, 1), None, "Open"),
        (2, d(2024, 1, 2), d(2024, 1, 5), "Closed"),
        (3, d(2024, 1, 3), None, "Open"),
    ]
    twice = merge.upsert(out, source, "k", ["closed"])
    assert _rows(twice) == _rows(out)  # idempotent


def test_schema_change_fails(spark):
    a = spark.createDataFrame([(1, "x")], "k bigint, v string")
    b = spark.createDataFrame([(1, 2)], "k bigint, v int")
    with pytest.raises(merge.SchemaChangeError):
        merge.upsert(a, b, "k", ["v"])


def test_incremental_select(spark):
    d = dt.datetime
    src = spark.createDataFrame([(1, d(2024, 1, 1), None, "O"), (2, d(2024, 1, 3), None, "O")], SCHEMA)
    tgt = spark.createDataFrame([(1, d(2024, 1, 2), None, "O")], SCHEMA)
    assert [r.k for r in merge.incremental_select(src, tgt, "created").collect()] == [2]
    assert merge.incremental_select(src, None, "created").count() == 2


def test_changed_rows_catch_late_updates(spark):
    d = dt.datetime
    old = spark.createDataFrame([(1, d(2024, 1, 1), None, "Open"), (2, d(2024, 1, 1), None, "Open")], SCHEMA)
    new = spark.createDataFrame(
        [(1, d(2024, 1, 1), d(2024, 3, 1), "Closed"), (2, d(2024, 1, 1), None, "Open"), (3, d(2024, 1, 2), None, "Open")],
        SCHEMA,
    )
    got = {r.k: r.change_kind for r in merge.changed_rows(old, new, "k", ["created", "closed", "status"]).collect()}
    assert got == {1: "updated", 3: "inserted"}


def test_full_refresh_overwrites(spark, tmp_dir):
    path = f"{tmp_dir}/model"
    merge.full_refresh(spark.range(5), path)
    merge.full_refresh(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2
