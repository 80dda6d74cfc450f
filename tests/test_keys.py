import datetime as dt

import pytest
from pyspark.sql import functions as F

from servicelake.operators import keys
from tests.conftest import SF_SMALL


def test_keyset_paging_concatenates_to_sorted_whole(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("ts", "event_id")
    expected = [tuple(r) for r in ev.orderBy("ts", "event_id").collect()]
    pages, after = [], None
    while True:
        page = keys.keyset_page(ev, ["ts", "event_id"], after, limit=128).collect()
        if not page:
            break
        pages.extend(tuple(r) for r in page)
        cur = keys.page_cursor(spark.createDataFrame(page, ev.schema), ["ts", "event_id"]).first()
        after = (cur["ts"], cur["event_id"])
        if len(page) < 128:
            break
    assert pages == expected  # no gap, no repeat


def test_after_cursor_ties_on_first_column(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(t, "1"), (t, "2"), (t, "3"), (t + dt.timedelta(seconds=1), "0")], "d timestamp_ntz, k string")
    got = [r.k for r in keys.keyset_page(df, ["d", "k"], (t, "2"), 10).collect()]
    assert got == ["3", "0"]


def test_page_summary(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, i % 28 + 1),) for i in range(7)] + [(dt.datetime(2023, 5, 1),)], "ts timestamp_ntz")
    got = {r.year: (r.rows, r.pages) for r in keys.page_summary(df, "ts", 3).collect()}
    assert got == {2024: (7, 3), 2023: (1, 1)}


def test_pending_chunks_and_ledger(spark):
    df = spark.createDataFrame([(dt.datetime(y, 6, 1),) for y in (2021, 2022, 2023, 2024)], "ts timestamp_ntz")
    ledger = keys.completed_year_ledger(df, "ts")
    assert sorted(r.year for r in ledger.collect()) == [2021, 2022, 2023]
    done = spark.createDataFrame([(2021,), (2022,)], "year bigint")
    assert sorted(r.year for r in keys.pending_chunks(keys.chunk_years(df, "ts"), done).collect()) == [2023, 2024]


def test_backfill_validation(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 2, 1),)], "ts timestamp_ntz")
    assert keys.backfill(df, "ts", "2024-01-01", "2024-02-01").count() == 1
    with pytest.raises(ValueError):
        keys.backfill(df, "ts", "2024-02-01", "2024-02-01")
    with pytest.raises(ValueError):
        keys.backfill(df, "ts", None, "2024-02-01")


def test_dedupe_latest_is_deterministic(spark):
    d = dt.datetime
    rows = [
        (1, None, "a"), (1, d(2024, 1, 2), "b"), (1, d(2024, 1, 2), "c"),  # latest closed, tie -> max payload
        (2, None, "x"), (2, None, "y"),
        (3, d(2024, 1, 1), "z"),
    ]
    df = spark.createDataFrame(rows, "k bigint, closed timestamp_ntz, payload string")
    got = {r.k: (r.closed, r.payload) for r in keys.dedupe_latest(df, "k", ["closed"]).collect()}
    assert got == {1: (d(2024, 1, 2), "c"), 2: (None, "y"), 3: (d(2024, 1, 1), "z")}
    again = {r.k: (r.closed, r.payload) for r in keys.dedupe_latest(df.repartition(3), "k", ["closed"]).collect()}
    assert again == got


def test_as_of_load(spark):
    df = spark.createDataFrame([(1, 0, "old"), (1, 2, "new"), (2, 3, "late")], "k bigint, load_id int, v string")
    got = {r.k: r.v for r in keys.as_of(df, "k", "load_id", 2, ["load_id"]).collect()}
    assert got == {1: "new"}
    assert F is not None


def test_paging_rejects_empty_pages(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        keys.keyset_page(df, ["id"], None, 0)
    with pytest.raises(ValueError):
        keys.page_summary(df.select(F.current_timestamp().alias("ts")), "ts", 0)
