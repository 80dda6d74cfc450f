import datetime as dt

from pyspark.sql import functions as F

from servicelake.functions import clean
from servicelake.operators import layout


def test_tolerant_parsing(spark):
    df = spark.createDataFrame(
        [("2024-01-05T10:20:30.123", "  Noise\t", "40.5"), ("not a date", " x ", "abc"), (None, None, None)],
        "ts string, txt string, num string",
    )
    out = df.select(
        clean.parse_ts("ts").alias("ts"),
        clean.clean_text("txt").alias("txt"),
        clean.to_double_tolerant("num").alias("num"),
    ).collect()
    assert out[0]["ts"] == dt.datetime(2024, 1, 5, 10, 20, 30, 123000)
    assert out[0]["txt"] == "Noise\t"  # trim removes spaces only
    assert out[0]["num"] == 40.5
    assert out[1]["ts"] is None and out[1]["num"] is None
    assert out[1]["txt"] == "x"
    assert out[2]["ts"] is None


def test_day_diff_counts_boundaries(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2021, 4, 30, 23, 0), dt.datetime(2021, 5, 1, 1, 0)), (dt.datetime(2022, 4, 2), None)],
        "a timestamp_ntz, b timestamp_ntz",
    )
    rows = df.select(clean.day_diff("a", "b").alias("d")).collect()
    assert rows[0]["d"] == 1
    assert rows[1]["d"] is None


def test_type_requests_leaves_unknown_columns(spark):
    df = spark.createDataFrame([(" brooklyn ", "x")], "borough string, other string")
    row = clean.type_requests(df).first()
    assert row["borough"] == "BROOKLYN" and row["other"] == "x"


def test_partition_columns(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 7, 9, 5), "BRONX")], "created_date timestamp_ntz, borough string")
    row = layout.with_partition_columns(df).first()
    assert row["created_month"] == dt.date(2023, 7, 1)
    assert row["borough_truncated"] == "B"
    assert F is not None


def test_landing_fast_path_equals_pattern_parse(spark):
    edge = [
        "2021-02-30T00:00:00.000", "2021-13-01T00:00:00.000", "2021-01-01T24:00:00.000",
        "2021-01-01T23:59:60.000", "2021-1-01T00:00:00.000", "2021-01-01T00:00:00.0000",
        "2021-01-01 00:00:00.000", "+2021-01-01T00:00:00.000", "2021-01-01T00:00:00.000Z",
        "2021-03-14T02:30:00.000", " 2021-01-01T00:00:00.000", "12345-01-01T00:00:00.000",
        "2024-02-29T12:34:56.789", "2023-02-29T12:34:56.789", None, "", "2021-01-01T00:00:00.000\n",
    ]
    df = spark.createDataFrame([(s,) for s in edge], "s string")
    fast = clean.parse_ts("s")
    slow = F.when(
        F.try_to_timestamp(F.col("s"), F.lit(clean.LANDING_TS_FORMAT)).isNotNull(),
        F.to_timestamp_ntz(F.col("s"), F.lit(clean.LANDING_TS_FORMAT)),
    )
    rows = df.select("s", fast.alias("a"), slow.alias("b")).collect()
    assert all(r.a == r.b for r in rows), [r for r in rows if r.a != r.b]
    assert sum(r.a is not None for r in rows) == 2


def test_zone_independent_text_and_seconds(spark):
    # 1998-10-11 00:00 did not exist in Sao Paulo (clocks jumped to 01:00).
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = spark.createDataFrame(
            [(dt.datetime(1998, 10, 11, 0, 0, 0, 250000), dt.datetime(1998, 10, 12, 1, 0, 5))],
            "a timestamp_ntz, b timestamp_ntz",
        )
        row = df.select(clean.ntz_text("a").alias("t"), clean.seconds_between("a", "b").alias("s")).first()
        assert row.t == "1998-10-11T00:00:00.250"
        assert row.s == 86400 + 3605
        assert df.select(clean.parse_ts(clean.ntz_text("a")).alias("p")).first().p == dt.datetime(1998, 10, 11, 0, 0, 0, 250000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_landing_text_of_any_year_and_fraction(spark):
    want = {
        "1998-10-18 00:30:00": "1998-10-18T00:30:00.000",
        "2001-01-01 12:00:00.01": "2001-01-01T12:00:00.010",
        "9999-12-31 23:59:59.999999": "9999-12-31T23:59:59.999",
        "0001-01-01 00:00:00.0009": "0001-01-01T00:00:00.000",
        "+12345-01-01 00:00:00": "12345-01-01T00:00:00.000",
        "-0005-03-04 01:02:03": "-005-03-04T01:02:03.000",
    }
    df = spark.createDataFrame([(x,) for x in want], "s string").select("s", clean.ntz_text(F.col("s").cast("timestamp_ntz")).alias("text"))
    assert {r.s: r.text for r in df.collect()} == want
    assert "overlay" in df._jdf.queryExecution().analyzed().toString()  # not formatted field by field
