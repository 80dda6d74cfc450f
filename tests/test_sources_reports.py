import datetime as dt

from pyspark.sql import functions as F

from servicelake.functions.sla import change_note, relative_saving, speedup
from servicelake.operators import benchmarks, layout
from servicelake.sources import tables
from tests.conftest import SF_SMALL


def test_read_raw_and_read_table_prune_and_push(spark, tmp_dir):
    spark.range(10).withColumn("v", F.col("id") * 2).write.parquet(f"{tmp_dir}/flat")
    assert tables.read_raw(spark, f"{tmp_dir}/flat").count() == 10
    df = tables.read_table(spark, f"{SF_SMALL}/lineitem.parquet", columns=["l_orderkey"], where=F.col("l_quantity") > 40)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,40.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
    assert df.columns == ["l_orderkey"]


def test_seed_csv_load_and_view(spark, tmp_dir):
    lines = ["complaint_type,responsible_agency,target_days"] + [f"{a},{b},{c}" for a, b, c in tables.REFERENCE_SLA_TARGETS]
    with open(f"{tmp_dir}/sla_targets.csv", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    seed = tables.load_targets(spark, f"{tmp_dir}/sla_targets.csv")
    assert seed.count() == 10 and dict(seed.dtypes)["target_days"] == "int"
    tables.register_view(seed, "sla_targets_seed")
    assert spark.sql("SELECT target_days FROM sla_targets_seed WHERE complaint_type = 'ELEVATOR'").first()[0] == 1


def test_append_raw_keeps_load_ids(spark, tmp_dir):
    df = spark.createDataFrame([("a",), ("b",)], "x string")
    layout.append_raw(df, f"{tmp_dir}/landing", 7)
    layout.append_raw(df, f"{tmp_dir}/landing", 8)
    got = {r.load_id: r.n for r in spark.read.parquet(f"{tmp_dir}/landing").groupBy("load_id").agg(F.count("*").alias("n")).collect()}
    assert got == {7: 2, 8: 2}


def test_partitioned_write_registered_in_catalog(spark, tmp_dir):
    df = spark.createDataFrame(
        [(dt.datetime(2022, 3, 4), "BRONX", 1), (dt.datetime(2022, 4, 4), "QUEENS", 2)],
        "created_date timestamp_ntz, borough string, v int",
    )
    layout.write_partitioned(df, f"{tmp_dir}/tbl", table="requests_silver_t")
    back = spark.table("requests_silver_t")
    assert back.count() == 2 and {"created_month", "borough_truncated"} <= set(back.columns)
    spark.sql("DROP TABLE requests_silver_t")


def test_metrics_sink(spark, tmp_dir):
    rows = [benchmarks.timing_record("raw_parquet", "query_a", i, s, 6, 20) for i, s in enumerate([3.0, 1.0, 2.0])]
    df = spark.createDataFrame(rows, benchmarks.TIMINGS_SCHEMA)
    layout.write_metrics(df, f"{tmp_dir}/metrics")
    assert spark.read.json(f"{tmp_dir}/metrics").count() == 3


def test_percent_and_speedup_labels(spark):
    df = spark.createDataFrame([(18.4, 2.42), (1.24, 1.60), (0.0, 1.0), (None, 1.0), (1.0, 25.0)], "a double, b double")
    rows = df.select(relative_saving("a", "b").alias("p"), change_note("a", "b", "x").alias("l"), speedup("a", "b").alias("s")).collect()
    assert rows[0].l == "(-86.8% vs x)" and rows[1].l == "(+29.0% vs x)"
    assert rows[4].l == "(+2400.0% vs x)"  # no thousands separator
    assert rows[2].p is None and rows[3].s is None
    assert abs(rows[1].s - 1.24 / 1.60) < 1e-12


def test_median_stage_comparison_and_headline(spark):
    recs = []
    for fmt, times in {"raw_parquet": [10.0, 12.0, 11.0], "partitioned": [2.0, 3.0, 2.5]}.items():
        for q in ("query_a", "query_c"):
            for i, t in enumerate(times):
                recs.append(benchmarks.timing_record(fmt, q, i, t, 1, 5))
    timings = spark.createDataFrame(recs, benchmarks.TIMINGS_SCHEMA)
    med = benchmarks.median_timings(timings)
    got = {(r.storage_format, r.query): r.median_seconds for r in med.collect()}
    assert got[("raw_parquet", "query_a")] == 11.0 and got[("partitioned", "query_c")] == 2.5
    comp = {(r.query, r.storage_format): r for r in benchmarks.stage_comparison(med, ["raw_parquet", "partitioned", "zordered"], "raw_parquet").collect()}
    assert comp[("query_a", "zordered")].time_label == "PENDING" and comp[("query_a", "zordered")].speedup is None
    assert comp[("query_c", "partitioned")].speedup == 11.0 / 2.5
    assert comp[("query_c", "partitioned")].speedup_label == "(4.4x faster)"
    assert comp[("query_c", "raw_parquet")].speedup_label == ""
    assert comp[("query_c", "raw_parquet")].speedup is None
    head = benchmarks.headline(med, "query_c", "raw_parquet", "partitioned").first()
    assert head.speedup == 11.0 / 2.5


def test_incremental_vs_full(spark):
    runs = spark.createDataFrame([("full_refresh", 1000), ("incremental", 1221)], "mode string, bytes_scanned bigint")
    r = benchmarks.incremental_vs_full(runs).first()
    assert r.full_refresh_bytes == 1000 and abs(r.reduction_percentage - (-22.1)) < 1e-9


def test_read_table_any_installed_format(spark, tmp_dir):
    spark.range(5).withColumn("v", F.col("id") * 3).write.orc(f"{tmp_dir}/orc")
    df = tables.read_table(spark, f"{tmp_dir}/orc", fmt="orc", columns=["v"], where=F.col("id") >= 3)
    assert sorted(r.v for r in df.collect()) == [9, 12]
