import random

import pytest
from pyspark.sql import functions as F

from servicelake.operators import benchmarks, drift, layout, numbering, quality, run_metrics
from servicelake.plans.publish import publish, published


def test_positions_over_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, rng.randint(0, 40)]), k) for k in range(3000)] + [(7, 5000 + k) for k in range(2000)]  # two fifths are equal
    got = numbering.with_positions(spark.createDataFrame(rows, "a long, b long").repartition(7), ["a", "b"]).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.position)] == want
    assert sorted(r.position for r in got) == list(range(len(rows)))
    assert numbering.with_positions(spark.createDataFrame([], "a long, b long"), ["a"]).count() == 0


def test_disorder_is_seen(spark, tmp_dir):
    spark.createDataFrame([(k,) for k in (1, 3, 2, 5, 4, 4)], "a long").coalesce(1).write.parquet(f"{tmp_dir}/t")
    row = numbering.disorder_in_files(spark.read.parquet(f"{tmp_dir}/t"), "a").first()
    assert (row["rows"], row["out_of_order"]) == (6, 2)


def test_baseline_through_periods(spark):
    days = [
        (1, [("a", "int")]),
        (2, [("a", "int")]),
        (3, [("a", "int"), ("b", "str")]),
        (4, [("a", "int")]),
        (5, [("a", "str"), ("b", "str")]),
        (6, [("a", "int"), ("b", "str"), ("c", "int")]),
    ]
    given = spark.createDataFrame(days, "period int, columns array<struct<column_name: string, type_name: string>>").repartition(3)
    got = drift.baseline_history(given).orderBy("period").collect()
    assert [r.action for r in got] == ["save", "keep", "replace", "fail", "fail", "replace"]
    assert [len(r.baseline) for r in got] == [1, 1, 2, 2, 2, 3]
    assert drift.baseline_history(given.limit(0)).count() == 0


def test_period_snapshots_take_the_newest_type_that_is_not_null(spark):
    rows = [(1, 1, '{"x": 1, ":id": 2}'), (1, 2, '{"x": "s"}'), (1, 3, '{"x": null, "y": null}'), (2, 4, "no json"), (2, 5, '{"x": 1.5}')]
    df = spark.createDataFrame(rows, "day int, at int, j string")
    got = {r.period: [tuple(c) for c in r["columns"]] for r in drift.period_snapshots(df, F.col("day"), "j", ["at"]).collect()}
    assert got == {1: [("x", "str")], 2: [("x", "float")]}


def test_dry_run_sees_every_partition(spark, tmp_dir):
    rows = [(k, f"1998-{m:02d}-01 00:00:00", b) for k, (m, b) in enumerate((m, b) for m in range(1, 13) for b in ("Ab", "B", None, "") for _ in range(5))]
    df = spark.createDataFrame(rows, "unique_key long, d string, borough string").select("unique_key", F.to_timestamp_ntz("d").alias("created_date"), "borough")
    path = layout.write_partitioned(df, f"{tmp_dir}/t", sample_per_partition=3)
    assert path.endswith("_test")
    per = layout.read_partitioned(spark, path).groupBy(*layout.PARTITION_COLS).count().collect()
    assert len(per) == 36 and {r["count"] for r in per} == {3}  # the empty and the missing borough share a folder
    again = {r[0] for r in layout.sample_of_each_partition(df.repartition(9), 3, "unique_key").select("unique_key").collect()}
    assert again == {r[0] for r in spark.read.parquet(path).select("unique_key").collect()}


def test_depth_of_overlapping_ranges(spark):
    ranges = spark.createDataFrame([(1, 5), (2, 3), (3, 9), (6, 6), (None, None)], "lo int, hi int")
    row = layout.overlap_depth(ranges, "lo", "hi").first()
    assert (row["greatest_depth"], row["mean_depth"]) == (3, 2.0)  # at 1, 2, 3 and 6: 1, 2, 3, 2
    by = layout.overlap_depth(ranges.withColumn("p", F.col("lo") > 2), "lo", "hi", ["p"]).where("p").first()
    assert by["greatest_depth"] == 2


def test_few_values_count_as_much_in_the_z_order(spark):
    df = spark.range(4096).select((F.col("id") % 2).cast("string").alias("few"), F.col("id").alias("many"))
    quarters = layout.with_zorder(df, ["few", "many"], bits=4).groupBy(F.shiftright("_z", 6).alias("quarter"))  # the first bit of each column
    assert sorted(r["n"] for r in quarters.agg(F.count_distinct("few").alias("n")).collect()) == [1, 1, 1, 1]


def test_a_failing_version_is_not_published(spark, tmp_dir):
    checks = [quality.Check("rows", "row_count_gt", None, 2)]
    assert published(spark, "v_test") is None
    publish(spark.range(5), "v_test", checks, tmp_dir)
    with pytest.raises(quality.QualityGateError):
        publish(spark.range(1), "v_test", checks, tmp_dir)
    assert spark.table("v_test").count() == 5
    publish(spark.range(9), "v_test", checks, tmp_dir)
    assert spark.sql("SELECT count(*) FROM v_test").first()[0] == 9
    assert spark.read.parquet(published(spark, "v_test")).count() == 9


def test_runs_count_what_they_read(spark, tmp_dir):
    df = spark.createDataFrame([(1, "ab"), (2, None), (3, "é")], "a long, s string")
    assert run_metrics.measured(df, "full", lambda d: d.write.parquet(f"{tmp_dir}/out")) == ("full", 3, 28)
    assert run_metrics.measured(df.limit(0), "none", lambda d: d.write.parquet(f"{tmp_dir}/none")) == ("none", 0, 0)
    metrics = spark.createDataFrame([("full_refresh", 10, 100), ("incremental", 4, 25)], run_metrics.SCHEMA)
    layout.write_metrics(metrics, f"{tmp_dir}/m")
    row = run_metrics.run_savings(run_metrics.read_metrics(spark, f"{tmp_dir}/m")).first()
    assert (row["rows_reduction_pct"], row["bytes_reduction_pct"]) == (60.0, 75.0)


def test_unmeasured_cells_are_pending(spark):
    wide = spark.createDataFrame([("raw", 10, 4), ("raw", 30, 4), ("z", 5, None)], "storage_format string, q1 long, q2 long")
    medians = benchmarks.median_values(benchmarks.unpivoted(wide, ["q1", "q2"]))
    got = {(r["query"], r["storage_format"]): (r["time_label"], r["speedup_label"]) for r in benchmarks.stage_comparison(medians, ["raw", "z"], "raw", "%.0f rows").collect()}
    assert got == {("q1", "raw"): ("20 rows", ""), ("q1", "z"): ("5 rows", "(4.0x faster)"), ("q2", "raw"): ("4 rows", ""), ("q2", "z"): ("PENDING", "")}


def test_disorder_is_seen_between_blocks_of_a_large_file(spark, tmp_dir):
    values = [1, 3, 2, 5, 4, 4, None, 3, 9, 8]
    spark.createDataFrame([(v,) for v in values], "a long").coalesce(1).write.parquet(f"{tmp_dir}/t")
    for size in (1, 2, 3, 4, 100):
        row = numbering.disorder_in_files(spark.read.parquet(f"{tmp_dir}/t"), "a", block_rows=size).first()
        assert (row["rows"], row["out_of_order"]) == (10, 3), size
    plan = numbering.disorder_in_files(spark.read.parquet(f"{tmp_dir}/t"), "a", block_rows=2)._jdf.queryExecution().executedPlan().toString()
    assert "block" in plan.split("Window", 1)[1]
