import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from servicelake.operators import layout, verify
from servicelake.plans.gold import fixture_typed
from tests.conftest import SF_SMALL


def _typed(spark):
    return fixture_typed(spark, SF_SMALL)


def test_partitioned_write_and_derived_predicates(spark, tmp_dir):
    typed = _typed(spark)
    path = layout.write_partitioned(typed, f"{tmp_dir}/part")
    back = spark.read.parquet(path)
    assert back.count() == typed.count()
    files = layout.partition_file_counts(spark, path)
    assert files.agg(F.max("files")).first()[0] == 1  # one file per partition value
    # derived predicates never drop matching rows (superset filter)
    cond = (F.col("borough") == "ASIA") & (F.col("created_date") >= F.lit("1998-01-01").cast("timestamp_ntz")) & (
        F.col("created_date") < F.lit("1999-01-01").cast("timestamp_ntz")
    )
    plain = back.where(cond).count()
    pruned = back.where(cond & layout.partition_predicates(("1998-01-01", "1999-01-01"), {"borough": "ASIA"})).count()
    assert plain == pruned == typed.where(cond).count()
    plan = back.where(cond & layout.partition_predicates(("1998-01-01", "1999-01-01"), {"borough": "ASIA"}))._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [", 1)[1].split("], PushedFilters", 1)[0]
    assert "created_month" in filters and "borough_truncated" in filters


def test_sampled_dry_run_goes_to_test_path(spark, tmp_dir):
    path = layout.write_partitioned(_typed(spark), f"{tmp_dir}/silver", sample_rows=50)
    assert path.endswith("_test")
    assert spark.read.parquet(path).count() == 50


def test_zorder_preserves_content_and_clusters(spark, tmp_dir):
    typed = _typed(spark)
    path = layout.write_zordered(typed, f"{tmp_dir}/z", num_partitions=16)
    back = spark.read.parquet(path).select(*typed.columns)
    assert verify.content_parity(typed, back).first().equal
    assert verify.content_difference(typed, back).count() == 0
    z = layout.with_zorder(typed, ["borough", "complaint_type"], bits=4)
    assert z.select(F.min("_z"), F.max("_z")).first()[1] < (1 << 8)


def test_zorder_is_order_preserving_per_column(spark):
    df = spark.createDataFrame([(f"v{i:03d}", float(i)) for i in range(300)], "s string, x double")
    bounds = layout.zorder_boundaries(df, ["s", "x"], bits=3)
    z = layout.with_zorder(df, ["s"], bits=3, boundaries=bounds[:1]).orderBy("s").select("_z").collect()
    vals = [r[0] for r in z]
    assert vals == sorted(vals) and len(set(vals)) > 1


def test_skip_report_candidates_cover_matches(spark, tmp_dir):
    path = layout.write_partitioned(_typed(spark), f"{tmp_dir}/p")
    index = layout.file_index(spark, path, ["borough"])
    rep = layout.skip_report(index, equals={"borough": "ASIA"}).first()
    assert rep.passed and rep.skip_pct > 50
    # every file that really holds a match is a candidate
    holders = {r.file_path for r in layout.with_file_path(spark.read.parquet(path)).where(F.col("borough") == "ASIA").select("file_path").distinct().collect()}
    cands = {r.file_path for r in index.where((F.col("borough_min") <= "ASIA") & (F.col("borough_max") >= "ASIA")).collect()}
    assert holders <= cands


def test_file_stats_compaction_and_storage_report(spark, tmp_dir):
    typed = _typed(spark)
    typed.repartition(12).write.parquet(f"{tmp_dir}/small")
    stats = layout.needs_compaction(spark, f"{tmp_dir}/small", partition_cols=[]).first()
    assert stats.files == stats.mergeable_files == 12 and stats.needs_compaction
    rep = {r.stage: r for r in layout.compact(spark, f"{tmp_dir}/small", f"{tmp_dir}/compacted").collect()}
    assert rep["before"].files == 12 and rep["after"].files == 1
    assert spark.read.parquet(f"{tmp_dir}/compacted").count() == typed.count()
    sr = layout.storage_report(spark, [("small", f"{tmp_dir}/small"), ("compacted", f"{tmp_dir}/compacted")]).orderBy("stage").collect()
    assert sr[0].prev_layer is None and sr[1].prev_layer == "small" and sr[1].change_label.endswith("vs previous)")
    assert sr[0].total_reduction_pct == 0.0


def test_count_parity_raises(spark):
    a = spark.range(3)
    b = spark.range(4)
    assert verify.assert_count_parity(a, spark.range(3)) == 3
    try:
        verify.assert_count_parity(a, b)
        raise AssertionError("expected ParityError")
    except verify.ParityError:
        pass
    assert dt is not None


def test_file_stats_skip_logs_and_markers(spark, tmp_dir):
    import os

    spark.range(100).repartition(3).write.parquet(f"{tmp_dir}/t")  # writes _SUCCESS and .crc files too
    os.makedirs(f"{tmp_dir}/t/_delta_log")
    with open(f"{tmp_dir}/t/_delta_log/00000.json", "w") as fh:
        fh.write("{}")
    st = layout.file_stats(spark, f"{tmp_dir}/t").first()
    data = [f for f in os.listdir(f"{tmp_dir}/t") if f.endswith(".parquet")]
    assert st.files == len(data) == 3
    assert st.bytes == sum(os.path.getsize(f"{tmp_dir}/t/{f}") for f in data)


def test_coordinate_disagreement_counts_only_present_pairs(spark):
    parent = spark.createDataFrame([(1, 1.0, 2.0), (2, 1.0, None), (3, 5.0, 5.0), (4, 1.0, 1.0)], "k int, lat double, lon double")
    child = spark.createDataFrame([(1, 1.0, 2.0), (2, 9.0, 9.0), (3, 5.0, 6.0)], "k int, lat double, lon double")
    r = verify.coordinate_disagreement(parent, child, "k", [("lat", "lat"), ("lon", "lon")]).first()
    assert (r.parent_rows, r.matched_rows, r.compared_rows, r.disagreements) == (4, 3, 2, 1)


def test_partition_scoped_compaction_in_place(spark, tmp_dir):
    typed = _typed(spark)
    path = f"{tmp_dir}/silver"
    # three appends: touched partitions end up with several files
    for lo, hi in ((0, 1), (1, 2), (2, 4)):
        layout.write_partitioned(typed.where((F.col("load_id") >= lo) & (F.col("load_id") < hi)), path, mode="append")
    # a partition with a single file must not be rewritten
    lonely = typed.limit(1).withColumn("created_date", F.lit("2030-01-05 00:00:00").cast("timestamp_ntz"))
    layout.write_partitioned(lonely, path, mode="append")
    single_before = sorted(layout.with_file_path(spark.read.parquet(path)).where(F.col("created_month") == "2030-01-01").select("file_path").distinct().collect())
    rep = {r.stage: r for r in layout.compact_partitions(spark, path, f"{tmp_dir}/scratch").collect()}
    assert rep["after"].files < rep["before"].files
    back = spark.read.parquet(path)
    assert layout.partition_file_counts(spark, path).agg(F.max("files")).first()[0] == 1
    expected = typed.unionByName(lonely)
    assert verify.content_difference(back.select(*typed.columns), expected).count() == 0
    single_after = sorted(layout.with_file_path(spark.read.parquet(path)).where(F.col("created_month") == "2030-01-01").select("file_path").distinct().collect())
    assert single_before == single_after
    # a second call finds nothing to do, and a compacted table of many files does not trigger
    again = {r.stage: r for r in layout.compact_partitions(spark, path, f"{tmp_dir}/scratch2").collect()}
    assert again["before"] == layout_row(again["after"], "before") and not os.path.exists(f"{tmp_dir}/scratch2")
    assert not layout.needs_compaction(spark, path).first().needs_compaction


def layout_row(row, stage):
    from pyspark.sql import Row

    return Row(stage=stage, files=row.files, bytes=row.bytes)


def test_compaction_honours_the_target_size_and_converges(spark, tmp_dir):
    typed = _typed(spark).withColumn("created_date", F.lit("1998-03-04").cast("timestamp_ntz")).withColumn("borough", F.lit("ASIA"))
    path = f"{tmp_dir}/silver"
    for k in range(4):
        typed.where(F.col("unique_key") % 4 == k).repartition(3).transform(layout.with_partition_columns).write.mode("append").partitionBy(*layout.PARTITION_COLS).parquet(path)
    size = layout.file_stats(spark, path).first().bytes
    target = size // 3
    rep = {r.stage: r for r in layout.compact_partitions(spark, path, f"{tmp_dir}/s1", target_file_bytes=target).collect()}
    assert rep["before"].files == 12 and 2 <= rep["after"].files <= 4
    again = {r.stage: r for r in layout.compact_partitions(spark, path, f"{tmp_dir}/s2", target_file_bytes=target).collect()}
    assert again["before"].files == again["after"].files == rep["after"].files
    back = layout.read_partitioned(spark, path)
    assert verify.content_difference(back.select(*typed.columns), typed).count() == 0
    # Z-order within the partition: files hold narrow ranges of the category
    index = layout.file_index(spark, path, ["complaint_type"])
    assert index.where("complaint_type_min = complaint_type_max").count() + 1 >= 1
    assert index.agg(F.count_distinct("complaint_type_min")).first()[0] > 1


def test_interrupted_compaction_is_finished(spark, tmp_dir, monkeypatch):
    typed = _typed(spark)
    path = f"{tmp_dir}/silver"
    for k in range(2):
        layout.write_partitioned(typed.where(F.col("unique_key") % 2 == k), path, mode="append")

    def lost(*args):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(layout, "_replace_partitions", lost)
    with pytest.raises(RuntimeError):
        layout.compact_partitions(spark, path, f"{tmp_dir}/scratch")
    monkeypatch.undo()
    # half of the replaced directories are gone
    copied = sorted(f"{m}/{b}" for m in os.listdir(f"{tmp_dir}/scratch") if "=" in m for b in os.listdir(f"{tmp_dir}/scratch/{m}") if "=" in b)
    for d in copied[::2]:
        shutil.rmtree(f"{path}/{d}")
    assert layout.recover_compaction(spark, path)
    assert not layout.recover_compaction(spark, path)
    assert verify.content_difference(layout.read_partitioned(spark, path).select(*typed.columns), typed).count() == 0
    assert layout.partition_file_counts(spark, path).agg(F.max("files")).first()[0] == 1


def test_text_z_order_uses_whole_values(spark):
    names = ["NOISE - RESIDENTIAL", "NOISE - STREET/SIDEWALK", "NOISE - VEHICLE", "NOISE - COMMERCIAL", "HEAT/HOT WATER", "RODENT"]
    df = spark.createDataFrame([(n,) for n in names * 5], "complaint_type string")
    z = layout.with_zorder(df, ["complaint_type"], bits=8)
    assert [r.complaint_type for r in z.distinct().orderBy("_z").collect()] == sorted(names)
    assert z.select("_z").distinct().count() == 6
    many = spark.range(40_000).select(F.concat(F.lit("common prefix "), F.lpad("id", 6, "0")).alias("s"))
    z = layout.with_zorder(many, ["s"], bits=4)
    rows = z.groupBy("_z").agg(F.count("*").alias("n"), F.min("s").alias("a"), F.max("s").alias("b")).orderBy("_z").collect()
    assert len(rows) >= 12 and all(x.b < y.a for x, y in zip(rows, rows[1:])) and max(r.n for r in rows) < 8000


def test_hot_z_value_makes_several_files(spark, tmp_dir):
    typed = _typed(spark).withColumns({"created_date": F.lit("1998-03-04").cast("timestamp_ntz"), "borough": F.lit("ASIA"), "complaint_type": F.lit("X")})
    path = layout.write_zordered(typed, f"{tmp_dir}/z", num_partitions=8)
    assert layout.file_stats(spark, path).first().files >= 6


def test_empty_key_and_digit_prefixes(spark, tmp_dir):
    rows = [(1, "1998-01-02", ""), (2, "1998-01-03", "7TH"), (3, "1998-01-04", "8TH"), (4, "1998-01-05", None)]
    df = spark.createDataFrame(rows, "k int, created_date string, borough string").withColumn("created_date", F.col("created_date").cast("timestamp_ntz"))
    path = layout.write_partitioned(df, f"{tmp_dir}/p")
    back = layout.read_partitioned(spark, path)
    assert dict(back.dtypes)["borough_truncated"] == "string" and dict(back.dtypes)["created_month"] == "date"
    for value, keys_ in (("", [1]), ("7TH", [2])):
        got = back.where((F.col("borough") == value) & layout.partition_predicates(None, {"borough": value})).select("k").collect()
        assert [r.k for r in got] == keys_


def test_tables_that_are_sorted_as_they_are_read_are_read_in_small_splits(spark, tmp_dir):
    from servicelake.session import split_session

    most, name = 8 << 20, "spark.sql.files.maxPartitionBytes"
    path = layout.write_partitioned(_typed(spark), f"{tmp_dir}/p")
    assert int(layout.file_index(spark, path, ["borough"]).sparkSession.conf.get(name)) <= most
    assert split_session(spark).conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert split_session(spark).conf.get(name) != spark.conf.get(name)
    spark.range(300_000).coalesce(1).write.option("parquet.block.size", 100_000).parquet(f"{tmp_dir}/one")
    assert split_session(spark, 200_000).read.parquet(f"{tmp_dir}/one").rdd.getNumPartitions() > spark.read.parquet(f"{tmp_dir}/one").coalesce(1).rdd.getNumPartitions()


def test_landing_records_are_joined_once(spark):
    from servicelake.plans import registry

    path = registry._landed(spark, SF_SMALL)
    assert registry._landed(spark, SF_SMALL) == path
    assert path in registry._raw(spark, SF_SMALL).inputFiles()[0]
    assert verify.content_parity(_typed(spark), registry._typed(spark, SF_SMALL)).first().equal


def test_shuffles_follow_the_landing_records(spark, monkeypatch):
    from servicelake import session
    from servicelake.plans import registry
    from servicelake.sources.fixtures import table

    assert [session.partitions_for(n) for n in (0, 1, 250_000, 250_001, 1_000_000, 1_000_001)] == [1, 1, 1, 2, 4, 8]
    name = "spark.sql.shuffle.partitions"
    own = spark.conf.get(name)
    monkeypatch.setattr(registry, "_ROWS", {})
    assert registry._sized(spark, SF_SMALL).conf.get(name) == own  # few rows: no fewer than the session's
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    assert int(registry._sized(spark, SF_SMALL).conf.get(name)) == session.partitions_for(table(spark, SF_SMALL, "lineitem").count()) > int(own)
    assert spark.conf.get(name) == own


def test_a_stored_table_is_not_copied_for_its_z_order(spark, tmp_dir, monkeypatch):
    rows = _typed(spark)
    rows.write.parquet(f"{tmp_dir}/typed")
    monkeypatch.setattr(layout, "remove_path", lambda *a: (_ for _ in ()).throw(AssertionError("a copy was made")))
    path = layout.write_zordered(spark.read.parquet(f"{tmp_dir}/typed"), f"{tmp_dir}/z", stored=True)
    assert verify.content_parity(rows, spark.read.parquet(path).select(*rows.columns)).first().equal
