import glob
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from servicelake.operators import increments, keyed, merge
from servicelake.operators.keys import dedupe_latest
from servicelake.streaming.upsert import upsert_available

SCHEMA = "k long, part string, at long, v string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(table):
    return {f: (os.stat(f).st_mtime_ns, os.stat(f).st_size) for f in glob.glob(f"{table.rows_path}/*/*.parquet")}


def make(spark, path, rows, **kw):
    return keyed.create(spark, path, spark.createDataFrame(rows, SCHEMA), ["k", "part"], ["at"], **{"slots": 8, "buckets": 2, **kw})


def test_only_touched_slots_are_written(spark, tmp_dir):
    table = make(spark, f"{tmp_dir}/t", [(k, "a", 1, f"v{k}") for k in range(500)])
    before = files(table)
    source = spark.createDataFrame([(7, "a", 2, "new"), (7, "a", 1, "older"), (1000, "b", 1, "more")], SCHEMA)
    changes = table.merge(source, "one")
    assert rows_of(changes.select("old.v", F.col("new.v").alias("n"))) == rows_of(spark.createDataFrame([("v7", "new"), (None, "more")], "v string, n string"))
    after = files(table)
    kept = {f for f in before if before[f] == after.get(f)}
    touched = {f"{table.rows_path}/_slot={s}" for s in table._slots_of(source)}
    assert kept and {os.path.dirname(f) for f in set(before) - kept} == touched
    assert rows_of(table.read()) == rows_of(merge.upsert(spark.createDataFrame([(k, "a", 1, f"v{k}") for k in range(500)], SCHEMA), source, ["k", "part"], ["at"]))
    # the same rows again, under this id or another, write nothing new
    table.merge(source, "two")
    assert files(table) == after
    table.merge(source, "one")
    assert rows_of(table.read().where("k = 7")) == [(7, "a", 2, "new")]


def test_the_table_is_not_shuffled(spark, tmp_dir):
    table = make(spark, f"{tmp_dir}/t", [(k, "a", 1, "v") for k in range(100)])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        new = spark.createDataFrame([(3, "a", 2, "w")], SCHEMA)
        for how in ("left", "full_outer"):
            joined = table._side(new, True, "new").join(table._side(table.read([1, 2]), True, "old"), ["k", "part"], how)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            scan = next(line for line in plan.splitlines() if "FileScan" in line)
            assert "PartitionFilters: [" in scan and "_slot" in scan
            assert "SortMergeJoin" in plan and plan.count("Exchange") == 1  # that of the new rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_null_keys_are_keys(spark, tmp_dir):
    table = make(spark, f"{tmp_dir}/t", [(None, "a", 1, "x"), (None, None, 1, "y"), (1, None, 1, "z"), (1, "a", 1, "w")])
    source = spark.createDataFrame([(None, "a", 2, "x2"), (1, None, 2, "z2"), (2, None, 1, "q")], SCHEMA)
    for name in ("one", "two"):
        table.merge(source, name)
        assert rows_of(table.read()) == sorted([(None, "a", 2, "x2"), (None, None, 1, "y"), (1, None, 2, "z2"), (1, "a", 1, "w"), (2, None, 1, "q")], key=repr)


def test_interrupted_merge_goes_on_from_its_changes(spark, tmp_dir, monkeypatch):
    table = make(spark, f"{tmp_dir}/t", [(k, "a", 1, "v") for k in range(20)])
    source = spark.createDataFrame([(3, "a", 2, "w"), (50, "a", 1, "n")], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(keyed.KeyedTable, "_apply", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.merge(source, "one")
    assert table.read().count() == 20
    changes = table.merge(source.limit(0), "one")  # the written changes count, not what is handed over again
    assert changes.count() == 2 and table.read().count() == 21
    with pytest.raises(merge.SchemaChangeError):
        table.merge(source.withColumn("extra", F.lit(1)), "two")


def test_a_later_session_reads_it(spark, tmp_dir):
    table = make(spark, f"{tmp_dir}/t", [(k, "a", 1, "v") for k in range(20)])
    spark.sql(f"DROP TABLE {table.name}")  # the catalog forgets, the files stay
    again = keyed.KeyedTable(spark, table.path, table.schema, table.keys, table.order, table.slots, table.buckets)
    assert again.read().count() == 20
    assert again.read([0]).count() == spark.read.parquet(f"{table.rows_path}/_slot=0").count()


row = st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.sampled_from(["a", "b", None]), st.integers(0, 3), st.sampled_from(["x", "y", None]))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(row, min_size=1, max_size=8), min_size=2, max_size=3))
def test_latest_merges_equal_one_dedupe(spark, tmp_path_factory, batches):
    """Increments in any order, each twice, with NULL keys."""
    table = keyed.KeyedTable(spark, str(tmp_path_factory.mktemp("keyed")), spark.createDataFrame([], SCHEMA).schema, ["k", "part"], ["at"], slots=2, buckets=1)
    for n, batch in enumerate([*batches, *batches]):
        table.merge(spark.createDataFrame(batch, SCHEMA), f"m{n}", latest=True)
    whole = dedupe_latest(spark.createDataFrame([r for b in batches for r in b], SCHEMA), ["k", "part"], ["at"])
    assert rows_of(table.read()) == rows_of(whole)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, max_size=8), st.lists(row, max_size=8))
def test_upsert_is_idempotent_with_null_keys(spark, target, source):
    t = dedupe_latest(spark.createDataFrame(target, SCHEMA), ["k", "part"], ["at"])
    s = spark.createDataFrame(source, SCHEMA)
    once = merge.upsert(t, s, ["k", "part"], ["at"])
    assert rows_of(merge.upsert(once, s, ["k", "part"], ["at"])) == rows_of(once)
    assert merge.changed_rows(once, once, ["k", "part"], ["at", "v"]).count() == 0


def test_stream_of_files(spark, tmp_dir):
    """Several batches, a lost checkpoint, and changes handed on once for each batch."""
    for k in range(3):
        spark.createDataFrame([(i, "a", k, f"{k}") for i in range(k, k + 5)], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    table = keyed.KeyedTable(spark, f"{tmp_dir}/t", spark.createDataFrame([], SCHEMA).schema, ["k", "part"], ["at"], slots=2, buckets=1)
    seen = {}
    run = lambda ckpt: upsert_available(spark, f"{tmp_dir}/in", table.schema, table, f"{tmp_dir}/{ckpt}", max_files_per_trigger=1, on_changes=lambda c, name: seen.setdefault(name, c.count()))
    assert run("c1") == 3 and run("c1") == 0
    want = sorted([(i, "a", min(i, 2), f"{min(i, 2)}") for i in range(7)], key=repr)
    assert rows_of(table.read()) == want
    assert run("c2") == 3
    assert rows_of(table.read()) == want and len(seen) == 3 and sum(seen.values()) >= 7


def test_counts_follow_and_fold(spark, tmp_dir):
    state = f"{tmp_dir}/state"
    count = lambda rows: spark.createDataFrame(rows, "g string, _n long")
    increments.add(state, "a", count([("x", 3), ("y", 1)]))
    increments.add(state, "b", count([("x", -1), ("y", -1), ("z", 5)]))
    increments.add(state, "b", count([("x", -1), ("y", -1), ("z", 5)]))
    want = [("x", 2), ("z", 5)]
    assert rows_of(increments.histogram(spark, state)) == want
    assert rows_of(increments.histogram(spark, increments.folded(spark, state, f"{tmp_dir}/folded"))) == want


def test_queries_deal_tables_by_their_rows(spark, tmp_dir):
    from servicelake.operators import layout
    from servicelake.plans import stored

    assert stored._dealt(spark.range(10)) == {"slots": 4, "buckets": 4}
    assert stored._dealt(spark.range(7 * stored.BUCKET_ROWS + 1))["buckets"] == 8
    rows = spark.range(0, 100, 1, 12)
    for most, files in ((1000, 1), (30, 4)):
        path = layout.write_landing(rows, f"{tmp_dir}/landing-{most}", rows_per_file=most)
        assert layout.file_stats(spark, path).first().files == files and spark.read.parquet(path).count() == 100


def test_merges_are_dealt_by_the_buckets(spark, tmp_dir):
    """Whatever the session's own number of shuffle partitions is."""
    table = make(spark, f"{tmp_dir}/t", [(k, "a", 1, "v") for k in range(100)], buckets=3)
    changes = table._changes(spark.createDataFrame([(3, "a", 2, "w"), (3, "a", 1, "u"), (None, "a", 1, "n")], SCHEMA).repartition(2), False)
    plan = changes._jdf.queryExecution().executedPlan().toString()
    own = spark.conf.get("spark.sql.shuffle.partitions")
    assert own != "3" and ", 3), ENSURE_REQUIREMENTS" in plan and f", {own}), ENSURE_REQUIREMENTS" not in plan
    assert rows_of(changes.select("new.*")) == [(3, "a", 2, "w"), (None, "a", 1, "n")]
