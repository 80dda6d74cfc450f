import os

import pytest

from servicelake.operators import drift


def test_json_key_types_first_non_null_newest_first(spark):
    recs = [
        (3, '{"a": null, "b": 1, ":geo": 5}'),
        (2, '{"a": "x", "b": 1.5, "c": [1]}'),
        (1, '{"a": 7, "d": {"x": 1}, "e": true}'),
        (0, '{"n": null}'),
        (-1, "not json"),
    ]
    df = spark.createDataFrame(recs, "id bigint, rec string")
    got = {r.column_name: r.type_name for r in drift.json_key_types(df, "rec", ["id"]).collect()}
    assert got == {"a": "str", "b": "int", "c": "list", "d": "dict", "e": "bool", "n": "NoneType"}
    newest_two = {r.column_name for r in drift.json_key_types(df, "rec", ["id"], sample=1).collect()}
    assert newest_two == {"a", "b"}


def _snap(spark, pairs):
    return spark.createDataFrame(pairs, "column_name string, type_name string")


def test_diff_and_verdicts(spark):
    old = _snap(spark, [("a", "str"), ("b", "int"), ("c", "str"), (":geo", "str")])
    new = _snap(spark, [("a", "str"), ("b", "float"), ("d", "str")])
    diff = {r.column_name: r.change for r in drift.schema_diff(old, new).collect()}
    assert diff == {"b": "type_changed", "c": "removed", "d": "added"}
    v = drift.drift_verdict(drift.schema_diff(old, new)).first()
    assert v.is_breaking
    assert v.description == "columns removed: ['c']; type changes: b: int -> float"


def test_baseline_lifecycle(spark, tmp_dir):
    path = f"{tmp_dir}/baseline"
    base = _snap(spark, [("a", "str"), ("b", "int")])
    assert drift.apply_baseline(spark, base, path)[0] == "save"
    assert drift.apply_baseline(spark, base, path)[0] == "keep"
    added = _snap(spark, [("a", "str"), ("b", "int"), ("c", "str")])
    action, desc = drift.apply_baseline(spark, added, path)
    assert action == "replace" and desc == "new optional columns added: ['c']"
    assert drift.read_baseline(spark, path).count() == 3
    removed = _snap(spark, [("a", "str")])
    action, _ = drift.apply_baseline(spark, removed, path)
    assert action == "fail"
    assert drift.read_baseline(spark, path).count() == 3  # breaking change keeps the old baseline


def test_snapshots_from_schema_and_records(spark):
    import datetime as dt

    df = spark.createDataFrame([(1, "a", 2.5, dt.datetime(2024, 1, 1)), (2, None, None, None)], "k bigint, s string, x double, t timestamp_ntz")
    snap = {r.column_name: r.type_name for r in drift.schema_snapshot(spark, df).collect()}
    assert snap == {"k": "bigint", "s": "string", "x": "double", "t": "timestamp_ntz"}
    rec = drift.records_as_json(df, keep=["k"])
    kinds = {r.column_name: r.type_name for r in drift.json_key_types(rec, "record", ["k"]).collect()}
    assert kinds == {"k": "int", "s": "str", "x": "float", "t": "str"}


def test_unreadable_baseline_raises(spark, tmp_dir):
    path = f"{tmp_dir}/baseline"
    base = _snap(spark, [("a", "str"), ("b", "int")])
    saved = drift.save_baseline(base, path)
    for name in os.listdir(saved):
        if name.endswith(".parquet"):
            with open(f"{saved}/{name}", "wb") as fh:
                fh.write(b"torn")
            os.remove(f"{saved}/.{name}.crc")
    with pytest.raises(Exception, match="(?i)parquet|footer|read"):
        drift.apply_baseline(spark, _snap(spark, [("a", "str")]), path)
    assert len([d for d in os.listdir(path) if d.startswith("v-")]) == 1


def test_file_schema_snapshot_reads_just_these_files(spark, tmp_dir):
    spark.range(3).selectExpr("id", "cast(id as string) as s").coalesce(1).write.parquet(f"{tmp_dir}/a")
    spark.range(3).selectExpr("id", "cast(id as int) as t").coalesce(1).write.parquet(f"{tmp_dir}/b")
    files = {d: [f"{tmp_dir}/{d}/{f}" for f in os.listdir(f"{tmp_dir}/{d}") if f.endswith(".parquet")] for d in "ab"}
    snap = lambda names: {r.column_name: r.type_name for r in drift.file_schema_snapshot(spark, names).collect()}
    assert snap(files["a"]) == {"id": "bigint", "s": "string"}
    assert snap(files["a"] + files["b"]) == {"id": "bigint", "s": "string", "t": "int"}
    assert drift.file_schema_snapshot(spark, []) is None
    with pytest.raises(Exception, match="(?i)path|exist"):
        drift.file_schema_snapshot(spark, [f"{tmp_dir}/none.parquet"])


def test_kinds_of_a_key_are_settled_without_dealing_rows_by_key(spark):
    rows = [(1, 1, '{"a": "s", "b": 1, "c": null}'), (2, 1, '{"a": 1, "b": "s", "c": null}'), (2, 2, '{"a": null, "b": 1.5}'), (None, 9, '{"a": true, "n": 1}'), (None, 10, '{"n": "s"}')]
    df = spark.createDataFrame(rows, "at long, seq long, j string")
    found = drift.json_key_types(df, "j", ["at", "seq"])
    # b: two kinds share the newest time, the later number decides; n: only rows without a time
    assert {r.column_name: r.type_name for r in found.collect()} == {"a": "int", "b": "float", "c": "NoneType", "n": "str"}
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
