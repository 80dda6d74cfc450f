"""Scale guards on the physical plans of every registered query."""

import pytest

from servicelake.plans.registry import REGISTRY as QUERIES
from tests.conftest import SF_SMALL

# Layout queries write files when called; their read-back plans are trivial.
WRITES = {
    "partition_rows", "partition_file_counts", "partitioned_bench_c", "zorder_content", "file_index",
    "skip_report", "storage_report", "compaction_report", "layer_parity", "ingest_available",
    "reader_parity", "compaction_needed", "partition_compaction_report",
}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_python_udf_no_single_partition_window_no_cartesian(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if "Window" in plan:
        assert "SinglePartition" not in plan


def test_gold_plan_is_partially_aggregated(spark):
    plan = _plan(QUERIES["sla_performance"](spark, SF_SMALL))
    assert plan.count("HashAggregate") >= 2  # partial + final around one exchange


def test_selective_scan_pushes_filters(spark):
    df = QUERIES["partitioned_bench_c"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    filters = text.split("PartitionFilters: [", 1)[1].split("], PushedFilters", 1)[0]
    assert "created_month" in filters and "borough_truncated" in filters


def test_size_probe_sends_one_row_of_each_task(spark):
    from servicelake.operators.joins import size_in_bytes

    df = spark.range(0, 1000, 1, 8).selectExpr("id", "cast(id as string) s")
    assert size_in_bytes(df) == 1000 * 8 * 3 + sum(len(str(k)) for k in range(1000))
    plan = _plan(df.agg({"id": "count"}))
    assert plan.count("HashAggregate") >= 2 and "Limit" not in plan


def test_upsert_reads_its_source_twice(spark, tmp_dir):
    from servicelake.operators import merge

    spark.range(100).selectExpr("id k", "id v").write.parquet(f"{tmp_dir}/t")
    spark.range(50, 150).selectExpr("id k", "id v").write.parquet(f"{tmp_dir}/s")
    plan = _plan(merge.upsert(spark.read.parquet(f"{tmp_dir}/t"), spark.read.parquet(f"{tmp_dir}/s"), "k", ["v"]))
    assert plan.count("FileScan parquet") <= 3 and plan.count(f"{tmp_dir}/s]") <= 2
