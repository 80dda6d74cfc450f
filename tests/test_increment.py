import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from servicelake.functions.clean import type_requests
from servicelake.operators import increments, keys, quality, sla, verify
from servicelake.plans.increment import IncrementConfig, run_increment
from servicelake.sources.fixtures import FIXTURE_YEAR_CAP, fixture_targets, raw_requests
from tests.conftest import SF_SMALL

ANY_ROWS = [quality.Check("any rows", "row_count_gt", None, 0)]


def test_a_failed_run_is_finished_by_the_next(spark, tmp_dir, monkeypatch):
    raw = raw_requests(spark, SF_SMALL).cache()
    targets = fixture_targets(spark)
    cfg = IncrementConfig(f"{tmp_dir}/incoming", raw.schema, tmp_dir, ("perf_inc", "trends_inc"), FIXTURE_YEAR_CAP, slots=2, buckets=2, performance_checks=ANY_ROWS, trends_checks=ANY_ROWS)

    def arrive(load):
        raw.where(F.col("load_id") == load).coalesce(1).write.mode("append").parquet(cfg.incoming_path)

    def latest(loads):
        return keys.dedupe_latest(type_requests(raw.where(F.col("load_id").isin(loads))), "unique_key", ["closed_date"])

    def right(loads, stored=None):
        """Readers see the facts of these loads; what is stored may be ahead of them."""
        fact = sla.sla_performance(sla.enrich(sla.stage_requests(latest(loads)), targets))
        assert verify.content_difference(spark.table("perf_inc").select(*fact.columns), fact).count() == 0
        trends = sla.sla_trends(fact, FIXTURE_YEAR_CAP)
        assert verify.content_difference(spark.table("trends_inc").select(*trends.columns), trends).count() == 0
        rows = cfg.requests(spark).read()
        assert verify.content_difference(rows.select(*raw.columns), latest(stored or loads).select(*raw.columns)).count() == 0

    arrive(0)
    assert run_increment(spark, cfg, targets) == 1
    right([0])
    assert run_increment(spark, cfg, targets) == 0  # nothing new
    right([0])
    arrive(1)
    add = increments.add
    with monkeypatch.context() as m:  # lost after the merge, before the counts
        m.setattr(increments, "add", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(StreamingQueryException):
            run_increment(spark, cfg, targets)
    with monkeypatch.context() as m:  # lost after the counts, before the stream's commit
        m.setattr(increments, "add", lambda *a: (add(*a), (_ for _ in ()).throw(RuntimeError("lost"))))
        with pytest.raises(StreamingQueryException):
            run_increment(spark, cfg, targets)
    right([0], stored=[0, 1])
    assert run_increment(spark, cfg, targets) == 1
    right([0, 1])
    arrive(2)
    cfg.performance_checks = [quality.Check("rows", "row_count_gt", None, 10**6)]
    with pytest.raises(quality.QualityGateError):
        run_increment(spark, cfg, targets)
    right([0, 1], stored=[0, 1, 2])  # the rejected facts are not shown
    cfg.performance_checks = ANY_ROWS
    run_increment(spark, cfg, targets)
    right([0, 1, 2])
