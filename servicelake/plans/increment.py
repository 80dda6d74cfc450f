"""A daily run whose work follows the increment.

New files are read once, by a stream.  Each batch is merged into the stored
requests (``operators.keyed``: only slots with changed keys are written), and
its changes go to the counts that the performance fact is made of
(``operators.increments``).  Facts are then computed from the counts, whose size
follows groups and days, checked, and shown to readers only if they pass.

Every step may be repeated: a batch is applied from its written changes, a
change set counts once, a view moves only to a checked version.  A run that
failed is finished by the next (but for a driver lost while slots are put in
place, see ``operators.keyed``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from servicelake.functions.clean import type_requests
from servicelake.operators import increments, keyed, quality, sla
from servicelake.plans.publish import publish
from servicelake.session import path_exists
from servicelake.streaming.upsert import upsert_available


@dataclass
class IncrementConfig:
    incoming_path: str
    incoming_schema: T.StructType
    root: str
    views: tuple[str, str]
    year_cap: int
    key: str = "unique_key"
    order: tuple[str, ...] = ("closed_date",)
    slots: int = 16
    buckets: int = 8
    max_files_per_trigger: int | None = None
    performance_checks: list[quality.Check] = field(default_factory=quality.gold_suite)
    trends_checks: list[quality.Check] = field(default_factory=quality.trends_suite)

    @property
    def counts(self) -> str:
        return f"{self.root.rstrip('/')}/counts"

    def requests(self, spark: SparkSession) -> keyed.KeyedTable:
        """The stored requests: the latest row of each key, typed."""
        typed = type_requests(spark.createDataFrame([], self.incoming_schema)).schema
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in typed.fields])
        return keyed.KeyedTable(spark, f"{self.root.rstrip('/')}/requests", schema, [self.key], list(self.order), self.slots, self.buckets)


def run_increment(spark: SparkSession, cfg: IncrementConfig, targets: DataFrame) -> int:
    """Merge what has arrived, let counts and facts follow, check and publish both facts; returns the batches merged."""

    def enrich(rows: DataFrame) -> DataFrame:
        return sla.enrich(sla.stage_requests(rows), targets)

    def follow(changes: DataFrame, change_id: str) -> None:
        increments.add(cfg.counts, change_id, increments.signed_histogram(changes, enrich))

    batches = upsert_available(
        spark,
        cfg.incoming_path,
        cfg.incoming_schema,
        cfg.requests(spark),
        f"{cfg.root.rstrip('/')}/checkpoint",
        stream="arrivals",
        max_files_per_trigger=cfg.max_files_per_trigger,
        transform=type_requests,
        on_changes=follow,
    )
    if path_exists(spark, cfg.counts):
        performance, trends = cfg.views
        publish(increments.performance(spark, cfg.counts), performance, cfg.performance_checks, f"{cfg.root.rstrip('/')}/published")
        publish(sla.sla_trends(spark.table(performance), cfg.year_cap), trends, cfg.trends_checks, f"{cfg.root.rstrip('/')}/published")
    return batches
