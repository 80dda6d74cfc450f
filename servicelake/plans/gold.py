"""Landing -> silver -> staging -> enriched -> gold, as lazy DataFrames.

``fixture_*`` functions build each stage from the driver's test tables so
that every registered query reads the given tables.  ``build_gold`` is the
production shape: it writes the performance fact, then computes the trends
fact from the *written* table (the trends model reads the performance
table, and reading it back cuts the lineage instead of recomputing it).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from servicelake.functions.clean import type_requests
from servicelake.operators import sla
from servicelake.sources.fixtures import fixture_targets, raw_requests


def fixture_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_requests(raw_requests(spark, sf_dir))


def fixture_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sla.stage_requests(fixture_typed(spark, sf_dir))


def fixture_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sla.enrich(fixture_staged(spark, sf_dir), fixture_targets(spark))


def fixture_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sla.sla_performance(fixture_enriched(spark, sf_dir))


@dataclass
class GoldTables:
    performance_path: str
    trends_path: str


def build_gold(
    spark: SparkSession,
    staged: DataFrame,
    targets: DataFrame,
    out_dir: str,
    year_cap: int,
    fmt: str = "parquet",
) -> GoldTables:
    """M4/M5: full rebuild of both facts.  The enriched stage stays inline."""
    perf_path = f"{out_dir.rstrip('/')}/fct_sla_performance"
    trends_path = f"{out_dir.rstrip('/')}/fct_sla_trends"
    sla.sla_performance(sla.enrich(staged, targets)).write.mode("overwrite").format(fmt).save(perf_path)
    perf = spark.read.format(fmt).load(perf_path)
    sla.sla_trends(perf, year_cap).write.mode("overwrite").format(fmt).save(trends_path)
    return GoldTables(perf_path, trends_path)


def register_views(spark: SparkSession, staged: DataFrame, targets: DataFrame, year_cap: int) -> dict[str, DataFrame]:
    """Expose every stage to ``spark.sql`` under the model names.

    ``fct_sla_trends`` is defined over the *view* ``fct_sla_performance``;
    register a stored performance table under that name (``build_gold``)
    when both facts are queried repeatedly.
    """
    enriched = sla.enrich(staged, targets)
    views = {"stg_requests": staged, "sla_targets": targets, "int_requests_enriched": enriched}
    views["fct_sla_performance"] = sla.sla_performance(enriched)
    views["fct_sla_trends"] = sla.sla_trends(views["fct_sla_performance"], year_cap)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
