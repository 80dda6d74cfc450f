"""Layout benchmark queries and their reports (A1, A2, R-1, A7, A11, R-8).

Query A, B and C are defined once and run unchanged on every layout:

* on the raw landing (text columns) dates come from ``try_cast``;
* on typed layouts the bare timestamp column is filtered, so the predicate
  reaches the Parquet scan (``PushedFilters``), and -- for partitioned
  layouts -- the derived partition predicates (L2) prune directories.

Date bounds are half-open ``[start, end)`` on every layout.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicelake.functions.sla import speedup
from servicelake.operators.layout import partition_predicates


def _day(df: DataFrame, col: str, typed: bool) -> Column:
    return F.col(col).cast("date") if typed else F.col(col).try_cast("date")


def _ts_at_least(df: DataFrame, col: str, day: str, typed: bool) -> Column:
    if typed:
        return F.col(col) >= F.lit(day).cast("timestamp_ntz")
    return _day(df, col, False) >= F.lit(day).cast("date")


def _ts_before(df: DataFrame, col: str, day: str, typed: bool) -> Column:
    if typed:
        return F.col(col) < F.lit(day).cast("timestamp_ntz")
    return _day(df, col, False) < F.lit(day).cast("date")


def query_a(df: DataFrame, typed: bool = True, n: int = 20) -> DataFrame:
    """A1/K1: volume and mean day difference per category over closed rows, top n."""
    days = F.datediff(_day(df, "closed_date", typed), _day(df, "created_date", typed))
    return (
        df.where(F.col("closed_date").isNotNull())
        .groupBy("complaint_type")
        .agg(F.count(F.lit(1)).alias("volume"), F.avg(days).alias("avg_resolution_days"))
        .orderBy(F.desc("volume"), F.asc("complaint_type"))
        .limit(n)
    )


def query_b(df: DataFrame, since: str, typed: bool = True, partitioned: bool = False) -> DataFrame:
    """A2: monthly request counts per borough since ``since``."""
    rows = df.where(_ts_at_least(df, "created_date", since, typed))
    if partitioned:
        rows = rows.where(partition_predicates((since, None)))
    return rows.groupBy(
        F.trunc(_day(df, "created_date", typed), "MM").alias("month"), "borough"
    ).agg(F.count(F.lit(1)).alias("requests"))


def query_c(
    df: DataFrame,
    borough: str,
    category: str,
    start: str,
    end: str,
    typed: bool = True,
    partitioned: bool = False,
    columns: list[str] | None = None,
) -> DataFrame:
    """R-1/F3: selective fetch -- one borough, one category, ``[start, end)``."""
    cond = (
        (F.col("borough") == F.lit(borough))
        & (F.col("complaint_type") == F.lit(category))
        & _ts_at_least(df, "created_date", start, typed)
        & _ts_before(df, "created_date", end, typed)
    )
    rows = df.where(cond)
    if partitioned:
        rows = rows.where(partition_predicates((start, end), {"borough": borough}))
    return rows.select(*(columns or df.columns))


def median_timings(timings: DataFrame) -> DataFrame:
    """Median seconds per (layout, query) over repeated runs."""
    return timings.groupBy("storage_format", "query").agg(
        F.median("seconds").alias("median_seconds"),
        F.count(F.lit(1)).alias("runs"),
        F.max("total_rows").alias("result_rows"),
    )


def unpivoted(records: DataFrame, queries: Sequence[str], value: str = "value") -> DataFrame:
    """(storage_format, query, value) of wide records, one column for each query; what was not measured is left out."""
    rows = records.unpivot(["storage_format"], list(queries), "query", value)
    return rows.where(F.col(value).isNotNull())


def median_values(records: DataFrame, value: str = "value") -> DataFrame:
    """A7 for any measure: its median by layout and query."""
    return records.groupBy("storage_format", "query").agg(F.median(value).alias("median_seconds"))


def stage_comparison(medians: DataFrame, layouts: list[str], baseline: str, label: str = "%.2fs") -> DataFrame:
    """R-8: median per query x layout, speedup vs the baseline, ``PENDING`` if missing.

    The expected grid (queries x layouts) is the distinct queries with the
    given layout list attached as an array and exploded (a handful of rows),
    so missing measurements show up as PENDING rows.
    """
    stages = F.array(*[F.struct(F.lit(i).alias("stage"), F.lit(n).alias("storage_format")) for i, n in enumerate(layouts)])
    grid = medians.select("query").distinct().select("query", F.inline(stages))
    base = medians.where(F.col("storage_format") == baseline).select("query", F.col("median_seconds").alias("baseline_seconds"))
    out = grid.join(medians.select("query", "storage_format", "median_seconds"), ["query", "storage_format"], "left").join(
        base, "query", "left"
    )
    return out.select(
        "query",
        "stage",
        "storage_format",
        "median_seconds",
        # The texts of a report's cells.
        F.when(F.col("median_seconds").isNull(), F.lit("PENDING"))
        .otherwise(F.format_string(label, F.col("median_seconds")))
        .alias("time_label"),
        F.when(F.col("storage_format") != F.lit(baseline), speedup("baseline_seconds", "median_seconds")).alias("speedup"),
    ).withColumn(
        "speedup_label",
        F.when(F.col("speedup").isNotNull(), F.format_string("(%.1fx faster)", F.col("speedup"))).otherwise(F.lit("")),
    )


def headline(medians: DataFrame, query: str, baseline: str, best: str) -> DataFrame:
    """R-8 headline: baseline / best-layout ratio for one query (one row)."""
    m = medians.where(F.col("query") == query)
    return m.agg(
        F.max(F.when(F.col("storage_format") == baseline, F.col("median_seconds"))).alias("baseline_seconds"),
        F.max(F.when(F.col("storage_format") == best, F.col("median_seconds"))).alias("best_seconds"),
    ).withColumn("speedup", speedup("baseline_seconds", "best_seconds"))


def incremental_vs_full(run_metrics: DataFrame) -> DataFrame:
    """bytes/rows of incremental vs full-refresh runs and the reduction.

    ``run_metrics`` has ``mode`` (``full_refresh``/``incremental``) and
    ``bytes_scanned`` columns, one row per run.
    """
    from servicelake.functions.sla import relative_saving

    agg = run_metrics.agg(
        F.sum(F.when(F.col("mode") == "full_refresh", F.col("bytes_scanned"))).alias("full_refresh_bytes"),
        F.sum(F.when(F.col("mode") == "incremental", F.col("bytes_scanned"))).alias("incremental_bytes"),
    )
    return agg.withColumn("reduction_percentage", F.coalesce(relative_saving("full_refresh_bytes", "incremental_bytes"), F.lit(0.0)))


def timing_record(storage_format: str, query: str, run: int, seconds: float, files: int | None, rows: int | None) -> tuple:
    return (storage_format, query, run, float(seconds), files, rows, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))


TIMINGS_SCHEMA = (
    "storage_format string, query string, run int, seconds double, files_scanned bigint, "
    "total_rows bigint, timestamp timestamp_ntz"
)
