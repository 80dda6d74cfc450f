"""Metrics that a run takes of itself (A11, S11): rows and bytes counted while they are read, without a pass of their own.

``DataFrame.observe`` adds the counters to the plan of the run.  A task that is
repeated after a lost executor may be counted again, so these are measures of
work done, not of content.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicelake.functions.sla import relative_saving

SCHEMA = "mode string, rows_read bigint, bytes_scanned bigint"


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: the length of texts (NULL: none), eight for any other."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    fixed = F.lit(8 * (len(df.columns) - len(texts))).cast("bigint")
    return reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(c), F.lit(0)) for c in texts], fixed)


def measured(df: DataFrame, mode: str, run: Callable[[DataFrame], None]) -> tuple[str, int, int]:
    """Run an action over ``df``; (mode, rows, bytes) of what it read of it."""
    seen = Observation()
    run(df.observe(seen, F.count(F.lit(1)).alias("rows_read"), F.sum(row_bytes(df)).alias("bytes_scanned")))
    found = seen.get
    return mode, found["rows_read"], found["bytes_scanned"] or 0


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The records that ``layout.write_metrics`` has written."""
    return spark.read.schema(SCHEMA).json(path)


def run_savings(metrics: DataFrame) -> DataFrame:
    """Rows and bytes of full and of incremental runs, and the share that the latter save, in percent (one row)."""
    def of(mode: str, column: str) -> Column:
        return F.sum(F.when(F.col("mode") == mode, F.col(column)))

    out = metrics.agg(
        of("full_refresh", "rows_read").alias("full_refresh_rows"),
        of("incremental", "rows_read").alias("incremental_rows"),
        of("full_refresh", "bytes_scanned").alias("full_refresh_bytes"),
        of("incremental", "bytes_scanned").alias("incremental_bytes"),
    )
    return out.withColumns({f"{what}_reduction_pct": relative_saving(f"full_refresh_{what}", f"incremental_{what}") for what in ("rows", "bytes")})
