"""Scans and seed dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The documented SLA targets seed (complaint_type,
# responsible_agency, target_days).
REFERENCE_SLA_TARGETS: tuple[tuple[str, str, int], ...] = (
    ("HEAT/HOT WATER", "HPD", 7),
    ("NOISE - RESIDENTIAL", "NYPD", 3),
    ("UNSANITARY CONDITION", "DOHMH", 10),
    ("ILLEGAL PARKING", "NYPD", 1),
    ("WATER LEAK", "DEP", 14),
    ("RODENT", "DOHMH", 7),
    ("STREET CONDITION", "DOT", 30),
    ("SIDEWALK CONDITION", "DOT", 45),
    ("BROKEN MUNI METER", "DOT", 3),
    ("ELEVATOR", "HPD", 1),
)

TARGETS_SCHEMA = T.StructType(
    [
        T.StructField("complaint_type", T.StringType(), False),
        T.StructField("responsible_agency", T.StringType(), True),
        T.StructField("target_days", T.IntegerType(), False),
    ]
)


def read_raw(spark: SparkSession, path: str, glob: str | None = "*.parquet") -> DataFrame:
    """Flat landing directory of Parquet files (no partition folders)."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def read_table(
    spark: SparkSession,
    ref: str,
    fmt: str = "parquet",
    columns: Sequence[str] | None = None,
    where: Column | str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Scan a table by format with optional projection and filter.

    The projection and the predicate are plain DataFrame operations, so
    Catalyst prunes the read schema and pushes the filter into the scan
    (``PushedFilters``/``PartitionFilters`` in ``explain``).
    """
    df = spark.read.format(fmt).options(**(options or {})).load(ref)
    if where is not None:
        df = df.where(where)
    if columns is not None:
        df = df.select(*columns)
    return df


def literal_frame(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """A small in-memory table as a JVM-only plan (inline literal array).

    Unlike ``createDataFrame(list)`` this does not go through a Python RDD,
    so scanning or broadcasting it never starts Python workers.
    """
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)]) for row in rows
    ]
    if not structs:
        return spark.createDataFrame([], schema)
    return spark.range(1).select(F.inline(F.array(*structs)))


def targets_frame(spark: SparkSession, rows: Iterable[tuple[str, str, int]] = REFERENCE_SLA_TARGETS) -> DataFrame:
    """Seed dimension from in-memory rows (bounded by construction)."""
    return literal_frame(spark, list(rows), TARGETS_SCHEMA)


def load_targets(spark: SparkSession, path: str) -> DataFrame:
    """Typed CSV seed with a header, schema declared (no inference)."""
    return spark.read.schema(TARGETS_SCHEMA).option("header", True).option("mode", "FAILFAST").csv(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a DataFrame to ``spark.sql`` under ``name``."""
    df.createOrReplaceTempView(name)
    return df
