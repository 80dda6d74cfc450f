"""Incremental file ingest with durable progress.

Replaces a hand-written checkpoint file: a file-source stream with an
explicit schema, drained with ``trigger(availableNow=True)``, writing to a
file sink whose commit log (``_spark_metadata``) and the checkpoint make
reruns exactly-once -- progress is recorded only after the sink commits.
A file's age plays no part: copied or backfilled files with old times are
ingested like others, and a run that leaves out a file that was listed before
it began fails.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicelake.session import path_exists

#: The file source ignores files this much older than the newest one seen; so long that none is.
MAX_FILE_AGE = "365000d"


#: The column of the sink that names the file a row came from.
SOURCE_COL = "_source_file"


class IngestError(RuntimeError):
    """Listed files were not ingested."""


def decoded_path(path: Column) -> Column:
    """A file path as ``_metadata.file_path`` gives it, without URL encoding."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _plain(path: Column) -> Column:
    """A file path without URL encoding and with one form of the local scheme."""
    return F.regexp_replace(decoded_path(path), "^file:/+", "/")


def listed_files(spark: SparkSession, source_path: str, glob: str | None = None) -> DataFrame:
    """(file): data files under a folder, from its listing."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(source_path).select(F.regexp_replace("path", "^file:/+", "/").alias("file"))


def ingested_files(spark: SparkSession, sink_path: str, fmt: str = "parquet") -> DataFrame:
    """(file): the files of which the sink holds rows."""
    if not path_exists(spark, sink_path):
        return spark.createDataFrame([], "file string")
    rows = spark.read.format(fmt).schema(f"{SOURCE_COL} string").load(sink_path)
    return rows.select(_plain(F.col(SOURCE_COL)).alias("file")).distinct()


def ingest_available(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType | str,
    sink_path: str,
    checkpoint_path: str,
    fmt: str = "parquet",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    transform=None,
    partition_by: Sequence[str] = (),
) -> int:
    """Ingest every file not yet seen under ``source_path``; return the sink's new rows.

    ``transform`` (DataFrame -> DataFrame) may type the stream.  It must keep
    ``SOURCE_COL``, which holds the file of each row, and the rows: a file that
    has rows of which the sink holds none counts as left out.
    """
    # names of files that arrived since the last run (the stream's driver lists them too)
    expected = listed_files(spark, source_path, glob).join(ingested_files(spark, sink_path, fmt), "file", "left_anti")
    expected = spark.createDataFrame(expected.collect(), "file string")
    rows_before = _rows(spark, sink_path, fmt)
    reader = spark.readStream.schema(schema).format(fmt).option("maxFileAge", MAX_FILE_AGE)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_path).withColumn(SOURCE_COL, F.col("_metadata.file_path"))
    if transform is not None:
        stream = transform(stream)
    writer = stream.writeStream.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = (
        writer.option("path", sink_path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    left = [r["file"] for r in expected.join(ingested_files(spark, sink_path, fmt), "file", "left_anti").collect()]
    missing = [f for f in left if _rows(spark, f, fmt)]  # a file without rows leaves no trace in the sink
    if missing:
        raise IngestError(f"{len(missing)} listed files were not ingested, among them {min(missing)}")
    return _rows(spark, sink_path, fmt) - rows_before


def _rows(spark: SparkSession, sink_path: str, fmt: str) -> int:
    """Rows of the sink (for Parquet from the files' footers)."""
    if not path_exists(spark, sink_path):
        return 0
    return spark.read.format(fmt).schema("_none int").load(sink_path).count()


def read_sink(spark: SparkSession, sink_path: str, fmt: str = "parquet") -> DataFrame:
    """The ingested rows (honours the sink's commit log)."""
    return spark.read.format(fmt).load(sink_path).drop(SOURCE_COL)
