"""I7 with M2: a stream of files merged into a keyed table.

Each micro-batch is one merge whose id is the stream's name and the batch's
number.  Structured Streaming may hand over a batch more than once (after a
failure between the merge and the stream's own commit, or from a lost
checkpoint); a batch that has been merged is then applied from its written
changes, which leaves the table as it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from servicelake.operators.keyed import KeyedTable
from servicelake.session import split_session
from servicelake.streaming.ingest import MAX_FILE_AGE


def batch_id(stream: str, number: int) -> str:
    return f"{stream}-{number:012d}"


def upsert_available(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType | str,
    table: KeyedTable,
    checkpoint_path: str,
    stream: str = "stream",
    fmt: str = "parquet",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    on_changes: Callable[[DataFrame, str], None] | None = None,
) -> int:
    """Merge every file not yet seen under ``source_path``; returns the number of batches.

    The greater row of a key (by the table's order) stays, so files may come in
    any order and more than once.  ``on_changes`` gets each batch's changes and
    its id, before the stream notes the batch as done; it must bear repetition,
    too.
    """
    batches = 0

    def merge(rows: DataFrame, number: int) -> None:
        nonlocal batches
        name = batch_id(stream, number)
        changes = table.merge(transform(rows) if transform else rows, name, latest=True)
        if on_changes is not None:
            on_changes(changes, name)
        batches += 1

    # a batch is sorted by key as it is read, so its splits are small
    reader = split_session(spark).readStream.schema(schema).format(fmt).option("maxFileAge", MAX_FILE_AGE)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    query = reader.load(source_path).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()
    query.awaitTermination()
    return batches
