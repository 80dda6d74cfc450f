"""Operator 6: token ids as Parquet list columns.

Documents are dealt to ranges of ``doc_id``, more of them the more text there
is, and sorted.  The bounds are quantiles of the id; where one id fills a range,
or ranges are many, Spark's own range partitioning by id and text hash takes
their place.  Each task encodes its range in order and Spark's Parquet writer lays it out: format version 2
with dictionary pages for the ids (delta-packed where a dictionary does not
pay) and delta-packed metadata, row groups and pages of a set size, and page
indexes, so readers can take the metadata columns or a range of documents
without touching other pages.  ``start`` needs the ids of all earlier
documents: a file holds the count within its own range, and the counts of
earlier files, one row for each file, are added on reading.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from servicelake.llm.common import documents, slices, text_key
from servicelake.llm.tokens import DEFAULT_TOKENIZER, encoder

#: Bytes of text in a range, where the session's shuffle partitions are too few for that.
RANGE_BYTES = 256 << 20
#: Quantiles of the id that one pass finds; ranges number at most a quarter of that, else Spark cuts them.
MOST_BOUNDS = 1000
SCHEMA = "part long, doc_id long, start_in_part long, n_tokens long, ids array<int>"


def _ranged(rows: DataFrame, parts: int | None) -> DataFrame:
    """Rows in partitions of ascending (doc_id, text_key), a null id first; without ``parts``, so many as the text needs."""
    grid = F.percentile_approx("doc_id", [k / MOST_BOUNDS for k in range(1, MOST_BOUNDS)], 10_000)
    quantiles, size = rows.agg(grid, F.sum(F.octet_length("text"))).first()
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = parts or max(least, -(-(size or 0) // RANGE_BYTES))
    keyed = rows.withColumn("text_key", text_key())
    if quantiles and n <= MOST_BOUNDS // 4:
        bounds = [quantiles[k * MOST_BOUNDS // n - 1] for k in range(1, n)]
        if len(set(bounds)) == len(bounds):
            return keyed.repartitionById(n, _part(F.col("doc_id"), bounds))
    return keyed.repartitionByRange(n, "doc_id", "text_key")


def _part(key: Column, bounds: list[int], low: int = 0, high: int | None = None) -> Column:
    """The number of bounds below the key, by halving; a null key comes first."""
    high = len(bounds) if high is None else high
    if low >= high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(F.lit(bounds[middle]) < key, _part(key, bounds, middle + 1, high)).otherwise(_part(key, bounds, low, middle))


def write_tokens(
    docs: DataFrame,
    path: str,
    end_id: int = 2,
    tokenizer: str = DEFAULT_TOKENIZER,
    parts: int | None = None,
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 256 << 10,
    page_rows: int = 2000,
) -> None:
    """Write (part, doc_id, start_in_part, n_tokens, ids) in ascending doc_id order, ``part`` numbering the ranges.

    Null or empty text is a document of the end id alone; null ids come first;
    rows with the same id stand in the order of their text's hash; other columns are
    ignored; an empty table gives files without rows.
    """
    rows = documents(docs)
    ranged = _ranged(rows, parts).sortWithinPartitions("doc_id", "text_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        part, start = TaskContext.get().partitionId(), 0
        for rows in slices(batches, "text", 1 << 24):
            ids, ends = encode(rows.column("text"), end_id)
            sizes = np.diff(ends, prepend=0)
            column = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.view("<i4")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(sizes), part, np.int64)), rows.column("doc_id"), pa.array(start + ends - sizes), pa.array(sizes), column],
                names=["part", "doc_id", "start_in_part", "n_tokens", "ids"],
            )
            start += int(ends[-1])

    options = {
        "compression": "snappy", "parquet.writer.version": "v2", "parquet.enable.dictionary": "true",
        "parquet.block.size": str(row_group_bytes), "parquet.page.size": str(page_bytes), "parquet.page.row.count.limit": str(page_rows),
    }
    ranged.mapInArrow(run, SCHEMA).write.options(**options).parquet(path)


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None, where: Column | None = None) -> DataFrame:
    """Rows of a written folder: ``columns`` alone are read, and ``where`` reaches row groups and page indexes."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    rows = rows if where is None else rows.where(where)
    return rows.select(*columns) if columns else rows


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, before): the ids in all earlier parts, from the metadata columns; one row for each file."""
    counts = read_tokens(spark, path, ["part", "n_tokens"]).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def checksums(rows: DataFrame) -> DataFrame:
    """Each row with the unsigned crc32 of its ids in place of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values, ends = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<i4")).cast("B"), lists.offsets.to_pylist()
            sums = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("part", "doc_id", "start_in_part", "n_tokens")] + [pa.array(sums, pa.int64())],
                names=["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"],
            )

    return rows.mapInArrow(run, "part long, doc_id long, start_in_part long, n_tokens long, ids_crc32 long")


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    rows = checksums(read_tokens(spark, path))
    return rows.join(part_starts(spark, path), "part").select("doc_id", (F.col("start_in_part") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
