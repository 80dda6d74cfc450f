"""Places in a total order, without sorting in one task (K3).

Rows are dealt by ranges of the order and sorted in each range; a row's place
is its place in the range plus the rows of the ranges before.  Only the size of
each range is put together, one number for each task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from servicelake.session import shared_path

_PART, _AT = "_part", "_at"


def offsets(sizes: DataFrame, part: str, size: str) -> DataFrame:
    """(part, first): for each part the sizes of all parts before it, by one fold over one row."""
    row = sizes.agg(F.array_sort(F.collect_list(F.struct(F.col(part).cast("bigint").alias("part"), F.col(size).cast("bigint").alias("size")))).alias("all"))
    none = F.array().cast("array<struct<part: bigint, first: bigint>>")
    start = F.struct(F.lit(0).cast("bigint").alias("sum"), none.alias("out"))
    folded = F.aggregate(
        "all",
        start,
        lambda acc, x: F.struct((acc["sum"] + x["size"]).alias("sum"), F.concat(acc["out"], F.array(F.struct(x["part"].alias("part"), acc["sum"].alias("first")))).alias("out")),
    )
    return row.select(F.inline(folded["out"])).toDF(part, "first")


def with_positions(df: DataFrame, order: Sequence[Column | str], name: str = "position", first: int = 0) -> DataFrame:
    """``df`` with each row's place in ``order``, from ``first``; rows that are equal in it get places in any order.

    The sorted rows are written once to the shared folder, so counting and
    numbering see the same ranges.
    """
    spark = df.sparkSession
    path = shared_path(spark, "numbered")
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()  # the task's number, and the row's in it
    dealt.withColumns({_PART: F.shiftrightunsigned(number, 33), _AT: number.bitwiseAND((1 << 33) - 1)}).write.parquet(path)
    rows = spark.read.parquet(path)
    sizes = rows.groupBy(_PART).agg(F.count(F.lit(1)).alias("size"))
    placed = rows.join(F.broadcast(offsets(sizes, _PART, "size")), _PART)  # a row for each task
    return placed.select(*df.columns, (F.col("first") + F.col(_AT) + F.lit(first)).alias(name))


def disorder_in_files(df: DataFrame, order: str, block_rows: int = 1 << 17) -> DataFrame:
    """(file, rows, out_of_order): rows of each Parquet file, and those whose ``order`` is less than that of the row before (K5).

    Files are taken in blocks of rows, dealt so that a task has some
    ``block_rows`` of them however large files are; the first row of a block is
    then compared with the last one of the block before.
    """
    rows = df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), F.col(order).alias("value"))
    rows = rows.withColumn("block", F.floor(F.col("at") / F.lit(block_rows)).cast("bigint"))
    tasks = max(1, -(-df.count() // block_rows))  # counted from the files' footers
    before = F.lag("value").over(Window.partitionBy("file", "block").orderBy("at"))
    blocks = rows.repartition(tasks, "file", "block").withColumn("before", before).groupBy("file", "block")
    blocks = blocks.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("value") < F.col("before")).alias("inside"),
        F.min_by("value", "at").alias("head"),
        F.max_by("value", "at").alias("tail"),
    )
    earlier = F.lag("tail").over(Window.partitionBy("file").orderBy("block"))
    between = F.when(F.col("head") < F.col("earlier"), 1).otherwise(0)
    return blocks.withColumn("earlier", earlier).groupBy("file").agg(F.sum("rows").alias("rows"), F.sum(F.col("inside") + between).alias("out_of_order"))
