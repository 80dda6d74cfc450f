"""Physical layout: partitioned writes, Z-order, file index, skipping, compaction.

(S7-S9, L1-L8, A8, A9.)  Everything is a DataFrame plan; the only values
that reach the driver are bounded (Z-order boundaries: ``k * 2**bits``
numbers; file statistics: one row per layer).

Write clustering uses ``REBALANCE`` on the partition columns: rows of one
partition value go to one task (one file per directory) unless AQE measures
that partition as skewed, in which case it is split into advisory-sized
pieces instead of landing a third of the table on one task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicelake.operators.joins import bounded_broadcast
from servicelake.session import path_exists, remove_path, shared_path, split_session

MONTH_COL = "created_month"
PREFIX_COL = "borough_truncated"
PARTITION_COLS = (MONTH_COL, PREFIX_COL)
Z_COL = "_z"


# --- derived partition columns and predicates --------------------------------


def with_partition_columns(
    df: DataFrame, ts_col: str = "created_date", key_col: str = "borough"
) -> DataFrame:
    """Month start (DATE) and first letter as explicit partition columns.

    The month is stored as a DATE (``created_month=1998-10-01``): the same
    month id as a truncated timestamp, but its directory value parses back
    without any time-zone interpretation.  An empty key has no first letter
    (NULL), like a missing one: a directory name cannot tell them apart.
    """
    return df.withColumns(
        {
            MONTH_COL: F.trunc(F.col(ts_col).cast("date"), "MM"),
            PREFIX_COL: F.nullif(F.substring(F.col(key_col), 1, 1), F.lit("")),
        }
    )


def partition_predicates(
    ts_range: tuple | None = None,
    equals: Mapping[str, str] | None = None,
    key_col: str = "borough",
) -> Column:
    """L2: filters on the derived columns implied by source-column filters.

    ``ts_range=(start, end)`` (half-open, either side may be None) becomes a
    month range; ``equals={key_col: v}`` becomes ``prefix = substr(v, 1, 1)``.
    Literals fold to constants, so the scan prunes partition directories.
    The result is a superset filter: keep the original predicate as well.
    An empty key has an empty prefix, which a partitioned layout stores as
    its NULL partition.
    """
    cond = F.lit(True)
    if ts_range is not None:
        start, end = ts_range
        if start is not None:
            cond = cond & (F.col(MONTH_COL) >= F.trunc(F.lit(str(start)).cast("date"), "MM"))
        if end is not None:
            # half-open end: the last month touched is the month of end - 1us
            last = F.lit(str(end)).cast("timestamp_ntz") - F.expr("INTERVAL 1 MICROSECOND")
            cond = cond & (F.col(MONTH_COL) <= F.trunc(last.cast("date"), "MM"))
    for col, value in (equals or {}).items():
        if col != key_col:
            continue
        prefix = str(value)[:1]
        cond = cond & (F.col(PREFIX_COL) == F.lit(prefix) if prefix else F.col(PREFIX_COL).isNull())
    return cond


def read_partitioned(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A month x letter layout with its partition columns as DATE and text (not guessed from directory names)."""
    inferred = spark.read.format(fmt).load(path).schema
    kinds = {MONTH_COL: T.DateType(), PREFIX_COL: T.StringType()}
    schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType), True) for f in inferred.fields])
    return spark.read.schema(schema).format(fmt).load(path)


# --- writes ------------------------------------------------------------------


def cluster_for_write(df: DataFrame, partition_cols: Sequence[str], sort_cols: Sequence[str] = ()) -> DataFrame:
    """L1/K5: co-locate each partition value and sort within tasks."""
    return df.hint("rebalance", *partition_cols).sortWithinPartitions(*partition_cols, *sort_cols)


def write_partitioned(
    df: DataFrame,
    path: str,
    ts_col: str = "created_date",
    key_col: str = "borough",
    fmt: str = "parquet",
    table: str | None = None,
    max_records_per_file: int | None = None,
    sample_rows: int | None = None,
    mode: str = "overwrite",
    sample_per_partition: int | None = None,
    sample_key: str = "unique_key",
) -> str:
    """Partitioned create-or-replace by month x first letter.

    ``table`` also registers the output in the catalog (``saveAsTable`` with
    an explicit path).  ``sample_rows`` is the dry-run mode: a limited sample
    written to ``<path>_test`` (and ``<table>_test``), never the real target;
    ``sample_per_partition`` takes so many rows of every partition value
    instead, by hash of ``sample_key``.
    """
    if sample_per_partition is not None:
        df = sample_of_each_partition(df, sample_per_partition, sample_key, ts_col, key_col)
    data = with_partition_columns(df, ts_col, key_col)
    if sample_rows is not None:
        data = data.limit(sample_rows)
    if sample_rows is not None or sample_per_partition is not None:
        path = f"{path.rstrip('/')}_test"
        table = f"{table}_test" if table else None
    writer = cluster_for_write(data, PARTITION_COLS, (ts_col,)).write.mode(mode).format(fmt).partitionBy(*PARTITION_COLS)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if table:
        writer.option("path", path).saveAsTable(table)
    else:
        writer.save(path)
    return path


def sample_of_each_partition(df: DataFrame, per_partition: int, key: str, ts_col: str = "created_date", key_col: str = "borough") -> DataFrame:
    """S9 without blind spots: of every partition value the ``per_partition`` rows with the least hashes of ``key``.

    Which rows these are does not depend on files or tasks, and no partition
    value is missing.  Each task keeps that many rows of a partition at most
    before anything is shuffled.
    """
    rows = with_partition_columns(df, ts_col, key_col)
    least = Window.partitionBy(*PARTITION_COLS).orderBy(F.md5(F.col(key).cast("string")), *df.columns)
    return rows.withColumn("_place", F.row_number().over(least)).where(F.col("_place") <= per_partition).select(*df.columns)


def append_raw(df: DataFrame, path: str, load_id, fmt: str = "parquet") -> str:
    """Append-only landing write; every row carries its ``load_id``."""
    df.withColumn("load_id", F.lit(load_id)).write.mode("append").format(fmt).save(path)
    return path


def write_landing(df: DataFrame, path: str, rows_per_file: int = 4_000_000, fmt: str = "parquet") -> str:
    """A landing layer of as few files as its rows allow, each written by one task as it reads.

    ``df`` should be a stored table: it is counted, and its splits are put
    together without a shuffle.
    """
    df.coalesce(max(1, math.ceil(df.count() / rows_per_file))).write.format(fmt).save(path)
    return path


def write_metrics(df: DataFrame, path: str) -> str:
    """One JSON metrics record set per run (small, one file)."""
    df.coalesce(1).write.mode("append").json(path)
    return path


# --- Z-order -----------------------------------------------------------------


def _is_text(df: DataFrame, col: str) -> bool:
    dtype = df.schema[col].dataType
    return not isinstance(dtype, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def order_key(df: DataFrame, col: str) -> Column:
    """What a column is ordered by: numbers and times as a number, text as itself (byte order)."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.NumericType):
        return F.col(col).cast("double")
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    return F.col(col).cast("string")


def zorder_boundaries(df: DataFrame, cols: Sequence[str], bits: int = 8, accuracy: int = 10_000) -> list[list]:
    """Bucket boundaries of every Z column, ``2**bits - 1`` at most for each.

    Numbers and times: approximate quantiles (a bounded sketch for each task,
    merged).  Text: whole values.  Where a column has no more distinct values
    than buckets, each value but the largest is a boundary, so each value has
    its own bucket; otherwise the boundaries are the cumulative-share quantiles
    of a deterministic sample of distinct values (by hash, ``64 * 2**bits``
    expected), each weighted by its rows.  Only boundaries and that bounded
    sample reach the driver.
    """
    most = (1 << bits) - 1
    qs = [i / (1 << bits) for i in range(1, 1 << bits)]
    numeric = [c for c in cols if not _is_text(df, c)]
    bounds: dict[str, list] = {}
    if numeric:
        row = df.agg(*[F.percentile_approx(order_key(df, c), qs, accuracy).alias(f"b{i}") for i, c in enumerate(numeric)]).first()
        bounds = {c: sorted({float(x) for x in (row[f"b{i}"] or [])}) for i, c in enumerate(numeric)}
    for c in cols:
        if c in bounds:
            continue
        values = df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        distinct = values.agg(F.count(F.lit(1))).first()[0]
        keep = 64 * (most + 1)
        if distinct > keep:
            cut = 1 << 30
            values = values.where(F.pmod(F.xxhash64("v"), F.lit(cut)) < int(cut * keep / distinct))
        rows = sorted((r["v"].encode(), r["v"], r["n"]) for r in values.collect())
        if len(rows) <= most + 1:
            bounds[c] = [v for _, v, _ in rows[:-1]]
            continue
        total, seen, step, found = sum(n for *_, n in rows), 0, 1, []
        for _, v, n in rows[:-1]:
            seen += n
            if seen * (most + 1) >= step * total:
                found.append(v)
                step = seen * (most + 1) // total + 1
        bounds[c] = found[:most]
    return [bounds[c] for c in cols]


def bucket_key(df: DataFrame, col: str) -> Column:
    """What the bucket boundaries are compared with."""
    return order_key(df, col)


def _bucket(key: Column, bounds: Sequence, lo: int = 0, hi: int | None = None) -> Column:
    """Number of ``bounds`` strictly below ``key``, as a balanced CASE tree.

    ``log2(len(bounds))`` code-generated comparisons per row, no per-row
    allocation.  NULL keys compare false everywhere and land in bucket 0.
    """
    if hi is None:
        hi = len(bounds)
    if lo >= hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    # bounds[mid] < key  <=>  the answer is above mid
    return F.when(F.lit(bounds[mid]) < key, _bucket(key, bounds, mid + 1, hi)).otherwise(_bucket(key, bounds, lo, mid))


def with_zorder(df: DataFrame, cols: Sequence[str], bits: int = 8, boundaries: list[list] | None = None) -> DataFrame:
    """L3: add ``_z``, the bit-interleaved rank buckets of ``cols``.

    Bucket id = number of quantile boundaries below the value (NULL -> 0);
    bit ``i`` of column ``j`` lands at position ``i * k + j``.  Bucket ids
    are computed once per row in their own projection, then interleaved; the
    ids of a column of few values are spread over all bits, so that it counts
    in the order as much as one of many.
    """
    if len(cols) * bits > 62:
        raise ValueError("cols * bits must fit in 62 bits")
    bounds = boundaries if boundaries is not None else zorder_boundaries(df, cols, bits)
    k = len(cols)
    bucket_cols = [f"_zb{j}" for j in range(k)]
    with_buckets = df.withColumns(
        {
            name: F.coalesce(_bucket(bucket_key(df, c), b), F.lit(0)).cast("bigint") * ((1 << bits) // (len(b) + 1))
            for name, c, b in zip(bucket_cols, cols, bounds)
        }
    )
    z = F.lit(0).cast("bigint")
    for j, name in enumerate(bucket_cols):
        for i in range(bits):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(F.col(name), i).bitwiseAND(F.lit(1)), i * k + j))
    return with_buckets.withColumn(Z_COL, z).drop(*bucket_cols)


def write_zordered(
    df: DataFrame,
    path: str,
    zorder_by: Sequence[str] = ("borough", "complaint_type"),
    ts_col: str = "created_date",
    key_col: str = "borough",
    num_partitions: int | None = None,
    rows_per_file: int = 1_000_000,
    bits: int = 8,
    fmt: str = "parquet",
    stored: bool = False,
) -> str:
    """L3 write: partitioned by month x letter, Z-ordered inside each partition.

    Range partitioning on ``(partition cols, _z, time, key hash)`` gives each
    task a contiguous Z range of one partition, so files have narrow min/max
    on the Z columns; the tie-break spreads a hot partition, and a hot Z value
    within it, over several tasks.  The task count follows the data:
    ``rows / rows_per_file`` but at least the cluster's default parallelism,
    unless given.  The typed input is written to the shared folder first, so
    its plan runs once, not for each of the boundary, sampling and write passes;
    not so if it is ``stored``: a table that is just read.
    """
    spark = df.sparkSession
    once = shared_path(spark, "layouts", "zorder-input")
    data = with_partition_columns(df, ts_col, key_col)
    if not stored:
        data.write.format(fmt).save(once)
        data = split_session(spark).read.schema(data.schema).format(fmt).load(once)
    bounds = zorder_boundaries(data, list(zorder_by), bits)
    n = num_partitions or max(spark.sparkContext.defaultParallelism, math.ceil(data.count() / rows_per_file))
    data = with_zorder(data, list(zorder_by), bits, boundaries=bounds)
    tie = F.xxhash64(*df.columns)
    out = (
        data.repartitionByRange(n, *[F.col(c) for c in PARTITION_COLS], F.col(Z_COL), F.col(ts_col), tie)
        .sortWithinPartitions(*PARTITION_COLS, Z_COL, ts_col)
        .drop(Z_COL)
    )
    out.write.mode("overwrite").format(fmt).partitionBy(*PARTITION_COLS).save(path)
    if not stored:
        remove_path(spark, once)
    return path


# --- file statistics, index and skipping --------------------------------------


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """Data file count and total bytes under ``path`` (one row).

    ``binaryFile`` lists files without reading contents (the read schema is
    only ``path, length``).  Spark's listing already ignores names starting
    with ``_`` or ``.`` (commit markers, logs, checksums).
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("bytes"),
    )


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Per data file: ``file_path`` (same form as ``_metadata.file_path``) and ``length``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("file_path"), "length")


def _partition_of(file_path: Column, column: str) -> Column:
    """A partition value as it stands in a file's path."""
    return F.regexp_extract(file_path, f"/{column}=([^/]*)/", 1)


def small_file_partitions(
    spark: SparkSession, path: str, partition_cols: Sequence[str] = PARTITION_COLS, target_file_bytes: int = 128 << 20
) -> DataFrame:
    """Per partition with two or more files under 3/4 of the target size: directory values, those files and their bytes.

    From the file listing alone: the cost follows files, not rows.
    """
    files = file_sizes(spark, path)
    values = [_partition_of(F.col("file_path"), c).alias(c) for c in partition_cols]
    small = F.col("length") < 0.75 * target_file_bytes
    per = files.groupBy(*values).agg(F.count_if(small).alias("small_files"), F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    # rewriting must halve the files at least, or it is not worth it (and might never end)
    return per.where((F.col("small_files") >= 2) & (F.col("files") >= 2 * F.ceil(F.col("bytes") / target_file_bytes)))


def needs_compaction(
    spark: SparkSession,
    path: str,
    target_file_bytes: int = 128 << 20,
    share: float = 0.5,
    partition_cols: Sequence[str] = PARTITION_COLS,
) -> DataFrame:
    """L4: compaction trigger -- whether mergeable files make up more than ``share`` of all; one row.

    A compacted table of any size has none, so its number of files alone never triggers.
    """
    total = file_stats(spark, path)
    small = small_file_partitions(spark, path, partition_cols, target_file_bytes).agg(F.coalesce(F.sum("files"), F.lit(0)).alias("mergeable_files"))
    return total.withColumn("mergeable_files", small.scalar()).withColumn("needs_compaction", F.col("mergeable_files") > F.lit(share) * F.col("files"))


def overlap_depth(ranges: DataFrame, low: str, high: str, by: Sequence[str] = ()) -> DataFrame:
    """L3 measured: how many files' ranges [low, high] hold a value, at most and on average over the ranges' ends.

    A sweep over the ends of all ranges: one more where a range begins, one
    less after it ends, added up in order.  ``by`` sweeps each partition for
    itself.  A query for one value must read as many files as hold it; a layout
    is clustered by a column if that is few.  The sweep follows files, not rows.
    """
    ends = ranges.where(F.col(low).isNotNull()).select(
        *by, F.inline(F.array(F.struct(F.col(low).alias("at"), F.lit(0).alias("after"), F.lit(1).alias("step")), F.struct(F.col(high).alias("at"), F.lit(1).alias("after"), F.lit(-1).alias("step"))))
    )
    places = ends.groupBy(*by, "at", "after").agg(F.sum("step").alias("step"))
    running = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    depth = F.sum("step").over(running.orderBy("at", "after").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    begun = places.withColumn("depth", depth).where("after = 0")
    return begun.groupBy(*by).agg(F.max("depth").alias("greatest_depth"), F.avg("depth").alias("mean_depth"))


def with_file_path(df: DataFrame) -> DataFrame:
    return df.withColumn("file_path", F.col("_metadata.file_path"))


def partition_file_counts(spark: SparkSession, path: str, partition_cols: Sequence[str] = PARTITION_COLS) -> DataFrame:
    """Files and rows per distinct partition value."""
    df = with_file_path(spark.read.parquet(path))
    return df.groupBy(*partition_cols).agg(
        F.count_distinct("file_path").alias("files"), F.count(F.lit(1)).alias("rows")
    )


def partition_rows(spark: SparkSession, path: str, partition_cols: Sequence[str] = PARTITION_COLS) -> DataFrame:
    """Rows per partition value as read back from the layout."""
    return spark.read.parquet(path).groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("rows"))


def file_index(
    spark: SparkSession, path: str, cols: Sequence[str], partition_cols: Sequence[str] = ()
) -> DataFrame:
    """Per data file, row count and min/max of ``cols``.

    ``partition_cols`` carries each file's partition values along, so the
    index can be filtered with the same partition predicates as a query.  A
    task sorts the rows of its split by file (bounds of text are not kept in a
    hash aggregate), so splits are small.
    """
    df = with_file_path(split_session(spark).read.parquet(path))
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in cols:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.groupBy("file_path", *partition_cols).agg(*aggs)


def skip_report(
    index: DataFrame,
    equals: Mapping[str, object] | None = None,
    ranges: Mapping[str, tuple] | None = None,
    min_skip_pct: float = 50.0,
) -> DataFrame:
    """Files that may hold matches vs all files, and the skip verdict.

    A file is a candidate when every predicate overlaps its [min, max].  A
    file whose column is entirely NULL has NULL bounds and cannot match an
    equality or range predicate.
    """
    cand = F.lit(True)
    for c, v in (equals or {}).items():
        cand = cand & F.coalesce((F.col(f"{c}_min") <= F.lit(v)) & (F.col(f"{c}_max") >= F.lit(v)), F.lit(False))
    for c, (lo, hi) in (ranges or {}).items():
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col(f"{c}_max") >= F.lit(lo))
        if hi is not None:
            cond = cond & (F.col(f"{c}_min") < F.lit(hi))
        cand = cand & F.coalesce(cond, F.lit(False))
    agg = index.agg(F.count(F.lit(1)).alias("total_files"), F.count_if(cand).alias("candidate_files"))
    skip = F.lit(100.0) * (F.col("total_files") - F.col("candidate_files")) / F.nullif(F.col("total_files"), F.lit(0))
    return agg.withColumn("skip_pct", skip).withColumn("passed", F.coalesce(F.col("skip_pct") > F.lit(min_skip_pct), F.lit(False)))


def compact(
    spark: SparkSession,
    src_path: str,
    dst_path: str,
    target_file_bytes: int = 128 * 1024 * 1024,
    partition_cols: Sequence[str] = (),
    fmt: str = "parquet",
) -> DataFrame:
    """Rewrite ``src_path`` into ``dst_path`` with ~target-sized files.

    Writes to a new path (never over the input).  Returns a before/after
    report ``(stage, files, bytes)``.
    """
    before = file_stats(spark, src_path).withColumn("stage", F.lit("before"))
    if partition_cols:
        parts = _file_numbers(file_sizes(spark, src_path), partition_cols, target_file_bytes)
        df = read_partitioned(split_session(spark), src_path, fmt)
        _write_sized(df, parts, dst_path, partition_cols, fmt)
    else:
        n = max(1, math.ceil(before.first()["bytes"] / target_file_bytes))
        spark.read.format(fmt).load(src_path).repartition(n).write.mode("overwrite").format(fmt).save(dst_path)
    after = file_stats(spark, dst_path).withColumn("stage", F.lit("after"))
    return before.unionByName(after).select("stage", "files", "bytes")


def _file_numbers(files: DataFrame, partition_cols: Sequence[str], target_file_bytes: int) -> DataFrame:
    """Directory values of each partition and the number of target-sized files its bytes make."""
    values = [_partition_of(F.col("file_path"), c).alias(c) for c in partition_cols]
    return files.groupBy(*values).agg(F.greatest(F.ceil(F.sum("length") / target_file_bytes), F.lit(1)).cast("int").alias("_n"))


def _directory_value(col: str) -> Column:
    """A partition value as its directory shows it (NULL has a name of its own)."""
    return F.coalesce(F.col(col).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))


def _write_sized(
    df: DataFrame, parts: DataFrame, path: str, partition_cols: Sequence[str], fmt: str, zorder_by: Sequence[str] = ("borough", "complaint_type"), ts_col: str = "created_date"
) -> None:
    """Write the rows of the listed partitions, each in its ``_n`` files, Z-ordered.

    Rows of a partition of several files are dealt by Z range: ``_n - 1``
    boundaries for each such partition, so its files keep narrow min/max.
    """
    zcols = [c for c in zorder_by if c in df.columns]
    # files are numbered through all partitions (a list of folders), and each is one task's
    earlier = Window.orderBy(*partition_cols).rowsBetween(Window.unboundedPreceding, -1)
    named = parts.select(*partition_cols, "_n", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    named = named.toDF(*[f"_p_{c}" for c in partition_cols], "_n", "_first")
    total = parts.agg(F.sum("_n")).first()[0]
    on = None
    for c in partition_cols:
        eq = _directory_value(c) == F.url_decode(F.replace(F.col(f"_p_{c}"), F.lit("+"), F.lit("%2B")))
        on = eq if on is None else on & eq
    rows = df.join(bounded_broadcast(named), on, "inner").drop(*[f"_p_{c}" for c in partition_cols])
    sort = [c for c in (ts_col,) if c in df.columns]
    if zcols:
        rows = with_zorder(rows, zcols)
        sort = [Z_COL, *sort]
    own = [_directory_value(c).alias(f"_d_{i}") for i, c in enumerate(partition_cols)]
    # a place in the partition: the Z value, ties broken by the row's hash, as one number
    place = (F.col(Z_COL) if zcols else F.lit(0)).cast("double") + (F.pmod(F.xxhash64(*df.columns), F.lit(1 << 20)) / float(1 << 20))
    rows = rows.withColumn("_place", place)
    cuts = (
        rows.where("_n > 1")
        .groupBy(*own, "_n")
        .agg(F.percentile_approx("_place", F.lit([i / 1000 for i in range(1, 1000)]), 10_000).alias("_q"))
        .withColumn("_cuts", F.expr("transform(sequence(1, _n - 1), i -> _q[least(cast(round(1000.0 * i / _n) as int), 999) - 1])"))
        .drop("_q", "_n")
    )
    if cuts.isEmpty():
        rows = rows.withColumn("_file", F.lit(0))
    else:
        keyed = rows.withColumns({f"_d_{i}": _directory_value(c) for i, c in enumerate(partition_cols)})
        keys = [f"_d_{i}" for i in range(len(partition_cols))]
        rows = keyed.join(bounded_broadcast(cuts), keys, "left").withColumn("_file", F.coalesce(F.size(F.filter("_cuts", lambda x: x < F.col("_place"))), F.lit(0))).drop(*keys, "_cuts")
    out = rows.withColumn("_file", (F.col("_first") + F.col("_file")).cast("int")).repartitionById(int(total), "_file")
    out = out.sortWithinPartitions(*partition_cols, *sort)
    out.drop("_n", "_first", "_place", "_file", Z_COL).write.mode("overwrite").format(fmt).partitionBy(*partition_cols).save(path)


def _marker(path: str) -> str:
    """Where a compaction that has begun to replace partitions is noted."""
    return f"{path.rstrip('/')}_compacting"


def recover_compaction(spark: SparkSession, path: str) -> bool:
    """Finish a compaction that was interrupted while it replaced partitions; True if there was one.

    The marker is written after the scratch copy is complete and names it.
    A partition that is no longer in the copy has been moved already.
    """
    marker = _marker(path)
    if not path_exists(spark, f"{marker}/_SUCCESS"):
        return False
    row = spark.read.schema("scratch string, columns array<string>").json(marker).first()
    _replace_partitions(spark, row["scratch"], path, row["columns"])
    remove_path(spark, marker)
    return True


def _replace_partitions(spark: SparkSession, scratch: str, path: str, partition_cols: Sequence[str]) -> None:
    """Move each partition folder of the copy into the place of the table's own (file system calls, no rows)."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(scratch)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = fs.globStatus(hadoop.Path(root, "/".join(f"{c}=*" for c in partition_cols)))
    for folder in folders or []:
        source = folder.getPath()
        names = [source.getName()]
        for _ in partition_cols[1:]:
            names.insert(0, source.getParent().getName())
            source = source.getParent()
        target = hadoop.Path(hadoop.Path(path), "/".join(names))
        fs.delete(target, True)
        fs.mkdirs(target.getParent())
        if not fs.rename(folder.getPath(), target):
            raise OSError(f"could not move {folder.getPath()} to {target}")


def compact_partitions(
    spark: SparkSession,
    path: str,
    scratch: str,
    partition_cols: Sequence[str] = PARTITION_COLS,
    fmt: str = "parquet",
    target_file_bytes: int = 128 << 20,
) -> DataFrame:
    """L5, partition-scoped: rewrite only partitions with several small files;
    returns a before/after ``(stage, files, bytes)``.

    The partitions are found from the file listing; a second call finds none.
    Their rows (partition filters keep other partitions unread) are written to
    ``scratch`` (of the same file system) in target-sized files, Z-ordered, and
    the complete copy is noted in a marker before its folders take the place
    of the table's: a job lost in between is finished by
    ``recover_compaction``.  ``scratch`` may be removed once this returns.
    """
    recover_compaction(spark, path)
    b = file_stats(spark, path).first()
    schema = "stage string, files bigint, bytes bigint"
    found = small_file_partitions(spark, path, partition_cols, target_file_bytes)
    parts = found.select(*partition_cols, F.greatest(F.ceil(F.col("bytes") / target_file_bytes), F.lit(1)).cast("int").alias("_n"))
    # the listing is taken now: it changes once directories are replaced
    listing = shared_path(spark, "layouts", "fragmented")
    parts.write.parquet(listing)
    parts = spark.read.schema(parts.schema).parquet(listing)
    if not parts.isEmpty():
        _write_sized(read_partitioned(split_session(spark), path, fmt), parts, scratch, partition_cols, fmt)
        spark.createDataFrame([(scratch, list(partition_cols))], "scratch string, columns array<string>").coalesce(1).write.mode("overwrite").json(_marker(path))
        _replace_partitions(spark, scratch, path, partition_cols)
        remove_path(spark, _marker(path))
    remove_path(spark, listing)
    a = file_stats(spark, path).first()
    return spark.createDataFrame([("before", b["files"], b["bytes"]), ("after", a["files"], a["bytes"])], schema)


def storage_report(spark: SparkSession, layers: Sequence[tuple[str, str]]) -> DataFrame:
    """Files and size per layer, change vs the previous layer, total change
    vs the first layer.

    ``layers`` is an ordered list of ``(name, path)``.  Each layer is one
    ``file_stats`` row; the previous layer is attached by an equi join on the
    stage ordinal (a few rows, no window).
    """
    from servicelake.functions.sla import change_note, relative_saving

    parts = [file_stats(spark, p).select(F.lit(i).alias("stage"), F.lit(n).alias("layer"), "files", "bytes") for i, (n, p) in enumerate(layers)]
    stats = parts[0]
    for p in parts[1:]:
        stats = stats.unionByName(p)
    prev = stats.select((F.col("stage") + 1).alias("stage"), F.col("layer").alias("prev_layer"), F.col("bytes").alias("prev_bytes"))
    first_bytes = stats.where(F.col("stage") == 0).select("bytes").scalar()
    out = stats.join(prev, "stage", "left")
    out = out.withColumn("gb", F.col("bytes") / F.lit(1024.0**3))
    out = out.withColumn("total_reduction_pct", relative_saving(first_bytes, F.col("bytes")))
    out = out.withColumn("pct_vs_previous", relative_saving("prev_bytes", "bytes"))
    out = out.withColumn(
        "change_label",
        F.when(F.col("prev_layer").isNotNull(), change_note("prev_bytes", "bytes", "previous")),
    )
    return out.select(
        "stage", "layer", "files", "bytes", "gb", "prev_layer", "pct_vs_previous", "change_label", "total_reduction_pct"
    )
