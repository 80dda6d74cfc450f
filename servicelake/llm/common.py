"""Helpers shared by the operators: inputs, shared scratch tables, document keys, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table by the path Spark sees (any file system Spark reads)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session, once, so they need no path to it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    import tempfile
    import zipfile
    from pathlib import Path

    package = Path(__file__).resolve().parent.parent
    to = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(to, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(to))
    _SHIPPED.add(context.applicationId)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is absent and the session is local (tests) is a
    private folder made; on a cluster its absence is an error, because
    executors could not see a folder of the driver's own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        import tempfile

        root = tempfile.mkdtemp(prefix="llm-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def forget(df: DataFrame) -> None:
    """Remove a table that ``written`` made, once all that is made of it has been written in turn."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._scratch)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_key() -> Column:
    """64 bits of a document's text; with the id it names a row (equal rows share it)."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of a documents table: ids as long, null text as empty, other columns dropped."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """``names``, each with as many underscores behind it as it takes to differ from all that are taken (in any case)."""
    used = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """A text column's values as UTF-8 bytes (None: null), without decoding them."""
    col = batch.column(column)
    kind = pa.large_binary() if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else pa.binary()
    return col.cast(kind).to_pylist()


def release() -> None:
    """Give freed memory back to the system: Python workers live on between tasks and stages."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; other systems do without
    if trim:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches that hold about ``max_bytes`` of text at most (one row at least)."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            base = int(sizes[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(sizes, base + max_bytes, side="right")))
            yield batch.slice(first, last - first)
            first = last
            release()


def chunks(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Such slices, each with its texts as bytes."""
    for batch in slices(batches, column, max_bytes):
        yield batch, utf8(batch, column)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (wrapping arithmetic)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class WordHashes(dict):
    """Word bytes -> 64-bit hash, remembered up to a fixed number of words."""

    def __init__(self, most: int = 250_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.most:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of ``n`` consecutive word hashes (empty if there are fewer words)."""
    size = len(words) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    out = words[:size].copy()
    for k in range(1, n):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + size] + np.uint64(k))
    return out if n > 1 else mix64(out)


def bitmap(df: DataFrame, column: str, bits: int = 1 << 26) -> np.ndarray:
    """A set of 64-bit values as ``bits`` bits, packed: a test of it errs to the side of membership only.

    Its size (8 MB by default) does not follow the data.  Bits are put
    together on the executors; the driver receives no more than the bitmap.
    """
    run = 1 << 15
    places = df.select(F.pmod(F.col(column), F.lit(bits)).alias("b")).groupBy(F.floor(F.col("b") / run).cast("long").alias("k")).agg(F.collect_set(F.pmod("b", F.lit(run)).cast("int")).alias("at"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for at in batch.column("at").to_pylist():
                own = np.zeros(run, np.uint8)
                own[at] = 1
                out.append(np.packbits(own).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(out, pa.binary())], names=["k", "blob"])

    out = np.zeros(bits // 8, np.uint8)
    for row in places.mapInArrow(pack, "k long, blob binary").collect():
        out[row["k"] * run // 8 : (row["k"] + 1) * run // 8] = np.frombuffer(row["blob"], np.uint8)
    return out


def in_bitmap(packed: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which 64-bit values may be in the set."""
    at = values.view(np.int64) & np.int64(len(packed) * 8 - 1)
    return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """Arrays as an Arrow list column."""
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat).cast(kind))
