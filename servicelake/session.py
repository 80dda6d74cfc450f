"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in the package relies on.  Timestamps in the data are
# wall-clock values; UTC keeps any LTZ round trip lossless.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
    "spark.ui.enabled": "false",
}


def get_session(
    app_name: str = "servicelake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the package defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # Local mode: the driver JVM is also the only executor, so it needs
        # an executor-sized heap (Spark's 1g default starves shuffles and
        # runtime broadcasts).  Only applies when the JVM is launched here.
        settings["spark.driver.memory"] = "8g"
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is configured by the operator (an object-store or HDFS
    path visible to every executor); a cluster session without it is an
    error, because a folder of the driver's own is not visible to executors.
    Only a local session (tests on a laptop) gets a private directory.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="servicelake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path under the shared checkpoint folder.

    ``unique`` appends a random component so that a job never overwrites a
    path it is still reading from (write new, then switch).
    """
    pieces = [checkpoint_root(spark), "servicelake", *parts]
    if unique:
        pieces.append(uuid.uuid4().hex[:12])
    return "/".join(p.strip("/") if i else p for i, p in enumerate(pieces))


#: Sessions made by ``split_session``.
_BESIDE: dict[tuple[str, int, int | None, int | None], SparkSession] = {}

#: Rows that a task should take of a shuffle, and bytes of a stored table's row group, which no split divides.
TASK_ROWS = 250_000
ROW_GROUP_BYTES = 8 << 20


def partitions_for(rows: int) -> int:
    """Shuffle partitions of some ``TASK_ROWS`` rows each, as a power of two (so that few sessions differ in it)."""
    return 1 << max(0, -(-rows // TASK_ROWS) - 1).bit_length()


def split_session(spark: SparkSession, split_bytes: int = 8 << 20, partitions: int | None = None, advisory_bytes: int | None = None) -> SparkSession:
    """A session beside ``spark``, with its settings, that reads files in splits of ``split_bytes`` at most.

    What a task of a scan sorts or holds for a shuffle follows the rows of its
    split, and a file's bytes may be a tenth of its rows' in memory.  So tables
    that are sorted or dealt as they are read are read through this session;
    their frames join those of ``spark``.

    ``partitions`` is the number of shuffle partitions there: a session's own
    number stays the same however many rows come, and so what a task sorts would
    grow with them.  ``advisory_bytes`` is what AQE puts together for a task.
    What a frame of this session runs (and the left one of a join) has them.
    """
    key = (spark.sparkContext.applicationId, split_bytes, partitions, advisory_bytes)
    if key not in _BESIDE:
        other = spark.newSession()
        for name, value in spark.conf.getAll.items():
            if spark.conf.isModifiable(name):
                other.conf.set(name, value)
        other.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
        other.conf.set("spark.sql.files.openCostInBytes", str(split_bytes >> 4))
        if partitions:
            other.conf.set("spark.sql.shuffle.partitions", str(partitions))
            other.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        if advisory_bytes:
            other.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(advisory_bytes))
        _BESIDE[key] = other
    return _BESIDE[key]


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system Spark reads; errors are raised."""
    fs, target = _fs(spark, path)
    return bool(fs.exists(target))


def remove_path(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def keep_newest_versions(spark: SparkSession, root: str, keep: int, prefix: str = "v-", using: tuple[str, ...] = ()) -> list[str]:
    """Expire versioned folders under ``root`` but for the ``keep`` newest and those in ``using``; returns what went."""
    fs, target = _fs(spark, root)
    if not fs.exists(target):
        return []
    found = [f for f in fs.listStatus(target) if f.isDirectory() and f.getPath().getName().startswith(prefix)]
    found.sort(key=lambda f: f.getModificationTime(), reverse=True)
    named = {u.rstrip("/").rsplit("/", 1)[-1] for u in using}
    old = [f.getPath() for f in found[keep:] if f.getPath().getName() not in named]
    for path in old:
        fs.delete(path, True)
    return [path.getName() for path in old]


def materialize(df):
    """Cut lineage: reliable checkpoint into the shared checkpoint folder.

    Used for small derived tables that several later steps read (e.g. the
    performance fact feeding the trends fact), so the expensive plan under
    them runs once.  Never a local (executor-disk) checkpoint: it would not
    survive executor loss.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
