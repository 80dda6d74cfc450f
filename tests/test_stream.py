import os
import time

import pytest
from pyspark.sql import functions as F

from servicelake.streaming import ingest
from servicelake.streaming.ingest import ingest_available, read_sink
from tests.conftest import SF_SMALL


def test_rerun_adds_nothing(spark, tmp_dir):
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    sink, ckpt = f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    first = ingest_available(spark, SF_SMALL, schema, sink, ckpt, glob="events.parquet")
    total = read_sink(spark, sink).count()
    assert first == total == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    second = ingest_available(spark, SF_SMALL, schema, sink, ckpt, glob="events.parquet")
    assert second == 0 and read_sink(spark, sink).count() == total


def _add(spark, folder, first, n):
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    spark.range(first, first + n).coalesce(1).write.mode("append").parquet(folder)
    return [f"{folder}/{f}" for f in os.listdir(folder) if f not in before and f.startswith("part-")]


def test_old_and_same_second_files_are_ingested(spark, tmp_dir):
    source, sink, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    now = time.time()
    for path in _add(spark, source, 0, 10):
        os.utime(path, (now, now))
    assert ingest_available(spark, source, "id long", sink, ckpt) == 10
    for path in _add(spark, source, 10, 5):  # a copied file, ten days old
        os.utime(path, (now - 10 * 86400,) * 2)
    for path in _add(spark, source, 15, 3):  # the same second as one already seen
        os.utime(path, (now, now))
    assert ingest_available(spark, source, "id long", sink, ckpt) == 8
    assert sorted(r.id for r in read_sink(spark, sink).collect()) == list(range(18))


def test_many_batches_are_all_counted(spark, tmp_dir):
    source = f"{tmp_dir}/in"
    spark.range(104).repartition(104).write.option("maxRecordsPerFile", 1).parquet(source)
    rows = ingest_available(spark, source, "id long", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", max_files_per_trigger=1)
    assert rows == 104 == read_sink(spark, f"{tmp_dir}/sink").count()


def test_a_file_left_out_is_an_error(spark, tmp_dir, monkeypatch):
    source, now = f"{tmp_dir}/in", time.time()
    for path in _add(spark, source, 0, 10):
        os.utime(path, (now, now))
    for path in _add(spark, source, 10, 5):
        os.utime(path, (now - 10 * 86400,) * 2)
    monkeypatch.setattr(ingest, "MAX_FILE_AGE", "1d")
    # files with a space and a percent sign in their path are told apart, too
    assert ingest_available(spark, source, "id long", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt") == 15  # the first batch has no age to hold against
    for path in _add(spark, source, 15, 5):
        os.utime(path, (now - 10 * 86400,) * 2)
    with pytest.raises(ingest.IngestError):
        ingest_available(spark, source, "id long", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt")


def test_odd_names_and_empty_folders(spark, tmp_dir):
    source = f"{tmp_dir}/in put+100%"
    os.makedirs(source)
    assert ingest_available(spark, source, "id long", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt") == 0
    _add(spark, source, 0, 4)
    tagged = ingest_available(spark, source, "id long", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", transform=lambda s: s.withColumn("file", F.col("_metadata.file_path")))
    assert tagged == 4
