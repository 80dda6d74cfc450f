"""A stored table with one row for each key, merged without rewriting what a merge does not touch.

Rows lie in slots (a hash of the key, as partition folders), and in each slot
in buckets sorted by the key.  A merge reads the slots that its source's keys
fall into and no others, joins them bucket by bucket without shuffling the
table, and replaces just the slots in which a row really changes; files of the
other slots keep their names and times.

What a merge changes (old row, new row) is written first, under the merge's id.
A merge of an id that has been written works from there, so a repeated or
interrupted batch has the same effect as one, and whoever keeps aggregates of
the table (``operators.increments``) reads the same changes again.

One moment is not covered.  Spark puts new slot folders in place one by one when
the writing job commits, on the driver: lost executors do not matter, but a
driver lost just then may have removed a slot's folder whose replacement still
lies in Spark's staging folder beside it.  A table format's own MERGE has no
such moment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicelake.operators.keys import dedupe_latest
from servicelake.operators.merge import assert_same_schema
from servicelake.session import path_exists, split_session

SLOT = "_slot"


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


@dataclass
class KeyedTable:
    """Where a keyed table lies and how it is dealt; the same values must be given each time.

    A slot should be small enough to be rewritten as a whole, and slots times
    buckets follow the size of the table: 1,024 slots of 256 buckets hold 100 TB
    in files of some 400 MB.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: list[str]
    order: list[str] = field(default_factory=list)
    slots: int = 16
    buckets: int = 8

    @property
    def rows_path(self) -> str:
        return f"{self.path.rstrip('/')}/rows"

    @property
    def name(self) -> str:
        """Its name in the session's catalog, by which Spark knows the buckets."""
        return "keyed_" + hashlib.sha256(f"{self.path}|{self.slots}|{self.buckets}".encode()).hexdigest()[:24]

    @property
    def session(self) -> SparkSession:
        """The session in which the table is read, merged and written: with as many shuffle partitions as buckets.

        So what is dealt by key meets its buckets as it is, and a task's share
        does not grow with the rows, as long as the buckets follow them.
        """
        return split_session(self.spark, partitions=self.buckets)

    def _registered(self) -> str:
        spark = self.session
        if not spark.catalog.tableExists(self.name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            spark.sql(
                f"CREATE TABLE {self.name} ({columns}, {SLOT} INT) USING parquet OPTIONS (path '{self.rows_path}', partitionOverwriteMode 'dynamic') "
                f"PARTITIONED BY ({SLOT}) CLUSTERED BY ({_quoted(self.keys)}) SORTED BY ({_quoted(self.keys)}) INTO {self.buckets} BUCKETS"
            )
            if path_exists(self.spark, self.rows_path):
                spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        return self.name

    def slot(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.slots)).cast("int")

    def read(self, slots: Sequence[int] | None = None) -> DataFrame:
        """The rows, of some slots only if given: a filter on folders."""
        rows = self.session.table(self._registered())
        if slots is not None:
            rows = rows.where(F.col(SLOT).isin([int(s) for s in slots]))
        return rows.select(*self.schema.fieldNames())

    def _slots_of(self, rows: DataFrame) -> list[int]:
        """At most ``slots`` numbers."""
        return sorted(r[0] for r in rows.select(self.slot().alias("s")).distinct().collect())

    def _replace(self, rows: DataFrame) -> None:
        """Write the whole content of the slots that ``rows`` fall into, each bucket by one task."""
        rows.withColumn(SLOT, self.slot()).select(*self.schema.fieldNames(), SLOT).write.insertInto(self._registered(), overwrite=True)

    def changes_path(self, merge_id: str) -> str:
        return f"{self.path.rstrip('/')}/changes/{merge_id}"

    def merge(self, source: DataFrame, merge_id: str, latest: bool = False, on_schema_change: str = "fail") -> DataFrame:
        """Insert or update by key; returns the changes (``old``, ``new``): one row for each key whose row is new or differs.

        The source counts once for each key, its row greatest by ``order``.
        That row replaces the table's; with ``latest`` only if it is the greater
        of the two, so that merges may come in any order.  NULL keys are keys
        like others.  Nothing but the slots of changed rows is written.
        """
        path = self.changes_path(merge_id)
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            if on_schema_change == "fail":
                assert_same_schema(source, self.spark.createDataFrame([], self.schema))
            self._changes(source.select(*self.schema.fieldNames()), latest).write.mode("overwrite").parquet(path)
        pair = T.StructType([T.StructField(c, T.StructType(self.schema.fields)) for c in ("old", "new")])
        changes = self.session.read.schema(pair).parquet(path)
        self._apply(changes)
        return changes

    def _changes(self, source: DataFrame, latest: bool) -> DataFrame:
        names = self.schema.fieldNames()
        new = dedupe_latest(source, self.keys, self.order)
        target = self.read(self._slots_of(source)) if path_exists(self.spark, self.rows_path) else self.session.createDataFrame([], self.schema)
        pairs = self._pairs(target, new)
        rest = [c for c in names if c not in self.keys and c not in self.order]
        if latest:
            rank = {side: F.struct(*[F.col(f"{side}.{c}") for c in [*self.order, *rest]]) for side in ("old", "new")}
            pairs = pairs.where(F.col("old").isNull() | (rank["new"] > rank["old"]))
        return pairs.where(~F.col("old").eqNullSafe(F.col("new")))

    def _side(self, rows: DataFrame, known: bool, name: str) -> DataFrame:
        """Keys and, as a struct, the whole row of those rows whose keys are all known, or not."""
        given = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])
        return rows.where(given if known else ~given).select(*self.keys, F.struct(*self.schema.fieldNames()).alias(name))

    def _pairs(self, target: DataFrame, new: DataFrame) -> DataFrame:
        """(old, new) for each row of ``new``.

        Keys without NULL are joined by plain equality, which the buckets serve;
        the few others null-safely.
        """
        whole = self._side(target, True, "old").join(self._side(new, True, "new"), self.keys, "right")  # the table's session leads
        odd = self._side(target, False, "old").withColumnsRenamed({k: f"_old_{k}" for k in self.keys})
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in self.keys])
        return whole.select("old", "new").unionByName(self._side(new, False, "new").join(odd, on, "left").select("old", "new"))

    def _apply(self, changes: DataFrame) -> None:
        """Replace the slots of the changes: their other rows as they are, and the new ones."""
        new = changes.select("new.*")
        slots = self._slots_of(new)
        if not slots:
            return
        if not path_exists(self.spark, self.rows_path):
            self._replace(new.repartition(self.buckets, *self.keys))
            return
        target = self.read(slots)
        whole = self._side(target, True, "old").join(self._side(new, True, "new"), self.keys, "full_outer")
        odd_new = self._side(new, False, "new").withColumnsRenamed({k: f"_new_{k}" for k in self.keys})
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in self.keys])
        odd = self._side(target, False, "old").join(odd_new, on, "full_outer")
        merged = whole.select("old", "new").unionByName(odd.select("old", "new"))
        self._replace(merged.select(F.coalesce("new", "old").alias("row")).select("row.*"))


def create(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], order: Sequence[str] = (), slots: int = 16, buckets: int = 8) -> KeyedTable:
    """A new keyed table with the latest row of each key of ``rows``."""
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields])
    table = KeyedTable(spark, path, schema, list(keys), list(order), slots, buckets)
    table.merge(rows, "first")
    return table
