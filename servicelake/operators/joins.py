"""Join helpers: broadcast only behind a proven size bound."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of values up to which a side is broadcast (a hash relation takes a few times as much).
MAX_BROADCAST_BYTES = 64 << 20

# DataFrames are immutable plans, so a size holds for the object's lifetime;
# remembering it saves one small job per reuse (e.g. a seed frame joined by
# many queries).
_SIZES: "weakref.WeakKeyDictionary[DataFrame, int]" = weakref.WeakKeyDictionary()


def size_in_bytes(df: DataFrame) -> int:
    """Bytes of all values of ``df``: a fixed width for each, and the length of texts.

    One partially aggregated pass: each task sends one row.  Only the columns
    of ``df`` are read, so pass a projection (the keys of a key set).
    """
    known = _SIZES.get(df)
    if known is None:
        texts = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))]
        lengths = [F.coalesce(F.sum(F.octet_length(F.col(c).cast("string"))), F.lit(0)) for c in texts]
        width = 8 * (len(df.columns) + 1)
        known = df.agg((F.count(F.lit(1)) * width + sum(lengths, F.lit(0))).cast("long")).first()[0]
        _SIZES[df] = known
    return known


def bounded_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only if its values are measured to take ``max_bytes`` at most.

    Otherwise the frame is returned unchanged and the planner picks a
    shuffle join (or AQE converts it at runtime when its measured size is
    under ``spark.sql.adaptive.autoBroadcastJoinThreshold``).
    """
    return F.broadcast(df) if size_in_bytes(df) <= max_bytes else df
