"""Incremental model semantics.

The staging table is a key-unique merge target.  An upsert is expressed as
``target ANTI JOIN source_keys UNION source``: matched keys take the source
row, unmatched target rows stay, new keys are inserted.  The source is
deduplicated first so it contributes exactly one row per key.  The result is
written to a *new* path; callers switch to it after the write succeeds, so a
failed job never leaves a half-overwritten table it was reading from.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicelake.operators.keys import dedupe_latest


def _null_safe(keys: Sequence[str], prefix: str) -> Column:
    """Equality of each key with the other side's, named with a prefix; NULL equals NULL."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


class SchemaChangeError(RuntimeError):
    """M3: the incoming columns differ from the target's (policy ``fail``)."""


def high_water_mark(target: DataFrame, ts: str):
    """``(SELECT MAX(ts) FROM target)`` as a scalar-subquery column."""
    return target.agg(F.max(ts)).scalar()


def incremental_select(source: DataFrame, target: DataFrame | None, ts: str) -> DataFrame:
    """M1: rows newer than the target's high-water mark; first run -> all."""
    if target is None:
        return source
    return source.where(F.col(ts) > high_water_mark(target, ts))


def assert_same_schema(incoming: DataFrame, target: DataFrame) -> None:
    """M3: fail loudly on added, removed or retyped columns."""
    a = {f.name: f.dataType.simpleString() for f in incoming.schema.fields}
    b = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    if a != b:
        added = sorted(set(a) - set(b))
        removed = sorted(set(b) - set(a))
        retyped = sorted(k for k in set(a) & set(b) if a[k] != b[k])
        raise SchemaChangeError(f"schema change: added={added} removed={removed} retyped={retyped}")


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    on_schema_change: str = "fail",
    source_is_small: bool = False,
) -> DataFrame:
    """Merge ``source`` into ``target`` by ``key``.

    Idempotent: ``upsert(upsert(t, s), s) == upsert(t, s)``.  The source is
    read twice (its keys for the anti join, its rows for the union), the
    target once.  A caller that knows the source's keys to be few (say from
    the footers of a written increment) passes ``source_is_small``: they are
    broadcast and the target is streamed.  Otherwise the planner decides from
    measured sizes, and AQE splits a skewed target partition.  A NULL key is a
    key like others.  (``operators.keyed`` merges a stored table in place.)
    """
    keys = [key] if isinstance(key, str) else list(key)
    if on_schema_change == "fail":
        assert_same_schema(source, target)
    src = dedupe_latest(source, keys, order)
    src_keys = src.select(*[F.col(k).alias(f"_src_{k}") for k in keys])
    if source_is_small:
        src_keys = F.broadcast(src_keys)
    kept = target.join(src_keys, on=_null_safe(keys, "_src_"), how="left_anti")
    return kept.unionByName(src)


def changed_rows(
    old: DataFrame,
    new: DataFrame,
    key: str | Sequence[str],
    compare: Sequence[str],
) -> DataFrame:
    """M6: rows of ``new`` that are new keys or differ from ``old`` in ``compare``.

    Catches late updates (a request that closes after it was first loaded),
    which a created-date high-water mark never revisits.  NULL-safe.
    """
    keys = [key] if isinstance(key, str) else list(key)
    prev = old.select(*[F.col(c).alias(f"_old_{c}") for c in dict.fromkeys([*keys, *compare])], F.lit(True).alias("_seen"))
    joined = new.join(prev, on=_null_safe(keys, "_old_"), how="left")
    differs = F.lit(False)
    for c in compare:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    change = F.when(F.col("_seen").isNull(), F.lit("inserted")).when(differs, F.lit("updated"))
    return (
        joined.withColumn("change_kind", change)
        .where(F.col("change_kind").isNotNull())
        .select(*new.columns, "change_kind")
    )


def full_refresh(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """M4: overwrite the model from scratch."""
    df.write.mode("overwrite").format(fmt).save(path)
    return path
