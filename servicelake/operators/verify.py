"""Verification operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ParityError(AssertionError):
    """Two readers or layouts disagree."""


def coordinate_null_share(df: DataFrame, coord_col: str = "latitude") -> DataFrame:
    """rows, rows with a NULL coordinate and their percentage, one pass."""
    total = F.count(F.lit(1))
    nulls = F.count_if(F.col(coord_col).isNull())
    return df.agg(
        total.alias("total_rows"),
        nulls.alias("null_coordinates"),
        (F.lit(100.0) * nulls / F.nullif(total, F.lit(0))).alias("null_pct"),
    )


def count_parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """V1 as data: both row counts and whether they agree (one row)."""
    right_rows = right.agg(F.count(F.lit(1))).scalar()
    lc = left.agg(F.count(F.lit(1)).alias("left_rows")).withColumn("right_rows", right_rows)
    return lc.withColumn("equal", F.col("left_rows") == F.col("right_rows"))


def assert_count_parity(left: DataFrame, right: DataFrame) -> int:
    """V1: raise :class:`ParityError` when two readers see different counts."""
    row = count_parity(left, right).first()
    if not row["equal"]:
        raise ParityError(f"row counts differ: {row['left_rows']} vs {row['right_rows']}")
    return row["left_rows"]


def fingerprint(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Order-independent content fingerprint: row count + sum of row hashes.

    One pass, partially aggregated; the hash sum is DECIMAL(38,0) so it
    cannot overflow.  Duplicates count (multiset semantics).
    """
    cols = cols or sorted(df.columns)
    h = F.xxhash64(*[F.col(c) for c in cols]).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(h), F.lit(0)).cast("decimal(38,0)").alias("hash_sum"))


def content_parity(left: DataFrame, right: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """V2: layer parity by fingerprint (one row)."""
    cols = cols or sorted(left.columns)
    rf = fingerprint(right.select(*cols), cols)
    lf = fingerprint(left, cols).select(
        F.col("rows").alias("left_rows"),
        F.col("hash_sum").alias("left_hash"),
        rf.select("rows").scalar().alias("right_rows"),
        rf.select("hash_sum").scalar().alias("right_hash"),
    )
    return lf.withColumn(
        "equal", (F.col("left_rows") == F.col("right_rows")) & (F.col("left_hash") == F.col("right_hash"))
    )


def content_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """V2 detail: rows only in one side (multiset), tagged with the side."""
    cols = sorted(left.columns)
    l, r = left.select(*cols), right.select(*cols)
    return l.exceptAll(r).withColumn("side", F.lit("left_only")).unionByName(
        r.exceptAll(l).withColumn("side", F.lit("right_only"))
    )


def validate_only(df: DataFrame, coord_col: str = "latitude") -> DataFrame:
    """V3: dry-run validation -- rows, columns and NULL-coordinate share; no write."""
    return coordinate_null_share(df, coord_col).withColumn("columns", F.lit(len(df.columns)))


def coordinate_disagreement(
    parent: DataFrame,
    child: DataFrame,
    key: str,
    pairs: list[tuple[str, str]],
) -> DataFrame:
    """Left join child coordinates onto parents and count disagreements.

    ``pairs`` maps parent columns to child columns.  Rows count as compared
    when the child matched and every pair has both values present; a
    compared row disagrees when any pair differs.
    """
    c = child.select(F.col(key), *[F.col(cc).alias(f"_child_{i}") for i, (_, cc) in enumerate(pairs)], F.lit(True).alias("_matched"))
    j = parent.join(c, key, "left")
    matched = F.col("_matched").isNotNull()
    present = matched
    differs = F.lit(False)
    for i, (pc, _) in enumerate(pairs):
        present = present & F.col(pc).isNotNull() & F.col(f"_child_{i}").isNotNull()
        differs = differs | (F.col(pc) != F.col(f"_child_{i}"))
    return j.agg(
        F.count(F.lit(1)).alias("parent_rows"),
        F.count_if(matched).alias("matched_rows"),
        F.count_if(present).alias("compared_rows"),
        F.count_if(present & differs).alias("disagreements"),
    )
