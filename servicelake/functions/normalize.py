"""Category normalisation and anomaly flags.

Rules are data: an ordered list of ``(kind, patterns, label)``.  They fold
into one ``CASE WHEN`` chain, first match wins, so the expression stays a
single JVM-side projection inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from servicelake.functions.clean import day_diff

# The complaint-type normalisation rules, in evaluation order.
# kind "ilike" = case-insensitive LIKE on any of the patterns,
# kind "equals" = exact, case-sensitive equality.
CATEGORY_RULES: tuple[tuple[str, tuple[str, ...], str], ...] = (
    ("ilike", ("%Noise%Residential%",), "NOISE - RESIDENTIAL"),
    ("ilike", ("%Heat%", "%Hot Water%"), "HEAT/HOT WATER"),
    ("ilike", ("%Unsanitary%",), "UNSANITARY CONDITION"),
    ("ilike", ("%Illegal Parking%",), "ILLEGAL PARKING"),
    ("ilike", ("%Water Leak%",), "WATER LEAK"),
    ("ilike", ("%Rodent%",), "RODENT"),
    ("equals", ("Street Condition",), "STREET CONDITION"),
    ("equals", ("Sidewalk Condition",), "SIDEWALK CONDITION"),
    ("ilike", ("%Broken Parking Meter%",), "BROKEN MUNI METER"),
)

# Anomaly reasons, in precedence order.
REASON_RETROACTIVE = "retroactively merged case"
REASON_ABANDONED = "abandoned case never properly closed"
REASON_NO_BOROUGH = "missing borough value"

# Fixed value: resolution beyond this many days marks an abandoned case.
ABANDONED_AFTER_DAYS = 730


def _rule_predicate(source: Column, kind: str, patterns: Sequence[str]) -> Column:
    if kind == "ilike":
        preds = [source.ilike(p) for p in patterns]
    elif kind == "equals":
        preds = [source == F.lit(p) for p in patterns]
    else:
        raise ValueError(f"unknown rule kind {kind!r}")
    out = preds[0]
    for p in preds[1:]:
        out = out | p
    return out


def normalize_category(
    c: str | Column,
    rules: Sequence[tuple[str, Sequence[str], str]] = CATEGORY_RULES,
) -> Column:
    """First matching rule's label, else ``UPPER(TRIM(c))``."""
    source = F.col(c) if isinstance(c, str) else c
    expr = None
    for kind, patterns, label in rules:
        pred = _rule_predicate(source, kind, patterns)
        expr = F.when(pred, F.lit(label)) if expr is None else expr.when(pred, F.lit(label))
    fallback = F.upper(F.trim(source))
    return fallback if expr is None else expr.otherwise(fallback)


def _anomaly_conditions(created: Column, closed: Column, borough: Column, max_days: int):
    return (
        (closed < created, REASON_RETROACTIVE),
        (day_diff(created, closed) > F.lit(max_days), REASON_ABANDONED),
        (borough.isNull() | (F.trim(borough) == F.lit("")), REASON_NO_BOROUGH),
    )


def anomaly_flag(
    created: str | Column = "created_date",
    closed: str | Column = "closed_date",
    borough: str | Column = "borough",
    max_days: int = ABANDONED_AFTER_DAYS,
) -> Column:
    """Never NULL.  A NULL comparison (open case) is simply not a hit."""
    conds = _anomaly_conditions(*(F.col(x) if isinstance(x, str) else x for x in (created, closed, borough)), max_days)
    expr = None
    for cond, _ in conds:
        expr = F.when(cond, F.lit(True)) if expr is None else expr.when(cond, F.lit(True))
    return expr.otherwise(F.lit(False))


def anomaly_reason(
    created: str | Column = "created_date",
    closed: str | Column = "closed_date",
    borough: str | Column = "borough",
    max_days: int = ABANDONED_AFTER_DAYS,
) -> Column:
    """Reason of the first cause that fires, same precedence as P13."""
    conds = _anomaly_conditions(*(F.col(x) if isinstance(x, str) else x for x in (created, closed, borough)), max_days)
    expr = None
    for cond, reason in conds:
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr.otherwise(F.lit(None).cast("string"))
