"""SLA flag expressions (P15-P19) and guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def within_sla(closed: str | Column, anomaly: str | Column, days: str | Column, target: str | Column) -> Column:
    """Tri-state.  Open or anomalous -> NULL, else ``days <= target``."""
    closed, anomaly, days, target = map(_c, (closed, anomaly, days, target))
    return (
        F.when(closed.isNull(), F.lit(None).cast("boolean"))
        .when(anomaly, F.lit(None).cast("boolean"))
        .when(days <= target, F.lit(True))
        .otherwise(F.lit(False))
    )


def sla_breach(closed: str | Column, anomaly: str | Column, days: str | Column, target: str | Column) -> Column:
    """Tri-state complement of P15 (NULL where P15 is NULL)."""
    closed, anomaly, days, target = map(_c, (closed, anomaly, days, target))
    return (
        F.when(closed.isNull(), F.lit(None).cast("boolean"))
        .when(anomaly, F.lit(None).cast("boolean"))
        .when(days > target, F.lit(True))
        .otherwise(F.lit(False))
    )


def days_over(days: str | Column, target: str | Column) -> Column:
    """``GREATEST(days - target, 0)`` with warehouse NULL semantics.

    Spark's ``greatest`` skips NULL arguments and would report 0 for an open
    case; the warehouse function returns NULL, so the NULL is kept explicitly.
    """
    days, target = _c(days), _c(target)
    return F.when(days.isNotNull(), F.greatest(days - target, F.lit(0)).cast("bigint"))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num::double / NULLIF(den, 0)``; 0 or NULL denominator -> NULL."""
    num, den = _c(num), _c(den)
    return num.cast("double") / F.nullif(den, F.lit(0)).cast("double")


def trend_direction(current: str | Column, earliest: str | Column) -> Column:
    """Improving / worsening / stable (either end NULL -> stable)."""
    current, earliest = _c(current), _c(earliest)
    return (
        F.when(current < earliest, F.lit("improving"))
        .when(current > earliest, F.lit("worsening"))
        .otherwise(F.lit("stable"))
    )


def relative_saving(old: str | Column, new: str | Column) -> Column:
    """P20: the share of ``old`` that ``new`` saves, in percent (negative: it takes more; NULL for nothing to compare)."""
    old, new = _c(old).cast("double"), _c(new).cast("double")
    return F.lit(100.0) - F.try_divide(new, old) * F.lit(100.0)


def change_note(old: str | Column, new: str | Column, against: str) -> Column:
    """P20 as text: the signed change of size against a named stage.

    Fixed value: the form of the text, ``(-12.3% vs stage)``; no change shows a minus.
    """
    change = F.negate(relative_saving(old, new))
    shown = F.format_string("%.1f", F.abs(change))
    return F.concat(F.lit("("), F.when(change > 0, "+").when(change.isNotNull(), "-"), shown, F.lit(f"% vs {against})"))


def speedup(baseline: str | Column, current: str | Column) -> Column:
    """``baseline / current``; NULL when either is NULL or current is 0."""
    baseline, current = _c(baseline), _c(current)
    return F.try_divide(baseline.cast("double"), F.nullif(current.cast("double"), F.lit(0.0)))
