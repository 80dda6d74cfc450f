"""Declarative data-quality checks and the severity gate (Q1-Q10).

A suite is a list of :class:`Check`.  All row-level checks on one table are
folded into a single aggregation pass (one partial hash aggregate); only
uniqueness needs its own shuffle (``groupBy(col)``, partially aggregated).
Every check yields one row::

    check, table, metric, threshold, severity, passed
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicelake.functions.clean import seconds_between

ERROR = "error"
WARN = "warn"

RESULT_SCHEMA = "check string, table string, metric double, threshold string, severity string, passed boolean"
RESULT_COLUMNS = ("check", "table", "metric", "threshold", "severity", "passed")


class QualityGateError(RuntimeError):
    """Q9: at least one error-severity check failed."""


@dataclass(frozen=True)
class Check:
    """One declarative check.

    kind:
      ``row_count_gt``        metric = rows;                 pass if metric > threshold
      ``missing_count_eq``    metric = NULL count;           pass if metric == threshold
      ``unique``              metric = duplicated values;    pass if metric == 0
      ``accepted_values``     metric = non-NULL values outside ``values``; pass if 0
      ``invalid_percent_lt``  metric = 100 * invalid / rows (``values`` or ``min``/``max``);
                              pass if metric < threshold
      ``between``             metric = non-NULL values outside [min, max]; pass if 0
      ``freshness_lt_days``   metric = days from max(column) to ``as_of``; pass if < threshold
    """

    name: str
    kind: str
    column: str | None = None
    threshold: float = 0.0
    severity: str = ERROR
    values: tuple = field(default_factory=tuple)
    min: float | None = None
    max: float | None = None


def _invalid(check: Check) -> Column:
    c = F.col(check.column)
    if check.values:
        bad = ~c.isin(list(check.values))
    else:
        lo = F.lit(check.min) if check.min is not None else None
        hi = F.lit(check.max) if check.max is not None else None
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (c < lo)
        if hi is not None:
            bad = bad | (c > hi)
    return c.isNotNull() & bad


# A metric is assembled from mergeable partial aggregates: each partial is
# (name, row-level aggregate, merge kind), and the final metric is an
# expression over the merged partials.  This lets the whole suite run as one
# partially aggregated pass, grouped by the key of a uniqueness check if the
# suite has one (so that check needs no separate scan).
_ROWS = "_rows"


def _partials(i: int, check: Check) -> list[tuple[str, Column, str]]:
    k = check.kind
    if k == "row_count_gt":
        return []
    if k == "missing_count_eq":
        return [(f"_p{i}", F.count_if(F.col(check.column).isNull()), "sum")]
    if k in ("accepted_values", "between", "invalid_percent_lt"):
        return [(f"_p{i}", F.count_if(_invalid(check)), "sum")]
    if k == "freshness_lt_days":
        return [(f"_p{i}", F.max(F.col(check.column)), "max")]
    if k == "unique":
        return []
    raise ValueError(f"unknown check kind {check.kind!r}")


def _final(i: int, check: Check, as_of: Column | None, dup_col: str | None) -> tuple[Column, Column]:
    thr = F.lit(float(check.threshold))
    rows = F.col(_ROWS)
    k = check.kind
    if k == "row_count_gt":
        m = rows.cast("double")
        return m, m > thr
    if k == "missing_count_eq":
        m = F.col(f"_p{i}").cast("double")
        return m, m == thr
    if k in ("accepted_values", "between"):
        m = F.col(f"_p{i}").cast("double")
        return m, m == F.lit(0.0)
    if k == "invalid_percent_lt":
        m = F.lit(100.0) * F.col(f"_p{i}") / F.nullif(rows, F.lit(0))
        return m, F.coalesce(m < thr, F.lit(True))
    if k == "freshness_lt_days":
        if as_of is None:
            raise ValueError("freshness checks need as_of")
        newest = F.col(f"_p{i}").cast("timestamp_ntz")
        # Wall-clock difference of two NTZ values: no time zone involved.
        m = seconds_between(newest, as_of).cast("double") / F.lit(86400.0)
        return m, F.coalesce(m < thr, F.lit(False))
    if k == "unique":
        m = F.col(dup_col).cast("double")
        return m, m == F.lit(0.0)
    raise ValueError(f"unknown check kind {check.kind!r}")


def _threshold_text(check: Check) -> str:
    if check.kind == "row_count_gt":
        return f"> {check.threshold:g}"
    if check.kind in ("missing_count_eq",):
        return f"= {check.threshold:g}"
    if check.kind == "invalid_percent_lt":
        return f"< {check.threshold:g}%"
    if check.kind == "freshness_lt_days":
        return f"< {check.threshold:g}d"
    return "= 0"


def _result_row(check: Check, table: str, metric: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check"),
        F.lit(table).alias("table"),
        metric.cast("double").alias("metric"),
        F.lit(_threshold_text(check)).alias("threshold"),
        F.lit(check.severity).alias("severity"),
        passed.alias("passed"),
    )


def run_checks(
    df: DataFrame,
    table: str,
    checks: Sequence[Check],
    as_of: dt.datetime | dt.date | str | None = None,
) -> DataFrame:
    """Evaluate a suite against ``df`` in one scan.

    Without a uniqueness check this is one global aggregate.  With one, the
    rows are first aggregated per key of the (first) uniqueness check --
    a partial hash aggregate, so a hot key is combined before the shuffle --
    and every other metric is merged from those per-key partials; the number
    of duplicated keys falls out of the same pass.  Uniqueness checks on
    further columns need their own grouping and run as extra passes.
    """
    if not checks:
        raise ValueError("empty check suite")
    as_of_col = F.lit(str(as_of)).cast("timestamp_ntz") if as_of is not None else None
    uniques = [c for c in checks if c.kind == "unique"]
    key = uniques[0].column if uniques else None
    parts = [p for i, c in enumerate(checks) for p in _partials(i, c)]
    if key is None:
        merged = df.agg(F.count(F.lit(1)).alias(_ROWS), *[agg.alias(n) for n, agg, _ in parts])
        dup_cols: dict[str, str] = {}
    else:
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias(_ROWS), *[agg.alias(n) for n, agg, _ in parts])
        merge = {"sum": F.sum, "max": F.max}
        merged = per_key.agg(
            F.sum(_ROWS).alias(_ROWS),
            F.count_if(F.col(key).isNotNull() & (F.col(_ROWS) > 1)).alias("_dups"),
            *[merge[kind](n).alias(n) for n, _, kind in parts],
        )
        dup_cols = {key: "_dups"}
    rows = []
    extra = []
    for i, chk in enumerate(checks):
        if chk.kind == "unique" and chk.column not in dup_cols:
            extra.append(chk)
            continue
        metric, passed = _final(i, chk, as_of_col, dup_cols.get(chk.column))
        rows.append(_result_row(chk, table, metric, passed))
    out = merged.select(F.inline(F.array(*rows)))
    for chk in extra:
        dups = duplicate_values(df, chk.column).agg(F.count(F.lit(1)).alias("_dups"))
        metric, passed = _final(0, chk, as_of_col, "_dups")
        out = out.unionByName(dups.select(F.inline(F.array(_result_row(chk, table, metric, passed)))))
    return out


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Q3: non-NULL values of ``column`` that occur more than once, with copies."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def invalid_values(df: DataFrame, check: Check) -> DataFrame:
    """Q4-Q7 detail: the offending values of one check with their counts."""
    return df.where(_invalid(check)).groupBy(check.column).agg(F.count(F.lit(1)).alias("rows"))


def freshness(df: DataFrame, column: str, as_of, max_days: float) -> DataFrame:
    """Q8 detail: newest value, its age in days at ``as_of`` and the verdict."""
    chk = Check("freshness", "freshness_lt_days", column, max_days)
    as_of_col = F.lit(str(as_of)).cast("timestamp_ntz")
    newest = df.agg(F.max(column).alias("_p0"))
    metric, passed = _final(0, chk, as_of_col, None)
    return newest.select(
        F.col("_p0").alias("newest"), as_of_col.alias("as_of"), metric.alias("age_days"), passed.alias("passed")
    )


def failed_checks(results: DataFrame) -> DataFrame:
    """Q10: the checks that did not pass."""
    return results.where(~F.col("passed"))


def gate(results: DataFrame) -> DataFrame:
    """Q9: raise when an error-severity check failed; warnings only report.

    Collects at most one row per check (the suite size), never data rows.
    """
    failed = failed_checks(results).select("check", "table", "severity", "metric").collect()
    errors = [r for r in failed if r["severity"] == ERROR]
    if errors:
        names = ", ".join(f"{r['table']}.{r['check']}" for r in errors)
        raise QualityGateError(f"{len(errors)} error check(s) failed: {names}")
    return results


# The source/staging/gold check suites of the SLA lakehouse.
ACCEPTED_BOROUGHS = ("BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND", "UNSPECIFIED")


def staging_suite(
    valid_boroughs: Sequence[str] = ACCEPTED_BOROUGHS,
    min_rows: int = 1_000_000,
) -> list[Check]:
    return [
        Check("Minimum row count check", "row_count_gt", None, min_rows),
        Check("No missing primary keys", "missing_count_eq", "unique_key", 0),
        Check("No missing created dates", "missing_count_eq", "created_date", 0),
        Check("Borough values mostly valid", "invalid_percent_lt", "borough", 1.0, values=tuple(valid_boroughs)),
        Check("Data freshness check", "freshness_lt_days", "created_date", 30),
        Check("unique_key unique", "unique", "unique_key"),
        Check("borough accepted values", "accepted_values", "borough", severity=WARN, values=tuple(valid_boroughs)),
        Check("resolution_days between", "between", "resolution_days", severity=WARN, min=-365, max=3650),
    ]


def source_suite(valid_boroughs: Sequence[str] = ACCEPTED_BOROUGHS, unique: bool = False) -> list[Check]:
    """Checks of the silver table.  Its keys repeat until staging re-decides
    them (append-only loads), so their uniqueness only warns, where asked for."""
    checks = [
        Check("unique_key not null", "missing_count_eq", "unique_key", 0),
        Check("created_date not null", "missing_count_eq", "created_date", 0),
        Check("borough accepted values", "accepted_values", "borough", severity=WARN, values=tuple(valid_boroughs)),
    ]
    return checks + [Check("unique_key unique", "unique", "unique_key", severity=WARN)] * unique


def trends_suite() -> list[Check]:
    return [Check("breach_rate_current not null", "missing_count_eq", "breach_rate_current", 0)]


def gold_suite(min_rows: int = 20) -> list[Check]:
    return [
        Check("Minimum aggregated rows", "row_count_gt", None, min_rows),
        Check("No missing breach rates", "missing_count_eq", "sla_breach_rate", 0),
        Check("Breach rate bounds check", "invalid_percent_lt", "sla_breach_rate", 5.0, min=0, max=1),
    ]


def seed_suite() -> list[Check]:
    return [
        Check("complaint_type not null", "missing_count_eq", "complaint_type", 0),
        Check("complaint_type unique", "unique", "complaint_type"),
        Check("target_days not null", "missing_count_eq", "target_days", 0),
    ]

