"""Staging, enrichment and the two gold SLA facts (J1-J3, A3-A5, K2, R-2..R-7).

The chain ``stage_requests -> enrich -> sla_performance`` is one lazy plan.
The trends fact and reports read the *stored* performance fact (see
``plans.gold.build_gold``): they use it several times (scalar subquery,
top-k, pivot), and a stored table keeps the requests scan to one pass.
Scale notes:

* the targets seed is broadcast only after a bounded row-count check;
* every aggregate is partial-aggregable: the performance fact first counts
  rows per (group, day, flags) with a code-generated hash aggregate, so a
  hot group is combined map-side before the shuffle, and its exact
  percentiles come from that small histogram;
* the top-k set is bounded by its limit, so broadcasting it is safe;
* the "current year" is a scalar subquery, not a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from servicelake.functions.clean import calendar_year, day_diff
from servicelake.functions.normalize import anomaly_flag, anomaly_reason, normalize_category
from servicelake.functions.sla import days_over, safe_ratio, sla_breach, trend_direction, within_sla
from servicelake.operators.joins import bounded_broadcast

TREND_YEARS = 5

PERF_KEYS = ("complaint_type", "responsible_agency", "calendar_year", "target_days")


def stage_requests(typed: DataFrame) -> DataFrame:
    """Staging model: normalised borough/category, day difference, anomaly flags.

    Rows are flagged, never dropped.
    """
    created, closed, borough = F.col("created_date"), F.col("closed_date"), F.col("borough")
    return typed.select(
        "unique_key",
        "created_date",
        "closed_date",
        F.upper(F.trim(borough)).alias("borough"),
        F.trim("complaint_type").alias("complaint_type"),
        "agency",
        "status",
        normalize_category("complaint_type").alias("complaint_type_normalized"),
        day_diff(created, closed).alias("resolution_days"),
        anomaly_flag(created, closed, borough).alias("is_anomaly"),
        anomaly_reason(created, closed, borough).alias("anomaly_reason"),
    )


def enrich(staged: DataFrame, targets: DataFrame) -> DataFrame:
    """J1 + P15-P17 + P9: join to SLA targets and derive SLA outcome columns.

    An inner join: a breach is measured against a target, and a request of a
    category that has none cannot be late.
    """
    t = bounded_broadcast(targets).select(
        F.col("complaint_type").alias("_target_type"), "responsible_agency", "target_days"
    ).where(F.col("_target_type").isNotNull())
    # Null-safe key on a side without NULL keys: the same rows as ``=``, but
    # Catalyst does not infer an ``isnotnull(normalised category)`` filter,
    # which it would push below the projection and so evaluate the whole
    # category CASE chain twice per row.
    joined = staged.join(t, staged.complaint_type_normalized.eqNullSafe(F.col("_target_type")), "inner")
    rd, target = F.col("resolution_days"), F.col("target_days")
    return joined.select(
        "unique_key",
        "created_date",
        "closed_date",
        "borough",
        "complaint_type_normalized",
        "resolution_days",
        "is_anomaly",
        "anomaly_reason",
        "responsible_agency",
        "target_days",
        within_sla("closed_date", "is_anomaly", rd, target).alias("is_within_sla"),
        sla_breach("closed_date", "is_anomaly", rd, target).alias("is_sla_breach"),
        days_over(rd, target).alias("days_over_sla"),
        calendar_year("created_date").alias("calendar_year"),
    )


def _rank_pos(n: Column, q: float) -> Column:
    return (n - F.lit(1)).cast("double") * F.lit(q)


def _value_at_rank(rank: Column, cum: Column, day: Column, clean: Column) -> Column:
    """Aggregate: the clean value at 0-based ``rank`` of a day histogram.

    ``cum`` is the inclusive running count of clean rows ordered by day, so
    the value at rank ``i`` is the smallest day whose running count exceeds
    ``i``.
    """
    return F.min(F.when(clean & (cum > rank), day))


def performance_histogram(enriched: DataFrame) -> DataFrame:
    """Rows counted (``_n``) by group, clean resolution day, closed or not, breach or not.

    Counts can be added and taken away, so the histogram of a changed table is
    the old one plus that of new rows less that of replaced ones
    (``operators.increments``).
    """
    keys = [F.col("complaint_type_normalized").alias("complaint_type"), "responsible_agency", "calendar_year", "target_days"]
    # Only clean (non-anomalous, closed) rows need their day; keying every
    # other row to a NULL day bounds the histogram by groups x 731 days.
    return enriched.groupBy(
        *keys,
        F.when(~F.col("is_anomaly"), F.col("resolution_days")).alias("_day"),
        F.col("closed_date").isNotNull().alias("_closed"),
        F.col("is_sla_breach").alias("_breach"),
    ).agg(F.count(F.lit(1)).alias("_n"))


def sla_performance(enriched: DataFrame) -> DataFrame:
    """A3: one row per (category, agency, year, target) with 7 measures."""
    return performance_of(performance_histogram(enriched))


def performance_of(cube: DataFrame) -> DataFrame:
    """A3 from a histogram of ``performance_histogram``.

    Breach rate keeps the warehouse model's asymmetry: the denominator is all
    closed requests (anomalies included), the numerator excludes anomalies.

    Plan: rows are first counted per (group, clean resolution day, closed?,
    breach?) -- a code-generated hash aggregate, partially
    aggregated before its shuffle, whose output is tiny (groups x distinct
    days).  Every measure, including the exact continuous percentiles
    (linear interpolation between ranks floor/ceil of ``q * (n - 1)``), is
    computed from that histogram; the running count is a window per group
    that holds one row per distinct day of the group, never its rows.
    """
    day = F.col("_day")
    clean = day.isNotNull()
    clean_n = F.when(clean, F.col("_n")).otherwise(F.lit(0))
    group = Window.partitionBy(*PERF_KEYS)
    running = group.orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = cube.withColumns({"_cum": F.sum(clean_n).over(running), "_ncl": F.sum(clean_n).over(group)})
    cum, ncl = F.col("_cum"), F.col("_ncl")
    bounds = {}
    for q in (0.5, 0.9):
        pos = _rank_pos(ncl, q)
        tag = int(q * 100)
        bounds[f"_lo{tag}"] = _value_at_rank(F.floor(pos), cum, day, clean)
        bounds[f"_hi{tag}"] = _value_at_rank(F.ceil(pos), cum, day, clean)
    agg = ranked.groupBy(*PERF_KEYS).agg(
        F.sum("_n").alias("total_requests"),
        F.sum(F.when(F.col("_closed"), F.col("_n")).otherwise(F.lit(0))).alias("closed_requests"),
        F.sum(F.when(F.col("_breach"), F.col("_n")).otherwise(F.lit(0))).alias("sla_breach_count"),
        F.sum(F.when(clean, day * F.col("_n"))).alias("_day_sum"),
        F.max(ncl).alias("_ncl"),
        *[v.alias(k) for k, v in bounds.items()],
    )

    def interpolate(q: float) -> Column:
        pos = _rank_pos(F.col("_ncl"), q)
        tag = int(q * 100)
        lo, hi = F.col(f"_lo{tag}"), F.col(f"_hi{tag}")
        return lo + (pos - F.floor(pos)) * (hi - lo)

    return agg.select(
        *PERF_KEYS,
        "total_requests",
        "closed_requests",
        "sla_breach_count",
        safe_ratio("sla_breach_count", "closed_requests").alias("sla_breach_rate"),
        (F.col("_day_sum").cast("double") / F.nullif(F.col("_ncl"), F.lit(0)).cast("double")).alias("avg_resolution_days"),
        interpolate(0.5).alias("p50_resolution_days"),
        interpolate(0.9).alias("p90_resolution_days"),
    )


def last_complete_year(staged: DataFrame, ts_col: str = "created_date") -> Column:
    """A5 helper: newest year whose data reaches 31 December, as a scalar subquery."""
    newest = F.max(F.col(ts_col))
    year = F.year(newest) - F.when((F.month(newest) == 12) & (F.dayofmonth(newest) == 31), 0).otherwise(1)
    return staged.agg(year.cast("bigint").alias("y")).scalar()


def current_year(perf: DataFrame, year_cap: int | Column) -> Column:
    """A5: ``MAX(calendar_year) WHERE calendar_year <= cap`` as a scalar subquery."""
    cap = F.lit(year_cap) if isinstance(year_cap, int) else year_cap
    return perf.where(F.col("calendar_year") <= cap).agg(F.max("calendar_year")).scalar()


def top_breach(perf: DataFrame, year_cap: int | Column, n: int = 10) -> DataFrame:
    """K2/R-5: top-``n`` (category, agency) by breach rate in the current year.

    NULL rates sort last; category and agency break ties so the set is
    deterministic.  ``TakeOrderedAndProject``: each task keeps ``n`` rows.
    """
    return _top_in_year(perf, current_year(perf, year_cap), n)


def _top_in_year(perf: DataFrame, year: Column, n: int) -> DataFrame:
    return (
        perf.where(F.col("calendar_year") == year)
        .orderBy(F.desc_nulls_last("sla_breach_rate"), F.asc("complaint_type"), F.asc("responsible_agency"))
        .limit(n)
        .select("complaint_type", "responsible_agency", "calendar_year", "sla_breach_rate")
    )


def sla_trends(perf: DataFrame, year_cap: int | Column, n: int = 10, years: int = TREND_YEARS) -> DataFrame:
    """R-2: five-year breach-rate pivot and trend for the current top ``n``.

    A5 -> K2 -> J2 (join to a set of at most ``n`` rows, broadcast) -> A4
    (conditional-max pivot with fixed column names) -> P19.
    """
    cur = current_year(perf, year_cap)
    top = _top_in_year(perf, cur, n).select("complaint_type", "responsible_agency")
    window = perf.where(F.col("calendar_year") >= cur - (years - 1)).join(
        F.broadcast(top), ["complaint_type", "responsible_agency"], "inner"
    )
    year, rate = F.col("calendar_year"), F.col("sla_breach_rate")
    cols = [
        F.max(F.when(year == cur - k, rate)).alias(f"breach_rate_y_minus_{k}")
        for k in range(years - 1, 0, -1)
    ]
    cols.append(F.max(F.when(year == cur, rate)).alias("breach_rate_current"))
    pivot = window.groupBy("complaint_type", "responsible_agency", "target_days").agg(*cols)
    return pivot.withColumn(
        "trend_direction",
        trend_direction("breach_rate_current", f"breach_rate_y_minus_{years - 1}"),
    )


def trend_report(trends: DataFrame) -> DataFrame:
    """R-3: ordered report with rates formatted as percentages."""
    rate_cols = [c for c in trends.columns if c.startswith("breach_rate_")]
    formatted = [
        F.when(F.col(c).isNotNull(), F.concat(F.format_number(F.col(c) * 100, 1), F.lit("%"))).alias(f"{c}_pct")
        for c in rate_cols
    ]
    return trends.select(
        "complaint_type", "responsible_agency", *rate_cols, *formatted, F.upper("trend_direction").alias("trend")
    ).orderBy(F.desc_nulls_last("breach_rate_current"), "complaint_type", "responsible_agency")


def agency_year_breach(perf: DataFrame) -> DataFrame:
    """R-4: breach rate per agency and year = sum(breaches) / sum(closed)."""
    agg = perf.groupBy("responsible_agency", "calendar_year").agg(
        F.sum("total_requests").alias("total_requests"),
        F.sum("closed_requests").alias("closed_requests"),
        F.sum("sla_breach_count").alias("sla_breach_count"),
    )
    return agg.withColumn("sla_breach_rate", safe_ratio("sla_breach_count", "closed_requests"))


def borough_compare(enriched: DataFrame, category: str | None = None) -> DataFrame:
    """R-6: per category, borough and year volume and breach rate.

    The gold fact has no borough, so this reads the enriched rows.  Pass
    ``category`` to restrict to one category (pushed below the join).
    """
    rows = enriched if category is None else enriched.where(F.col("complaint_type_normalized") == category)
    agg = rows.groupBy(
        F.col("complaint_type_normalized").alias("complaint_type"), "borough", "calendar_year"
    ).agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(F.col("closed_date").isNotNull()).alias("closed_requests"),
        F.count_if(F.col("is_sla_breach")).alias("sla_breach_count"),
    )
    return agg.withColumn("sla_breach_rate", safe_ratio("sla_breach_count", "closed_requests"))
