"""Tolerant parsing and cleaning projections.

Spark 4 runs in ANSI mode: a plain ``cast``/``to_timestamp`` throws on bad
input and aborts the job.  Landing data is untrusted text, so every parse
here is a ``try_*`` form that yields NULL instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: timestamp text format of the landing records.
LANDING_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
# The same format as a full-string regular expression (fast path below).
LANDING_TS_REGEX = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}\z"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c: str | Column, fmt: str = LANDING_TS_FORMAT) -> Column:
    """Text -> TIMESTAMP_NTZ, unparseable text -> NULL.

    ``try_to_timestamp`` decides validity; the value itself comes from
    ``to_timestamp_ntz`` so that the wall-clock value never depends on the
    session time zone.  The guarded branch is only evaluated for rows that
    parsed, so ANSI mode never raises.
    """
    c = _col(c)
    if fmt == LANDING_TS_FORMAT:
        # Fast path, same result: the text must have exactly the landing
        # shape, then Spark's native ISO-8601 cast parses it (it rejects
        # impossible dates and times just like the pattern parser).
        return F.when(c.rlike(LANDING_TS_REGEX), c.try_cast("timestamp_ntz"))
    fmt_lit = F.lit(fmt)
    return F.when(F.try_to_timestamp(c, fmt_lit).isNotNull(), F.to_timestamp_ntz(c, fmt_lit))


def to_double_tolerant(c: str | Column) -> Column:
    """``try_cast(x AS DOUBLE)``."""
    return _col(c).try_cast("double")


def clean_text(c: str | Column) -> Column:
    """Trim surrounding spaces (spaces only, like SQL TRIM)."""
    return F.trim(_col(c))


def clean_upper(c: str | Column) -> Column:
    """P5 over P4: ``UPPER(TRIM(x))``."""
    return F.upper(F.trim(_col(c)))


def day_diff(start: str | Column, end: str | Column) -> Column:
    """Number of calendar-day boundaries between two timestamps.

    The 2-argument ``datediff`` truncates both sides to dates, so 23:00 ->
    01:00 the next day counts as 1.  Result is BIGINT, NULL if either side
    is NULL, negative when ``end`` precedes ``start``.
    """
    return F.datediff(_col(end), _col(start)).cast("bigint")


def ntz_text(c: str | Column) -> Column:
    """TIMESTAMP_NTZ -> landing text ``yyyy-MM-ddTHH:mm:ss.SSS``.

    Built from the value's own fields, so no session time zone is involved
    (``date_format`` would round-trip through local time and could shift a
    wall-clock value that falls in a daylight-saving gap); other values than
    those of years 0 to 9999 go through a format, which takes twice as long.
    """
    c = _col(c)
    text = c.cast("string")  # of years of four digits: yyyy-MM-dd HH:mm:ss, and a fraction without zeros at its end
    parts = F.concat(F.overlay(F.substring(text, 1, 19), F.lit("T"), 11), F.lit("."), F.rpad(F.substring(text, 21, 3), 3, "0"))
    millis = (F.date_part(F.lit("SECOND"), c) * 1000).cast("int") % 1000
    formatted = F.format_string(
        "%04d-%02d-%02dT%02d:%02d:%02d.%03d",
        F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c), F.second(c), millis,
    )
    return F.when(F.year(c).between(0, 9999), parts).otherwise(formatted)


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole-second boundaries from ``start`` to ``end`` (TIMESTAMP_NTZ).

    Calendar days times 86400 plus the difference of the seconds-of-day;
    wall-clock arithmetic with no time zone, BIGINT.
    """
    start, end = _col(start), _col(end)

    def sod(x: Column) -> Column:
        return F.hour(x) * 3600 + F.minute(x) * 60 + F.second(x)

    return (F.datediff(end, start).cast("bigint") * 86400 + (sod(end) - sod(start))).cast("bigint")


def calendar_year(c: str | Column) -> Column:
    """Calendar year as BIGINT."""
    return F.year(_col(c)).cast("bigint")


def type_requests(df: DataFrame, ts_format: str = LANDING_TS_FORMAT) -> DataFrame:
    """The landing -> silver typing pass, one projection.

    Timestamps are parsed tolerantly, text columns trimmed, borough
    upper-cased, coordinates cast to double.  Columns that are absent are
    left alone, every other column passes through unchanged.
    """
    present = set(df.columns)
    changes: dict[str, Column] = {}
    for name in ("created_date", "closed_date"):
        if name in present:
            changes[name] = parse_ts(name, ts_format)
    if "borough" in present:
        changes["borough"] = clean_upper("borough")
    for name in ("agency", "complaint_type", "status"):
        if name in present:
            changes[name] = clean_text(name)
    for name in ("latitude", "longitude"):
        if name in present:
            changes[name] = to_double_tolerant(name)
    return df.withColumns(changes)
