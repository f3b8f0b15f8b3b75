"""Column expressions that keep warehouse semantics on Spark.

Every helper returns a built-in Catalyst expression, so it stays inside
whole-stage codegen. Nothing here depends on the session time zone:
timestamps are TIMESTAMP_NTZ holding UTC wall-clock time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of an NTZ wall-clock time read as UTC.

    Exact calendar arithmetic on the date part and the time-of-day fields.
    ``timestamp_diff`` and casts to TIMESTAMP are avoided: they pass through
    the session zone, which moves wall-clock times inside a DST gap.
    """
    c = col(ts)
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")
    secs = F.date_part(F.lit("SECOND"), c)  # seconds with microsecond fraction
    return (days * 86_400_000_000 + F.hour(c).cast("bigint") * 3_600_000_000
            + F.minute(c).cast("bigint") * 60_000_000 + (secs * 1_000_000).cast("bigint"))


def floor_div(x, d: int) -> Column:
    """Integer floor division (exact for negative values too)."""
    x = col(x)
    return ((x - F.pmod(x, F.lit(d))) / d).cast("bigint")


def epoch_seconds(ts) -> Column:
    """UNIX_SECONDS of an NTZ timestamp: whole seconds since 1970, floored."""
    return floor_div(epoch_micros(ts), 1_000_000)


def epoch_millis(ts) -> Column:
    """UNIX_MILLIS of an NTZ timestamp: whole milliseconds since 1970, floored."""
    return floor_div(epoch_micros(ts), 1_000)


def seconds_to_ts(secs) -> Column:
    """TIMESTAMP_SECONDS as an NTZ value."""
    return F.timestamp_add("SECOND", col(secs).cast("bigint"), epoch_ntz())


def millis_to_ts(ms) -> Column:
    """TIMESTAMP_MILLIS as an NTZ value."""
    return F.timestamp_add("MILLISECOND", col(ms).cast("bigint"), epoch_ntz())


def add_seconds(ts, n) -> Column:
    return F.timestamp_add("SECOND", col(n).cast("bigint"), col(ts))


def add_days_exact(ts, days: int) -> Column:
    """TIMESTAMP_ADD(ts, INTERVAL n DAY): n * 24 h on an absolute instant."""
    return F.timestamp_add("SECOND", F.lit(days * 86400), col(ts))


def round_to_bigint(x) -> Column:
    """CAST(float AS INT64) in the warehouse rounds half away from zero."""
    return F.round(col(x).cast("double"), 0).cast("bigint")


def safe_divide(num, den) -> Column:
    """SAFE_DIVIDE: NULL when the divisor is zero or NULL."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def safe_pct(num, den) -> Column:
    """100 * num / NULLIF(den, 0) as FLOAT64."""
    return safe_divide(num, F.nullif(col(den), F.lit(0))) * F.lit(100.0)


def _nearest(num: Column, den: Column) -> Column:
    """num / den to the nearest whole number (halves up) in whole-number arithmetic, NULL on a zero divisor."""
    n, d = num.cast("decimal(38,0)") * 2 + den.cast("decimal(38,0)"), den.cast("decimal(38,0)") * 2
    whole = F.floor(F.try_divide(n - F.pmod(n, F.nullif(d, F.lit(0))), d))
    return F.when(den > 0, whole)


def ratio0(num: Column, den: Column, kind: str) -> Column:
    """num hundredths / den as a two-place decimal, halves up; NULL when den is not positive or the type too narrow."""
    return (_nearest(num, den).cast("decimal(36,2)") / 100).cast("decimal(36,2)").try_cast(kind)


def ratio2(num: Column, den: Column, kind: str) -> Column:
    """num / den as a two-place decimal, halves up, without a double in between."""
    return ratio0(num * 100, den, kind)


def pct2(num: Column, den: Column) -> Column:
    """100 * num / den as DECIMAL(5,2)."""
    return ratio0(num * 10000, den, "decimal(5,2)")


def extract_or_null(s, pattern: str, group: int = 1) -> Column:
    """REGEXP_EXTRACT returns NULL on no match; Spark returns ''."""
    return F.nullif(F.regexp_extract(col(s), pattern, group), F.lit(""))


def contains_ci(s, pattern: str) -> Column:
    """Case-insensitive REGEXP_CONTAINS with Unicode folding as in RE2."""
    return F.regexp_like(col(s), F.lit("(?iu)" + pattern))


def format_ntz(ts, with_time: bool = True) -> Column:
    """'YYYYMMDDHH24MISS' (or 'YYYYMMDD') text of an NTZ time from its fields;
    ``date_format`` would go through the session zone."""
    c = col(ts)
    parts = [F.lpad(F.year(c).cast("string"), 4, "0"), F.lpad(F.month(c).cast("string"), 2, "0"),
             F.lpad(F.dayofmonth(c).cast("string"), 2, "0")]
    if with_time:
        parts += [F.lpad(F.hour(c).cast("string"), 2, "0"), F.lpad(F.minute(c).cast("string"), 2, "0"),
                  F.lpad(F.second(c).cast("string"), 2, "0")]
    return F.concat(*parts)


def date_key(ts) -> Column:
    """Integer YYYYMMDD key of a timestamp or date."""
    c = col(ts)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("bigint")


def parse_date_key(k) -> Column:
    """PARSE_DATE('%Y%m%d', CAST(k AS STRING))."""
    return F.to_date(col(k).cast("string"), "yyyyMMdd")


def month_start(ts) -> Column:
    """First day of the month as DATE (zone-free for NTZ input)."""
    return F.trunc(F.to_date(col(ts)), "month")


def bar_concat(*cols) -> Column:
    """CONCAT that returns NULL when any argument is NULL."""
    return F.concat(*[col(c) for c in cols])


def as_double_rounded(x, digits: int = 4) -> Column:
    return F.round(col(x).cast("double"), digits)


def ntz_to_instant(ts) -> Column:
    """NTZ wall-clock time read as UTC -> TIMESTAMP (instant), zone-free."""
    return F.timestamp_micros(epoch_micros(ts))


def instant_to_ntz(ts) -> Column:
    """TIMESTAMP (instant) -> NTZ wall-clock time in UTC, zone-free."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(col(ts)), epoch_ntz())
