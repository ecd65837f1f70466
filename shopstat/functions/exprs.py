"""Column expressions used by the reports and jobs (all built-in, codegen-friendly).

Every function returns a ``Column``; none of them touches the session or the
data, so they compose freely inside ``select`` / ``agg``.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# P1 — revenue = price x quantity (null when either side is null)
def revenue(price: ColumnOrName = "price", quantity: ColumnOrName = "quantity") -> Column:
    return _c(price) * _c(quantity)


# P2 — month bucket. Grouping is done on the first day of the month (a date, cheap to
# hash); the "yyyy-MM" text is produced only on the aggregated rows. Casting a
# timestamp_ntz to date and truncating does not depend on the session time zone.
def month_start(ts: ColumnOrName = "order_date") -> Column:
    return F.trunc(_c(ts).cast("date"), "month")


def month_label(month_first_day: ColumnOrName) -> Column:
    return F.date_format(_c(month_first_day), "yyyy-MM")


# F1/F2 — growth percentage (cur - prev) / prev * 100; null when prev is null or 0
def growth_pct(current: ColumnOrName, previous: ColumnOrName) -> Column:
    return F.try_divide(_c(current) - _c(previous), _c(previous)) * F.lit(100.0)


# F3 — percentage change against a baseline, (base - x) / base * 100; 0.0 when base is 0,
# null when either is null (not measured)
def change_vs_baseline(base: ColumnOrName, value: ColumnOrName, guard_zero: bool = True) -> Column:
    pct = (_c(base) - _c(value)) / _c(base) * F.lit(100.0)
    if not guard_zero:
        return F.try_divide(_c(base) - _c(value), _c(base)) * F.lit(100.0)
    return F.when(_c(base) != 0, pct).when((_c(base) == 0) & _c(value).isNotNull(), F.lit(0.0))


# F4 — rounding; Spark rounds half away from zero, ``half_even=True`` gives banker's rounding
def round_to(x: ColumnOrName, digits: int, half_even: bool = False) -> Column:
    return F.bround(_c(x), digits) if half_even else F.round(_c(x), digits)


# F5 — clip into [lo, hi]; either bound may be None
def clip(x: ColumnOrName, lo=None, hi=None) -> Column:
    out = _c(x)
    if hi is not None:
        out = F.least(out, F.lit(hi))
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    return out


# F6/F7 — floor and fractional part
def floor_of(x: ColumnOrName) -> Column:
    return F.floor(_c(x))


def fractional(x: ColumnOrName) -> Column:
    return _c(x) - F.floor(_c(x))


# F8 — whole days between two dates/timestamps (end - start)
def days_between(end: ColumnOrName, start: ColumnOrName) -> Column:
    return F.datediff(_c(end).cast("date"), _c(start).cast("date"))


# F9 — timestamp + whole days + seconds (interval arithmetic keeps timestamp_ntz)
def add_days_seconds(ts: ColumnOrName, days: ColumnOrName, seconds: ColumnOrName) -> Column:
    return _c(ts) + F.make_dt_interval(_c(days).cast("int"), F.lit(0), F.lit(0),
                                       _c(seconds).cast("decimal(18,6)"))


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


# F10 — epoch seconds -> timestamp_ntz (wall clock in UTC, independent of the session zone)
def epoch_seconds_to_ntz(seconds: ColumnOrName) -> Column:
    s = _c(seconds).cast("long")
    return add_days_seconds(_epoch_ntz(), F.floor(s / 86400), s - F.floor(s / 86400) * 86400)


# S9 helper — epoch microseconds -> timestamp_ntz, also zone independent
def epoch_micros_to_ntz(micros: ColumnOrName) -> Column:
    m = _c(micros).cast("long")
    day_us = 86_400_000_000
    days = F.floor(m / day_us)
    rest = (m - days * day_us).cast("decimal(20,0)") / F.lit(1_000_000)
    return _epoch_ntz() + F.make_dt_interval(days.cast("int"), F.lit(0), F.lit(0), rest.cast("decimal(18,6)"))


# F11 — date -> timestamp_ntz (midnight)
def to_ntz(d: ColumnOrName) -> Column:
    return _c(d).cast("date").cast("timestamp_ntz")


# F12 — capitalise the first letter only (Python's str.capitalize; initcap differs)
def capitalize_first(s: ColumnOrName) -> Column:
    x = _c(s)
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30)))


# F13 — drop the last character
def drop_last_char(s: ColumnOrName) -> Column:
    x = _c(s)
    return F.substring(x, F.lit(1), F.length(x) - 1)


# F14 — string interpolation with a separator
def join_words(*parts: ColumnOrName, sep: str = " ") -> Column:
    return F.concat_ws(sep, *[_c(p) for p in parts])


# F15 — fixed-decimal text, e.g. fixed_text(x, 3, " s") -> "1.234 s"; null stays null
# (format_string would print a null as the truncated word "null")
def fixed_text(x: ColumnOrName, decimals: int, suffix: str = "") -> Column:
    return F.when(_c(x).isNotNull(), F.format_string(f"%.{decimals}f{suffix}", _c(x)))


# F16 — human-readable size with 1024 steps: B, KB, MB, GB, then TB. The value is
# rounded before formatting, so an exact binary tie (e.g. 1.125) is rounded once,
# half away from zero, rather than left to the formatter's rounding rule.
def human_size(num_bytes: ColumnOrName) -> Column:
    b = _c(num_bytes).cast("double")

    def text(unit: str, power: int) -> Column:
        return F.format_string(f"%.2f {unit}", F.round(b / F.lit(1024.0 ** power), 2))

    return (
        F.when(b < F.lit(1024.0), text("B", 0))
        .when(b < F.lit(1024.0 ** 2), text("KB", 1))
        .when(b < F.lit(1024.0 ** 3), text("MB", 2))
        .when(b < F.lit(1024.0 ** 4), text("GB", 3))
        .otherwise(text("TB", 4))
    )


# F17 — energy estimate in Wh from CPU seconds at a fixed power draw
CPU_TDP_WATTS = 65.0  # fixed value


def energy_wh(cpu_seconds: ColumnOrName, watts: float = CPU_TDP_WATTS) -> Column:
    return _c(cpu_seconds) * F.lit(watts) / F.lit(3600.0)


# F18 — bytes -> MB
def bytes_to_mb(num_bytes: ColumnOrName) -> Column:
    return _c(num_bytes).cast("double") / F.lit(1024.0 ** 2)


# F19 — integer narrowing (ANSI cast: raises on overflow instead of wrapping)
def narrow(x: ColumnOrName, to: str = "smallint") -> Column:
    return _c(x).cast(to)


# A7 — larger of two measurements
def larger_of(a: ColumnOrName, b: ColumnOrName) -> Column:
    return F.greatest(_c(a), _c(b))
