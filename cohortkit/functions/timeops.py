"""Time functions (SC1-SC6, PRM2-PRM4).

Stored times are TIMESTAMP_NTZ holding UTC.  Bounds given in local time are
shifted to UTC *as literals* (so the comparison stays on the bare column and
reaches the Parquet scan as a pushed filter); stored columns are shifted to
local time only on output.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_TZ = "America/Chicago"
MICROS_PER_DAY = 86_400_000_000


def _as_col(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal from a ``datetime``/``date``/ISO text."""
    if isinstance(value, dt.datetime):
        return F.lit(value).cast("timestamp_ntz")
    if isinstance(value, dt.date):
        return F.lit(dt.datetime(value.year, value.month, value.day)).cast("timestamp_ntz")
    return F.to_timestamp_ntz(F.lit(str(value)))


#: window of an extraction whose prompt is left empty (PRM2)
DEFAULT_BEGIN, DEFAULT_END = dt.datetime(1996, 1, 1), dt.datetime(1999, 7, 1)


def parse_prompt(text: str, mask: str) -> Column:
    """Prompt text -> timestamp by a configured mask (SC4); bad text -> NULL."""
    return F.try_to_timestamp(F.lit(text), F.lit(mask)).cast("timestamp_ntz")


def prompt_bound(text: str | None, mask: str, default: dt.datetime) -> Column:
    """One bound of a window from prompt text (PRM2): empty text takes the
    default; text that does not fit the mask raises when the query runs,
    instead of a NULL bound that would empty the cohort silently."""
    if text is None or not text.strip():
        return ntz_literal(default)
    bad = F.raise_error(F.lit(f"prompt {text!r} does not fit the mask {mask!r}")).cast("timestamp_ntz")
    return F.coalesce(parse_prompt(text, mask), bad)


def prompt_window(begin: str | None, end: str | None, mask: str) -> tuple[Column, Column]:
    return prompt_bound(begin, mask, DEFAULT_BEGIN), prompt_bound(end, mask, DEFAULT_END)


def local_to_utc(value, tz: str | None) -> Column:
    """Local wall time -> UTC wall time (SC1).  ``tz=None`` leaves it as is.

    A wall time inside a DST gap moves forward; an ambiguous one takes the
    earlier offset.
    """
    c = value if isinstance(value, Column) else ntz_literal(value)
    if tz is None:
        return c
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), c)


def utc_to_local(col, tz: str | None) -> Column:
    """UTC -> local wall time, for output columns only (SC2)."""
    c = _as_col(col)
    if tz is None:
        return c
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), c)


def local_day(col, tz: str | None) -> Column:
    """Calendar day in local time (SC2 + SC3)."""
    return utc_to_local(col, tz).cast("date")


def day_diff(later, earlier) -> Column:
    """``later - earlier`` in fractional days (SC5); NTZ, so no DST effects."""
    a, b = _as_col(later), _as_col(earlier)
    return (F.unix_micros(a.cast("timestamp")) - F.unix_micros(b.cast("timestamp"))) / F.lit(float(MICROS_PER_DAY))


def plus_days(col, days: float) -> Column:
    """``ts + days`` with fractional days (``- 0.5`` = 12 hours)."""
    micros = int(round(days * MICROS_PER_DAY))
    return _as_col(col) + F.make_dt_interval(secs=F.lit(micros / 1e6))


def age_years(at, birth, tz: str | None = None) -> Column:
    """Whole years, truncated toward zero (SC6): ``trunc((local(at) - birth) / 365.25)``."""
    return (day_diff(utc_to_local(at, tz), birth) / F.lit(365.25)).cast("int")
