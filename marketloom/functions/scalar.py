"""Column helpers that pin down the arithmetic and text rules used everywhere.

All of them are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# A double carries a relative error near 1e-16, so an exact decimal tie such as
# 2.345 may sit a hair below itself. Pushing values this little away from zero
# before rounding makes ties behave as in decimal arithmetic. The relative part is
# two units in the last place: it stays below half a cent up to 1e13.
TIE_NUDGE = 1e-9
TIE_NUDGE_RELATIVE = 4e-16


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def day(value) -> Column:
    """A date column from a Python date, ISO text or column; None is today."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, dt.date):
        return F.lit(value)
    return F.lit(dt.date.fromisoformat(value))


def ratio(numerator, denominator) -> Column:
    """Quotient as double; NULL when the denominator is zero or missing."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def pct_change(new, old) -> Column:
    """Relative change in percent. The difference is taken before leaving decimals."""
    return ratio(_col(new) - _col(old), old) * F.lit(100.0)


def round_half_away(value, digits: int) -> Column:
    """Round a double half away from zero, tolerant of representation error."""
    value = _col(value).cast("double")
    nudged = value + F.signum(value) * F.lit(TIE_NUDGE) + value * F.lit(TIE_NUDGE_RELATIVE)
    return F.round(nudged, digits)


def year_before(value, years: int = 1) -> Column:
    """Same day some years earlier; 29 February becomes the 28th."""
    return F.add_months(day(value), -12 * years)


def same_text(left, right) -> Column:
    """Equality that ignores case."""
    return F.lower(_col(left)) == F.lower(_col(right))


_LEADING_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?"


def leading_number(text) -> Column:
    """Number at the start of a text, 0 when there is none ('10abc' gives 10)."""
    found = F.trim(F.regexp_extract(_col(text), _LEADING_NUMBER, 0))
    return F.coalesce(found.try_cast("double"), F.lit(0.0))


def missing_to_null(value) -> Column:
    """NaN counts as missing."""
    value = _col(value)
    return F.when(~F.isnan(value), value)


def is_missing(value) -> Column:
    value = _col(value)
    return value.isNull() | F.isnan(value)


def non_zero(value) -> Column:
    """NULL for zero, NaN or missing: a zero measure means 'not reported'."""
    return F.nullif(missing_to_null(value), F.lit(0.0))
