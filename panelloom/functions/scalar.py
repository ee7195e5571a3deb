"""Scalar column functions. Missing is NULL throughout: NaN and infinities become NULL at the door."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fin(x: Column | str) -> Column:
    """The value where it is finite, else NULL."""
    x = _c(x)
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def safe_div(num: Column | str, den: Column | str, floor: float = 0.0) -> Column:
    """num / den where |den| is over ``floor``; NULL elsewhere and where the quotient is not finite."""
    num, den = _c(num), _c(den)
    return fin(F.when(F.abs(den) > floor, F.try_divide(num, den)))


def positive_div(num: Column | str, den: Column | str, floor: float = 0.0) -> Column:
    """num / den where den itself is over ``floor``."""
    return F.when(_c(den) > floor, F.try_divide(_c(num), _c(den)))


def safe_log(x: Column | str) -> Column:
    return F.when(_c(x) > 0, F.log(_c(x)))


def safe_sqrt(x: Column | str) -> Column:
    return F.when(_c(x) >= 0, F.sqrt(_c(x)))


def signed_power(x: Column | str, p: float) -> Column:
    return F.signum(_c(x)) * F.pow(F.abs(_c(x)), F.lit(p))


def _tolerance(b: Column) -> Column:
    return F.lit(1e-12) + F.lit(1e-12) * F.abs(b)


def gt(a: Column, b: Column) -> Column:
    return a > b + _tolerance(b)


def ge(a: Column, b: Column) -> Column:
    return a >= b - _tolerance(b)


def lt(a: Column, b: Column) -> Column:
    return a < b - _tolerance(b)


def le(a: Column, b: Column) -> Column:
    return a <= b + _tolerance(b)


def clamp(x: Column | str, low: float | Column, high: float | Column) -> Column:
    """x between low and high; NULL stays NULL (least and greatest alone would skip it)."""
    x = _c(x)
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low) if not isinstance(low, Column) else low), F.lit(high) if not isinstance(high, Column) else high))


def winsor_guarded(x: Column, low: Column, high: Column) -> Column:
    """Clamp, unless the bounds leave no room."""
    return F.when(low < high, clamp(x, low, high)).otherwise(x)


def any_prefix(code: Column | str, prefixes: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (_c(code).startswith(p) for p in prefixes), F.lit(False))


def quarter_end(day: Column | str) -> Column:
    return F.date_format(_c(day), "MMdd").isin("0331", "0630", "0930", "1231")


def positive_only(x: Column | str) -> Column:
    return F.when(_c(x) > 0, _c(x))


def valid_bar(open_: Column, high: Column, low: Column, close: Column) -> Column:
    """All prices over 0, the high not below open and close, the low not above them."""
    return F.coalesce((F.least(open_, high, low, close) > 0) & (high >= F.greatest(open_, close)) & (low <= F.least(open_, close)), F.lit(False))


def price_limit(previous: Column | str, rate: float = 0.1, up: bool = True) -> Column:
    """Limit price to the cent: floor, not half-up rounding of the decimal text."""
    return F.floor(_c(previous) * (1 + rate if up else 1 - rate) * 100 + 0.5) / 100


def fraction(text: Column | str) -> Column:
    """The value of an ``a/b`` text, NULL where there is none or b is 0."""
    number = r"(-?\d+(?:\.\d+)?)\s*/\s*(-?\d+(?:\.\d+)?)"
    part = lambda i: F.regexp_extract(_c(text), number, i).try_cast("double")
    return safe_div(part(1), part(2))


def clock(text: Column | str) -> Column:
    """HHMM as an integer from ``H:MM`` or ``HMM`` texts."""
    digits = F.lpad(F.regexp_replace(_c(text), r"\D", ""), 4, "0")
    return F.when(F.regexp_replace(_c(text), r"\D", "") != "", F.substring(digits, 1, 4).try_cast("int"))


def parse_day(text: Column | str) -> Column:
    """Date from the first ten characters; NULL where they are no date."""
    return F.try_to_date(F.substring(_c(text), 1, 10), "yyyy-MM-dd")


def quarter_ordinal(day: Column | str) -> Column:
    """Quarters since the start of 1990."""
    return (F.year(_c(day)) - 1990) * 4 + F.quarter(_c(day)) - 1


def normal_quantile(p: Column | str) -> Column:
    """Inverse of the standard normal distribution by the rational form 26.2.23 of Abramowitz and Stegun.

    Its error is below 4.5e-4; NULL outside (0, 1).
    """
    p = _c(p)
    tail = F.least(p, 1 - p)
    t = F.sqrt(-2 * F.log(tail))
    start = t - (2.515517 + t * (0.802853 + t * 0.010328)) / (1 + t * (1.432788 + t * (0.189269 + t * 0.001308)))
    x = F.when(p < 0.5, -start).otherwise(start)
    return F.when((p > 0) & (p < 1), x)


def gaussian_rank(rank: Column, n: Column) -> Column:
    return normal_quantile((rank - 0.5) / n)


def trade_fee(amount: Column | str, selling: Column) -> Column:
    """Commission with a floor, transfer fee, and stamp duty on sales."""
    return F.greatest(_c(amount) * 0.00025, F.lit(5.0)) + _c(amount) * 1e-5 + F.when(selling, _c(amount) * 5e-4).otherwise(0.0)


def any_suffix(code: Column | str, suffixes: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (_c(code).endswith(s) for s in suffixes), F.lit(False))


def plain_name(text: Column | str) -> Column:
    """A name for comparison: upper case, without white space, full-width letters and digits as plain ones."""
    wide = "".join(chr(0xFF01 + i) for i in range(94))
    plain = "".join(chr(0x21 + i) for i in range(94))
    return F.upper(F.regexp_replace(F.translate(_c(text), wide, plain), r"\s+", ""))


def squash(x: Column | str, scale: float = 1.0) -> Column:
    """Hyperbolic tangent of x in units of ``scale``."""
    return F.tanh(_c(x) / scale)


def soft_log(x: Column | str) -> Column:
    """Inverse hyperbolic sine: a logarithm for both signs, and 0 for 0."""
    return F.signum(_c(x)) * F.log(F.abs(_c(x)) + F.sqrt(_c(x) * _c(x) + 1))
