"""Exact rounding helpers.

Ratios in the marts are rounded half away from zero. Dividing in floating
point and rounding afterwards gives answers that depend on the engine's
rounding of the intermediate double, so these helpers divide integers
exactly (decimal remainder arithmetic) and only turn the final value into a
double. ``q / 10**scale`` is the correctly rounded double of the decimal
result in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT = "decimal(38,0)"

# Money keeps nine decimals from staging to the marts, as the modelled NUMERIC type does.
MONEY_SCALE = 9
MONEY = f"decimal(27,{MONEY_SCALE})"
SCORE_SCALE = 9


def _as_scaled_int(c: Column, input_scale: int) -> Column:
    return (c * F.lit(10**input_scale)).cast(_INT)


def round_div(num: Column, den: Column, scale: int = 1, factor: int = 1, input_scale: int = 0) -> Column:
    """``round(factor * num / den, scale)`` with exact HALF_UP rounding, as double.

    ``num`` and ``den`` must be exact numbers with at most ``input_scale``
    decimals (integers or money). NULL when ``den`` is 0 or NULL.
    """
    n = _as_scaled_int(num, input_scale)
    d = _as_scaled_int(den, input_scale)
    x = F.abs(n) * F.lit(2 * factor * 10**scale) + F.abs(d)
    y = F.abs(d) * F.lit(2)
    q = ((x - (x % y)) / y).cast("bigint")
    sign = F.when((n < 0) != (d < 0), F.lit(-1)).otherwise(F.lit(1))
    return F.when(d != 0, (q * sign).cast("double") / F.lit(float(10**scale)))


def exact_score(c: Column) -> Column:
    """A satisfaction score as an exact decimal, all digits kept."""
    return c.cast(f"decimal(20,{SCORE_SCALE})")


def mean_score(total: Column, n: Column, scale: int) -> Column:
    """Rounded mean of ``n`` scores whose exact sum is ``total``; NULL without any."""
    return round_div(total, n, scale=scale, input_scale=SCORE_SCALE)


def to_tenths(c: Column) -> Column:
    """A one-decimal double (an hours value) as an integer count of tenths."""
    return F.round(c * F.lit(10.0)).cast("bigint")
