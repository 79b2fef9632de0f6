"""Exact number and percentage expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_div(a: Column, b: Column) -> Column:
    """Whole-number division, truncating."""
    return F.call_function("div", a, b)


def half_up_mean(total: Column, n: Column, held: int, kept: int) -> Column:
    """``total / n`` rounded half away from zero to ``kept`` decimals, as double.

    ``total`` is a whole number of units of 10**-``held``.
    """
    scaled = F.abs(total) * (2 * 10**kept)
    unit = n * 10**held
    rounded = whole_div(scaled + unit, unit * 2) * F.signum(total).cast("bigint")
    return rounded / F.lit(float(10**kept))


# A double between 2**-5 and 128 is a whole number of 2**-57 beyond its floor.
_FRACTION_BITS = 57
_ONE = 1 << _FRACTION_BITS


def percent_text(part: Column, total: Column) -> Column:
    """``part`` / ``total`` as text like ``16.2%``, the digits that
    ``format(part * 100 / total, ".1f")`` gives in Python.

    That rounds the exact value of the double, with halves to the even digit.
    Spark's own rounding goes by the shortest decimal text of the double and
    would print some halves differently, so the fraction is rounded here as a
    whole number of 2**-57.
    """
    percent = part * 100 / total
    whole = F.floor(percent)
    tenfold = ((percent - whole) * float(_ONE)).cast("bigint") * 10
    digit = F.shiftright(tenfold, _FRACTION_BITS)
    rest = tenfold.bitwiseAND(_ONE - 1)
    odd = digit.bitwiseAND(1)
    up = (rest + odd > _ONE // 2).cast("bigint")
    tenths = (whole * 10 + digit + up).cast("decimal(5,0)")
    return F.concat((tenths * F.lit("0.1").cast("decimal(1,1)")).cast("string"), F.lit("%"))
