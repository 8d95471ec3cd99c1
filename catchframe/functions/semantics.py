"""Missing-value, division and rounding rules as native column expressions.

A missing value is always SQL ``NULL``; ``NaN`` counts as missing as well and is
turned into ``NULL`` where data enter (``clean_nan``, ``to_double``).
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from catchframe.functions.normal import normal_quantile

# Text that counts as a number; anything else becomes NULL.  A bare cast would
# also accept suffixed literals such as '12F'.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_nan(c: Column | str) -> Column:
    """``NaN`` -> ``NULL``."""
    c = as_col(c)
    return F.when(~F.isnan(c), c)


def na_sum(c: Column | str) -> Column:
    """Sum without the missing values; a group of only missing values gives 0."""
    return F.coalesce(F.sum(as_col(c)), F.lit(0.0))


def two_measure_sum(a: Column | str, b: Column | str) -> Column:
    """Sum of two measures, missing values ignored in both."""
    return na_sum(a) + na_sum(b)


def poison_sum(c: Column | str) -> Column:
    """Sum in which one missing value makes the whole group missing."""
    c = as_col(c)
    return F.when(F.bool_and(c.isNotNull()), F.sum(c))


def poison_avg(c: Column | str) -> Column:
    """Mean in which one missing value makes the whole group missing."""
    c = as_col(c)
    return F.when(F.bool_and(c.isNotNull()), F.avg(c))


def poison_over(c: Column | str, window: WindowSpec) -> Column:
    """``poison_sum`` over a window; with a running frame it is a running sum."""
    c = as_col(c)
    return F.when(F.bool_and(c.isNotNull()).over(window), F.sum(c).over(window))


def ratio(n: Column | str, d: Column | str) -> Column:
    """``n / d`` with 0/0 missing and x/0 infinite with the sign of x."""
    n, d = as_col(n), as_col(d)
    by_zero = F.when(n > 0, F.lit(float("inf"))).when(n < 0, F.lit(float("-inf")))
    return F.when(d == 0, by_zero).otherwise(F.try_divide(n, d))


def if_else(cond: Column, yes, no) -> Column:
    """Two-way choice that is missing where the condition is missing."""
    return F.when(cond.isNull(), F.lit(None)).when(cond, yes).otherwise(no)


def not_in(c: Column | str, values: Sequence) -> Column:
    """Negated membership that keeps rows with a missing value."""
    return ~F.coalesce(as_col(c).isin(list(values)), F.lit(False))


def to_double(c: Column | str) -> Column:
    """Text -> double; text that is not a number becomes missing."""
    t = as_col(c).cast("string")
    # A number begins with a digit, a sign, a point or a blank: most words are told apart without the pattern.
    return F.when((F.ascii(t) <= ord("9")) & t.rlike(NUMBER_PATTERN), t.try_cast("double"))


def to_int(c: Column | str) -> Column:
    """Text -> int through ``to_double``; fractions are cut."""
    return to_double(c).try_cast("int")


def half_even(c: Column | str, digits: int = 0) -> Column:
    """Round half to even."""
    return F.bround(as_col(c), digits)


def sig_round(c: Column | str) -> Column:
    """Significant digits for advice: three if the first digit is 1, else two."""
    x = as_col(c)
    # Half of x is one decade lower exactly when the first digit of x is 1.
    e = F.floor(F.log10(F.abs(x) / 2)).try_cast("int") - 1
    power = F.pow(F.lit(10.0), F.abs(e).cast("double"))
    rounded = F.when(e < 0, F.bround(x * power, 0) / power).otherwise(F.bround(x / power, 0) * power)
    return F.when((x == 0) | F.abs(x).isin(float("inf"), float("nan")), x + 0.0).otherwise(rounded)


def z_value(fractile: float | Column) -> float | Column:
    """Standard normal quantile: a constant of the query, or of a column with a fractile per row."""
    return normal_quantile(fractile) if isinstance(fractile, Column) else NormalDist().inv_cdf(fractile)
