"""Exact money arithmetic on columns that are stored as double.

Amounts with two decimals are summed as integer cents: the result does not
depend on the order of the rows, stays within code-generated hash aggregation,
and costs a fraction of wide decimals. A sum beyond the range of a bigint raises
an error under ANSI mode, it does not wrap around.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def cents(amount: Column | str) -> Column:
    """A two-decimal amount as an integer number of cents."""
    return F.floor(_column(amount).cast("double") * 100 + 0.5)


def basis_points(fraction: Column | str) -> Column:
    """A fraction such as a discount as an integer number of ten-thousandths."""
    return F.floor(_column(fraction).cast("double") * 10_000 + 0.5)


def share_of(amount_cents: Column, points: Column) -> Column:
    """``amount_cents * points / 10000``, rounded half away from zero to whole cents."""
    product = amount_cents * points
    return F.call_function("div", F.when(product < 0, product - 5_000).otherwise(product + 5_000), F.lit(10_000))


def sum_cents(amount: Column | str) -> Column:
    """Sum of two-decimal amounts, in cents."""
    return F.sum(cents(amount))


def amount(cent_count: Column | str) -> Column:
    """Cents as a double amount."""
    return _column(cent_count) / 100.0


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient; NULL when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def _millionths(value: Column) -> Column:
    return (value.cast("decimal(28,6)") * 1_000_000).cast("decimal(38,0)")


def rounded_ratio(numerator: Column, denominator: Column, digits: int = 2, scale: int = 1) -> Column:
    """``scale * numerator / denominator`` rounded half away from zero, as double.

    The rounding is exact: it is one integer division. (Dividing decimals first
    would round twice, as Spark keeps only six digits of a wide quotient.)
    NULL when the denominator is zero. Operands may have six decimals.
    """
    n, d = _millionths(numerator), _millionths(denominator)
    doubled = F.abs(n) * (2 * scale * 10 ** digits) + F.abs(d)
    whole = F.call_function("div", doubled.cast("decimal(38,0)"), F.nullif(F.abs(d) * 2, F.lit(0)))
    return F.when((n < 0) == (d < 0), whole).otherwise(-whole) / float(10 ** digits)


def mean_cents(cent_sum: Column, n: Column) -> Column:
    """The mean amount of ``n`` rows that sum up to ``cent_sum``, rounded half up to cents, as double."""
    return rounded_ratio(cent_sum, n * 100)
