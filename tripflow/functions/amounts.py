"""Numeric helpers: sums and averages that do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sums run on decimals of ten places; amounts below LARGE fit in them, some 10^10 times over.
EXACT = "decimal(38,10)"
LARGE = 1e18


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(value: Column | str) -> Column:
    """Sum of a double column that does not depend on row order or partitioning.

    Values below 10^18 are added as decimals of ten places, so what lies below 5e-11 is lost. Greater ones, which no trip
    costs, are added beside them as doubles: one such value is exact, several are as exact as doubles are. So are
    NaN and infinities, which make the sum theirs. NULL only if all inputs are NULL.
    """
    x = _col(value)
    usual = F.abs(x) < F.lit(LARGE)  # NaN is greater than any number
    total = F.sum(F.when(usual, x).cast(EXACT)).cast("double")
    odd = F.sum(F.when(~usual, x))
    return F.coalesce(total + F.coalesce(odd, F.lit(0.0)), odd)


def exact_avg(value: Column | str) -> Column:
    """Average over the non-NULL values, from the exact sum."""
    x = _col(value)
    return exact_sum(x) / F.nullif(F.count(x), F.lit(0))


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """part / whole * 100, guarded against an empty whole."""
    ratio = part.cast("double") / F.greatest(whole, F.lit(1)).cast("double") * 100.0
    return F.round(ratio, digits)
