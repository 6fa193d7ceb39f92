"""Rank conventions over ``below`` (baseline values strictly under the target) and ``n``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from furrow.functions.scalar import _col


def _ranked(below, n) -> Column:
    """``greatest`` and ``least`` skip NULLs, so an unranked target is ruled out first."""
    return (_col(n) > 0) & _col(below).isNotNull()


def percentile_rank(below, n) -> Column:
    """Share of the baseline strictly below, 0-100; NULL without a baseline."""
    return F.when(_col(n) > 0, _col(below) / _col(n) * 100.0)


def decile_rank(below, n) -> Column:
    """Integer decile 1-10 of rank ``below + 1``; ties do not lift it."""
    raw = F.ceil((_col(below) + 1) / _col(n) * 10)
    return F.when(_ranked(below, n), F.greatest(F.lit(1), F.least(F.lit(10), raw)).cast("int"))


def decile_score(below, n) -> Column:
    """Continuous companion of the decile, one decimal, half to even."""
    raw = (_col(below) + 1) / _col(n) * 10.0
    return F.when(_ranked(below, n), F.bround(F.greatest(F.lit(1.0), F.least(F.lit(10.0), raw)), 1))


def cell_percentile(below, n) -> Column:
    """Rank-fraction percentile ``(below + 1) / n``, at most 100."""
    return F.when(_ranked(below, n), F.least(F.lit(100.0), (_col(below) + 1.0) * 100.0 / _col(n)))


# --- expressions over one sorted array of baseline values --------------------------------

def sorted_quantile(arr, p: float) -> Column:
    """Linear-interpolated quantile of an ascending array; NULL when it is empty."""
    arr = _col(arr)
    pos = (F.size(arr) - 1) * F.lit(float(p))
    lo = F.floor(pos).cast("int")
    low = F.get(arr, lo)
    high = F.get(arr, F.ceil(pos).cast("int"))
    return F.when(F.size(arr) > 0, low + (high - low) * (pos - lo))


def count_below(arr, target) -> Column:
    t = _col(target)
    return F.when(t.isNotNull(), F.size(F.filter(_col(arr), lambda v: v < t)))


def array_mean(arr) -> Column:
    arr = _col(arr)
    total = F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)
    return F.when(F.size(arr) > 0, total / F.size(arr))


def median_without(arr, position) -> Column:
    """Median of an ascending array with the element at 1-based ``position`` left out."""
    arr, pos = _col(arr), _col(position)
    m = F.size(arr) - 1
    lo = F.floor((m - 1) / 2).cast("int") + 1
    hi = F.floor(m / 2).cast("int") + 1

    def at(i):
        return F.get(arr, i + F.when(i >= pos, 1).otherwise(0) - 1)

    return F.when(m > 0, (at(lo) + at(hi)) / 2.0)
