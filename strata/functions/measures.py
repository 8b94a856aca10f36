"""Named measures: aggregate Column builders evaluated in a filter context.

Semantics follow the measure definitions of the report layer:

* division by zero gives NULL (``try_divide``), not an error or infinity;
* ``round`` is half-away-from-zero (``F.round``), applied only when
  ``digits`` is given -- callers comparing against another engine keep the
  raw ratio, because engines disagree on ties after a float sum;
* averages skip NULLs, row counts do not.

Each builder returns an aggregate ``Column`` to be used inside ``agg``.
Measures that combine two facts (avg clicks per student / per
registration) are composed from these in ``plans.star`` by aggregating
each fact separately and joining on the slice keys (drill-across).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column, den: Column, digits: int | None = None) -> Column:
    r = F.try_divide(num.cast("double"), den.cast("double"))
    return F.round(r, digits) if digits is not None else r


def distinct_count(c, approx: bool = False, rsd: float = 0.01) -> Column:
    """M1 total students: exact distinct count of a dimension key.

    ``approx=True`` uses a HyperLogLog++ sketch (``rsd`` relative error):
    fixed memory per group and no (key, value) shuffle.
    """
    return F.approx_count_distinct(_col(c), rsd) if approx else F.count_distinct(_col(c))


def average(c) -> Column:
    """M2 average (NULLs skipped)."""
    return F.avg(_col(c))


def row_count() -> Column:
    """M3 / M7: COUNTROWS of the fact in context."""
    return F.count(F.lit(1))


def total(c, kind: str = "bigint") -> Column:
    """M4 / M12: plain sum."""
    return F.sum(_col(c)).cast(kind)


def pass_rate(score, threshold: float = 40, digits: int | None = 2) -> Column:
    """M5: rows with score >= threshold over all rows (ungraded rows count)."""
    return ratio(F.count_if(_col(score) >= F.lit(threshold)), row_count(), digits)


def weighted_score(score, weight, digits: int | None = 2) -> Column:
    """M6: sum(score*weight) / sum(weight).

    A NULL score drops out of the numerator but its weight stays in the
    denominator, as the row-wise SUMX definition does.
    """
    return ratio(F.sum(_col(score) * _col(weight)), F.sum(_col(weight)), digits)


def flag_count(flag, blank_when_zero: bool = False) -> Column:
    """M8: rows whose flag is true; optionally NULL when none (BLANK)."""
    n = F.count_if(_col(flag))
    return F.nullif(n, F.lit(0)) if blank_when_zero else n


def flag_rate(flag, digits: int | None = 2) -> Column:
    """M9: M8 / M7."""
    return ratio(F.count_if(_col(flag)), row_count(), digits)
