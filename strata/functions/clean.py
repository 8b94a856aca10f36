"""Cleaning and flag expressions.

Sources deliver "missing" both as NULL and as the empty string, so every
test for absence checks both.  Flags are computed from the raw text before
any cast, so they do not depend on the cast succeeding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    c = _col(c)
    return c.isNull() | (c == F.lit(""))


def impute_blank(c, value: str = "Unknown") -> Column:
    """NULL or '' -> ``value``; anything else unchanged."""
    return F.when(is_blank(c), F.lit(value)).otherwise(_col(c))


def canonicalise(c, mapping: dict) -> Column:
    """Whole-value replacement from a small dict; unmapped values unchanged.

    For mappings with thousands of entries, join a mapping table instead.
    """
    c = _col(c)
    if not mapping:
        return c
    expr = None
    for src, dst in mapping.items():
        expr = (F.when(c == F.lit(src), F.lit(dst)) if expr is None
                else expr.when(c == F.lit(src), F.lit(dst)))
    return expr.otherwise(c)


def presence_flag(c) -> Column:
    """True when the raw value is present (not NULL, not '')."""
    return ~is_blank(c)


def presence_int(c) -> Column:
    return F.when(presence_flag(c), F.lit(1)).otherwise(F.lit(0))


def presence_label(c, present: str = "unregistered",
                   absent: str = "registered") -> Column:
    return F.when(presence_flag(c), F.lit(present)).otherwise(F.lit(absent))


def null_default(c, value=0) -> Column:
    return F.coalesce(_col(c), F.lit(value))
