"""Dynamic row-level security over a star schema.

A mapping table (principal, attribute value) grants a principal the
dimension rows carrying those values.  The secured dimension is a
left-semi join of the dimension with the caller's mapped values; facts are
then restricted by a left-semi join on the surrogate key, so every measure
-- numerators and denominators -- sees the same secured rows.  An unmapped
principal sees nothing (deny by default).  Principals compare
case-insensitively.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def principal_values(mapping: DataFrame, principal: str | Column, user_col: str,
                     value_col: str) -> DataFrame:
    p = F.lit(principal) if isinstance(principal, str) else principal
    return (mapping.filter(F.lower(F.col(user_col)) == F.lower(p))
            .select(value_col).distinct())


def secure_dimension(dim: DataFrame, mapping: DataFrame, principal: str | Column,
                     attr: str, user_col: str = "user_email",
                     value_col: str = "region") -> DataFrame:
    allowed = principal_values(mapping, principal, user_col, value_col)
    if value_col != attr:
        allowed = allowed.withColumnRenamed(value_col, attr)
    return dim.join(allowed, attr, "left_semi")


def secure_fact(fact: DataFrame, secured_dim: DataFrame, sk: str,
                fact_col: str | None = None) -> DataFrame:
    fact_col = fact_col or sk
    return fact.join(secured_dim.select(F.col(sk).alias(fact_col)), fact_col, "left_semi")


def mask_columns(df: DataFrame, columns: Sequence[str], allowed: bool,
                 mask=None) -> DataFrame:
    """Column-level restriction: replace ``columns`` with ``mask`` (NULL by
    default) unless the caller is ``allowed``."""
    if allowed:
        return df
    return df.withColumns({c: F.lit(mask).cast(df.schema[c].dataType) for c in columns})
