"""Additive roll-up of an event stream to a coarser grain.

Repeated event rows are real activity, so they are aggregated, never
de-duplicated.  ``groupBy().agg()`` plans a partial (map-side) aggregate
before the shuffle, so a hot key is reduced on every mapper first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup_events(df: DataFrame, keys: Sequence[str], value: str | Column,
                  total_name: str = "total_clicks", count_name: str = "event_count",
                  total_kind: str = "bigint") -> DataFrame:
    """One row per key combination: sum of ``value`` and number of events.

    NULL keys form their own group; NULL values are skipped by the sum but
    counted as events.  ``total_kind`` fixes the sum type (e.g. a decimal
    for money-like doubles so the sum does not depend on row order).
    """
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*keys).agg(F.sum(v.cast(total_kind)).alias(total_name),
                                 F.count(F.lit(1)).alias(count_name))


def conservation_report(source: DataFrame, rolled: DataFrame, value: str | Column,
                        total_name: str = "total_clicks", count_name: str = "event_count",
                        total_kind: str = "bigint") -> DataFrame:
    """Nothing lost: events counted == source rows and totals equal."""
    v = F.col(value) if isinstance(value, str) else value
    src = source.agg(F.count(F.lit(1)).alias("source_rows"),
                     F.sum(v.cast(total_kind)).alias("source_total"))
    out = rolled.agg(F.sum(count_name).alias("rolled_events"),
                     F.sum(total_name).alias("rolled_total"),
                     F.count(F.lit(1)).alias("rolled_rows"))
    return (src.select("source_rows", "source_total",
                       out.select("rolled_events").scalar().alias("rolled_events"),
                       out.select("rolled_total").scalar().alias("rolled_total"),
                       out.select("rolled_rows").scalar().alias("rolled_rows"))
            .withColumn("conserved",
                        (F.col("source_rows") == F.col("rolled_events"))
                        & F.coalesce(F.col("source_total") == F.col("rolled_total"),
                                     F.col("source_total").isNull()
                                     & F.col("rolled_total").isNull())))
