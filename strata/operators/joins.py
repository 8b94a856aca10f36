"""Join operators for star schemas.

Dimension lookups are left joins, so a failed match shows up as a NULL
surrogate key (checked by ``quality.orphan_report``) instead of silently
dropping fact rows.  The dimension side is pruned to (key columns, sk)
before the join.

Broadcast policy: joins carry no hint.  AQE switches a sort-merge join to a
broadcast join only from the *measured* size of the finished shuffle stage
(``spark.sql.adaptive.autoBroadcastJoinThreshold``) and splits skewed
partitions of a side that comes straight from a shuffle (``skewJoin``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.skew import salted_lookup


def lookup_key(fact: DataFrame, dim: DataFrame, on: Sequence[str] | str, sk: str,
               how: str = "left") -> DataFrame:
    """Attach ``dim.sk`` to each fact row by natural key(s) ``on``."""
    on = [on] if isinstance(on, str) else list(on)
    right = dim.select(*on, sk)
    return fact.join(right, on, how)


def preaggregate_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                      measure: str, out: str, default=0, kind: str | None = None) -> DataFrame:
    """Sum ``right.measure`` to the grain of ``keys`` first, then left join.

    Aggregating before the join keeps one right row per key, so the join
    cannot fan out the left side; missing keys get ``default``.  Left rows of a
    hot key are spread over several tasks (``skew.salted_lookup``).
    """
    keys = list(keys)
    s = F.sum(measure)
    agg = right.groupBy(*keys).agg((s.cast(kind) if kind else s).alias(out))
    j = salted_lookup(left, agg, keys)
    return j.withColumn(out, F.coalesce(F.col(out), F.lit(default).cast(
        kind or agg.schema[out].dataType.simpleString())))


def slice_by_unrelated(members: DataFrame, column: str, total: DataFrame) -> DataFrame:
    """Each member of an unrelated dimension gets the grand total.

    This is what slicing a measure by a dimension with no relationship to
    the fact yields.  ``total`` is a one-row aggregate attached as a scalar
    subquery (no cross join).
    """
    value_col = total.columns[0]
    return members.select(column).distinct().withColumn(value_col, total.scalar())


def outputs_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """Multiset difference both ways (EXCEPT ALL); equal when both are 0."""
    cols = a.columns
    b = b.select(*cols)
    only_a = a.exceptAll(b).agg(F.count(F.lit(1)).alias("only_left"))
    only_b = b.exceptAll(a).agg(F.count(F.lit(1)))
    return (only_a.select("only_left", only_b.scalar().alias("only_right"))
            .withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0)))
