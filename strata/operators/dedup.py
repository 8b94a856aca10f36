"""Keep one row per key, deterministically.

Implemented as an aggregate -- ``min``/``max`` of a struct whose leading
fields are the ordering columns -- rather than ``row_number`` over a window.
The aggregate is partially evaluated before the shuffle, so a key holding a
third of all rows is reduced to one row per mapper and never lands whole in
one task.  Struct comparison orders field by field with NULLs first, the
same order as an ascending ``ORDER BY``.  Include enough columns in
``order`` to break ties; all remaining columns are appended as final
tie-breakers, so the result never depends on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: Sequence[str] | str, order: Sequence[str],
               descending: bool = False) -> DataFrame:
    key = [key] if isinstance(key, str) else list(key)
    order = list(order)
    rest = [c for c in df.columns if c not in key and c not in order]
    pick = F.max if descending else F.min
    picked = df.groupBy(*key).agg(pick(F.struct(*order, *rest)).alias("_pick"))
    return picked.select(*key, *[F.col(f"_pick.{c}").alias(c) for c in order + rest]) \
                 .select(*df.columns)
