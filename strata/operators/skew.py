"""Joins and aggregates that a hot key cannot funnel into one task.

AQE splits a skewed partition only where both sides of a join come straight
from a shuffle; a join to an aggregate, and the aggregate of distinct values
itself, stay whole.  Here the hot keys are found first and only they are
spread:

* ``hot_keys`` -- a frequent-items sketch over the key (one pass, merged in the
  tasks, fixed size) names the keys that hold more than half a task's rows and
  into how many parts each is cut.  It misses no key above that share.
* ``salted_lookup`` -- rows of hot keys get a part number, the one matching row
  of such a key is repeated once per part, all other rows join as they are.
* ``salted_rollup`` -- the aggregates of (key, part), then of the key; distinct
  values are dealt to parts by value, so each is counted in one part only.

Parts come from a hash of the row and its partition's number: a task that is
run again gives the same parts.  Keys are compared by a 64-bit hash; two keys
that share one are both spread, which costs a little and changes nothing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys that the sketch tracks per key it may report: its counts are off by at most a few parts in ten thousand.
TRACKED = 10_000
#: Most hot keys that are spread; a key of so small a share fills no task.
MOST = 1_000

_PART = "_skew_part"


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def hot_keys(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> dict[int, int]:
    """{key hash: parts} of the keys that hold more than half of an even task's rows.

    The driver receives at most ``MOST`` numbers.  A NULL key counts like any
    other: its rows meet in one task too, although an equi-join matches none.
    """
    return hot_of(df.agg(*hot_sketch(keys)).first(), partitions or _partitions(df))


def hot_sketch(keys: Sequence[str]) -> list[Column]:
    """Aggregates that ``hot_of`` reads, for a pass that aggregates something else as well."""
    return [F.call_function("approx_top_k", key_hash(keys), F.lit(MOST), F.lit(TRACKED)).alias("_top"), F.count(F.lit(1)).alias("_rows")]


def hot_of(found, partitions: int) -> dict[int, int]:
    """{key hash: parts} from a row with the aggregates of ``hot_sketch``."""
    if not found["_rows"]:
        return {}
    even = found["_rows"] / partitions
    return {r["item"]: math.ceil(2 * r["count"] / even) for r in found["_top"] or [] if r["count"] > even / 2}


def _lookup(hot: dict[int, int], keys: Sequence[str]) -> Column:
    """Parts of a row's key; 1 where it is not hot."""
    if not hot:
        return F.lit(1)
    h = key_hash(keys)
    parts = F.create_map(*(F.lit(x) for k, n in hot.items() for x in (k, n)))
    return F.when(h.isin(list(hot)), parts[h]).otherwise(1)


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]


def _part_of_row(df: DataFrame, hot: dict[int, int], keys: Sequence[str]) -> Column:
    spread = F.pmod(F.xxhash64(*_hashable(df), F.spark_partition_id()), _lookup(hot, keys)).cast("int")
    return F.when(key_hash(keys).isin(list(hot)), spread).otherwise(0)


def salted_lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
                  hot: dict[int, int] | None = None) -> DataFrame:
    """``left`` joined (``left`` or ``inner``) to ``right``, which has one row per key.

    ``hot`` are the hot keys of ``left`` where they are known already, for
    example from the narrower table that ``left`` was made of.
    """
    keys = list(keys)
    if how not in ("left", "inner"):
        raise ValueError(f"salted_lookup joins left or inner, not {how!r}")
    hot = hot_keys(left, keys) if hot is None else hot
    if not hot:
        return left.join(right, keys, how)
    part = F.explode(F.sequence(F.lit(0), _lookup(hot, keys) - 1))
    again = right.withColumn(_PART, part)
    return left.withColumn(_PART, _part_of_row(left, hot, keys)).join(again, [*keys, _PART], how).drop(_PART)


def salted_rollup(df: DataFrame, keys: Sequence[str], aggs: dict[str, tuple[str, str]],
                  hot: dict[int, int] | None = None) -> DataFrame:
    """One row per key with ``aggs``: {output: (``sum`` | ``count`` | ``min`` | ``max`` | ``distinct``, column)}.

    ``distinct`` counts the distinct values.  A NULL key is a group.
    """
    keys = list(keys)
    first = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    plain = {o: (kind, c) for o, (kind, c) in aggs.items() if kind != "distinct"}
    hot = hot_keys(df, keys) if hot is None else hot
    out = None
    if plain:
        half = df.groupBy(*keys, _part_of_row(df, hot, keys).alias(_PART)).agg(*(first[kind](c).alias(o) for o, (kind, c) in plain.items()))
        out = half.groupBy(*keys).agg(*(first["sum" if kind in ("sum", "count") else kind](o).alias(o) for o, (kind, _) in plain.items()))
    for o, (kind, c) in aggs.items():
        if kind != "distinct":
            continue
        by_value = F.when(key_hash(keys).isin(list(hot)), F.pmod(F.xxhash64(c), _lookup(hot, keys))).otherwise(0)
        parts = df.groupBy(*keys, by_value.alias(_PART)).agg(F.count_distinct(c).alias(o)).groupBy(*keys).agg(F.sum(o).alias(o))
        out = parts if out is None else _together(out, parts, keys, o)
    return out.select(*keys, *aggs)


def _together(a: DataFrame, b: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Two aggregates of the same keys in one row per key (a NULL key matches itself)."""
    both = a.withColumn(col, F.lit(None).cast(b.schema[col].dataType)).unionByName(b, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*(F.max(c).alias(c) for c in [*[c for c in a.columns if c not in keys], col]))
