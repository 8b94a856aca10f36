"""Old against new: which rows and columns of two outputs differ, without moving what is equal.

``compare_keyed`` goes from the whole to the part:

1. both sides add up row digests per range of the key's hash (``2^16`` ranges,
   partial sums in the tasks); ranges whose counts and sums agree are done;
2. the rows of differing ranges do the same per sub-range;
3. only rows of differing sub-ranges are shuffled and meet by key: a key on one
   side only is ``missing`` or ``extra``, one that occurs several times on a
   side and differs is ``repeated``, else the columns that differ are listed.

A digest is the 64-bit hash of a row's compared values; its two halves are added
separately, so equal sums of unequal ranges need two coincidences at once.
Values compare as text; ``normalise`` replaces columns first (rounding, case).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.errors import CheckFailed

RANGE_BITS = 16
_SUMS = ("n", "low", "high")


def _prepared(df: DataFrame, keys: Sequence[str], cols: Sequence[str], normalise: dict[str, Column] | None) -> DataFrame:
    if normalise:
        df = df.withColumns(normalise)
    text = [F.col(c).cast("string").alias(c) for c in cols]
    out = df.select(F.struct(*[F.col(k).cast("string").alias(k) for k in keys]).alias("_key"), F.struct(*text).alias("_row") if cols else F.lit(None).alias("_row"))
    h = F.xxhash64("_key")
    return out.withColumns({"_r1": F.shiftright(h, 64 - RANGE_BITS), "_r2": F.shiftright(h, 64 - 2 * RANGE_BITS), "_d": F.xxhash64("_key", "_row")})


def _differing(old: DataFrame, new: DataFrame, level: str) -> DataFrame:
    """The ranges of ``level`` whose sums differ."""
    def sums(df: DataFrame) -> DataFrame:
        return df.groupBy(level).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_d").bitwiseAND(0xFFFFFFFF)).alias("low"),
                                     F.sum(F.shiftrightunsigned("_d", 32)).alias("high"))
    b = sums(new).select(F.col(level).alias("_o"), *(F.col(c).alias(f"_{c}") for c in _SUMS))
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _SUMS])
    return sums(old).join(b, F.col(level) == F.col("_o"), "full").where(~same).select(F.coalesce(level, "_o").alias(level))


def compare_keyed(old: DataFrame, new: DataFrame, keys: Sequence[str], normalise: dict[str, Column] | None = None) -> DataFrame:
    """Rows (keys, kind, column, old_value, new_value); no rows where the outputs agree.

    Both sides must have the same columns; ``keys`` identify a row (a NULL key
    is a key like any other).
    """
    if sorted(old.columns) != sorted(new.columns):
        raise CheckFailed("outputs have different columns", {"old": sorted(old.columns), "new": sorted(new.columns)})
    keys = list(keys)
    cols = [c for c in old.columns if c not in keys]
    a, b = (_prepared(df, keys, cols, normalise) for df in (old, new))
    ranges = F.broadcast(_differing(a, b, "_r1"))           # 2^16 rows at most
    a, b = a.join(ranges, "_r1", "left_semi"), b.join(ranges, "_r1", "left_semi")
    parts = _differing(a, b, "_r2")

    def rows(df: DataFrame, tag: str) -> DataFrame:
        return (df.join(parts, "_r2", "left_semi").groupBy("_key")
                .agg(F.count(F.lit(1)).alias(f"{tag}_n"), F.min("_row").alias(f"{tag}_row"), F.sum(F.col("_d").bitwiseAND(0xFFFFFFFF)).alias(f"{tag}_d")))

    met = rows(a, "old").join(rows(b, "new"), "_key", "full")
    several = (F.col("old_n") > 1) | (F.col("new_n") > 1)
    entry = lambda kind, c, o, n: F.struct(F.lit(kind).alias("kind"), c.alias("column"), o.alias("old_value"), n.alias("new_value"))
    none = F.lit(None).cast("string")
    changed = F.array(*[F.when(~F.col(f"old_row.{c}").eqNullSafe(F.col(f"new_row.{c}")), entry("changed", F.lit(c), F.col(f"old_row.{c}"), F.col(f"new_row.{c}")))
                        for c in cols]) if cols else F.array().cast("array<struct<kind:string,column:string,old_value:string,new_value:string>>")
    one = lambda e: F.array(e)
    found = (F.when(F.col("new_n").isNull(), one(entry("missing", none, none, none)))
             .when(F.col("old_n").isNull(), one(entry("extra", none, none, none)))
             .when(several & ((F.col("old_n") != F.col("new_n")) | (F.col("old_d") != F.col("new_d"))),
                   one(entry("repeated", none, F.col("old_n").cast("string"), F.col("new_n").cast("string"))))
             .when(several, F.array_repeat(entry("", none, none, none), 0))
             .otherwise(F.filter(changed, lambda x: x.isNotNull())))
    return met.select("_key", F.explode(found).alias("e")).select("_key.*", "e.*")


def difference_counts(differences: DataFrame) -> DataFrame:
    """Rows per kind and column of a comparison."""
    return differences.groupBy("kind", "column").agg(F.count(F.lit(1)).alias("n"))
