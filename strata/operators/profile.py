"""Profiles of all columns in one pass, stored per load and merged without reading data again.

``profile_columns`` aggregates every column at once: exact counts (rows, NULLs,
blank texts), exact extremes, and three mergeable sketches -- distinct values
(HyperLogLog), quantiles (KLL, numeric columns) and frequent values.  The result
has a row per column and is stored as a small table per load; ``merge_profiles``
adds any number of them up, ``profile_report`` turns sketches into numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: log2 of the registers of the distinct-value sketch; its relative error is about 1 / 2^(HLL / 2).
HLL = 12
#: Values tracked per column by the frequent-value sketch.
TRACKED = 1_000


def _entry(name: str, kind: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    text, number = c.cast("string"), isinstance(kind, T.NumericType)
    as_double = c.cast("double") if number else F.lit(None).cast("double")
    ordered = F.lit(None).cast("string") if number else text
    blank = F.count_if(F.trim(text) == "") if isinstance(kind, T.StringType) else F.lit(0).cast("bigint")
    return F.struct(F.lit(name).alias("column"), F.lit(kind.simpleString()).alias("kind"), F.count(F.lit(1)).alias("rows"),
                    F.count_if(c.isNull()).alias("nulls"), blank.alias("blanks"),
                    F.min(as_double).alias("least"), F.max(as_double).alias("most"),
                    F.min(ordered).alias("first_text"), F.max(ordered).alias("last_text"),
                    F.hll_sketch_agg(text, HLL).alias("distinct_sketch"),
                    F.call_function("kll_sketch_agg_double", as_double).alias("quantile_sketch"),
                    F.call_function("approx_top_k_accumulate", text, F.lit(TRACKED)).alias("frequent_sketch"))


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column; one scan of ``df``, whatever the number of columns."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    entries = [_entry(c, kinds[c]).alias(f"c{i}") for i, c in enumerate(columns or df.columns)]
    one = df.agg(*entries)
    return one.select(F.explode(F.array(*one.columns)).alias("p")).select("p.*")


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """The profile of several loads together."""
    return profiles.groupBy("column", "kind").agg(
        *(F.sum(c).alias(c) for c in ("rows", "nulls", "blanks")),
        F.min("least").alias("least"), F.max("most").alias("most"), F.min("first_text").alias("first_text"), F.max("last_text").alias("last_text"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.call_function("kll_merge_agg_double", F.col("quantile_sketch")).alias("quantile_sketch"),
        F.call_function("approx_top_k_combine", F.col("frequent_sketch"), F.lit(TRACKED)).alias("frequent_sketch"))


def profile_report(profiles: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75), frequent: int = 5) -> DataFrame:
    """Numbers of a profile: the exact ones, distinct values, quantiles (NULL for texts) and the most frequent values with counts."""
    cuts = [F.when(F.col("least").isNotNull(), F.call_function("kll_sketch_get_quantile_double", F.col("quantile_sketch"), F.lit(float(q))))
            .alias(f"q{q * 100:g}".replace(".", "_")) for q in quantiles]
    return profiles.select("column", "kind", "rows", "nulls", "blanks", "least", "most", "first_text", "last_text",
                           F.hll_sketch_estimate("distinct_sketch").alias("distinct"), *cuts, "frequent_sketch") \
        .groupBy(*["column", "kind", "rows", "nulls", "blanks", "least", "most", "first_text", "last_text", "distinct"],
                 *[f"q{q * 100:g}".replace(".", "_") for q in quantiles]) \
        .agg(F.call_function("approx_top_k_estimate", F.call_function("approx_top_k_combine", F.col("frequent_sketch"), F.lit(TRACKED)), F.lit(frequent)).alias("frequent"))
