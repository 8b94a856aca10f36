"""Data-quality operators: quarantine split, reconciliation, uniqueness,
orphan and fan-out checks, anti-join probes, category profiles.

Every report is a small DataFrame built from one aggregate pass (or a union
of one-row aggregates); ``require`` collects such a report -- a handful of
scalars, never data rows -- and raises ``CheckFailed`` when a rule fails.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.errors import CheckFailed


def _cols(cs) -> list[str]:
    return [cs] if isinstance(cs, str) else list(cs)


# -- quarantine --------------------------------------------------------------

def invalid_mask(rule: Column) -> Column:
    """True exactly where ``rule`` is false.  A NULL rule result counts as
    valid, so the two sides partition the input by construction."""
    return F.coalesce(~rule, F.lit(False))


def split_by_rule(df: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) halves of ``df``; together they are the whole input."""
    bad = invalid_mask(rule)
    return df.filter(~bad), df.filter(bad)


def score_in_range(c, low=0, high=100) -> Column:
    """Validity rule: NULL (not graded) or inside [low, high]."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | ((c >= F.lit(low)) & (c <= F.lit(high)))


def split_report(df: DataFrame, rule: Column) -> DataFrame:
    """One pass: valid, invalid and source counts, and whether they add up."""
    bad = invalid_mask(rule)
    return (df.agg(F.count_if(~bad).alias("valid_rows"),
                   F.count_if(bad).alias("invalid_rows"),
                   F.count(F.lit(1)).alias("source_rows"))
            .withColumn("complete", (F.col("valid_rows") + F.col("invalid_rows"))
                        == F.col("source_rows")))


# -- counting and reconciliation ---------------------------------------------

def count_tables(tables: dict[str, DataFrame], name_col: str = "table_name",
                 count_col: str = "row_count") -> DataFrame:
    """UNION ALL of one-row counts, one per named table."""
    parts = [df.agg(F.count(F.lit(1)).alias(count_col))
             .select(F.lit(name).alias(name_col), count_col)
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def reconcile(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(table_name, source_rows, target_rows, match) for each named pair."""
    src = count_tables({k: v[0] for k, v in pairs.items()}, count_col="source_rows")
    dst = count_tables({k: v[1] for k, v in pairs.items()}, count_col="target_rows")
    return (src.join(dst, "table_name", "full")
            .withColumn("match", F.coalesce(F.col("source_rows") == F.col("target_rows"),
                                            F.lit(False))))


def uniqueness(df: DataFrame, keys) -> DataFrame:
    """rows vs distinct keys of a dimension; unique when equal."""
    keys = _cols(keys)
    return (df.agg(F.count(F.lit(1)).alias("rows"),
                   F.count_distinct(*[F.col(k) for k in keys]).alias("distinct_keys"))
            .withColumn("unique", F.col("rows") == F.col("distinct_keys")))


def duplicate_keys(df: DataFrame, keys, count_col: str = "n") -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    keys = _cols(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .filter(F.col(count_col) > 1))


def orphan_report(fact: DataFrame, sk_cols: Sequence[str],
                  expected_rows: DataFrame | None = None) -> DataFrame:
    """Rows and NULL surrogate keys after a left join; with ``expected_rows``
    (the pre-join source) also the fan-out check rows == source rows."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in sk_cols]
    rep = fact.agg(*aggs)
    ok = reduce(lambda a, b: a & b, [F.col(f"null_{c}") == 0 for c in sk_cols],
                F.lit(True))
    if expected_rows is not None:
        rep = rep.withColumn("source_rows",
                             expected_rows.agg(F.count(F.lit(1))).scalar())
        ok = ok & (F.col("rows") == F.col("source_rows"))
    return rep.withColumn("ok", ok)


def anti_counts(a: DataFrame, b: DataFrame, keys, a_name: str = "left",
                b_name: str = "right") -> DataFrame:
    """Keys present on one side only, counted in both directions."""
    keys = _cols(keys)
    ka, kb = a.select(*keys), b.select(*keys)
    only_a = ka.join(kb, keys, "left_anti").agg(F.count(F.lit(1)).alias("n"))
    only_b = kb.join(ka, keys, "left_anti").agg(F.count(F.lit(1)).alias("n"))
    return only_a.select(F.col("n").alias(f"in_{a_name}_not_in_{b_name}"),
                         only_b.scalar().alias(f"in_{b_name}_not_in_{a_name}"))


def profile(df: DataFrame, expr: Column | str, name: str = "value",
            count_col: str = "n", pct_col: str = "pct") -> DataFrame:
    """Category profile: value, count and percent of all rows.

    The total is a scalar subquery, so no step moves the grouped result
    into one partition; groups can be as many as the data has values.
    """
    e = F.col(expr) if isinstance(expr, str) else expr
    grouped = df.groupBy(e.alias(name)).agg(F.count(F.lit(1)).alias(count_col))
    total = df.agg(F.count(F.lit(1))).scalar()
    return grouped.withColumn(pct_col, F.col(count_col).cast("double") * F.lit(100.0)
                              / total.cast("double"))


def require(report: DataFrame, rules: dict[str, Column], what: str) -> dict:
    """Evaluate boolean ``rules`` on a small report; raise on any failure.

    The report must be small (it is collected whole); returns the first
    row's values for logging.
    """
    named = report.select("*", *[r.alias(f"__rule_{k}") for k, r in rules.items()])
    rows = named.collect()
    failed = sorted({k for row in rows for k in rules if row[f"__rule_{k}"] is not True})
    first = {k: v for k, v in rows[0].asDict().items() if not k.startswith("__rule_")} if rows else {}
    if failed:
        raise CheckFailed(f"{what}: failed {failed}; numbers {first}", first)
    return first


def require_all_rows(report: DataFrame, flag: str, what: str) -> list[dict]:
    """Every row of a small report must carry ``flag`` = true."""
    rows = [r.asDict() for r in report.collect()]
    bad = [r for r in rows if r.get(flag) is not True]
    if bad:
        raise CheckFailed(f"{what}: {len(bad)} row(s) failed: {bad}", {"failed": bad})
    return rows


def cast_loss_report(raw: DataFrame, spec: dict[str, str]) -> DataFrame:
    from strata.functions.casts import cast_loss
    return cast_loss(raw, spec)


def distinct_values(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Distinct-values probe before choosing a type."""
    return df.select(*cols).distinct()
