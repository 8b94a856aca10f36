"""Distribution and association statistics, computed as Spark jobs.

* ``exact_quantiles`` -- linear-interpolation quantiles (the ``(n-1)*q``
  rule of pandas / ``quantile_cont``), per group, from value counts and a
  skew-safe running sum over them.  No task ever holds a whole group, unlike
  ``percentile`` whose final merge keeps one value->count map per group.
* ``box_stats`` -- quartiles, whiskers (extreme values inside the 1.5 IQR
  fences) and outlier counts per group.
* ``point_biserial`` -- Pearson r of a 0/1 flag against a numeric column
  (the point-biserial coefficient), with its two-sided p-value from the
  t distribution with n-2 degrees of freedom.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.sequence import null_safe_join, range_sketch, running
from strata.operators.skew import hot_of, hot_sketch

def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _qname(q: float) -> str:
    return "q" + f"{q * 100:g}".replace(".", "_")


def _ranked(df: DataFrame, value: str, by: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Distinct values ``_v`` of each group with their count ``_c``, the rows up to them ``_upto`` and the group's rows ``_n``.

    NULL and NaN values are left out, as pandas leaves them out.
    """
    v = F.col(value).cast("double")
    rows = df.select(*[F.col(b) for b in by], v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    counts = rows.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c"))
    # One pass without a shuffle names the hot groups and the ranges of the values.
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = rows.agg(range_sketch(F.col("_v"), n).alias("_cuts"), *(hot_sketch(by) if by else [])).first()
    return running(counts, ["_v"], by, F.col("_c"), "_upto", "sum", partitions, total="_n",
                   hot=hot_of(found, n) if by else None, cuts=found["_cuts"] or [])


def _quantile_columns(qs: Sequence[float], names: Sequence[str]) -> tuple[list[Column], list[Column]]:
    """Aggregates over ``_ranked`` rows, and the quantiles made of them."""
    aggs, cols = [], []
    for i, (nm, q) in enumerate(zip(names, qs)):
        pos = lambda n, q=q: F.lit(float(q)) * (F.col(n) - 1).cast("double")
        for side, rank in (("lo", F.floor(pos("_n"))), ("hi", F.ceil(pos("_n")))):
            aggs.append(F.min(F.when(F.col("_upto") >= rank + 1, F.col("_v"))).alias(f"_{side}{i}"))
        frac = pos("n") - F.floor(pos("n"))
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        cols.append(F.when(frac == 0, lo).otherwise(lo + (hi - lo) * frac).alias(nm))
    return aggs, cols


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], by: Sequence[str] = (),
                    names: Sequence[str] | None = None,
                    partitions: int | None = None) -> DataFrame:
    """One row per group: ``by`` columns, n, and one column per quantile.

    Ties are counted first (partial aggregation removes them before the
    shuffle); a skew-safe running sum over the distinct values then tells
    which value holds each rank, by a minimum over the group.
    """
    names = list(names) if names else [_qname(q) for q in qs]
    aggs, cols = _quantile_columns(qs, names)
    out = _ranked(df, value, list(by), partitions).groupBy(*by).agg(F.coalesce(F.max("_n"), F.lit(0)).alias("n"), *aggs)
    return out.select(*by, "n", *cols)


def approx_quantiles(df: DataFrame, value: str, qs: Sequence[float], by: Sequence[str] = (),
                     names: Sequence[str] | None = None, accuracy: int = 10_000) -> DataFrame:
    """Sketch-based quantiles (``percentile_approx``): one pass, mergeable,
    fixed memory per group; rank error about 1/``accuracy``."""
    names = list(names) if names else [_qname(q) for q in qs]
    v = F.col(value).cast("double")
    pa = F.percentile_approx(v, list(qs), accuracy)
    out = df.groupBy(*by).agg(F.count(v).alias("n"), pa.alias("_q"))
    return out.select(*by, "n", *[F.col("_q")[i].alias(nm) for i, nm in enumerate(names)])


def median_by(df: DataFrame, value: str, by: Sequence[str], name: str = "median") -> DataFrame:
    return exact_quantiles(df, value, [0.5], by, [name]).drop("n")


def summary(df: DataFrame, value: str, sum_kind: str | None = None,
            std_digits: int | None = None) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 %, max of one column, NULL and NaN left out.

    ``sum_kind`` (e.g. ``decimal(18,2)``) sums in an exact type first so the
    mean does not depend on the order rows are added in.
    """
    c = F.when(~F.isnan(F.col(value).cast("double")), F.col(value))
    mean = (F.sum(c.cast(sum_kind)).cast("double") / F.count(c) if sum_kind else F.avg(c))
    std = F.stddev_samp(c.cast("double"))
    if std_digits is not None:
        std = F.round(std, std_digits)
    moments = df.agg(F.count(c).alias("count"), mean.alias("mean"), std.alias("std"),
                     F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"))
    qs = exact_quantiles(df, value, [0.25, 0.5, 0.75], (), ["p25", "p50", "p75"]).drop("n")
    # Both sides are single rows: the moments ride along as one scalar
    # subquery returning a struct (no join).
    m = moments.select(F.struct(*moments.columns).alias("_m")).scalar()
    return (qs.select(m.alias("_m"), "p25", "p50", "p75")
            .select("_m.count", "_m.mean", "_m.std", "_m.min", "p25", "p50", "p75", "_m.max"))


def box_stats(df: DataFrame, value: str, by: Sequence[str], whisker: float = 1.5) -> DataFrame:
    """Per group: n, q1, median, q3, lower/upper whisker, outlier count.

    Quartiles and whiskers come from the same counted values: the input is read once.
    """
    by = list(by)
    aggs, cols = _quantile_columns([0.25, 0.5, 0.75], ["q1", "median", "q3"])
    ranked = _ranked(df, value, by)
    q = ranked.groupBy(*by).agg(F.coalesce(F.max("_n"), F.lit(0)).alias("n"), *aggs).select(*by, "n", *cols)
    iqr = F.col("q3") - F.col("q1")
    fences = q.withColumns({"_lo": F.col("q1") - F.lit(whisker) * iqr, "_hi": F.col("q3") + F.lit(whisker) * iqr})
    inside = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    held = null_safe_join(ranked.select(*by, "_v", "_c"), fences, by)
    ends = [F.min(F.when(inside, F.col("_v"))).alias("lower_whisker"), F.max(F.when(inside, F.col("_v"))).alias("upper_whisker"),
            F.sum(F.when(inside, 0).otherwise(F.col("_c"))).alias("outliers")]
    keep = ["n", "q1", "median", "q3"]
    return held.groupBy(*by, *keep).agg(*ends).select(*by, *keep, "lower_whisker", "upper_whisker", "outliers")


# -- association -------------------------------------------------------------

def point_biserial(df: DataFrame, flag: str | Column, value: str | Column,
                   digits: int | None = None) -> DataFrame:
    """r between a boolean/0-1 flag and a numeric column, with n."""
    f = _as_col(flag).cast("int").cast("double")
    x = _as_col(value).cast("double")
    pair = df.select(f.alias("_f"), x.alias("_x")).dropna()
    # Pearson r without ``corr``: under ANSI mode ``corr`` raises on a
    # constant column; this form yields NULL there instead.
    r = F.try_divide(F.covar_samp("_f", "_x"),
                     F.stddev_samp("_f") * F.stddev_samp("_x"))
    if digits is not None:
        r = F.round(r, digits)
    return pair.agg(r.alias("r"), F.count(F.lit(1)).alias("n"))


def point_biserial_test(df: DataFrame, flag: str | Column, value: str | Column) -> DataFrame:
    """r, n, t statistic and two-sided p-value (t distribution, n-2 dof).

    The p-value is that of the slope of a least-squares line of the value on
    the flag, which is the same test; ``pyspark.ml`` computes it from one
    distributed pass.  Guards: n < 3 and a constant column (r is NULL) give
    NULL t and p; |r| = 1 gives an infinite t and p = 0.
    """
    pair = df.select(_as_col(flag).cast("int").cast("double").alias("_f"),
                     _as_col(value).cast("double").alias("_x")).dropna()
    base = point_biserial(pair, "_f", "_x")
    dof = (F.col("n") - 2).cast("double")
    r = F.col("r")
    t = (F.when((F.col("n") < 3) | r.isNull(), F.lit(None).cast("double"))
         .when(F.abs(r) >= 1, F.signum(r) * F.lit(float("inf")))
         .otherwise(r * F.sqrt(dof / (F.lit(1.0) - r * r))))
    out = base.withColumn("t", t)
    found = out.first()                 # one row
    p = None
    if found["t"] is not None:
        p = 0.0
        if abs(found["t"]) != float("inf"):
            rows = VectorAssembler(inputCols=["_f"], outputCol="_v").transform(pair)
            line = LinearRegression(featuresCol="_v", labelCol="_x", solver="normal").fit(rows)
            p = float(line.summary.pValues[0])
    return out.withColumn("p_value", F.lit(p).cast("double"))


def segment_rates(df: DataFrame, segment: str | Sequence[str], flag: str | Column,
                  min_n: int | None = None, rate: str = "rate", n: str = "n") -> DataFrame:
    """Rate of ``flag`` and group size per segment; small groups optional."""
    seg = [segment] if isinstance(segment, str) else list(segment)
    out = df.groupBy(*seg).agg(
        F.try_divide(F.count_if(_as_col(flag)).cast("double"),
                     F.count(F.lit(1)).cast("double")).alias(rate),
        F.count(F.lit(1)).alias(n))
    return out.filter(F.col(n) >= min_n) if min_n else out
