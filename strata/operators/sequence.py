"""Skew-safe row numbering within groups (and globally).

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends every row of a
group to one task; with a group holding a third of the data that task
holds a third of the data.  ``number_rows`` gets the same numbers without
that funnel:

1. range-partition on (g, o): a large group is cut into value ranges
   spread over many partitions (the range bounds come from a sample);
2. sort inside the partition and take ``monotonically_increasing_id``: its
   high bits are the partition, its low bits the place in it, so the rows are
   shuffled once and need no window;
3. per (partition, group) segment take the first place and the count, and turn
   counts into offsets with a running sum over the segments of a group (at
   most one per partition, so this window is small);
4. number = place - first place of the segment + offset.  Numbering without
   groups has one segment per partition, and that bounded table is broadcast.

Steps 3 and 4 both read the output of step 2.  Range bounds are sampled per
execution, so the locally numbered rows are checkpointed (reliable
checkpoint in the shared ``spark.checkpoint.dir``) and both steps read the
same materialized rows; this also cuts the lineage, so a lost executor
re-reads the checkpoint instead of re-sampling.

The result is exactly ``row_number`` when ``order`` is a total order
within each group (add a unique column to break ties).

All steps are DataFrame operations planned by Catalyst; no rows are collected.
``running`` and ``neighbour`` use such ranges for hot groups only, which a sketch
names at every input size; groups that fit a task are plain windows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.skew import hot_keys, key_hash
from strata.session import ensure_checkpoint_dir

_PID = "_seq_pid"
_LOCAL = "_seq_local"
_N = "_seq_n"
_FIRST = "_seq_first"
_OFF = "_seq_off"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_ID_BITS = 33       # monotonically_increasing_id: partition above, place below


def _ranged(df: DataFrame, by: Sequence[str], order_cols: Sequence[Column], partitions: int | None) -> DataFrame:
    cols = [*[F.col(b) for b in by], *order_cols]
    # Without an explicit count AQE may merge adjacent range partitions
    # (never reorders them), so small inputs do not pay for 200 tasks.
    return df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)


def number_rows(df: DataFrame, order: Sequence, by: Sequence[str] = (), name: str = "rn",
                partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based row number within ``by`` groups in ``order``."""
    by = list(by)
    order_cols = [_as_col(c) for c in order]
    ensure_checkpoint_dir(df.sparkSession)
    local = (_ranged(df, by, order_cols, partitions)
             .sortWithinPartitions(*[F.col(b) for b in by], *order_cols)
             .withColumn(_LOCAL, F.monotonically_increasing_id())
             .withColumn(_PID, F.shiftright(_LOCAL, _ID_BITS))
             .checkpoint(eager=True))
    seg_keys = [_PID, *by]
    seg = local.groupBy(*seg_keys).agg(F.min(_LOCAL).alias(_FIRST), F.count(F.lit(1)).alias(_N))
    running = Window.partitionBy(*by).orderBy(_PID).rowsBetween(
        Window.unboundedPreceding, -1)
    seg = seg.withColumn(_OFF, F.coalesce(F.sum(_N).over(running), F.lit(0)) - F.col(_FIRST) + 1)
    seg = seg.select(*seg_keys, _OFF)
    # Without groups: one row per partition, whatever the number of rows.
    out = null_safe_join(local, seg if by else F.broadcast(seg), seg_keys)
    return (out.withColumn(name, (F.col(_OFF) + F.col(_LOCAL)).cast("bigint"))
               .drop(_PID, _LOCAL, _OFF))


def null_safe_join(rows: DataFrame, seg: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on segment keys, NULL-safe (a NULL group is a group)."""
    renamed = seg.select(*[F.col(k).alias(f"_sk_{k}") for k in keys],
                         *[c for c in seg.columns if c not in keys])
    cond = None
    for k in keys:
        c = rows[k].eqNullSafe(renamed[f"_sk_{k}"])
        cond = c if cond is None else cond & c
    return rows.join(renamed, cond, how).drop(*[f"_sk_{k}" for k in keys])


def _split_hot(df: DataFrame, by: Sequence[str], hot: dict[int, int] | None) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of groups that fit a task, and rows of hot groups; None for a side without rows.  Without groups all is hot."""
    if not by:
        return None, df
    hot = hot_keys(df, by) if hot is None else hot
    if not hot:
        return df, None
    crowded = key_hash(by).isin(list(hot))
    return df.where(~crowded), df.where(crowded)


def range_sketch(v: Column, n: int) -> Column:
    """Aggregate: bounds of about ``n`` ranges with as many rows each."""
    return F.percentile_approx(F.when(~F.isnan(v), v), [(i + 1) / n for i in range(n)], 10 * n)


def _with_bins(df: DataFrame, order, name: str, cuts: Sequence[float] | None = None) -> DataFrame | None:
    """``name`` = number of an ascending range of the first order column, about as many ranges as shuffle partitions
    with as many rows each; None where that column is not a number or a time.

    The bounds are approximate percentiles: one pass, no shuffle, a number per partition on the driver.
    """
    if not isinstance(order, str):
        return None
    kind = df.schema[order].dataType
    if isinstance(kind, T.NumericType):
        v = F.col(order).cast("double")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        v = F.col(order).cast("timestamp").cast("double")
    else:
        return None
    if cuts is None:
        cuts = df.agg(range_sketch(v, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))).alias("c")).first()["c"] or []
    splits = [float("-inf"), *sorted({c for c in cuts if abs(c) != float("inf")} or {0.0}), float("inf")]
    raw, bin_ = f"{name}_v", f"{name}_b"
    put = Bucketizer(splits=splits, inputCol=raw, outputCol=bin_, handleInvalid="keep")
    # NULLs sort first, NaNs (kept in a bin of their own) last.
    return (put.transform(df.withColumn(raw, v))
            .withColumn(name, F.when(F.col(raw).isNull(), -1).otherwise(F.col(bin_).cast("int"))).drop(raw, bin_))


def running(df: DataFrame, order: Sequence, by: Sequence[str], value: Column, name: str,
            how: str = "max", partitions: int | None = None, total: str | None = None,
            hot: dict[int, int] | None = None, cuts: Sequence[float] | None = None) -> DataFrame:
    """``name`` = running ``max`` or ``sum`` of ``value`` up to and including
    this row (in ``order``) within ``by``; ``total`` = the same over the group.

    A group that fits a task is one window.  Hot groups (``skew.hot_keys``) are
    cut into ranges of the first order column: the rows are shuffled once on
    (range, group), a window runs inside each, and the fold of all earlier
    ranges of the group, from a small table of a row per range, is carried in.
    ``hot`` groups and the ranges' bounds ``cuts`` may be known already.
    """
    by = list(by)
    fold = {"max": F.max, "sum": F.sum}[how]
    order_cols = [_as_col(c) for c in order]
    rows = df.withColumn("_rm_v", value)
    cold, crowded = _split_hot(rows, by, hot)
    out = []
    if cold is not None:
        w = Window.partitionBy(*by)
        done = cold.withColumn(name, fold("_rm_v").over(w.orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        out.append((done.withColumn(total, fold("_rm_v").over(w)) if total else done).drop("_rm_v"))
    if crowded is not None:
        out.append(_running_ranges(crowded, order, order_cols, by, name, fold, how, partitions, total, cuts))
    return reduce(DataFrame.unionByName, out)


def _running_ranges(rows: DataFrame, order: Sequence, order_cols: Sequence[Column], by: list[str], name: str, fold, how: str,
                    partitions: int | None, total: str | None, cuts: Sequence[float] | None) -> DataFrame:
    # A struct is never NULL, whatever its fields are: plain equality joins NULL groups too and keeps the partitioning.
    group = [F.struct(*by).alias("_rm_g")] if by else []
    ranged = _with_bins(rows.select("*", *group), order[0], _PID, cuts)
    keys = [_PID, "_rm_g"] if by else [_PID]
    if ranged is not None:
        ranged = ranged.repartition(partitions, *keys) if partitions else ranged.repartition(*keys)
    else:
        ensure_checkpoint_dir(rows.sparkSession)
        ranged = _ranged(rows.select("*", *group), by, order_cols, partitions).withColumn(_PID, F.spark_partition_id()).checkpoint(eager=True)
    w = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn("_rm_local", fold("_rm_v").over(w))
    seg = ranged.groupBy(*keys).agg(fold("_rm_v").alias("_rm_seg"))
    whole = Window.partitionBy(*keys[1:])       # a row per range
    seg = seg.select(*keys, fold("_rm_seg").over(whole.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)).alias("_rm_in"),
                     *([fold("_rm_seg").over(whole).alias(total)] if total else []))
    out = local.join(seg, keys)
    both = (F.greatest("_rm_local", "_rm_in") if how == "max" else
            F.coalesce(F.col("_rm_local") + F.col("_rm_in"), "_rm_local", "_rm_in"))
    return out.withColumn(name, both).drop(_PID, "_rm_local", "_rm_in", "_rm_v", "_rm_g")


def dense_key(df: DataFrame, order: Sequence[str], name: str = "sk",
              partitions: int | None = None) -> DataFrame:
    """Dense surrogate key 0..n-1 in natural-key order, placed first.

    Deterministic: the same input gives the same keys on every run and
    every action, unlike ``monotonically_increasing_id`` (which depends on
    the partitioning of the moment).  Input rows must be distinct on
    ``order``.
    """
    numbered = number_rows(df, order, (), name, partitions)
    cols = [c for c in df.columns]
    return numbered.select((F.col(name) - 1).cast("bigint").alias(name), *cols)


def neighbour(df: DataFrame, order: Sequence, by: Sequence[str] = (),
              cols: Sequence[str] = (), offset: int = 1, prefix: str = "next_",
              partitions: int | None = None, hot: dict[int, int] | None = None) -> DataFrame:
    """LEAD (offset > 0) or LAG (offset < 0) of ``cols`` within ``by``.

    A group that fits a task is one window.  Rows of hot groups
    (``skew.hot_keys``) are numbered skew-safely and joined to the row
    ``offset`` places away on (group, number) -- an equi-join, NULL-safe in the
    group, on a key that is unique per row.
    """
    by = list(by)
    cold, crowded = _split_hot(df, by, hot)
    out = []
    if cold is not None:
        w = Window.partitionBy(*by).orderBy(*[_as_col(c) for c in order])
        out.append(cold.withColumns({f"{prefix}{c}": F.lead(c, offset).over(w) for c in cols}))
    if crowded is not None:
        rn = "_nb_rn"
        numbered = number_rows(crowded, order, by, rn, partitions)
        other = numbered.select(*by, (F.col(rn) - F.lit(offset)).alias(rn),
                                *[F.col(c).alias(f"{prefix}{c}") for c in cols])
        out.append(null_safe_join(numbered, other, [*by, rn], "left").drop(rn))
    return reduce(DataFrame.unionByName, out)
