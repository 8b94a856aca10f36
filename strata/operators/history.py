"""Incremental loads, upserts, slowly changing dimensions, parallel runs.

* ``after_watermark`` -- rows newer than the high-watermark of what is
  already loaded (batch form of an incremental load).
* ``merge_upsert`` -- target rows whose key is not in the changes, plus
  all changes: an anti-join and a union (``MERGE`` where Delta exists).
* ``scd2`` -- type-2 history from dated attribute observations: one
  version per run of unchanged attributes, with ``effective_from``,
  ``effective_to`` (next version's start, or an open-end date) and
  ``is_current`` set on the latest version only.  Previous / next versions
  are found with the skew-safe ``sequence.neighbour``: windows on one shuffle,
  and an equi-join on (key, rank) for the keys with a huge history.
* ``scd2_apply`` -- a batch applied to stored history: only its keys are
  rebuilt.
* ``asof_join`` -- for each row, the latest row of another table with the
  same key at or before its time (e.g. the dimension version in effect on
  a fact's date).  Not a key join plus range filter, which pairs every row
  with every version of its key: both sides are unioned, ordered by
  (key, time) and a skew-safe running max carries the latest version
  forward (``sequence.running``).
* ``compare_outputs`` -- parallel-run check of an old and a new output
  after normalising (EXCEPT ALL both ways).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.errors import CheckFailed
from strata.operators.joins import outputs_equal
from strata.operators.sequence import neighbour, running
from strata.operators.skew import hot_keys

OPEN_END = "9999-12-31"


def after_watermark(source: DataFrame, loaded: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of ``source`` with ``column`` beyond max(``loaded.column``).

    With ``keys`` rows equal to the watermark qualify too, unless their key is
    loaded already; late rows of the last instant are then not lost.

    With nothing loaded yet, every row qualifies.  The watermark is a
    scalar subquery, so Catalyst can still push the comparison into the
    scan as a runtime filter.
    """
    mark = loaded.agg(F.max(column)).scalar()
    if not keys:
        return source.filter(mark.isNull() | (F.col(column) > mark))
    known = loaded.filter(F.col(column) == mark).select(*keys)
    return source.filter(mark.isNull() | (F.col(column) >= mark)).join(known, list(keys), "left_anti")


def merge_upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``changes`` replace target rows of equal key; raises ``CheckFailed`` unless
    the changes' keys are unique and not NULL (either would duplicate rows)."""
    keys = list(keys)
    bad = changes.groupBy(*keys).count().filter(
        (F.col("count") > 1) | reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))
    if not bad.isEmpty():
        raise CheckFailed(f"changes have repeated or NULL keys {keys}")
    kept = target.join(changes.select(*keys), keys, "left_anti")
    return kept.unionByName(changes.select(*target.columns))


def scd2(observations: DataFrame, key: Sequence[str], attrs: Sequence[str], at: str,
         tie: Sequence[str] = (), open_end: str = OPEN_END) -> DataFrame:
    """Type-2 versions from (key, attrs, at) observations.

    ``tie`` breaks ordering ties between observations with equal ``at``.
    """
    key, attrs = list(key), list(attrs)
    order = [at, *tie]
    obs = observations.select(*key, *attrs, *tie, at)
    hot = hot_keys(obs, key)            # found once: both neighbours then share one shuffle on the key
    # The marker tells "no previous row" from a previous row of NULLs.
    with_prev = neighbour(obs.withColumn("_here", F.lit(True)), order, key, [*attrs, "_here"],
                          offset=-1, prefix="_prev_", hot=hot)
    first = F.col("_prev__here").isNull()
    changed = F.lit(False)
    for a in attrs:
        changed = changed | ~F.col(a).eqNullSafe(F.col(f"_prev_{a}"))
    # The very first observation of a key has no previous row at all.
    starts = (with_prev.filter(changed | first)
              .select(*key, *attrs, *tie, F.col(at).alias("effective_from")))
    versions = neighbour(starts, ["effective_from", *tie], key, ["effective_from"],
                         offset=1, prefix="_next_", hot=hot)
    end = F.coalesce(F.col("_next_effective_from"), F.lit(open_end).cast(
        versions.schema["effective_from"].dataType))
    return versions.select(*key, *attrs, "effective_from", end.alias("effective_to"),
                           F.col("_next_effective_from").isNull().alias("is_current"))


def scd2_apply(history: DataFrame, log: DataFrame, batch: DataFrame, key: Sequence[str], attrs: Sequence[str], at: str,
               tie: Sequence[str] = (), open_end: str = OPEN_END) -> DataFrame:
    """``history`` (of ``scd2`` over ``log``) after a batch of observations, late ones included.

    Only the keys in the batch are rebuilt, from their logged observations and
    the batch; the versions of all other keys are taken as they are.  So a late
    observation splits a version, equal neighbours merge, and the result is that
    of a rebuild from all observations, in whatever order batches come; a batch
    that is applied again changes nothing.  The caller appends the batch to the
    log.  A NULL key is a key.
    """
    key = list(key)
    cols = [*key, *attrs, *tie, at]
    touched = batch.select(F.struct(*key).alias("_touched")).distinct()     # a struct is never NULL

    def of(df: DataFrame, how: str) -> DataFrame:
        return df.withColumn("_touched", F.struct(*key)).join(touched, "_touched", how).drop("_touched")

    seen = of(log.select(*cols), "left_semi").unionByName(batch.select(*cols)).distinct()
    rebuilt = scd2(seen, key, attrs, at, tie, open_end)
    return of(history.select(*rebuilt.columns), "left_anti").unionByName(rebuilt)


def asof_join(left: DataFrame, right: DataFrame, key: Sequence[str], left_at: str,
              right_at: str, right_cols: Sequence[str], tie: Sequence[str] = (),
              prefix: str = "", partitions: int | None = None) -> DataFrame:
    """Left rows with ``right_cols`` of the latest right row whose
    ``right_at`` <= ``left_at`` (same key); NULLs when there is none.
    Ties on ``right_at`` go to the greatest ``tie`` values."""
    key = list(key)
    payload = F.struct(F.col(right_at).alias("_at"), *[F.col(t).alias(f"_tie_{t}") for t in tie],
                       *[F.col(c) for c in right_cols])
    r = right.select(*key, F.col(right_at).alias("_t"), F.lit(0).alias("_side"),
                     payload.alias("_r"))
    l_struct = F.struct(*[F.col(c) for c in left.columns])
    l_type = left.select(l_struct.alias("s")).schema["s"].dataType
    r_type = r.schema["_r"].dataType
    lft = left.select(*[F.col(k) for k in key], F.col(left_at).alias("_t"), F.lit(1).alias("_side"),
                      l_struct.alias("_l"), F.lit(None).cast(r_type).alias("_r"))
    both = lft.unionByName(r.withColumn("_l", F.lit(None).cast(l_type)))
    # Right rows sort before left rows at equal time, so "<=" holds.
    scanned = running(both, ["_t", "_side"], key, F.col("_r"), "_m", "max", partitions)
    out = scanned.filter(F.col("_side") == 1)
    return out.select("_l.*", *[F.col(f"_m.{c}").alias(f"{prefix}{c}") for c in right_cols])


def compare_outputs(old: DataFrame, new: DataFrame,
                    normalise: dict[str, Column] | None = None) -> DataFrame:
    if normalise:
        old, new = old.withColumns(normalise), new.withColumns(normalise)
    return outputs_equal(old, new)
