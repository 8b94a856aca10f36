"""Keyed comparison against a plain one in Python."""

import random

import pytest
from pyspark.sql import functions as F

from strata.errors import CheckFailed
from strata.operators.compare import compare_keyed, difference_counts

SCHEMA = "k string, j int, x double, y string"


def brute(old, new):
    def by_key(rows):
        out = {}
        for r in rows:
            out.setdefault(r[:2], []).append(r[2:])
        return out
    a, b, out = by_key(old), by_key(new), set()
    for k in a.keys() | b.keys():
        if k not in b or k not in a:
            out.add((*k, "missing" if k not in b else "extra", None))
        elif len(a[k]) > 1 or len(b[k]) > 1:
            if sorted(a[k], key=str) != sorted(b[k], key=str):
                out.add((*k, "repeated", None))
        else:
            out |= {(*k, "changed", c) for c, v, w in zip("xy", a[k][0], b[k][0]) if v != w}
    return {tuple(None if v is None else str(v) for v in r) for r in out}


@pytest.mark.parametrize("seed", range(3))
def test_every_difference_is_found(spark, seed):
    r = random.Random(seed)
    old = [(r.choice(["a", "b", None]), i, r.choice([1.5, None, 2.0]), r.choice(["p", "q", None])) for i in range(300)]
    new = []
    for row in old:
        u = r.random()
        if u < 0.03:
            continue
        if u < 0.06:
            row = (*row[:2], 9.0, row[3])
        elif u < 0.09:
            row = (*row[:3], "other")
        elif u < 0.11:
            new.append(row)
        new.append(row)
    new += [("z", i, None, None) for i in range(4)]
    old += [("w", 1, 1.0, "p"), ("w", 1, 2.0, "p")]
    new += [("w", 1, 2.0, "p"), ("w", 1, 1.0, "p")]           # repeated on both sides alike
    got = compare_keyed(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA).repartition(3), ["k", "j"])
    assert {(g["k"], g["j"], g["kind"], g["column"]) for g in got.collect()} == brute(old, new)
    assert difference_counts(got).agg(F.sum("n")).first()[0] == got.count()


def test_equal_outputs_normalising_and_columns(spark):
    a = spark.range(1000).select("id", (F.col("id") / 3).alias("v"))
    assert compare_keyed(a, a.repartition(7), ["id"]).count() == 0
    b = a.withColumn("v", F.col("v") + 1e-9)
    assert compare_keyed(a, b, ["id"]).count() == 999 + 1
    assert compare_keyed(a, b, ["id"], {"v": F.round("v", 3)}).count() == 0
    with pytest.raises(CheckFailed):
        compare_keyed(a, a.withColumn("w", F.lit(1)), ["id"])
    empty = a.limit(0)
    assert compare_keyed(empty, empty, ["id"]).count() == 0
    assert {r["kind"] for r in compare_keyed(empty, a, ["id"]).collect()} == {"extra"}


def test_only_rows_of_differing_ranges_are_shuffled_by_key(spark):
    a = spark.range(5000).select("id", (F.col("id") * 2).alias("v"))
    b = a.withColumn("v", F.when(F.col("id") == 77, -1).otherwise(F.col("v")))
    out = compare_keyed(a, b, ["id"])
    assert [tuple(r) for r in out.collect()] == [("77", "changed", "v", "154", "-1")]
