"""Batches applied to stored tables, rejected input lines, and profiles merged per load."""

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from strata.errors import CheckFailed
from strata.operators.history import scd2, scd2_apply
from strata.operators.profile import merge_profiles, profile_columns, profile_report
from strata.operators.rollup import rollup_events
from strata.sources.ingest import land_csv, read_raw_csv, scan_csv
from strata.sources.layout import Layout, read_manifest
from strata.sources.partitioned import merge_rollup
from strata.sources.publish import vacuum


def same(a, b):
    assert sorted(map(tuple, a.select(*b.columns).collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


# -- scd2 ----------------------------------------------------------------------

def observations(spark, seed):
    r = random.Random(seed)
    rows = [(r.choice(["a", "b", "c", None]), r.choice(["x", "y", None]), r.randrange(40), i) for i in range(60)]
    return spark.createDataFrame(rows, "k string, v string, t int, i int")


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_history_is_that_of_a_rebuild_in_any_order(spark, order):
    obs = observations(spark, 4)
    args = (["k"], ["v"], "t", ["i"], "1000")
    batches = [obs.where(F.col("i") % 3 == b) for b in order]
    log, history = batches[0], scd2(batches[0], *args)
    for b in batches[1:]:
        history = scd2_apply(history, log, b, *args)
        log = log.unionByName(b)
    same(history, scd2(obs, *args))


def test_late_rows_split_and_merge_and_repeats_change_nothing(spark):
    kind = "k string, v string, t int"
    log = spark.createDataFrame([("a", "x", 1), ("a", "x", 9), ("b", "p", 2)], kind)
    args = (["k"], ["v"], "t", (), "99")
    history = scd2(log, *args)
    late = spark.createDataFrame([("a", "y", 5)], kind)
    split = scd2_apply(history, log, late, *args)
    assert sorted(map(tuple, split.collect())) == [("a", "x", 1, 5, False), ("a", "x", 9, 99, True), ("a", "y", 5, 9, False), ("b", "p", 2, 99, True)]
    same(scd2_apply(split, log.union(late), late, *args), split)
    back = spark.createDataFrame([("a", "x", 0)], kind)
    merged = scd2_apply(history, log, back, *args)
    assert sorted(map(tuple, merged.collect())) == [("a", "x", 0, 99, True), ("b", "p", 2, 99, True)]
    same(scd2_apply(history, log, log.limit(0), *args), history)


# -- incremental roll-up --------------------------------------------------------

def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.startswith("part-")}


def test_only_touched_partitions_are_written(spark, tmp_path):
    lake = Layout(root=str(tmp_path))
    df = spark.createDataFrame([("p1", "u", 1), ("p1", "u", 2), ("p2", "u", 3), (None, "u", 4), ("007", "w", None)], "p string, u string, v int")
    put = lambda batch, name: merge_rollup(spark, lake, "silver", "clicks", batch, name, ["p", "u"], "v", "p")
    assert put(df, "one") == {"applied": True, "events": 5, "partitions": ["p=007", "p=__HIVE_DEFAULT_PARTITION__", "p=p1", "p=p2"]}
    before = files(tmp_path)
    more = spark.createDataFrame([("p2", "u", 10), ("p2", "z", 1), (None, "u", 1)], "p string, u string, v int")
    assert put(more, "two")["partitions"] == ["p=__HIVE_DEFAULT_PARTITION__", "p=p2"]
    whole = rollup_events(df.union(more), ["p", "u"], "v")
    same(lake.read(spark, "silver", "clicks"), whole)
    after = files(tmp_path)
    assert before.items() <= after.items()
    assert not any("/p=p1/" in f or "/p=007/" in f for f in after.keys() - before.keys())
    number = read_manifest(spark, lake)[0]
    assert put(more, "two") == {"applied": False, "events": 0, "partitions": []}
    assert read_manifest(spark, lake)[0] == number and files(tmp_path) == after
    same(lake.read(spark, "silver", "clicks"), whole)
    assert put(more.limit(0), "empty")["applied"]
    same(lake.read(spark, "silver", "clicks"), whole)
    gone = vacuum(spark, lake, keep=1)
    assert len(gone) == 2 and all("p=p2" in g or "HIVE" in g for g in gone)
    same(lake.read(spark, "silver", "clicks"), whole)


# -- rejected lines ---------------------------------------------------------------

def test_lines_are_landed_or_rejected_with_file_and_reason(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text('a,b,c\n1,x,y\n2,x\n3,x,y,z\n4,"un,closed\n5,"x,1",y\n\n6,,""\n')
    (raw / "b.csv").write_text('a,b,c\r\n7,"say \\"hi\\"",z\r\n8,x,"open\r\n9,"",q\r\n')
    got = {r["record"]: (os.path.basename(r["file"]), r["reason"]) for r in scan_csv(spark, str(raw), ["a", "b", "c"]).collect()}
    assert {k: v for k, v in got.items() if v[1]} == {
        "2,x": ("a.csv", "short row"), "3,x,y,z": ("a.csv", "long row"), '4,"un,closed': ("a.csv", "unclosed quote"), '8,x,"open': ("b.csv", "unclosed quote")}
    lake = Layout(root=str(tmp_path / "lake"))
    assert land_csv(spark, str(raw), ["a", "b", "c"], lake, "raw", "t") == {"read": 9, "landed": 5, "rejected": 4}
    rows = {tuple(r)[:3] for r in lake.read(spark, "raw", "t").collect()}
    assert rows == {("1", "x", "y"), ("5", "x,1", "y"), ("6", None, None), ("7", 'say "hi"', "z"), ("9", None, "q")}
    assert lake.read(spark, "raw", "t_rejects").columns == ["file", "reason", "record", "_ingested_at"]
    # good files read as by the plain reader
    good = tmp_path / "good"
    good.mkdir()
    (good / "g.csv").write_text('a,b,c\n1,x,y\n5,"x,1",y\n6,,""\n7,"say \\"hi\\"",z\n')
    same(scan_csv(spark, str(good), ["a", "b", "c"]).select("a", "b", "c"), read_raw_csv(spark, str(good), ["a", "b", "c"]))


def test_nothing_to_land(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text("a,b\n")
    lake = Layout(root=str(tmp_path / "lake"))
    assert land_csv(spark, str(raw), ["a", "b"], lake, "raw", "t") == {"read": 0, "landed": 0, "rejected": 0}
    assert issubclass(CheckFailed, Exception)


# -- profiles -----------------------------------------------------------------------

def test_profile_scans_once_and_merges(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(20_000).select(F.col("id"), (F.col("id") % 997 / 3).alias("v"), F.concat(F.lit("s"), F.least(F.col("id") % 50, F.lit(3))).alias("s"),
                                    F.when(F.col("id") % 4 == 0, " ").when(F.col("id") % 4 == 1, "t").alias("b"), F.lit(None).cast("int").alias("none"))
    df.write.parquet(path)
    whole = profile_columns(spark.read.parquet(path))
    assert whole._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    parts = [profile_columns(df.where(F.col("id") % 3 == i)) for i in range(3)]
    merged = merge_profiles(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    for p in (whole, merged):
        got = {r["column"]: r for r in profile_report(p).collect()}
        assert (got["id"]["rows"], got["id"]["least"], got["id"]["most"], got["b"]["nulls"], got["b"]["blanks"]) == (20_000, 0, 19_999, 10_000, 5_000)
        assert (got["none"]["nulls"], got["none"]["distinct"], got["s"]["first_text"], got["s"]["last_text"]) == (20_000, 0, "s0", "s3")
        for c, n in (("id", 20_000), ("v", 997), ("s", 4)):
            assert abs(got[c]["distinct"] - n) <= max(0.05 * n, 0)
        assert abs(got["id"]["q50"] - 10_000) <= 0.03 * 20_000 and abs(got["v"]["q25"] - 997 / 12) <= 0.03 * 997 / 3
        assert [tuple(x) for x in got["s"]["frequent"]][0] == ("s3", 18_800)
    assert {r["rows"] for r in profile_report(profile_columns(df.limit(0))).collect()} == {0}
