"""Compaction by file: partition folders and large files stay, empty files count, readers switch once."""

import os

from pyspark.sql import functions as F

from strata.operators.maintain import compact_small, folder_stats
from strata.sources.layout import Layout, read_manifest
from strata.sources.partitioned import merge_rollup
from strata.sources.publish import Publication


def files(root):
    return {os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if f.startswith("part-")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_small_files_of_partitions_are_packed(spark, tmp_path):
    lake = Layout(root=str(tmp_path))
    df = spark.range(4000).select(F.col("id"), F.concat(F.lit("x y/"), F.col("id") % 2).alias("p"), F.repeat(F.lit("t"), 5).alias("s"))
    big = spark.range(30_000).select((F.col("id") + 10_000).alias("id"), F.lit("x y/0").alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("s"))
    p = Publication(spark, lake)
    p.write(df.repartition(6).unionByName(big.coalesce(1)), "silver", "t", partition_by=("p",))
    p.publish()
    before, held = files(tmp_path), rows(lake.read(spark, "silver", "t").select("id", "p", "s"))
    target = 1_000_000
    large = {f for f in before if os.path.getsize(os.path.join(tmp_path, f)) >= target / 2}
    assert len(large) == 1
    report = compact_small(spark, lake, "silver", "t", target)
    assert report["files_before"] == len(before) and report["files_after"] == 3 and report["rows"] == 4000 and len(report["folders"]) == 2
    assert rows(lake.read(spark, "silver", "t").select("id", "p", "s")) == held
    entry = read_manifest(spark, lake)[1]["silver.t"]
    assert {os.path.basename(f) for f in large} <= {f for names in entry["files"].values() for f in names}
    assert before <= files(tmp_path)                            # old files stay for readers that have begun
    assert compact_small(spark, lake, "silver", "t", target)["folders"] == []


def test_table_without_partitions_and_empty_files(spark, tmp_path):
    lake = Layout(root=str(tmp_path))
    p = Publication(spark, lake)
    p.write(spark.range(100).repartition(5).where("id % 10 = 3").unionByName(spark.range(7)), "silver", "t")
    p.publish()
    stats = folder_stats(spark, str(tmp_path / "versions")).collect()
    assert sum(r["files"] for r in stats) == len(files(tmp_path)) and all(r["small_files"] == r["files"] for r in stats)
    held = rows(lake.read(spark, "silver", "t"))
    assert compact_small(spark, lake, "silver", "t")["files_after"] == 1
    assert rows(lake.read(spark, "silver", "t")) == held


def test_compacted_roll_up_takes_further_batches(spark, tmp_path):
    lake = Layout(root=str(tmp_path))
    batch = lambda a, b: spark.range(a, b).select((F.col("id") % 3).cast("string").alias("p"), (F.col("id") % 5).alias("u"), F.lit(1).alias("v")).repartition(4)
    put = lambda df, name: merge_rollup(spark, lake, "silver", "c", df, name, ["p", "u"], "v", "p")
    put(batch(0, 60), "a")
    compact_small(spark, lake, "silver", "c")
    put(batch(60, 90), "b")
    assert not put(batch(60, 90), "b")["applied"]
    got = lake.read(spark, "silver", "c").groupBy("p").agg(F.sum("event_count").alias("n"))
    assert rows(got) == [("0", 30), ("1", 30), ("2", 30)]
