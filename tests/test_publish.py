"""New versions become visible together, and only after their checks."""

import os

import pytest
from pyspark.sql import functions as F

from strata.errors import CheckFailed
from strata.plans import medallion
from strata.plans.schemas import RAW_COLUMNS
from strata.sources.layout import Layout, read_manifest
from strata.sources.publish import Publication, vacuum
from tests.fixtures import SECURITY_ROWS, raw_tables


def put(spark, layout, value):
    p = Publication(spark, layout)
    p.write(spark.range(value).toDF("a"), "gold", "t")
    p.write(spark.range(1).select(F.lit(value).alias("b")), "gold", "u")
    return p


def seen(spark, layout):
    return layout.read(spark, "gold", "t").count(), layout.read(spark, "gold", "u").first()["b"]


def test_staged_tables_are_invisible_until_published(spark, tmp_path):
    lake = Layout(root=str(tmp_path))
    assert put(spark, lake, 3).publish() == 1
    second = put(spark, lake, 5)
    assert second.read("gold", "t").count() == 5 and seen(spark, lake) == (3, 3)
    assert second.publish() == 2 and seen(spark, lake) == (5, 5)
    with pytest.raises(ValueError):                 # a published table is not overwritten in place
        lake.write(spark.range(1), "gold", "t")


def test_second_of_two_jobs_fails(spark, tmp_path):
    lake = Layout(root=str(tmp_path))
    a, b = put(spark, lake, 2), put(spark, lake, 4)
    a.publish()
    with pytest.raises(CheckFailed):
        b.publish()
    assert seen(spark, lake) == (2, 2)


def test_incomplete_manifest_is_passed_over(spark, tmp_path):
    lake = Layout(root=str(tmp_path))
    put(spark, lake, 2).publish()
    with open(os.path.join(tmp_path, "manifest", "0000000002.json"), "w") as fh:
        fh.write('{"gold.t": "versions/')
    assert read_manifest(spark, lake)[0] == 1 and seen(spark, lake) == (2, 2)


def test_vacuum_keeps_what_recent_manifests_name(spark, tmp_path):
    lake = Layout(root=str(tmp_path))
    for v in (2, 3, 4):
        put(spark, lake, v).publish()
    staged = put(spark, lake, 9)
    gone = vacuum(spark, lake, keep=2)
    assert len(gone) == 2 and not any(os.path.exists(os.path.join(tmp_path, f)) for f in gone)
    assert seen(spark, lake) == (4, 4)
    staged.publish()
    assert seen(spark, lake) == (9, 9)


def test_failed_check_leaves_the_old_gold(spark, tmp_path):
    lake = Layout(root=str(tmp_path / "lake"))
    clean, dirty = Layout(root=str(tmp_path / "clean")), Layout(root=str(tmp_path / "dirty"))
    for src, flag in ((clean, False), (dirty, True)):
        for t, df in raw_tables(spark, dirty=flag).items():
            src.write(df, "raw", t)
    report = medallion.run_pipeline(spark, lake, SECURITY_ROWS, source=clean)
    assert report["manifest"] == 1
    before = {t: df.collect() for t, df in medallion.read_gold(spark, lake).items()}
    silver = lake.read(spark, "silver", "studentAssessment").count()
    with pytest.raises(CheckFailed):
        medallion.run_pipeline(spark, lake, SECURITY_ROWS, source=dirty)
    assert read_manifest(spark, lake)[0] == 1
    for t, df in medallion.read_gold(spark, lake).items():
        assert sorted(map(tuple, df.collect()), key=str) == sorted(map(tuple, before[t]), key=str)
    assert lake.read(spark, "silver", "studentAssessment").count() == silver
    assert set(RAW_COLUMNS) <= set(os.listdir(tmp_path / "lake" / "bronze"))
