import os

from pyspark.sql import functions as F

from strata.plans import medallion
from strata.plans.schemas import RAW_COLUMNS
from strata.sources.ingest import land, read_raw_csv
from strata.sources.layout import Layout, write_observed
from tests.fixtures import raw_rows


def _write_csv(path, header, rows):
    os.makedirs(path, exist_ok=True)

    def q(v):
        if v is None:
            return ""
        v = str(v).replace("\\", "\\\\").replace('"', '\\"')
        return f'"{v}"' if ("," in v or '"' in v or v == "") else v
    with open(os.path.join(path, "part-0.csv"), "w") as fh:
        fh.write(",".join(header) + "\n")
        for r in rows:
            fh.write(",".join(q(v) for v in r) + "\n")


def test_csv_dialect_and_blank(spark, tmp_root):
    path = os.path.join(tmp_root, "t")
    _write_csv(path, ["a", "b"], [("x, y", 'say "hi"'), ("", None), ("plain", "1")])
    df = read_raw_csv(spark, path, ["a", "b"])
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "string"]
    rows = sorted((r.a or "", r.b or "") for r in df.collect())
    assert rows == [("", ""), ("plain", "1"), ("x, y", 'say "hi"')]


def test_ingest_csv_into_bronze_and_append_duplicates(spark, tmp_root):
    rows = raw_rows()
    raw_dir = os.path.join(tmp_root, "raw")
    for t, cols in RAW_COLUMNS.items():
        _write_csv(os.path.join(raw_dir, t), cols, rows[t])
    lake = Layout(root=os.path.join(tmp_root, "lake"))
    counts = medallion.ingest_csv(spark, raw_dir, lake)
    assert counts == {t: len(rows[t]) for t in RAW_COLUMNS}
    info = lake.read(spark, "bronze", "studentInfo")
    assert "_ingested_at" in info.columns
    assert info.select("_ingested_at").distinct().count() == 1
    # Landing appends: landing the same files twice doubles the rows.
    courses = read_raw_csv(spark, os.path.join(raw_dir, "courses"), RAW_COLUMNS["courses"])
    land(courses, lake, "landing", "courses")
    land(courses, lake, "landing", "courses")
    assert lake.read(spark, "landing", "courses").count() == 2 * len(rows["courses"])


def test_observed_write_counts_without_rescan(spark, tmp_root):
    df = spark.range(100).withColumn("x", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id")))
    out = write_observed(df, lambda d: d.write.parquet(os.path.join(tmp_root, "o")), ("x",))
    assert out == {"rows": 100, "null_x": 10}


def test_catalog_layout(spark):
    lake = Layout()
    lake.write(spark.range(5), "silver", "strata_catalog_probe")
    assert lake.read(spark, "silver", "strata_catalog_probe").count() == 5
