"""Filter replacement, masks by role and the co-located star."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from strata.plans import medallion
from strata.plans.reports import student_star
from strata.plans.star import ColumnPolicy
from tests.test_skew import plain_shuffles  # noqa: F401

SECURITY = [("a@x.org", "North"), ("b@x.org", "North")]


@pytest.fixture(scope="module")
def gold(spark):
    n = 90
    students = spark.range(n).select(F.col("id").alias("student_sk"), F.concat(F.lit("s"), "id").alias("id_student"), F.when(F.col("id") % 3 == 0, "South").otherwise("North").alias("region"),
                                     F.concat(F.lit("band"), F.col("id") % 4).alias("imd_band"), F.lit("F").alias("gender"))
    modules = spark.range(2).select(F.col("id").alias("module_sk"), F.concat(F.lit("m"), "id").alias("code_module"), F.lit("p").alias("code_presentation"), F.lit(1).alias("module_presentation_length"))
    tests = spark.range(3).select(F.col("id").alias("assessment_sk"), F.concat(F.lit("t"), "id").alias("assessment_type"), (F.col("id") * 1.0).alias("weight"), F.lit("m0").alias("code_module"))
    scores = spark.range(3 * n).select((F.col("id") % n).alias("student_sk"), (F.col("id") % 3).alias("assessment_sk"), (F.col("id") % 5 * 20).cast("int").alias("score"),
                                       F.lit(1).alias("date_submitted"))
    clicks = spark.range(2 * n).select((F.col("id") % n).alias("student_sk"), (F.col("id") % 2).alias("module_sk"), F.col("id").alias("total_clicks"), F.lit(1).cast("bigint").alias("event_count"))
    reg = spark.range(n).select(F.col("id").alias("student_sk"), (F.col("id") % 2).alias("module_sk"), (F.col("id") % 5 == 0).alias("is_withdrawn"),
                                F.lit(1).alias("date_registration"), F.lit(2).alias("date_unregistration"))
    return {"dim_student": students, "dim_module": modules, "dim_assessment": tests, "fact_assessment": scores, "fact_vle": clicks, "fact_registration": reg,
            "security_region_map": spark.createDataFrame(SECURITY, "user_email string, region string")}


@pytest.fixture(scope="module")
def star(gold):
    return student_star(gold, digits=None)


def test_numerator_is_the_same_in_every_slice(star):
    s = star.unsecured()
    rows = s.query(["passed", "total_assessments", "pass_rate"], ["fact_assessment.score"]).collect()
    assert len(rows) == 5 and {r["passed"] for r in rows} == {162} and all(r["pass_rate"] == 162 / r["total_assessments"] for r in rows)
    both = s.query(["passed", "withdrawal_count"], ["dim_student.region", "fact_assessment.score"]).collect()
    per_region = {r["region"]: r["passed"] for r in s.query(["passed"], ["dim_student.region"]).collect()}
    assert all(r["passed"] == per_region[r["region"]] for r in both) and sum(per_region.values()) == 162
    flag = s.query(["withdrawal_count", "total_registrations"], ["fact_registration.is_withdrawn"]).collect()
    assert {r["is_withdrawn"]: (r["withdrawal_count"], r["total_registrations"]) for r in flag} == {True: (18, 18), False: (18, 72)}
    assert s.query(["pass_rate"], []).first()[0] == 162 / 270


def governed(star, spark, grants, members, masks):
    return replace(star, policy=ColumnPolicy(masks, spark.createDataFrame(grants, "role string, column string"), spark.createDataFrame(members, "user_email string, role string")))


def test_masks_follow_roles_in_slices_needs_and_measures(spark, star):
    masks = {"dim_student.imd_band": "masked", "dim_assessment.weight": None}
    g = governed(star, spark, [("analyst", "dim_student.imd_band"), ("other", "dim_assessment.weight")], [("A@x.org", "analyst"), ("c@x.org", "other")], masks)
    seen = g.query(["total_students"], ["dim_student.imd_band"], principal="a@x.org").collect()
    assert sorted(r["imd_band"] for r in seen) == ["band0", "band1", "band2", "band3"] and sum(r["total_students"] for r in seen) == 60
    hidden = g.query(["total_students"], ["dim_student.imd_band"], principal="b@x.org").collect()
    assert [tuple(r) for r in hidden] == [("masked", 60)]
    # a need (the weight) of a measure is masked too
    assert g.query(["weighted_score"], [], principal="a@x.org").first()[0] is None
    assert star.query(["weighted_score"], [], principal="a@x.org").first()[0] is not None
    # row security looks at the true values
    region = governed(star, spark, [("nobody", "dim_student.region")], [], {"dim_student.region": "masked"})
    assert [tuple(r) for r in region.query(["total_students"], ["dim_student.region"], principal="b@x.org").collect()] == [("masked", 60)]
    assert len(g.unsecured().query(["total_students"], ["dim_student.imd_band"]).collect()) == 4
    with pytest.raises(ValueError):
        governed(star, spark, [("r", "dim_student.student_sk")], [], {"dim_student.student_sk": None}).query(["total_students"], [], principal="a@x.org")


def test_colocated_tables_join_without_a_shuffle(plain_shuffles, gold, star):  # noqa: F811
    spark = plain_shuffles
    tables = medallion.store_colocated(spark, gold, "colocated_probe", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1300")       # the mapping is broadcast, facts and dimension are not
    stored = student_star(tables, digits=None)
    out = stored.query(["withdrawal_rate", "total_students"], ["dim_student.imd_band"], principal="a@x.org")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [student_sk" in plan and "hashpartitioning(student_sk" not in plan
    want = star.query(["withdrawal_rate", "total_students"], ["dim_student.imd_band"], principal="a@x.org")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))


def test_lines_meet_their_orders_once_and_in_few_numbers(spark, tmp_path):
    from datetime import datetime
    from strata.plans import analog_star
    day = datetime(1995, 3, 1)
    lines = [(1, 10, 100, 1, 3.0), (1, 11, 100, 7, 4.0), (2, None, 101, None, 5.5), (9, 12, None, 2, 1.0), (None, 13, 102, 7, None), (2, 14, 103, 3, None)]
    tables = {"lineitem": spark.createDataFrame([(*x, day) for x in lines], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz"),
              "orders": spark.createDataFrame([(1, 5, "F", "1-URGENT", day), (2, None, "O", None, day), (None, 7, "O", "x", day)],
                                              "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp_ntz"),
              "customer": spark.createDataFrame([], "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"),
              "nation": spark.createDataFrame([], "n_nationkey int, n_name string, n_regionkey int"), "region": spark.createDataFrame([], "r_regionkey int, r_name string"),
              "part": spark.createDataFrame([], "p_partkey long, p_brand string, p_type string, p_size int"), "supplier": spark.createDataFrame([], "s_suppkey long")}
    for t, df in tables.items():
        df.write.parquet(f"{tmp_path}/{t}.parquet")
    analog_star.order_lines(spark, str(tmp_path)).write.parquet(f"{tmp_path}/lines")
    raw = analog_star.raw_tables(spark, str(tmp_path), spark.read.parquet(f"{tmp_path}/lines"))
    for t in ("studentAssessment", "studentVle"):
        assert "Join" not in raw[t]._jdf.queryExecution().optimizedPlan().toString()
    got = {tuple(r[c] for c in ("id_assessment", "id_student", "score", "is_banked")) for r in raw["studentAssessment"].collect()}
    assert got == {("10", "5", "6", "0"), ("11", "5", "", "0"), (None, None, "11", "0"), ("12", None, "2", "0"), ("13", None, "", "0"), ("14", None, None, "0")}
    got = {tuple(r[c] for c in ("code_module", "code_presentation", "id_student", "id_site", "sum_click")) for r in raw["studentVle"].collect()}
    assert got == {("1-URGENT", "1995", "5", "100", "3"), ("1-URGENT", "1995", "5", "100", "4"), (None, "1995", None, "101", "5"), (None, None, None, None, "1"),
                   (None, None, None, "102", None), (None, "1995", None, "103", None)}
