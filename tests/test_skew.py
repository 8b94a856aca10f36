"""A key holding a third of all rows: results stay exact on every path,
and the distributed numbering spreads the hot group over several tasks."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.dedup import keep_first
from strata.operators.sequence import number_rows
from strata.operators.stats import exact_quantiles


def hot_frame(spark, n=3000):
    # key 0 holds one third of the rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("k"),
        F.col("id"), (F.col("id") * 7919 % 1009).cast("double").alias("v"))


def test_hot_key_numbering_is_exact_and_spread(spark):
    df = hot_frame(spark)
    got = number_rows(df, ["v", "id"], ["k"], "rn", partitions=8)
    want = df.withColumn("rn", F.row_number().over(
        Window.partitionBy("k").orderBy("v", "id")).cast("bigint"))
    assert got.select(*want.columns).exceptAll(want).count() == 0
    # The range partitioning splits the hot key over several partitions.
    spread = (df.repartitionByRange(8, "k", "v", "id")
              .filter(F.col("k") == 0)
              .select(F.spark_partition_id().alias("p")).distinct().count())
    assert spread > 1


def test_hot_key_quantiles_and_keep_first(spark):
    df = hot_frame(spark)
    q = {r.k: r.q50 for r in exact_quantiles(df, "v", [0.5], ["k"], partitions=8).collect()}
    hot = sorted(r.v for r in df.filter("k = 0").collect())
    m = len(hot)
    assert q[0] == (hot[(m - 1) // 2] + hot[m // 2]) / 2
    first = {r.k: r.id for r in keep_first(df, "k", ["v", "id"]).collect()}
    assert first[0] == df.filter("k = 0").orderBy("v", "id").first().id


def test_hot_key_lead_distributed(spark):
    from strata.operators.sequence import neighbour
    df = hot_frame(spark, 900)
    got = neighbour(df, ["v", "id"], ["k"], ["id"], 1, "next_", partitions=8)
    want = df.withColumn("next_id", F.lead("id").over(Window.partitionBy("k").orderBy("v", "id")))
    assert got.select(*want.columns).exceptAll(want).count() == 0


def test_asof_join_matches_brute_force(spark):
    from strata.operators.history import asof_join
    left = spark.createDataFrame(
        [(1, "a", 5), (2, "a", 10), (3, "a", 1), (4, "b", 7), (5, None, 3), (6, "c", 4)],
        "id int, k string, t int")
    right = spark.createDataFrame(
        [("a", 2, "v1"), ("a", 5, "v2"), ("a", 9, "v3"), ("b", 8, "w1"), (None, 1, "n1")],
        "k string, t int, v string")
    got = {r.id: r.v for r in asof_join(left, right, ["k"], "t", "t", ["v"], partitions=4).collect()}
    assert got == {1: "v2", 2: "v3", 3: None, 4: None, 5: "n1", 6: None}


def test_asof_hot_key_distributed(spark):
    from strata.operators.history import asof_join
    df = hot_frame(spark, 1200)
    right = df.filter(F.col("id") % 5 == 0).select("k", F.col("v").alias("rv"),
                                                   F.col("id").alias("rid"))
    got = asof_join(df, right, ["k"], "v", "rv", ["rid"], tie=["rid"], partitions=8).select("id", "rid")
    # brute force on the driver for this small fixture
    rows = [(r.k, r.v, r.id) for r in df.collect()]
    rights = [(k, v, i) for k, v, i in rows if i % 5 == 0]
    want = {}
    for k, v, i in rows:
        cands = [(rv, rid) for rk, rv, rid in rights if rk == k and rv <= v]
        want[i] = max(cands)[1] if cands else None
    assert {r.id: r.rid for r in got.collect()} == want


def test_number_rows_null_group_distributed(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, v int")
    got = {r.v: (r.g, r.rn) for r in
           number_rows(df, ["v"], ["g"], "rn", partitions=2).collect()}
    assert got == {1: (None, 1), 2: (None, 2), 3: ("a", 1)}


def tasks_of(df):
    """Rows of each task of a join's output."""
    return [r["n"] for r in df.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()]


@pytest.fixture()
def plain_shuffles(spark):
    """No merging of partitions and no broadcasts: what a task gets is what the join's keys give it."""
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def crowded(spark, n=24_000):
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("k"),
                                 (F.col("id") % 5).alias("m"), F.col("id").alias("v"))


def balanced(df, rows):
    sizes = tasks_of(df)
    assert sum(sizes) == rows and max(sizes) <= 2 * rows / 8


def test_hot_keys_are_found(spark):
    from strata.operators.skew import hot_keys
    df = crowded(spark)
    hot = hot_keys(df, ["k"], partitions=8)
    assert list(hot) == [spark.range(1).select(F.xxhash64(F.lit(0).cast("bigint")).alias("h")).first()["h"]]
    assert hot_keys(df.limit(0), ["k"]) == {} and hot_keys(spark.range(1000).withColumnRenamed("id", "k"), ["k"], 8) == {}
    assert hot_keys(df.withColumn("k", F.when(F.col("k") != 0, F.col("k"))), ["k"], 8)       # a NULL key can be hot


def test_preaggregate_join_spreads_a_hot_key(plain_shuffles):
    from strata.operators.joins import preaggregate_join
    df = crowded(plain_shuffles)
    out = preaggregate_join(df, df.withColumnRenamed("v", "w"), ["k"], "w", "total")
    balanced(out, 24_000)
    plain = df.join(df.groupBy("k").agg(F.sum("v").alias("total")), "k", "left").select(*out.columns)
    assert out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()


def test_three_key_join_and_engagement_spread_a_hot_key(plain_shuffles):
    from strata.operators.skew import salted_lookup
    from strata.plans.reports import engagement_outcome
    df = crowded(plain_shuffles).withColumn("d", F.lit("x")).withColumn("m", F.lit(1))
    per = df.groupBy("k", "m", "d").agg(F.count(F.lit(1)).alias("n"))
    balanced(salted_lookup(df, per, ["k", "m", "d"]), 24_000)
    reg = df.select(F.col("k").alias("student_sk"), F.col("m").alias("module_sk"), F.lit(True).alias("is_withdrawn"))
    clicks = df.select(F.col("k").alias("student_sk"), F.col("m").alias("module_sk"), F.col("v").alias("total_clicks"))
    out = engagement_outcome({"fact_registration": reg, "fact_vle": clicks})
    balanced(out, 24_000)


def test_legacy_summary_spreads_a_hot_student(plain_shuffles):
    from strata.plans.legacy import KEY3, legacy_summary
    info = crowded(plain_shuffles).select(F.col("k").cast("string").alias("id_student"), F.lit("m").alias("code_module"), F.col("v").cast("string").alias("code_presentation"),
                                          *[F.lit("a").alias(c) for c in ("gender", "region", "highest_education", "age_band", "imd_band")])
    reg = info.select(*KEY3, F.lit("5").alias("date_registration"), F.lit("").alias("date_unregistration"))
    scores = info.select("id_student", F.lit("50").alias("score"))
    clicks = info.select("id_student", F.lit("2").alias("sum_click"))
    out = legacy_summary(info, reg, scores, clicks)
    balanced(out, 24_000)
    assert out.filter("id_student = '0'").select("total_clicks").distinct().collect()[0][0] == 16_000


def test_salted_rollup_equals_plain_aggregates(spark):
    from strata.operators.skew import salted_rollup
    df = crowded(spark, 6000).withColumn("k", F.when(F.col("k") != 5, F.col("k")))           # with a NULL key
    spec = {"n": ("count", "v"), "s": ("sum", "v"), "a": ("min", "v"), "z": ("max", "v"), "d": ("distinct", "m"), "e": ("distinct", "v")}
    got = salted_rollup(df, ["k"], spec)
    want = df.groupBy("k").agg(F.count("v").alias("n"), F.sum("v").alias("s"), F.min("v").alias("a"), F.max("v").alias("z"),
                               F.count_distinct("m").alias("d"), F.count_distinct("v").alias("e"))
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert salted_rollup(df.limit(0), ["k"], spec).count() == 0


def test_left_lookup_spreads_null_keys(plain_shuffles):
    from strata.operators.skew import salted_lookup
    df = crowded(plain_shuffles).withColumn("k", F.when(F.col("k") != 0, F.col("k")))
    per = df.groupBy("k").agg(F.max("v").alias("top"))
    out = salted_lookup(df, per, ["k"])
    balanced(out, 24_000)
    assert out.filter("k IS NULL AND top IS NOT NULL").isEmpty()


@pytest.mark.parametrize("how", ["sum", "max"])
@pytest.mark.parametrize("by", [[], ["k"]])
def test_running_equals_a_window(spark, how, by):
    from strata.operators.sequence import running
    df = crowded(spark, 3000).withColumn("o", F.when(F.col("v") % 7 == 0, None).when(F.col("v") % 11 == 0, float("nan")).otherwise(F.col("v") % 50 / 2))
    fold = F.sum if how == "sum" else F.max
    w = Window.partitionBy(*by)
    want = df.withColumns({"r": fold("v").over(w.orderBy("o", "v").rowsBetween(Window.unboundedPreceding, 0)), "t": fold("v").over(w)})
    got = running(df, ["o", "v"], by, F.col("v"), "r", how, total="t")
    assert got.select(*want.columns).exceptAll(want).isEmpty() and got.count() == 3000
    text = df.withColumn("o", F.col("o").cast("string"))                                      # not a number: ranges by sampled bounds
    want = text.withColumns({"r": fold("v").over(w.orderBy("o", "v").rowsBetween(Window.unboundedPreceding, 0)), "t": fold("v").over(w)})
    got = running(text, ["o", "v"], by, F.col("v"), "r", how, total="t")
    assert got.select(*want.columns).exceptAll(want).isEmpty() and got.count() == 3000


def test_running_shuffles_its_rows_once(plain_shuffles):
    from strata.operators.sequence import running
    df = crowded(plain_shuffles, 3000)
    for by in ([], ["m"]):
        plan = running(df, ["v"], by, F.col("v"), "r", "sum")._jdf.queryExecution().executedPlan().toString()
        rows = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "_rm_v" not in x and "ReusedExchange" not in x]
        # the rows once; the other exchanges carry a row per range
        assert plan.count("REPARTITION_BY_COL") == 2 and plan.count("BroadcastNestedLoopJoin") == 0, rows


def test_quantiles_leave_out_nan(spark):
    from strata.operators.stats import box_stats, summary
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", None), ("a", 3.0), ("b", None)], "g string, v double")
    assert {r.g: r.q50 for r in exact_quantiles(df, "v", [0.5], ["g"]).collect()} == {"a": 2.0}
    s = summary(df, "v").first()
    assert (s["count"], s["mean"], s["p50"], s["max"]) == (2, 2.0, 2.0, 3.0)
    assert [tuple(r) for r in box_stats(df, "v", ["g"]).collect()] == [("a", 2, 1.5, 2.0, 2.5, 1.0, 3.0, 0)]
    assert summary(df.limit(0), "v").first()["count"] == 0
