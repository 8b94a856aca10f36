"""The student star rebuilt from the driver's tables, and every report,
measure, security, legacy, history and maintenance query over it.

The driver's tables are turned into the seven untyped source tables of the
student pipeline (``raw_tables``), landed as Bronze and run through
``medallion.run_pipeline`` -- Silver and Gold with all their checks.  The
resulting Gold layer maps back to the driver's tables as:

* dim_student    <- customer + nation + region: region = region name,
  highest_education = market segment, imd_band = nation name,
  age_band = balance band
* dim_module     <- distinct (order priority, order year) of orders
* dim_assessment <- part: code_module = brand, assessment_type = type,
  weight = size
* fact_registration <- orders (withdrawn = status 'F')
* fact_assessment   <- lineitem + orders (score = 2 x quantity, ungraded on
  line 7)
* fact_vle          <- lineitem + orders rolled up per (student, module,
  presentation, site = supplier, day) with clicks = quantity

The Gold tables are built once per session and data folder and written to
the shared checkpoint folder; later queries read them back, as report
queries read a written Gold layer.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.compare import compare_keyed
from strata.operators.history import after_watermark, merge_upsert, scd2, scd2_apply
from strata.operators.joins import outputs_equal
from strata.operators.maintain import compact, file_stats
from strata.plans import medallion
from strata.plans.analogs import ORDER_ORIGIN, table
from strata.plans.legacy import legacy_summary
from strata.plans.reports import engagement_outcome, student_star
from strata.session import ensure_checkpoint_dir, scratch_path
from strata.operators.quality import count_tables, require_all_rows
from strata.sources.ingest import inline_table, with_audit
from strata.sources.layout import Layout, write_many

# Invented principals and the regions they may see.  Covers a
# user with several regions, a duplicate mapping in other letter case and a
# region without customers.
SECURITY_ROWS = [
    ("africa.admin@example.org", "AFRICA"),
    ("multi.admin@example.org", "ASIA"),
    ("multi.admin@example.org", "EUROPE"),
    ("Multi.Admin@example.org", "EUROPE"),
    ("exec.admin@example.org", "AMERICA"),
    ("exec.admin@example.org", "MIDDLE EAST"),
    ("polar.admin@example.org", "ANTARCTICA"),
]
MULTI_REGION_USER = "Multi.Admin@Example.org"
UNMAPPED_USER = "nobody@example.org"
GOLD_TABLES = ["dim_student", "dim_module", "dim_assessment", "fact_registration",
               "fact_assessment", "fact_vle", "security_region_map"]
_GOLD_ROOTS: dict[tuple[str, str], str] = {}


def _students(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    band = (F.when(F.col("c_acctbal") < 0, F.lit("negative"))
            .when(F.col("c_acctbal") < 5000, F.lit("low")).otherwise(F.lit("high")))
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
            .select(F.col("c_custkey").alias("id_student"), F.col("r_name").alias("region"),
                    F.col("c_mktsegment").alias("highest_education"),
                    F.col("n_name").alias("imd_band"), band.alias("age_band")))


def order_lines(spark, d) -> DataFrame:
    """Each line with what its scores and clicks take from its order.

    At size the two meet in a shuffle: both sides go in as the few numbers that
    are needed, text is made of them afterwards.
    """
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.datediff(F.to_date("l_shipdate"), F.lit(ORDER_ORIGIN)).alias("day"),
        F.coalesce(F.col("l_linenumber") == 7, F.lit(False)).alias("ungraded"), F.col("l_quantity").cast("int").alias("clicks"),
        F.when(F.coalesce(F.col("l_linenumber") != 7, F.lit(True)), (F.col("l_quantity") * 2).cast("int")).alias("score"))
    of = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.year("o_orderdate").alias("year"))
    return li.join(of, li.l_orderkey == of.o_orderkey, "left").drop("l_orderkey", "o_orderkey")


def raw_tables(spark, d, lines: DataFrame | None = None) -> dict[str, DataFrame]:
    """The seven untyped source tables, as strings, from the driver's tables; ``lines`` are ``order_lines``
    where they are written already."""
    o, c, n, r = (table(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    S = "string"
    day = lambda col: F.datediff(F.to_date(col), F.lit(ORDER_ORIGIN)).cast(S)
    keys = [F.col("o_orderpriority").alias("code_module"),
            F.year("o_orderdate").cast(S).alias("code_presentation"),
            F.col("o_custkey").cast(S).alias("id_student")]
    band = (F.when(F.col("c_acctbal") < 0, F.lit("negative"))
            .when(F.col("c_acctbal") < 5000, F.lit("low")).otherwise(F.lit("high")))
    cust = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .join(r, F.col("n_regionkey") == r.r_regionkey, "left"))
    info = o.join(cust, o.o_custkey == cust.c_custkey, "left").select(
        *keys, F.lit("U").alias("gender"), F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("highest_education"), F.col("n_name").alias("imd_band"),
        band.alias("age_band"), F.lit("0").alias("num_of_prev_attempts"),
        F.lit("60").alias("studied_credits"), F.lit("N").alias("disability"),
        F.col("o_orderstatus").alias("final_result"))
    reg = o.select(*keys, day("o_orderdate").alias("date_registration"),
                   F.when(F.col("o_orderstatus") == "F",
                          (F.datediff(F.to_date("o_orderdate"), F.lit(ORDER_ORIGIN)) + 30)
                          .cast(S)).alias("date_unregistration"))
    courses = o.select(*keys[:2]).distinct().withColumn("module_presentation_length",
                                                        F.lit("365"))
    parts = table(spark, d, "part").select(
        F.col("p_brand").alias("code_module"), F.lit("-").alias("code_presentation"),
        F.col("p_partkey").cast(S).alias("id_assessment"), F.col("p_type").alias("assessment_type"),
        F.lit("0").alias("date"), F.col("p_size").cast(S).alias("weight"))
    lines = order_lines(spark, d) if lines is None else lines
    scores = lines.select(
        F.col("l_partkey").cast(S).alias("id_assessment"), F.col("o_custkey").cast(S).alias("id_student"),
        F.col("day").cast(S).alias("date_submitted"), F.lit("0").alias("is_banked"),
        F.when(F.col("ungraded"), F.lit("")).otherwise(F.col("score").cast(S)).alias("score"))
    clicks = lines.select(F.col("o_orderpriority").alias("code_module"), F.col("year").cast(S).alias("code_presentation"),
                          F.col("o_custkey").cast(S).alias("id_student"), F.col("l_suppkey").cast(S).alias("id_site"),
                          F.col("day").cast(S).alias("date"), F.col("clicks").cast(S).alias("sum_click"))
    vle = table(spark, d, "supplier").select(
        F.col("s_suppkey").cast(S).alias("id_site"), F.lit("-").alias("code_module"),
        F.lit("-").alias("code_presentation"), F.lit("resource").alias("activity_type"),
        F.lit("0").alias("week_from"), F.lit("1").alias("week_to"))
    return {"studentInfo": info, "studentRegistration": reg, "courses": courses,
            "assessments": parts, "studentAssessment": scores, "studentVle": clicks, "vle": vle}


def build_gold(spark: SparkSession, d: str, layout: Layout) -> dict:
    """Land the raw tables as Bronze (with the audit column) and reconcile them with
    what can be read back, then run the medallion pipeline -- Silver and Gold
    with all checks -- on them."""
    staged = scratch_path(spark, "order_lines")     # joined once for the two tables made of them
    order_lines(spark, d).write.parquet(staged)
    raw = raw_tables(spark, d, spark.read.parquet(staged))
    landed = write_many(layout, [(with_audit(df), "bronze", t) for t, df in raw.items()])
    folder = spark._jvm.org.apache.hadoop.fs.Path(staged)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    sent = inline_table(spark, [(t, w["rows"]) for t, w in landed.items()], "table_name string, source_rows bigint")
    back = count_tables({t: layout.read(spark, "bronze", t) for t in landed}, count_col="target_rows")
    require_all_rows(sent.join(back, "table_name", "left").withColumn("match", F.col("source_rows").eqNullSafe(F.col("target_rows"))),
                     "match", "bronze reconciliation")
    return medallion.run_pipeline(spark, layout, SECURITY_ROWS)


def _gold_root(spark: SparkSession, d: str) -> str:
    key = (os.path.abspath(d), ensure_checkpoint_dir(spark))
    root = _GOLD_ROOTS.get(key)
    if root is None:
        root = scratch_path(spark, "analog_gold")
        build_gold(spark, d, Layout(root=root))
        _GOLD_ROOTS[key] = root
    return root


def gold(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    layout = Layout(root=_gold_root(spark, d))
    return {t: layout.read(spark, "gold", t) for t in GOLD_TABLES}


def star(spark, d):
    # Raw ratios (no rounding) so another engine can reproduce them exactly.
    return student_star(gold(spark, d), digits=None)


def _q(measures, by, principal=None, **kw):
    """A slice of the whole star, or of what ``principal`` may see."""
    def run(spark, d):
        s = star(spark, d)
        s = s.unsecured() if principal is None else s
        return s.query(measures, by, principal=principal, **kw)
    return run


q_withdrawal_rate_by_region = _q(["withdrawal_rate"], ["dim_student.region"])


# -- security -----------------------------------------------------------------

def q_rls_dim(spark, d):
    s = star(spark, d).secured(MULTI_REGION_USER)
    return s.dims["dim_student"].select("student_sk", "id_student", "region")


# -- legacy summary, engagement, parallel run --------------------------------

def q_legacy_summary(spark, d):
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    key3 = [F.col("o_custkey").cast("string").alias("id_student"),
            F.col("o_orderpriority").alias("code_module"),
            F.col("o_orderkey").cast("string").alias("code_presentation")]
    imd = (F.when(F.col("o_orderkey") % 9 == 0, F.lit(None).cast("string"))
           .when(F.col("o_orderkey") % 9 == 1, F.lit("")).otherwise(F.col("c_mktsegment")))
    info = (o.join(c, o.o_custkey == c.c_custkey, "left")
            .join(n, F.col("c_nationkey") == n.n_nationkey, "left")
            .select(*key3, F.col("c_mktsegment").alias("gender"), F.col("n_name").alias("region"),
                    F.col("o_orderstatus").alias("highest_education"),
                    F.col("o_orderpriority").alias("age_band"), imd.alias("imd_band")))
    # The registration of an order under 25,000 is filed under another presentation: those students keep NULL dates.
    filed = F.when(F.col("o_totalprice") >= 25000, F.col("o_orderkey")).otherwise(-F.col("o_orderkey"))
    reg = o.select(
        *key3[:2], filed.cast("string").alias("code_presentation"),
        F.datediff(F.to_date("o_orderdate"), F.lit(ORDER_ORIGIN)).cast("string")
        .alias("date_registration"),
        F.when(F.col("o_orderstatus") == "F", F.lit("5"))
        .when(F.col("o_orderkey") % 2 == 0, F.lit("")).alias("date_unregistration"))
    li = table(spark, d, "lineitem")
    scores = li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        F.col("o_custkey").cast("string").alias("id_student"),
        F.col("l_quantity").cast("string").alias("score"))
    clicks = table(spark, d, "events").select(F.col("user_id").cast("string").alias("id_student"),
                                              F.col("value").cast("string").alias("sum_click"))
    return legacy_summary(info, reg, scores, clicks, digits=None)


def q_engagement_outcome(spark, d):
    return engagement_outcome(gold(spark, d))


def q_outputs_equal(spark, d):
    via_star = star(spark, d).unsecured().query(["withdrawal_count"], ["dim_student.region"])
    st = _students(spark, d)
    direct = (table(spark, d, "orders").join(
        st, F.col("o_custkey") == st.id_student, "left")
        .groupBy("region")
        .agg(F.nullif(F.count_if(F.col("o_orderstatus") == "F"), F.lit(0))
             .alias("withdrawal_count"))
        .filter(F.col("withdrawal_count").isNotNull()))
    return outputs_equal(via_star, direct)


def q_outputs_differ(spark, d):
    """As ``outputs_equal`` with one region under another name: a row on each side only."""
    by = star(spark, d).unsecured().query(["withdrawal_count"], ["dim_student.region"])
    other = by.withColumn("region", F.when(F.col("region") == "ASIA", F.lit("EURASIA")).otherwise(F.col("region")))
    return outputs_equal(by, other)


def q_legacy_vs_medallion(spark, d):
    """Per student: the legacy one-table transform against the Gold facts, old row by new.

    The legacy join repeats a registration that a student has twice under one
    key, so ``registrations`` differs; every 50th student is filed under another
    id in the new output, which shows as one missing and one extra row.
    """
    raw = raw_tables(spark, d)
    old = (legacy_summary(raw["studentInfo"], raw["studentRegistration"], raw["studentAssessment"], raw["studentVle"], digits=None)
           .groupBy("id_student").agg(F.count(F.lit(1)).alias("registrations"), F.max("is_withdrawn").alias("is_withdrawn"),
                                      F.max("avg_score").alias("avg_score"), F.max("total_clicks").cast("bigint").alias("total_clicks")))
    g = gold(spark, d)
    reg = g["fact_registration"].groupBy("student_sk").agg(F.count(F.lit(1)).alias("registrations"), F.max(F.col("is_withdrawn").cast("int")).alias("is_withdrawn"))
    score = g["fact_assessment"].groupBy("student_sk").agg(F.avg(F.col("score").cast("double")).alias("avg_score"))
    clicks = g["fact_vle"].groupBy("student_sk").agg(F.sum("total_clicks").alias("total_clicks"))
    filed = F.when(F.col("id_student").cast("int") % 50 == 0, F.concat(F.lit("-"), F.col("id_student"))).otherwise(F.col("id_student"))
    new = (g["dim_student"].select("student_sk", filed.alias("id_student")).join(reg, "student_sk").join(score, "student_sk", "left")
           .join(clicks, "student_sk", "left").drop("student_sk"))
    return compare_keyed(old, new.select(*old.columns), ["id_student"])


def q_gold_facts(spark, d):
    """Every row of the published facts with both of its keys."""
    g = gold(spark, d)
    long = lambda c: F.col(c).cast("bigint")
    parts = [("fact_assessment", "assessment_sk", "score", "date_submitted"), ("fact_vle", "module_sk", "total_clicks", "event_count"),
             ("fact_registration", "module_sk", "is_withdrawn", "date_registration")]
    frames = [g[t].select(F.lit(t).alias("fact"), "student_sk", F.col(sk).alias("other_sk"), long(a).alias("first_value"), long(b).alias("second_value"))
              for t, sk, a, b in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def q_gold_dims(spark, d):
    """Modules and assessments with their keys."""
    g = gold(spark, d)
    m = g["dim_module"].select(F.lit("module").alias("dim"), F.col("module_sk").alias("sk"), "code_module", "code_presentation",
                               F.col("module_presentation_length").cast("double").alias("value"))
    a = g["dim_assessment"].select(F.lit("assessment"), "assessment_sk", F.col("code_module"), F.col("id_assessment"), F.col("weight"))
    return m.union(a)


# -- history ------------------------------------------------------------------

def q_scd2(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderkey",
                                         F.to_date("o_orderdate").alias("d"))
    v = scd2(o, ["o_custkey"], ["o_orderpriority"], "d", tie=["o_orderkey"])
    return v.withColumns({"effective_from": F.col("effective_from").cast("string"),
                          "effective_to": F.col("effective_to").cast("string")})


def q_scd2_apply(spark, d):
    """The history of ``scd2`` from three batches that come out of order, the second one twice."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderkey", F.to_date("o_orderdate").alias("d"))
    args = (["o_custkey"], ["o_orderpriority"], "d", ["o_orderkey"])
    batches = [o.filter(F.pmod(F.col("o_orderkey"), F.lit(3)) == i) for i in (2, 0, 1)]
    log, history = batches[0], scd2(batches[0], *args)
    for b in (batches[1], batches[1], batches[2]):
        path = scratch_path(spark, "history")           # each batch's history is a written table
        scd2_apply(history, log, b, *args).write.parquet(path)
        log, history = log.unionByName(b), spark.read.parquet(path)
    return history.withColumns({"effective_from": F.col("effective_from").cast("string"),
                                "effective_to": F.col("effective_to").cast("string")})


def q_rollup_incremental(spark, d):
    """Events rolled up from three batches, one of them sent twice; stored by event type."""
    from strata.plans.analogs import MONEY, event_day
    from strata.sources.partitioned import merge_rollup
    e = table(spark, d, "events").withColumn("day", event_day())
    lake = Layout(root=scratch_path(spark, "incremental"))
    for i in (1, 0, 1, 2):
        merge_rollup(spark, lake, "silver", "clicks", e.filter(F.pmod(F.col("event_id"), F.lit(3)) == i), f"batch-{i}",
                     ["user_id", "event_type", "day"], "value", "event_type", "total_value", "event_count", MONEY)
    return lake.read(spark, "silver", "clicks").withColumn("total_value", F.col("total_value").cast("double"))


def q_csv_rejects(spark, d):
    """customer as CSV lines of which some are cut, lengthened or left with an open quote: what was landed, and why the rest was not."""
    from strata.sources.ingest import land_csv
    c = table(spark, d, "customer")
    quoted = F.concat(F.lit('"'), F.col("c_name"), F.lit(', esq."'))
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), quoted, F.col("c_nationkey").cast("string"), F.col("c_acctbal").cast("string"), "c_mktsegment")
    k = F.col("c_custkey") % 20
    line = (F.when(k == 1, F.regexp_replace(line, ",[^,]*$", "")).when(k == 2, F.concat(line, F.lit(",more")))
            .when(k == 3, F.concat(line, F.lit(',"open'))).when(k == 4, F.regexp_replace(line, '"$|esq."', 'esq.')).otherwise(line))
    folder = scratch_path(spark, "customer_lines")
    spark.createDataFrame([(",".join(c.columns),)], "value string").coalesce(1).write.text(folder)
    c.select(line.alias("value")).write.mode("append").text(folder)
    lake = Layout(root=scratch_path(spark, "landing"))
    counts = land_csv(spark, folder, c.columns, lake, "raw", "customer")
    good = lake.read(spark, "raw", "customer").groupBy().agg(F.lit("landed").alias("outcome"), F.count(F.lit(1)).alias("n"),
                                                             F.sum(F.col("c_custkey").cast("bigint")).alias("keys"))
    bad = lake.read(spark, "raw", "customer_rejects").groupBy(F.col("reason").alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.substring_index("record", ",", 1).cast("bigint")).alias("keys"))
    return good.unionByName(bad).withColumn("read", F.lit(counts["read"]).cast("bigint"))


def q_profile_all(spark, d):
    """All columns of the orders profiled in two loads, merged without reading again: the exact part."""
    from strata.operators.profile import merge_profiles, profile_columns, profile_report
    o = table(spark, d, "orders").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 10 == 0, F.lit(" ")).when(
        F.col("o_orderkey") % 10 != 1, F.col("o_orderstatus"))).drop("o_orderdate")
    path = scratch_path(spark, "profiles")
    for load in (F.col("o_orderkey") % 4 == 0, F.col("o_orderkey") % 4 != 0):
        profile_columns(o.filter(load)).write.mode("append").parquet(path)
    report = profile_report(merge_profiles(spark.read.parquet(path)))
    return report.select("column", "rows", "nulls", "blanks", "least", "most", "first_text", "last_text")


def q_scd2_null_runs(spark, d):
    """As ``scd2`` with an attribute that is NULL on many rows in a row."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("d"),
                                         F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("status"))
    v = scd2(o, ["o_custkey"], ["status"], "d", tie=["o_orderkey"])
    return v.withColumns({"effective_from": F.col("effective_from").cast("string"),
                          "effective_to": F.col("effective_to").cast("string")})


CUTOFF = "1999-01-01"          # already loaded: orders before this date
CHANGES_FROM = "1998-07-01"    # change set: orders from this date on


def q_merge_upsert(spark, d):
    o = table(spark, d, "orders")
    target = o.filter(F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz"))
    changes = (o.filter(F.col("o_orderdate") >= F.lit(CHANGES_FROM).cast("timestamp_ntz"))
               .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0)))
    return merge_upsert(target, changes, ["o_orderkey"])


def q_asof_last_purchase(spark, d):
    """For every event, the user's latest purchase at or before it."""
    from strata.operators.history import asof_join
    e = table(spark, d, "events")
    purchases = e.filter(F.col("event_type") == "purchase").select(
        "user_id", "ts", F.col("event_id").alias("purchase_id"),
        F.col("value").alias("purchase_value"))
    j = asof_join(e.select("event_id", "user_id", "ts"), purchases, ["user_id"], "ts", "ts",
                  ["purchase_id", "purchase_value"], tie=["purchase_id"])
    return j.select("event_id", "purchase_id", "purchase_value")


def q_incremental(spark, d):
    o = table(spark, d, "orders")
    loaded = o.filter(F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz"))
    return after_watermark(o, loaded, "o_orderdate")


# -- maintenance (file layout varies: row-count check only) ------------------

def _fragmented_copy(spark, d, files: int = 8) -> str:
    path = scratch_path(spark, "lineitem_copy")
    table(spark, d, "lineitem").repartition(files).write.parquet(path)
    return path


def q_file_stats(spark, d):
    return file_stats(spark.read.parquet(_fragmented_copy(spark, d)))


def q_compaction(spark, d):
    src = _fragmented_copy(spark, d)
    return compact(spark, src, scratch_path(spark, "lineitem_compact"))


def q_compaction_by_file(spark, d):
    """Lines stored by return flag in many small files; compacted, then read back per flag."""
    from strata.operators.maintain import compact_small
    from strata.sources.publish import Publication
    lake = Layout(root=scratch_path(spark, "fragments"))
    lines = table(spark, d, "lineitem")
    first = Publication(spark, lake)
    first.write(lines.repartition(8), "silver", "lines", partition_by=("l_returnflag",))
    first.publish()
    report = compact_small(spark, lake, "silver", "lines")
    again = compact_small(spark, lake, "silver", "lines")
    return (lake.read(spark, "silver", "lines").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))
            .withColumns({"fewer_files": F.lit(report["files_after"] < report["files_before"]), "folders": F.lit(len(report["folders"])).cast("bigint"),
                          "rows_moved": F.lit(report["rows"]).cast("bigint"), "nothing_left": F.lit(not again["folders"])}))


# -- ingest paths: CSV landing, streaming increments, cast-loss probe ----------

def q_csv_roundtrip(spark, d):
    """customer -> CSV files -> all-string read -> landed twice (append:
    re-landing duplicates, as the raw landing step does) -> typed profile."""
    from strata.functions.casts import cast_columns
    from strata.sources.ingest import land, read_raw_csv
    c = table(spark, d, "customer")
    csv_dir = scratch_path(spark, "customer_csv")
    c.write.options(header="true", quote='"', escape="\\").csv(csv_dir)
    raw = read_raw_csv(spark, csv_dir, c.columns)
    lake = Layout(root=scratch_path(spark, "landing"))
    land(raw, lake, "raw", "customer")
    land(raw, lake, "raw", "customer")
    typed = cast_columns(lake.read(spark, "raw", "customer"), {"c_custkey": "bigint"})
    return typed.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("c_custkey").alias("customers"),
        F.sum(F.col("c_acctbal").try_cast("decimal(18,2)")).cast("double").alias("balance"))


def q_stream_ingest(spark, d):
    """lineitem arrives as two file batches; each ingest run appends only
    the new files (exactly once), then the Bronze copy is profiled."""
    from strata.streaming import ingest_increment
    li = table(spark, d, "lineitem")
    landing, target = scratch_path(spark, "landing_li"), scratch_path(spark, "bronze_li")
    ckpt = scratch_path(spark, "stream_ckpt")
    li.filter(F.col("l_linenumber") <= 3).write.parquet(f"{landing}/batch1")
    ingest_increment(spark, f"{landing}/*", target, ckpt, li.schema)
    li.filter(~(F.col("l_linenumber") <= 3)).write.parquet(f"{landing}/batch2")
    ingest_increment(spark, f"{landing}/*", target, ckpt, li.schema)
    ingest_increment(spark, f"{landing}/*", target, ckpt, li.schema)   # nothing new
    return spark.read.parquet(target).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"),
        F.count_if(F.col("_ingested_at").isNull()).alias("missing_audit"))


def q_cast_loss(spark, d):
    from strata.functions.casts import cast_loss
    li = table(spark, d, "lineitem")
    raw = li.select(
        F.when(F.col("l_linenumber") == 3, F.lit("")).when(F.col("l_linenumber") == 5, F.lit("n/a"))
        .otherwise(F.col("l_extendedprice").cast("string")).alias("price_raw"),
        F.when(F.col("l_linenumber") == 2, F.lit("4%"))
        .otherwise(F.col("l_discount").cast("string")).alias("discount_raw"))
    return cast_loss(raw, {"price_raw": "int", "discount_raw": "double"})


def q_rls_default_user(spark, d):
    """No principal named: the session user, here one without a region."""
    return star(spark, d).query(["total_students"])


def q_rls_masked_dim(spark, d):
    """Column-level restriction on top of row-level security: a principal
    without the privilege sees the secured rows with ``imd_band`` masked."""
    from strata.operators.security import mask_columns
    s = star(spark, d).secured(MULTI_REGION_USER)
    dim = s.dims["dim_student"].select("student_sk", "region", "imd_band")
    return mask_columns(dim, ["imd_band"], allowed=False)


def colocated_star(spark, d):
    """The star over Gold stored in buckets on the student's key, once per session and data folder."""
    root = os.path.basename(_gold_root(spark, d)).replace("-", "_")
    if not spark.catalog.databaseExists(root):
        tables = medallion.store_colocated(spark, gold(spark, d), root)
    else:
        tables = {t: Layout().read(spark, root, t) for t in GOLD_TABLES}
    return student_star(tables, digits=None)


def q_rls_fact_colocated(spark, d):
    """As ``rls_fact``; facts and dimension meet without a shuffle."""
    return colocated_star(spark, d).query(["withdrawal_rate", "total_students"], ["dim_student.imd_band"], principal=MULTI_REGION_USER)


# Who has which role, and which governed columns a role may see.
ROLE_ROWS = [("multi.admin@example.org", "regional_admin"), ("exec.admin@example.org", "executive"),
             ("exec.admin@example.org", "regional_admin")]
GRANT_ROWS = [("executive", "dim_student.imd_band"), ("executive", "fact_assessment.score"), ("regional_admin", "dim_student.age_band")]
MASKS = {"dim_student.imd_band": "masked", "dim_student.age_band": "masked", "fact_assessment.score": None}


def governed_star(spark, d):
    from dataclasses import replace

    from strata.plans.star import ColumnPolicy
    from strata.sources.ingest import inline_table
    policy = ColumnPolicy(MASKS, inline_table(spark, GRANT_ROWS, "role string, column string"),
                          inline_table(spark, ROLE_ROWS, "user_email string, role string"))
    return replace(star(spark, d), policy=policy)


def q_rls_masked_slice(spark, d):
    """By a column that the principal's role may not see: one masked member."""
    return governed_star(spark, d).query(["total_students", "total_registrations", "withdrawal_count"], ["dim_student.imd_band"],
                                         principal=MULTI_REGION_USER)


def q_rls_granted_slice(spark, d):
    """By columns that one of the principal's roles may see, with a measure of a governed column."""
    return governed_star(spark, d).query(["total_assessments", "score_sum"], ["dim_student.imd_band", "dim_student.age_band"],
                                         principal="exec.admin@example.org")


def q_rls_masked_measure(spark, d):
    """A measure of a masked column is NULL, the slice by a granted one is not masked."""
    return governed_star(spark, d).query(["total_assessments", "score_sum"], ["dim_student.age_band"], principal=MULTI_REGION_USER)


def q_engagement_correlation(spark, d):
    from strata.operators.stats import point_biserial
    eo = engagement_outcome(gold(spark, d))
    return point_biserial(eo, "is_withdrawn", "total_clicks", digits=6)


def q_engagement_median_clicks(spark, d):
    from strata.operators.stats import median_by
    eo = engagement_outcome(gold(spark, d))
    return median_by(eo, "total_clicks", ["is_withdrawn"], "median_clicks")


def q_engagement_box(spark, d):
    from strata.operators.stats import box_stats
    return box_stats(engagement_outcome(gold(spark, d)), "total_clicks", ["is_withdrawn"])


def q_diag_distinct_students(spark, d):
    """Distinct students per source table (registrations vs student rows)."""
    from strata.plans.diagnostics import diagnostics
    raw = raw_tables(spark, d)
    return diagnostics(raw)["distinct_students"]


def q_diag_registration_orphans(spark, d):
    """Registrations without student rows and the reverse (three-part key)."""
    from strata.plans.diagnostics import diagnostics
    raw = raw_tables(spark, d)
    # Registrations of every 7th day are filed under another id: keys miss on both sides.
    filed = F.when(F.col("date_registration").cast("int") % 7 == 0, F.concat(F.lit("-"), "id_student")).otherwise(F.col("id_student"))
    return diagnostics({**raw, "studentRegistration": raw["studentRegistration"].withColumn("id_student", filed)})["registration_orphans"]


def q_diag_imd_profile(spark, d):
    """Count and share of each value of a slicing column in the raw rows."""
    from strata.plans.diagnostics import diagnostics
    return diagnostics(raw_tables(spark, d))["imd_band_profile"]


def q_diag_registration_status(spark, d):
    from strata.plans.diagnostics import diagnostics
    return diagnostics(raw_tables(spark, d))["registration_status"]


def _report(key):
    def run(spark, d):
        from strata.plans.reports import report
        return report(star(spark, d).unsecured(), key)
    return run


QUERIES = {
    "m_total_students": _q(["total_students"], ["dim_student.region"]),
    "m_avg_score": _q(["avg_score"], ["dim_assessment.assessment_type"]),
    "m_total_assessments": _q(["total_assessments"], ["dim_assessment.assessment_type"]),
    "m_total_clicks": _q(["total_clicks"], ["dim_module.code_module"]),
    "m_pass_rate": _q(["pass_rate"], ["dim_assessment.assessment_type"]),
    "m_weighted_score": _q(["weighted_score"], ["dim_assessment.code_module"]),
    "m_total_registrations": _q(["total_registrations"], ["dim_module.code_module"]),
    "m_withdrawal_count": _q(["withdrawal_count"], ["dim_student.region"]),
    "m_withdrawal_rate": q_withdrawal_rate_by_region,
    "m_avg_clicks_per_student": _q(["avg_clicks_per_student"], ["dim_module.code_module"]),
    "m_avg_clicks_per_registration": _q(["avg_clicks_per_registration"],
                                        ["dim_module.code_module"]),
    "m_avg_clicks_per_active_student": _q(["avg_clicks_per_active_student"],
                                          ["dim_module.code_module"]),
    "implicit_sum": _q(["score_sum"], ["fact_assessment.score"]),
    "unrelated_slice": _q(["total_registrations"], ["dim_assessment.code_module"]),
    "report_top": _q(["withdrawal_rate"], ["dim_student.imd_band"],
                     order=[("withdrawal_rate", True)], limit=10),
    "kpi_registration": _q(["total_registrations", "withdrawal_count", "withdrawal_rate"], []),
    "kpi_engagement": _q(["total_students", "total_clicks", "avg_clicks_per_student"], []),
    "kpi_assessment": _q(["total_assessments", "avg_score", "pass_rate", "weighted_score"], []),
    "students_by_age_band": _q(["total_students"], ["dim_student.age_band"]),
    "withdrawal_rate_by_education": _q(["withdrawal_rate"],
                                       ["dim_student.highest_education"]),
    "rls_dim": q_rls_dim,
    "rls_fact": _q(["withdrawal_rate", "total_students"], ["dim_student.imd_band"],
                   principal=MULTI_REGION_USER),
    "rls_fact_colocated": q_rls_fact_colocated,
    "rls_default_user": q_rls_default_user,
    "rls_unmapped": _q(["withdrawal_rate"], ["dim_student.region"], principal=UNMAPPED_USER),
    "engagement_outcome": q_engagement_outcome,
    "legacy_summary": q_legacy_summary,
    "outputs_equal": q_outputs_equal,
    "outputs_differ": q_outputs_differ,
    "legacy_vs_medallion": q_legacy_vs_medallion,
    "gold_facts": q_gold_facts,
    "gold_dims": q_gold_dims,
    "scd2": q_scd2,
    "scd2_null_runs": q_scd2_null_runs,
    "scd2_apply": q_scd2_apply,
    "rollup_incremental": q_rollup_incremental,
    "csv_rejects": q_csv_rejects,
    "profile_all": q_profile_all,
    "merge_upsert": q_merge_upsert,
    "incremental": q_incremental,
    "asof_last_purchase": q_asof_last_purchase,
    "file_stats": q_file_stats,
    "compaction": q_compaction,
    "compaction_by_file": q_compaction_by_file,
    "csv_roundtrip": q_csv_roundtrip,
    "stream_ingest": q_stream_ingest,
    "cast_loss": q_cast_loss,
    "v_avg_score_by_module": _report("avg_score_by_module"),
    "v_pass_rate_by_module": _report("pass_rate_by_module"),
    "v_students_by_education": _report("students_by_education"),
    "v_withdrawal_rate_by_imd_band": _report("withdrawal_rate_by_imd_band"),
    "v_score_count_by_score": _report("score_count_by_score"),
    "v_registrations_by_module": _report("registrations_by_module"),
    "rls_masked_dim": q_rls_masked_dim,
    "rls_masked_slice": q_rls_masked_slice,
    "rls_granted_slice": q_rls_granted_slice,
    "rls_masked_measure": q_rls_masked_measure,
    "pass_rate_by_score": _q(["pass_rate"], ["fact_assessment.score"]),
    "pass_rate_by_type_and_score": _q(["pass_rate", "total_assessments"], ["dim_assessment.assessment_type", "fact_assessment.score"]),
    "withdrawal_count_by_flag": _q(["withdrawal_count"], ["fact_registration.is_withdrawn"]),
    "withdrawal_count_by_region_and_flag": _q(["withdrawal_count"], ["dim_student.region", "fact_registration.is_withdrawn"]),
    "engagement_correlation": q_engagement_correlation,
    "engagement_median_clicks": q_engagement_median_clicks,
    "engagement_box": q_engagement_box,
    "diag_distinct_students": q_diag_distinct_students,
    "diag_registration_orphans": q_diag_registration_orphans,
    "diag_imd_profile": q_diag_imd_profile,
    "diag_registration_status": q_diag_registration_status,
}


# -- equivalent SQL ----------------------------------------------------------

_STUDENTS = """(SELECT c.c_custkey AS id_student, r.r_name AS region,
    c.c_mktsegment AS highest_education, n.n_name AS imd_band,
    CASE WHEN c.c_acctbal < 0 THEN 'negative' WHEN c.c_acctbal < 5000 THEN 'low'
         ELSE 'high' END AS age_band
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""
_REG = """(SELECT o_orderkey, o_custkey AS id_student, o_orderpriority AS code_module,
    CAST(year(o_orderdate) AS VARCHAR) AS code_presentation,
    o_orderstatus = 'F' AS is_withdrawn FROM orders)"""
_LINES = """(SELECT o.o_custkey AS id_student, o.o_orderpriority AS code_module,
    CAST(year(o.o_orderdate) AS VARCHAR) AS code_presentation, l.l_partkey AS id_assessment,
    CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(l.l_quantity * 2 AS INTEGER) END AS score,
    CAST(l.l_quantity AS INTEGER) AS sum_click
    FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)"""
_PARTS = """(SELECT p_partkey AS id_assessment, p_brand AS code_module,
    p_type AS assessment_type, CAST(p_size AS DOUBLE) AS weight FROM part)"""
_WCOUNT = "NULLIF(COUNT(*) FILTER (WHERE r.is_withdrawn), 0)"
_WRATE = f"CAST({_WCOUNT} AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)"
_REG_S = f"{_REG} r LEFT JOIN {_STUDENTS} s ON r.id_student = s.id_student"
_LINES_P = f"{_LINES} l LEFT JOIN {_PARTS} p ON l.id_assessment = p.id_assessment"
_PASS = ("CAST(COUNT(*) FILTER (WHERE l.score >= 40) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)")
_WSCORE = ("CAST(SUM(l.score * p.weight) AS DOUBLE) / CAST(SUM(p.weight) AS DOUBLE)")
_CLICKS = "CAST(SUM(l.sum_click) AS BIGINT)"
_ALL_STUDENTS = "(SELECT COUNT(DISTINCT c_custkey) FROM customer)"
_SK_STUDENT = ("(SELECT c_custkey, row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) - 1 "
               "AS student_sk FROM customer)")
_SK_MODULE = """(SELECT code_module, code_presentation,
    row_number() OVER (ORDER BY code_module, code_presentation) - 1 AS module_sk
    FROM (SELECT DISTINCT code_module, code_presentation FROM {reg}))""".format(reg=_REG)
_MULTI = "('ASIA', 'EUROPE')"
_LEGACY_KEY = "o.o_totalprice >= 25000"

SQL = {
    "m_total_students": f"""SELECT region, COUNT(DISTINCT id_student) AS total_students
        FROM {_STUDENTS} GROUP BY region""",
    "m_avg_score": f"""SELECT p.assessment_type, AVG(l.score) AS avg_score FROM {_LINES_P}
        GROUP BY p.assessment_type HAVING AVG(l.score) IS NOT NULL""",
    "m_total_assessments": f"""SELECT p.assessment_type, COUNT(*) AS total_assessments
        FROM {_LINES_P} GROUP BY p.assessment_type""",
    "m_total_clicks": f"""SELECT l.code_module, {_CLICKS} AS total_clicks FROM {_LINES} l
        GROUP BY l.code_module HAVING SUM(l.sum_click) IS NOT NULL""",
    "m_pass_rate": f"""SELECT p.assessment_type, {_PASS} AS pass_rate FROM {_LINES_P}
        GROUP BY p.assessment_type""",
    "m_weighted_score": f"""SELECT p.code_module, {_WSCORE} AS weighted_score FROM {_LINES_P}
        GROUP BY p.code_module HAVING {_WSCORE} IS NOT NULL""",
    "m_total_registrations": f"""SELECT code_module, COUNT(*) AS total_registrations
        FROM {_REG} GROUP BY code_module""",
    "m_withdrawal_count": f"""SELECT s.region, {_WCOUNT} AS withdrawal_count FROM {_REG_S}
        GROUP BY s.region HAVING {_WCOUNT} IS NOT NULL""",
    "m_withdrawal_rate": f"""SELECT s.region, {_WRATE} AS withdrawal_rate FROM {_REG_S}
        GROUP BY s.region HAVING {_WCOUNT} IS NOT NULL""",
    "m_avg_clicks_per_student": f"""SELECT l.code_module,
        CAST(SUM(l.sum_click) AS DOUBLE) / CAST({_ALL_STUDENTS} AS DOUBLE)
        AS avg_clicks_per_student FROM {_LINES} l GROUP BY l.code_module""",
    "m_avg_clicks_per_registration": f"""WITH c AS (SELECT code_module, SUM(sum_click) AS clicks
          FROM {_LINES} GROUP BY code_module),
        g AS (SELECT code_module, COUNT(*) AS regs FROM {_REG} GROUP BY code_module)
        SELECT COALESCE(c.code_module, g.code_module) AS code_module,
        CAST(c.clicks AS DOUBLE) / CAST(g.regs AS DOUBLE) AS avg_clicks_per_registration
        FROM c FULL OUTER JOIN g ON c.code_module IS NOT DISTINCT FROM g.code_module
        WHERE c.clicks IS NOT NULL AND g.regs IS NOT NULL""",
    "m_avg_clicks_per_active_student": f"""SELECT l.code_module,
        CAST(SUM(l.sum_click) AS DOUBLE) / CAST(COUNT(DISTINCT l.id_student) AS DOUBLE)
        AS avg_clicks_per_active_student FROM {_LINES} l GROUP BY l.code_module""",
    "implicit_sum": f"""SELECT score, CAST(SUM(score) AS BIGINT) AS score_sum FROM {_LINES}
        GROUP BY score HAVING SUM(score) IS NOT NULL""",
    "unrelated_slice": """SELECT DISTINCT p_brand AS code_module,
        (SELECT COUNT(*) FROM orders) AS total_registrations FROM part""",
    "report_top": f"""SELECT s.imd_band, {_WRATE} AS withdrawal_rate FROM {_REG_S}
        GROUP BY s.imd_band HAVING {_WCOUNT} IS NOT NULL
        ORDER BY withdrawal_rate DESC, s.imd_band LIMIT 10""",
    "kpi_registration": f"""SELECT COUNT(*) AS total_registrations,
        {_WCOUNT} AS withdrawal_count, {_WRATE} AS withdrawal_rate FROM {_REG} r""",
    "kpi_engagement": f"""SELECT {_ALL_STUDENTS} AS total_students,
        {_CLICKS} AS total_clicks,
        CAST(SUM(l.sum_click) AS DOUBLE) / CAST({_ALL_STUDENTS} AS DOUBLE)
        AS avg_clicks_per_student FROM {_LINES} l""",
    "kpi_assessment": f"""SELECT COUNT(*) AS total_assessments, AVG(l.score) AS avg_score,
        {_PASS} AS pass_rate, {_WSCORE} AS weighted_score FROM {_LINES_P}""",
    "students_by_age_band": f"""SELECT age_band, COUNT(DISTINCT id_student) AS total_students
        FROM {_STUDENTS} GROUP BY age_band""",
    "withdrawal_rate_by_education": f"""SELECT s.highest_education, {_WRATE} AS withdrawal_rate
        FROM {_REG_S} GROUP BY s.highest_education HAVING {_WCOUNT} IS NOT NULL""",
    "rls_dim": f"""SELECT k.student_sk, CAST(s.id_student AS VARCHAR) AS id_student, s.region
        FROM {_STUDENTS} s
        JOIN {_SK_STUDENT} k ON s.id_student = k.c_custkey WHERE s.region IN {_MULTI}""",
    "rls_fact": f"""WITH w AS (SELECT s.imd_band, {_WCOUNT} AS wc, COUNT(*) AS n FROM {_REG_S}
          WHERE s.region IN {_MULTI} GROUP BY s.imd_band),
        t AS (SELECT imd_band, COUNT(DISTINCT id_student) AS total_students FROM {_STUDENTS}
          WHERE region IN {_MULTI} GROUP BY imd_band)
        SELECT COALESCE(w.imd_band, t.imd_band) AS imd_band,
        CAST(w.wc AS DOUBLE) / CAST(w.n AS DOUBLE) AS withdrawal_rate, t.total_students
        FROM w FULL OUTER JOIN t ON w.imd_band IS NOT DISTINCT FROM t.imd_band""",
    "rls_default_user": "SELECT CAST(0 AS BIGINT) AS total_students",
    "rls_unmapped": f"""SELECT s.region, {_WRATE} AS withdrawal_rate FROM {_REG_S}
        WHERE FALSE GROUP BY s.region""",
    "engagement_outcome": f"""WITH m AS {_SK_MODULE}, k AS {_SK_STUDENT},
        r AS (SELECT k.student_sk, m.module_sk, r.is_withdrawn FROM {_REG} r
          LEFT JOIN k ON r.id_student = k.c_custkey
          LEFT JOIN m ON r.code_module = m.code_module
            AND r.code_presentation = m.code_presentation),
        c AS (SELECT k.student_sk, m.module_sk, SUM(l.sum_click) AS total_clicks
          FROM {_LINES} l LEFT JOIN k ON l.id_student = k.c_custkey
          LEFT JOIN m ON l.code_module = m.code_module
            AND l.code_presentation = m.code_presentation GROUP BY 1, 2)
        SELECT r.student_sk, r.module_sk, r.is_withdrawn,
        CAST(COALESCE(c.total_clicks, 0) AS BIGINT) AS total_clicks
        FROM r LEFT JOIN c ON r.student_sk = c.student_sk AND r.module_sk = c.module_sk""",
    "legacy_summary": f"""SELECT CAST(o.o_custkey AS VARCHAR) AS id_student,
        c.c_mktsegment AS gender, n.n_name AS region, o.o_orderstatus AS highest_education,
        o.o_orderpriority AS age_band,
        CASE WHEN o.o_orderkey % 9 IN (0, 1) THEN 'Unknown' ELSE c.c_mktsegment END AS imd_band,
        CASE WHEN {_LEGACY_KEY} THEN CAST(date_diff('day', DATE '1995-01-01',
          CAST(o.o_orderdate AS DATE)) AS INTEGER) END AS date_registration,
        CASE WHEN {_LEGACY_KEY} AND o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_withdrawn,
        (SELECT AVG(l.l_quantity) FROM lineitem l JOIN orders o2 ON l.l_orderkey = o2.o_orderkey
          WHERE o2.o_custkey = o.o_custkey) AS avg_score,
        (SELECT CAST(SUM(CAST(trunc(e.value) AS INTEGER)) AS INTEGER) FROM events e
          WHERE e.user_id = o.o_custkey) AS total_clicks
        FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
        LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "outputs_equal": f"""WITH a AS (SELECT s.region, {_WCOUNT} AS wc FROM {_REG_S}
          GROUP BY s.region HAVING {_WCOUNT} IS NOT NULL),
        b AS (SELECT DISTINCT s.region, (SELECT NULLIF(COUNT(*), 0) FROM orders o2
          JOIN {_STUDENTS} s2 ON o2.o_custkey = s2.id_student
          WHERE s2.region IS NOT DISTINCT FROM s.region AND o2.o_orderstatus = 'F') AS wc
          FROM orders o LEFT JOIN {_STUDENTS} s ON o.o_custkey = s.id_student),
        b2 AS (SELECT * FROM b WHERE wc IS NOT NULL)
        SELECT only_left, only_right, only_left = 0 AND only_right = 0 AS equal FROM (
        SELECT (SELECT COUNT(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b2)) AS only_left,
        (SELECT COUNT(*) FROM (SELECT * FROM b2 EXCEPT ALL SELECT * FROM a)) AS only_right)""",
    "outputs_differ": "SELECT CAST(1 AS BIGINT) AS only_left, CAST(1 AS BIGINT) AS only_right, FALSE AS equal FROM region WHERE r_name = 'ASIA'",
    "legacy_vs_medallion": f"""WITH k AS (SELECT id_student, code_module, code_presentation, COUNT(*) AS n FROM {_REG} GROUP BY ALL),
        s AS (SELECT id_student, CAST(SUM(n * n) AS BIGINT) AS was, CAST(SUM(n) AS BIGINT) AS now FROM k GROUP BY id_student)
        SELECT CAST(id_student AS VARCHAR) AS id_student, 'changed' AS kind, 'registrations' AS column,
          CAST(was AS VARCHAR) AS old_value, CAST(now AS VARCHAR) AS new_value FROM s WHERE was <> now AND id_student % 50 <> 0
        UNION ALL SELECT CAST(id_student AS VARCHAR), 'missing', NULL, NULL, NULL FROM s WHERE id_student % 50 = 0
        UNION ALL SELECT '-' || id_student, 'extra', NULL, NULL, NULL FROM s WHERE id_student % 50 = 0""",
    "gold_facts": f"""WITH m AS {_SK_MODULE}, k AS {_SK_STUDENT},
        a AS (SELECT p_partkey, row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) - 1 AS assessment_sk FROM part),
        l AS (SELECT o.o_custkey, o.o_orderpriority, CAST(year(o.o_orderdate) AS VARCHAR) AS p, l.*,
          CAST(date_diff('day', DATE '1995-01-01', CAST(l.l_shipdate AS DATE)) AS BIGINT) AS day
          FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey),
        c AS (SELECT o_custkey, o_orderpriority, p, l_suppkey, day, CAST(SUM(CAST(l_quantity AS INTEGER)) AS BIGINT) AS clicks, COUNT(*) AS n
          FROM l GROUP BY ALL)
        SELECT 'fact_assessment' AS fact, k.student_sk, a.assessment_sk AS other_sk,
          CASE WHEN l.l_linenumber <> 7 THEN CAST(l.l_quantity * 2 AS BIGINT) END AS first_value, l.day AS second_value
          FROM l LEFT JOIN k ON l.o_custkey = k.c_custkey LEFT JOIN a ON l.l_partkey = a.p_partkey
        UNION ALL SELECT 'fact_vle', k.student_sk, m.module_sk, c.clicks, c.n
          FROM c LEFT JOIN k ON c.o_custkey = k.c_custkey LEFT JOIN m ON c.o_orderpriority = m.code_module AND c.p = m.code_presentation
        UNION ALL SELECT 'fact_registration', k.student_sk, m.module_sk, CASE WHEN r.is_withdrawn THEN 1 ELSE 0 END,
          CAST(date_diff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE)) AS BIGINT)
          FROM {_REG} r JOIN orders o ON r.o_orderkey = o.o_orderkey LEFT JOIN k ON r.id_student = k.c_custkey
          LEFT JOIN m ON r.code_module = m.code_module AND r.code_presentation = m.code_presentation""",
    "gold_dims": f"""SELECT 'module' AS dim, module_sk AS sk, code_module, code_presentation, CAST(365 AS DOUBLE) AS value FROM {_SK_MODULE}
        UNION ALL SELECT 'assessment', row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) - 1, p_brand, CAST(p_partkey AS VARCHAR),
        CAST(p_size AS DOUBLE) FROM part""",
    "scd2": """WITH o AS (SELECT o_custkey, o_orderpriority, o_orderkey,
          CAST(o_orderdate AS DATE) AS d FROM orders),
        c AS (SELECT *, LAG(o_orderpriority) OVER w AS prev, ROW_NUMBER() OVER w AS rn FROM o
          WINDOW w AS (PARTITION BY o_custkey ORDER BY d, o_orderkey)),
        s AS (SELECT * FROM c WHERE rn = 1 OR prev IS DISTINCT FROM o_orderpriority),
        v AS (SELECT *, LEAD(d) OVER (PARTITION BY o_custkey ORDER BY d, o_orderkey) AS nxt
          FROM s)
        SELECT o_custkey, o_orderpriority, CAST(d AS VARCHAR) AS effective_from,
        CAST(COALESCE(nxt, DATE '9999-12-31') AS VARCHAR) AS effective_to,
        nxt IS NULL AS is_current FROM v""",
    "scd2_null_runs": """WITH o AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d,
          CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS status FROM orders),
        c AS (SELECT *, LAG(status) OVER w AS prev, ROW_NUMBER() OVER w AS rn FROM o
          WINDOW w AS (PARTITION BY o_custkey ORDER BY d, o_orderkey)),
        s AS (SELECT * FROM c WHERE rn = 1 OR prev IS DISTINCT FROM status),
        v AS (SELECT *, LEAD(d) OVER (PARTITION BY o_custkey ORDER BY d, o_orderkey) AS nxt FROM s)
        SELECT o_custkey, status, CAST(d AS VARCHAR) AS effective_from,
        CAST(COALESCE(nxt, DATE '9999-12-31') AS VARCHAR) AS effective_to,
        nxt IS NULL AS is_current FROM v""",
    "merge_upsert": f"""SELECT * FROM orders t WHERE t.o_orderdate < TIMESTAMP '{CUTOFF}'
          AND NOT EXISTS (SELECT 1 FROM orders c WHERE c.o_orderdate >= TIMESTAMP
          '{CHANGES_FROM}' AND c.o_orderkey = t.o_orderkey)
        UNION ALL
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0::DOUBLE AS o_totalprice,
          o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP
          '{CHANGES_FROM}'""",
    "incremental": f"""SELECT * FROM orders WHERE o_orderdate > (SELECT MAX(o_orderdate)
        FROM orders WHERE o_orderdate < TIMESTAMP '{CUTOFF}')""",
    "asof_last_purchase": """SELECT l.event_id, r.event_id AS purchase_id,
        r.value AS purchase_value FROM events l ASOF LEFT JOIN
        (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'purchase') r
        ON l.user_id = r.user_id AND l.ts >= r.ts""",
    "csv_roundtrip": """SELECT c_mktsegment, 2 * COUNT(*) AS n,
        COUNT(DISTINCT c_custkey) AS customers,
        CAST(2 * SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
        FROM customer GROUP BY c_mktsegment""",
    "stream_ingest": """SELECT l_returnflag, COUNT(*) AS n, SUM(l_quantity) AS qty,
        0::BIGINT AS missing_audit FROM lineitem GROUP BY l_returnflag""",
    "cast_loss": """SELECT COUNT(*) AS rows,
        COUNT(*) FILTER (WHERE l_linenumber = 5) AS price_raw_lost,
        COUNT(*) FILTER (WHERE l_linenumber = 2) AS discount_raw_lost FROM lineitem""",
    "v_avg_score_by_module": f"""SELECT p.code_module, AVG(l.score) AS avg_score
        FROM {_LINES_P} GROUP BY p.code_module HAVING AVG(l.score) IS NOT NULL""",
    "v_pass_rate_by_module": f"""SELECT p.code_module, {_PASS} AS pass_rate FROM {_LINES_P}
        GROUP BY p.code_module""",
    "v_students_by_education": f"""SELECT highest_education,
        COUNT(DISTINCT id_student) AS total_students FROM {_STUDENTS}
        GROUP BY highest_education""",
    "v_withdrawal_rate_by_imd_band": f"""SELECT s.imd_band, {_WRATE} AS withdrawal_rate
        FROM {_REG_S} GROUP BY s.imd_band HAVING {_WCOUNT} IS NOT NULL""",
    "v_score_count_by_score": f"""SELECT score, COUNT(*) AS total_assessments FROM {_LINES}
        GROUP BY score""",
    "v_registrations_by_module": f"""SELECT code_module, COUNT(*) AS total_registrations
        FROM {_REG} GROUP BY code_module""",
    "rls_masked_dim": f"""SELECT k.student_sk, s.region, CAST(NULL AS VARCHAR) AS imd_band
        FROM {_STUDENTS} s JOIN {_SK_STUDENT} k ON s.id_student = k.c_custkey
        WHERE s.region IN {_MULTI}""",
    "rls_masked_slice": f"""WITH r AS (SELECT COUNT(*) AS n, {_WCOUNT} AS wc FROM {_REG_S} WHERE s.region IN {_MULTI})
        SELECT 'masked' AS imd_band, COUNT(DISTINCT id_student) AS total_students, (SELECT n FROM r) AS total_registrations,
        (SELECT wc FROM r) AS withdrawal_count FROM {_STUDENTS} WHERE region IN {_MULTI}""",
    "rls_granted_slice": f"""SELECT s.imd_band, s.age_band, COUNT(*) AS total_assessments, CAST(SUM(l.score) AS BIGINT) AS score_sum
        FROM {_LINES} l JOIN {_STUDENTS} s ON l.id_student = s.id_student WHERE s.region IN ('AMERICA', 'MIDDLE EAST') GROUP BY ALL""",
    "rls_masked_measure": f"""SELECT s.age_band, COUNT(*) AS total_assessments, CAST(NULL AS BIGINT) AS score_sum
        FROM {_LINES} l JOIN {_STUDENTS} s ON l.id_student = s.id_student WHERE s.region IN {_MULTI} GROUP BY ALL""",
    "pass_rate_by_score": f"""WITH l AS {_LINES} SELECT score, CAST((SELECT COUNT(*) FROM l WHERE score >= 40) AS DOUBLE)
        / CAST(COUNT(*) AS DOUBLE) AS pass_rate FROM l GROUP BY score""",
    "pass_rate_by_type_and_score": f"""WITH x AS (SELECT p.assessment_type, l.score FROM {_LINES_P}),
        t AS (SELECT assessment_type, COUNT(*) FILTER (WHERE score >= 40) AS passed FROM x GROUP BY assessment_type)
        SELECT x.assessment_type, x.score, CAST(t.passed AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS pass_rate, COUNT(*) AS total_assessments
        FROM x JOIN t ON x.assessment_type IS NOT DISTINCT FROM t.assessment_type GROUP BY x.assessment_type, x.score, t.passed""",
    "withdrawal_count_by_flag": f"""WITH r AS {_REG} SELECT DISTINCT is_withdrawn, (SELECT {_WCOUNT} FROM r) AS withdrawal_count FROM r""",
    "withdrawal_count_by_region_and_flag": f"""WITH x AS (SELECT s.region, r.is_withdrawn FROM {_REG_S})
        SELECT DISTINCT x.region, x.is_withdrawn, t.wc AS withdrawal_count FROM x
        JOIN (SELECT region, {_WCOUNT} AS wc FROM x r GROUP BY region) t ON x.region IS NOT DISTINCT FROM t.region WHERE t.wc IS NOT NULL""",
    "diag_registration_orphans": """WITH r AS (SELECT CASE WHEN date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 7 = 0
          THEN -o_custkey ELSE o_custkey END AS s, o_orderpriority AS m, year(o_orderdate) AS p FROM orders),
        i AS (SELECT o.o_custkey AS s, o.o_orderpriority AS m, year(o.o_orderdate) AS p
          FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)
        SELECT (SELECT COUNT(*) FROM r WHERE NOT EXISTS (SELECT 1 FROM i
                  WHERE i.s = r.s AND i.m = r.m AND i.p = r.p)) AS in_reg_not_in_info,
               (SELECT COUNT(*) FROM i WHERE NOT EXISTS (SELECT 1 FROM r
                  WHERE r.s = i.s AND r.m = i.m AND r.p = i.p)) AS in_info_not_in_reg""",
    "diag_imd_profile": """SELECT n.n_name AS imd_band, COUNT(*) AS imd_count,
        CAST(COUNT(*) AS DOUBLE) * 100.0::DOUBLE / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS pct
        FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
        LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name""",
    "diag_registration_status": """SELECT CASE WHEN o_orderstatus = 'F' THEN 'unregistered'
        ELSE 'registered' END AS registration_status, COUNT(*) AS status_count,
        CAST(COUNT(*) AS DOUBLE) * 100.0::DOUBLE / CAST(SUM(COUNT(*)) OVER () AS DOUBLE)
        AS status_percentage FROM orders GROUP BY 1""",
    "diag_distinct_students": """SELECT 'studentRegistration' AS table_name,
        COUNT(DISTINCT o_custkey) AS unique_students FROM orders
        UNION ALL SELECT 'studentInfo', COUNT(DISTINCT o_custkey) FROM orders""",
}
SQL["rls_fact_colocated"] = SQL["rls_fact"]
SQL["scd2_apply"] = SQL["scd2"]
SQL["compaction_by_file"] = """SELECT l_returnflag, COUNT(*) AS n, SUM(l_quantity) AS qty, TRUE AS fewer_files,
    (SELECT COUNT(DISTINCT l_returnflag) FROM lineitem) AS folders, (SELECT COUNT(*) FROM lineitem) AS rows_moved, TRUE AS nothing_left
    FROM lineitem GROUP BY l_returnflag"""
SQL["rollup_incremental"] = """SELECT user_id, event_type, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS day,
    CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value, COUNT(*) AS event_count FROM events GROUP BY ALL"""
SQL["csv_rejects"] = """SELECT CASE c_custkey % 20 WHEN 1 THEN 'short row' WHEN 2 THEN 'long row' WHEN 3 THEN 'unclosed quote'
    WHEN 4 THEN 'unclosed quote' ELSE 'landed' END AS outcome, COUNT(*) AS n, CAST(SUM(c_custkey) AS BIGINT) AS keys,
    (SELECT COUNT(*) FROM customer) AS read FROM customer GROUP BY 1"""
_PROFILED = """(SELECT * REPLACE (CASE WHEN o_orderkey % 10 = 0 THEN ' ' WHEN o_orderkey % 10 <> 1 THEN o_orderstatus END AS o_orderstatus) FROM orders)"""
SQL["profile_all"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column, COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls, "
    + (f"COUNT(*) FILTER (WHERE trim({c}) = '') AS blanks, CAST(NULL AS DOUBLE) AS least, CAST(NULL AS DOUBLE) AS most, MIN({c}) AS first_text, MAX({c}) AS last_text"
       if c in ("o_orderstatus", "o_orderpriority") else
       f"0 AS blanks, CAST(MIN({c}) AS DOUBLE) AS least, CAST(MAX({c}) AS DOUBLE) AS most, CAST(NULL AS VARCHAR) AS first_text, CAST(NULL AS VARCHAR) AS last_text")
    + f" FROM {_PROFILED}" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"))
_EO = "(" + SQL["engagement_outcome"] + ") eo"
SQL["engagement_correlation"] = f"""SELECT round(corr(CASE WHEN is_withdrawn THEN 1.0 ELSE 0.0 END,
    CAST(total_clicks AS DOUBLE)), 6) AS r, COUNT(*) AS n FROM {_EO}"""
SQL["engagement_median_clicks"] = f"""SELECT is_withdrawn,
    quantile_cont(CAST(total_clicks AS DOUBLE), 0.5) AS median_clicks FROM {_EO}
    GROUP BY is_withdrawn"""
SQL["engagement_box"] = f"""WITH e AS (SELECT is_withdrawn, CAST(total_clicks AS DOUBLE) AS v
      FROM {_EO}),
    q AS (SELECT is_withdrawn, COUNT(*) AS n, quantile_cont(v, 0.25) AS q1,
      quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM e GROUP BY 1),
    f AS (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi FROM q)
    SELECT f.is_withdrawn, f.n, f.q1, f.median, f.q3,
      MIN(CASE WHEN e.v BETWEEN f.lo AND f.hi THEN e.v END) AS lower_whisker,
      MAX(CASE WHEN e.v BETWEEN f.lo AND f.hi THEN e.v END) AS upper_whisker,
      COUNT(*) FILTER (WHERE NOT (e.v BETWEEN f.lo AND f.hi)) AS outliers
    FROM e JOIN f ON e.is_withdrawn = f.is_withdrawn
    GROUP BY f.is_withdrawn, f.n, f.q1, f.median, f.q3"""
