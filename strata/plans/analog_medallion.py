"""The Silver and Gold stage functions run on raw (all-string) tables
derived from the driver's data.

orders  -> studentRegistration / studentInfo rows (one per order: module =
           priority, presentation = order year, student = customer)
lineitem + orders -> studentVle click rows and studentAssessment scores

Blank, junk and NULL raw values are derived from keys, so the casts, the
flag-before-cast rule, the quarantine split and the imputing all see them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.plans import medallion
from strata.plans.analogs import ORDER_ORIGIN, table
from strata.sources.ingest import with_audit

S = "string"


def _order_keys(o: DataFrame) -> list:
    return [F.col("o_orderpriority").alias("code_module"),
            F.year("o_orderdate").cast(S).alias("code_presentation"),
            F.col("o_custkey").cast(S).alias("id_student")]


def _day(c: str) -> F.Column:
    return F.datediff(F.to_date(c), F.lit(ORDER_ORIGIN))


def raw_registration(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    unreg = (F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 5 == 0), F.lit("abc"))
             .when(F.col("o_orderstatus") == "F", (_day("o_orderdate") + 30).cast(S))
             .when(F.col("o_orderkey") % 2 == 0, F.lit("")))
    return with_audit(o.select(*_order_keys(o), _day("o_orderdate").cast(S).alias("date_registration"),
                               unreg.alias("date_unregistration")))


def raw_student_info(spark, d) -> DataFrame:
    o, c, n = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    j = (o.join(c, o.o_custkey == c.c_custkey, "left")
         .join(n, F.col("c_nationkey") == n.n_nationkey, "left"))
    imd = (F.when(F.col("o_orderkey") % 4 == 0, F.lit(None).cast(S))
           .when(F.col("o_orderkey") % 4 == 1, F.lit("")).otherwise(F.col("o_orderpriority")))
    return with_audit(j.select(
        *_order_keys(o), F.col("o_orderstatus").alias("gender"), F.col("n_name").alias("region"),
        F.col("c_mktsegment").alias("highest_education"), imd.alias("imd_band"),
        F.month("o_orderdate").cast(S).alias("age_band"),
        F.lit("0").alias("num_of_prev_attempts"),
        F.col("o_totalprice").cast(S).alias("studied_credits"),
        F.when(F.col("o_totalprice") > 250000, F.lit("Y")).otherwise(F.lit("N")).alias("disability"),
        F.col("o_orderstatus").alias("final_result")))


def _lines(spark, d) -> DataFrame:
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey, "left")


def raw_clicks(spark, d) -> DataFrame:
    j = _lines(spark, d)
    clicks = (F.when(F.col("l_linenumber") == 4, F.lit(""))
              .when(F.col("l_linenumber") == 6, F.lit(None).cast(S))
              .otherwise(F.col("l_quantity").cast(S)))
    return with_audit(j.select(*_order_keys(j), F.col("l_suppkey").cast(S).alias("id_site"),
                               _day("l_shipdate").cast(S).alias("date"),
                               clicks.alias("sum_click")))


def raw_scores(spark, d) -> DataFrame:
    j = _lines(spark, d)
    score = F.when(F.col("l_linenumber") == 7, F.lit("")).otherwise(
        (F.col("l_quantity") * 3 - 20).cast(S))
    return with_audit(j.select(F.col("l_partkey").cast(S).alias("id_assessment"),
                               F.col("o_custkey").cast(S).alias("id_student"),
                               _day("l_shipdate").cast(S).alias("date_submitted"),
                               (F.col("l_linenumber") % 3).cast(S).alias("is_banked"),
                               score.alias("score")))


def q_silver_registration(spark, d):
    return medallion.silver_registration(raw_registration(spark, d)).drop("_ingested_at")


def q_silver_click_rollup(spark, d):
    return medallion.silver_clicks(raw_clicks(spark, d))


def q_silver_score_split(spark, d):
    valid, invalid, _ = medallion.silver_assessment_split(raw_scores(spark, d))
    return (valid.withColumn("quarantined", F.lit(False))
            .unionByName(invalid.withColumn("quarantined", F.lit(True)))
            .drop("_ingested_at"))


def q_gold_dim_student(spark, d):
    return medallion.dim_student(medallion.silver_student_info(raw_student_info(spark, d)))


def q_gold_fact_registration(spark, d):
    """Registration fact through both dimension lookups, with the orphan and
    fan-out report of the pipeline."""
    from strata.operators.quality import orphan_report
    reg = medallion.silver_registration(raw_registration(spark, d))
    students = medallion.dim_student(medallion.silver_student_info(raw_student_info(spark, d)))
    modules = medallion.dim_module(reg.select("code_module", "code_presentation").distinct()
                                   .withColumn("module_presentation_length", F.lit(None).cast("int")))
    fact = medallion.fact_registration(reg, students, modules)
    return orphan_report(fact, ["student_sk", "module_sk"], expected_rows=reg)


QUERIES = {
    "silver_registration": q_silver_registration,
    "silver_click_rollup": q_silver_click_rollup,
    "silver_score_split": q_silver_score_split,
    "gold_dim_student": q_gold_dim_student,
    "gold_fact_registration": q_gold_fact_registration,
}

_KEYS = ("o.o_orderpriority AS code_module, CAST(year(o.o_orderdate) AS VARCHAR) AS "
         "code_presentation, CAST(o.o_custkey AS VARCHAR) AS id_student")
_DAY = "CAST(date_diff('day', DATE '1995-01-01', CAST({c} AS DATE)) AS INTEGER)"
_LINES = "lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey"
_INFO = f"""(SELECT {_KEYS}, o.o_orderstatus AS gender, n.n_name AS region,
    c.c_mktsegment AS highest_education,
    CASE WHEN o.o_orderkey % 4 IN (0, 1) THEN 'Unknown' ELSE o.o_orderpriority END AS imd_band,
    CAST(month(o.o_orderdate) AS VARCHAR) AS age_band,
    CASE WHEN o.o_totalprice > 250000 THEN 'Y' ELSE 'N' END AS disability
    FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""
_ATTRS = "gender, region, highest_education, imd_band, age_band, disability"

SQL = {
    "silver_registration": f"""SELECT {_KEYS}, {_DAY.format(c='o.o_orderdate')} AS date_registration,
        CASE WHEN o.o_orderstatus = 'F' AND o.o_orderkey % 5 <> 0
             THEN {_DAY.format(c='o.o_orderdate')} + 30 END AS date_unregistration,
        o.o_orderstatus = 'F' AS is_withdrawn FROM orders o""",
    "silver_click_rollup": f"""SELECT {_KEYS}, CAST(l.l_suppkey AS VARCHAR) AS id_site,
        {_DAY.format(c='l.l_shipdate')} AS date,
        CAST(SUM(CASE WHEN l.l_linenumber IN (4, 6) THEN NULL
                      ELSE CAST(l.l_quantity AS INTEGER) END) AS BIGINT) AS total_clicks,
        COUNT(*) AS event_count FROM {_LINES} GROUP BY ALL""",
    "silver_score_split": f"""SELECT CAST(l.l_partkey AS VARCHAR) AS id_assessment,
        CAST(o.o_custkey AS VARCHAR) AS id_student,
        {_DAY.format(c='l.l_shipdate')} AS date_submitted,
        (l.l_linenumber % 3) <> 0 AS is_banked,
        CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(l.l_quantity * 3 - 20 AS INTEGER) END
          AS score,
        l.l_linenumber <> 7 AND (l.l_quantity * 3 - 20 < 0 OR l.l_quantity * 3 - 20 > 100)
          AS quarantined FROM {_LINES}""",
    "gold_dim_student": f"""WITH first AS (SELECT * FROM (SELECT *, row_number() OVER (
          PARTITION BY id_student ORDER BY code_presentation, code_module, {_ATTRS}) AS rn
          FROM {_INFO}) WHERE rn = 1)
        SELECT row_number() OVER (ORDER BY id_student, {_ATTRS}) - 1 AS student_sk,
        id_student, {_ATTRS} FROM first""",
    "gold_fact_registration": """WITH f AS (SELECT s.id AS sid, m.m AS mid FROM orders o
          LEFT JOIN (SELECT DISTINCT o_custkey AS id FROM orders) s ON o.o_custkey = s.id
          LEFT JOIN (SELECT DISTINCT o_orderpriority AS m, year(o_orderdate) AS p FROM orders) m
            ON o.o_orderpriority = m.m AND year(o.o_orderdate) = m.p)
        SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE sid IS NULL) AS null_student_sk,
          COUNT(*) FILTER (WHERE mid IS NULL) AS null_module_sk,
          (SELECT COUNT(*) FROM orders) AS source_rows,
          (COUNT(*) FILTER (WHERE sid IS NULL) = 0 AND COUNT(*) FILTER (WHERE mid IS NULL) = 0
           AND COUNT(*) = (SELECT COUNT(*) FROM orders)) AS ok FROM f""",
}
