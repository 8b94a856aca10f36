"""The legacy one-table student summary, and its parallel-run comparison.

One row per registration (student info LEFT JOIN registration on student,
module and presentation) carrying per-student aggregates -- average score
and total clicks -- repeated on each of the student's rows: the mixed
grain of the original single-statement transform.  The correlated scalar
subqueries are expressed as per-student pre-aggregates joined on the
student id (NULL for students without rows), which is also what Catalyst
turns such subqueries into.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.casts import to_double, to_int
from strata.functions.clean import impute_blank, presence_int
from strata.operators.skew import hot_keys, salted_lookup

KEY3 = ["id_student", "code_module", "code_presentation"]


def legacy_summary(info: DataFrame, reg: DataFrame, scores: DataFrame, clicks: DataFrame,
                   digits: int | None = 2) -> DataFrame:
    avg = F.avg(to_double("score"))
    per_student_score = scores.groupBy("id_student").agg(
        (F.round(avg, digits) if digits is not None else avg).alias("avg_score"))
    per_student_clicks = clicks.groupBy("id_student").agg(
        F.sum(to_int("sum_click")).cast("int").alias("total_clicks"))
    per_student = per_student_score.join(per_student_clicks, "id_student", "full")
    base = info.join(reg.select(*KEY3, "date_registration", "date_unregistration"), KEY3, "left")
    # A student with very many rows is spread; the narrow table names the hot ones.
    return (salted_lookup(base, per_student, ["id_student"], hot=hot_keys(info, ["id_student"]))
            .select("id_student", "gender", "region", "highest_education", "age_band",
                    impute_blank("imd_band").alias("imd_band"),
                    to_int("date_registration").alias("date_registration"),
                    presence_int("date_unregistration").alias("is_withdrawn"),
                    "avg_score", "total_clicks"))
