"""Measures and report result sets of the student-analytics star.

``student_star(gold)`` wires the Gold tables into a ``Star`` with the
eleven named measures plus the implicit column sums; ``REPORTS`` lists the
report tiles as (measures, slice columns, order).  ``report(star, key)``
returns one result set as a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import measures as M
from strata.plans.star import Measure, Ratio, Relationship, Security, Star

# Referential integrity is assumed on five of the six relationships (the
# click fact -> student one is not); the Gold load checks it for all.
RELATIONSHIPS = (
    Relationship("fact_assessment", "assessment_sk", "dim_assessment", "assessment_sk", True),
    Relationship("fact_vle", "module_sk", "dim_module", "module_sk", True),
    Relationship("fact_vle", "student_sk", "dim_student", "student_sk", False),
    Relationship("fact_assessment", "student_sk", "dim_student", "student_sk", True),
    Relationship("fact_registration", "student_sk", "dim_student", "student_sk", True),
    Relationship("fact_registration", "module_sk", "dim_module", "module_sk", True),
)


def student_measures(pass_threshold: float = 40, digits: int | None = 2) -> dict:
    ms = [
        Measure("total_students", "dim_student", lambda: M.distinct_count("id_student")),
        Measure("avg_score", "fact_assessment", lambda: M.average("score")),
        Measure("total_assessments", "fact_assessment", M.row_count),
        Measure("total_clicks", "fact_vle", lambda: M.total("total_clicks")),
        # A filter on the score of its own: a slice by score does not reach it.
        Measure("passed", "fact_assessment", lambda: M.flag_count(F.col("score") >= pass_threshold),
                replaces=("fact_assessment.score",)),
        Ratio("pass_rate", "passed", "total_assessments", digits),
        Measure("weighted_score", "fact_assessment",
                lambda: M.weighted_score("score", "weight", digits),
                needs=("dim_assessment.weight",)),
        Measure("total_registrations", "fact_registration", M.row_count),
        Measure("withdrawal_count", "fact_registration",
                lambda: M.flag_count("is_withdrawn", blank_when_zero=True),
                replaces=("fact_registration.is_withdrawn",)),
        Ratio("withdrawal_rate", "withdrawal_count", "total_registrations", digits),
        Ratio("avg_clicks_per_student", "total_clicks", "total_students"),
        Ratio("avg_clicks_per_registration", "total_clicks", "total_registrations"),
        # Alternative to the literal per-student average: students with clicks
        # in the slice, not all students.
        Measure("active_students", "fact_vle", lambda: M.distinct_count("student_sk")),
        Ratio("avg_clicks_per_active_student", "total_clicks", "active_students"),
        # Implicit default-sum measures of numeric columns.
        Measure("score_sum", "fact_assessment", lambda: M.total("score")),
        Measure("date_submitted_sum", "fact_assessment", lambda: M.total("date_submitted")),
        Measure("event_count_sum", "fact_vle", lambda: M.total("event_count")),
        Measure("date_registration_sum", "fact_registration", lambda: M.total("date_registration")),
        Measure("date_unregistration_sum", "fact_registration",
                lambda: M.total("date_unregistration")),
        Measure("module_length_sum", "dim_module",
                lambda: M.total("module_presentation_length")),
    ]
    return {m.name: m for m in ms}


def student_star(gold: dict[str, DataFrame], pass_threshold: float = 40,
                 digits: int | None = 2, secure: bool = True) -> Star:
    dims = {k: gold[k] for k in ("dim_student", "dim_module", "dim_assessment")}
    facts = {k: gold[k] for k in ("fact_assessment", "fact_vle", "fact_registration")}
    security = (Security("dim_student", "region", gold["security_region_map"])
                if secure and "security_region_map" in gold else None)
    return Star(dims, facts, RELATIONSHIPS, student_measures(pass_threshold, digits), security)


D = True  # descending
# Report tiles: key -> (measures, slice columns, order)
REPORTS = {
    "kpi_withdrawal_rate": (["withdrawal_rate"], [], []),
    "kpi_withdrawal_count": (["withdrawal_count"], [], []),
    "kpi_total_registrations": (["total_registrations"], [], []),
    "withdrawal_rate_by_region": (["withdrawal_rate"], ["dim_student.region"],
                                  [("withdrawal_rate", D)]),
    # Literal form: sliced by an unrelated dimension, every bar is the total.
    "registrations_by_assessment_module": (["total_registrations"],
                                           ["dim_assessment.code_module"],
                                           [("total_registrations", D)]),
    "registrations_by_module": (["total_registrations"], ["dim_module.code_module"],
                                [("total_registrations", D)]),
    "kpi_avg_clicks_per_student": (["avg_clicks_per_student"], [], []),
    "kpi_total_students": (["total_students"], [], []),
    "kpi_total_clicks": (["total_clicks"], [], []),
    "students_by_age_band": (["total_students"], ["dim_student.age_band"],
                             [("total_students", D)]),
    "students_by_region": (["total_students"], ["dim_student.region"],
                           [("total_students", D)]),
    "kpi_weighted_score": (["weighted_score"], [], []),
    "kpi_total_assessments": (["total_assessments"], [], []),
    "kpi_pass_rate": (["pass_rate"], [], []),
    "kpi_avg_score": (["avg_score"], [], []),
    "avg_score_by_module": (["avg_score"], ["dim_assessment.code_module"],
                            [("avg_score", D)]),
    "score_sum_by_score": (["score_sum"], ["fact_assessment.score"], [("score_sum", D)]),
    "score_count_by_score": (["total_assessments"], ["fact_assessment.score"], []),
    "withdrawal_rate_by_imd_band": (["withdrawal_rate"], ["dim_student.imd_band"], []),
    "withdrawal_rate_by_education": (["withdrawal_rate"],
                                     ["dim_student.highest_education"], []),
    "avg_clicks_per_student_by_module": (["avg_clicks_per_student"],
                                         ["dim_module.code_module"], []),
    "avg_clicks_per_active_student_by_module": (["avg_clicks_per_active_student"],
                                                ["dim_module.code_module"], []),
    "students_by_education": (["total_students"], ["dim_student.highest_education"], []),
    "pass_rate_by_module": (["pass_rate"], ["dim_assessment.code_module"], []),
    "avg_score_by_assessment_type": (["avg_score"], ["dim_assessment.assessment_type"], []),
    "avg_clicks_per_registration_by_module": (["avg_clicks_per_registration"],
                                              ["dim_module.code_module"], []),
}


def report(star: Star, key: str, principal=None, limit: int | None = None) -> DataFrame:
    measures, by, order = REPORTS[key]
    return star.query(measures, by, principal=principal, order=order, limit=limit)


def engagement_outcome(gold: dict[str, DataFrame]) -> DataFrame:
    """Per registration: withdrawn flag and the student's clicks in that
    module (clicks summed to the registration grain before the join)."""
    from strata.operators.joins import preaggregate_join
    reg = gold["fact_registration"].select("student_sk", "module_sk", "is_withdrawn")
    return preaggregate_join(reg, gold["fact_vle"], ["student_sk", "module_sk"],
                             "total_clicks", "total_clicks", 0, "bigint")


def engagement_analysis(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Distribution, correlation test and group medians of the outcome set."""
    from strata.operators.stats import (box_stats, median_by, point_biserial_test,
                                        summary)
    eo = engagement_outcome(gold)
    return {
        "outcome": eo,
        "withdrawn_counts": eo.groupBy("is_withdrawn").agg(F.count(F.lit(1)).alias("n")),
        "clicks_summary": summary(eo, "total_clicks"),
        "correlation": point_biserial_test(eo, "is_withdrawn", "total_clicks"),
        "median_clicks": median_by(eo, "total_clicks", ["is_withdrawn"], "median_clicks"),
        "box": box_stats(eo, "total_clicks", ["is_withdrawn"]),
    }
