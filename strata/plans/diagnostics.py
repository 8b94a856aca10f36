"""Source diagnostics run before choosing types and keys.

Each probe is a small aggregate DataFrame: row counts per table, distinct
students per table, registrations missing on either side, the profile of a
slicing column and the share of withdrawals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.clean import presence_label
from strata.operators.quality import anti_counts, count_tables, profile

KEY3 = ["id_student", "code_module", "code_presentation"]


def diagnostics(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    distinct_students = reduce(DataFrame.unionByName, [
        raw[t].agg(F.count_distinct("id_student").alias("unique_students"))
        .select(F.lit(t).alias("table_name"), "unique_students")
        for t in ("studentRegistration", "studentInfo")])
    return {
        "table_counts": count_tables(raw),
        "distinct_students": distinct_students,
        "registration_orphans": anti_counts(raw["studentRegistration"], raw["studentInfo"],
                                            KEY3, "reg", "info"),
        "imd_band_profile": profile(raw["studentInfo"], "imd_band", "imd_band",
                                    "imd_count", "pct").orderBy(F.desc("imd_count"),
                                                                "imd_band"),
        "registration_status": profile(raw["studentRegistration"],
                                       presence_label("date_unregistration"),
                                       "registration_status", "status_count",
                                       "status_percentage"),
    }
