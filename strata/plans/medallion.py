"""The student-analytics medallion pipeline, built from the operators.

raw CSV --land--> raw tables --copy + audit--> Bronze --type/clean/flag/
quarantine/roll-up--> Silver --dedup/keys/star joins--> Gold

Each stage returns DataFrames (lazy plans); ``run_pipeline`` writes them
as new versions with observed counts and stops at the first failed check with
``CheckFailed`` carrying the numbers.  Only after the last check do Silver and
Gold become visible, together; until then readers see the versions before.
Every write is a full reload, so running the pipeline twice gives the same
tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.errors import CheckFailed
from strata.functions.casts import cast_columns
from strata.functions.clean import canonicalise, impute_blank, presence_flag
from strata.operators.dedup import keep_first
from strata.operators.joins import lookup_key
from strata.operators.keys import build_dimension
from strata.operators.quality import score_in_range, split_by_rule, split_report
from strata.operators.rollup import rollup_events
from strata.plans.schemas import (CLICK_KEYS, IMD_BAND_CANONICAL, MODULE_KEY,
                                  RAW_COLUMNS, SILVER_CASTS, STUDENT_ATTRS)
from strata.sources.ingest import inline_table, read_raw_csv, with_audit
from strata.sources.layout import Layout, write_many
from strata.sources.publish import Publication

SECURITY_MAP_SCHEMA = "user_email string, region string"


# -- Silver ------------------------------------------------------------------

def silver_student_info(df: DataFrame) -> DataFrame:
    df = cast_columns(df, SILVER_CASTS["studentInfo"])
    return df.withColumn("imd_band", canonicalise(impute_blank("imd_band"), IMD_BAND_CANONICAL))


def silver_registration(df: DataFrame) -> DataFrame:
    # Flag from the raw text first, then cast.
    df = df.withColumn("is_withdrawn", presence_flag("date_unregistration"))
    return cast_columns(df, SILVER_CASTS["studentRegistration"])


def silver_clicks(df: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Clicks rolled up; ``seen`` observes rows and clicks of the typed input in the job that uses the result."""
    typed = cast_columns(df, SILVER_CASTS["studentVle"])
    if seen is not None:
        typed = typed.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(F.col("sum_click").cast("bigint")).alias("clicks"))
    return rollup_events(typed, CLICK_KEYS, "sum_click", "total_clicks", "event_count")


def silver_assessment_split(df: DataFrame, seen: Observation | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Valid rows, quarantined rows and the report; ``seen`` observes the rows of the typed input."""
    typed = cast_columns(df, SILVER_CASTS["studentAssessment"])
    if seen is not None:
        typed = typed.observe(seen, F.count(F.lit(1)).alias("rows"))
    rule = score_in_range("score", 0, 100)
    valid, invalid = split_by_rule(typed, rule)
    return valid, invalid, split_report(typed, rule)


def silver(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    valid, invalid, _ = silver_assessment_split(bronze["studentAssessment"])
    return {
        "studentInfo": silver_student_info(bronze["studentInfo"]),
        "studentRegistration": silver_registration(bronze["studentRegistration"]),
        "assessments": cast_columns(bronze["assessments"], SILVER_CASTS["assessments"]),
        "courses": cast_columns(bronze["courses"], SILVER_CASTS["courses"]),
        "vle": cast_columns(bronze["vle"], SILVER_CASTS["vle"]),
        "studentVle": silver_clicks(bronze["studentVle"]),
        "studentAssessment": valid,
        "studentAssessment_quarantine": invalid,
    }


# -- Gold --------------------------------------------------------------------

def dim_student(student_info: DataFrame) -> DataFrame:
    """One row per student: the earliest presentation's attributes.

    Ties (one student in two modules of the same presentation) are broken
    by module and then by the attributes, so the pick is deterministic.
    """
    first = keep_first(student_info.select("id_student", *MODULE_KEY, *STUDENT_ATTRS),
                       "id_student", ["code_presentation", "code_module", *STUDENT_ATTRS])
    return build_dimension(first, ["id_student"], STUDENT_ATTRS, "student_sk")


def dim_module(courses: DataFrame) -> DataFrame:
    return build_dimension(courses, MODULE_KEY, ["module_presentation_length"], "module_sk")


def dim_assessment(assessments: DataFrame) -> DataFrame:
    return build_dimension(assessments, ["id_assessment"],
                           ["code_module", "code_presentation", "assessment_type", "date",
                            "weight"], "assessment_sk")


def fact_assessment(scores: DataFrame, students: DataFrame, assessments: DataFrame) -> DataFrame:
    f = lookup_key(scores, students, "id_student", "student_sk")
    f = lookup_key(f, assessments, "id_assessment", "assessment_sk")
    return f.select("student_sk", "assessment_sk", "score", "is_banked", "date_submitted")


def fact_vle(clicks: DataFrame, students: DataFrame, modules: DataFrame) -> DataFrame:
    # The few modules first: their key takes the place of two texts before rows are dealt by student.
    f = lookup_key(clicks, modules, MODULE_KEY, "module_sk").drop(*MODULE_KEY)
    f = lookup_key(f, students, "id_student", "student_sk")
    return f.select("student_sk", "module_sk", "total_clicks", "event_count")


def fact_registration(reg: DataFrame, students: DataFrame, modules: DataFrame) -> DataFrame:
    # The few modules first: their key takes the place of two texts before rows are dealt by student.
    f = lookup_key(reg, modules, MODULE_KEY, "module_sk").drop(*MODULE_KEY)
    f = lookup_key(f, students, "id_student", "student_sk")
    return f.select("student_sk", "module_sk", "is_withdrawn", "date_registration",
                    "date_unregistration")


def gold(silver_tables: dict[str, DataFrame], security_rows=(), spark=None) -> dict[str, DataFrame]:
    s = silver_tables
    ds = dim_student(s["studentInfo"])
    dm = dim_module(s["courses"])
    da = dim_assessment(s["assessments"])
    out = {
        "dim_student": ds,
        "dim_module": dm,
        "dim_assessment": da,
        "fact_assessment": fact_assessment(s["studentAssessment"], ds, da),
        "fact_vle": fact_vle(s["studentVle"], ds, dm),
        "fact_registration": fact_registration(s["studentRegistration"], ds, dm),
    }
    spark = spark or ds.sparkSession
    out["security_region_map"] = inline_table(spark, security_rows, SECURITY_MAP_SCHEMA)
    return out


# -- run ---------------------------------------------------------------------

def ingest_csv(spark: SparkSession, raw_dir: str, layout: Layout) -> dict:
    """Land every raw CSV folder ``<raw_dir>/<table>`` into Bronze (overwrite),
    with the audit column; returns observed row counts per table."""
    items = [(with_audit(read_raw_csv(spark, f"{raw_dir.rstrip('/')}/{t}", cols)), "bronze", t)
             for t, cols in RAW_COLUMNS.items()]
    return {t: w["rows"] for t, w in write_many(layout, items).items()}


def run_pipeline(spark: SparkSession, layout: Layout, security_rows=(),
                 source: Layout | None = None, source_layer: str = "raw",
                 partition_clicks_by: tuple[str, ...] = ()) -> dict:
    """Bronze -> Silver -> Gold with checks; returns the check numbers.

    With ``source`` given, Bronze is a full copy of ``source``'s tables plus
    the audit column and is reconciled against it; otherwise Bronze must
    already exist in ``layout``.  ``partition_clicks_by`` (e.g.
    ``("code_presentation",)``) lays the Silver click table out in folders
    per value, so readers filtering on it prune folders; there is no
    repartition before the write, so a value holding a third of the rows is
    still written by all tasks.
    """
    report: dict = {}
    if source is not None:
        from strata.operators.quality import require_all_rows
        from strata.sources.ingest import copy_tables
        rec = copy_tables(spark, source, layout, RAW_COLUMNS, source_layer, "bronze")
        report["bronze"] = require_all_rows(rec, "match", "bronze reconciliation")

    bronze = {t: layout.read(spark, "bronze", t) for t in RAW_COLUMNS}
    new = Publication(spark, layout)
    sv = silver(bronze)
    written = write_many(new, [(sv[t], "silver", t) for t in
                               ("studentInfo", "studentRegistration", "assessments", "courses", "vle")])

    # Click roll-up: source rows and clicks are observed on the typed input
    # inside the same job that writes the roll-up -- no second scan.
    clicks_in = Observation("clicks_in")
    totals = written["studentVle"] = new.write(
        silver_clicks(bronze["studentVle"], clicks_in), "silver", "studentVle", partition_by=partition_clicks_by,
        metrics={"events": F.sum("event_count"), "clicks": F.sum("total_clicks")})
    src = clicks_in.get
    if totals["events"] != src["rows"] or totals["clicks"] != src["clicks"]:
        raise CheckFailed("click roll-up lost rows", {
            "source_rows": src["rows"], "events": totals["events"],
            "source_clicks": src["clicks"], "rolled_clicks": totals["clicks"]})

    # Quarantine split: the source count is observed by the valid-rows write.
    scores_in = Observation("scores_in")
    valid, _, _ = silver_assessment_split(bronze["studentAssessment"], scores_in)
    written["studentAssessment"] = new.write(valid, "silver", "studentAssessment")
    written["studentAssessment_quarantine"] = new.write(sv["studentAssessment_quarantine"], "silver", "studentAssessment_quarantine")
    split_total = written["studentAssessment"]["rows"] + written["studentAssessment_quarantine"]["rows"]
    if split_total != scores_in.get["rows"]:
        raise CheckFailed("quarantine split lost rows", {
            "source_rows": scores_in.get["rows"], "valid+invalid": split_total})
    sv_read = {t: new.read("silver", t) for t in written}
    report["silver"] = {t: w["rows"] for t, w in written.items()}
    report["silver"]["click_events_out"] = totals["events"]
    report["silver"]["click_rows_in"] = src["rows"]

    g = gold(sv_read, security_rows, spark)
    gw = write_many(new, [(g[t], "gold", t) for t in
                          ("dim_student", "dim_module", "dim_assessment", "security_region_map")])
    gd = {t: new.read("gold", t) for t in ("dim_student", "dim_module", "dim_assessment")}
    ds_rows, ds_keys = gd["dim_student"].agg(F.count(F.lit(1)), F.count_distinct("id_student")).collect()[0]
    if ds_rows != ds_keys:
        raise CheckFailed("dim_student has duplicate students",
                          {"rows": ds_rows, "distinct": ds_keys})
    facts = {
        "fact_assessment": (fact_assessment(sv_read["studentAssessment"], gd["dim_student"],
                                            gd["dim_assessment"]),
                            ("student_sk", "assessment_sk"),
                            written["studentAssessment"]["rows"]),
        "fact_vle": (fact_vle(sv_read["studentVle"], gd["dim_student"], gd["dim_module"]),
                     ("student_sk", "module_sk"), written["studentVle"]["rows"]),
        "fact_registration": (fact_registration(sv_read["studentRegistration"],
                                                gd["dim_student"], gd["dim_module"]),
                              ("student_sk", "module_sk"),
                              written["studentRegistration"]["rows"]),
    }
    # Rows and NULL keys come from each write's own observation.
    fw = write_many(new, [(df, "gold", t, {"null_cols": sks})
                          for t, (df, sks, _) in facts.items()])
    for t, (_, _, expected) in facts.items():
        w = fw[t]
        gw[t] = w
        bad = {k: v for k, v in w.items() if k.startswith("null_") and v}
        if bad or w["rows"] != expected:
            raise CheckFailed(f"{t}: orphan keys or fan-out",
                              {"rows": w["rows"], "expected": expected, **w})
    report["gold"] = {t: w["rows"] for t, w in gw.items()}
    # All checks hold: Silver and Gold become visible together.
    report["manifest"] = new.publish()
    return report


#: Tables that are joined on the student's key.
BY_STUDENT = ("dim_student", "fact_assessment", "fact_vle", "fact_registration")


def store_colocated(spark: SparkSession, gold_tables: dict[str, DataFrame], layer: str = "gold", buckets: int | None = None) -> dict[str, DataFrame]:
    """Gold as catalog tables, the student dimension and the facts hashed on ``student_sk`` into as many buckets.

    Row-level security, lookups of student attributes and counts per student
    then join in place: each task reads the same bucket of both tables.  The
    number of buckets (by default the shuffle partitions) bounds the tasks of
    such a join.  Rows are dealt to buckets before the write, so there is a file
    per bucket.
    """
    lake = Layout()
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for t, df in gold_tables.items():
        if t in BY_STUDENT:
            lake.write(df.repartition(buckets, "student_sk"), layer, t, buckets=(buckets, "student_sk"))
        else:
            lake.write(df, layer, t)
    return {t: lake.read(spark, layer, t) for t in gold_tables}


def read_gold(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    names = ["dim_student", "dim_module", "dim_assessment", "fact_assessment", "fact_vle",
             "fact_registration", "security_region_map"]
    return {t: layout.read(spark, "gold", t) for t in names}
