"""Column lists and types per layer of the student-analytics pipeline."""

from __future__ import annotations

# Source table names and their raw (all-string) columns.
RAW_COLUMNS = {
    "assessments": ["code_module", "code_presentation", "id_assessment",
                    "assessment_type", "date", "weight"],
    "courses": ["code_module", "code_presentation", "module_presentation_length"],
    "studentAssessment": ["id_assessment", "id_student", "date_submitted",
                          "is_banked", "score"],
    "studentInfo": ["code_module", "code_presentation", "id_student", "gender", "region",
                    "highest_education", "imd_band", "age_band", "num_of_prev_attempts",
                    "studied_credits", "disability", "final_result"],
    "studentRegistration": ["code_module", "code_presentation", "id_student",
                            "date_registration", "date_unregistration"],
    "studentVle": ["code_module", "code_presentation", "id_student", "id_site", "date",
                   "sum_click"],
    "vle": ["id_site", "code_module", "code_presentation", "activity_type",
            "week_from", "week_to"],
}

# Silver casts per table ({column: kind}, see functions.casts).
SILVER_CASTS = {
    "studentInfo": {"studied_credits": "int", "num_of_prev_attempts": "int",
                    "_ingested_at": "timestamp"},
    "studentRegistration": {"date_registration": "int", "date_unregistration": "int",
                            "_ingested_at": "timestamp"},
    "assessments": {"date": "int", "weight": "double", "_ingested_at": "timestamp"},
    "courses": {"module_presentation_length": "int", "_ingested_at": "timestamp"},
    "vle": {"week_from": "int", "week_to": "int", "_ingested_at": "timestamp"},
    "studentVle": {"sum_click": "int", "date": "int", "_ingested_at": "timestamp"},
    "studentAssessment": {"score": "int", "date_submitted": "int", "is_banked": "flag",
                          "_ingested_at": "timestamp"},
}

# imd_band spelling fix found by the diagnostics.
IMD_BAND_CANONICAL = {"10-20": "10-20%"}

CLICK_KEYS = ["id_student", "code_module", "code_presentation", "id_site", "date"]
MODULE_KEY = ["code_module", "code_presentation"]
STUDENT_ATTRS = ["gender", "region", "highest_education", "imd_band", "age_band",
                 "disability"]
