"""strata: set-based medallion analytics operators on Spark DataFrames.

Sub-packages
------------
sources    ingest, audit column, table layout, writes with observed counts
functions  Column builders: null-safe casts, cleaning, flags, measures
operators  DataFrame -> DataFrame operators: quality checks, roll-ups,
           dedup, dense keys, joins, statistics, security, maintenance,
           history (incremental / merge / SCD2), skew-safe sequencing
plans      the medallion pipeline, star-schema query layer, report result
           sets, legacy summary, diagnostics and the analysis of the
           engagement outcome
streaming  incremental file ingest with Structured Streaming
"""

from strata.errors import CheckFailed

__all__ = ["CheckFailed"]
