"""Raw ingestion: CSV landing, table-to-table copies with an audit column.

Raw and Bronze are untyped: every column is a nullable string, so a bad
value never fails the load; types are imposed later, column by column.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.errors import CheckFailed
from strata.sources.layout import Layout

AUDIT_COL = "_ingested_at"

# CSV dialect of the raw landing files.
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": "\\",
    "recursiveFileLookup": "true",
}


def all_string_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_raw_csv(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """Read CSV files under ``path`` with an explicit all-string schema.

    No schema inference (it would scan the data twice and guess types);
    blank fields arrive as NULL.
    """
    reader = spark.read.schema(all_string_schema(columns))
    for k, v in CSV_OPTIONS.items():
        reader = reader.option(k, v)
    return reader.csv(path)


#: Why a line is not landed.
REASONS = ("unclosed quote", "short row", "long row")


def scan_csv(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """Lines of CSV files under ``path`` that are neither blank nor the header: ``file``, ``record`` (the line), ``reason``
    (one of ``REASONS``; NULL for a good line) and the columns, NULL in a rejected line.

    A line is judged from its text before it is parsed: the number of quotes
    that are not escaped, then the number of separators outside quotes.
    """
    columns = list(columns)
    sep, quote = CSV_OPTIONS["sep"], CSV_OPTIONS["quote"]
    lines = (spark.read.option("recursiveFileLookup", "true").text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "\r$", "").alias("record")))
    count = lambda text, what: F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))
    plain = F.regexp_replace("record", r"\\.", "")                       # without escaped characters
    outside = F.regexp_replace(plain, f"{quote}[^{quote}]*{quote}", "")     # without quoted text
    fields = count(outside, sep) + 1
    reason = (F.when(count(plain, quote) % 2 == 1, REASONS[0]).when(fields < len(columns), REASONS[1])
              .when(fields > len(columns), REASONS[2]))
    read = (lines.where((F.trim("record") != "") & (F.col("record") != sep.join(columns))).withColumn("reason", reason))
    options = {k: CSV_OPTIONS[k] for k in ("sep", "quote", "escape")}
    parsed = F.from_csv(F.when(F.col("reason").isNull(), F.col("record")), ", ".join(f"`{c}` string" for c in columns), options)
    return read.withColumn("_p", parsed).select("file", "record", "reason", *[F.col(f"_p.`{c}`").alias(c) for c in columns])


def land_csv(spark: SparkSession, path: str, columns: Iterable[str], layout: Layout, layer: str, table: str) -> dict:
    """Lands good lines (with the audit column) in ``table`` and the others in ``table_rejects`` with file and reason;
    raises ``CheckFailed`` unless read = landed + rejected.  Returns the three counts."""
    columns = list(columns)
    seen = Observation(f"csv_{table}")
    scanned = scan_csv(spark, path, columns)
    good = scanned.observe(seen, F.count(F.lit(1)).alias("read")).where(F.col("reason").isNull())
    landed = layout.write(with_audit(good.select(*columns)), layer, table)["rows"]
    bad = scanned.where(F.col("reason").isNotNull()).select("file", "reason", "record")
    rejected = layout.write(with_audit(bad), layer, f"{table}_rejects")["rows"]
    counts = {"read": seen.get["read"], "landed": landed, "rejected": rejected}
    if counts["read"] != landed + rejected:
        raise CheckFailed(f"{table}: lines were lost", counts)
    return counts


def with_audit(df: DataFrame, col: str = AUDIT_COL) -> DataFrame:
    """Add the load time; one value for the whole query."""
    return df.withColumn(col, F.current_timestamp())


def land(df: DataFrame, layout: Layout, layer: str, table: str) -> dict:
    """Append raw rows to a landing table (the first hop appends)."""
    return layout.write(df, layer, table, mode="append")


def copy_tables(spark: SparkSession, src: Layout, dst: Layout, tables: Iterable[str],
                src_layer: str, dst_layer: str, audit: bool = True) -> DataFrame:
    """Full copy (overwrite) of each table, adding the audit column.

    Returns a reconciliation report (table_name, source_rows, target_rows,
    match); target rows come from the write's own observation.
    """
    rows = []
    for t in tables:
        df = src.read(spark, src_layer, t)
        out = with_audit(df) if audit else df
        written = dst.write(out, dst_layer, t, mode="overwrite")["rows"]
        rows.append((t, written))
    written_df = inline_table(spark, rows, "table_name string, target_rows bigint")
    from strata.operators.quality import count_tables
    counts = count_tables({t: src.read(spark, src_layer, t) for t, _ in rows},
                          count_col="source_rows")
    return (counts.join(written_df, "table_name", "left")
            .withColumn("match", F.coalesce(F.col("source_rows") == F.col("target_rows"),
                                            F.lit(False))))


def inline_table(spark: SparkSession, rows, schema: str | T.StructType) -> DataFrame:
    """Small literal table with an explicit schema (e.g. a security map).

    Built from a pandas frame through Arrow, so it becomes a JVM-side local
    relation; a Python list would go through ``parallelize`` and start
    Python workers every time the plan runs.
    """
    import pandas as pd
    st = schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema
    pdf = pd.DataFrame(list(rows), columns=st.fieldNames())
    if pdf.empty:
        return spark.createDataFrame([], st)
    return spark.createDataFrame(pdf, st)
