"""From raw documents to packed training sequences.

Each stage reads what the one before wrote as Parquet in the shared folder,
works on all of it, and its decisions take effect in what it returns.  An
empty table, null columns and repeated rows pass as the operators define.  A
stage's table is removed once the next one is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm.line_dedup import stage_lines
from strata.llm.minhash import stage_near_duplicates
from strata.llm.packing import stage_pack
from strata.llm.pii import stage_pii
from strata.llm.quality_rules import stage_quality
from strata.session import scratch_path

STAGES = [("quality_rules", stage_quality), ("line_dedup", stage_lines), ("minhash_near_dedup", stage_near_duplicates),
          ("pii", stage_pii), ("best_fit_packing", stage_pack)]

#: SQL cannot express the stages (boosted trees, tokenizer); tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:          # what the stage read is in what it wrote
            folder = spark._jvm.org.apache.hadoop.fs.Path(before)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        before = path
    return docs
