"""Table maintenance: file statistics and small-file compaction.

* ``folder_stats`` -- files, empty ones included, small files and bytes per
  folder, from a listing that Spark deals out; no file is opened.
* ``compact_small`` -- of a published table, rewrites only the small files of
  folders that have several, keeps partition folders and large files as they are,
  and switches the manifest when the rows written are the rows read.
* ``compact`` -- a whole folder into another:

Without a transactional table format, compaction writes the table afresh
to a new folder sized by a target file size, verifies the row count from
the write's own observation, and returns the new location; the caller
swaps its pointer (catalog location or config).  With Delta present,
``OPTIMIZE`` does the same in place.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.errors import CheckFailed
from strata.sources.layout import Layout, entry_folders, write_observed
from strata.sources.publish import Publication


def file_stats(df: DataFrame) -> DataFrame:
    """Number of files and bytes behind a file-based DataFrame."""
    return (df.select(F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_size").alias("file_size"))
            .distinct()
            .agg(F.count(F.lit(1)).alias("files"),
                 F.sum("file_size").cast("bigint").alias("bytes")))


def compact(spark: SparkSession, path: str, out_path: str, fmt: str = "parquet",
            target_file_bytes: int = 128 * 1024 * 1024) -> DataFrame:
    """Rewrite ``path`` into ~``target_file_bytes`` files at ``out_path``.

    Returns a one-row before/after report (files, bytes, rows).  The file
    count is derived from bytes, so each task writes one file of about the
    target size; ``coalesce`` would keep the upstream partitioning's skew,
    so a round-robin ``repartition`` evens the output files.
    """
    src = spark.read.format(fmt).load(path)
    before = file_stats(src).collect()[0]
    n_files = max(1, math.ceil((before["bytes"] or 0) / target_file_bytes))
    written = write_observed(
        src.repartition(n_files),
        lambda d: d.write.format(fmt).mode("errorifexists").save(out_path))["rows"]
    after_df = spark.read.format(fmt).load(out_path)
    rows_before = src.count()
    if rows_before != written:
        raise CheckFailed(f"compaction changed row count {rows_before} -> {written}",
                          {"rows_before": rows_before, "rows_after": written})
    after = file_stats(after_df)
    return after.select(F.lit(before["files"]).cast("bigint").alias("files_before"),
                        F.col("files").alias("files_after"),
                        F.lit(before["bytes"]).cast("bigint").alias("bytes_before"),
                        F.col("bytes").alias("bytes_after"),
                        F.lit(rows_before).cast("bigint").alias("rows_before"),
                        F.lit(written).cast("bigint").alias("rows_after"))


def _listing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(folder, file, bytes) of all data files below ``paths``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)      # contents are not read
    return files.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), F.substring_index("path", "/", -1).alias("file"),
                        F.col("length").alias("bytes")).where(~F.col("file").rlike("^[_.]"))


def folder_stats(spark: SparkSession, path: str, target_file_bytes: int = 128 * 1024 * 1024) -> DataFrame:
    """Per folder: files, files of under half the target, and bytes."""
    small = F.col("bytes") < target_file_bytes / 2
    return (_listing(spark, [path]).groupBy("folder")
            .agg(F.count(F.lit(1)).alias("files"), F.count_if(small).alias("small_files"), F.sum("bytes").alias("bytes"),
                 F.sum(F.when(small, F.col("bytes")).otherwise(0)).alias("small_bytes")))


def compact_small(spark: SparkSession, layout: Layout, layer: str, table: str, target_file_bytes: int = 128 * 1024 * 1024) -> dict:
    """Bin-packs the small files of each folder of a published table into files of about the target size.

    Returns files before and after, rows moved and folders rewritten.  Readers
    see the files before or those after, never both; raises ``CheckFailed``
    before the switch if the rows differ.
    """
    name, root = layout.name(layer, table), layout.root.rstrip("/")
    out = Publication(spark, layout)
    entry = out.tables[name]
    held = entry_folders(entry)
    found = _listing(spark, [f"{root}/{f}" for _, f, _ in held]).collect()          # names only, as many as Spark lists to read the table
    files: dict[str, list[tuple[str, int]]] = {}
    for r in found:
        folder = "versions/" + r["folder"].partition("/versions/")[2]
        files.setdefault(folder, []).append((r["file"], r["bytes"]))
    live, parts, moved = {}, {}, {}
    for version, folder, names in held:
        for sub, group in files.items():
            if sub != folder and not sub.startswith(folder + "/"):
                continue
            part = sub.removeprefix(version).strip("/")
            group = [x for x in group if names is None or x[0] in names]
            small = [x for x in group if x[1] < target_file_bytes / 2]
            keep = [f for f, _ in group if len(small) < 2 or f not in dict(small)]
            if len(keep) < len(group):
                moved[(version, sub, part)] = small
            if keep:
                parts.setdefault(part, []).append(version)
                live[sub] = keep
    before = sum(len(n) for n in live.values()) + sum(len(m) for m in moved.values())
    if not moved:
        return {"files_before": before, "files_after": before, "rows": 0, "folders": []}
    frames, bins = [], {}
    for version in sorted({v for v, _, _ in moved}):
        paths = [f"{root}/{sub}/{f}" for (v, sub, _), small in moved.items() if v == version for f, _ in small]
        reader = spark.read.schema(layout.load(spark, entry).schema).format(layout.fmt)
        frames.append(reader.option("basePath", f"{root}/{version}").load(paths))
    for (_, _, part), small in moved.items():
        bins[part] = bins.get(part, 0) + sum(b for _, b in small)
    rows = reduce(DataFrame.unionByName, frames)
    by = [p.partition("=")[0] for p in next(iter(bins)).split("/") if p]
    seen = Observation(f"small_{uuid.uuid4().hex[:8]}")
    source = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    most = max(math.ceil(b / target_file_bytes) for b in bins.values())
    if by:
        # as many files as the largest folder needs: a row's bin spreads each folder over that many tasks at most
        spread = F.pmod(F.xxhash64(*[c for c in rows.columns if c not in by]), F.lit(most))
        source = source.repartition(*by, spread)
    else:
        source = source.repartition(most)
    version = f"versions/{layer}/{table}/{out.run}"

    def writer(d: DataFrame) -> None:
        w = d.write.format(layout.fmt).mode("errorifexists")
        (w.partitionBy(*by) if by else w).save(f"{root}/{version}")

    wrote = write_observed(source, writer)["rows"]
    if wrote != seen.get["rows"]:
        raise CheckFailed(f"{name}: compaction changed the rows", {"rows_before": seen.get["rows"], "rows_after": wrote})
    added = _listing(spark, [f"{root}/{version}"]).groupBy("folder").count().collect()
    for r in added:
        part = ("versions/" + r["folder"].partition("/versions/")[2]).removeprefix(version).strip("/")
        parts.setdefault(part, []).append(version)
    old = entry if isinstance(entry, dict) else {}
    columns = [c for c in rows.columns if c not in by] + by
    out.staged[name] = {**old, "parts": parts, "files": live,
                        "schema": ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns)}
    out.publish()
    return {"files_before": before, "files_after": sum(len(n) for n in live.values()) + sum(r["count"] for r in added), "rows": wrote,
            "folders": sorted({p for _, _, p in moved})}
