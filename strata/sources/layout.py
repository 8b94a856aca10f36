"""Where each layer's tables live, and how they are written.

A ``Layout`` names tables ``<layer>.<table>``.  With ``root`` set, a table
is a folder ``<root>/<layer>/<table>`` in ``fmt`` (parquet by default; any
installed format such as delta works); without it, tables go through the
session catalog as ``<layer>.<table>``.

Tables that are to appear together, after checks, go through
``sources.publish``; reads follow its manifest.

Writes are full reloads (overwrite) unless stated; every write attaches an
``Observation`` so the row count and NULL counts of the written data come
back from the write job itself, with no second scan.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_observed(df: DataFrame, writer, null_cols: tuple[str, ...] = (),
                   metrics: dict | None = None) -> dict:
    """Run ``writer(observed_df)`` and return {'rows': n, 'null_<c>': n, ...}
    plus any extra named aggregate ``metrics`` -- all from the write job."""
    obs = Observation(f"w{uuid.uuid4().hex[:10]}")
    metrics_cols = [F.count(F.lit(1)).alias("rows")]
    metrics_cols += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in null_cols]
    metrics_cols += [m.alias(k) for k, m in (metrics or {}).items()]
    metrics = metrics_cols
    writer(df.observe(obs, *metrics))
    return dict(obs.get)


@dataclass(frozen=True)
class Layout:
    root: str | None = None
    fmt: str = "parquet"

    def name(self, layer: str, table: str) -> str:
        return f"{layer}.{table}"

    def path(self, layer: str, table: str) -> str:
        if self.root is None:
            raise ValueError("catalog layout has no paths")
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def load(self, spark: SparkSession, entry: str | dict) -> DataFrame:
        """A folder named relative to the root, or partitions of several versions (``sources.partitioned``)."""
        root = self.root.rstrip("/")
        if isinstance(entry, str):
            return spark.read.format(self.fmt).load(f"{root}/{entry}")
        versions: dict[str, list[str]] = {}
        for version, folder, names in entry_folders(entry):
            versions.setdefault(version, []).extend([f"{root}/{folder}/{f}" for f in names] if names is not None else [f"{root}/{folder}"])
        frames = [spark.read.schema(entry["schema"]).format(self.fmt).option("basePath", f"{root}/{v}").load(paths) for v, paths in versions.items()]
        return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], entry["schema"])

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        """The published version (``sources.publish``) of a table, else the table written in place."""
        if self.root is None:
            return spark.table(self.name(layer, table))
        folder = read_manifest(spark, self)[1].get(self.name(layer, table))
        return self.load(spark, folder or f"{layer}/{table}")

    def write(self, df: DataFrame, layer: str, table: str, mode: str = "overwrite",
              null_cols: tuple[str, ...] = (), partition_by: tuple[str, ...] = (),
              metrics: dict | None = None, buckets: tuple[int, str] | None = None) -> dict:
        """Write ``df`` and return observed counts of what was written.

        ``buckets`` = (number, column) stores a catalog table hashed and sorted
        on the column: tables with the same number join on it without a shuffle.

        Spark refuses to overwrite a table the same plan reads, so a stage
        never writes its own input; layers are separate tables.  A published
        table is replaced by publishing, not in place.
        """
        if self.root is not None and self.name(layer, table) in read_manifest(df.sparkSession, self)[1]:
            raise ValueError(f"{self.name(layer, table)} is published: write it through a Publication")

        def _writer(d: DataFrame):
            w = d.write.format(self.fmt).mode(mode)
            if partition_by:
                w = w.partitionBy(*partition_by)
            if buckets:
                if self.root is not None:
                    raise ValueError("buckets need a catalog table")
                w = w.bucketBy(*buckets).sortBy(buckets[1])
            if self.root is None:
                d.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
                w.saveAsTable(self.name(layer, table))
            else:
                w.save(self.path(layer, table))
        return write_observed(df, _writer, null_cols, metrics)


def entry_folders(entry: str | dict) -> list[tuple[str, str, list[str] | None]]:
    """(version, folder, file names) of what a table consists of; no names: all files of the folder.

    A partition (``""`` for a table without) may be spread over several
    versions; ``files`` limits a folder to some of its files.
    """
    if isinstance(entry, str):
        return [(entry, entry, None)]
    out = []
    for part, held in sorted(entry["parts"].items()):
        for version in [held] if isinstance(held, str) else held:
            folder = f"{version}/{part}" if part else version
            out.append((version, folder, entry.get("files", {}).get(folder)))
    return out


def manifest_files(spark: SparkSession, layout: Layout) -> list[tuple[int, dict[str, str | dict]]]:
    """(number, {table: folder, or versions of its partitions}) of every complete manifest, the newest first."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(layout.root.rstrip("/"), "manifest")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    out = []
    for f in fs.listStatus(folder):
        name = f.getPath().getName()
        if not name.endswith(".json"):
            continue
        stream = fs.open(f.getPath())
        try:
            body = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        if body.endswith("}\n"):            # else it is being written
            out.append((int(name.removesuffix(".json")), json.loads(body)))
    return sorted(out, reverse=True)


def read_manifest(spark: SparkSession, layout: Layout) -> tuple[int, dict[str, str | dict]]:
    """Number and tables of the newest manifest; (0, {}) where nothing was published."""
    found = manifest_files(spark, layout)
    return found[0] if found else (0, {})


def write_many(layout, items: list[tuple], parallel: int = 4) -> dict[str, dict]:
    """Write independent tables concurrently; {table: observed counts}.

    ``items`` holds (df, layer, table[, kwargs]) tuples.  Each write is its
    own Spark job; submitting them from a few threads lets the scheduler run
    them side by side, so small tables do not leave most task slots idle.
    Results are the same as writing one after the other.  ``layout`` is a
    ``Layout`` or a ``Publication``.
    """
    if getattr(layout, "layout", layout).root is None:
        spark = items[0][0].sparkSession if items else None
        for layer in {it[1] for it in items}:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")

    def run(it):
        df, layer, table, *rest = it
        return table, layout.write(df, layer, table, **(rest[0] if rest else {}))
    if parallel <= 1 or len(items) <= 1:
        return dict(run(it) for it in items)
    with ThreadPoolExecutor(max_workers=min(parallel, len(items))) as pool:
        return dict(pool.map(run, items))
