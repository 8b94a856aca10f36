"""Verify, then publish: tables become visible together, after their checks.

A ``Publication`` writes each table into a new folder of its own under
``<root>/versions`` and leaves what readers see alone.  ``publish()`` then adds
one manifest under ``<root>/manifest`` that names the folder of every table;
``Layout.read`` follows the newest manifest.  A job that fails a check, or dies,
publishes nothing, and readers keep the tables they had.

A manifest is one small file, created under the next free number without
overwriting: of two jobs that started from the same state the second fails.  A
file that is not complete yet is passed over by readers.  ``vacuum`` removes
folders that only manifests older than the last few name.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from strata.errors import CheckFailed
from strata.sources.layout import Layout, entry_folders, manifest_files, read_manifest, write_observed


class Publication:
    """New versions of a layout's tables, visible to this object at once and to readers after ``publish``.

    On a layout of catalog tables, which have no folders to switch, it writes in place.
    """

    def __init__(self, spark: SparkSession, layout: Layout):
        self.spark, self.layout = spark, layout
        self.run = uuid.uuid4().hex[:12]
        self.number, self.tables = read_manifest(spark, layout) if layout.root else (0, {})
        self.staged: dict[str, str | dict] = {}

    def write(self, df: DataFrame, layer: str, table: str, null_cols: tuple[str, ...] = (), partition_by: tuple[str, ...] = (),
              metrics: dict | None = None) -> dict:
        """As ``Layout.write``; returns the counts observed in the write."""
        if self.layout.root is None:
            return self.layout.write(df, layer, table, null_cols=null_cols, partition_by=partition_by, metrics=metrics)
        name = self.layout.name(layer, table)
        folder = f"versions/{layer}/{table}/{self.run}-{len(self.staged)}"

        def writer(d: DataFrame) -> None:
            w = d.write.format(self.layout.fmt).mode("errorifexists")
            (w.partitionBy(*partition_by) if partition_by else w).save(f"{self.layout.root.rstrip('/')}/{folder}")

        counts = write_observed(df, writer, null_cols, metrics)
        self.staged[name] = folder
        return counts

    def read(self, layer: str, table: str) -> DataFrame:
        """The staged version, or what readers see where there is none."""
        folder = self.staged.get(self.layout.name(layer, table))
        return self.layout.load(self.spark, folder) if folder else self.layout.read(self.spark, layer, table)

    def publish(self) -> int:
        """Makes all staged tables visible together; returns the manifest's number."""
        if self.layout.root is None:
            return 0
        fs, folder = _folder(self.spark, self.layout)
        body = json.dumps({**self.tables, **self.staged}, sort_keys=True) + "\n"
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"{self.number + 1:010d}.json")
        fs.mkdirs(folder)
        if fs.exists(path):
            raise CheckFailed("tables were published meanwhile", {"manifest": self.number + 1})
        out = fs.create(path, False)            # fails where the file exists
        out.write(body.encode())
        out.close()
        self.number, self.tables, self.staged = self.number + 1, {**self.tables, **self.staged}, {}
        return self.number


def _folder(spark: SparkSession, layout: Layout):
    folder = spark._jvm.org.apache.hadoop.fs.Path(layout.root.rstrip("/"), "manifest")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def vacuum(spark: SparkSession, layout: Layout, keep: int = 2) -> list[str]:
    """Removes the folders that none of the last ``keep`` manifests names, and the manifests before them.

    Folders of a job that has not published yet are in no manifest and stay, as
    do replaced small files of a folder whose other files are in use.
    """
    fs, folder = _folder(spark, layout)
    files = manifest_files(spark, layout)
    used = {f for _, tables in files[:keep] for e in tables.values() for _, f, _ in entry_folders(e)}
    old = sorted({f for _, tables in files[keep:] for e in tables.values() for _, f, _ in entry_folders(e)} - used)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for f in old:
        fs.delete(path(f"{layout.root.rstrip('/')}/{f}"), True)
    for n, _ in files[keep:]:
        fs.delete(path(folder, f"{n:010d}.json"), False)
    return old
