"""Connected components by minimum labels with pointer jumping."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, lean, partitions, release

#: Nodes whose links a task holds at once.
HELD = 100_000


def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that connect what a task's links (a, b) connect, in both directions, each node with one of its neighbourhood:
    paths within a task get short."""
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    def stars() -> pa.RecordBatch:
        pairs = [p for x in parent if (r := root(x)) != x for p in ((r, x), (x, r))]
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], kind) for i in (0, 1)], ["a", "b"])

    for batch in batches:
        kind = batch.schema.field(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if (x := root(a)) != (y := root(b)):
                parent[max(x, y)] = min(x, y)
        if len(parent) > HELD:
            yield stars()
            parent.clear()
    if parent:
        yield stars()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, first, root, root_first): the smallest (first, node) of each node's component, a null ``first`` last.

    ``nodes`` has (node, first), a node once, ``edges`` (a, b) over nodes.  Tasks
    first replace their links by stars.  A round takes the smallest label over the
    links, then jumps to the label's own label.  Rounds end when nothing changes;
    the driver sees whether something did.
    """
    edges = edges.select("a", "b")
    both = cut(edges.coalesce(partitions(nodes.sparkSession)).mapInArrow(lean(forests), edges.schema).distinct())
    own = F.struct(F.col("first").isNull().alias("none"), F.col("first"), F.col("node"))
    labels = cut(nodes.select("node", "first", own.alias("label")).join(both.select(F.col("a").alias("node")).distinct(), "node"))
    while True:
        said = both.join(labels.select(F.col("node").alias("b"), "label"), "b").select(F.col("a").alias("node"), "label")
        # a node's own row and what its neighbours say meet in one aggregation
        lower = (labels.select("node", "label", "first", F.col("label").alias("old")).unionByName(said, allowMissingColumns=True)
                 .groupBy("node").agg(F.max("first").alias("first"), F.max("old").alias("old"), F.min("label").alias("label")))
        up = lower.select(F.col("node").alias("up"), F.col("label").alias("above"))
        after = cut(lower.join(up, F.col("label")["node"] == F.col("up"))
                    .select("node", "first", "old", F.least("label", "above").alias("label")))
        labels = after.select("node", "first", "label")
        if after.where(F.col("old") != F.col("label")).isEmpty():
            return labels.select("node", "first", F.col("label")["node"].alias("root"), F.col("label")["first"].alias("root_first"))
        release(nodes.sparkSession)     # what the driver keeps of a round's plans and shuffles goes


def joined_up(labels: DataFrame, nodes: DataFrame, more: DataFrame) -> DataFrame:
    """(node, root, root_first) of ``labels`` from ``components(nodes, ...)`` when links ``more`` (a, b) between roots,
    or nodes that have no label, are added."""
    above = cut(components(nodes, more))
    known = labels.select("node", "root", "root_first")
    up = above.select(F.col("node").alias("root"), F.col("root").alias("to"), F.col("root_first").alias("to_first"))
    return (known.join(up, "root", "left")
            .select("node", F.coalesce("to", "root").alias("root"), F.when(F.col("to").isNull(), F.col("root_first")).otherwise(F.col("to_first")).alias("root_first"))
            .union(above.join(known, "node", "left_anti").select("node", "root", "root_first")))
