"""Additive roll-ups kept up to date batch by batch, rewriting only the partitions a batch touches.

The manifest (``sources.publish``) names, for such a table, the version folder
of every partition and the batches it holds.  ``merge_rollup`` rolls a batch up,
adds it to what the touched partitions hold, writes those partitions as a new
version and switches the manifest, which names the batch from then on: in one
step the batch is in the table and known to be in it.  A batch that is sent again
changes nothing, and one that fails half-way is simply sent again.

The number of partitions must suit a manifest (thousands, not millions).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.errors import CheckFailed
from strata.operators.rollup import rollup_events
from strata.sources.layout import Layout, write_observed
from strata.sources.publish import Publication


def merge_rollup(spark: SparkSession, layout: Layout, layer: str, table: str, batch: DataFrame, batch_id: str, keys: Sequence[str], value: str,
                 part: str, total_name: str = "total_clicks", count_name: str = "event_count", total_kind: str = "bigint") -> dict:
    """Adds ``batch`` to the roll-up of ``keys``, stored by the key column ``part``.

    Returns whether it was applied, the events in and the partitions rewritten;
    raises ``CheckFailed``, before anything is visible, if events were lost.
    """
    name = layout.name(layer, table)
    out = Publication(spark, layout)
    entry = out.tables.get(name) or {"parts": {}, "batches": []}
    if batch_id in entry["batches"]:
        return {"applied": False, "events": 0, "partitions": []}
    if batch.isEmpty():
        out.staged[name] = {**entry, "batches": [*entry["batches"], batch_id], "schema": entry.get("schema") or _schema(rollup_events(batch, keys, value, total_name, count_name, total_kind), part)}
        out.publish()
        return {"applied": True, "events": 0, "partitions": []}
    seen, held = Observation(f"batch_{uuid.uuid4().hex[:8]}"), Observation(f"held_{uuid.uuid4().hex[:8]}")
    delta = rollup_events(batch.observe(seen, F.count(F.lit(1)).alias("events")), keys, value, total_name, count_name, total_kind)
    merged, known = delta, bool(entry["parts"])
    if known:
        values = [r[0] for r in batch.select(part).distinct().collect()]        # as many as partitions
        inside = F.col(part).isin([v for v in values if v is not None])
        if None in values:
            inside = inside | F.col(part).isNull()
        old = layout.load(spark, entry).where(inside).observe(held, F.coalesce(F.sum(count_name), F.lit(0)).alias("events"))
        kind = delta.schema[total_name].dataType
        merged = (old.unionByName(delta).groupBy(*keys)
                  .agg(F.sum(total_name).cast(kind).alias(total_name), F.sum(count_name).alias(count_name)))
    version = f"versions/{layer}/{table}/{out.run}"
    folder = f"{layout.root.rstrip('/')}/{version}"
    wrote = write_observed(merged, lambda d: d.write.format(layout.fmt).mode("errorifexists").partitionBy(part).save(folder),
                           metrics={"events": F.coalesce(F.sum(count_name), F.lit(0))})
    events = seen.get["events"] + (held.get["events"] if known else 0)
    if wrote["events"] != events:
        raise CheckFailed(f"{name}: the roll-up lost events", {"in": events, "out": wrote["events"]})
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(f.getPath().getName() for f in fs.listStatus(path) if f.getPath().getName().startswith(f"{part}="))
    out.staged[name] = {**entry, "parts": {**entry["parts"], **dict.fromkeys(parts, version)}, "batches": [*entry["batches"], batch_id],
                        "schema": _schema(delta, part)}
    out.publish()
    return {"applied": True, "events": seen.get["events"], "partitions": parts}


def _schema(rolled: DataFrame, part: str) -> str:
    """Columns as readers see them: the partition's column comes last."""
    columns = [f for f in rolled.schema.fields if f.name != part] + [rolled.schema[part]]
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
