"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from strata.session import ensure_checkpoint_dir, ship

#: The white space that separates words in every operator here.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows and bytes that go to a Python worker together: texts are long, and a worker holds a batch several times over.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def prepare(spark: SparkSession) -> None:
    """Workers get the package, and batches of bounded size unless the session sets their size itself."""
    ship(spark)
    set_already = spark.conf.getAll
    for k, v in BATCHES.items():
        if k not in set_already:
            spark.conf.set(k, v)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage,
    so that later reads survive lost executors and see the same rows."""
    prepare(df.sparkSession)
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files that nothing refers to since a checkpoint
    (its cleaner otherwise waits for the driver to collect garbage)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fresh(name: str) -> str:
    """A column name that no input column has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Memory that Python and Arrow have freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, giving memory back at its end: Spark keeps idle Python workers, also beside steps that need none."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return work


def append(df: DataFrame, inputs: Sequence[str], fields: Sequence[tuple[str, T.DataType]],
           make: Callable[[], Callable[..., list]]) -> DataFrame:
    """``df`` with columns ``fields`` computed from the columns ``inputs``.

    ``make()`` runs once per task and returns a function from pyarrow arrays
    (one per input, a batch of rows) to a list of arrays or lists.  Other
    columns pass through untouched whatever their names are.
    """
    prepare(df.sparkSession)
    schema = T.StructType(df.schema.fields + [T.StructField(n, t) for n, t in fields])
    places = [df.columns.index(c) for c in inputs]
    kinds = [to_arrow_type(t) for _, t in fields]
    names = list(schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for b in batches:
            made = work(*(b.column(i) for i in places))
            cols = [a if isinstance(a, (pa.Array, pa.ChunkedArray)) and a.type == k else pa.array(a, k)
                    for a, k in zip(made, kinds)]
            yield pa.RecordBatch.from_arrays(list(b.columns) + cols, names=names)

    return df.mapInArrow(lean(run), schema)
