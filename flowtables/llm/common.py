"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path, ship_package

__all__ = [
    "WORKER_CACHES", "arrow_map", "cut_lineage", "give_back_memory", "held_out", "read_table", "scratch_path", "ship_package", "sum_vectors", "vector_rows",
]

#: Rows of whole texts handed to Python at once.  Bounds a worker's memory: a
#: batch of average texts is a few MB, and a batch of the longest ones fits too.
BATCH_ROWS = 256


#: Per module, what empties its cache in a worker: a worker that goes on with another operator starts without it.
WORKER_CACHES: dict[str, Callable[[], None]] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the rows whose labels a classifier never sees:
    crc32 of the id as text, modulo ``folds``, is 0 (a null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with small batches, so that a worker holds few whole texts.

    The batch size is a session setting read when the plan runs, so it is set
    here once for the session; it changes memory use, never results.
    """
    spark = df.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for owner, clear in WORKER_CACHES.items():
            if owner != fn.__module__:
                clear()
        yield from fn(batches)
        give_back_memory()

    return df.mapInArrow(run, schema)


def give_back_memory() -> None:
    """Return freed memory to the system at the end of a task.  Workers are
    used again, and what one operator has freed would count against the next."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its own rules
        pass


def vector_rows(vec: np.ndarray, slices: int = 16) -> pa.RecordBatch:
    """One task's count vector as ``slices`` rows ``(slice, v)``."""
    parts = np.array_split(np.ascontiguousarray(vec, dtype="<i8"), slices)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(slices), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["slice", "v"]
    )


def sum_vectors(df: DataFrame, length: int, slices: int = 16) -> np.ndarray:
    """Sum of the count vectors that tasks emitted with ``vector_rows``.

    Each slice is summed in its own task; the driver gets one vector of
    ``length`` numbers, which is fixed by the caller and not by the data.
    """

    def total(pdf):
        first = pdf.iloc[:1].copy()
        acc = np.frombuffer(pdf["v"].iloc[0], "<i8").copy()
        for b in pdf["v"].iloc[1:]:
            acc += np.frombuffer(b, "<i8")
        first["v"] = [acc.tobytes()]
        return first

    # Two levels, so that no task holds the vectors of all the others.
    salted = df.withColumn("s", F.spark_partition_id() % 64)
    partial = salted.groupBy("slice", "s").applyInPandas(lambda p: total(p), "slice int, v binary, s int")
    rows = partial.select("slice", "v").groupBy("slice").applyInPandas(lambda p: total(p), "slice int, v binary").collect()
    got = {r["slice"]: np.frombuffer(bytes(r["v"]), "<i8") for r in rows}
    sizes = [len(p) for p in np.array_split(np.empty(length), slices)]
    return np.concatenate([got.get(i, np.zeros(n, "<i8")) for i, n in enumerate(sizes)])
