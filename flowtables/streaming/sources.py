"""File streams for the streaming operators, and the replay used to feed them.

A stream reads a folder of Parquet files with the schema given (no
inference).  Event times arrive as ``timestamp_ntz``; watermarks need
``timestamp``, so ``ts`` is cast (session time zone UTC).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_STATE = "org.apache.spark.sql.execution.streaming.state."


def replay(df: DataFrame, ts_col: str, folder: str, slices: int) -> Iterator[int]:
    """Append ``df`` to ``folder`` in ``slices`` steps of equal event time, one
    step each time the iterator is asked, so that a stream over the folder can
    be run after each.  Rows without an event time come with the first step."""
    ts = F.col(ts_col)
    bounds = df.select(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi")).first()
    lo, hi = bounds["lo"], bounds["hi"]
    step = None if lo is None else (hi - lo) / slices
    for i in range(slices):
        if lo is None:
            part = df if i == 0 else df.limit(0)
        else:
            begins = (ts >= F.lit(lo + step * i)) if i else F.lit(True)
            ends = (ts < F.lit(lo + step * (i + 1))) if i < slices - 1 else F.lit(True)
            part = df.filter(begins & ends | ts.isNull() if i == 0 else begins & ends)
        part.write.mode("append").parquet(folder)
        yield i


def event_stream(spark: SparkSession, folder: str, schema: StructType, ts_col: str = "ts", max_files: int | None = None) -> DataFrame:
    """``readStream`` over ``folder`` with ``ts_col`` as ``timestamp``;
    ``max_files`` bounds the files of a micro-batch (default: no bound)."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder).withColumn(ts_col, F.col(ts_col).cast("timestamp"))


def run_available_now(
    spark: SparkSession, stream_writer, checkpoint: str, state_partitions: int | None = None
) -> None:
    """Start with ``Trigger.AvailableNow`` and wait until every file present
    at start has been processed.

    Stateful operators keep their state in a fixed number of partitions,
    set when a checkpoint is first used.  By default that is the total
    number of executor cores (``defaultParallelism``), a count that grows
    with the cluster.  State entries with timers need a store with column
    families, which Spark's default store is not: RocksDB stands in for it, any
    other store that the session names stays.  The session settings are changed
    only while the query starts and are put back right after.
    """
    if state_partitions is None:
        try:
            state_partitions = spark.sparkContext.defaultParallelism
        except Exception:  # pragma: no cover - Connect sessions
            state_partitions = None
    before = spark.conf.get("spark.sql.shuffle.partitions")
    store = spark.conf.get(_PROVIDER, None)
    default_store = store is None or store == f"{_STATE}HDFSBackedStateStoreProvider"
    if state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    if default_store:
        spark.conf.set(_PROVIDER, f"{_STATE}RocksDBStateStoreProvider")
    try:
        query = stream_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        if default_store:
            spark.conf.unset(_PROVIDER) if store is None else spark.conf.set(_PROVIDER, store)
    query.awaitTermination()
    if query.exception() is not None:  # pragma: no cover
        raise query.exception()
