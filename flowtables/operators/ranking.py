"""Consecutive numbering inside a key without sending the key to one task.

``row_number().over(Window.partitionBy(k).orderBy(o))`` moves every row of a
key into one task.  When one key (one pipeline, one parent) holds a large
share of the rows that task becomes the job.  Here the rows are range
partitioned on ``(k, o)`` instead, so a hot key is spread over many
partitions and sorted there, so a row's place in its slice is known when it is
stored; the offset of a slice is the number of rows of the same key in
earlier slices.  The offsets come from a table with one row per (slice, key)
pair, which is bounded by the number of slices for any one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def _names(cols: Sequence[str] | str) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _null_safe_join(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Left join on ``cols`` where null equals null; ``right``'s copies are dropped."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in cols else F.col(c) for c in right.columns])
    on = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in cols]
    return left.join(renamed, on, "left").drop(*[f"_r_{c}" for c in cols])


def _in_slices(df: DataFrame, sort: list, num_partitions: int | None) -> DataFrame:
    """``df`` in range partitions sorted by ``sort``, stored, with ``_slice``
    (range) and ``_at`` (place in it).  Without a fixed count AQE may merge
    neighbouring slices; merged slices are still ordered ranges.  Stored, so
    that neither number changes if a task is run again."""
    ranged = df.repartitionByRange(num_partitions, *sort) if num_partitions else df.repartitionByRange(*sort)
    numbered = ranged.sortWithinPartitions(*sort).withColumn("_id", F.monotonically_increasing_id())
    stored = cut_lineage(numbered, "ranged")
    # The id holds the partition above its lower 33 bits, and the place of the row in it below.
    return stored.withColumn("_slice", F.shiftright("_id", 33)).withColumn("_at", F.col("_id").bitwiseAND((1 << 33) - 1)).drop("_id")


def number_within(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: Sequence[str] | str,
    out: str = "rn",
    num_partitions: int | None = None,
    descending: bool = False,
) -> DataFrame:
    """Add ``out`` = 0-based position of the row inside its key, by ``order``
    (largest first with ``descending``).  A null key is a key like any other.

    Rows should be unique on ``keys + order`` (ties are numbered in an
    arbitrary but fixed order).  On distinct values this is ``dense_rank - 1``.
    """
    keys, order = _names(keys), _names(order)
    sort = [*[F.col(k) for k in keys], *[F.col(c).desc() if descending else F.col(c).asc() for c in order]]
    ranged = _in_slices(df, sort, num_partitions)
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice and key: where the key begins in the slice, and how many of its rows came before.
    starts = (
        ranged.groupBy("_slice", *keys)
        .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_at").alias("_first"))
        .withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
        .drop("_cnt")
    )
    return (
        _null_safe_join(ranged, starts, ["_slice", *keys])
        .withColumn(out, (F.col("_off") + F.col("_at") - F.col("_first")).cast("long"))
        .drop("_slice", "_at", "_off", "_first")
    )


def dense_number_within(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: Sequence[str] | str,
    out: str = "rank",
) -> DataFrame:
    """``dense_rank() - 1`` of ``order`` inside ``keys``, joined back to ``df``."""
    keys, order = _names(keys), _names(order)
    distinct_vals = df.select(*keys, *order).distinct()
    numbered = number_within(distinct_vals, keys, order, out=out)
    return _null_safe_join(df, numbered, [*keys, *order])


def previous_within(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: str,
    value: str,
    out: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """``lag(value)`` inside ``keys`` by ``order`` without a whole key in one
    task.  A null key is a key like any other.

    Rows are range partitioned on ``(keys, order)``; each slice takes the lag
    locally, and the first row of a slice takes the last value of the
    nearest earlier slice holding the same key (one row per slice and key).
    Rows should be unique on ``keys + order``.
    """
    keys = _names(keys)
    ranged = _in_slices(df, [*[F.col(k) for k in keys], F.col(order)], num_partitions)
    w = Window.partitionBy("_slice", *keys).orderBy("_at")
    local = ranged.withColumn("_prev", F.lag(value).over(w)).withColumn("_begins", F.row_number().over(w) == 1)
    tails = (
        ranged.groupBy("_slice", *keys)
        .agg(F.max_by(value, "_at").alias("_tail"))
        .withColumn("_carry", F.lag("_tail").over(Window.partitionBy(*keys).orderBy("_slice")))
        .drop("_tail")
    )
    return (
        _null_safe_join(local, tails, ["_slice", *keys])
        .withColumn(out, F.when(F.col("_begins"), F.col("_carry")).otherwise(F.col("_prev")))
        .drop("_slice", "_at", "_prev", "_begins", "_carry")
    )
