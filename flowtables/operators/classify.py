"""Node classification and slicing (P1, P5, P6) and the long form of node I/O.

Pipeline tables keep a node's inputs and outputs in long form,
``node_io(pipeline, node, dataset, role)`` with role ``in``/``out``: a node
that reads millions of datasets is then millions of rows spread over the
cluster, not one huge array in one row.  ``io_from_arrays`` turns the
array form (``inputs``/``outputs`` columns, as users write small pipelines)
into the long form.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    SPARK_DATASET_TYPES,
    SPARK_FRAME_CLASS,
    SPARK_GROUP_TAG,
    SUPPORTED_HANDLER_TYPES,
)

ROLE_IN = "in"
ROLE_OUT = "out"


def io_from_arrays(nodes: DataFrame) -> DataFrame:
    """``nodes(pipeline, node, inputs[], outputs[])`` → ``node_io`` long form."""
    ins = nodes.select(
        "pipeline", "node", F.explode("inputs").alias("dataset"), F.lit(ROLE_IN).alias("role")
    )
    outs = nodes.select(
        "pipeline", "node", F.explode("outputs").alias("dataset"), F.lit(ROLE_OUT).alias("role")
    )
    return ins.unionByName(outs)


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def mark_spark_nodes(
    nodes: DataFrame,
    node_io: DataFrame,
    catalog: DataFrame,
    spark_types: Iterable[str] = SPARK_DATASET_TYPES,
    group_tag: str = SPARK_GROUP_TAG,
) -> DataFrame:
    """Add ``is_spark`` to ``nodes``.

    A node is a Spark node when any of these holds: a parameter is hinted as
    a Spark DataFrame, the return value is, an input or output dataset is of
    a Spark dataset class (exact class name), or it carries the group tag.
    The dataset test is a semi join of ``node_io`` with the Spark rows of the
    catalog, reduced to one flag row per node before it meets ``nodes``.
    """
    spark_datasets = (
        catalog.filter(F.col("type").isin(list(spark_types))).select("dataset").distinct()
    )
    io_flag = (
        node_io.join(spark_datasets, "dataset", "left_semi")
        .select("pipeline", "node")
        .distinct()
        .withColumn("_spark_io", F.lit(True))
    )
    by_hint = (
        _flag(F.array_contains("param_types", SPARK_FRAME_CLASS))
        | _flag(F.col("return_type") == SPARK_FRAME_CLASS)
        | _flag(F.array_contains("tags", group_tag))
    )
    return (
        nodes.join(io_flag, ["pipeline", "node"], "left")
        .withColumn("is_spark", by_hint | _flag(F.col("_spark_io")))
        .drop("_spark_io")
    )


def select_nodes(
    nodes: DataFrame,
    pipeline: str,
    names: Iterable[str] | DataFrame | None = None,
) -> DataFrame:
    """P5: nodes of one pipeline, optionally only the named ones.

    The caller chooses the form: a list of names becomes an ``IN`` predicate
    (pushed into the scan), a DataFrame of names a left semi join.
    """
    out = nodes.filter(F.col("pipeline") == F.lit(pipeline))
    if names is None:
        return out
    if isinstance(names, DataFrame):
        return out.join(names.select(F.col(names.columns[0]).alias("node")), "node", "left_semi")
    return out.filter(F.col("node").isin(list(names)))


def supported_handlers(
    handlers: DataFrame, type_col: str = "type", supported: Iterable[str] = SUPPORTED_HANDLER_TYPES
) -> DataFrame:
    """Keep handler rows of a supported type, drop the others silently."""
    return handlers.filter(F.col(type_col).isin(list(supported)))
