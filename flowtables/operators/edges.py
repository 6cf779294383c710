"""Dataset-mediated edges and their contraction.

All joins here are equi joins on ``(pipeline, key)``; Spark chooses the
strategy (broadcast when a side is below the threshold by its statistics,
sort-merge otherwise, with AQE splitting skewed partitions such as a dataset
read by a very large number of nodes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .classify import ROLE_IN, ROLE_OUT
from .ranking import number_within


def dataset_links(node_io: DataFrame) -> DataFrame:
    """``(pipeline, parent, child, dataset)``: ``parent`` writes what ``child`` reads.

    A dataset has one writer per pipeline, as in any pipeline that can be
    ordered; a second writer makes an edge of its own to every reader."""
    outs = node_io.filter(F.col("role") == ROLE_OUT).select(
        "pipeline", F.col("node").alias("parent"), "dataset"
    )
    ins = node_io.filter(F.col("role") == ROLE_IN).select(
        "pipeline", F.col("node").alias("child"), "dataset"
    )
    return outs.join(ins, ["pipeline", "dataset"]).filter(F.col("parent") != F.col("child"))


def dataset_edges(node_io: DataFrame) -> DataFrame:
    """Node edges ``(pipeline, parent, child)``, one row per pair."""
    return dataset_links(node_io).select("pipeline", "parent", "child").distinct()


def contract_edges(edges: DataFrame, groups: DataFrame, group_col: str = "group_id") -> DataFrame:
    """Group edges ``(pipeline, parent_group, child_group)``.

    ``groups`` maps ``(pipeline, node)`` to ``group_col``.  Self loops and
    duplicates are removed.
    """
    g = groups.select("pipeline", "node", group_col)
    parent_g = g.withColumnRenamed("node", "parent").withColumnRenamed(group_col, "parent_group")
    child_g = g.withColumnRenamed("node", "child").withColumnRenamed(group_col, "child_group")
    return (
        edges.select("pipeline", "parent", "child")
        .join(parent_g, ["pipeline", "parent"])
        .join(child_g, ["pipeline", "child"])
        .filter(F.col("parent_group") != F.col("child_group"))
        .select("pipeline", "parent_group", "child_group")
        .distinct()
    )


def boundary_datasets(node_io: DataFrame, groups: DataFrame, group_col: str = "group_id") -> DataFrame:
    """Datasets written in one group and read in another ``(pipeline, dataset)``.

    These must be stored between steps; datasets that stay inside one group
    can stay lazy.
    """
    g = groups.select("pipeline", "node", group_col)
    return (
        dataset_links(node_io)
        .join(g.withColumnRenamed("node", "parent").withColumnRenamed(group_col, "pg"), ["pipeline", "parent"])
        .join(g.withColumnRenamed("node", "child").withColumnRenamed(group_col, "cg"), ["pipeline", "child"])
        .filter(F.col("pg") != F.col("cg"))
        .select("pipeline", "dataset")
        .distinct()
    )


def collect_sorted(
    df: DataFrame,
    keys: list[str],
    value: str,
    out: str,
    max_per_row: int = 10000,
) -> DataFrame:
    """Sorted distinct ``value`` lists per key, at most ``max_per_row`` per row.

    Values are numbered inside their key (see ``number_within``, which does
    not pull a key into one task) and cut into chunks; a key with more values
    than ``max_per_row`` spans several rows ``(keys, chunk, out)``, so no
    collected list grows without bound.  ``n_<out>`` counts the key's values,
    not the chunk's.
    """
    distinct_vals = df.select(*keys, value).distinct()
    numbered = number_within(distinct_vals, keys, value, out="_pos").withColumn(
        "chunk", (F.col("_pos") / F.lit(max_per_row)).cast("long")
    )
    chunks = numbered.groupBy(*keys, "chunk").agg(
        F.sort_array(F.collect_list(value)).alias(out),
        F.max("_pos").alias("_last"),
    )
    # One row per chunk here: a key's rows are its values divided by max_per_row.
    total = F.max("_last").over(Window.partitionBy(*keys)) + 1
    return chunks.withColumn(f"n_{out}", total).drop("_last")


def children_of(edges: DataFrame, max_per_row: int = 10000) -> DataFrame:
    """A1: parent → sorted children ``(pipeline, parent, chunk, children, n_children)``."""
    return collect_sorted(edges, ["pipeline", "parent"], "child", "children", max_per_row)


def group_members(groups: DataFrame, group_col: str = "group_id", max_per_row: int = 10000) -> DataFrame:
    """A2: member list per group ``(pipeline, group, chunk, members, n_members, member_list)``.

    ``member_list`` is the comma-joined form passed to a step that runs the
    group's nodes.
    """
    return collect_sorted(groups, ["pipeline", group_col], "node", "members", max_per_row).withColumn(
        "member_list", F.concat_ws(",", "members")
    )


def type_members(groups: DataFrame, max_per_row: int = 10000) -> DataFrame:
    """A2 per group type: ``(pipeline, group_type, chunk, members, n_members, member_list)``."""
    return group_members(groups, "group_type", max_per_row)
