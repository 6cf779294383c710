"""Schemas of the pipeline tables and a helper to state a small pipeline
inline (as users and tests write them)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from .operators.classify import io_from_arrays

NODES_SCHEMA = (
    "pipeline string, node string, tags array<string>, inputs array<string>, "
    "outputs array<string>, param_types array<string>, return_type string"
)
CATALOG_SCHEMA = "dataset string, type string, location string"
EDGES_SCHEMA = "pipeline string, parent string, child string"


def pipeline_tables(
    spark: SparkSession,
    nodes: Iterable[Mapping],
    catalog: Mapping[str, str],
    pipeline: str = "__default__",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``nodes`` as dicts with ``name``, ``inputs``, ``outputs`` and optional
    ``tags``, ``param_types``, ``return_type``; ``catalog`` maps dataset →
    class name.  Returns ``(nodes, node_io, catalog)`` frames."""
    rows = [
        (
            pipeline,
            n["name"],
            list(n.get("tags") or []),
            list(n.get("inputs") or []),
            list(n.get("outputs") or []),
            list(n.get("param_types") or []),
            n.get("return_type"),
        )
        for n in nodes
    ]
    df = spark.createDataFrame(rows, NODES_SCHEMA)
    cat = spark.createDataFrame([(k, v, None) for k, v in catalog.items()], CATALOG_SCHEMA)
    return df.drop("inputs", "outputs"), io_from_arrays(df), cat
