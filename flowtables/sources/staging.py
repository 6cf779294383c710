"""Run-scoped staging (S5) and materialisation between steps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stage_run_inputs(
    spark: SparkSession,
    src_dir: str,
    run_area: str,
    tables: Iterable[str],
    fmt: str = "parquet",
    skip: bool = False,
) -> DataFrame:
    """Copy every raw table into a fresh run-scoped area before the first
    step; later steps read only from there.  ``skip``: no copies, the steps
    read the raw tables.  An area that holds a table already is an error: it
    belongs to another run (name areas with ``run_scoped_name``).

    Each table is a distributed read + write (no bytes pass the driver).
    Returns ``(table, n_rows, path)``, counts taken from where the steps read.
    """
    out = None
    for name in tables:
        raw = f"{src_dir.rstrip('/')}/{name}.{fmt}"
        source = spark.read.format(fmt).load(raw)
        if skip:
            staged, target = source, raw
        else:
            target = f"{run_area.rstrip('/')}/{name}"
            source.write.mode("errorifexists").parquet(target)
            staged = spark.read.parquet(target)
        row = staged.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows", F.lit(target).alias("path"))
        out = row if out is None else out.unionByName(row)
    return out


def materialise(df: DataFrame, name: str, area: str) -> DataFrame:
    """Store a dataset that crosses a step boundary and continue from the
    stored copy (steps share no memory)."""
    path = f"{area.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
