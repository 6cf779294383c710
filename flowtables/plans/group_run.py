"""A chain of steps run group by group (X1 inside a group, X2 between groups).

A group of steps is one fused run: what its steps hand to each other stays
lazy.  What one group writes and another reads (J7) is stored, and so are the
requested outputs; nothing else is.  Groups run in the order of their levels
(G4) in the contracted graph (J4).  After a group's datasets are stored, an
entry in the area's manifest says so, and a run that was broken off goes on
with the first group that has none.

The graph is as large as the list of steps in the caller's program, so its
levels and boundaries come to the driver; the datasets never do.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.classify import ROLE_IN, ROLE_OUT
from ..operators.edges import boundary_datasets, contract_edges, dataset_edges
from ..operators.graph import dag_levels
from ..session import path_exists, remove_folder
from ..sources.staging import materialise
from .transforms import Step, needed_steps, run_fused, shared_datasets

PIPELINE = "__default__"
MANIFEST = "_manifest"
_ENTRY = "run string, steps array<string>, stored array<string>, built_from map<string, string>"


def step_io(spark: SparkSession, steps: Sequence[Step]) -> DataFrame:
    """``node_io(pipeline, node, dataset, role)`` of the steps."""
    rows = [(PIPELINE, s.name, d, role) for s in steps for role, names in ((ROLE_IN, s.inputs), (ROLE_OUT, s.outputs)) for d in names]
    return spark.createDataFrame(rows, "pipeline string, node string, dataset string, role string")


def _entry_path(area: str, group: str) -> str:
    return f"{area.rstrip('/')}/{MANIFEST}/{quote(group, safe='')}"


def _entry(spark: SparkSession, area: str, group: str) -> dict | None:
    """What the manifest says of a group; None if it was never finished."""
    path = _entry_path(area, group)
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return None
    row = spark.read.schema(_ENTRY).json(path).first()
    return row.asDict() if row else None


def run_by_groups(
    spark: SparkSession,
    steps: Sequence[Step],
    inputs: Mapping[str, DataFrame],
    groups: DataFrame,
    area: str,
    outputs: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Run ``steps`` by ``groups(pipeline, node, group_name)`` below ``area``.

    ``outputs`` (default: what no step reads) are stored and returned; only
    the steps that they come from run.  A step without a group is a group of
    its own.  Groups that need each other are an error, as neither can go
    first.  A dataset that several steps of one group read is cached while
    the group runs.

    ``area`` belongs to one run over one set of inputs (name it with
    ``run_scoped_name``).  Called again, a group is read from the manifest if
    it has the same steps and stored datasets and was made from the present
    datasets of the groups before it; otherwise it runs again, and with it
    what comes after it.
    """
    given = set(inputs)
    if outputs is None:
        read = {i for s in steps for i in s.inputs}
        outputs = [name for s in steps for name in s.outputs if name not in read]
    steps = needed_steps(steps, given, outputs)
    data = dict(inputs)
    if not steps:
        return {name: data[name] for name in outputs}

    io = step_io(spark, steps).filter(~((F.col("role") == ROLE_OUT) & F.col("dataset").isin(sorted(given))))
    chosen = groups.filter(F.col("pipeline") == PIPELINE).select("node", "group_name")
    members = io.select("pipeline", "node").distinct().join(chosen, "node", "left")
    members = members.select("pipeline", "node", F.coalesce("group_name", "node").alias("group_name"))
    group_of = {r["node"]: r["group_name"] for r in members.collect()}
    crossing = {r["dataset"] for r in boundary_datasets(io, members, "group_name").collect()}
    levels = dag_levels(
        contract_edges(dataset_edges(io), members, "group_name"), members.select("pipeline", F.col("group_name").alias("group")).distinct()
    ).collect()
    stuck = sorted(r["group"] for r in levels if r["level"] is None)
    if stuck:
        raise ValueError(f"groups wait for each other: {stuck}")

    made_in = {d: group_of[s.name] for s in steps for d in s.outputs}
    runs: dict[str, str] = {}
    for r in sorted(levels, key=lambda r: (r["level"], r["group"])):
        group = r["group"]
        own = [s for s in steps if group_of[s.name] == group]
        stored = sorted({d for s in own for d in s.outputs if d not in given} & (crossing | set(outputs)))
        before = {made_in[i] for s in own for i in s.inputs if i not in given} - {group}
        want = {"steps": sorted(s.name for s in own), "stored": stored, "built_from": {g: runs[g] for g in before}}
        found = _entry(spark, area, group)
        if found and all((found[k] or type(v)()) == v for k, v in want.items()):
            runs[group] = found["run"]
            for name in stored:
                data[name] = spark.read.parquet(f"{area.rstrip('/')}/{name}")
            continue
        remove_folder(spark, _entry_path(area, group))
        data.update(_run_group(own, data, stored, area))
        runs[group] = uuid.uuid4().hex
        entry = spark.createDataFrame([(runs[group], want["steps"], stored, want["built_from"])], _ENTRY)
        entry.coalesce(1).write.mode("overwrite").json(_entry_path(area, group))
    return {name: data[name] for name in outputs}


def _run_group(own: Sequence[Step], data: Mapping[str, DataFrame], stored: Sequence[str], area: str) -> dict[str, DataFrame]:
    """Run a group's steps fused and store ``stored``."""
    shared = shared_datasets(own, stored)
    cached: list[DataFrame] = []

    def caching(s: Step) -> Step:
        def func(*args):
            result = s.func(*args)
            result = (result,) if isinstance(result, DataFrame) else tuple(result)
            held = tuple(df.persist() if name in shared else df for name, df in zip(s.outputs, result, strict=True))
            cached.extend(df for name, df in zip(s.outputs, held) if name in shared)
            return held

        return Step(s.name, func, s.inputs, s.outputs)

    read = {i for s in own for i in s.inputs}
    fused = run_fused([caching(s) for s in own], {k: v for k, v in data.items() if k in read and k not in {d for s in own for d in s.outputs}})
    out = {name: materialise(fused[name], name, area) for name in stored}
    for df in cached:
        df.unpersist()
    return out
