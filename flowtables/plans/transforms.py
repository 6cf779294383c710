"""Chains of named DataFrame transforms.

A step is a function of DataFrames with named inputs and outputs.  Fused
(X1): the whole chain stays one lazy plan per output, so Catalyst optimises
across steps (filters move to the scans, unused columns are never read).
Materialised (X2): every output is stored and the next step reads the
stored copy, as separate steps on separate machines would.  Both must give
the same rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources.staging import materialise


@dataclass(frozen=True)
class Step:
    name: str
    func: Callable[..., DataFrame | Sequence[DataFrame]]
    inputs: tuple[str, ...]
    outputs: tuple[str, ...]


def step(name: str, func, inputs: Sequence[str], outputs: Sequence[str]) -> Step:
    return Step(name, func, tuple(inputs), tuple(outputs))


def _ordered(steps: Sequence[Step], available: set[str]) -> list[Step]:
    """Steps in an order where each one's inputs exist before it runs."""
    todo, done, order = list(steps), set(available), []
    while todo:
        ready = [s for s in todo if set(s.inputs) <= done]
        if not ready:
            missing = {i for s in todo for i in s.inputs} - done
            raise ValueError(f"steps cannot run, missing datasets: {sorted(missing)}")
        for s in ready:
            order.append(s)
            done.update(s.outputs)
            todo.remove(s)
    return order


def _apply(s: Step, data: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    result = s.func(*[data[i] for i in s.inputs])
    if isinstance(result, DataFrame):
        result = (result,)
    if len(result) != len(s.outputs):
        raise ValueError(f"step {s.name} returned {len(result)} outputs, expected {len(s.outputs)}")
    return dict(zip(s.outputs, result))


def needed_steps(steps: Sequence[Step], given: set[str], outputs: Sequence[str]) -> list[Step]:
    """The steps that the datasets ``outputs`` come from, in their own order; ``given`` are not made."""
    made_by: dict[str, Step] = {}
    for s in steps:
        for name in s.outputs:
            if name in made_by:
                raise ValueError(f"dataset {name} is made by {made_by[name].name} and {s.name}")
            made_by[name] = s
    missing = sorted(set(outputs) - set(made_by) - given)
    if missing:
        raise ValueError(f"no step makes {missing}")
    reached: set[str] = set()
    todo = [name for name in outputs if name not in given]
    while todo:
        s = made_by.get(todo.pop())
        if s is not None and s.name not in reached:
            reached.add(s.name)
            todo.extend(i for i in s.inputs if i not in given)
    return [s for s in steps if s.name in reached]


def shared_datasets(steps: Sequence[Step], outputs: Sequence[str] = ()) -> set[str]:
    """Datasets made by a step that two or more consumers read: steps, or a step and the caller."""
    readers = Counter(i for s in steps for i in set(s.inputs))
    readers.update(set(outputs))
    made = {name for s in steps for name in s.outputs}
    return {name for name, n in readers.items() if n > 1 and name in made}


def run_fused(
    steps: Sequence[Step], inputs: Mapping[str, DataFrame], outputs: Sequence[str] | None = None, area: str | None = None
) -> dict[str, DataFrame]:
    """Run the chain lazily; returns every dataset by name.

    With ``outputs``, only the steps that these come from run, and only these
    datasets are returned.  A dataset with two or more consumers is then made
    once: stored below ``area`` (default: the checkpoint folder) and read by all of them.
    Everything else stays one lazy plan per output.
    """
    data = dict(inputs)
    if outputs is None:
        for s in _ordered(steps, set(data)):
            data.update(_apply(s, data))
        return data
    steps = needed_steps(steps, set(data), outputs)
    shared = shared_datasets(steps, outputs)
    for s in _ordered(steps, set(data)):
        for name, df in _apply(s, data).items():
            if name in shared:
                df = materialise(df, name, area) if area else cut_lineage(df, f"shared-{name}")
            data[name] = df
    return {name: data[name] for name in outputs}


def run_materialised(steps: Sequence[Step], inputs: Mapping[str, DataFrame], area: str) -> dict[str, DataFrame]:
    """Like ``run_fused`` but every step output is stored under ``area``
    and read back before the next step uses it."""
    data = dict(inputs)
    for s in _ordered(steps, set(data)):
        for name, df in _apply(s, data).items():
            data[name] = materialise(df, name, area)
    return data


def run_for_date(
    transform: Callable[[DataFrame], DataFrame],
    source: DataFrame,
    ts_col: str,
    ds: str | None,
    sink: str,
) -> DataFrame:
    """Run scheduled dates.  ``ds`` = one date (``yyyy-MM-dd``): only
    that date's rows are read (the filter reaches the scan) and only
    partition ``ds=<date>`` of ``sink`` is replaced, also when the date has
    no rows (any more).  ``ds=None`` runs every date of ``source`` in one job
    and replaces the whole sink, one partition per date.  ``transform`` gets
    the rows with a ``ds`` column and must keep it.
    """
    day = F.date_format(F.col(ts_col), "yyyy-MM-dd")
    rows = source.withColumn("ds", day)
    if ds is None:
        transform(rows).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("ds").parquet(sink)
    else:
        one = rows.filter(F.col(ts_col) >= F.lit(ds).cast("timestamp_ntz")).filter(
            F.col(ts_col) < F.date_add(F.lit(ds).cast("date"), 1).cast("timestamp_ntz")
        )
        transform(one).drop("ds").write.mode("overwrite").parquet(f"{sink.rstrip('/')}/ds={ds}")
    return source.sparkSession.read.parquet(sink)
