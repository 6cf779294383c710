"""Set operators with set semantics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_groups(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every row of either side once."""
    return a.unionByName(b).distinct()


def intersect_nodes(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows on both sides, once."""
    return a.intersect(b.select(*a.columns))


def subtract_groups(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` not in ``b``, once."""
    return a.subtract(b.select(*a.columns))


def dedupe_by_name(df: DataFrame, keys: Sequence[str], order: Sequence[str], newest: bool = True) -> DataFrame:
    """U4: one row per ``keys``: the one with the largest ``order`` (or the
    smallest when ``newest=False``), ties broken by the rest of the row, so
    the choice is the same on every run (``dropDuplicates`` is not).

    A partial aggregate: a key with very many rows is reduced map-side.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    tie = [c for c in rest if c not in order]
    rank = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in tie])
    pick = F.max_by if newest else F.min_by
    return df.groupBy(*keys).agg(pick(F.struct(*[F.col(c) for c in rest]), rank).alias("_row")).select(*keys, "_row.*")
