"""Work of the levels: what a pass reads, and parents told apart by a hash."""

import random

import pytest
from pyspark.sql import functions as F

from flowtables.operators import cycles, graph
from test_cycles import SCHEMA, both_rows, plain


def test_levels_off_cycles_are_found_once(spark, monkeypatch):
    """Levels over the condensation start below the cycles: the groups above are not levelled a second time."""
    states = []
    real = graph.cut_lineage_counting

    def counting(df, name, **metrics):
        if name in ("levels-state", "levels-nodes"):
            states.append(df.count())
        return real(df, name, **metrics)

    monkeypatch.setattr(graph, "cut_lineage_counting", counting)
    pairs = [(f"a{i}", f"b{j}") for i in range(6) for j in range(6)] + [("b0", "x"), ("a1", "x"), ("x", "y"), ("y", "x"), ("y", "z"), ("b3", "z")]
    e = spark.createDataFrame([("p", a, b) for a, b in pairs], SCHEMA)
    groups = spark.createDataFrame([("p", "lone"), ("p", "x")], "pipeline string, group string")
    want = {("p", g): v for g, v in plain(pairs, ["lone"]).items()}
    assert both_rows(cycles.condensed_levels(e, groups)) == want
    # 16 groups in all, 3 of them on or below the cycle: the second pass over the 16 is not there.
    assert sum(n >= 13 for n in states) == 1


@pytest.mark.parametrize("same", [False, True])
def test_parents_with_one_hash(spark, monkeypatch, same):
    if same:
        monkeypatch.setattr(graph, "_parent_hash", lambda col: F.lit(0).cast("long"))
    rnd = random.Random(3)
    rows, want = [], {}
    for p in range(12):
        n = rnd.randrange(3, 14)
        pairs = [(f"n{rnd.randrange(n):02}", f"n{rnd.randrange(n):02}") for _ in range(int(1.4 * n))]
        if p % 2:
            pairs = [(min(x), max(x)) for x in pairs if x[0] != x[1]]
        rows += [(f"p{p}", a, b) for a, b in pairs + pairs[:2]]
        for g, (level, cycle, below) in plain(pairs).items():
            lost = cycle is not None or below
            want[f"p{p}", g] = (None if lost else level, lost)
    got = {(r.pipeline, r.group): (r.level, r.cyclic) for r in graph.dag_levels(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want
