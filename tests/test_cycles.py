"""Cycles and levels over the condensation against plain Python reachability."""

import random

from flowtables.operators import cycles

SCHEMA = "pipeline string, parent_group string, child_group string"


SHAPES = [
    [("b", "b"), ("b", "c"), ("c", "d")],  # a cycle of one, with a path below it
    [("h", "v"), ("v", "h"), ("x", "h"), ("h", "y")],  # a ring with a way in and out
    [("a", "b"), ("b", "a"), ("b", "m"), ("m", "n"), ("n", "c"), ("c", "d"), ("d", "c")],  # a path between cycles
    [("a", "b"), ("b", "c"), ("c", "a"), ("b", "d"), ("d", "b"), ("d", "d"), ("e", "a"), ("e", "f")],
    [("k", "l"), ("l", "k"), ("k", "k"), ("l", "z"), ("z", "k"), ("z", "q"), ("q", "r")],
]


def plain(pairs, more=()):
    """``{group: (level, cycle id, below a cycle)}`` from the transitive closure."""
    nodes = {n for p in pairs for n in p} | set(more)
    children = {n: {b for a, b in pairs if a == n} for n in nodes}
    reach = {}
    for n in nodes:
        seen, todo = set(), list(children[n])
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo.extend(children[x])
        reach[n] = seen
    cycle = {n: min({n} | {m for m in reach[n] if n in reach[m]}) if n in reach[n] else None for n in nodes}
    unit = {n: cycle[n] or n for n in nodes}
    level = {}

    def depth(u):
        if u not in level:
            above = {unit[a] for a, b in pairs if unit[b] == u and unit[a] != u}
            level[u] = 1 + max((depth(a) for a in above), default=-1)
        return level[u]

    return {n: (depth(unit[n]), cycle[n], cycle[n] is None and any(cycle[m] and n in reach[m] for m in nodes)) for n in nodes}


def both(spark, tables, groups=None):
    e = spark.createDataFrame([(p, a, b) for p, pairs in tables.items() for a, b in pairs], SCHEMA)
    return both_rows(cycles.condensed_levels(e, groups))


def test_shapes_and_random_graphs(spark):
    """The shapes above, and sparse to dense graphs with edges to oneself and repeated edges: a pipeline each, in one run."""
    rng = random.Random(11)
    tables = {f"s{i}": pairs for i, pairs in enumerate(SHAPES)}
    for i in range(40):
        n = rng.randrange(2, 16)
        name = [f"g{j:02}" for j in rng.sample(range(60), n)]
        tables[f"p{i}"] = [(rng.choice(name), rng.choice(name)) for _ in range(int(n * rng.choice([0.7, 1, 1.3, 2])) + 1)]
    want = {(p, g): v for p, pairs in tables.items() for g, v in plain(pairs).items()}
    assert both(spark, tables) == want
    assert sum(v[1] is not None for v in want.values()) > 50 and sum(v[2] for v in want.values()) > 10


def test_long_ring_takes_few_rounds(spark, monkeypatch):
    ring = [(f"r{i:04}", f"r{(i + 1) % 3000:04}") for i in range(3000)]
    stored = []
    real = cycles.cut_lineage_counting
    monkeypatch.setattr(cycles, "cut_lineage_counting", lambda *a, **k: stored.append(1) or real(*a, **k))
    e = spark.createDataFrame([("p", a, b) for a, b in ring + [("r0007", "tail"), ("head", "r0009")]], SCHEMA)
    got = {r.group: r.cycle_id for r in cycles.cycle_groups(e).collect()}
    assert got == {a: "r0000" for a, _ in ring} and len(stored) < 40


def test_empty_null_and_lone_groups(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cycles.cycle_groups(none).count() == 0
    groups = spark.createDataFrame([("p", "only"), ("p", None)], "pipeline string, group string")
    assert both_rows(cycles.condensed_levels(none, groups)) == {("p", "only"): (0, None, False)}
    e = spark.createDataFrame([("p", "a", None), (None, "a", "b"), ("p", "a", "b"), ("p", "b", "a"), ("p", "b", "a")], SCHEMA)
    assert both_rows(cycles.condensed_levels(e)) == {("p", "a"): (0, "a", False), ("p", "b"): (0, "a", False)}


def both_rows(df):
    return {(r.pipeline, r.group): (r.level, r.cycle_id, r.below_cycle) for r in df.collect()}
