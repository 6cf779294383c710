"""Operators without SQL oracle (and the distributed helpers) against plain
Python on small inputs: fixpoint absorption, levels with cycles, connected
groups, numbering and lag inside a key with one hot key."""

import random
from collections import defaultdict

import pandas as pd
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from flowtables import bindings as B
from flowtables import session
from flowtables.operators import classify, edges, graph, group_store
from flowtables.operators.ranking import number_within, previous_within
from flowtables.plans.grouping import group_pipeline


def union_find(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    comps = defaultdict(list)
    for n in nodes:
        comps[find(n)].append(n)
    return {n: min(members) for members in comps.values() for n in members}


def test_connected_groups_match_union_find(spark):
    got = {r.node: r.group_id for r in E.queries()["g1_connected_groups"](spark, SF_SMALL).collect()}
    pairs = [(r.parent, r.child) for r in B.order_part_links(spark, SF_SMALL).collect()]
    nodes = {x for p in pairs for x in p}
    assert got == union_find(nodes, pairs)


def test_connected_groups_of_all_links(spark):
    """Every distinct pair of lineitem is in the graph, also those of orders with several parts."""
    got = {r.node: r.group_id for r in E.queries()["g1_connected_groups_links"](spark, SF_SMALL).collect()}
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_partkey").collect()
    pairs = {(f"o{r.l_orderkey}", f"p{r.l_partkey}") for r in lines}
    assert len(pairs) > len({a for a, _ in pairs})  # orders with several parts
    assert {(r.parent, r.child) for r in B.order_part_links(spark, SF_SMALL).collect()} == pairs
    assert got == union_find({x for p in pairs for x in p}, pairs)


def test_stored_groups_equal_a_full_run(spark):
    """Increments of nodes and edges, edges before their nodes, a smaller name that
    joins late, an increment that is run again, and one that brings nothing."""
    rng = random.Random(8)
    nodes = [f"n{i:02d}" for i in range(60)]
    pairs = [tuple(rng.sample(nodes[5:], 2)) for _ in range(40)] + [("n00", "n59"), ("n00", "n30"), ("n07", "n07")]
    late = {"n00", "n20", "n21"}
    steps = [([n for n in nodes[5:] if n not in late][:30], pairs[:20]), (nodes[5:20], pairs[10:30]), (nodes, pairs[30:]), ([], []), (["zz"], [("zz", "n01"), ("a", "zz")])]
    area = session.scratch_path(spark, "groups")
    frames = lambda v, e: (spark.createDataFrame([("p", n) for n in v], "pipeline string, node string"), spark.createDataFrame([("p", a, b) for a, b in e], "pipeline string, parent string, child string"))
    seen, edges_ = set(), []
    for i, (v, e) in enumerate(steps):
        for _ in range(2 if i in (1, 4) else 1):
            group_store.add_to_groups(area, i, *frames(v, e))
        seen |= set(v)
        edges_ += e
        got = [(r.node, r.group_id) for r in group_store.stored_groups(spark, area).collect()]
        assert len(got) == len(seen)
        assert dict(got) == union_find(seen, [p for p in edges_ if set(p) <= seen])
    at_first = {r.node: r.group_id for r in group_store.stored_groups(spark, area, upto=0).collect()}
    assert at_first == union_find(set(steps[0][0]), [p for p in steps[0][1] if set(p) <= set(steps[0][0])])
    # What an increment wrote holds what it touched and nothing else.
    renames = [(r.label, r.to, r.increment) for r in spark.read.parquet(f"{area}/renames").collect()]
    assert [r for r in renames if r[2] == 4] == [("zz", "n01", 4)] and not [r for r in renames if r[2] == 3]
    stored = [r.node for r in spark.read.parquet(f"{area}/nodes").collect()]
    assert len(stored) == len(set(stored)) == 61


def test_connected_groups_with_hub_and_long_chain(spark):
    """One hub holding a third of the edges, plus a long chain (many rounds
    for plain propagation)."""
    pairs = [("h", f"x{i:04d}") for i in range(300)] + [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(600)]
    pairs += [("x0007", "c0300")]
    nodes = {x for p in pairs for x in p} | {"lonely"}
    e = spark.createDataFrame([("p", a, b) for a, b in pairs], "pipeline string, parent string, child string")
    v = spark.createDataFrame([("p", n) for n in nodes], "pipeline string, node string")
    got = {r.node: r.group_id for r in graph.connected_groups(v, e).collect()}
    assert got == union_find(nodes, pairs)


def absorb_fixpoint(spark_group, defaults, parents, children):
    member = dict(spark_group)
    pending = set(defaults)
    while True:
        new = {}
        for d in pending:
            up = {member[p] for p in parents[d] if p in member}
            down = {member[c] for c in children[d] if c in member}
            both = up & down
            if both:
                new[d] = min(both)
        if not new:
            return {d: member[d] for d in member if d in defaults}
        member.update(new)
        pending -= set(new)


def test_absorb_fixpoint_matches_loop(spark):
    nodes, io, cat = B.layered_dag(spark, SF_SMALL, "dense")
    marked = classify.mark_spark_nodes(nodes, io, cat).select("node", "is_spark").collect()
    e = [(r.parent, r.child) for r in edges.dataset_edges(io).collect()]
    spark_nodes = {r.node for r in marked if r.is_spark}
    defaults = {r.node for r in marked if not r.is_spark}
    comp = union_find(spark_nodes, [(a, b) for a, b in e if a in spark_nodes and b in spark_nodes])
    parents, children = defaultdict(set), defaultdict(set)
    for a, b in e:
        parents[b].add(a)
        children[a].add(b)
    want = absorb_fixpoint(comp, defaults, parents, children)
    got = {r.node: r.group_id for r in E.queries()["j3_absorb_fixpoint"](spark, SF_SMALL).collect()}
    assert got == want
    plain = {r.node: r.group_id for r in E.queries()["j3_absorb_sandwiched"](spark, SF_SMALL).collect()}
    assert plain == want


def levels(nodes, pairs):
    parents = defaultdict(set)
    for a, b in pairs:
        parents[b].add(a)
    level, remaining, k = {}, set(nodes), 0
    while True:
        peel = {n for n in remaining if not (parents[n] & remaining)}
        if not peel:
            break
        for n in peel:
            level[n] = k
        remaining -= peel
        k += 1
    return {n: level.get(n) for n in nodes}


def test_levels_match_peeling(spark):
    rows = E.queries()["g4_dag_levels"](spark, SF_SMALL).collect()
    got = {r.group: r.level for r in rows}
    assert all(r.cyclic == (r.level is None) for r in rows)
    nodes_df, io, cat = B.layered_dag(spark, SF_SMALL, "dense")
    g = group_pipeline(nodes_df, io, cat, grouped=True)
    pairs = [(r.parent_group, r.child_group) for r in g.group_edges.collect()]
    groups = {r.group_name for r in g.groups.select("group_name").distinct().collect()}
    assert got == levels(groups, pairs)
    assert any(v is None for v in got.values())  # contraction does create cycles here


def test_levels_small_cases(spark):
    pairs = [("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("x", "y"), ("y", "x"), ("y", "z")]
    e = spark.createDataFrame([("p", a, b) for a, b in pairs], "pipeline string, parent_group string, child_group string")
    got = {r.group: r.level for r in graph.dag_levels(e).collect()}
    assert got == {"a": 0, "b": 1, "c": 2, "d": 3, "x": None, "y": None, "z": None}


def test_number_within_hot_key(spark):
    rnd = random.Random(7)
    rows = [("hot", f"v{i:05d}") for i in range(3000)] + [
        (f"k{rnd.randrange(50)}", f"v{rnd.randrange(10**6):07d}") for _ in range(6000)
    ]
    df = spark.createDataFrame(rows, "key string, val string").distinct()
    got = number_within(df, "key", "val", out="rn").toPandas()
    pdf = df.toPandas()
    pdf["rn"] = pdf.sort_values("val").groupby("key").cumcount()
    merged = got.merge(pdf, on=["key", "val"], suffixes=("", "_want"))
    assert len(merged) == len(pdf) == len(got)
    assert (merged["rn"] == merged["rn_want"]).all()


def test_number_within_descending_and_global(spark):
    df = spark.createDataFrame([(f"b{i:03d}",) for i in range(40)], "b string")
    got = {r.b: r.rn for r in number_within(df, [], "b", out="rn", descending=True).collect()}
    assert got == {f"b{i:03d}": 39 - i for i in range(40)}


def test_previous_within_hot_key(spark):
    rnd = random.Random(3)
    rows = [("hot", i) for i in rnd.sample(range(10**6), 2000)] + [
        (f"k{rnd.randrange(30)}", rnd.randrange(10**6)) for _ in range(4000)
    ]
    df = spark.createDataFrame(rows, "key string, t long").distinct()
    got = previous_within(df, "key", "t", "t", "prev").toPandas()
    pdf = df.toPandas().sort_values(["key", "t"])
    pdf["prev_want"] = pdf.groupby("key")["t"].shift(1)
    merged = got.merge(pdf, on=["key", "t"])
    assert len(merged) == len(pdf)
    assert ((merged["prev"].isna() & merged["prev_want"].isna()) | (merged["prev"] == merged["prev_want"])).all()


def test_grouping_invariants_on_random_dags(spark):
    """Every node in exactly one group, no self loop between groups, the
    ungrouped mode has one group per node."""
    rnd = random.Random(11)
    from flowtables.model import pipeline_tables

    for trial in range(3):
        n = 40
        nodes, catalog = [], {}
        for i in range(n):
            ins = [f"d{j}" for j in rnd.sample(range(i), min(i, rnd.randrange(3)))] if i else []
            nodes.append({"name": f"n{i:02d}", "inputs": ins, "outputs": [f"d{i}"]})
            catalog[f"d{i}"] = "SparkDataSet" if rnd.random() < 0.4 else "CSVDataSet"
        nd, io, cat = pipeline_tables(spark, nodes, catalog)
        g = group_pipeline(nd, io, cat, grouped=True)
        members = g.groups.groupBy("node").count().collect()
        assert len(members) == n and all(r["count"] == 1 for r in members)
        assert g.group_edges.filter(F.col("parent_group") == F.col("child_group")).count() == 0
        u = group_pipeline(nd, io, cat, grouped=False)
        assert u.groups.select("group_name").distinct().count() == n


def test_fused_equals_materialised(spark):
    a = E.queries()["x1_run_fused"](spark, SF_SMALL).toPandas().sort_values("n_nationkey").reset_index(drop=True)
    b = E.queries()["x2_run_materialised"](spark, SF_SMALL).toPandas().sort_values("n_nationkey").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)


def test_rounds_store_an_edge_once_and_members_once(spark, monkeypatch):
    """A link has one direction in the rounds of grouping, and absorption does not write all members again each round."""
    stored: dict = {}

    def count(store):
        def run(df, name, *args, **kwargs):
            stored.setdefault(name, []).append(df.count())
            return store(df, name, *args, **kwargs)

        return run

    monkeypatch.setattr(graph, "cut_lineage", count(graph.cut_lineage))
    monkeypatch.setattr(graph, "cut_lineage_counting", count(graph.cut_lineage_counting))
    schema = "pipeline string, parent string, child string"
    ring = spark.createDataFrame([("p", f"v{i}", f"v{(i + 1) % 6}") for i in range(6)], schema)
    ends = ring.select("pipeline", F.col("parent").alias("node"))
    for closed in (False, True):
        stored.clear()
        got = {r.node: r.group_id for r in graph.connected_groups(ends, ring, closed=closed).collect()}
        assert got == {f"v{i}": "v0" for i in range(6)} and stored["cc-edges"][0] == 6
    # d0 joins g, then d1 by d0, then d2 by d1: an edge of d(i) comes from d(i-1), one leads to g.
    edges = [("p", "g" if i == 0 else f"d{i - 1}", f"d{i}") for i in range(3)] + [("p", f"d{i}", "g") for i in range(3)]
    default = spark.createDataFrame([("p", f"d{i}") for i in range(4)], "pipeline string, node string")
    groups = spark.createDataFrame([("p", "g", "g")], "pipeline string, node string, group_id string")
    got = {r.node for r in graph.absorb_sandwiched(spark.createDataFrame(edges, schema), groups, default).collect()}
    assert got == {"d0", "d1", "d2"} and sum(stored["absorb-members"]) == 1
