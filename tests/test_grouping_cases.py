"""Grouping cases as small pipeline tables, plus quirk cases."""

from flowtables.constants import SPARK_FRAME_CLASS, SPARK_GROUP_TAG
from flowtables.model import pipeline_tables
from flowtables.operators.graph import dag_levels
from flowtables.plans.grouping import group_pipeline

S, C = "SparkDataSet", "CSVDataSet"


def run(spark, nodes, catalog, grouped=True):
    n, io, cat = pipeline_tables(spark, nodes, catalog)
    g = group_pipeline(n, io, cat, grouped=grouped)
    groups = {}
    for r in g.groups.collect():
        groups.setdefault(r.group_name, {"type": r.group_type, "nodes": set()})["nodes"].add(r.node)
    children = {name: set() for name in groups}
    for r in g.group_edges.collect():
        children[r.parent_group].add(r.child_group)
    return groups, children


def node(name, inputs, outputs, **kw):
    return {"name": name, "inputs": inputs, "outputs": outputs, **kw}


def test_empty(spark):
    groups, _ = run(spark, [], {})
    assert groups == {}


def test_only_spark(spark):
    groups, children = run(
        spark,
        [node("node1", ["s1"], ["s2"]), node("node2", ["s2"], ["s3"])],
        {"s1": S, "s2": S, "s3": S},
    )
    assert list(groups) == ["pyspark_0"]
    assert groups["pyspark_0"] == {"type": "pyspark", "nodes": {"node1", "node2"}}
    assert children["pyspark_0"] == set()


def test_only_default(spark):
    groups, children = run(
        spark,
        [node("node1", ["p1"], ["p2"]), node("node2", ["p2"], ["p3"])],
        {"p1": C, "p2": C, "p3": C},
    )
    assert groups == {
        "node1": {"type": "default", "nodes": {"node1"}},
        "node2": {"type": "default", "nodes": {"node2"}},
    }
    assert children == {"node1": {"node2"}, "node2": set()}


def test_typed_intermediates(spark):
    groups, _ = run(
        spark,
        [
            node("node1", ["s1"], ["s2"]),
            node("node2", ["s2"], ["s3"], param_types=[SPARK_FRAME_CLASS], return_type=SPARK_FRAME_CLASS),
            node("node3", ["s3"], ["s4"]),
        ],
        {"s1": S, "s4": S},
    )
    assert groups == {"pyspark_0": {"type": "pyspark", "nodes": {"node1", "node2", "node3"}}}


def test_mixed(spark):
    groups, children = run(
        spark,
        [node("node1", ["s1"], ["s2"]), node("node2", ["s2"], ["s3"]), node("node3", ["p1"], ["p2"])],
        {"s1": S, "s3": S, "p1": C, "p2": C},
    )
    assert groups == {
        "pyspark_0": {"type": "pyspark", "nodes": {"node1", "node2"}},
        "node3": {"type": "default", "nodes": {"node3"}},
    }
    assert children == {"pyspark_0": set(), "node3": set()}


def test_interleaved(spark):
    groups, children = run(
        spark,
        [node("node1", ["p0"], ["s1"]), node("node2", ["s1", "p2"], ["s2"]), node("node3", ["p1"], ["p2"])],
        {"s1": S, "s2": S, "p0": C, "p1": C, "p2": C},
    )
    assert groups["pyspark_0"] == {"type": "pyspark", "nodes": {"node1", "node2"}}
    assert groups["node3"]["type"] == "default"
    assert children["node3"] == {"pyspark_0"}


def test_two_spark_subdags(spark):
    groups, children = run(
        spark,
        [
            node("node1", ["s1"], ["s2"]),
            node("node2", ["s2"], ["p1"]),
            node("node3", ["p1"], ["p2"]),
            node("node4", ["p2"], ["s3"]),
            node("node5", ["s3"], ["s4"]),
        ],
        {"s1": S, "s2": S, "p1": C, "p2": C, "p3": C, "s3": S, "s4": S},
    )
    assert sorted(groups) == ["node3", "pyspark_0", "pyspark_1"]
    assert groups["pyspark_0"]["nodes"] == {"node1", "node2"}
    assert groups["pyspark_1"]["nodes"] == {"node4", "node5"}
    assert children == {"pyspark_0": {"node3"}, "node3": {"pyspark_1"}, "pyspark_1": set()}


def test_tag(spark):
    groups, children = run(
        spark,
        [node("node3", ["p1"], ["p2"], tags=[SPARK_GROUP_TAG]), node("node4", ["p2"], ["p3"])],
        {"p1": C, "p3": C},
    )
    assert groups["pyspark_0"] == {"type": "pyspark", "nodes": {"node3"}}
    assert children["pyspark_0"] == {"node4"}


def test_sandwiched(spark):
    groups, _ = run(
        spark,
        [
            node("node1", ["s1"], ["s2", "p1"]),
            node("node2", ["s2", "p2"], ["s3"]),
            node("node3", ["p1"], ["p2"]),
        ],
        {"s1": S, "s2": S, "p1": C, "p2": C, "s3": S},
    )
    assert groups == {"pyspark_0": {"type": "pyspark", "nodes": {"node1", "node2", "node3"}}}


def test_ungrouped(spark):
    groups, children = run(
        spark,
        [node("node1", ["s1"], ["s2"]), node("node2", ["s2"], ["s3"]), node("node3", [], ["p1"])],
        {"s1": S, "s2": S, "s3": S, "p1": C},
        grouped=False,
    )
    assert groups == {
        "node1": {"type": "pyspark", "nodes": {"node1"}},
        "node2": {"type": "pyspark", "nodes": {"node2"}},
        "node3": {"type": "default", "nodes": {"node3"}},
    }
    assert children == {"node1": {"node2"}, "node2": set(), "node3": set()}


# ---- our own cases -------------------------------------------------------

def test_two_defaults_between_one_group(spark):
    """a(spark) → d1 → d2 → b(spark), plus a → d2 and d1 → b: both defaults
    are sandwiched in the first round."""
    groups, _ = run(
        spark,
        [
            node("a", ["s0"], ["x1", "x2", "s1"]),
            node("d1", ["x1"], ["y1", "y2"]),
            node("d2", ["y1", "x2"], ["z1"]),
            node("b", ["z1", "y2", "s1"], ["s9"]),
        ],
        {"s0": S, "s1": S, "s9": S},
    )
    assert groups == {"pyspark_0": {"type": "pyspark", "nodes": {"a", "b", "d1", "d2"}}}


def test_absorbed_in_second_round(spark):
    """e is sandwiched by the group only once d (sandwiched in round one)
    belongs to it: a → d, d → b; e reads d's output and writes into b."""
    groups, _ = run(
        spark,
        [
            node("a", ["s0"], ["s1", "x"]),
            node("b", ["s1", "y", "w"], ["s9"]),
            node("d", ["x"], ["y", "v"]),
            node("e", ["v"], ["w"]),
        ],
        {"s0": S, "s1": S, "s9": S},
    )
    assert groups == {"pyspark_0": {"type": "pyspark", "nodes": {"a", "b", "d", "e"}}}


def test_default_node_fitting_two_groups_takes_smallest(spark):
    """d sits between a1 → b1 (group with smallest member a1) and between
    a2 → b2 (smallest member a2): it joins the first only."""
    groups, _ = run(
        spark,
        [
            node("a1", ["s0"], ["s1", "x1"]),
            node("b1", ["s1", "y"], ["s2"]),
            node("a2", ["t0"], ["t1", "x2"]),
            node("b2", ["t1", "y"], ["t2"]),
            node("d", ["x1", "x2"], ["y"]),
        ],
        {"s0": S, "s1": S, "s2": S, "t0": S, "t1": S, "t2": S},
    )
    assert groups == {
        "pyspark_0": {"type": "pyspark", "nodes": {"a1", "b1", "d"}},
        "pyspark_1": {"type": "pyspark", "nodes": {"a2", "b2"}},
    }


def test_contraction_cycle_is_reported(spark):
    """A → d1 → d2 → B with A → B: contraction gives a cycle {A,B} → d1 → d2 → {A,B}."""
    n, io, cat = pipeline_tables(
        spark,
        [
            node("A", ["s0"], ["s1", "x"]),
            node("B", ["s1", "y"], ["s2"]),
            node("d1", ["x"], ["m"]),
            node("d2", ["m"], ["y"]),
        ],
        {"s0": S, "s1": S, "s2": S},
    )
    g = group_pipeline(n, io, cat, grouped=True)
    groups = g.groups.select("pipeline", g.groups.group_name.alias("group")).distinct()
    levels = {r.group: (r.level, r.cyclic) for r in dag_levels(g.group_edges, groups).collect()}
    assert levels == {"pyspark_0": (None, True), "d1": (None, True), "d2": (None, True)}
