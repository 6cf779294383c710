"""Registered queries: one per operator of the inventory, each reading the
driver tables of ``sf_dir`` (through ``bindings``) and returning a
DataFrame.  Next to each query is the DuckDB SQL that computes the same
rows independently from the same tables (the correctness oracle).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bindings as B
from .operators import classify, cycles, edges, graph, group_store
from .plans.grouping import group_pipeline, group_summary
from .session import cut_lineage, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco


# --------------------------------------------------------------------------
# SQL building blocks for the layered DAG (FIXTURES.md §3).

#: Rounds of absorption written out in SQL; more than the data need, the last ones add nothing.
ABSORB_ROUNDS = 10


def _absorb_sql(rounds: int) -> str:
    """Absorption, round by round: a default node joins the smallest group
    that both writes one of its inputs and reads one of its outputs."""
    parts = ["m0 AS MATERIALIZED (SELECT node, group_id FROM comp)"]
    for i in range(rounds):
        parts.append(
            f"""m{i + 1} AS MATERIALIZED (
  SELECT node, group_id FROM m{i}
  UNION ALL
  SELECT n.node, min(pg.group_id) FROM nodes n
  JOIN (SELECT e.child AS node, m.group_id FROM edges e JOIN m{i} m ON e.parent = m.node) pg ON pg.node = n.node
  JOIN (SELECT e.parent AS node, m.group_id FROM edges e JOIN m{i} m ON e.child = m.node) cg
    ON cg.node = n.node AND cg.group_id = pg.group_id
  WHERE NOT n.is_spark AND n.node NOT IN (SELECT node FROM m{i}) GROUP BY n.node
)"""
        )
    parts.append(f"members AS (SELECT node, group_id FROM m{rounds})")
    parts.append("absorbed AS (SELECT node, group_id FROM members WHERE node NOT IN (SELECT node FROM sn))")
    # 0 if the last written round added nothing.
    parts.append(f"unfinished AS (SELECT (SELECT count(*) FROM m{rounds}) - (SELECT count(*) FROM m{rounds - 1}) AS n)")
    return ",\n".join(parts)


def _layered_sql(dense: bool) -> str:
    nation_mark = "true" if dense else "false"
    return f"""
nodes AS (
  SELECT 'p' || p_partkey AS node, (p_type = 'PROMO' AND p_size <= 5) AS is_spark FROM part
  UNION ALL SELECT 'o' || o_orderkey, o_orderpriority = '1-URGENT' FROM orders
  UNION ALL SELECT 'c' || c_custkey, c_mktsegment = 'BUILDING' FROM customer
  UNION ALL SELECT 'n' || n_nationkey, {nation_mark} FROM nation
),
edges AS (
  SELECT DISTINCT 'p' || l_partkey AS parent, 'o' || l_orderkey AS child FROM lineitem
  UNION SELECT 'o' || o_orderkey, 'c' || o_custkey FROM orders
  UNION SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer
),
sn AS (SELECT node FROM nodes WHERE is_spark),
se AS (SELECT parent AS a, child AS b FROM edges
       WHERE parent IN (SELECT node FROM sn) AND child IN (SELECT node FROM sn)),
und AS (SELECT a, b FROM se UNION SELECT b, a FROM se),
reach(node, lbl) AS (
  SELECT node, node FROM sn
  UNION SELECT u.b, r.lbl FROM reach r JOIN und u ON r.node = u.a
),
comp AS (SELECT node, min(lbl) AS group_id FROM reach GROUP BY node),
{_absorb_sql(ABSORB_ROUNDS)},
allg AS (
  SELECT node, group_id, 'pyspark_' || CAST(dense_rank() OVER (ORDER BY group_id) - 1 AS VARCHAR) AS group_name,
         'pyspark' AS group_type FROM members
  UNION ALL
  SELECT node, node, node, 'default' FROM nodes
  WHERE NOT is_spark AND node NOT IN (SELECT node FROM absorbed)
),
gedges AS (
  SELECT DISTINCT a.group_name AS parent_group, b.group_name AS child_group
  FROM edges e JOIN allg a ON e.parent = a.node JOIN allg b ON e.child = b.node
  WHERE a.group_name <> b.group_name
)"""


def _layered(spark: SparkSession, sf_dir: str, marks: str = "sparse", store_io: bool = False):
    return B.layered_dag(spark, sf_dir, marks, store_io)


def _marked_edges(spark: SparkSession, sf_dir: str, marks: str):
    """P1 and J1 on the layered DAG, each stored once for the loops after."""
    nodes, io, cat = _layered(spark, sf_dir, marks, store_io=True)
    marked = cut_lineage(classify.mark_spark_nodes(nodes, io, cat).select("pipeline", "node", "is_spark"), "marked")
    return marked, cut_lineage(edges.dataset_edges(io), "edges")


# --------------------------------------------------------------------------
# Graph family: P1, P5, J1, G1, J3, W2, J4, J7, A1, A2, G2, G3, G4.

@register(
    "g3_group_pipeline",
    "WITH RECURSIVE " + _layered_sql(False) + """
SELECT 'layered' AS pipeline, g.group_name, g.group_type, count(*) AS n_nodes, min(g.node) AS first_node,
       coalesce(ch.n, 0) AS n_children, coalesce(pa.n, 0) AS n_parents
FROM allg g
LEFT JOIN (SELECT parent_group, count(*) AS n FROM gedges GROUP BY 1) ch ON ch.parent_group = g.group_name
LEFT JOIN (SELECT child_group, count(*) AS n FROM gedges GROUP BY 1) pa ON pa.child_group = g.group_name
GROUP BY g.group_name, g.group_type, ch.n, pa.n
""",
)
def g3_group_pipeline(spark, sf_dir):
    """Flagship: group the layered DAG (sparse marks) and summarise groups."""
    nodes, io, cat = _layered(spark, sf_dir, "sparse", store_io=True)
    return group_summary(group_pipeline(nodes, io, cat, grouped=True))


@register(
    "p1_mark_spark_nodes",
    "WITH " + _layered_sql(True).split("sn AS")[0].rstrip().rstrip(",") + """
SELECT 'layered' AS pipeline, node, is_spark FROM nodes
""",
)
def p1_mark_spark_nodes(spark, sf_dir):
    nodes, io, cat = _layered(spark, sf_dir, "dense")
    return classify.mark_spark_nodes(nodes, io, cat).select("pipeline", "node", "is_spark")


@register(
    "p5_select_nodes",
    """
SELECT 'layered' AS pipeline, 'n' || n_nationkey AS node FROM nation
UNION ALL SELECT 'layered', 'c' || c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'
""",
)
def p5_select_nodes(spark, sf_dir):
    """Slice one pipeline by a node-name list that is itself a table (the
    BUILDING customers and all nations), i.e. the semi-join form."""
    nodes, _, _ = _layered(spark, sf_dir)
    cust = B.table(spark, sf_dir, "customer")
    names = (
        B.table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("node"))
        .unionByName(
            cust.filter(F.col("c_mktsegment") == "BUILDING").select(
                F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("node")
            )
        )
    )
    return classify.select_nodes(nodes, B.LAYERED, names).select("pipeline", "node")


@register(
    "j1_dataset_edges",
    "WITH " + _layered_sql(False).split("sn AS")[0].rstrip().rstrip(",") + """
SELECT 'layered' AS pipeline, parent, child FROM edges
""",
)
def j1_dataset_edges(spark, sf_dir):
    _, io, _ = _layered(spark, sf_dir)
    return edges.dataset_edges(io)


#: Rounds of smallest labels written out in SQL; more than the data need, the last ones change nothing.
LABEL_ROUNDS = 12


def _label_sql(rounds: int) -> str:
    """Smallest labels, round by round: a node takes the smallest label among its own and its neighbours'."""
    return ",\n".join(
        f"""l{i + 1} AS MATERIALIZED (
  SELECT l.node, least(l.group_id, min(n.group_id)) AS group_id
  FROM l{i} l JOIN und u ON u.a = l.node JOIN l{i} n ON n.node = u.b GROUP BY l.node, l.group_id
)"""
        for i in range(rounds)
    )


_LINK_GROUPS_SQL = f"""
WITH e AS MATERIALIZED (SELECT DISTINCT 'o' || l_orderkey AS a, 'p' || l_partkey AS b FROM lineitem),
und AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
l0 AS MATERIALIZED (SELECT DISTINCT a AS node, a AS group_id FROM und),
{_label_sql(LABEL_ROUNDS)}
SELECT 'bipartite' AS pipeline, node, group_id FROM l{LABEL_ROUNDS}
-- Proof that the rounds suffice: rows that no result has if the last one changed labels.
UNION ALL SELECT 'more rounds needed', x.node, NULL FROM l{LABEL_ROUNDS} x JOIN l{LABEL_ROUNDS - 1} y ON y.node = x.node
WHERE x.group_id <> y.group_id
"""


@register("g1_connected_groups", _LINK_GROUPS_SQL)
def g1_connected_groups(spark, sf_dir):
    """Groups of the whole order–part graph, every distinct link of lineitem."""
    e = cut_lineage(B.order_part_links(spark, sf_dir), "links")
    v = e.select("pipeline", F.col("parent").alias("node")).unionByName(e.select("pipeline", F.col("child").alias("node")))
    return graph.connected_groups(v, e, closed=True)


@register("g1_connected_groups_links", _LINK_GROUPS_SQL)
def g1_connected_groups_links(spark, sf_dir):
    """The same graph, kept up to date: its links arrive in three increments (by line
    number), orders with their first lines, parts only in the second increment."""
    li = B.table(spark, sf_dir, "lineitem")
    area, at = scratch_path(spark, "group-store"), F.least(F.floor((F.col("l_linenumber") - 1) / 2), F.lit(2)).cast("int")
    links = cut_lineage(B.order_part_links(spark, sf_dir, at.alias("at")), "links")
    for i in range(3):
        e = links.filter(F.col("at") == i).drop("at")
        v = e.select("pipeline", F.col("parent").alias("node"))
        if i:
            v = v.unionByName(links.filter(F.col("at") <= i).select("pipeline", F.col("child").alias("node")))
        group_store.add_to_groups(area, i, v, e)
    return group_store.stored_groups(spark, area)


@register(
    "g1_connected_groups_layered",
    "WITH RECURSIVE " + _layered_sql(False).split("m0 AS")[0].rstrip().rstrip(",") + """
SELECT 'layered' AS pipeline, node, group_id FROM comp
""",
)
def g1_connected_groups_layered(spark, sf_dir):
    marked, e = _marked_edges(spark, sf_dir, "sparse")
    return graph.connected_groups(marked.filter("is_spark").select("pipeline", "node"), e)


def _dense_components(spark, sf_dir):
    marked, e = _marked_edges(spark, sf_dir, "dense")
    spark_nodes = marked.filter("is_spark").select("pipeline", "node")
    comp = graph.connected_groups(spark_nodes, e)
    return marked, e, comp


_ABSORB_SQL = (
    "WITH RECURSIVE "
    + _layered_sql(True).split("allg AS")[0].rstrip().rstrip(",")
    + """
SELECT 'layered' AS pipeline, node, group_id FROM absorbed
-- Proof that the rounds suffice: a row that no result has if the last one added nodes.
UNION ALL SELECT 'more rounds needed', CAST(n AS VARCHAR), NULL FROM unfinished WHERE n > 0
"""
)


@register("j3_absorb_sandwiched", _ABSORB_SQL)
def j3_absorb_sandwiched(spark, sf_dir):
    """Absorption on the dense-marked DAG, repeated until nothing changes."""
    marked, e, comp = _dense_components(spark, sf_dir)
    defaults = marked.filter(~F.col("is_spark")).select("pipeline", "node")
    return graph.absorb_sandwiched(e, comp, defaults)


@register("j3_absorb_fixpoint", _ABSORB_SQL)
def j3_absorb_fixpoint(spark, sf_dir):
    """The same, as the grouping plan finds it: what its groups hold beyond the marked nodes."""
    nodes, io, cat = _layered(spark, sf_dir, "dense", store_io=True)
    marked = classify.mark_spark_nodes(nodes, io, cat).filter("is_spark").select("pipeline", "node")
    g = group_pipeline(nodes, io, cat, grouped=True).groups.filter(F.col("group_type") == "pyspark")
    return g.join(marked, ["pipeline", "node"], "left_anti").select("pipeline", "node", "group_id")


@register(
    "w2_renumber_groups",
    "WITH RECURSIVE " + _layered_sql(False).split("m0 AS")[0].rstrip().rstrip(",") + """
SELECT DISTINCT 'layered' AS pipeline, group_id,
       'pyspark_' || CAST(dense_rank() OVER (ORDER BY group_id) - 1 AS VARCHAR) AS group_name
FROM comp
""",
)
def w2_renumber_groups(spark, sf_dir):
    comp = g1_connected_groups_layered(spark, sf_dir)
    return graph.renumber_groups(comp.select("pipeline", "group_id").distinct())


def _sparse_grouping(spark, sf_dir):
    nodes, io, cat = _layered(spark, sf_dir, "sparse", store_io=True)
    return io, group_pipeline(nodes, io, cat, grouped=True)


@register(
    "j4_contract_edges",
    "WITH RECURSIVE " + _layered_sql(False) + """
SELECT 'layered' AS pipeline, parent_group, child_group FROM gedges
""",
)
def j4_contract_edges(spark, sf_dir):
    _, g = _sparse_grouping(spark, sf_dir)
    return g.group_edges


@register(
    "j7_boundary_datasets",
    "WITH RECURSIVE " + _layered_sql(False) + """,
links AS (
  SELECT DISTINCT 'dp' || l_partkey AS dataset, 'p' || l_partkey AS parent, 'o' || l_orderkey AS child FROM lineitem
  UNION ALL SELECT 'do' || o_orderkey, 'o' || o_orderkey, 'c' || o_custkey FROM orders
  UNION ALL SELECT 'dc' || c_custkey, 'c' || c_custkey, 'n' || c_nationkey FROM customer
)
SELECT DISTINCT 'layered' AS pipeline, l.dataset
FROM links l JOIN allg a ON a.node = l.parent JOIN allg b ON b.node = l.child
WHERE a.group_name <> b.group_name
""",
)
def j7_boundary_datasets(spark, sf_dir):
    io, g = _sparse_grouping(spark, sf_dir)
    return edges.boundary_datasets(io, g.groups, "group_name")


@register(
    "a1_children_of",
    "WITH " + _layered_sql(False).split("sn AS")[0].rstrip().rstrip(",") + """
SELECT 'layered' AS pipeline, parent, chunk, string_agg(child, ',' ORDER BY child) AS children, any_value(n) AS n_children
FROM (SELECT parent, child, count(*) OVER (PARTITION BY parent) AS n,
        (row_number() OVER (PARTITION BY parent ORDER BY child) - 1) // 10000 AS chunk FROM edges)
GROUP BY parent, chunk
""",
)
def a1_children_of(spark, sf_dir):
    _, io, _ = _layered(spark, sf_dir)
    out = edges.children_of(edges.dataset_edges(io))
    return out.select("pipeline", "parent", "chunk", F.concat_ws(",", "children").alias("children"), "n_children")


@register(
    "a2_group_members",
    "WITH RECURSIVE " + _layered_sql(False) + """
SELECT 'layered' AS pipeline, group_name, chunk, string_agg(node, ',' ORDER BY node) AS member_list, any_value(n) AS n_members
FROM (SELECT group_name, node, count(*) OVER (PARTITION BY group_name) AS n,
        (row_number() OVER (PARTITION BY group_name ORDER BY node) - 1) // 10000 AS chunk FROM allg)
GROUP BY group_name, chunk
""",
)
def a2_group_members(spark, sf_dir):
    _, g = _sparse_grouping(spark, sf_dir)
    out = edges.group_members(g.groups, "group_name")
    return out.select("pipeline", "group_name", "chunk", "member_list", "n_members")


@register(
    "a2_type_members",
    "WITH RECURSIVE " + _layered_sql(False) + """
SELECT 'layered' AS pipeline, group_type, chunk, string_agg(node, ',' ORDER BY node) AS member_list, any_value(n) AS n_members
FROM (SELECT group_type, node, count(*) OVER (PARTITION BY group_type) AS n,
        (row_number() OVER (PARTITION BY group_type ORDER BY node) - 1) // 1000 AS chunk FROM allg)
GROUP BY group_type, chunk
""",
)
def a2_type_members(spark, sf_dir):
    """Node set and count of each group type, in lists of at most 1,000."""
    _, g = _sparse_grouping(spark, sf_dir)
    return edges.type_members(g.groups, max_per_row=1000).select("pipeline", "group_type", "chunk", "member_list", "n_members")


@register(
    "f9_split_list",
    "WITH RECURSIVE " + _layered_sql(False) + """
SELECT 'layered' AS pipeline, group_name, node FROM allg
""",
)
def f9_split_list(spark, sf_dir):
    """Round trip of the comma member list of every group back to rows."""
    from .functions.text import split_list

    _, g = _sparse_grouping(spark, sf_dir)
    lists = edges.group_members(g.groups, "group_name")
    return lists.select("pipeline", "group_name", F.explode(split_list("member_list")).alias("node"))


@register(
    "g2_singleton_groups",
    "WITH " + _layered_sql(False).split("sn AS")[0].rstrip().rstrip(",") + """,
gedges AS (SELECT DISTINCT parent AS parent_group, child AS child_group FROM edges)
SELECT 'layered' AS pipeline, n.node AS group_name,
       CASE WHEN n.is_spark THEN 'pyspark' ELSE 'default' END AS group_type,
       CAST(1 AS BIGINT) AS n_nodes, n.node AS first_node,
       coalesce(ch.n, 0) AS n_children, coalesce(pa.n, 0) AS n_parents
FROM nodes n
LEFT JOIN (SELECT parent_group, count(*) AS n FROM gedges GROUP BY 1) ch ON ch.parent_group = n.node
LEFT JOIN (SELECT child_group, count(*) AS n FROM gedges GROUP BY 1) pa ON pa.child_group = n.node
""",
)
def g2_singleton_groups(spark, sf_dir):
    nodes, io, cat = _layered(spark, sf_dir, "sparse", store_io=True)
    return group_summary(group_pipeline(nodes, io, cat, grouped=False))


@register(
    "g3_group_pipeline_dense",
    "WITH RECURSIVE " + _layered_sql(True) + """
SELECT 'layered' AS pipeline, group_name, group_type, count(*) AS n_nodes, min(node) AS first_node
FROM allg GROUP BY group_name, group_type
""",
)
def g3_group_pipeline_dense(spark, sf_dir):
    """Grouping of the dense-marked DAG, where absorption takes several rounds."""
    nodes, io, cat = _layered(spark, sf_dir, "dense", store_io=True)
    summary = group_summary(group_pipeline(nodes, io, cat, grouped=True))
    return summary.select("pipeline", "group_name", "group_type", "n_nodes", "first_node")


@register(
    "g4_dag_levels",
    "WITH RECURSIVE " + _layered_sql(True) + """,
down(a, b) AS (
  SELECT parent_group, child_group FROM gedges WHERE parent_group IN (SELECT child_group FROM gedges)
  UNION SELECT d.a, g.child_group FROM down d JOIN gedges g ON g.parent_group = d.b),
looped AS (SELECT DISTINCT a AS g FROM down WHERE a = b),
lost AS (SELECT g FROM looped UNION SELECT d.b FROM down d JOIN looped l ON l.g = d.a),
ok AS (SELECT parent_group, child_group FROM gedges
       WHERE parent_group NOT IN (SELECT g FROM lost) AND child_group NOT IN (SELECT g FROM lost)),
depth(g, n) AS (
  SELECT group_name, 0 FROM allg WHERE group_name NOT IN (SELECT g FROM lost)
  UNION SELECT ok.child_group, d.n + 1 FROM depth d JOIN ok ON ok.parent_group = d.g)
SELECT 'layered' AS pipeline, g AS "group", CAST(max(n) AS INTEGER) AS level, false AS cyclic FROM depth GROUP BY g
UNION ALL SELECT DISTINCT 'layered', g, CAST(NULL AS INTEGER), true FROM lost
""",
)
def g4_dag_levels(spark, sf_dir):
    """Levels of the grouped dense-marked DAG (contraction makes cycles there)."""
    nodes, io, cat = _layered(spark, sf_dir, "dense", store_io=True)
    g = group_pipeline(nodes, io, cat, grouped=True)
    groups = g.groups.select("pipeline", F.col("group_name").alias("group")).distinct()
    return graph.dag_levels(g.group_edges, groups)


@register(
    "g4_condensed_levels",
    "WITH RECURSIVE " + _layered_sql(True) + """,
down(a, b) AS (
  SELECT parent_group, child_group FROM gedges WHERE parent_group IN (SELECT child_group FROM gedges)
  UNION SELECT d.a, g.child_group FROM down d JOIN gedges g ON g.parent_group = d.b),
looped AS (SELECT x.a AS g, min(x.b) AS cycle_id FROM down x JOIN down y ON y.a = x.b AND y.b = x.a GROUP BY x.a),
below AS (SELECT DISTINCT d.b AS g FROM down d JOIN looped l ON l.g = d.a WHERE d.b NOT IN (SELECT g FROM looped)),
unit AS (
  SELECT DISTINCT a.group_name AS g, l.cycle_id, coalesce(l.cycle_id, a.group_name) AS u
  FROM allg a LEFT JOIN looped l ON l.g = a.group_name),
cedges AS (
  SELECT DISTINCT p.u AS pu, c.u AS cu FROM gedges e JOIN unit p ON p.g = e.parent_group JOIN unit c ON c.g = e.child_group
  WHERE p.u <> c.u),
depth(u, n) AS (
  SELECT DISTINCT u, 0 FROM unit
  UNION SELECT cedges.cu, d.n + 1 FROM depth d JOIN cedges ON cedges.pu = d.u)
SELECT 'layered' AS pipeline, unit.g AS "group", CAST(max(d.n) AS INTEGER) AS level, unit.cycle_id,
       unit.g IN (SELECT g FROM below) AS below_cycle
FROM unit JOIN depth d ON d.u = unit.u GROUP BY unit.g, unit.cycle_id
""",
)
def g4_condensed_levels(spark, sf_dir):
    """Cycles of the grouped dense-marked DAG, and levels in which a cycle is one group."""
    nodes, io, cat = _layered(spark, sf_dir, "dense", store_io=True)
    g = group_pipeline(nodes, io, cat, grouped=True)
    groups = g.groups.select("pipeline", F.col("group_name").alias("group")).distinct()
    return cycles.condensed_levels(g.group_edges, groups)


# Other families register themselves on import.
from . import queries_runs  # noqa: E402,F401
from . import queries_values  # noqa: E402,F401
from . import queries_io  # noqa: E402,F401
from . import queries_stream  # noqa: E402,F401
