"""Iterative graph operators: connected groups (G1), absorption of sandwiched
nodes (J3), singleton groups (G2), group numbering (W2) and levels (G4).

Each loop runs one distributed round per iteration (joins + partial
aggregations, no collect) and stores the round's output with
``cut_lineage`` so the next round plans from files.  The loop ends on a
count of changed rows, which is the only value brought to the driver.
Every round only touches the rows that changed in the round before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import GROUP_DEFAULT, GROUP_SPARK, SPARK_GROUP_NAME_PREFIX
from ..session import cut_lineage, cut_lineage_counting, stored_once, stored_rounds
from .ranking import dense_number_within

K = ["pipeline", "node"]


def _links(edges: DataFrame) -> DataFrame:
    """Edges without direction, ``src`` the smaller end; repeats stay."""
    e = edges.select("pipeline", F.col("parent").alias("src"), F.col("child").alias("dst")).filter("pipeline IS NOT NULL AND src <> dst")
    return e.select("pipeline", F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))


def connected_groups(
    vertices: DataFrame,
    edges: DataFrame,
    jumps: int = 0,
    closed: bool = False,
) -> DataFrame:
    """G1: ``(pipeline, node, group_id)``, group id = smallest node name in
    the component, direction ignored.

    ``vertices(pipeline, node)`` are the nodes to group; ``edges(pipeline,
    parent, child)`` are kept only where both ends are vertices; with
    ``closed`` the caller knows that all are, and none is looked up.

    Graph contraction: every node starts with its own label.  An edge is one
    row, its smaller end first.  Each round, every label with a smaller one
    beside it hooks to the smallest of them (a partial aggregate, so a hub is
    combined map-side), the hooks are
    shortened by pointer jumping, and the edge list is rewritten between
    the new labels, dropping edges that fell inside one label.  The number
    of labels with edges falls geometrically, so rounds grow with the log
    of the component size, and every round works on a smaller edge list.
    A node's final label is its start label sent through each round's hook
    table.  Labels only fall and never leave the component, so the last
    label is the component's smallest node.  The node comes before the pipeline in
    keys: rows of one pipeline are sorted by their first letters instead of as a whole.
    """
    with stored_rounds(vertices.sparkSession) as keep:
        return _contract(vertices, edges, jumps, closed, keep)


def _contract(vertices: DataFrame, edges: DataFrame, jumps: int, closed: bool, keep) -> DataFrame:
    # Callers pass stored frames (the grouping plan stores its marks), so the
    # two reads of the vertices below cost a scan each, not a recomputation.
    v = vertices.select(*K).distinct()
    links = _links(edges)
    if not closed:
        for end in ("src", "dst"):
            links = links.join(v.select("pipeline", F.col("node").alias(end)), [end, "pipeline"], "left_semi").select("pipeline", "src", "dst")
    links, seen = cut_lineage_counting(links, "cc-edges", n=F.count(F.lit(1)))
    hooks: list[DataFrame] = []
    while seen["n"]:  # each round leaves at most half of the labels that have edges
        hook = links.groupBy(F.col("dst").alias("label"), "pipeline").agg(F.min("src").alias("to"))
        # Stored before it is joined with itself.
        hook = cut_lineage(hook, "cc-hooks")
        # Shorten hook chains by pointer jumping until every label points at
        # a root; a chain of length d needs about log2(d) jumps.
        while True:
            for _ in range(jumps):
                hook = _jump(hook)
            hop = hook.select("pipeline", F.col("label").alias("to"), F.col("to").alias("_hop"))
            hook = hook.join(hop, ["to", "pipeline"], "left").select(
                "pipeline", "label", F.coalesce("_hop", "to").alias("to"), (F.coalesce("_hop", "to") != F.col("to")).alias("_moved")
            )
            hook, jumped = cut_lineage_counting(hook, "cc-hooks", moved=F.count_if("_moved"))
            hook = hook.drop("_moved")
            if not jumped["moved"]:
                break
        hooks.append(hook)
        to_src = hook.select("pipeline", F.col("label").alias("src"), F.col("to").alias("_s"))
        # Every larger end has a hook.
        to_dst = hook.select("pipeline", F.col("label").alias("dst"), F.col("to").alias("_d"))
        met = (
            links.join(to_dst, ["dst", "pipeline"])
            .join(to_src, ["src", "pipeline"], "left")
            .select("pipeline", F.coalesce("_s", "src").alias("parent"), F.col("_d").alias("child"))
        )
        relinked = _links(met).distinct()
        links, seen = cut_lineage_counting(relinked, "cc-edges", n=F.count(F.lit(1)))
    labels = v.withColumn("group_id", F.col("node"))
    for i, moved in enumerate(hooks):
        step = moved.select("pipeline", F.col("label").alias("group_id"), F.col("to").alias("_to"))
        labels = labels.join(step, ["group_id", "pipeline"], "left").select(
            *K, F.coalesce("_to", "group_id").alias("group_id")
        )
        if i % 8 == 7 and i + 1 < len(hooks):
            labels = cut_lineage(labels, "cc-labels")
    # Stored: callers read the labels several times.
    return keep(cut_lineage(labels, "cc-labels")) if hooks else labels


def _jump(hook: DataFrame) -> DataFrame:
    hop = hook.select("pipeline", F.col("label").alias("to"), F.col("to").alias("_hop"))
    return hook.join(hop, ["to", "pipeline"], "left").select("pipeline", "label", F.coalesce("_hop", "to").alias("to"))


def absorb_sandwiched(
    edges: DataFrame,
    spark_groups: DataFrame,
    default_nodes: DataFrame,
    max_rounds: int | None = None,
) -> DataFrame:
    """Default nodes that join a Spark group ``(pipeline, node, group_id)``.

    A default node joins group G when one of its inputs is written by a
    member of G and one of its outputs is read by a member of G.  Joining
    enlarges G, which can make further nodes qualify, so rounds repeat until
    nothing changes (``max_rounds=1`` gives the single-pass form).  A node
    that qualifies for several groups in the same round takes the smallest
    group id.  After the first round only the edges of newly absorbed nodes
    are looked at; what was found beside earlier members is kept.
    """
    with stored_rounds(edges.sparkSession) as keep:
        return _absorb(edges, spark_groups, default_nodes, max_rounds, keep)


def _absorb(edges: DataFrame, spark_groups: DataFrame, default_nodes: DataFrame, max_rounds: int | None, keep) -> DataFrame:
    e = edges.select("pipeline", "parent", "child")
    new = cut_lineage(spark_groups.select(*K, "group_id"), "absorb-members")
    pending = cut_lineage(default_nodes.select(*K).distinct(), "absorb-pending")
    absorbed: DataFrame | None = None
    # Groups that a node reads from and is read by, as far as seen and still open.
    sides: dict[str, DataFrame | None] = {"child": None, "parent": None}
    rounds = 0
    while max_rounds is None or rounds < max_rounds:
        rounds += 1
        for end, other in (("child", "parent"), ("parent", "child")):
            # Members first: few edges lead to the new ones, many to open nodes.
            beside = (
                e.join(new.withColumnRenamed("node", other), ["pipeline", other])
                .select("pipeline", F.col(end).alias("node"), "group_id")
                .distinct()
            )
            before = sides[end]
            # A pair may come twice, by members of different rounds.
            near = (beside if before is None else before.unionByName(beside)).join(pending, K, "left_semi")
            sides[end] = cut_lineage(near, f"absorb-{end}")
        chosen = (
            sides["child"].join(sides["parent"], [*K, "group_id"], "left_semi")
            .groupBy(*K)
            .agg(F.min("group_id").alias("group_id"))
        )
        new, seen = cut_lineage_counting(chosen, "absorb-new", n=F.count(F.lit(1)))
        if not seen["n"]:
            break
        # Stored each round, so that a round's plan does not grow with their number.
        absorbed = new if absorbed is None else cut_lineage(absorbed.unionByName(new), "absorb-all")
        pending = cut_lineage(pending.join(new, K, "left_anti"), "absorb-pending")
    return spark_groups.select(*K, "group_id").limit(0) if absorbed is None else keep(absorbed)


def renumber_groups(spark_groups: DataFrame, group_col: str = "group_id") -> DataFrame:
    """Add ``group_name`` = ``pyspark_<n>``, ``n`` consecutive from 0 per
    pipeline in order of the group id (smallest member name)."""
    numbered = dense_number_within(spark_groups, "pipeline", group_col, out="_n")
    return numbered.withColumn(
        "group_name", F.concat(F.lit(SPARK_GROUP_NAME_PREFIX), F.col("_n").cast("string"))
    ).drop("_n")


def singleton_groups(marked_nodes: DataFrame) -> DataFrame:
    """Ungrouped mode, every node its own group, typed by ``is_spark``.

    Output ``(pipeline, node, group_id, group_name, group_type)``.
    """
    return marked_nodes.select(
        *K,
        F.col("node").alias("group_id"),
        F.col("node").alias("group_name"),
        F.when(F.col("is_spark"), F.lit(GROUP_SPARK)).otherwise(F.lit(GROUP_DEFAULT)).alias("group_type"),
    )


def dag_levels(group_edges: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """``(pipeline, group, level, cyclic)``, level = longest path from a
    group with no parent; groups on or below a cycle get ``level`` null and
    ``cyclic`` true.

    Rounds go on until nothing changes, each on what the last one left:

    * groups without a parent get their level, which goes to their children
      as a lower bound, and leave with their edges;
    * a group with a single parent has level ``max(bound, parent + steps)``.
      Such groups follow their parents by pointer jumping to the first
      ancestor that has none or several parents, and leave; their edges start
      at that ancestor, longer by the path.  A chain or tree of any depth is
      one round.  Followers that never reach such an ancestor are on or below
      a cycle, and with them what they lead to.

    What remains lies on or below a cycle.  Followers take their levels at
    the end, last round first.  A column ``bound`` of ``groups`` is the least level
    that a group may have (a group may come several times).
    """
    with stored_rounds(group_edges.sparkSession) as keep:
        return keep(levels_of_stored(stored_once(group_edges, "levels-edges"), groups))


def levels_of_stored(group_edges: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """``dag_levels`` where reading the edges several times costs no more than their scan."""
    with stored_rounds(group_edges.sparkSession) as keep:
        return _peel(group_edges, groups, keep)


def _peel(group_edges: DataFrame, groups: DataFrame | None, keep) -> DataFrame:
    """The rounds of ``dag_levels``; ``groups`` may bring a lower ``bound`` of the level with them.

    A round stores the state of the groups that are left, what leaves, and the rows that
    go on: edges ``(u, v, w)`` and bounds ``b`` of the level of ``v`` (a row may be both).
    Edges need not be distinct.  The group comes before the pipeline in keys, which sorts faster;
    parents are told apart by a hash, since Spark sorts rows to find the least of a text, and
    those that a hash takes for one are looked at themselves."""
    none = F.lit(None).cast("long")
    e = group_edges.select(
        "pipeline", F.col("parent_group").alias("u"), F.col("child_group").alias("v"), F.lit(1).cast("long").alias("w"), none.alias("b")
    )
    zero = F.lit(0).cast("long").alias("bound")
    nodes = e.select("pipeline", F.col("u").alias("group"), zero).distinct()
    nodes = nodes.unionByName(e.filter("pipeline IS NULL OR v IS NULL").select("pipeline", F.col("v").alias("group"), zero))
    if groups is not None:
        nodes = nodes.unionByName(groups.select("pipeline", "group", F.col("bound") if "bound" in groups.columns else zero))
    # At first the ends of edges are groups as well; later, only what stayed counts.
    met = e.filter("pipeline IS NOT NULL AND v IS NOT NULL").withColumn("b", F.lit(0).cast("long"))
    every = True
    done: list[DataFrame] = []
    followers: list[DataFrame] = []
    while True:
        no = F.lit(False)
        rows = nodes.select("pipeline", "group", "bound", F.lit(False).alias("edge"), none.alias("_u"), no.alias("_loop"), F.lit(True).alias("here"))
        rows = rows.unionByName(met.select(
            "pipeline", F.col("v").alias("group"), F.col("b").alias("bound"), F.col("w").isNotNull().alias("edge"),
            F.when(F.col("u").isNotNull(), _parent_hash("u")).alias("_u"), F.coalesce(F.col("u") == F.col("v"), no).alias("_loop"), F.lit(every).alias("here"),
        ))
        # Parents of each group: none, one other, or more.
        state = rows.groupBy("group", "pipeline").agg(
            F.max("bound").alias("bound"), F.min("_u").alias("_first"), F.max("_u").alias("_last"), F.max("_loop").alias("_loop"),
            F.count("_u").alias("_named"), F.count_if("edge").alias("_edges"), F.max("here").alias("_here"),
        )
        one = (F.col("_named") == F.col("_edges")) & (F.col("_first") == F.col("_last")) & ~F.col("_loop")
        kind = F.when(F.col("_edges") == 0, "root").when(one, "one").when(F.col("_named") > 0, "more")
        state, seen = cut_lineage_counting(
            state.filter("_here").select("pipeline", "group", "bound", kind.alias("kind")),
            "levels-state",
            roots=F.count_if(F.col("kind") == "root"),
            single=F.count_if(F.col("kind") == "one"),
            more=F.count_if(F.col("kind") == "more"),
        )
        if seen["single"]:
            hop, state, seen = _pointers(met, state, seen)
        if not seen["roots"] and not seen["single"]:
            done.append(state.select("pipeline", "group", none.alias("level")))
            break
        gone = state.filter("kind = 'root'").select("pipeline", "group", F.col("bound").alias("level"), F.lit(None).cast(met.schema["u"].dataType).alias("to"), none.alias("bound"), none.alias("steps"))
        if seen["single"]:
            gone = gone.unionByName(_followed(hop, state, seen["single"]))
        # Left for good: with a level, on or below a cycle (no level), or behind ``to``, which stays.
        gone, left = cut_lineage_counting(gone, "levels-gone", follow=F.count("to"))
        done.append(gone.filter("to IS NULL").select("pipeline", "group", "level"))
        if left["follow"]:
            followers.append(gone.filter("to IS NOT NULL"))
        if not seen["more"]:
            break
        nodes = state.filter("kind = 'more'").select("pipeline", "group", "bound")
        out = gone.select("pipeline", F.col("group").alias("u"), "level", "to", F.col("bound").alias("_bound"), F.col("steps").alias("_steps"), F.lit(True).alias("_gone"))
        on = e.filter("u IS NOT NULL").join(out, ["u", "pipeline"], "left").select(
            "pipeline", "v",
            # A group that circles leaves a loop behind, so that its children stay.
            F.when(F.col("_gone").isNull(), F.col("u")).when(F.col("to").isNotNull(), F.col("to")).when(F.col("level").isNull(), F.col("v")).alias("u"),
            F.when(F.col("level").isNull(), F.col("w") + F.coalesce("_steps", F.lit(0))).alias("w"),
            (F.coalesce("level", "_bound") + F.col("w")).alias("b"),
        )
        on = on.groupBy("v", "u", "pipeline").agg(F.max("w").alias("w"), F.max("b").alias("b"))
        stay = nodes.select("pipeline", F.col("group").alias("v"))
        e = cut_lineage(on.join(stay, ["v", "pipeline"], "left_semi").select("pipeline", "u", "v", "w", "b"), "levels-edges")
        met, every = e, False
    for follow in reversed(followers):
        known = _all(done).select("pipeline", F.col("group").alias("to"), F.col("level").alias("base"))
        took = follow.join(known, ["to", "pipeline"]).select(
            "pipeline", "group", F.when(F.col("base").isNotNull(), F.greatest("bound", F.col("base") + F.col("steps"))).alias("level")
        )
        done.append(cut_lineage(took, "levels-took"))
    out = _all(done).select("pipeline", "group", F.col("level").cast("int").alias("level"), F.col("level").isNull().alias("cyclic"))
    return keep(cut_lineage(out, "levels"))


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _parent_hash(col: str):
    return F.xxhash64(col)


def _pointers(met: DataFrame, state: DataFrame, seen: dict) -> tuple[DataFrame, DataFrame, dict]:
    """Pointers ``(pipeline, group, to, bound, steps)`` of groups with a single parent, their edge read once more; a group
    whose parents only have the same hash has several."""
    one = state.filter("kind = 'one'").select("pipeline", F.col("group").alias("v"), "bound")
    edges = met.filter("w IS NOT NULL").select("pipeline", "u", "v", "w").join(one, ["v", "pipeline"])
    hop = edges.groupBy(F.col("v").alias("group"), F.col("u").alias("to"), "pipeline").agg(F.max("bound").alias("bound"), F.max("w").alias("steps"))
    hop, found = cut_lineage_counting(hop.select("pipeline", "group", "to", "bound", "steps"), "levels-hops", n=F.count(F.lit(1)))
    if found["n"] == seen["single"]:
        return hop, state, seen
    several = hop.groupBy("group", "pipeline").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("pipeline", "group", F.lit(True).alias("_several"))
    state, seen = cut_lineage_counting(
        state.join(several, ["group", "pipeline"], "left").select("pipeline", "group", "bound", F.when(F.col("_several"), "more").otherwise(F.col("kind")).alias("kind")),
        "levels-state",
        roots=F.count_if(F.col("kind") == "root"),
        single=F.count_if(F.col("kind") == "one"),
        more=F.count_if(F.col("kind") == "more"),
    )
    return hop.join(several, ["group", "pipeline"], "left_anti").select("pipeline", "group", "to", "bound", "steps"), state, seen


def _followed(hop: DataFrame, state: DataFrame, single: int) -> DataFrame:
    """Groups with a single parent, followed up to the first ancestor that has none (so their level is known),
    to one with several parents, or round in circles: ``(pipeline, group, level, to, bound, steps)``."""
    none = F.lit(None).cast("long")
    # A pointer says: level = max(bound, level of to + steps).
    reach = 1
    while reach <= 2 * single:
        nxt = hop.select("pipeline", F.col("group").alias("to"), F.col("to").alias("to2"), F.col("bound").alias("bound2"), F.col("steps").alias("steps2"))
        hop, moved = cut_lineage_counting(
            hop.join(nxt, ["to", "pipeline"], "left").select(
                "pipeline", "group",
                F.coalesce("to2", "to").alias("to"),
                F.greatest("bound", F.col("bound2") + F.col("steps")).alias("bound"),
                (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps"),
                F.col("to2").isNotNull().alias("moved"),
            ),
            "levels-hops",
            n=F.count_if("moved"),
        )
        hop = hop.drop("moved")
        if not moved["n"]:
            break
        reach *= 2
    # Pointers that still end in a follower go round in circles.
    ends = state.select("pipeline", F.col("group").alias("to"), F.col("kind").alias("_kind"), F.col("bound").alias("_level"))
    root, more = F.col("_kind") == "root", F.col("_kind") == "more"
    return hop.join(ends, ["to", "pipeline"], "left").select(
        "pipeline", "group",
        F.when(root, F.greatest("bound", F.col("_level") + F.col("steps"))).alias("level"),
        F.when(more, F.col("to")).alias("to"),
        F.when(more, F.col("bound")).otherwise(none).alias("bound"),
        F.when(more, F.col("steps")).otherwise(none).alias("steps"),
    )
