"""Cycles of a group graph: strongly connected groups, told apart from what
lies below them, and levels over the condensation.

Every step is a distributed round of joins and partial aggregates whose result
is stored, as in the other iterative operators; nothing but counts of changed
rows reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, cut_lineage_counting, stored_once, stored_rounds
from .graph import dag_levels, levels_of_stored

KEY = ["pipeline", "group"]


def cycle_groups(group_edges: DataFrame) -> DataFrame:
    """``(pipeline, group, cycle_id)`` of the groups that lie on a cycle; the id is the cycle's smallest group.

    Two groups are on the same cycle if each leads to the other.  Forward-backward
    colouring: groups that no cycle leads to, or that lead to none, are trimmed;
    links that are the only way out of one group and the only way into the next are
    folded by pointer jumping, so a ring of any length is one round; every
    remaining group is coloured with its smallest ancestor, and what leads back to
    that ancestor within its colour is its cycle.  Edges between colours are on no
    cycle, so the next round works within the colours on what is left.  The number of
    steps of a round grows with the shortest paths between groups that branch.

    An edge from a group to itself is a cycle of that group.  Repeated edges count once;
    edges with a null end or pipeline join nothing; an empty table gives no rows.
    """
    with stored_rounds(group_edges.sparkSession) as keep:
        e = _edges(group_edges)
        return keep(cut_lineage(_cycles(e, _lost(e)), "cycles"))


def _edges(group_edges: DataFrame) -> DataFrame:
    e = group_edges.select("pipeline", F.col("parent_group").alias("u"), F.col("child_group").alias("v"))
    return cut_lineage(e.na.drop().distinct(), "cycles-edges")


def _lost(e: DataFrame) -> DataFrame:
    """Groups on or below a cycle."""
    levels = dag_levels(e.select("pipeline", F.col("u").alias("parent_group"), F.col("v").alias("child_group")))
    return levels.filter("cyclic").select(*KEY)


def _cycles(e: DataFrame, lost: DataFrame) -> DataFrame:
    alone = e.filter("u = v").select("pipeline", F.col("u").alias("group"), F.col("u").alias("root"))
    e = e.filter("u <> v").join(lost.withColumnRenamed("group", "u"), ["pipeline", "u"], "left_semi").select("pipeline", "u", "v")
    rounds: list[tuple[DataFrame, DataFrame]] = []  # what each round folded and found
    while True:
        # The first edges have been trimmed from above by ``lost``.
        for parent, child in (("u", "v"), ("v", "u"))[not rounds :]:
            e, left = cut_lineage_counting(e, "cycles-edges", n=F.count(F.lit(1)))
            if left["n"]:
                e = _trim(e, parent, child)
        e, left = cut_lineage_counting(e, "cycles-edges", n=F.count(F.lit(1)))
        if not left["n"]:
            break
        e, fold, found = _fold(e)
        e, left = cut_lineage_counting(e, "cycles-edges", n=F.count(F.lit(1)))
        if not left["n"]:
            rounds.append((fold, found))
            break
        colour = _colour(e)
        inner = cut_lineage(_within(e, colour), "cycles-inner")
        back = _lead_back(inner, colour.filter("`group` = colour"))
        # A root that nothing leads back to is on no cycle.
        real = back.groupBy("pipeline", "colour").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        on_cycle = back.join(real, ["pipeline", "colour"], "left_semi").select(*KEY, F.col("colour").alias("root"))
        rounds.append((fold, found.unionByName(on_cycle)))
        gone = back.select("pipeline", "group")
        e = (
            inner.join(gone.withColumnRenamed("group", "u"), ["pipeline", "u"], "left_anti")
            .join(gone.withColumnRenamed("group", "v"), ["pipeline", "v"], "left_anti")
            .select("pipeline", "u", "v")
        )
    # What a round folded is on the cycles that it or a later round found for the head.
    members = alone.limit(0)
    for fold, found in reversed(rounds):
        members = cut_lineage(members.unionByName(found), "cycles-members")
        heads = members.select("pipeline", F.col("group").alias("head"), "root")
        took = fold.join(heads, ["pipeline", "head"]).select(*KEY, "root")
        members = cut_lineage(members.unionByName(took), "cycles-members")
    # Of a group's cycles the largest holds the others.
    members = cut_lineage(members.unionByName(alone).distinct(), "cycles-members")
    sizes = members.groupBy("pipeline", "root").agg(F.min("group").alias("cycle_id"), F.count(F.lit(1)).alias("size"))
    return members.join(sizes, ["pipeline", "root"]).groupBy(*KEY).agg(F.max_by("cycle_id", "size").alias("cycle_id"))


def _trim(e: DataFrame, parent: str, child: str) -> DataFrame:
    """Edges whose parent a cycle leads to; with the columns changed over, edges whose child leads to a cycle."""
    levels = dag_levels(e.select("pipeline", F.col(parent).alias("parent_group"), F.col(child).alias("child_group")))
    inside = levels.filter("cyclic").select("pipeline", F.col("group").alias(parent))
    return e.join(inside, ["pipeline", parent], "left_semi").select("pipeline", "u", "v")


def _fold(e: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(edges between heads, (group, head) of folded groups, members of rings (group, root))``.

    A link is folded if it is the only edge out of its parent and the only one into its child:
    then both ends are on the same cycle or on none."""
    out = e.groupBy("pipeline", "u").agg(F.count(F.lit(1)).alias("_out")).filter("_out = 1").select("pipeline", "u")
    into = e.groupBy("pipeline", "v").agg(F.count(F.lit(1)).alias("_in")).filter("_in = 1").select("pipeline", "v")
    hop, links = cut_lineage_counting(
        e.join(out, ["pipeline", "u"], "left_semi").join(into, ["pipeline", "v"], "left_semi")
        .select("pipeline", F.col("v").alias("group"), F.col("u").alias("head"), F.least("u", "v").alias("low")),
        "cycles-links",
        n=F.count(F.lit(1)),
    )
    reach = 1
    while reach < 2 * links["n"]:
        back = hop.select("pipeline", F.col("group").alias("head"), F.col("head").alias("_head"), F.col("low").alias("_low"))
        hop, moved = cut_lineage_counting(
            hop.join(back, ["pipeline", "head"], "left").select(
                *KEY, F.coalesce("_head", "head").alias("head"), F.least("low", "_low").alias("low"),
                F.col("_head").isNotNull().alias("moved"),
            ),
            "cycles-links",
            n=F.count_if("moved"),
        )
        hop = hop.drop("moved")
        if not moved["n"]:
            break
        reach *= 2
    # Pointers that still end in a folded group go round a ring, and have seen all of it.
    ends = hop.select("pipeline", F.col("group").alias("head"))
    rings = hop.join(ends, ["pipeline", "head"], "left_semi").select(*KEY, F.col("low").alias("root"))
    fold = cut_lineage(hop.join(ends, ["pipeline", "head"], "left_anti").select(*KEY, "head"), "cycles-fold")
    rings = cut_lineage(rings, "cycles-rings")
    gone = fold.select(*KEY).unionByName(rings.select(*KEY))
    # No edge but the folded one leads into a folded group, so only parents are renamed.
    rest = (
        e.join(gone.withColumnRenamed("group", "v"), ["pipeline", "v"], "left_anti")
        .join(fold.withColumnRenamed("group", "u"), ["pipeline", "u"], "left")
        .select("pipeline", F.coalesce("head", "u").alias("u"), "v")
        .distinct()
    )
    # A folded path that leads back to its head is a ring with ways in or out.
    closed = rest.filter("u = v").select("pipeline", F.col("u").alias("group"), F.col("u").alias("root"))
    return rest.filter("u <> v"), fold, rings.unionByName(closed)


def _colour(e: DataFrame) -> DataFrame:
    """``(pipeline, group, colour)``: the smallest of the group and its ancestors."""
    ends = e.select("pipeline", F.col("u").alias("group")).unionByName(e.select("pipeline", F.col("v").alias("group")))
    colour = cut_lineage(ends.distinct().withColumn("colour", F.col("group")), "cycles-colour")
    fresh = colour
    while True:
        told = (
            e.join(fresh.select("pipeline", F.col("group").alias("u"), "colour"), ["pipeline", "u"])
            .groupBy("pipeline", F.col("v").alias("group"))
            .agg(F.min("colour").alias("_told"))
        )
        better = colour.join(told, KEY, "left").select(*KEY, "colour", F.least("colour", "_told").alias("_new"))
        # An ancestor's smallest ancestor is one's own: a jump at each step.
        known = colour.select("pipeline", F.col("group").alias("_new"), F.col("colour").alias("_far"))
        now, seen = cut_lineage_counting(
            better.join(known, ["pipeline", "_new"], "left").select(
                *KEY, F.least("_new", "_far").alias("_best"), "colour"
            ).select(*KEY, F.col("_best").alias("colour"), (F.col("_best") < F.col("colour")).alias("moved")),
            "cycles-colour",
            n=F.count_if("moved"),
        )
        colour, fresh = now.drop("moved"), now.filter("moved").drop("moved")
        if not seen["n"]:
            return colour


def _within(e: DataFrame, colour: DataFrame) -> DataFrame:
    """Edges between groups of one colour, with it."""
    return (
        e.join(colour.select("pipeline", F.col("group").alias("u"), "colour"), ["pipeline", "u"])
        .join(colour.select("pipeline", F.col("group").alias("v"), F.col("colour").alias("_c")), ["pipeline", "v"])
        .filter("colour = _c")
        .select("pipeline", "u", "v", "colour")
    )


def _lead_back(inner: DataFrame, roots: DataFrame) -> DataFrame:
    """``(pipeline, group, colour)`` of the groups that lead to their colour's root, the root included."""
    reached = cut_lineage(roots.select(*KEY, "colour"), "cycles-back")
    fresh = reached
    while True:
        step = (
            inner.join(fresh.select("pipeline", F.col("group").alias("v")), ["pipeline", "v"], "left_semi")
            .select("pipeline", F.col("u").alias("group"), "colour")
            .distinct()
            .join(reached, KEY, "left_anti")
        )
        fresh, seen = cut_lineage_counting(step, "cycles-back", n=F.count(F.lit(1)))
        if not seen["n"]:
            return reached
        reached = cut_lineage(reached.unionByName(fresh), "cycles-back")


def condensed_levels(group_edges: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """``(pipeline, group, level, cycle_id, below_cycle)`` of every group.

    ``cycle_id`` is null off cycles; ``below_cycle`` says that the group is on no cycle but a cycle
    leads to it.  ``level`` is the longest path over the condensation, in which a cycle is one
    group: its members share a level, and what lies below it has a level, too."""
    with stored_rounds(group_edges.sparkSession) as keep:
        e = stored_once(group_edges, "cycles-edges").select("pipeline", F.col("parent_group").alias("u"), F.col("child_group").alias("v")).na.drop()
        levels = levels_of_stored(
            e.select("pipeline", F.col("u").alias("parent_group"), F.col("v").alias("child_group")),
            None if groups is None else groups.select(*KEY).na.drop(),
        )
        # Above the cycles and beside them, levels over the condensation are those of the graph itself.
        lost = cut_lineage(levels.filter("cyclic").select(*KEY), "cycles-lost")
        into = e.join(lost.withColumnRenamed("group", "v"), ["v", "pipeline"], "left_semi").select("pipeline", "u", "v").distinct()
        into = cut_lineage(into, "cycles-into")
        cycles = cut_lineage(_cycles(into, lost), "cycles")
        whole = cut_lineage(
            lost.join(cycles, KEY, "left").select(*KEY, "cycle_id", F.coalesce("cycle_id", "group").alias("unit")), "cycles-units"
        )
        # Below, they start from the levels of the parents that have one.
        above = levels.filter("NOT cyclic").select("pipeline", F.col("group").alias("u"), "level")
        child = whole.select("pipeline", F.col("group").alias("v"), F.col("unit").alias("group"))
        parent = whole.select("pipeline", F.col("group").alias("u"), F.col("unit").alias("parent_group"))
        bound = into.join(above, ["u", "pipeline"]).join(child, ["v", "pipeline"]).select("pipeline", "group", (F.col("level") + 1).cast("long").alias("bound"))
        units = whole.select("pipeline", F.col("unit").alias("group"), F.lit(0).cast("long").alias("bound")).unionByName(bound)
        condensed = (
            into.join(parent, ["u", "pipeline"]).join(child.withColumnRenamed("group", "child_group"), ["v", "pipeline"])
            .filter("parent_group <> child_group")
            .select("pipeline", "parent_group", "child_group")
        )
        below = dag_levels(cut_lineage(condensed, "cycles-condensed"), units)
        out = whole.join(below.select("pipeline", F.col("group").alias("unit"), "level"), ["unit", "pipeline"]).select(
            *KEY, "level", "cycle_id", F.col("cycle_id").isNull().alias("below_cycle")
        )
        known = levels.filter("NOT cyclic").select(*KEY, "level", F.lit(None).cast(out.schema["cycle_id"].dataType).alias("cycle_id"), F.lit(False).alias("below_cycle"))
        return keep(cut_lineage(known.unionByName(out), "cycles-levels"))
