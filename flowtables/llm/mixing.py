"""Mixing sources to target weights by pivotal dependent rounding.

A source's target divided by its size is the number of copies that each of
its documents should get; the whole part is given to all, and the fraction
``f`` (in 0..1) is rounded so that the source's words come out near its target.

Two documents ``a``, ``b`` with sizes ``wa``, ``wb`` meet; words are moved
between ``wa * fa`` and ``wb * fb`` in a random direction, chosen so that each
keeps its expected share, until one of them becomes 0 or 1.  The other one
carries on with what is left.  No pair changes the sum of words, so only the
very last document of a source, rounded by chance, moves its total.

The carrying-on runs as a reduction tree of small groups: each source is cut
into groups of about ``FAN`` documents, each group leaves one undecided
document, and those meet in groups again, up to one per source.  A group is a
bounded array folded by a SQL higher-order function; a source with a third of
all rows is just more groups.  Everything is DataFrame expressions.

Defined cases: a null or blank text has size 0; a null source is a source of
its own, ordered last; of rows that repeat a source, id and size (also those
without an id) as many as the fraction asks for get one copy more, those
with the smallest text hashes first, and only the last of them is rounded;
documents of size 0 in a source without words are kept once, and others of size 0 are rounded by themselves; an empty table gives an
empty mix; extra columns are carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import number_within
from ..session import cut_lineage_counting
from .common import cut_lineage, read_table

#: Documents or carried documents that meet in one group.
FAN = 64
#: Rows of a mixing plan up to which it is broadcast to the texts.
BROADCAST_ROWS = 1 << 18
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``(source, source_size, n_docs, target)`` of ``(source, source_size, n_docs)``.

    Sources in code point order (null last) take the weights in turn.  The
    level at which sources stop at ``most`` times their size is found by
    re-sharing the excess until nothing changes; a round is one aggregate.
    """
    ranked = number_within(sizes.withColumn("none", F.col("source").isNull()), [], ["none", "source"], out="pos")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("pos") % len(weights) + 1).cast("int"))
    src = cut_lineage(
        ranked.select("source", "source_size", "n_docs", turn.alias("w"), (F.col("source_size") * float(most)).alias("cap")), "mix-sources"
    )
    first = src.agg(F.sum("source_size").alias("all"), F.sum("w").alias("w")).first()
    mass = share * float(first["all"] or 0)
    level = mass / first["w"] if first["w"] else 0.0
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("w")
        got = src.agg(F.sum(F.when(full, F.col("cap"))).alias("cap"), F.sum(F.when(~full, F.col("w"))).alias("w")).first()
        if not got["w"]:
            break
        again = (mass - (got["cap"] or 0.0)) / got["w"]
        if again <= level:
            break
        level = again
    return src.select("source", "source_size", "n_docs", F.least(F.col("cap"), F.lit(level) * F.col("w")).alias("target"))


def _uniform(*cols: Column) -> Column:
    """A number in 0..1 that depends on nothing but the values."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)).cast("double") / float(1 << 52)


_ITEM = "struct<doc_id:bigint,size:bigint,rows:bigint,w:double,f:double>"
_DONE = "struct<doc_id:bigint,size:bigint,rows:bigint,take:int>"


def _item(x: Column, f: Column) -> Column:
    return F.struct(
        x["doc_id"].alias("doc_id"), x["size"].alias("size"), x["rows"].alias("rows"), x["w"].alias("w"), f.alias("f")
    ).cast(_ITEM)


def _done(x: Column, take: Column) -> Column:
    return F.array(F.struct(x["doc_id"].alias("doc_id"), x["size"].alias("size"), x["rows"].alias("rows"), take.alias("take")).cast(_DONE))


def _meet(seed: int):
    def step(state: Column, b: Column) -> Column:
        a = state["carry"]
        up = F.least(a["w"] * (1 - a["f"]), b["w"] * b["f"])  # words that may move from b to a
        down = F.least(a["w"] * a["f"], b["w"] * (1 - b["f"]))
        u = _uniform(F.lit(seed), a["doc_id"], a["size"], b["doc_id"], b["size"])
        goes_up = u * (up + down) < down
        a_ends = F.when(goes_up, a["w"] * (1 - a["f"]) <= b["w"] * b["f"]).otherwise(a["w"] * a["f"] <= b["w"] * (1 - b["f"]))
        moved = F.when(goes_up, up).otherwise(-down)
        one, none = F.lit(1), F.lit(0)
        inside = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
        met = F.struct(
            F.when(a_ends, _item(b, inside(b["f"] - moved / b["w"]))).otherwise(_item(a, inside(a["f"] + moved / a["w"]))).alias("carry"),
            F.concat(
                state["done"],
                F.when(a_ends, _done(a, F.when(goes_up, one).otherwise(none))).otherwise(_done(b, F.when(goes_up, none).otherwise(one))),
            ).alias("done"),
        )
        begun = F.struct(_item(b, b["f"]).alias("carry"), state["done"].alias("done"))
        kind = f"struct<carry:{_ITEM},done:array<{_DONE}>>"
        return F.when(a["w"].isNull(), begun.cast(kind)).otherwise(met.cast(kind))

    return step


def _round(items: DataFrame, seed: int, level: int) -> DataFrame:
    """Let the items ``(source, block, item)`` of each block meet; stored."""
    state = F.struct(F.lit(None).cast(_ITEM).alias("carry"), F.array().cast(f"array<{_DONE}>").alias("done"))
    grouped = items.groupBy("source", "block").agg(
        F.array_sort(F.collect_list(F.struct(F.xxhash64(F.lit(seed + level), "item.doc_id", "item.size").alias("h"), "item"))).alias("xs")
    )
    folded = grouped.select(
        "source", "block", F.aggregate(F.transform("xs", lambda x: x["item"]), state, _meet(seed + level)).alias("s")
    )
    return cut_lineage(folded.select("source", "block", "s.carry", "s.done"), f"mix-round{level}")


def mix_plan(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 20,
) -> DataFrame:
    """``(source, doc_id, size, rows, source_size, target, base, up, copies)`` of
    ``docs(doc_id, text, source)``, one row per distinct source, id and size:
    ``rows`` rows repeat it, all get ``base`` copies and ``up`` of them one more,
    ``copies`` together."""
    items = cut_lineage(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
        .groupBy("source", "doc_id", "size")
        .agg(F.count(F.lit(1)).alias("rows")),
        "mix-items",
    )
    sizes = items.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("n_docs"))
    targets = cut_lineage(source_targets(sizes, weights, share, most), "mix-targets")
    src = targets.select(F.col("source").alias("s"), "source_size", "n_docs", "target")
    shares = items.join(src, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    p = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    shares = shares.withColumn("base", F.floor(p).cast("int")).withColumn("f", p - F.floor(p))
    # Of repeated rows all but one are decided at once; the one has what is left of their fractions.
    shares = shares.withColumn("whole", F.floor(F.col("rows") * F.col("f"))).withColumn("f", F.col("rows") * F.col("f") - F.col("whole"))
    shares = shares.withColumn("tree", (F.col("f") > 0) & (F.col("size") > 0))
    alone = shares.filter(~F.col("tree")).withColumn(
        "up", F.col("whole") + (_uniform(F.lit(seed - 1), F.col("doc_id"), F.col("source")) < F.col("f")).cast("int")
    )
    n_blocks = F.ceil(F.col("n_docs") / FAN)
    item = F.struct("doc_id", "size", "rows", F.col("size").cast("double").alias("w"), "f").cast(_ITEM)
    live = shares.filter("tree").select(
        "source", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), n_blocks).cast("long").alias("block"), item.alias("item")
    )
    blocks = -(-int(targets.agg(F.max("n_docs")).first()[0] or 0) // FAN)
    decided, level = [], 0
    while True:
        out = _round(live, seed, level)
        decided.append(out.select("source", F.explode("done").alias("d")).select("source", "d.*"))
        live = out.select("source", F.floor(F.col("block") / FAN).alias("block"), F.col("carry").alias("item"))
        if blocks <= 1:
            break
        blocks, level = -(-blocks // FAN), level + 1
    last = _uniform(F.lit(seed - 2), F.col("item.doc_id"), F.col("source")) < F.col("item.f")
    decided.append(live.select("source", "item.doc_id", "item.size", "item.rows", last.cast("int").alias("take")))
    rounded = decided[0]
    for d in decided[1:]:
        rounded = rounded.unionByName(d)
    rounded = rounded.join(src, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("base", F.floor(p).cast("int"))
    rounded = rounded.withColumn("up", F.floor(F.col("rows") * (p - F.floor(p))) + F.col("take"))
    cols = ["source", "doc_id", "size", "rows", "source_size", "target", "base", F.col("up").cast("long").alias("up")]
    return rounded.select(*cols).unionByName(alone.select(*cols)).withColumn("copies", F.col("rows") * F.col("base") + F.col("up"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the plan says, with its own columns."""
    cols = [f"k{i}" for i in range(len(docs.columns))]
    by = {c.lower(): k for c, k in zip(docs.columns, cols, strict=True)}
    inner = docs.toDF(*cols)
    own = inner.withColumn("m_size", word_count(F.col(by["text"])))
    plan = mix_plan(inner.select(*[F.col(by[c]).alias(c) for c in ("doc_id", "text", "source")]), **options)
    plan = plan.filter("base > 0 OR up > 0").select("source", "doc_id", "size", "base", "up", (F.col("up") % F.col("rows") != 0).alias("split"))
    plan, seen = cut_lineage_counting(plan, "mix-plan", n=F.count(F.lit(1)), split=F.count_if("split"))
    if seen["n"] <= BROADCAST_ROWS:  # a few dozen bytes each; beyond it both sides are shuffled
        plan = F.broadcast(plan)
    same = (
        F.col(by["doc_id"]).eqNullSafe(F.col("doc_id"))
        & F.col(by["source"]).eqNullSafe(F.col("source"))
        & (F.col("m_size") == F.col("size"))
    )
    met = own.join(plan, same)
    taken = met.filter("NOT split").withColumn("m_n", F.col("base") + (F.col("up") > 0).cast("int"))
    if seen["split"]:  # repeated rows of which some get one copy more than others
        key = [by["doc_id"], by["source"], "m_size"]
        some = met.filter("split").drop("source", "doc_id", "size").withColumn("m_text", F.xxhash64(by["text"]))
        some = number_within(some, key, ["m_text"], out="m_at")
        some = some.withColumn("m_n", F.col("base") + (F.col("m_at") < F.col("up")).cast("int"))
        taken = taken.select(*cols, "m_n").unionByName(some.select(*cols, "m_n"))
    taken = taken.filter("m_n > 0").select(*cols, F.explode(F.sequence(F.lit(1), F.col("m_n"))).alias("m_copy"))
    return taken.select(*cols).toDF(*docs.columns)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    rows = plan.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    copies = (F.col("base") + (F.col("i") <= F.col("up")).cast("int")).alias("copies")
    rows = rows.select("doc_id", "size", "source_size", "target", "source", copies)
    return rows.withColumn("taken", F.col("size") * F.col("copies"))
