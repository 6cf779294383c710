"""MinHash near-duplicates by min-max hashing.

A document is the set of its distinct 4-word shingles; two documents link when
their sets have a Jaccard similarity of at least ``SIMILAR``.  Equal sets are
one entity from the start.

Min-max hashing: under each of ``PERMUTATIONS`` hash permutations the smallest
and the largest value of a set are kept.  Either agrees for two sets with a
probability equal to their similarity, so the signature has twice as many
values as hash evaluations, and as the two tend not to fail together, the
share of agreeing values varies less than that of as many minima.

Bands of ``ROWS`` minima, and bands of as many maxima, give bucket keys.
Similar sets miss each other in all bands with a probability below
``(1 - 0.8 ** ROWS) ** BANDS``, 5e-8.  No bucket is expanded into all its pairs:

* the smallest entity of a bucket is its hub, and only (hub, member) pairs are
  compared; linked entities become components;
* buckets whose members are then in different components go on in rounds.  In
  a round, about ``HUBS`` members of each bucket meet all other members in
  other components, and leave; the next round draws eight times as many.  They
  are drawn by a hash of the entity alone, so buckets with the same members
  mostly draw the same ones and give the same pairs.  A bucket with at most that
  many members is settled by it.  Members of a large bucket are dealt over many
  tasks, its hubs go to each of them.

Candidates are compared by the parities of both sets' shingles in hash cells (a
bit each) first: they give a lower bound of how many shingles are in only one of
the sets, and pairs with more than a ninth of both sizes go.  For those left the
whole sets are compared, exactly.

Defined cases: a null text has no words; a text without words has no shingles
and links with nothing; one with 1 to 3 words has one shingle; a null id never
is a component id, and a component without ids has none (all its rows are
kept); rows that repeat an id are members each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import connected_groups
from ..session import cut_lineage_counting, stored_rounds
from . import textvec as V
from .common import arrow_map, cut_lineage, give_back_memory, read_table, ship_package

SHINGLE = 4
#: Similarity in hundredths.
SIMILAR = 80
PERMUTATIONS, ROWS = 64, 4
BANDS = 2 * PERMUTATIONS // ROWS
#: Smaller sets are similar to equal ones only: four shared of five.
SMALLEST = 4
#: Bits of a sketch at most; a set has four to eight a shingle up to there.
MOST_CELLS = 1 << 15
#: Members of a bucket that meet all others in the first round.
HUBS = 8
#: Shingles that one task compares together, or rows of buckets: at most, and at least.
MOST_LOAD, LEAST_LOAD = 1 << 20, 1 << 12
#: Ids of documents whose sets are needed, up to which they are broadcast (8 bytes each) and beyond which shuffled.
BROADCAST_IDS = 1 << 18
_U = np.uint64
_WORD = V.space_separated()
_SETS = "doc_id long, n_shingles long, entity long, bands array<bigint>, cells binary"


def _multipliers() -> np.ndarray:
    with np.errstate(over="ignore"):
        return V.mix64(np.arange(1, PERMUTATIONS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)


_BY = _multipliers()


def sets_of(arr: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per chunk of texts: sorted distinct shingle hashes and the offsets of each text."""
    for _, _, raw, offs in V.chunks(arr):
        h, at = V.shingle_hashes(V.scan(raw, offs, _WORD), SHINGLE)
        text = np.repeat(np.arange(len(at) - 1), np.diff(at))
        order = np.lexsort((h, text))
        h = h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
        yield h[new], np.concatenate([[0], np.cumsum(np.bincount(text[new], minlength=len(at) - 1))])


def entity_of(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One int64 per set, equal for equal sets."""
    out = np.zeros(len(at) - 1, _U)
    some = np.diff(at) > 0
    with np.errstate(over="ignore"):
        if some.any():
            out[some] = np.add.reduceat(V.mix64(flat + _U(0xA24BAED4963EE407)), at[:-1][some])
        return V.mix64(out ^ np.diff(at).astype(_U) * _U(0x9FB21C651E98DF25)).view(np.int64)


def signatures(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``(sets, 2 * PERMUTATIONS)`` minima, then maxima; no set may be empty."""
    out = np.empty((len(at) - 1, 2 * PERMUTATIONS), np.uint32)
    if not len(out):
        return out
    with np.errstate(over="ignore"):
        spread = flat ^ (flat >> _U(32))
        for i, by in enumerate(_BY):
            h = (spread * by >> _U(32)).astype(np.uint32)
            out[:, i] = np.minimum.reduceat(h, at[:-1])
            out[:, PERMUTATIONS + i] = np.maximum.reduceat(h, at[:-1])
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """``(sets, BANDS)`` bucket keys: the first half from minima, the second from maxima."""
    key = np.zeros((len(sig), BANDS), _U) + np.arange(1, BANDS + 1, dtype=_U) * _U(0xD1B54A32D192ED03)
    rows = sig.reshape(len(sig), BANDS, ROWS).astype(_U)
    with np.errstate(over="ignore"):
        for i in range(ROWS):
            key = V.mix64(key * _U(3) + rows[:, :, i])
    return key.view(np.int64)


def sketch(found: np.ndarray) -> bytes:
    """Parity of the shingles of a set in each hash cell."""
    cells = min(8 << (len(found).bit_length() - 1), MOST_CELLS)
    with np.errstate(over="ignore"):
        cell = V.mix64(found + _U(0x2545F4914F6CDD1D)) & _U(cells - 1)
    return np.packbits((np.bincount(cell.astype(np.int64), minlength=cells) & 1).astype(np.uint8)).tobytes()


class Sketches:
    """Sketches of sets, for many pairs at once."""

    def __init__(self, size: np.ndarray, cells: list[bytes]) -> None:
        self.size, self.width = size, np.array([len(c) for c in cells], np.int64)
        self.place = np.zeros(len(cells), np.int64)
        self.by_width: dict[int, np.ndarray] = {}
        for w in np.unique(self.width).tolist():
            rows = np.flatnonzero(self.width == w)
            self.place[rows] = np.arange(len(rows))
            self.by_width[w] = np.frombuffer(b"".join([cells[i] for i in rows]), np.uint8).reshape(len(rows), w)

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """At least so many shingles are in only one of the sets of each pair."""
        out = np.zeros(len(a), np.int64)
        widths = self.width[a] * (1 << 32) + self.width[b]
        for both in np.unique(widths).tolist():
            u, v = both >> 32, both & 0xFFFFFFFF
            left, right = self.by_width[u], self.by_width[v]
            rows = np.flatnonzero(widths == both)
            step = max(1, (1 << 22) // max(u, v))
            for i in range(0, len(rows), step):
                r = rows[i : i + step]
                x, y = left[self.place[a[r]]], right[self.place[b[r]]]
                while x.shape[1] > y.shape[1]:  # half as many cells: numbers modulo fewer, parities added
                    x = x[:, : x.shape[1] // 2] ^ x[:, x.shape[1] // 2 :]
                while y.shape[1] > x.shape[1]:
                    y = y[:, : y.shape[1] // 2] ^ y[:, y.shape[1] // 2 :]
                out[r] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
        return out

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the pairs may be similar."""
        x, y = self.size[a], self.size[b]
        ok = (100 * x >= SIMILAR * y) & (100 * y >= SIMILAR * x)
        rows = np.flatnonzero(ok)
        # intersection >= s * union, so what is in one set only is at most (1 - s) / (1 + s) of both sizes
        ok[rows] = (100 + SIMILAR) * self.apart(a[rows], b[rows]) <= (100 - SIMILAR) * (x[rows] + y[rows])
        return ok


def set_table(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, entity, bands, cells)`` per row; no entity without
    shingles; bands and cells once per entity and task, and none for small sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            sizes, ents, bands, cells = [], [], [], []
            for flat, at in sets_of(b.column(1)):
                n, ent = np.diff(at), entity_of(flat, at)
                sizes.append(n)
                ents.append(ent)
                new = np.array([e not in seen and not seen.add(e) for e in ent.tolist()], bool) & (n >= SMALLEST)
                sig = signatures(flat[np.repeat(new, n)], np.concatenate([[0], np.cumsum(n[new])]))
                keys = iter(band_keys(sig))
                bands += [next(keys) if x else None for x in new]
                cells += [sketch(flat[at[i] : at[i + 1]]) if x else None for i, x in enumerate(new)]
            n = np.concatenate(sizes)
            cols = [b.column(0), pa.array(n), pa.array(np.concatenate(ents), mask=n == 0), pa.array(bands, pa.list_(pa.int64())), pa.array(cells, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_shingles", "entity", "bands", "cells"])

    return arrow_map(docs, run, _SETS)


def _load(spark: SparkSession, total: int) -> int:
    """Work of one task, so that there are several for each shuffle partition, within the bounds."""
    tasks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(max(total // tasks, LEAST_LOAD), MOST_LOAD)


def likely(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that may be similar by their sketches."""

    def side(x: str) -> DataFrame:
        return entities.select(F.col("entity").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("cells").alias(f"c{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            known = Sketches(np.concatenate([b.column(2).to_numpy(), b.column(3).to_numpy()]), b.column(4).to_pylist() + b.column(5).to_pylist())
            ok = known.near(np.arange(n), np.arange(n) + n)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(ok))

    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    return arrow_map(joined.select("a", "b", "na", "nb", "ca", "cb"), run, "a long, b long")


class _Exact:
    """Compares pairs by their whole sets, which are made once for each entity that needs one."""

    def __init__(self, docs: DataFrame, entities: DataFrame) -> None:
        self.docs, self.entities = docs, entities
        self.sets: DataFrame | None = None
        self.links: DataFrame | None = None

    def _need(self, wanted: DataFrame) -> None:
        if self.sets is not None:
            wanted = wanted.join(self.sets.select("entity"), "entity", "left_anti")
        wanted, seen = cut_lineage_counting(self.entities.join(wanted, "entity", "left_semi").select("entity", "rep"), "minmax-wanted", n=F.count(F.lit(1)))
        if not seen["n"]:
            return
        ids = wanted.filter("rep IS NOT NULL").select(F.col("rep").alias("r_id"))
        if seen["n"] <= BROADCAST_IDS:
            ids = F.broadcast(ids)
        texts = self.docs.join(ids, F.col("doc_id") == F.col("r_id"), "left_semi").select("text")
        texts = texts.unionByName(self.docs.filter("doc_id IS NULL").select("text"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ents, found = [], []
                for flat, at in sets_of(b.column(0)):
                    ents += entity_of(flat, at).tolist()
                    found += [flat[at[i] : at[i + 1]].tobytes() for i in range(len(at) - 1)]
                yield pa.RecordBatch.from_arrays([pa.array(ents, pa.int64()), pa.array(found, pa.binary())], ["entity", "shingles"])

        # Rows that repeat an id, and those without one, may bring other sets or the same again.
        made = arrow_map(texts, run, "entity long, shingles binary").join(wanted.select("entity"), "entity", "left_semi")
        made = cut_lineage(made.groupBy("entity").agg(F.first("shingles").alias("shingles")), "minmax-shingles")
        self.sets = made if self.sets is None else self.sets.unionByName(made)

    def __call__(self, pairs: DataFrame) -> bool:
        """Add the linked ones of the stored pairs ``(a, b)`` to ``links``; whether there are any."""
        spark = pairs.sparkSession
        self._need(pairs.select(F.col("a").alias("entity")).unionByName(pairs.select(F.col("b").alias("entity"))).distinct())
        if self.sets is None:
            return False
        # A set stands for some rows' worth of work besides its shingles.
        sizes = self.entities.select(F.col("entity").alias("b"), (F.col("n_shingles") + 64).alias("n"))
        sized, seen = cut_lineage_counting(pairs.join(sizes, "b"), "minmax-sized", n=F.sum("n"))
        load = _load(spark, seen["n"] or 0)
        groups = max(1, (seen["n"] or 0) // load)
        # The members of a hub are dealt by their load; the hub's set goes to each group of them, once.
        shares = sized.groupBy("a").agg(F.ceil(F.sum("n") / load).alias("shares"))
        group = F.pmod(F.xxhash64("a", F.pmod(F.xxhash64("b"), "shares")), F.lit(groups)).cast("int")
        dealt = cut_lineage(sized.join(shares, "a").select(group.alias("group"), "a", "b"), "minmax-dealt")
        hubs = dealt.select("group", "a").distinct().withColumn("b", F.col("a"))
        rows = dealt.unionByName(hubs).join(self.sets.withColumnRenamed("entity", "b"), "b")

        def step(pdf):
            own = pdf["a"].to_numpy() == pdf["b"].to_numpy()
            sets = [np.frombuffer(x, _U) for x in pdf["shingles"]]
            hub = {int(pdf["a"].iat[i]): sets[i] for i in np.flatnonzero(own)}
            ok = np.zeros(len(pdf), bool)
            for i in np.flatnonzero(~own):
                x, y = hub[int(pdf["a"].iat[i])], sets[i]
                both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
                ok[i] = 100 * both >= SIMILAR * (len(x) + len(y) - both)
            found = pdf.loc[ok, ["a", "b"]]
            give_back_memory()
            return found

        made = rows.select("group", "a", "b", "shingles").groupBy("group").applyInPandas(step, "a long, b long")
        found, seen = cut_lineage_counting(made, "minmax-links", n=F.count(F.lit(1)))
        if seen["n"]:
            self.links = found if self.links is None else self.links.unionByName(found)
        return bool(seen["n"])

    def components(self) -> DataFrame | None:
        """``(entity, component)`` of the linked entities."""
        if self.links is None:
            return None
        edges = self.links.select(F.lit(0).alias("pipeline"), F.col("a").alias("parent"), F.col("b").alias("child"))
        nodes = edges.select("pipeline", F.col("parent").alias("node")).unionByName(edges.select("pipeline", F.col("child").alias("node"))).distinct()
        nodes = cut_lineage(nodes, "minmax-linked")
        return connected_groups(nodes, edges, jumps=1).select(F.col("node").alias("entity"), F.col("group_id").alias("component"))


def _labelled(rows: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Add the component of the entity (itself if it has no link)."""
    if comps is None:
        return rows.withColumn("component", F.col("entity"))
    c = comps.select(F.col("entity").alias("c_e"), F.col("component").alias("c_c"))
    return rows.join(c, F.col("entity") == F.col("c_e"), "left").withColumn("component", F.coalesce("c_c", "entity")).drop("c_e", "c_c")


def _unsettled(members: DataFrame, comps: DataFrame | None) -> tuple[DataFrame, int]:
    """``(key, entity, component, n)`` of buckets that still hold several components, with their size; stored, and the number of rows."""
    labelled = _labelled(members.select("key", "entity"), comps)
    mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n")).filter("lo <> hi")
    rows, seen = cut_lineage_counting(labelled.join(mixed.select("key", "n"), "key"), "minmax-left", n=F.count(F.lit(1)))
    return rows, seen["n"] or 0


def _drawn(hubs: int, turn: int) -> Column:
    """Whether a row ``(key, entity, n)`` is a hub of its bucket in this round."""
    u = F.pmod(F.xxhash64(F.lit(turn), "entity"), F.lit(1 << 30).cast("long"))
    return (F.col("n") <= hubs) | (u * F.col("n") < F.lit(hubs << 30).cast("long"))


def _meet(left: DataFrame, n_rows: int, entities: DataFrame, hubs: int, turn: int) -> DataFrame:
    """Pairs ``(a, b)``, ``a < b``, of a hub and a member of its bucket in another component that may be similar."""
    ship_package(left.sparkSession)
    load = max(1, _load(left.sparkSession, n_rows) // 4)
    groups = max(1, n_rows // load)
    marked = left.withColumn("hub", _drawn(hubs, turn)).withColumn("shares", F.ceil(F.col("n") / load))
    own = F.pmod(F.xxhash64("entity", F.lit(turn)), "shares")
    # A hub goes to every share of its bucket, another member to one.
    spread = marked.withColumn("share", F.explode(F.when(F.col("hub"), F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).otherwise(F.array(own))))
    placed = spread.select(F.pmod(F.xxhash64("key", "share"), F.lit(groups)).cast("int").alias("group"), "key", "share", "entity", "component", "hub")
    sketches = entities.select("entity", "n_shingles", "cells")

    def step(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["key", "share", "hub", "entity"], ascending=[True, True, False, True], kind="stable")
        key, share, ent, comp, hub = (pdf[c].to_numpy() for c in ("key", "share", "entity", "component", "hub"))
        names, one, code = np.unique(ent, return_index=True, return_inverse=True)
        known = Sketches(pdf["n_shingles"].to_numpy()[one], [pdf["cells"].iat[i] for i in one])
        begins = np.ones(len(key), bool)
        begins[1:] = (key[1:] != key[:-1]) | (share[1:] != share[:-1])
        first = np.flatnonzero(begins)
        size_of = np.diff(np.append(first, len(key)))
        start, n_hubs = np.repeat(first, size_of), np.repeat(np.add.reduceat(hub.astype(np.int64), first), size_of)
        place = np.arange(len(key)) - start
        found = [np.zeros(0, np.int64)]
        for i in range(int(n_hubs.max())):
            rows = np.flatnonzero((place > i) & (n_hubs > i))
            at = start[rows] + i
            other = comp[at] != comp[rows]
            x, y = code[at[other]], code[rows[other]]
            pair = np.unique(np.minimum(x, y) * len(names) + np.maximum(x, y))
            found.append(pair[known.near(pair // len(names), pair % len(names))])
        pairs = np.unique(np.concatenate(found))
        give_back_memory()
        return pd.DataFrame({"a": names[pairs // len(names)], "b": names[pairs % len(names)]})

    return placed.join(sketches, "entity").groupBy("group").applyInPandas(step, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with stored_rounds(docs.sparkSession) as keep:
        table = cut_lineage(set_table(docs), "minmax-sets")
        entities = table.filter("entity IS NOT NULL").groupBy("entity").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("bands", True).alias("bands"), F.first("cells", True).alias("cells")
        )
        entities = cut_lineage(entities, "minmax-entities")
        labels = _labelled(entities.select("entity", "rep"), _components(docs, entities))
        ids = labels.groupBy("component").agg(F.min("rep").alias("component_id"))
        named = keep(cut_lineage(labels.join(ids, "component").select(F.col("entity").alias("e"), "component_id"), "minmax-labels"))
        out = keep(table).join(named, F.col("entity") == F.col("e"), "left")
        component = F.when(F.col("entity").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _components(docs: DataFrame, entities: DataFrame) -> DataFrame | None:
    bands = entities.filter("bands IS NOT NULL").select(F.explode("bands").alias("key"), "entity")
    heads = bands.groupBy("key").agg(F.min("entity").alias("hub"), F.max("entity").alias("last")).filter("hub <> last").select("key", "hub")
    members, seen = cut_lineage_counting(bands.join(heads, "key").filter("entity <> hub"), "minmax-members", n=F.count(F.lit(1)))
    if not seen["n"]:
        return None
    exact = _Exact(docs, entities)
    tested = [cut_lineage(likely(members.select(F.col("hub").alias("a"), F.col("entity").alias("b")).distinct(), entities), "minmax-pairs")]
    exact(tested[0])
    comps = exact.components()
    left, n = _unsettled(members, comps)  # the first hubs have met everyone
    hubs, turn = HUBS, 0
    while n:
        pairs = _meet(left, n, entities, hubs, turn)
        for t in tested:
            pairs = pairs.join(t, ["a", "b"], "left_anti")
        tested.append(cut_lineage(pairs, "minmax-pairs"))
        if exact(tested[-1]):
            comps = exact.components()
        left, n = _unsettled(left.filter((F.col("n") > hubs) & ~_drawn(hubs, turn)), comps)
        hubs, turn = hubs * 8, turn + 1
    return comps


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, a AS r FROM both_ways UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a),
c AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, d.doc_id)::BIGINT AS component_id,
       coalesce(c.component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
