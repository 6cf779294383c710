"""N-gram Jaccard join by PartEnum signatures.

A document is the set of its distinct 5-word shingles.  Two sets of sizes x <= y
with Jaccard similarity of at least 3/4 differ in at most (x + y) / 7 shingles.

Sizes are cut into bands [2**b, 2**(b+1)).  A band has ``parts(b)`` partitions of
the shingle domain; more of them hold shingles of a set than can be touched
by the shingles in which a similar set differs, so two similar sets agree
wholly in at least one partition that is not empty.  Each non-empty partition
of a set is a signature (band, partition, its shingles); a set whose size is
near the top of its band gives signatures of the next band as well, so that
similar sets always meet in one band.  Should a set fill too few partitions
for that argument, it also gives a signature for each empty one.

Signatures leave a task as packed blocks by hash bucket.  A bucket finds
*runs*: sets that share a signature.  No run is expanded into all its pairs:

* the smallest set of a run is its hub, and only (hub, member) pairs are
  compared; linked sets become components;
* then members of a run in different components remain, and more hubs are
  chosen among them, eight times as many in each round, until nothing is left;
* runs of more than ``HOT`` sets are mostly shared passages.  A set that keeps
  more signatures outside such runs than can be touched needs none of them
  (its similar sets share one of the others), so it leaves all large runs.
  Sets that need them leave them too, and meet in runs of their rarest
  shingles instead: two similar sets share one of the rarest quarter of each.

Sets that are equal are one entity from the start.  A pair is compared in two
steps: the parities of both sets' shingles in hash cells (a bit each) give a
lower bound of how far they are apart, and pairs beyond (x + y) / 7 go; for
those left the whole sets are compared, exactly.

Defined cases: a null text has no words; a text without words has no shingles
and links with nothing; one with 1 to 4 words has one shingle; a null id
never is a component id, and a component without ids has none; rows that
repeat an id are members each; an empty table gives no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.graph import connected_groups
from ..session import cut_lineage_counting, stored_rounds
from . import textvec as V
from .common import arrow_map, cut_lineage, give_back_memory, read_table, ship_package

SHINGLE = 5
#: Sets in a run from which it counts as large.
HOT = 16
#: Packed bytes of a bucket, about.
BUCKET_BYTES = 8 << 20
#: Signatures a task gathers before it hands its blocks on.
FLUSH = 1 << 20
TAGS = 40
#: Ids of documents whose sets are needed, up to which they are broadcast (8 bytes each) and beyond which shuffled.
BROADCAST_IDS = 1 << 18
#: Rows of runs that one task handles together.
GROUP_ROWS = 20_000
_U = np.uint64
_WORD = V.space_separated()


def most_apart(x: np.ndarray | int):
    """Most shingles in which a set of size x and any similar set differ."""
    return (x + 4 * x // 3) // 7


def parts(band: int) -> int:
    """Partitions of the domain for a band."""
    return max(most_apart((2 << band) - 1) + 1, int(0.9 * (1 << band)), 1)


_PARTS = np.array([parts(b) for b in range(TAGS)], np.int64)


def band_of(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(n, 1))).astype(np.int64)


def sets_of(arr: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per chunk of texts: sorted distinct shingle hashes and the offsets of each text."""
    for _, _, raw, offs in V.chunks(arr):
        w = V.scan(raw, offs, _WORD)
        h, at = V.shingle_hashes(w, SHINGLE)
        found = [np.unique(h[at[i] : at[i + 1]]) for i in range(w.n)]
        size = np.array([len(f) for f in found], np.int64)
        yield (np.concatenate(found) if found else h), np.concatenate([[0], np.cumsum(size)])


def sketch(found: np.ndarray) -> bytes:
    """Parity of the shingles per hash cell, four to eight cells (bits) a shingle."""
    if not len(found):
        return b""
    cells = 8 << (len(found).bit_length() - 1)
    with np.errstate(over="ignore"):
        cell = V.mix64(found + _U(0xC2B2AE3D27D4EB4F)) & _U(cells - 1)
    return np.packbits((np.bincount(cell.astype(np.int64), minlength=cells) & 1).astype(np.uint8)).tobytes()


def _halved(m: np.ndarray) -> np.ndarray:
    """Sketches (in rows) with half of the cells: cell numbers modulo fewer cells, parities added."""
    half = m.shape[-1] // 2
    return m[..., :half] ^ m[..., half:]


def apart(a: bytes, b: bytes) -> int:
    """At least so many shingles are in only one of two sets with these sketches."""
    x, y = (np.frombuffer(z, np.uint8) for z in (a, b))
    while len(x) > len(y):
        x = _halved(x)
    while len(y) > len(x):
        y = _halved(y)
    return int(np.bitwise_count(x ^ y).sum())


def entities(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One int64 per set, equal for equal sets."""
    n = np.diff(at)
    out = np.zeros(len(n), _U)
    some = n > 0
    with np.errstate(over="ignore"):
        if some.any():
            spread = V.mix64(flat + _U(0x9E3779B97F4A7C15))
            out[some] = np.add.reduceat(spread, at[:-1][some])
        return V.mix64(out + n.astype(_U) * _U(0xD6E8FEB86659FD93)).view(np.int64)


def _occupied(flat, at, size, which, tag):
    """Signature sums by (set, partition) of the sets ``which`` for their ``tag``: ``(sums, filled, first cell of each set)``."""
    n = size[which]
    p = _PARTS[tag]
    base = np.concatenate([[0], np.cumsum(p)])
    inner = np.repeat(at[:-1][which] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
    h = flat[inner]
    spread = V.mix64(h ^ np.repeat(V.mix64(tag.astype(_U) + _U(99)), n))
    cell = np.repeat(base[:-1], n) + ((spread >> _U(32)) * np.repeat(p, n).astype(_U) >> _U(32)).astype(np.int64)
    sums = np.zeros(int(base[-1]), _U)
    np.add.at(sums, cell, V.mix64(spread + _U(1)))
    filled = np.zeros(int(base[-1]), bool)
    filled[cell] = True
    return sums, filled, base


def bands(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(set, band)`` rows: each set of two or more shingles in its own band, those near the top in the next one too."""
    big = np.flatnonzero(size >= 3)  # smaller sets are similar to equal ones only
    own = band_of(size[big])
    top = 4 * size[big] // 3 >= (2 << own)
    return np.concatenate([big, big[top]]), np.concatenate([own, own[top] + 1])


def signatures(flat: np.ndarray, at: np.ndarray, buckets: int):
    """``(bucket, band, u32 signature, set)`` and, per (set, band) row, how many signatures may go before the guarantee does."""
    size = np.diff(at)
    which, tag = bands(size)
    if not len(which):
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)), (which, tag, which)
    with np.errstate(over="ignore"):
        sums, filled, base = _occupied(flat, at, size, which, tag)
        p = _PARTS[tag]
        row = np.repeat(np.arange(len(which)), p)
        m = np.add.reduceat(filled, base[:-1], dtype=np.int64)
        slack = m - most_apart(size[which])
        give = filled | (slack <= 0)[row]  # a set with too few filled partitions also gives the empty ones
        cell = np.flatnonzero(give)
        r = row[cell]
        part = (cell - base[r]).astype(_U)
        sig = V.mix64(sums[cell] + V.mix64((part << _U(8)) + tag[r].astype(_U) + _U(5)))
    return (((sig >> _U(40)) % _U(buckets)).astype(np.int64), tag[r], (sig & _U(0xFFFFFFFF)).astype(np.uint32), which[r]), (which, tag, slack)


def shingle_table(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, entity, slack, next_slack, sketch)`` per row; no entity without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, ent, near, far, cells = [], [], [], [], []
            for flat, at in sets_of(b.column(1)):
                size = np.diff(at)
                _, (which, tag, slack) = signatures(flat, at, 1)
                own = tag == band_of(size)[which]
                s = [np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)]
                s[0][which[own]], s[1][which[~own]] = slack[own], slack[~own]
                n.append(size)
                ent.append(np.ma.masked_array(entities(flat, at), size == 0))
                near.append(s[0])
                far.append(s[1])
                cells += [sketch(flat[at[i] : at[i + 1]]) for i in range(len(size))]
            cols = [b.column(0), pa.array(np.concatenate(n)), pa.array(np.ma.concatenate(ent).filled(0), mask=np.concatenate(n) == 0), pa.array(np.concatenate(near)), pa.array(np.concatenate(far)), pa.array(cells, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_shingles", "entity", "slack", "next_slack", "sketch"])

    return arrow_map(docs, run, "doc_id long, n_shingles long, entity long, slack long, next_slack long, sketch binary")


def _pack(ents: np.ndarray, tag: np.ndarray, sig: np.ndarray, who: np.ndarray) -> bytes:
    """One block: sets used, signatures by band, and the set of each signature."""
    order = np.argsort(tag, kind="stable")
    used, idx = np.unique(who, return_inverse=True)
    idx = idx[order].astype("<u2" if len(used) <= 65536 else "<u4")
    counts = np.bincount(tag, minlength=TAGS).astype("<u4")
    return struct.pack("<II", len(used), len(sig)) + counts.tobytes() + ents[used].astype("<i8").tobytes() + sig[order].astype("<u4").tobytes() + idx.tobytes()


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(entity, band, signature)`` of a block."""
    n, m = struct.unpack_from("<II", raw, 0)
    counts = np.frombuffer(raw, "<u4", TAGS, 8)
    p = 8 + 4 * TAGS
    ents = np.frombuffer(raw, "<i8", n, p)
    sig = np.frombuffer(raw, "<u4", m, p + 8 * n)
    idx = np.frombuffer(raw, "<u2" if n <= 65536 else "<u4", m, p + 8 * n + 4 * m)
    return ents[idx], np.repeat(np.arange(TAGS), counts), sig


def signature_blocks(docs: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, block)`` rows of packed signatures; a task gives each set once."""

    def flush(held) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        ents = np.concatenate([h[0] for h in held])
        shift = np.concatenate([[0], np.cumsum([len(h[0]) for h in held])])
        bucket, tag, sig, who = (np.concatenate(x) for x in zip(*[(h[1], h[2], h[3], h[4] + s) for h, s in zip(held, shift, strict=False)], strict=True))
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for i in range(buckets):
            o = order[cut[i] : cut[i + 1]]
            if len(o):
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([_pack(ents, tag[o], sig[o], who[o])], pa.binary())], ["bucket", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, seen = [], 0, set()
        for b in batches:
            for flat, at in sets_of(b.column(0)):
                ents = entities(flat, at)
                size = np.diff(at)
                new = np.array([e not in seen and not seen.add(e) for e in ents.tolist()]) & (size > 0)
                keep = np.repeat(new, size)
                flat, at = flat[keep], np.concatenate([[0], np.cumsum(np.where(new, size, 0))])
                (bucket, tag, sig, who), _ = signatures(flat, at, buckets)
                held.append((ents, bucket, tag, sig, who))
                n += len(sig)
                if n >= FLUSH:
                    yield from flush(held)
                    held, n = [], 0
        yield from flush(held)

    return arrow_map(docs.select("text"), run, "bucket int, block binary")


RUNS = "run long, entity long, hub long, tag int, hot boolean"


def find_runs(blocks: DataFrame) -> DataFrame:
    """``(run, entity, hub, tag, hot)``: members of runs of two or more sets, all
    but the hub; of small runs with the same members only one.  Large runs
    (``hot``) list all members, without a hub."""
    ship_package(blocks.sparkSession)

    def bucket(pdf):
        import pandas as pd

        ent, tag, sig = (np.concatenate(x) for x in zip(*[_unpack(b) for b in pdf["block"]], strict=True))
        which = int(pdf["bucket"].iloc[0])
        known, ent = np.unique(ent, return_inverse=True)
        key = (tag.astype(_U) << _U(32)) | sig.astype(_U)
        order = np.lexsort((ent, key))
        key, ent, tag = key[order], ent[order], tag[order]
        again = np.zeros(len(key), bool)
        again[1:] = (key[1:] == key[:-1]) & (ent[1:] == ent[:-1])
        key, ent, tag = key[~again], ent[~again], tag[~again]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(key)))
        cold, hot = (size > 1) & (size <= HOT), size > HOT
        with np.errstate(over="ignore"):
            if len(first):
                members = np.add.reduceat(V.mix64(known[ent].view(_U)), first)
                live = np.flatnonzero(cold)
                _, one = np.unique(members[live], return_index=True)
                cold[:] = False
                cold[live[one]] = True
            name = V.mix64(key[first] + _U(which) * _U(0x9E3779B97F4A7C15)).view(np.int64) if len(first) else np.zeros(0, np.int64)
        run = np.repeat(np.arange(len(first)), size)
        head = np.zeros(len(key), bool)
        head[first] = True
        rows = np.flatnonzero((cold[run] & ~head) | hot[run])
        r = run[rows]
        give_back_memory()
        return pd.DataFrame({"run": name[r], "entity": known[ent[rows]], "hub": known[ent[first[r]]], "tag": tag[rows].astype(np.int32), "hot": hot[r]})

    return blocks.groupBy("bucket").applyInPandas(bucket, RUNS)


def _entity_sets(docs: DataFrame, reps: DataFrame, n_wanted: int) -> DataFrame:
    """``(entity, shingles)`` of the entities ``reps(entity, rep)``: sorted u64
    hashes, as bytes, from the document with the id ``rep`` or any without an id."""
    ids = reps.filter("rep IS NOT NULL").select(F.col("rep").alias("r_id"))
    if n_wanted <= BROADCAST_IDS:  # one id each, so at most a few MB
        ids = F.broadcast(ids)
    texts = docs.join(ids, F.col("doc_id") == F.col("r_id"), "left_semi").select("text").unionByName(docs.filter("doc_id IS NULL").select("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ents, found = [], []
            for flat, at in sets_of(b.column(0)):
                ents += entities(flat, at).tolist()
                found += [flat[at[i] : at[i + 1]].tobytes() for i in range(len(at) - 1)]
            yield pa.RecordBatch.from_arrays([pa.array(ents, pa.int64()), pa.array(found, pa.binary())], ["entity", "shingles"])

    # Rows that repeat an id, and those without one, may bring others or the same again.
    made = arrow_map(texts, run, "entity long, shingles binary").join(reps.select("entity"), "entity", "left_semi")
    return made.groupBy("entity").agg(F.first("shingles").alias("shingles"))


def prefix_runs(sets: DataFrame) -> DataFrame:
    """``(run, entity)``: runs of sets ``(entity, shingles)`` that share one of
    their rarest shingles.  Of similar sets, each has three quarters of its
    shingles in common with the other, so the rarest ``size - ceil(3/4 size) + 1``
    of both, in one order for all, share one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.frombuffer(x.as_buffer(), np.int64) for x in b.column(1)]
            size = np.array([len(x) for x in sets], np.int64)
            keep = size - -(-3 * size // 4) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(sets)), pa.array(np.repeat(b.column(0).to_numpy(), size)), pa.array(np.repeat(keep, size))], ["run", "entity", "keep"]
            )

    grams = arrow_map(sets.select("entity", "shingles"), run, "run long, entity long, keep long")
    ranked = grams.join(grams.groupBy("run").agg(F.count(F.lit(1)).alias("n")), "run")
    place = F.row_number().over(Window.partitionBy("entity").orderBy("n", "run"))  # a set's own shingles
    return ranked.withColumn("place", place).filter("place <= keep AND n > 1").select("run", "entity")


def likely(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose sketches ``(entity, n_shingles, sketch)`` allow a similarity of 3/4."""
    left = sketches.select(F.col("entity").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("ka"))
    right = sketches.select(F.col("entity").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("kb"))
    near = (4 * F.col("na") >= 3 * F.col("nb")) & (4 * F.col("nb") >= 3 * F.col("na"))
    joined = pairs.join(left, "a").join(right, "b").filter(near)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            most = (x.column(2).to_numpy() + x.column(3).to_numpy()) // 7
            gap = [apart(a, b) for a, b in zip(x.column(4).to_pylist(), x.column(5).to_pylist(), strict=True)]
            ok = np.array(gap, np.int64) <= most
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return arrow_map(joined.select("a", "b", "na", "nb", "ka", "kb"), run, "a long, b long")


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` with 100 * intersection >= 75 * union."""
    left = sets.select(F.col("entity").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("entity").alias("b"), F.col("shingles").alias("sb"))
    joined = pairs.join(left, "a").join(right, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                both = len(x) + len(y) - len(np.union1d(x, y))
                ok.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return arrow_map(joined.select("a", "b", "sa", "sb"), run, "a long, b long")


class _Verifier:
    """Compares pairs; whole sets are made once for each entity that needs them."""

    def __init__(self, docs: DataFrame, table: DataFrame) -> None:
        self.docs, self.table = docs, table
        known = table.filter("entity IS NOT NULL").groupBy("entity")
        self.sketches = cut_lineage(known.agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")), "join-sketches")
        self.sets: DataFrame | None = None
        self.links: DataFrame | None = None

    def need(self, wanted: DataFrame) -> None:
        """Make the sets of ``wanted(entity)`` that are not there yet."""
        if self.sets is not None:
            wanted = wanted.join(self.sets.select("entity"), "entity", "left_anti")
        reps = self.table.join(wanted, "entity", "left_semi").groupBy("entity").agg(F.min("doc_id").alias("rep"))
        reps, seen = cut_lineage_counting(reps, "join-wanted", n=F.count(F.lit(1)))
        if seen["n"]:
            made = cut_lineage(_entity_sets(self.docs, reps, seen["n"]), "join-shingles")
            self.sets = made if self.sets is None else self.sets.unionByName(made)

    def __call__(self, close: DataFrame) -> bool:
        """Add the linked ones of the stored pairs ``close(a, b)`` to ``links``; whether there are any."""
        self.need(close.select(F.col("a").alias("entity")).unionByName(close.select(F.col("b").alias("entity"))).distinct())
        if self.sets is None:
            return False
        found, seen = cut_lineage_counting(similar(close, self.sets), "join-links", n=F.count(F.lit(1)))
        if seen["n"]:
            self.links = found if self.links is None else self.links.unionByName(found)
        return bool(seen["n"])


def _components(links: DataFrame) -> DataFrame:
    """``(entity, component)`` of the linked entities."""
    edges = links.select(F.lit(0).alias("pipeline"), F.col("a").alias("parent"), F.col("b").alias("child"))
    nodes = edges.select("pipeline", F.col("parent").alias("node")).unionByName(edges.select("pipeline", F.col("child").alias("node"))).distinct()
    nodes = cut_lineage(nodes, "join-linked")
    return connected_groups(nodes, edges, jumps=1).select(F.col("node").alias("entity"), F.col("group_id").alias("component"))


def _labelled(rows: DataFrame, comps: DataFrame | None, col: str, out: str) -> DataFrame:
    """Add the component of entity ``col`` (itself if it has no link)."""
    if comps is None:
        return rows.withColumn(out, F.col(col))
    c = comps.select(F.col("entity").alias("c_e"), F.col("component").alias("c_c"))
    return rows.join(c, F.col(col) == F.col("c_e"), "left").withColumn(out, F.coalesce("c_c", col)).drop("c_e", "c_c")


def _unsettled(members: DataFrame, comps: DataFrame | None) -> tuple[DataFrame, int]:
    """``(run, entity, component)`` of runs that still hold more than one component, stored, and their number."""
    labelled = _labelled(members, comps, "entity", "component")
    mixed = labelled.groupBy("run").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("run")
    rows, seen = cut_lineage_counting(labelled.join(mixed, "run", "left_semi"), "join-left", n=F.count(F.lit(1)))
    return rows, seen["n"] or 0


class _Sketches:
    """Sketches of the entities of one task, for many pairs at once."""

    def __init__(self, size: np.ndarray, cells: list[bytes]) -> None:
        self.size, self.width = size, np.array([len(c) for c in cells], np.int64)
        self.place = np.zeros(len(cells), np.int64)
        self.own, self.folded = {}, {}
        for w in np.unique(self.width).tolist():
            rows = np.flatnonzero(self.width == w)
            self.place[rows] = np.arange(len(rows))
            m = np.frombuffer(b"".join([cells[i] for i in rows]), np.uint8).reshape(len(rows), w)
            self.own[w], self.folded[w] = m, _halved(m)

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the pairs may have a similarity of 3/4."""
        x, y = self.size[a], self.size[b]
        ok = (4 * x >= 3 * y) & (4 * y >= 3 * x)
        wa, wb = self.width[a], self.width[b]
        for u in self.own:
            for v in self.own:
                rows = np.flatnonzero(ok & (wa == u) & (wb == v))
                if v > 2 * u or u > 2 * v:
                    continue  # sizes within a ratio of 4/3 have as many cells or twice as many
                left, right = (self.folded if u > v else self.own)[u], (self.folded if v > u else self.own)[v]
                for i in range(0, len(rows), 1 << 15):
                    r = rows[i : i + (1 << 15)]
                    gap = np.bitwise_count(left[self.place[a[r]]] ^ right[self.place[b[r]]]).sum(axis=1, dtype=np.int64)
                    ok[r] = gap <= (x[r] + y[r]) // 7
        return ok


def _next_pairs(left: DataFrame, n_rows: int, sketches: DataFrame, hubs: int) -> tuple[DataFrame, DataFrame, int]:
    """One round over the ``n_rows`` rows of runs ``left(run, entity, component)``: of the pairs
    ``(a, b)`` of each run's ``hubs`` smallest members and the members after
    them, where their components differ, those that may be similar by their
    sketches; and the runs ``(run, entity)`` without those hubs, with their number of rows.

    Runs with the same smallest member mostly have the same other members, so
    they are handled together (with other such runs, up to about
    ``GROUP_ROWS`` rows) and a pair leaves once and not once a run; a member
    that heads more rows than that is split over groups by run.
    """
    heads = left.groupBy("run").agg(F.min("entity").alias("head"), F.count(F.lit(1)).alias("n"))
    shares = heads.groupBy("head").agg(F.ceil(F.sum("n") / GROUP_ROWS).alias("shares"))
    groups = max(16, n_rows // GROUP_ROWS)
    group = F.pmod(F.xxhash64("head", F.pmod("run", "shares")), F.lit(groups)).cast("int")
    placed = heads.join(shares, "head").select("run", group.alias("group"))

    def step(members, own):
        import pandas as pd

        members = members.sort_values(["run", "entity"], kind="stable")
        run, ent, comp = (members[c].to_numpy() for c in ("run", "entity", "component"))
        first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        size = np.diff(np.append(first, len(run)))
        start = np.repeat(first, size)
        rank = np.arange(len(run)) - start
        own = own.sort_values("own")
        names = own["own"].to_numpy()
        code = np.searchsorted(names, ent)
        known = _Sketches(own["n_shingles"].to_numpy(), own["sketch"].tolist())
        found = [np.zeros(0, np.int64)]
        for i in range(min(hubs, int(size.max()) - 1)):
            rows = np.flatnonzero(rank > i)
            hub = start[rows] + i
            differ = comp[hub] != comp[rows]
            pair = np.unique(code[hub[differ]] * len(names) + code[rows[differ]])
            found.append(pair[known.near(pair // len(names), pair % len(names))])
        found = np.unique(np.concatenate(found))
        after = np.flatnonzero((rank >= hubs) & (np.repeat(size, size) > hubs + 1))
        pairs = pd.DataFrame({"pair": True, "run": 0, "a": names[found // len(names)], "b": names[found % len(names)]})
        rest = pd.DataFrame({"pair": False, "run": run[after], "a": ent[after], "b": ent[after]})
        return pd.concat([pairs, rest], ignore_index=True).astype({"pair": bool, "run": "int64", "a": "int64", "b": "int64"})

    # A sketch goes to a group once, however many of its runs the entity is in.
    members = left.join(placed, "run").select("group", "run", "entity", "component")
    own = members.select(F.col("group").alias("of"), F.col("entity").alias("own")).distinct()
    own = own.join(sketches, F.col("own") == F.col("entity")).select("of", "own", "n_shingles", "sketch")
    made = members.groupBy("group").cogroup(own.groupBy("of")).applyInPandas(step, "pair boolean, run long, a long, b long")
    made, seen = cut_lineage_counting(made, "join-round", rest=F.count_if(~F.col("pair")))
    return made.filter("pair").select("a", "b").distinct(), made.filter("NOT pair").select("run", F.col("a").alias("entity")), seen["rest"]


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with stored_rounds(docs.sparkSession) as keep:
        table, labels = _join(docs)
        return _result(keep(table), labels, keep)


def _join(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The table of sets, and ``(entity, rep, component)``."""
    table = cut_lineage(shingle_table(docs), "join-sets")
    total = table.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(32, int(total * 6 // BUCKET_BYTES))
    runs, seen = cut_lineage_counting(find_runs(signature_blocks(docs, buckets)), "join-runs", n=F.count(F.lit(1)), hot=F.count_if("hot"))
    labels = table.filter("entity IS NOT NULL").groupBy("entity").agg(F.min("doc_id").alias("rep"))
    if not seen["n"]:
        return table, labels.withColumn("component", F.col("entity"))
    verify, comps = _Verifier(docs, table), None
    cold = runs.filter("NOT hot")
    pairs = likely(cold.select(F.col("hub").alias("a"), F.col("entity").alias("b")).distinct(), verify.sketches)
    members = cold.select("run", "entity")  # all but the hubs, which meet everyone
    if seen["hot"]:
        needed, n = cut_lineage_counting(_needed(runs.filter("hot"), table), "join-needed", n=F.count(F.lit(1)))
        if n["n"]:
            verify.need(needed)
            rare = prefix_runs(verify.sets.join(needed, "entity", "left_semi"))
            rare, n = cut_lineage_counting(rare.withColumn("component", F.col("entity")), "join-rare", n=F.count(F.lit(1)))
            more, rest, _ = _next_pairs(rare, n["n"], verify.sketches, 2)
            pairs, members = pairs.unionByName(more).distinct(), members.unionByName(rest)
    tested = [cut_lineage(pairs, "join-pairs")]
    if verify(tested[0]):
        comps = _components(verify.links)
    hubs = HOT  # all that a small run holds
    left, n = _unsettled(members, comps)
    while n:
        pairs, rest, n_rest = _next_pairs(left, n, verify.sketches, hubs)
        for t in tested:
            pairs = pairs.join(t, ["a", "b"], "left_anti")
        tested.append(cut_lineage(pairs, "join-pairs"))
        if verify(tested[-1]):
            comps = _components(verify.links)
        left, n = _unsettled(rest, comps) if n_rest else (rest, 0)
        hubs *= 8
    return table, _labelled(labels, comps, "entity", "component")


def _needed(hot: DataFrame, table: DataFrame) -> DataFrame:
    """``(entity)`` of the sets that cannot do without large runs."""
    met = hot.groupBy("entity", "tag").agg(F.count(F.lit(1)).alias("met"))
    one = table.filter("entity IS NOT NULL").groupBy("entity").agg(F.first("n_shingles").alias("size"), F.first("slack").alias("slack"), F.first("next_slack").alias("next_slack"))
    own = F.floor(F.log2("size")) == F.col("tag")
    spare = F.when(own, F.col("slack")).otherwise(F.col("next_slack"))
    return met.join(one, "entity").filter(F.col("met") >= spare).select("entity").distinct()


def _result(table: DataFrame, labels: DataFrame, keep) -> DataFrame:
    """``labels(entity, rep, component)`` to documents; a component's id is its smallest document id."""
    ids = labels.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = keep(cut_lineage(labels.join(ids, "component").select(F.col("entity").alias("e"), "component_id"), "join-labels"))
    out = table.join(named, F.col("entity") == F.col("e"), "left")
    return out.select(
        "doc_id", "n_shingles", F.when(F.col("entity").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of near-duplicates (the one whose id names
    the group) and all without shingles or without an id; rows that repeat an
    id stay or go together."""
    cols = [f"k{i}" for i in range(len(docs.columns))]
    by = {c.lower(): k for c, k in zip(docs.columns, cols, strict=True)}
    inner = docs.toDF(*cols)
    groups = jaccard_components(inner.select(F.col(by["doc_id"]).cast("long").alias("doc_id"), F.col(by["text"]).alias("text")))
    stays = F.bool_or((F.col("n_shingles") == 0) | (F.col("doc_id") == F.col("component_id")))
    # What goes is the smaller side; its ids are all that meets the texts.
    gone = groups.groupBy("doc_id").agg(stays.alias("stays")).filter("NOT stays").select(F.col("doc_id").alias("g_id"))
    gone = cut_lineage(gone, "join-gone")
    return inner.join(gone, F.col(by["doc_id"]).cast("long") == F.col("g_id"), "left_anti").toDF(*docs.columns)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, a AS r FROM both_ways UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a),
c AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, d.doc_id)::BIGINT AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
