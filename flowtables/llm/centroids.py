"""Centroid clustering with scalar lookup tables.

Every component of a vector becomes the integer ``floor(scale * x)``.  Vectors
are stored once as blocks, in which a component is a code: its place in the
sorted list of the integers that occur in that dimension of the block.

A round tabulates, for each dimension, each occurring integer and each
centroid, the squared difference of the two.  A vector's distances to all
centroids are then one table row per dimension, gathered by its codes and
summed; nothing is subtracted or multiplied per vector.  A task adds up the
components of its vectors per cluster and gives one row per cluster; these
meet in two levels, so the driver gets one row per cluster.  Centroids travel
to the tasks with the function: ``k`` times ``dim`` integers, whatever the data.

All arithmetic is on integers and exact: tables are 32 bit wide where no
distance can pass that, else 64 bit, else Python's own integers.

Defined cases: vectors with another number of components, a null or a
non-finite component are left out; a null vec_id is an empty text in the
seeding hash, and rows are distinct vectors even if they repeat a vec_id or
all values (of equal hashes the smaller vec_id, then the smaller vector
starts first); with fewer vectors than ``k`` there are fewer centroids; a
distance or a sum of them beyond 64 bits is given as the largest long; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, cut_lineage, read_table, ship_package

DIM, K, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2
#: Vectors in a block, the unit that is held in memory at once.
BLOCK = 4096
LARGEST = (1 << 63) - 1
BLOCK_SCHEMA = "ids array<bigint>, wide boolean, at binary, listed binary, codes binary"


def kept_vectors(table: DataFrame, dim: int = DIM) -> DataFrame:
    """``(vec_id, x)`` of the rows whose embedding has ``dim`` finite components."""
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    return rows.filter((F.size("x") == dim) & finite)


def scaled(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` as int64, or as Python integers where those do not fit."""
    if not x.size or np.abs(x).max() < (1 << 52) / scale:
        return np.floor(x * scale).astype(np.int64)
    # Doubles from 2**52 on are whole numbers.
    whole = [int(v) * scale if abs(v) >= 1 << 52 else math.floor(v * scale) for v in x.ravel().tolist()]
    return np.array(whole, dtype=object).reshape(x.shape)


@dataclass
class Block:
    """Vectors of one block: per dimension the occurring integers and each vector's place among them."""

    ids: pa.Array
    listed: list[np.ndarray]
    codes: np.ndarray  #: (dim, n)

    @property
    def n(self) -> int:
        return self.codes.shape[1]

    def components(self) -> np.ndarray:
        return np.stack([v[c] for v, c in zip(self.listed, self.codes, strict=True)])


def encode(ids: pa.Array, v: np.ndarray) -> pa.RecordBatch:
    """One block row of the integers ``v`` (vectors in rows)."""
    wide = v.dtype == object
    listed, codes = zip(*[np.unique(col, return_inverse=True) for col in v.T], strict=True)
    at = np.concatenate([[0], np.cumsum([len(x) for x in listed])]).astype("<i4")
    flat = np.concatenate(listed)
    raw = ",".join(map(str, flat.tolist())).encode() if wide else flat.astype("<i8").tobytes()
    size = "<u2" if max(len(x) for x in listed) <= 1 << 16 else "<u4"
    held = np.concatenate([c.ravel().astype(size) for c in codes]).tobytes()
    cols = [pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([wide]), *(pa.array([b], pa.binary()) for b in (at.tobytes(), raw, held))]
    return pa.RecordBatch.from_arrays(cols, ["ids", "wide", "at", "listed", "codes"])


def decode(batch: pa.RecordBatch) -> Iterator[Block]:
    for i in range(batch.num_rows):
        ids, wide, at, raw, held = (batch.column(j)[i] for j in range(5))
        at = np.frombuffer(at.as_buffer(), "<i4")
        if wide.as_py():
            flat = np.array([int(x) for x in raw.as_py().split(b",")], dtype=object)
        else:
            flat = np.frombuffer(raw.as_buffer(), "<i8")
        listed = [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        size = "<u2" if np.diff(at).max() <= 1 << 16 else "<u4"
        yield Block(ids.values, listed, np.frombuffer(held.as_buffer(), size).reshape(len(listed), len(ids)))


def vector_blocks(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """The vectors ``(vec_id, x)`` as block rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            x = table.column(1).chunk(0)
            v = scaled(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1), scale)
            return encode(table.column(0).chunk(0), v)

        for b in batches:
            for i in range(0, b.num_rows, BLOCK):
                part = b.slice(i, BLOCK)
                if n and n + part.num_rows > BLOCK:
                    yield flush()
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if n:
            yield flush()

    return arrow_map(vectors, run, BLOCK_SCHEMA)


def _reach(numbers) -> int:
    return max((max(abs(int(x.min())), abs(int(x.max()))) for x in numbers if len(x)), default=0)


def assign(block: Block, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(cluster, distance)`` of each vector; ties go to the smaller number.

    ``centroids`` is ``(k, dim)``, of int64 or Python integers.
    """
    farthest = (_reach(block.listed) + _reach(centroids)) ** 2 * len(block.listed)
    kind = np.int32 if farthest < 1 << 31 else np.int64 if farthest < 1 << 63 else object
    total = np.zeros((block.n, len(centroids)), dtype=kind)
    for listed, codes, c in zip(block.listed, block.codes, centroids.T, strict=True):
        table = (listed.astype(kind)[:, None] - c.astype(kind)[None, :]) ** 2
        total += table[codes]
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(block.n), cluster]


def seeds(vectors: DataFrame, k: int = K, seed: int = SEED, scale: int = SCALE) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``seed:vec_id``, as integers in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = vectors.select(key.alias("h"), "vec_id", "x").orderBy("h", "vec_id", "x").limit(k).collect()  # k rows
    return scaled(np.array([r["x"] for r in first], dtype=np.float64), scale) if first else np.zeros((0, 0), np.int64)


def _texts(rows: np.ndarray) -> list[str]:
    return [",".join(str(int(x)) for x in row) for row in rows]


def cluster_sums(blocks: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """``{cluster: (vectors, sum of each component)}`` of the clusters that have any."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(k, np.int64), np.zeros((k, dim), dtype=object)
        for b in batches:
            for block in decode(b):
                cluster, _ = assign(block, centroids)
                order = np.argsort(cluster, kind="stable")
                found, first = np.unique(cluster[order], return_index=True)
                sums[found] += np.add.reduceat(block.components()[:, order], first, axis=1).T.astype(object)
                count += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[some]), pa.array(_texts(sums[some]), pa.string())], ["cluster", "n", "sums"])

    def together(pdf):
        rows = np.array([[int(x) for x in s.split(",")] for s in pdf["sums"]], dtype=object)
        one = pdf.iloc[:1].copy()
        one["n"] = int(pdf["n"].sum())
        one["sums"] = _texts(rows.sum(axis=0)[None, :])
        return one

    ship_package(blocks.sparkSession)
    rows = arrow_map(blocks, run, "cluster int, n long, sums string").withColumn("salt", F.spark_partition_id() % 64)
    for keys in (["cluster", "salt"], ["cluster"]):  # in two levels, so that no task meets the rows of all others
        rows = rows.groupBy(*keys).applyInPandas(together, "cluster int, n long, sums string, salt int")
    return {r["cluster"]: (r["n"], [int(x) for x in r["sums"].split(",")]) for r in rows.collect()}  # at most k rows


def _packed(rows: list[list[int]]) -> np.ndarray:
    out = np.array(rows, dtype=object)
    return out.astype(np.int64) if all(abs(x) < 1 << 62 for row in rows for x in row) else out


def cluster(table: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, cluster, distance)`` per kept row of ``table(vec_id, embedding)``, and the final centroids."""
    vectors = kept_vectors(table, dim)
    centroids = seeds(vectors, k, seed, scale)
    blocks = cut_lineage(vector_blocks(vectors, scale), "centroid-blocks")
    for _ in range(rounds if len(centroids) else 0):
        sums = cluster_sums(blocks, centroids)
        centroids = _packed([[s // sums[c][0] for s in sums[c][1]] if c in sums else [int(x) for x in row] for c, row in enumerate(centroids)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in decode(b):
                near, distance = assign(block, centroids)
                if distance.dtype == object:
                    distance = np.array([min(int(x), LARGEST) for x in distance], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([block.ids, pa.array(near, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return arrow_map(blocks, run, "vec_id long, cluster int, distance long"), centroids


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    found = cut_lineage(found, "centroid-clusters")
    named = [(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in enumerate(_texts(centroids))]
    named = spark.createDataFrame(named, "c int, centroid_sha256 string")
    # One row per centroid in all of these.
    own = found.groupBy(F.col("cluster").alias("c")).agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))
    per = own.join(F.broadcast(named), "c").withColumn("whole", F.sum("own").over(Window.partitionBy(F.lit(0))))
    as_long = lambda x: F.least(F.col(x), F.lit(LARGEST).cast("decimal(38,0)")).cast("long")
    per = per.select("c", as_long("own").alias("cluster_inertia"), as_long("whole").alias("inertia"), "centroid_sha256")
    return found.join(F.broadcast(per), F.col("cluster") == F.col("c")).drop("c")


def _oracle() -> str:
    steps = [
        f"v AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, embedding AS e FROM embeddings WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM})",
        f"x AS (SELECT r, d, floor({SCALE} * e[d]::DOUBLE)::BIGINT AS n FROM (SELECT r, e, unnest(range(1, {DIM + 1})) AS d FROM v))",
        f"s AS (SELECT r, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id::VARCHAR), vec_id) - 1 AS c FROM v)",
        f"c0 AS (SELECT c, d, n FROM s JOIN x USING (r) WHERE c < {K})",
    ]
    for i in range(ROUNDS + 1):
        steps.append(f"d{i} AS (SELECT r, c, sum((x.n - k.n) * (x.n - k.n))::BIGINT AS far FROM x JOIN c{i} k ON x.d = k.d GROUP BY r, c)")
        steps.append(f"a{i} AS (SELECT r, c, far FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY far, c) AS rn FROM d{i}) WHERE rn = 1)")
        if i < ROUNDS:
            mean = "SELECT c, d, sum(n)::BIGINT AS t, count(*)::BIGINT AS m FROM a{0} JOIN x USING (r) GROUP BY c, d".format(i)
            steps.append(f"m{i} AS (SELECT c, d, ((t - (((t % m) + m) % m)) // m)::BIGINT AS n FROM ({mean}))")
            steps.append(f"c{i + 1} AS (SELECT k.c, k.d, coalesce(m.n, k.n) AS n FROM c{i} k LEFT JOIN m{i} m ON k.c = m.c AND k.d = m.d)")
    steps.append(f"h AS (SELECT c, sha256(string_agg(n::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY c)")
    last = f"a{ROUNDS}"
    return "WITH " + ",\n".join(steps) + f"""
SELECT v.vec_id, c::INTEGER AS cluster, far AS distance, (sum(far) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(far) OVER ())::BIGINT AS inertia, centroid_sha256
FROM {last} JOIN v USING (r) JOIN h USING (c)
"""


ORACLE = _oracle()
