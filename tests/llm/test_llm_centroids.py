import hashlib
import math
import random

import numpy as np
import pyarrow as pa

from flowtables.llm import centroids as C


def _brute(rows, k, rounds, dim):
    """Every vector against every centroid, with Python's own integers."""
    kept = [(i, [int(x) * 256 if abs(x) >= 2**52 else math.floor(x * 256) for x in v], v) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] or 0, r[2]))
    cents = [list(v) for _, v, _ in start[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        mine = {}
        for _, v, _ in kept:
            mine.setdefault(near(v)[1], []).append(v)
        for j, vs in mine.items():
            cents[j] = [sum(col) // len(vs) for col in zip(*vs, strict=True)]
    return sorted(((i, near(v)[1], min(near(v)[0], C.LARGEST)) for i, v, _ in kept), key=str), cents


def _check(spark, rows, k=5, rounds=3, dim=4):
    table = spark.createDataFrame([(i, v, "z", 1) for i, v in rows], "vec_id long, embedding array<double>, cluster string, distance int").repartition(3)
    got, cents = C.cluster(table, k=k, rounds=rounds, dim=dim)
    want, brute = _brute(rows, k, rounds, dim)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert [[int(x) for x in c] for c in cents] == brute
    return want


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(i % 3, 0.3) for _ in range(4)]) for i in range(300)]
    assert len({c for _, c, _ in _check(spark, rows)}) > 1


def test_rows_left_out_ties_repeats_and_null_ids(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None), (2, []), (3, [1.0] * 3), (4, [1.0] * 5), (5, [1.0, None, 1.0, 1.0]), (6, [nan] * 4), (7, [0.0, inf, 0.0, 0.0])]
    same = [(8, [0.5] * 4)] * 4 + [(9, [-0.001] * 4), (None, [0.25] * 4), (None, [0.75] * 4), (10, [-0.0] * 4)]
    _check(spark, bad + same)
    _check(spark, bad + same[:2])  # fewer vectors than centroids
    assert _check(spark, bad) == []
    assert _check(spark, []) == []


def test_numbers_beyond_a_long(spark):
    rows = [(i, [s * 10.0**e, 1.5, -2.5, float(i)]) for i, (s, e) in enumerate([(1, 0), (1, 3), (-1, 9), (1, 14), (1, 18), (-1, 40), (1, 308), (1.7, 308)])]
    _check(spark, rows, k=3)
    _check(spark, [r for r in rows if abs(r[1][0]) <= 1e9], k=3)


def test_blocks_round_trip(monkeypatch):
    rng = np.random.default_rng(2)
    for v in (rng.integers(-300, 300, (50, 6)), np.array([[10**30, 2], [3, -(10**25)]], dtype=object)):
        (block,) = C.decode(C.encode(pa.array(range(len(v))), v))
        assert block.ids.to_pylist() == list(range(len(v)))
        assert (block.components().T == v).all()


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 16)
    rng = random.Random(3)
    _check(spark, [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(150)])
