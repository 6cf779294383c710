"""Quality classifier: naive Bayes support vectors.

Features are n-gram indicators: each distinct word, word pair, word shape and
pair of shapes of a text, and how densely each shape fills it, hashed into a
fixed number of slots.  Each indicator is scaled by the log ratio of its
smoothed frequency in good and bad labelled texts, the scaled vector gets unit
length, and a linear hinge-loss model is fitted to it by dual coordinate
descent.  A logistic curve turns margins into scores.

Labels are learned from a bounded sample (``MAX_SAMPLE`` rows, chosen by a
hash of their id; all rows when there are fewer) of the labelled rows that are
not held out; every text is scored whole.

Defined cases: a null text is empty and scores like a text without known
features; without labels of both classes every text scores the share of label
1 (0.5 without labels); an id with several labels counts as its smallest
label; rows that repeat an id are scored each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textvec as V
from .common import arrow_map, held_out, read_table

MAX_SAMPLE = 8000
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
MIN_TEXTS = 3
_WORD = V.space_separated()
_U = np.uint64


def _shapes(w: V.Words, raw: np.ndarray) -> np.ndarray:
    """A small number per word: case of its first two letters, last byte if a
    sign, length class, digits, and whether it repeats the word before."""
    if not len(w.start):
        return np.zeros(0, np.int64)
    first = raw[w.start]
    second = raw[np.minimum(w.start + 1, w.end - 1)]
    last = raw[w.end - 1]
    before = raw[np.maximum(w.end - 2, w.start)]
    upper = lambda b: (b >= 65) & (b <= 90)
    sign = lambda b: (b < 128) & ~(((b | 32) >= 97) & ((b | 32) <= 122)) & ~((b >= 48) & (b <= 57))
    digits = np.concatenate([[0], np.cumsum((raw >= 48) & (raw <= 57))])
    digit = digits[w.end] > digits[w.start]
    same = np.zeros(len(w.start), bool)
    same[1:] = w.hash[1:] == w.hash[:-1]
    length = np.minimum(np.log2(w.end - w.start).astype(np.int64), 5)
    n = upper(first).astype(np.int64)
    for flag in (upper(second), sign(first), digit, same, sign(last) & sign(before)):
        n = n * 2 + flag
    return (n * 6 + length) * 128 + np.where(sign(last), last, 0)


def features(arr: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct feature slots of each text."""
    with np.errstate(over="ignore"):
        for _, _, raw, offs in V.chunks(arr):
            w = V.scan(raw, offs, _WORD)
            shape = _shapes(w, raw)
            pair = V.mix64(w.hash[:-1] * _U(3) + w.hash[1:] * _U(5) + _U(1)) if len(w.hash) else w.hash
            sh = V.mix64(shape.astype(_U) + _U(1 << 40))
            sh2 = V.mix64(shape[:-1].astype(_U) * _U(1 << 20) + shape[1:].astype(_U) + _U(1 << 60)) if len(shape) else sh
            cut = _U(64 - SLOT_BITS)
            slots = [(x >> cut).astype(np.uint32) for x in (w.hash, sh, pair, sh2)]
            for i in range(w.n):
                a, b = int(w.at[i]), int(w.at[i + 1])
                if a == b:
                    yield np.zeros(0, np.uint32)
                    continue
                kinds, n = np.unique(shape[a:b], return_counts=True)
                dense = np.digitize(n / (b - a), (0.02, 0.1, 0.3, 0.6)).astype(_U)
                dense = (V.mix64(kinds.astype(_U) * _U(8) + dense + _U(1 << 50)) >> cut).astype(np.uint32)
                yield np.unique(np.concatenate([slots[0][a:b], slots[1][a:b], slots[2][a : b - 1], slots[3][a : b - 1], dense]))


@dataclass
class Model:
    value: np.ndarray  #: weight times scale of each slot
    square: np.ndarray  #: scale squared
    slope: float
    offset: float

    def margin(self, slots: np.ndarray) -> float:
        norm = float(self.square[slots].sum())
        return float(self.value[slots].sum()) / norm**0.5 if norm > 0 else 0.0

    def score(self, slots: np.ndarray) -> float:
        z = self.slope * self.margin(slots) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, passes: int = 12, alpha: float = 1.0, seed: int = 4) -> Model:
    """Scales, dual coordinate descent and the logistic curve."""
    y = np.where(labels > 0, 1.0, -1.0)
    share = float((labels > 0).mean()) if len(labels) else 0.5
    flat = np.zeros(SLOTS, np.float32)
    if not len(rows) or share in (0.0, 1.0):
        # No second class to tell apart: every text scores the share of label 1.
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(flat, flat, 1.0, float(np.log(share / (1 - share))))
    counts = [np.zeros(SLOTS), np.zeros(SLOTS)]
    for r, label in zip(rows, labels, strict=True):
        counts[int(label > 0)][r] += 1
    known = counts[0] + counts[1] >= min(MIN_TEXTS, max(1, len(rows) // 20))
    p, q = counts[1] + alpha, counts[0] + alpha
    scale = np.where(known, np.log((p / p.sum()) / (q / q.sum())), 0.0)
    idx = [r[known[r]] for r in rows]
    norm = np.array([max(float((scale[i] ** 2).sum()), 1e-12) ** 0.5 for i in idx])
    vals = [scale[i] / n for i, n in zip(idx, norm, strict=True)]
    rng = np.random.default_rng(seed)
    fit_on = rng.random(len(rows)) >= 0.2  # the curve is fitted to margins of texts that the weights did not see
    if len(set(y[fit_on])) < 2 or len(set(y[~fit_on])) < 2:
        fit_on[:] = True
    limit = np.where(y > 0, cost * 0.5 / share, cost * 0.5 / (1 - share))
    w, dual = np.zeros(SLOTS), np.zeros(len(rows))
    train = np.flatnonzero(fit_on)
    for _ in range(passes):
        rng.shuffle(train)
        moved = 0.0
        for i in train:
            grad = y[i] * float(vals[i] @ w[idx[i]]) - 1.0
            new = min(max(dual[i] - grad, 0.0), limit[i])  # rows have unit length
            if new != dual[i]:
                w[idx[i]] += (new - dual[i]) * y[i] * vals[i]
                moved = max(moved, abs(new - dual[i]))
                dual[i] = new
        if moved < 1e-3:
            break
    test = np.flatnonzero(~fit_on) if (~fit_on).any() else train
    m = np.array([float(vals[i] @ w[idx[i]]) for i in test])
    slope, offset = _logistic(m, (y[test] > 0).astype(float))
    return Model((w * scale).astype(np.float32), (scale**2).astype(np.float32), slope, offset)


def _logistic(m: np.ndarray, t: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margins to labels (Newton steps, smoothed targets)."""
    n1, n0 = t.sum(), len(t) - t.sum()
    t = np.where(t > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        g = np.array([((p - t) * m).sum() + 1e-3 * a, (p - t).sum()])
        s = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(s * m * m).sum() + 1e-3, (s * m).sum()], [(s * m).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -5, 5)), b - float(np.clip(step[1], -5, 5))
        if abs(step).max() < 1e-6:
            break
    return max(a, 1e-3), b


def labelled_sample(labels: DataFrame, column: str, limit: int) -> DataFrame:
    """At most ``limit`` rows ``(doc_id, label)`` that are not held out, by a hash of the id."""
    return (
        labels.select("doc_id", F.col(column).cast("int").alias("label"))
        .filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )


def sampled_rows(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """``(doc_id, text, label)``, one row per sampled id: of a repeated id the
    text with the smallest hash.  Reduced where the rows are, before any shuffle."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most the sample's ids: a broadcast of fixed size.
    rows = rows.join(F.broadcast(sample), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "label")).alias("r")
    return rows.groupBy("doc_id").agg(one).select("doc_id", "r.text", "r.label")


def train(docs: DataFrame, labels: DataFrame, column: str = "quality", limit: int = MAX_SAMPLE) -> Model:
    sample = labelled_sample(labels, column, limit)
    rows = sampled_rows(docs, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [f.tobytes() for f in features(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(found, pa.binary())], ["doc_id", "label", "slots"])

    got = arrow_map(rows, run, "doc_id long, label int, slots binary").toPandas()
    got = got.sort_values("doc_id", kind="stable")
    return fit([np.frombuffer(s, np.uint32) for s in got["slots"]], got["label"].to_numpy())


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` per row of ``docs(doc_id, text)``."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: two numbers a slot

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m.score(f) for f in features(b.column(1))], pa.float64())], ["doc_id", "score"])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, "doc_id long, score double")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
