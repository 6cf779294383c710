"""Language-model scoring: cross-entropy difference.

A target and a background bigram model share one vocabulary (words hashed to
``VOCABULARY`` slots) and one way of smoothing.  A document's score is the mean
over its words of background loss minus target loss, in nats: the larger,
the more the document reads like the target.  A document that is part of the
background is taken out of it before it is scored.

    P(w | v) = (c(v, w) + MU * P(w)) / (c(v) + MU),   P(w) = (c(w) + 1) / (N + VOCABULARY)

Slot counts (fixed size) are summed from all tasks and broadcast.  Bigrams are
not bounded and stay distributed: tasks hand packed blocks of (bigram,
document) by hash bucket to the tasks that count them, and what a
bigram's counts change in a document's losses goes back as packed sums.  A
frequent bigram is one number per document and task, whatever its share.

Defined cases: a null text has no words; a document without words scores 0
with losses null; without target texts the target model is its smoothing
alone; rows that repeat an id are scored each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textvec as V
from .common import arrow_map, read_table, ship_package

SLOT_BITS = 20
VOCABULARY = 1 << SLOT_BITS
MU = 20.0
#: Words of documents in a block of one task, and documents (numbered with 16 bits).
FLUSH_WORDS, FLUSH_DOCS = 2 << 20, 60_000
#: Words whose bigrams one bucket counts, about.
BUCKET_WORDS = 4 << 20
SLICES = 16
_U = np.uint64
_WORD = V.space_separated()


def _slots(w: V.Words) -> np.ndarray:
    """Vocabulary slot of each word; slot 0 stands before the first word only."""
    return np.maximum(w.hash >> _U(64 - SLOT_BITS), _U(1)).astype(np.int64)


def _before(slot: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Slot of the word before each word."""
    out = np.zeros(len(slot), np.int64)
    out[1:] = slot[:-1]
    first = at[:-1]
    out[first[first < len(slot)]] = 0
    return out


def _pack_counts(slot: np.ndarray, n: np.ndarray) -> bytes:
    """Slots in 32 bits, their counts in 64: a frequent word of a large corpus passes 2**32."""
    return slot.astype("<u4").tobytes() + n.astype("<i8").tobytes()


def _unpack_counts(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw) // 12
    return np.frombuffer(raw, "<u4", n).astype(np.int64), np.frombuffer(raw, "<i8", n, 4 * n)


def slot_counts(texts: DataFrame) -> tuple[np.ndarray, int]:
    """How often each slot occurs in ``texts(text)`` (at 0: texts with words), and words in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(VOCABULARY, np.int64)
        for b in batches:
            for _, _, raw, offs in V.chunks(b.column(0)):
                w = V.scan(raw, offs, _WORD)
                total += np.bincount(_slots(w), minlength=VOCABULARY)
                total[0] += int((w.counts() > 0).sum())
        used = np.flatnonzero(total)
        cut = np.searchsorted(used, np.arange(SLICES + 1) * (VOCABULARY // SLICES))
        for i in range(SLICES):
            here = used[cut[i] : cut[i + 1]]
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([_pack_counts(here, total[here])], pa.binary())], ["slice", "v"])

    step = VOCABULARY // SLICES

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        i = int(pdf["slice"].iloc[0])
        acc = np.zeros(step, np.int64)
        for x in pdf["v"]:
            slot, n = _unpack_counts(x)
            acc[slot - i * step] += n
        used = np.flatnonzero(acc)
        return pd.DataFrame({"slice": [i], "v": [_pack_counts(used + i * step, acc[used])]})

    parts = arrow_map(texts.select("text"), run, "slice int, v binary").withColumn("s", F.spark_partition_id() % 32)
    partial = parts.groupBy("slice", "s").applyInPandas(lambda p: add(p), "slice int, v binary")
    out = np.zeros(VOCABULARY, np.int64)
    for r in partial.groupBy("slice").applyInPandas(add, "slice int, v binary").collect():
        slot, n = _unpack_counts(r["v"])
        out[slot] = n
    return out, int(out[1:].sum())


def _buckets_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((V.mix64(key.astype(_U)) >> _U(20)) % _U(buckets)).astype(np.int64)


def _bytes5(key: np.ndarray) -> bytes:
    return key.astype("<u4").tobytes() + (key >> 32).astype(np.uint8).tobytes()


def _from5(raw: bytes, n: int, at: int) -> np.ndarray:
    return np.frombuffer(raw, "<u4", n, at).astype(np.int64) | np.frombuffer(raw, np.uint8, n, at + 4 * n).astype(np.int64) << 32


BLOCK = "bucket int, kind int, block long, payload binary"
_NAMES = ["bucket", "kind", "block", "payload"]
_TARGET, _DOCS, _BASE = 0, 1, 2


def _row(bucket: int, kind: int, block: int, payload: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([kind], pa.int32()), pa.array([block], pa.int64()), pa.array([payload], pa.binary())], _NAMES)


def _target_blocks(texts: DataFrame, buckets: int) -> DataFrame:
    """Bigram counts of the target, summed per task."""

    def flush(keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not keys:
            return
        key, n = np.unique(np.concatenate(keys), return_counts=True)
        b = _buckets_of(key, buckets)
        order = np.argsort(b, kind="stable")
        cut = np.searchsorted(b[order], np.arange(buckets + 1))
        for i in range(buckets):
            o = order[cut[i] : cut[i + 1]]
            if len(o):
                yield _row(i, _TARGET, 0, _bytes5(key[o]) + n[o].astype("<u4").tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = [], 0
        for b in batches:
            for _, _, raw, offs in V.chunks(b.column(0)):
                w = V.scan(raw, offs, _WORD)
                slot = _slots(w)
                keys.append(_before(slot, w.at) << SLOT_BITS | slot)
                n += len(slot)
                if n >= FLUSH_WORDS:
                    yield from flush(keys)
                    keys, n = [], 0
        yield from flush(keys)

    return arrow_map(texts.select("text"), run, BLOCK)


class _Model:
    """Logs and sums that do not depend on bigrams."""

    def __init__(self, counts: np.ndarray, n: int) -> None:
        self.mass = (MU * (counts + 1.0) / (n + VOCABULARY)).astype(np.float64)  # MU * P(w)
        self.context = counts


def _doc_blocks(docs: DataFrame, buckets: int, shipped) -> DataFrame:
    """Per task: bigrams with the documents they occur in, by bucket; and per
    block of documents the losses that they would have if all bigrams were new."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, background = shipped.value
        part = TaskContext.get().partitionId()
        held, ids, base, words, number = [], [], [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, ids, base, words, number
            if not ids:
                return
            block = (part << 24) | number
            sums = np.concatenate(base)
            table = pa.array(ids, pa.int64())
            null = np.array([x is None for x in ids], np.uint8)
            raw = np.array([x or 0 for x in ids], "<i8").tobytes() + null.tobytes() + sums.astype("<f8").tobytes()
            del table
            yield _row(block % buckets, _BASE, block, len(ids).to_bytes(4, "little") + raw)
            key, who = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            b = _buckets_of(key, buckets)
            order = np.lexsort((key, b))
            cut = np.searchsorted(b[order], np.arange(buckets + 1))
            for i in range(buckets):
                o = order[cut[i] : cut[i + 1]]
                if len(o):
                    yield _row(i, _DOCS, block, _bytes5(key[o]) + who[o].astype("<u2").tobytes())
            held, ids, base, words, number = [], [], [], 0, number + 1

        for batch in batches:
            texts, names = batch.column(1), batch.column(0).to_pylist()
            for i, j, raw, offs in V.chunks(texts):
                w = V.scan(raw, offs, _WORD)
                slot = _slots(w)
                prev = _before(slot, w.at)
                doc = w.text_of_word()
                n = w.counts()
                # Background counts without the document itself: of a word and of a context within the document.
                own_w, own_v = _own(doc, slot), _own(doc, prev)
                mass_b = np.maximum(background.mass[slot] - MU * own_w / (background.total + VOCABULARY), 1e-12)
                t = np.log(target.context[prev] + MU) - np.log(target.mass[slot])
                g = np.log(np.maximum(background.context[prev] - own_v, 0) + MU) - np.log(mass_b)
                base.append(np.stack([n, np.bincount(doc, t, len(n)), np.bincount(doc, g, len(n))], axis=1))
                held.append((prev << SLOT_BITS | slot, doc + len(ids)))
                ids += names[i:j]
                words += len(slot)
                if words >= FLUSH_WORDS or len(ids) >= FLUSH_DOCS - 300:
                    yield from flush()
        yield from flush()

    return arrow_map(docs.select("doc_id", "text"), run, BLOCK)


def _own(doc: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """How often each word's slot occurs in its document."""
    key = doc << SLOT_BITS | slot
    _, inverse, n = np.unique(key, return_inverse=True, return_counts=True)
    return n[inverse]


def _count(shipped):
    def bucket(pdf: pd.DataFrame) -> pd.DataFrame:
        """Changes of losses by the bigrams of one bucket: per block of documents, number and two sums each."""
        target, background = shipped.value
        base = pdf[pdf["kind"] == _BASE]
        t_key, t_n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for raw in pdf.loc[pdf["kind"] == _TARGET, "payload"]:
            n = len(raw) // 9
            t_key.append(_from5(raw, n, 0))
            t_n.append(np.frombuffer(raw, "<u4", n, 5 * n).astype(np.int64))
        key, who, block = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        rows = pdf[pdf["kind"] == _DOCS]
        for i, raw in enumerate(rows["payload"]):
            n = len(raw) // 7
            key.append(_from5(raw, n, 0))
            who.append(np.frombuffer(raw, "<u2", n, 5 * n).astype(np.int64) | i << 16)
        del block
        key, who = np.concatenate(key), np.concatenate(who)
        # Occurrences of a bigram in all documents, in its own document, and in the target.
        order = np.lexsort((who, key))
        key, who = key[order], who[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (who[1:] != who[:-1])
        at = np.flatnonzero(new)
        own = np.diff(np.append(at, len(key)))
        key, who = key[at], who[at]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        every = np.repeat(np.add.reduceat(own, first), np.diff(np.append(first, len(key)))) if len(key) else own
        tk, inverse = np.unique(np.concatenate(t_key), return_inverse=True)
        tn = np.bincount(inverse, np.concatenate(t_n), len(tk)) if len(tk) else np.zeros(0)
        if len(tk):
            spot = np.minimum(np.searchsorted(tk, key), len(tk) - 1)
            in_target = np.where(tk[spot] == key, tn[spot], 0.0)
        else:
            in_target = np.zeros(len(key))
        live = (every > own) | (in_target > 0)
        key, who, own, every, in_target = key[live], who[live], own[live], every[live], in_target[live]
        slot = key & (VOCABULARY - 1)
        t = own * np.log1p(in_target / target.mass[slot])
        g = own * np.log1p((every - own) / background.mass[slot])
        docs, inverse = np.unique(who, return_inverse=True)
        t, g = np.bincount(inverse, t, len(docs)), np.bincount(inverse, g, len(docs))
        cut = np.searchsorted(docs, np.arange(len(rows) + 1) << 16)
        names, out = rows["block"].to_numpy(), []
        for i in range(len(rows)):
            c = slice(cut[i], cut[i + 1])
            if cut[i + 1] > cut[i]:
                out.append((names[i], (docs[c] & 0xFFFF).astype("<u2").tobytes() + t[c].astype("<f4").tobytes() + g[c].astype("<f4").tobytes()))
        made = pd.DataFrame({"block": [x[0] for x in out], "kind": [_DOCS] * len(out), "payload": [x[1] for x in out]})
        return pd.concat([made, base[["block", "kind", "payload"]]], ignore_index=True).astype({"block": "int64", "kind": "int32"})

    return bucket


SCORES = "doc_id long, n_words long, target_loss double, background_loss double, score double"


def _finish(pdf: pd.DataFrame) -> pd.DataFrame:
    """Losses per document of one block."""
    raw = pdf.loc[pdf["kind"] == _BASE, "payload"].iloc[0]
    m = int.from_bytes(raw[:4], "little")
    ids, null = np.frombuffer(raw, "<i8", m, 4), np.frombuffer(raw, np.uint8, m, 4 + 8 * m)
    n, t, g = np.frombuffer(raw, "<f8", 3 * m, 4 + 9 * m).reshape(m, 3).T.copy()
    for x in pdf.loc[pdf["kind"] == _DOCS, "payload"]:
        k = len(x) // 10
        who = np.frombuffer(x, "<u2", k)
        t[who] -= np.frombuffer(x, "<f4", k, 2 * k)
        g[who] -= np.frombuffer(x, "<f4", k, 6 * k)
    with np.errstate(invalid="ignore", divide="ignore"):
        t, g = t / n, g / n
    words = n > 0
    return pd.DataFrame({
        "doc_id": pd.array(np.where(null, 0, ids), "Int64").copy() if not null.any() else pd.array([None if z else int(i) for i, z in zip(ids, null, strict=True)], "Int64"),
        "n_words": n.astype(np.int64),
        "target_loss": np.where(words, t, None),
        "background_loss": np.where(words, g, None),
        "score": np.where(words, g - t, 0.0).astype(float),
    })


def cross_entropy_difference(docs: DataFrame, target: DataFrame) -> DataFrame:
    """``(doc_id, n_words, target_loss, background_loss, score)`` per row of
    ``docs(doc_id, text)``; the background is all of ``docs``, the target ``target(text)``."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    models = []
    for texts in (target, docs):
        counts, n = slot_counts(texts)
        m = _Model(counts, n)
        m.total = n
        models.append(m)
    shipped = spark.sparkContext.broadcast(tuple(models))  # two numbers per slot and model
    buckets = max(16, models[1].total // BUCKET_WORDS)
    blocks = _target_blocks(target, buckets).unionByName(_doc_blocks(docs, buckets, shipped))
    changes = blocks.groupBy("bucket").applyInPandas(_count(shipped), "block long, kind int, payload binary")
    return changes.groupBy("block").applyInPandas(_finish, SCORES)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return cross_entropy_difference(docs, read_table(spark, sf_dir, "conversations").select("text"))
