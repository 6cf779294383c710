"""Document fingerprints: digests of improbable features.

Every 64-byte window of a text has an entropy.  How often each of 1000 entropy
classes occurs is counted over all windows of all documents, and a window's
rank is the rarity of its class.  Of each run of 64 neighbouring windows the
rarest (leftmost of equals) wins; windows that win at least 16 of them are
the text's features.  Features are hashed into chained Bloom filters of 2048 bits
with 5 bits a feature and at most 160 features a filter.  Two digests are
compared filter by filter: common bits beyond what chance gives, divided by the
most that there could be.

Entropies of all windows come from one cumulative sum: moving a window by a
byte changes two byte counts, and those counts come from 63 comparisons of the
text with itself, moved by 1 to 63 bytes.

A short text has too few windows for that; below 1,024 bytes it is read the
same way in windows of 16 bytes, with ranks counted over short texts, and
below 256 bytes in those only.

Defined cases: a null text is empty; an empty text has the digest ``0:``;
a text of less than one window has itself as its only feature, and one with
fewer windows than a run has its rarest one; equal digests are alike by 1, and an empty
one is unlike all others; in the order of documents null ids come last and
rows that repeat an id follow the order of their texts; an empty table gives
no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textvec as V
from .common import arrow_map, read_table, sum_vectors, vector_rows

WINDOW = 64
CLASSES = 1000
#: Texts below ``SHORT`` bytes are read in windows of ``SHORT_WINDOW`` bytes, those from ``LONG`` on in windows of ``WINDOW``.
SHORT, LONG, SHORT_WINDOW = 1024, 256, 16
FILTER_BITS = 2048
BITS_EACH = 5
FILTER_FEATURES = 160
#: Bytes looked at together: small enough for a processor's cache.
CHUNK = 1 << 18
_U = np.uint64
_SCALE = 1 << 20
_C = np.arange(WINDOW + 2, dtype=np.float64)
#: c * log2(c) as whole numbers, so that sums are exact.
_F = np.rint(np.where(_C > 0, _C * np.log2(np.maximum(_C, 1)), 0) * _SCALE).astype(np.int64)
_GAIN = np.diff(_F)  # of one more byte to c


def entropy_classes(x: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Entropy class (0 to CLASSES - 1) of every window of ``x``."""
    n = len(x)
    if n < window:
        return np.zeros(0, np.int16)
    full = int(_F[window])
    ahead, behind = np.ones(n, np.uint8), np.zeros(n, np.uint8)
    same = np.empty(n, bool)
    for d in range(1, window):
        s = same[: n - d]
        np.equal(x[:-d], x[d:], out=s)
        s = s.view(np.uint8)
        ahead[:-d] += s
        behind[d:] += s
    total = np.empty(n - window + 1, np.int64)
    total[0] = _F[np.bincount(x[:window], minlength=256)].sum()
    total[1:] = _GAIN[behind[window:]]
    total[1:] -= _GAIN[ahead[: n - window] - 1]
    np.cumsum(total, out=total)
    # Entropy is log2(window) - total / window; its share of the largest possible is 1 - total / total of one repeated byte.
    return np.minimum((full - total) * CLASSES // full, CLASSES - 1).astype(np.int16)


def _valid(offs: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which windows of a chunk lie inside one text."""
    ok = np.zeros(max(0, n - window + 1) + 1, np.int32)
    size = np.diff(offs)
    whole = size >= window
    np.add.at(ok, offs[:-1][whole], 1)
    np.add.at(ok, offs[1:][whole] - window + 1, -1)
    return np.cumsum(ok[:-1]) > 0


def _by_size(arr: pa.Array) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
    """``(window, numbers, texts)`` of the long and of the short texts."""
    if arr.null_count:
        arr = arr.fill_null("")
    size = np.diff(V.text_buffer(arr)[1])
    for window, these in ((WINDOW, np.flatnonzero(size >= LONG)), (SHORT_WINDOW, np.flatnonzero(size < SHORT))):
        if len(these):
            yield window, these, arr.take(pa.array(these))


def corpus_ranks(docs: DataFrame) -> dict[int, np.ndarray]:
    """Rarity rank of each entropy class (0 is the rarest) over all windows of
    ``docs(text)``, by window size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {WINDOW: np.zeros(CLASSES, np.int64), SHORT_WINDOW: np.zeros(CLASSES, np.int64)}
        for b in batches:
            for window, _, texts in _by_size(b.column(0)):
                for _, _, raw, offs in V.chunks(texts, CHUNK):
                    if len(raw) >= window:
                        seen[window] += np.bincount(entropy_classes(raw, window)[_valid(offs, len(raw), window)], minlength=CLASSES)
        yield vector_rows(np.concatenate([seen[WINDOW], seen[SHORT_WINDOW]]), 1)

    both = sum_vectors(arrow_map(docs.select("text"), run, "slice int, v binary"), 2 * CLASSES, 1)
    out = {}
    for window, counts in ((WINDOW, both[:CLASSES]), (SHORT_WINDOW, both[CLASSES:])):
        out[window] = np.empty(CLASSES, np.uint32)
        out[window][np.argsort(counts, kind="stable")] = np.arange(CLASSES, dtype=np.uint32)
    return out


def _winners(ranks: np.ndarray, raw: np.ndarray, offs: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """``(position, wins)`` of windows that win a run; positions in the chunk."""
    n = len(raw)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ok = _valid(offs, n, window)
    m = len(ok)
    never = _U((1 << 63) - 1)
    key = (ranks[entropy_classes(raw, window)].astype(_U) << _U(40)) | np.arange(m, dtype=_U)
    key[~ok] = never
    low, width = key, 1
    while width < window:  # smallest of 2, 4, ... 64 neighbours
        if len(low) <= width:
            break
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    size = np.diff(offs)
    wins = np.zeros(m, np.int64)
    if width == window:
        starts = np.zeros(len(low) + 1, np.int32)  # runs that lie inside one text
        whole = size >= 2 * window - 1
        np.add.at(starts, offs[:-1][whole], 1)
        np.add.at(starts, offs[1:][whole] - 2 * window + 2, -1)
        good = low[np.cumsum(starts[:-1]) > 0] & _U((1 << 40) - 1)
        wins = np.bincount(good.astype(np.int64), minlength=m)
    for i in np.flatnonzero((size >= window) & (size < 2 * window - 1)):  # less than 64 windows: one run
        a, b = offs[i], offs[i + 1] - window + 1
        wins[int(key[a:b].min() & _U((1 << 40) - 1))] = window
    at = np.flatnonzero(wins)
    return at, wins[at]


def _digest(hashes: np.ndarray) -> str:
    _, first = np.unique(hashes, return_index=True)
    h = hashes[np.sort(first)]
    if not len(h):
        return "0:"
    which = np.arange(len(h)) // FILTER_FEATURES
    bits = np.zeros((int(which[-1]) + 1) * FILTER_BITS, np.uint8)
    for k in range(BITS_EACH):
        bits[which * FILTER_BITS + ((h >> _U(11 * k)) & _U(FILTER_BITS - 1)).astype(np.int64)] = 1
    return f"{len(h)}:{base64.b64encode(np.packbits(bits).tobytes()).decode()}"


def digests(arr: pa.Array, ranks: dict[int, np.ndarray]) -> list[str]:
    """Digest of each text."""
    out: list[list[np.ndarray]] = [[] for _ in range(len(arr))]
    for window, these, texts in _by_size(arr):
        for i, h in zip(these.tolist(), _features(texts, ranks[window], window), strict=True):
            out[i].append(h)
    return [_digest(h[0] if len(h) == 1 else np.concatenate(h)) for h in out]


def _features(arr: pa.Array, ranks: np.ndarray, window: int) -> Iterator[np.ndarray]:
    """Feature hashes of each text, in order."""
    for _, _, raw, offs in V.chunks(arr, CHUNK):
        at, wins = _winners(ranks, raw, offs, window)
        strong = at[wins >= window // 4]
        size = np.diff(offs)
        up, down = V.POWERS.upto(len(raw) + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(len(raw) + 1, _U)
            np.cumsum(V.BYTE_VALUE[raw] * up[: len(raw)], out=total[1:])
            h = V.mix64((total[strong + window] - total[strong]) * down[strong])
            whole = V.mix64((total[offs[1:]] - total[offs[:-1]]) * down[offs[:-1]] + size.astype(_U))
            cut = np.searchsorted(strong, offs)
            for i in range(len(size)):
                found = h[cut[i] : cut[i + 1]]
                if 0 < size[i] < window:
                    found = whole[i : i + 1]
                elif not len(found) and size[i]:  # no window wins often: the one that wins most
                    a, b = np.searchsorted(at, (offs[i], offs[i + 1]))
                    p = int(at[a + int(np.argmax(wins[a:b]))])
                    found = V.mix64((total[p + window : p + window + 1] - total[p : p + 1]) * down[p : p + 1])
                yield found


def _filters(digest: str) -> tuple[int, np.ndarray]:
    n, _, packed = digest.partition(":")
    bits = np.unpackbits(np.frombuffer(base64.b64decode(packed), np.uint8)).reshape(-1, FILTER_BITS)
    return int(n), bits.astype(np.float32)


def likeness(a: str, b: str) -> float:
    """0 to 1: how much of the smaller digest is in the other one, beyond chance."""
    if a == b:
        return 1.0
    (na, fa), (nb, fb) = _filters(a), _filters(b)
    if not na or not nb:
        return 0.0
    if len(fa) > len(fb) or (len(fa) == len(fb) and na > nb):
        fa, fb = fb, fa
    common = fa @ fb.T
    sa, sb = fa.sum(axis=1)[:, None], fb.sum(axis=1)[None, :]
    most, chance = np.minimum(sa, sb), sa * sb / FILTER_BITS
    border = chance + 0.1 * (most - chance)
    score = np.clip((common - border) / np.maximum(most - border, 1e-6), 0, 1)
    # A filter with few features would match a fuller one too easily; weigh filters by their bits.
    return float((score.max(axis=1) * sa[:, 0]).sum() / sa.sum())


def fingerprints(docs: DataFrame, ranks: dict[int, np.ndarray]) -> DataFrame:
    """``(doc_id, fingerprint)`` per row of ``docs(doc_id, text)``."""
    shipped = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digests(b.column(1), shipped.value), pa.string())], ["doc_id", "fingerprint"])

    inner = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(inner, run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame, parts: int | None = None) -> tuple[DataFrame, bool]:
    """Rows ``(part, tail, doc_id, text)`` sorted in each partition, such that
    the next document of every one follows it in its part: the first document
    of each part is also the ``tail`` of the part before, and the first of all
    that of the last.  False if there is one part only (without a tail).

    Part borders are ids of the table, from approximate percentiles.
    """
    spark = docs.sparkSession
    n = max(2, parts or int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    got = docs.agg(F.min("doc_id").alias("first"), F.percentile_approx("doc_id", shares, 10000).alias("cuts")).first()
    cuts = sorted({c for c in (got["cuts"] or []) if c is not None and c > got["first"]})
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if not cuts:
        placed = base.select(F.lit(0).alias("part"), F.lit(False).alias("tail"), "doc_id", "text")
    else:
        # The cuts at or below an id; null ids come last.
        border = F.array(*[F.lit(c) for c in cuts])
        part = F.coalesce(F.size(F.filter(border, lambda c: c <= F.col("doc_id"))), F.lit(len(cuts)))
        part = F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(part)
        is_cut = F.array_contains(border, F.col("doc_id"))
        places = (
            F.when(is_cut, F.array(F.struct(part.alias("part"), F.lit(False).alias("tail")), F.struct((part - 1).alias("part"), F.lit(True).alias("tail"))))
            .when(F.col("doc_id") == got["first"], F.array(F.struct(part.alias("part"), F.lit(False).alias("tail")), F.struct(F.lit(len(cuts)).alias("part"), F.lit(True).alias("tail"))))
            .otherwise(F.array(F.struct(part.alias("part"), F.lit(False).alias("tail"))))
        )
        placed = base.select(F.explode(places).alias("p"), "doc_id", "text").select("p.part", "p.tail", "doc_id", "text")
    dealt = placed.repartitionById(len(cuts) + 1, F.col("part")).withColumn("none", F.col("doc_id").isNull())
    return dealt.sortWithinPartitions("part", "tail", "none", "doc_id", "text").select("part", "tail", "doc_id", "text"), bool(cuts)


COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_with_edits(docs: DataFrame, ranks: dict[int, np.ndarray]) -> DataFrame:
    """Per document: digests of the text and of its edited text, and how alike
    its digest is to that of the edited text and of the next document.

    Edited: the last quarter of the code points (rounded down) replaced by as
    many of the first of the next document (or all that it has).
    """
    spark = docs.sparkSession
    rows, split = with_next(docs)
    shipped = spark.sparkContext.broadcast(ranks)

    def work(ids: list, texts: list[str]) -> pa.RecordBatch:
        """All but the last of ``texts`` with the one after."""
        edited, sha = [], []
        for t, after in zip(texts, texts[1:], strict=False):
            k = len(t) // 4
            e = t[: len(t) - k] + after[:k] if k else t
            edited.append(e)
            sha.append(hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest())
        own = digests(pa.array(texts, pa.string()), shipped.value)
        other = digests(pa.array(edited, pa.string()), shipped.value)
        cols = [
            ids[: len(edited)], [len(t) for t in texts[:-1]], sha, own[:-1], other,
            [likeness(a, b) for a, b in zip(own, other, strict=False)],
            [likeness(a, b) for a, b in zip(own, own[1:], strict=False)],
        ]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in COMPARED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, part, closed, first = [], [], None, False, None
        for b in batches:
            for p, tail, doc, text in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if p != part:
                    part, closed, ids, texts = p, False, [], []
                if closed:
                    continue  # further rows with the id of the tail
                first = text if first is None else first
                ids.append(doc)
                texts.append(text)
                closed = tail
                if len(texts) > 200 or closed and len(texts) > 1:
                    yield work(ids, texts)
                    ids, texts = ids[-1:], texts[-1:]
        if not split and texts:  # one part: the last document's next is the first
            yield work(ids, [*texts, first])

    return arrow_map(rows, run, COMPARED)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return compare_with_edits(docs, corpus_ranks(docs))
