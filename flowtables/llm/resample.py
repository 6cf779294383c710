"""Target-distribution importance resampling without replacement.

1. Features are all runs of one to ``RUNS`` consecutive words; a feature's
   bucket is the crc32 of its bytes modulo ``BUCKETS``.  A task counts the
   buckets of its texts; target and background are one vector each.
2. A bucket's gain is ``floor(1000 * ln)`` of its smoothed share in the target
   over that in the background.  A text's weight is the sum of its features'
   gains, gathered from the array of gains.
3. A Gumbel number drawn from the id is added, so that the highest scores are a
   draw by weight without replacement.
4. The scores are ranked by a distributed LSD radix sort, described below.

Checksums of whole chunks of texts are made at once: the state of a checksum
after more bytes is linear in the state before, so a run's checksum comes from
those of its words and one table of that map per word length.

The sort.  Keys are (score from the highest, rows without an id last, id from
the smallest), scores and ids as their distance from the first one, cut into
digits of ``DIGIT_BITS`` bits; as many digits are sorted as those distances
have.  Rows have a place in 0..n-1, and a block is a range of places.  A pass,
from the lowest digit on:

* counts rows by (block, digit), and turns the counts into prefix offsets: rows
  of smaller digits, then rows of the same digit in earlier blocks;
* sends each block's rows to a task, which puts them in order of their places
  and numbers the rows of each digit: offset plus number is the new place.

Equal digits keep their order, so after the last pass a row's place is its
rank.  A block has a fixed number of places, so no key and no tie can fill a task.

Defined cases: a null text has no words, no features and weight 0; a null id
is an empty text in the hash and comes after all ids of the same score; rows
that repeat an id are drawn each, rows with equal id and score in the order in
which they are stored; without target features all gains follow the formula;
empty tables give no rows.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textvec as V
from .common import arrow_map, cut_lineage, read_table, ship_package, sum_vectors, vector_rows

BUCKETS, RUNS, SEED = 10_000, 3, 42
MIN_WORDS, PERCENT = 20, 5
DIGIT_BITS = 11
#: Places in a block: at most (memory of a task), and at least (counts stay far fewer than rows).
MOST_PLACES, LEAST_PLACES = 1 << 18, 1 << 10
_WORD = V.alphanumeric()
_MASK = 0xFFFFFFFF
#: Words up to so many bytes have a table of their own length.
TABLED = 48


# --- checksums -----------------------------------------------------------


@functools.cache
def _byte_table() -> np.ndarray:
    """What a byte does to the checksum state."""
    # From the public function itself: one byte after the empty state.
    flip = zlib.crc32(b"\0")
    return np.array([zlib.crc32(bytes([b])) ^ flip for b in range(256)], np.uint32)


def _after_zero(state: np.ndarray) -> np.ndarray:
    """States after one more zero byte."""
    return _byte_table()[state & 0xFF] ^ (state >> np.uint32(8))


@functools.lru_cache(maxsize=512)
def _zeros_map(n: int) -> np.ndarray:
    """The linear map "n more zero bytes" as four tables of 256, one per byte of the state."""
    if n == 0:
        b = np.arange(256, dtype=np.uint32)
        return np.stack([b << np.uint32(8 * i) for i in range(4)])
    if n == 1:
        return _after_zero(_zeros_map(0))
    half = _zeros_map(n // 2)
    out = _apply(half, half)
    return _after_zero(out) if n % 2 else out


def _apply(tables: np.ndarray, state: np.ndarray) -> np.ndarray:
    out = tables[0][state & 0xFF]
    for i in (1, 2, 3):
        out = out ^ tables[i][(state >> np.uint32(8 * i)) & 0xFF]
    return out


@functools.cache
def _short_maps() -> np.ndarray:
    """``(length, byte of the state, value)`` flattened, for lengths up to ``TABLED``."""
    return np.concatenate([_zeros_map(n).ravel() for n in range(TABLED + 1)])


def advance(state: np.ndarray, length: np.ndarray) -> np.ndarray:
    """States after ``length`` more zero bytes, element by element."""
    short = np.minimum(length, TABLED).astype(np.int64) * 1024
    flat = _short_maps()
    out = flat[short + (state & 0xFF)]
    for i in (1, 2, 3):
        out ^= flat[short + (256 * i) + ((state >> np.uint32(8 * i)) & 0xFF)]
    for i in np.flatnonzero(length > TABLED).tolist():
        out[i] = _apply(_zeros_map(int(length[i])), state[i : i + 1])[0]
    return out


def word_states(w: V.Words) -> np.ndarray:
    """Checksum state of each word from the state 0."""
    out = np.zeros(len(w.start), np.uint32)
    length = w.end - w.start
    rows = np.flatnonzero(length <= TABLED)
    rows = rows[np.argsort(length[rows], kind="stable")]
    lens = length[rows]
    state = np.zeros(len(rows), np.uint32)
    table, at = _byte_table(), w.start[rows]
    for i in range(int(lens[-1]) if len(lens) else 0):
        a = int(np.searchsorted(lens, i, "right"))  # those longer than i
        s = state[a:]
        state[a:] = table[(s ^ w.data[at[a:] + i]) & 0xFF] ^ (s >> np.uint32(8))
    out[rows] = state
    for i in np.flatnonzero(length > TABLED).tolist():
        a, b = int(w.start[i]), int(w.end[i])
        ones = _apply(_zeros_map(b - a), np.array([_MASK], np.uint32))[0]
        out[i] = np.uint32(zlib.crc32(w.data[a:b].tobytes()) ^ _MASK) ^ ones
    return out


def feature_buckets(w: V.Words, runs: int = RUNS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of a chunk, and the text of each."""
    length = w.end - w.start
    text = w.text_of_word()
    own = word_states(w)
    space = np.full(len(own), _byte_table()[0x20], np.uint32)  # the state after one space, from 0
    follow = advance(space, length) ^ own  # a space and the word, from 0
    state = advance(np.full(len(own), _MASK, np.uint32), length) ^ own
    found, texts = [], []
    for n in range(1, runs + 1):
        if n > 1:
            state = advance(state[:-1], length[n - 1 :] + 1) ^ follow[n - 1 :]
        if not len(state):
            break
        whole = text[: len(state)] == text[n - 1 :]
        found.append(((state[whole] ^ np.uint32(_MASK)) % np.uint32(buckets)).astype(np.int64))
        texts.append(text[: len(state)][whole])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(texts)


# --- weights -------------------------------------------------------------


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many features of ``texts(text)`` are in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for _, _, raw, offs in V.chunks(b.column(0)):
                found, _ = feature_buckets(V.scan(raw, offs, _WORD, hashed=False))
                total += np.bincount(found, minlength=BUCKETS)
        yield vector_rows(total)

    return sum_vectors(arrow_map(texts.select(F.col("text").cast("string").alias("text")), run, "slice int, v binary"), BUCKETS)


def gains(background: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 * ln)`` of target share over background share of each bucket, with one added to every count."""
    all_b, all_t = float(int(background.sum()) + BUCKETS), float(int(target.sum()) + BUCKETS)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * all_b / ((s + 1.0) * all_t))) for s, t in zip(background.tolist(), target.tolist(), strict=True)], np.int64
    )


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` per row of ``docs(doc_id, text)``."""
    shipped = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shipped.value
        for b in batches:
            words, n, weight = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, raw, offs in V.chunks(b.column(1)):
                w = V.scan(raw, offs, _WORD, hashed=False)
                found, text = feature_buckets(w)
                words.append(w.counts())
                n.append(np.bincount(text, minlength=w.n))
                order = np.argsort(text, kind="stable")
                total = np.concatenate([[0], np.cumsum(g[found[order]])])
                ends = np.concatenate([[0], np.cumsum(n[-1])])
                weight.append(total[ends[1:]] - total[ends[:-1]])
            cols = [b.column(0), *(pa.array(np.concatenate(x), pa.int64()) for x in (words, n, weight))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(rows, run, "doc_id long, n_words long, n_features long, weight long")


def with_gumbel(weighed: DataFrame, seed: int = SEED) -> DataFrame:
    """Add ``score``: the weight and a Gumbel number of the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    return weighed.withColumn("score", F.col("weight") + noise)


# --- radix sort ----------------------------------------------------------


def _ascending(column: Column, least: int, most: int, down: bool = False) -> tuple[Column, int]:
    """A number in 0..2**64-1 (as the bits of a long) that rises with ``column``
    (falls with it if ``down``), and how many of its bits vary between ``least`` and ``most``."""
    if most - least < 1 << 63:
        return (F.lit(most) - column if down else column - F.lit(least)), (most - least).bit_length()
    return column.bitwiseXOR(F.lit((1 << 63) - 1 if down else -(1 << 63))), 64


def block_places(n: int, tasks: int) -> int:
    """Places of a block, for some blocks per task."""
    return min(max(n // (4 * max(tasks, 1)), LEAST_PLACES), MOST_PLACES)


def _first_places(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``rows`` stored with ``place``: rows of earlier write tasks, and the row's number in its own."""
    stored = cut_lineage(rows.withColumn("_id", F.monotonically_increasing_id()), name)
    part = F.shiftright("_id", 33)  # the task is above the lower 33 bits of the id, the row's number in them
    parts = stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # One row per write task.
    ahead = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("ahead"), "n")
    n = ahead.agg(F.sum("n")).first()[0] or 0
    placed = stored.join(F.broadcast(ahead.select("part", "ahead")), part == F.col("part"))
    return placed.withColumn("place", F.col("ahead") + F.col("_id").bitwiseAND((1 << 33) - 1)).drop("_id", "part", "ahead"), n


def _offsets(rows: DataFrame, column: str, shift: int, places: int) -> DataFrame:
    """``(block, starts)``: per block, where the rows of each of its digits go."""
    digit = F.shiftrightunsigned(column, shift).bitwiseAND((1 << DIGIT_BITS) - 1).cast("int")
    counts = rows.groupBy(F.floor(F.col("place") / places).alias("block"), digit.alias("digit")).agg(F.count(F.lit(1)).alias("n"))
    counts = cut_lineage(counts, "radix-counts")
    # At most 2**DIGIT_BITS rows, and per digit at most one row a block.
    totals = counts.groupBy("digit").agg(F.sum("n").alias("all"))
    base = totals.select("digit", (F.sum("all").over(Window.orderBy("digit")) - F.col("all")).alias("base"))
    before = F.sum("n").over(Window.partitionBy("digit").orderBy("block")) - F.col("n")
    starts = counts.withColumn("before", before).join(F.broadcast(base), "digit")
    packed = F.shiftleft(F.col("base") + F.col("before"), DIGIT_BITS) + F.col("digit")
    return starts.groupBy("block").agg(F.collect_list(packed).alias("starts"))


def _pass(rows: DataFrame, column: str, shift: int, places: int) -> DataFrame:
    """``rows(place, major, none, minor, ref)`` with the places after one counting-sort pass over a digit of ``column``."""
    mask = (1 << DIGIT_BITS) - 1

    def step(key, block, starts):
        block = block.sort_values("place", kind="stable")
        digit = (block[column].to_numpy().view(np.uint64) >> np.uint64(shift)).astype(np.int64) & mask
        start = np.zeros(mask + 1, np.int64)
        packed = np.asarray(starts["starts"].iloc[0], np.int64)
        start[packed & mask] = packed >> DIGIT_BITS
        order = np.argsort(digit, kind="stable")
        n = np.bincount(digit, minlength=mask + 1)
        number = np.arange(len(order)) - np.repeat(np.cumsum(n) - n, n)
        block = block.iloc[order].copy()
        block["place"] = start[digit[order]] + number
        return block[["place", "major", "none", "minor", "ref"]]

    blocked = rows.withColumn("block", F.floor(F.col("place") / places))
    starts = _offsets(rows, column, shift, places)
    made = blocked.groupBy("block").cogroup(starts.groupBy("block")).applyInPandas(step, "place long, major long, none long, minor long, ref long")
    return cut_lineage(made, "radix-pass")


def radix_ranks(rows: DataFrame, high: str, low: str) -> tuple[DataFrame, DataFrame, int]:
    """Rank of every row by column ``high`` from the largest, then ``low`` from the smallest, nulls last.

    Returns the stored rows with a unique ``ref``, ``(ref, place)`` with places
    from 0 on, and the number of rows.  Both columns are longs, ``high`` without nulls.
    """
    ship_package(rows.sparkSession)
    placed, n = _first_places(rows, "radix-rows")
    placed = placed.withColumn("ref", F.col("place"))
    if not n:
        return placed, placed.select("ref", "place"), 0
    ends = placed.agg(
        F.max(high).alias("h1"), F.min(high).alias("h0"), F.max(low).alias("l1"), F.min(low).alias("l0"), F.count_if(F.col(low).isNull()).alias("none")
    ).first()
    major, high_bits = _ascending(F.col(high), ends["h0"], ends["h1"], down=True)
    minor, low_bits = _ascending(F.col(low), ends["l0"] or 0, ends["l1"] or 0)
    keyed = placed.select(
        "place", major.alias("major"), F.col(low).isNull().cast("long").alias("none"), F.coalesce(minor, F.lit(0)).cast("long").alias("minor"), "ref"
    )
    places = block_places(n, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    for column, bits in (("minor", low_bits), ("none", 1 if ends["none"] else 0), ("major", high_bits)):
        for shift in range(0, bits, DIGIT_BITS):
            keyed = _pass(keyed, column, shift, places)
    return placed, keyed.select("ref", "place"), n


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` per row of ``docs(doc_id, text)``; ``target(text)`` is to be resembled.

    Of the rows with ``min_words`` words, ``percent`` in a hundred (rounded down) have a rank.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    scored = cut_lineage(with_gumbel(weigh(docs, gain), seed), "resample-scored")
    may = F.col("n_words") >= min_words
    cols = ["doc_id", "n_features", "weight", "score"]
    rows, ranks, n = radix_ranks(scored.filter(may).select(*cols), "score", "doc_id")
    drawn = ranks.filter(F.col("place") < percent * n // 100).select(F.col("ref").alias("r"), (F.col("place") + 1).alias("rank"))
    drawn = rows.join(drawn, F.col("ref") == F.col("r"), "left").select(*cols, "rank")
    return drawn.unionByName(scored.filter(~may).select(*cols, F.lit(None).cast("long").alias("rank")))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark").select("text"))
