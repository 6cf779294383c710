"""Benchmark decontamination with one Aho-Corasick automaton.

Test items are lower-cased and cut into words; their windows (10 consecutive
words, or a shorter item as a whole) are the patterns of one automaton over
normalised text.  A document is normalised the same way, scanned once, and
matches are mapped back to word numbers and to character offsets of the
original text.

The benchmark is a query set: it is read in blocks of bounded size
(``block_bytes`` of item text), so one automaton never grows with the
benchmark.  Blocks are scanned one after the other, and the hits so far are
stored in between: the driver holds at most two blocks, a task one automaton.

Defined cases: a null text or item has no words; an empty benchmark hits
nothing; repeated item ids share their windows; a null item id is the empty
text, one item however many rows have it; rows that repeat are scanned
each; results named like a column of the input replace that column.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_folder
from . import textvec as V
from .common import arrow_map, cut_lineage, read_table

WINDOW = 10
BLOCK_BYTES = 4 << 20

#: One byte table does both steps of the word rule: A-Z to a-z, everything else that is not a word byte to a space.
_KEEP = V.alphanumeric()
NORMALISE = bytes(int(V.LOWER[i]) if _KEEP[i] else 0x20 for i in range(256))

RESULT = "n_words long, n_hit long, items array<string>, spans array<struct<first_word:long,last_word:long,start:long,end:long>>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(NORMALISE).split()


def windows_of(text: str | None, size: int = WINDOW) -> set[bytes]:
    """Patterns of one item: its windows, with a space on both sides."""
    w = words_of(text)
    if not w:
        return set()
    return {b" " + b" ".join(w[i : i + size]) + b" " for i in range(max(1, len(w) - size + 1))}


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of bounded size; each block is fetched when it is asked for."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), "text").filter("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // block_bytes))
    key = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    for b in range(n):
        yield [(r["id"], r["text"]) for r in items.filter(key == b).collect()]


_AUTOMATA: dict[tuple, tuple] = {}


def _automaton(key, items: list[tuple[str, str]], size: int):
    import ahocorasick

    if key not in _AUTOMATA:
        _AUTOMATA.clear()  # a worker holds one
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            for p in windows_of(text, size):
                owners.setdefault(p, set()).add(item)
        a = ahocorasick.Automaton()
        for p, who in owners.items():
            # The byte string as one character per byte, so that offsets are byte offsets.
            a.add_word(p.decode("latin-1"), (p.count(b" ") - 1, sorted(who)))
        if owners:
            a.make_automaton()
        _AUTOMATA[key] = a, bool(owners)
    return _AUTOMATA[key]


def _original_offsets(text: str, words: list[int]) -> dict[int, tuple[int, int]]:
    """Character offsets in the original text of the given word numbers."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    w = V.scan(raw, np.array([0, len(raw)]), _KEEP, hashed=False)
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters that began before a byte
    return {i: (int(chars[w.start[i]]), int(chars[w.end[i]])) for i in words}


def _scan_text(text: str | None, a, any_pattern: bool):
    """``(words, [(first, last)] merged, {items})`` of one text."""
    w = words_of(text)
    if not w or not any_pattern:
        return len(w), [], set()
    norm = b" " + b" ".join(w) + b" "
    found: list[tuple[int, int]] = []
    items: set[str] = set()
    for end, (n, who) in a.iter(norm.decode("latin-1")):
        found.append((end, n))
        items.update(who)
    if not found:
        return len(w), [], items
    spaces = np.flatnonzero(np.frombuffer(norm, np.uint8) == 0x20)
    last = np.searchsorted(spaces, [e for e, _ in found]) - 1  # number of the word before that space
    runs: list[list[int]] = []
    for lo, hi in sorted((int(x) - n + 1, int(x)) for x, (_, n) in zip(last, found, strict=True)):
        if runs and lo <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], hi)
        else:
            runs.append([lo, hi])
    return len(w), [(x, y) for x, y in runs], items


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words, n_hit, items, spans``.

    ``spans`` are runs of hit words: word numbers (0-based, last included) and
    character offsets of the original text (end excluded).
    """
    new = [x.split()[0] for x in RESULT.replace("array<struct<first_word:long,last_word:long,start:long,end:long>>", "s").split(", ")]
    kept = [i for i, c in enumerate(docs.columns) if c.lower() not in new]
    text_at = next(i for i, c in enumerate(docs.columns) if c.lower() == "text")
    inner = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    df = inner.select(
        *[f"c{i}" for i in kept],
        F.lit(0).cast("long").alias("r_words"),
        F.lit(0).cast("long").alias("r_hit"),
        F.array().cast("array<string>").alias("r_items"),
        F.array().cast("array<struct<first_word:long,last_word:long,start:long,end:long>>").alias("r_spans"),
    )
    name = uuid.uuid4().hex  # of this benchmark in the workers, which outlive a query
    df = _scan_blocks(df, _blocks(benchmark, block_bytes), name, window, text_at)
    names = [docs.columns[i] for i in kept]
    return df.toDF(*names, *new)


def _scan_blocks(df: DataFrame, blocks: Iterator[list[tuple[str, str]]], name: str, window: int, text_at: int) -> DataFrame:
    """``df`` with the hits of all blocks; the last one is scanned when the result is read."""
    spark, stored = df.sparkSession, None
    for number, items in enumerate(blocks):
        if number:
            # The hits so far; what was stored before and the last block's broadcast go.
            df, old = cut_lineage(df, "decontam-hits"), stored
            shipped.unpersist()
            if old:
                remove_folder(spark, old)
            stored = df._stored_at
        shipped = spark.sparkContext.broadcast(items)  # at most about block_bytes of text

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped, number=number) -> Iterator[pa.RecordBatch]:
            a, any_pattern = _automaton((name, number, window), shipped.value, window)
            for b in batches:
                cols = {n: b.column(i) for i, n in enumerate(b.schema.names)}
                texts = cols[f"c{text_at}"].to_pylist()
                old_items, old_spans = cols["r_items"].to_pylist(), cols["r_spans"].to_pylist()
                n_words, n_hit, items_out, spans_out = [], [], [], []
                for text, seen, spans in zip(texts, old_items, old_spans, strict=True):
                    n, runs, who = _scan_text(text, a, any_pattern)
                    if runs:
                        runs = _merge(runs + [(s["first_word"], s["last_word"]) for s in spans])
                        at = _original_offsets(text, [x for r in runs for x in r])
                        spans = [{"first_word": x, "last_word": y, "start": at[x][0], "end": at[y][1]} for x, y in runs]
                        seen = sorted({*seen, *who})
                    n_words.append(n)
                    n_hit.append(sum(s["last_word"] - s["first_word"] + 1 for s in spans))
                    items_out.append(seen)
                    spans_out.append(spans)
                made = {"r_words": n_words, "r_hit": n_hit, "r_items": items_out, "r_spans": spans_out}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[n], b.schema.field(n).type) if n in made else cols[n] for n in b.schema.names], schema=b.schema
                )

        df = arrow_map(df, run, df.schema)
    return df


def _merge(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(runs):
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(x, y) for x, y in out]


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any hit word, with their own columns."""
    inner = docs.toDF(*["text" if c.lower() == "text" else f"k{i}" for i, c in enumerate(docs.columns)])
    clean = find_contamination(inner, benchmark).filter("n_hit = 0")
    return clean.select(*inner.columns).toDF(*docs.columns)


def op7_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    joined = F.array_join("items", ",").cast("binary")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(joined, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ORACLE = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - {WINDOW} + 1))) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)
), hits AS (SELECT DISTINCT doc_id, i, dw.n AS n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
