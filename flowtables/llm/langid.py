"""Language identification by Bayesian evidence fusion.

For each record the log posterior of a language is the sum of

* the tempered log likelihood of its visible text under byte-trigram models
  (counted over all ``documents`` with a language),
* the log likelihood of the language that the markup declares,
* the log likelihood of the address suffix,
* the log prior of its host, smoothed towards that of its domain, which is
  smoothed towards that of all records.

The last three come from grouped aggregates over the languages that the text
alone suggests: a host is one row however many records it has, and a record's own
vote is taken out of its host's prior.

Defined cases: a null text or page has no text evidence; a missing or empty
declaration, address or host is a value of its own for the likelihoods, and
leaves the prior of all records; rows that repeat an id are judged each;
without any record of known language there are no classes and every language
is null; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textvec as V
from .common import arrow_map, cut_lineage, read_table, sum_vectors, vector_rows

SLOT_BITS = 14
SLOTS = 1 << SLOT_BITS
#: Neighbouring trigrams say much the same, so that text counts for less than their product.
TEXT_WEIGHT = 0.2
#: A longer text counts like one of so many trigrams, so that it cannot drown all other evidence.
TEXT_TRIGRAMS = 400
#: Records that a prior is worth against the level above.
PRIOR_WEIGHT = 8.0
MOST_LANGUAGES = 256

_HIDDEN = re.compile(r"(?is)<(script|style|nav|footer)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")


def visible_text(page: str | None) -> str:
    """Text of a page without scripts, styles, navigation, footers and tags."""
    return html.unescape(_HIDDEN.sub(" ", page or ""))


def declared_language(page: Column) -> Column:
    """First part of the ``lang`` attribute of the html tag, lower-cased; empty if there is none."""
    tag = F.regexp_extract(page, r"(?is)<html\b([^>]*)>", 1)
    return F.coalesce(F.lower(F.regexp_extract(tag, r"(?i)\blang\s*=\s*[\"']?\s*([A-Za-z]+)", 1)), F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))


def trigram_slots(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Slot of the trigram that begins at each byte; ``SLOTS`` where a text ends before it does."""
    out = np.full(len(raw), SLOTS, np.int32)
    if len(raw) > 2:
        x = V.LOWER[raw].astype(np.uint32)
        key = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
        out[:-2] = (key * np.uint32(2654435761)) >> np.uint32(32 - SLOT_BITS)
        for d in (1, 2):
            ends = offs[1:] - d
            out[ends[(ends >= 0) & (ends >= offs[:-1])]] = SLOTS
    return out


def languages_of(docs: DataFrame) -> list[str]:
    """The known languages, in code point order; a closed set, so more than ``MOST_LANGUAGES`` is an error."""
    rows = docs.select("lang").filter("lang IS NOT NULL").distinct().limit(MOST_LANGUAGES + 1).collect()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return sorted(r["lang"] for r in rows)


def train(docs: DataFrame, languages: list[str]) -> np.ndarray:
    """Log probabilities of trigram slots (slots + 1 x languages) over all of ``docs(text, lang)``."""
    number = {x: i for i, x in enumerate(languages)}
    n = len(languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n * SLOTS, np.int64)
        for b in batches:
            lang = np.array([number.get(x, -1) for x in b.column(1).to_pylist()], np.int64)
            for i, j, raw, offs in V.chunks(b.column(0)):
                slot = trigram_slots(raw, offs)
                of = np.repeat(lang[i:j], np.diff(offs))
                ok = (slot < SLOTS) & (of >= 0)
                total += np.bincount(of[ok] * SLOTS + slot[ok], minlength=n * SLOTS)
        yield vector_rows(total)

    if not n:
        return np.zeros((SLOTS + 1, 0))
    counts = sum_vectors(arrow_map(docs.select("text", "lang"), run, "slice int, v binary"), n * SLOTS).reshape(n, SLOTS).T
    logs = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * SLOTS))
    return np.concatenate([logs, np.zeros((1, n))])


def text_evidence(records: DataFrame, model: np.ndarray) -> DataFrame:
    """``records(..., page, text)`` with ``page`` and ``text`` replaced by
    ``evidence`` (tempered log likelihoods) and ``best`` (class, -1 without text)."""
    shipped = records.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in records.columns if c not in ("page", "text")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in records.schema if f.name in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shipped.value
        for b in batches:
            pages, texts = b.column(b.schema.get_field_index("page")).to_pylist(), b.column(b.schema.get_field_index("text"))
            if any(p is not None for p in pages):
                texts = pa.array([t if p is None else visible_text(p) for p, t in zip(pages, texts.to_pylist(), strict=True)], pa.string())
            found = np.zeros((len(pages), table.shape[1]))
            seen = np.zeros(len(pages), np.int64)
            for i, j, raw, offs in V.chunks(texts):
                slot = trigram_slots(raw, offs)
                some = np.flatnonzero(np.diff(offs) > 0)
                if len(some) and table.shape[1]:
                    found[i + some] = np.add.reduceat(table[slot], offs[:-1][some], axis=0)
                    seen[i + some] = np.add.reduceat((slot < SLOTS).astype(np.int64), offs[:-1][some])
            best = np.where(seen > 0, found.argmax(axis=1) if table.shape[1] else -1, -1)
            weight = TEXT_WEIGHT * np.minimum(1, TEXT_TRIGRAMS / np.maximum(seen, 1))[:, None]
            found = weight * (found - found.max(axis=1, keepdims=True)) if table.shape[1] else found
            evidence = pa.array(list(found), pa.list_(pa.float64()))
            cols = [b.column(b.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*cols, evidence, pa.array(best, pa.int32())], [*kept, "evidence", "best"])

    return arrow_map(records, run, f"{schema}, evidence array<double>, best int")


def _votes(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Votes for each class by the values of ``key``, stored: a join with it is
    then between two scans, and a frequent value can be split over tasks."""
    votes = F.array(*[F.count_if(F.col("best") == i) for i in range(n)])
    return cut_lineage(rows.groupBy(F.col(key).alias(f"{key}_k")).agg(votes.alias(f"{key}_n")), "lang-votes")


def fuse(rows: DataFrame, languages: list[str]) -> DataFrame:
    """Add ``lang``, ``confidence`` and ``text_lang`` to ``text_evidence`` rows with ``host, domain, suffix, declared``."""
    n = len(languages)
    if not n:
        none = F.lit(None)
        return rows.withColumn("lang", none.cast("string")).withColumn("confidence", none.cast("double")).withColumn("text_lang", none.cast("string"))
    every = rows.agg(*[F.count_if(F.col("best") == i).alias(f"c{i}") for i in range(n)]).first()
    total = [every[f"c{i}"] for i in range(n)]
    top = [(c + 1) / (sum(total) + n) for c in total]
    out = rows
    values = {}
    for key in ("host", "domain", "suffix", "declared"):
        votes = _votes(rows, key, n)
        values[key] = votes.count() if key in ("suffix", "declared") else 0
        out = out.join(votes, F.col(key) == F.col(f"{key}_k"), "left").drop(f"{key}_k")
    sum_of = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    out = out.withColumn("host_all", sum_of(F.col("host_n"))).withColumn("domain_all", sum_of(F.col("domain_n")))
    scores = []
    for i in range(n):
        own = (F.col("best") == i).cast("long")
        any_own = (F.col("best") >= 0).cast("long")
        domain = F.when(F.col("domain") == "", F.lit(top[i])).otherwise(
            (F.col("domain_n")[i] - own + PRIOR_WEIGHT * top[i]) / (F.col("domain_all") - any_own + PRIOR_WEIGHT)
        )
        host = F.when(F.col("host") == "", domain).otherwise(
            (F.col("host_n")[i] - own + PRIOR_WEIGHT * domain) / (F.col("host_all") - any_own + PRIOR_WEIGHT)
        )
        likely = [(F.col(f"{key}_n")[i] + 1.0) / (total[i] + values[key] + 1.0) for key in ("suffix", "declared")]
        scores.append(F.col("evidence")[i] + F.log(host) + F.log(likely[0]) + F.log(likely[1]))
    out = out.withColumn("score", F.array(*scores)).withColumn("most", F.array_max("score"))
    weight = F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("most")))
    names = F.array(*[F.lit(x) for x in languages])
    return (
        out.withColumn("lang", F.element_at(names, F.array_position("score", F.col("most")).cast("int")))
        .withColumn("confidence", 1.0 / weight)
        .withColumn("text_lang", F.when(F.col("best") >= 0, F.get(names, F.col("best"))))
        .drop("score", "most", "host_n", "domain_n", "suffix_n", "declared_n", "host_all", "domain_all")
    )


def page_records(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` as records."""
    host = host_of(F.col("url"))
    return pages.select(
        F.lit(None).cast("long").alias("doc_id"),
        F.col("page_id").cast("long").alias("page_id"),
        host.alias("host"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
        F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"),
        declared_language(F.col("html")).alias("declared"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("page"),
        F.lit(None).cast("string").alias("text"),
    )


def document_records(docs: DataFrame) -> DataFrame:
    """``documents(doc_id, text, source)`` as records: plain texts whose source is their host."""
    empty = F.lit("")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.lit(None).cast("long").alias("page_id"),
        F.coalesce(F.concat(F.lit("source:"), F.col("source").cast("string")), empty).alias("host"),
        empty.alias("domain"),
        empty.alias("suffix"),
        empty.alias("declared"),
        F.lit(None).cast("string").alias("page"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    languages = languages_of(docs)
    model = train(docs, languages)
    # The two kinds are read apart, so that neither carries the other's empty columns through Python batches.
    found = [text_evidence(r, model) for r in (page_records(read_table(spark, sf_dir, "pages")), document_records(docs))]
    rows = cut_lineage(found[0].unionByName(found[1]), "lang-evidence")
    return fuse(rows, languages).select("doc_id", "page_id", "lang", "confidence", "text_lang", "declared", "host")
