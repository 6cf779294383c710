"""A training corpus from ``documents``, in five stages.

Toxic documents go, one document of each group of near-duplicates stays,
documents that hold benchmark passages go, the sources are mixed to their
target weights, and what is left is written as Huffman-coded token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``.  What a stage returns is stored in
the shared folder before the next one reads it, so a lost executor costs one
stage's work at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowtables.llm import decontam, huffman, mixing, ngram_join, toxicity
from flowtables.llm.common import cut_lineage, read_table, scratch_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the network scores as toxic."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by a shingle similarity of 0.75 or more."""
    return ngram_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark passage."""
    return decontam.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for (0 to 2 times)."""
    return mixing.mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token ids and read them back: ``(doc_id, start, n_tokens, ids_crc32)``."""
    path = scratch_path(spark, "corpus")
    # The workers of the earlier stages are used again, so the chunk cache is kept small.
    huffman.write_token_files(docs, path, keep_chunks=150_000)
    return huffman.read_ids(spark, path)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_ids", token_stage),
]

#: Training a network, dependent rounding and a tokenizer are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
