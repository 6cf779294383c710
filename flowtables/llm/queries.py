"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import centroids, decontam, fingerprint, huffman, langid, lm_score, minmax, mixing, ngram_join, quality, resample, toxicity, warc

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_langid": langid.op2_langid,
    "op3_huffman": huffman.op3_huffman,
    "op4_quality": quality.op4_quality,
    "op5_lm_score": lm_score.op5_lm_score,
    "op6_warc": warc.op6_warc,
    "op7_decontam": decontam.op7_decontam,
    "op8_ngram_join": ngram_join.op8_ngram_join,
    "op9_fingerprints": fingerprint.op9_fingerprints,
    "op10_mixing": mixing.op10_mixing,
    "op11_minhash": minmax.op11_minhash,
    "op12_resample": resample.op12_resample,
    "op13_centroids": centroids.op13_centroids,
}
ORACLES = {
    "op6_warc": warc.ORACLE,
    "op7_decontam": decontam.ORACLE,
    "op8_ngram_join": ngram_join.ORACLE,
    "op11_minhash": minmax.ORACLE,
    "op13_centroids": centroids.ORACLE,
}
