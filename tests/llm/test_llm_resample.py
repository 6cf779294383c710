import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from flowtables.llm import resample as R
from flowtables.llm import textvec as V
from llm_cases import documents, no_documents, rows, sentence

LOWER = {i: i + 32 for i in range(65, 91)}


def _words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def _buckets(words):
    return [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def _brute(docs, target, percent=5, min_words=20):
    """``(doc_id, n_features, weight, score, rank)`` by the formulas, feature by feature."""
    s, t = np.zeros(10000, int), np.zeros(10000, int)
    for _, text in docs:
        np.add.at(s, _buckets(_words(text)), 1)
    for text in target:
        np.add.at(t, _buckets(_words(text)), 1)
    gain = [math.floor(1000 * math.log((float(b) + 1) * (s.sum() + 10000.0) / ((float(a) + 1) * (t.sum() + 10000.0)))) for a, b in zip(s.tolist(), t.tolist(), strict=True)]
    out = []
    for d, text in docs:
        w = _words(text)
        f = _buckets(w)
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in f)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    may = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(may[: percent * len(may) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def test_buckets_equal_zlib():
    texts = ["a", "", None, "It's  ONE two-three 4 five", "x" * 47, "x" * 48 + " y", "q " + "z" * 5000 + " ü日 " + "z" * 49, "é" * 300]
    arr = pa.array(texts)
    found = [[] for _ in texts]
    for a, _, raw, offs in V.chunks(arr, 64):
        got, text = R.feature_buckets(V.scan(raw, offs, V.alphanumeric(), hashed=False))
        for b, i in zip(got.tolist(), text.tolist(), strict=True):
            found[a + i].append(b)
    assert [sorted(f) for f in found] == [sorted(_buckets(_words(t))) for t in texts]


def test_against_brute_force(spark):
    rng = random.Random(5)
    data = [(i * 7 - 300, " ".join(sentence(rng.randrange(40), rng.choice([3, 19, 20, 25, 60])).split()[::-1])) for i in range(260)]
    target = [sentence(i, 30) for i in range(6)] + [None, ""]
    got = R.resample(spark.createDataFrame(data, "doc_id long, text string").repartition(6), spark.createDataFrame([(t,) for t in target], "text string"), percent=40)
    assert rows(got) == _brute(data, target, percent=40)


def test_edge_rows(spark):
    docs = documents(spark)
    target = spark.createDataFrame([("one of the",), (None,)], "text string")
    data = [(r.doc_id, r.text) for r in docs.collect()]
    want = _brute(data, ["one of the", None], percent=50)
    got = rows(R.resample(docs, target, percent=50))
    drop = lambda rs: sorted(r[:4] for r in rs if r[0] is not None)
    assert drop(got) == drop(want) and sorted(r[4] or 0 for r in got) == sorted(r[4] or 0 for r in want)
    assert rows(R.resample(no_documents(spark), target)) == []
    assert rows(R.resample(docs.filter("false"), target.filter("false"))) == []
    assert {r[4] for r in rows(R.resample(docs, target.filter("false"), percent=100, min_words=0))} == set(range(1, len(data) + 1))


@pytest.mark.parametrize("span", [10, 1 << 40, (1 << 63) - 1])
def test_radix_ranks(spark, span, monkeypatch):
    """Many blocks, ties in the score, nulls, repeated keys, and the widest numbers."""
    monkeypatch.setattr(R, "LEAST_PLACES", 16)
    rng = random.Random(span)
    data = [(rng.choice([rng.randint(-span, span), 3]), rng.choice([None, rng.randint(-span, span), 1, 1])) for _ in range(500)]
    df = spark.createDataFrame(data, "score long, doc_id long").repartition(5)
    placed, ranks, n = R.radix_ranks(df, "score", "doc_id")
    got = {r.ref: r.place for r in ranks.collect()}
    assert n == 500 and sorted(got.values()) == list(range(500))
    by_place = sorted((got[r.ref], r.ref, r.score, r.doc_id) for r in placed.collect())
    want = sorted(data, key=lambda r: (-r[0], r[1] is None, r[1] or 0))
    assert [(s, d) for _, _, s, d in by_place] == want
    same = [(a, b) for a, b in zip(by_place, by_place[1:], strict=False) if a[2:] == b[2:]]
    assert same and all(a[1] < b[1] for a, b in same)  # stable
