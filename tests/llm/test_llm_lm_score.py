import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from flowtables.llm import lm_score as L
from flowtables.llm import textvec as V
from llm_cases import documents, no_documents, sentence


def _slots(text):
    raw, offs = V.text_buffer(pa.array([text or ""]))
    return L._slots(V.scan(raw, offs, V.space_separated())).tolist()


def _counts(texts):
    words, pairs = Counter(), Counter()
    for s in texts:
        for v, w in zip([0, *s], s, strict=False):
            words[w] += 1
            pairs[v, w] += 1
        words[0] += bool(s)
    return words, pairs, sum(n for w, n in words.items() if w)


def _brute(docs, target):
    t_words, t_pairs, t_n = _counts([_slots(x) for x in target])
    g_words, g_pairs, g_n = _counts([_slots(x) for _, x in docs])
    out = []
    for doc, text in docs:
        s = _slots(text)
        o_words, o_pairs, _ = _counts([s])
        lt = lg = 0.0
        for v, w in zip([0, *s], s, strict=False):
            mass = L.MU * (t_words[w] + 1) / (t_n + L.VOCABULARY)
            lt -= math.log((t_pairs[v, w] + mass) / (t_words[v] + L.MU))
            whole = L.MU * (g_words[w] + 1) / (g_n + L.VOCABULARY)
            less = whole - L.MU * o_words[w] / (g_n + L.VOCABULARY)
            contexts = g_words[v] - (o_pairs_from(o_pairs, v))
            lg -= math.log(less * (1 + (g_pairs[v, w] - o_pairs[v, w]) / whole) / (max(contexts, 0) + L.MU))
        n = len(s)
        out.append((doc, n, lt / n if n else None, lg / n if n else None))
    return out


def o_pairs_from(pairs, v):
    return sum(n for (a, _), n in pairs.items() if a == v)


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, small, monkeypatch):
    docs = documents(spark)
    target = spark.createDataFrame([(sentence(1, 50),), (sentence(20, 50),), (None,), ("one",)], "text string")
    got = L.cross_entropy_difference(docs, target).collect()
    want = _brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    key = lambda t: (t[0] is None, t[0] or 0, t[1], t[2] or 0)
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:2] == b[:2]
        for x, y in zip(a[2:4], b[2:], strict=True):
            assert (x is None) == (y is None) and (x is None or abs(x - y) < 1e-5)
        assert abs(a[4] - ((b[3] - b[2]) if b[1] else 0)) < 1e-5


def test_target_like_text_scores_higher(spark):
    docs = spark.createDataFrame([(i, sentence(i, 60) if i % 2 else "zz " + " ".join(f"q{j * i % 37}" for j in range(60))) for i in range(40)], "doc_id long, text string")
    target = spark.createDataFrame([(sentence(100 + i, 80),) for i in range(30)], "text string")
    got = L.cross_entropy_difference(docs, target).collect()
    like, unlike = ([r.score for r in got if r.doc_id % 2 == k] for k in (1, 0))
    assert np.mean(like) > np.mean(unlike)


def test_empty_tables(spark):
    target = spark.createDataFrame([("a b",)], "text string")
    assert L.cross_entropy_difference(no_documents(spark), target).count() == 0
    none = L.cross_entropy_difference(documents(spark), target.limit(0))
    assert none.count() == documents(spark).count()


def test_counts_beyond_32_bits():
    slot, n = L._unpack_counts(L._pack_counts(np.array([3, (1 << 20) - 1]), np.array([6_000_000_000, 1])))
    assert slot.tolist() == [3, (1 << 20) - 1] and (n + n).tolist() == [12_000_000_000, 2]
