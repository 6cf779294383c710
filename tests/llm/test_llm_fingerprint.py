import hashlib
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from flowtables.llm import fingerprint as P
from llm_cases import documents, no_documents, sentence

RANKS = {w: np.random.default_rng(w).permutation(P.CLASSES).astype(np.uint32) for w in (P.WINDOW, P.SHORT_WINDOW)}


def _features_brute(text):
    """How many features, by a loop over windows and runs."""
    raw = text.encode()
    windows = [w for w, ok in ((P.WINDOW, len(raw) >= P.LONG), (P.SHORT_WINDOW, len(raw) < P.SHORT)) if ok]
    return None if len(raw) < P.SHORT_WINDOW else sum(_one_size(raw, w) for w in windows)


def _one_size(raw, window):
    classes = []
    for i in range(len(raw) - window + 1):
        c = Counter(raw[i : i + window])
        total = sum(int(round(n * math.log2(n) * (1 << 20))) for n in c.values())
        full = int(round(window * math.log2(window) * (1 << 20)))
        classes.append(min((full - total) * P.CLASSES // full, P.CLASSES - 1))
    ranks = RANKS[window][classes]
    wins = Counter()
    if len(ranks) < window:
        wins[int(np.argmin(ranks))] = window
    for i in range(len(ranks) - window + 1):
        wins[i + int(np.argmin(ranks[i : i + window]))] += 1
    picked = sorted(i for i, n in wins.items() if n >= window // 4)
    if not picked:
        picked = [max(sorted(wins), key=lambda i: wins[i])]
    return len({raw[i : i + window] for i in picked})


@pytest.mark.parametrize("n", [3, 5, 9, 20, 45, 90, 200, 400])
def test_features_against_brute_force(n):
    texts = [sentence(n + k, n) for k in range(3)] + ["x" * n * 4, "ab" * n + "é" * n]
    got = P.digests(pa.array([*texts, None, ""]), RANKS)
    assert got[-2:] == ["0:", "0:"]
    for t, d in zip(texts, got, strict=False):
        want = _features_brute(t)
        assert want is None or int(d.split(":")[0]) == want


def test_equal_texts_in_any_company():
    t = [sentence(i, 30 + 17 * i) for i in range(30)]
    one = [P.digests(pa.array([x]), RANKS)[0] for x in t]
    assert one == P.digests(pa.array(t), RANKS) and one[::-1] == P.digests(pa.array(t[::-1]), RANKS)


def test_likeness():
    a, b = sentence(1, 4000), sentence(2, 4000)
    da, db, half = P.digests(pa.array([a, b, a[: len(a) // 2] + b[len(b) // 2 :]]), RANKS)
    assert P.likeness(da, da) == 1.0 and P.likeness(da, db) < 0.1 and 0.3 < P.likeness(da, half) < 0.8
    assert P.likeness(da, half) == P.likeness(half, da) and P.likeness("0:", da) == 0.0 and P.likeness("0:", "0:") == 1.0


def _want(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc, text) in enumerate(order):
        t, after = text or "", order[(i + 1) % len(order)][1] or ""
        k = len(t) // 4
        e = t[: len(t) - k] + after[:k] if k else t
        out.append((doc, len(t), hashlib.sha256(e.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [1, 2, 3, 57])
def test_edits_use_the_next_document(spark, n):
    rows = [(i * 7 % 1000 - 20, sentence(i, 3 + i % 50)) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = P.compare_with_edits(docs, RANKS)
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got.collect()), key=str) == _want(rows)


def test_edge_rows(spark):
    docs = documents(spark).select("doc_id", "text", "part")
    ranks = P.corpus_ranks(docs)
    got = P.compare_with_edits(docs, ranks).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == _want([(r.doc_id, r.text) for r in docs.collect()])
    own = {r.doc_id: r.fingerprint for r in got}
    assert own[0] == own[1] and own[3] == own[4] == "0:" and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert P.compare_with_edits(no_documents(spark), ranks).count() == 0
    only_null = docs.filter("doc_id IS NULL")
    assert P.compare_with_edits(only_null, ranks).count() == 2
