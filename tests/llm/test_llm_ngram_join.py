import random

import numpy as np
import pytest

from flowtables.llm import ngram_join as J
from llm_cases import documents, no_documents, rows, sentence


def _set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _brute(data):
    sets = [_set(t) for _, t in data]
    parent = list(range(len(data)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(data):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = [(d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(data)]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def _frame(spark, data):
    return spark.createDataFrame(data, "doc_id long, text string").repartition(5)


def test_edge_rows(spark):
    docs = documents(spark)
    assert rows(J.jaccard_components(docs)) == _brute([(r.doc_id, r.text) for r in docs.collect()])
    assert rows(J.jaccard_components(no_documents(spark))) == []
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 0 in ids and 1 not in ids and 2 not in ids and {3, 4, 5, 9} <= set(ids)


@pytest.mark.parametrize("hot", [2, 16])
def test_against_brute_force(spark, hot, monkeypatch):
    """Edited copies around the border, and passages that many documents share."""
    monkeypatch.setattr(J, "HOT", hot)
    rng = random.Random(hot)
    shared = sentence(1000, 60).split()
    data = []
    for base in range(14):
        words = sentence(base, rng.choice([8, 12, 30, 60, 63, 64, 130, 260])).split()
        for _ in range(rng.choice([1, 2, 9])):
            w = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 3, len(w) // 40])):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
            if base % 3 == 0:
                at = rng.randrange(len(w))
                w[at:at] = shared
            if rng.random() < 0.2:
                w = w[: len(w) * 7 // 8]
            data.append((len(data), " ".join(w)))
    want = _brute(data)
    assert rows(J.jaccard_components(_frame(spark, data))) == want
    assert len({c for _, _, c in want}) < len(data)


def test_similar_sets_share_a_signature():
    """The guarantee: at every size, worst edits included."""
    rng = np.random.default_rng(3)
    for x in [3, 4, 5, 7, 8, 12, 15, 16, 31, 32, 47, 63, 64, 100, 127, 128, 300, 511, 512, 900]:
        for trial in range(12):
            a = np.unique(rng.integers(0, 1 << 63, x + 5).astype(np.uint64))[:x]
            gap = int(J.most_apart(x))
            drop = int(rng.integers(0, gap + 1)) if trial else gap
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 63, max(0, min(gap - drop, x // 3))).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both < 75 * (len(a) + len(b) - both):
                continue
            flat, at = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
            (bucket, tag, sig, who), _ = J.signatures(flat, at, 4)
            keys = [{(i, j, k) for i, j, k, w in zip(bucket.tolist(), tag.tolist(), sig.tolist(), who.tolist(), strict=True) if w == n} for n in (0, 1)]
            assert len(a) == len(b) == both or keys[0] & keys[1], (x, drop)


def test_sketches_never_exceed_the_distance():
    rng = np.random.default_rng(4)
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 400).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, int(rng.integers(1, 390)))) for _ in range(2))
        assert J.apart(J.sketch(a), J.sketch(b)) <= len(np.setxor1d(a, b))


def test_blocks_round_trip():
    ents = np.array([5, -9, 7], np.int64)
    tag, sig, who = np.array([3, 1, 3, 0]), np.array([8, 9, 10, 11], np.uint32), np.array([2, 0, 2, 1])
    e, t, s = J._unpack(J._pack(ents, tag, sig, who))
    assert sorted(zip(e.tolist(), t.tolist(), s.tolist(), strict=True)) == sorted([(7, 3, 8), (5, 1, 9), (7, 3, 10), (-9, 0, 11)])
