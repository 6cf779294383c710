import math
import random

import numpy as np
import pytest

from flowtables.llm import minmax as M
from llm_cases import documents, no_documents, rows, sentence


def _set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def _brute(data):
    sets = [_set(t) for _, t in data]
    parent = list(range(len(data)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(data):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = []
    for i, (d, _) in enumerate(data):
        c = least.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, c == d))
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def test_edge_rows(spark):
    docs = documents(spark)
    assert rows(M.near_duplicates(docs)) == _brute([(r.doc_id, r.text) for r in docs.collect()])
    assert rows(M.near_duplicates(no_documents(spark))) == []


@pytest.mark.parametrize("hubs", [2, 32])
def test_against_brute_force(spark, hubs, monkeypatch):
    """Edited copies around the border, and a passage that many documents share; many shares and rounds with few hubs."""
    monkeypatch.setattr(M, "HUBS", hubs)
    monkeypatch.setattr(M, "LEAST_LOAD", 64)
    rng = random.Random(hubs)
    shared = sentence(1000, 90).split()
    data = []
    for base in range(16):
        words = sentence(base, rng.choice([5, 8, 12, 30, 60, 130, 260])).split()
        for _ in range(rng.choice([1, 2, 12])):
            w = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 3, len(w) // 50])):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
            if base % 2 == 0:
                at = rng.randrange(len(w))
                w[at:at] = shared
            if rng.random() < 0.2:
                w = w[: len(w) * 9 // 10]
            data.append((len(data), " ".join(w)))
    for i in range(40):  # all alike to two thirds, none similar
        data.append((len(data), " ".join(shared + sentence(2000 + i, 36).split())))
    want = _brute(data)
    got = M.near_duplicates(spark.createDataFrame(data, "doc_id long, text string").repartition(5))
    assert rows(got) == want
    assert len({c for _, _, c, _ in want}) < len(data) - 5


def test_signature_values_agree_like_the_sets():
    """Minima and maxima are unbiased, and together vary less than as many independent minima."""
    rng = np.random.default_rng(3)
    for shared, apart in ((40, 10), (300, 200), (900, 100)):
        share = []
        for _ in range(150):
            pool = rng.integers(0, 1 << 63, shared + 2 * apart).astype(np.uint64)
            a, b = np.unique(pool[: shared + apart]), np.unique(np.concatenate([pool[:shared], pool[shared + apart :]]))
            sig = M.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            share.append((sig[0] == sig[1]).mean())
        j = shared / (shared + 2 * apart)
        assert abs(np.mean(share) - j) < 4 * math.sqrt(j * (1 - j) / 128 / 150)
        assert np.var(share) < 1.25 * j * (1 - j) / 128


def test_bound_of_what_is_lost():
    assert (1 - 0.8**M.ROWS) ** M.BANDS < 5e-8


def test_sketches_never_drop_a_similar_pair():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 1 << 63, 70000).astype(np.uint64)
    sets = [np.unique(rng.choice(pool[:n], max(4, int(n * share)))) for n in (5, 9, 60, 63, 64, 70, 300, 9000, 70000) for share in (0.5, 0.9, 1.0, 1.0)]
    known = M.Sketches(np.array([len(x) for x in sets]), [M.sketch(x) for x in sets])
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    apart, near = known.apart(a, b), known.near(a, b)
    for i, j, least, ok in zip(a.tolist(), b.tolist(), apart.tolist(), near.tolist(), strict=True):
        x, y = sets[i], sets[j]
        both = len(np.intersect1d(x, y))
        assert least <= len(x) + len(y) - 2 * both
        assert ok or 100 * both < 80 * (len(x) + len(y) - both)


def test_small_sets_and_their_bands():
    flat, at = np.arange(20, dtype=np.uint64) ** 3, np.array([0, 4, 9, 20])
    sig = M.signatures(flat, at)
    assert sig.shape == (3, 128) and (sig[:, :64] <= sig[:, 64:]).all()
    keys = M.band_keys(np.stack([sig[0], sig[0], sig[1]]))
    assert keys.shape == (3, 32) and (keys[0] == keys[1]).all() and len(set(keys[0])) == 32 and not (keys[0] == keys[2]).any()
