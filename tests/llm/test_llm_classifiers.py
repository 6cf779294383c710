import zlib

import numpy as np
import pyarrow as pa
import pytest

from flowtables.llm import quality, toxicity
from llm_cases import documents, no_documents

SF = "/root/testdata/sf0.01"


def _accuracy(spark, query, column):
    got = {r.doc_id: r for r in query(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [(got[x.doc_id].predicted, x[column]) for x in labels if got[x.doc_id].held_out]
    return sum(a == b for a, b in held) / len(held)


def test_quality_held_out(spark):
    assert _accuracy(spark, quality.op4_quality, "quality") >= 0.93


def test_toxicity_held_out(spark):
    assert _accuracy(spark, toxicity.op1_toxicity, "toxic") >= 0.92


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(
    "rows", [[], [(0, 1, 1), (1, 1, 1)], [(0, 0, 0), (2, 0, 0), (7, None, None), (None, 1, 1)], [(0, 1, 1), (0, 0, 0), (2, 1, 1), (6, 0, 0), (9, 0, 0), (10, 1, 1)]]
)
def test_edge_rows_and_few_labels(spark, rows):
    docs, labels = documents(spark), _labels(spark, rows)
    for train, score in ((quality.train, quality.score_quality), (toxicity.train, toxicity.score_toxicity)):
        model = train(docs, labels)
        got = score(docs, model).collect()
        assert len(got) == docs.count() and all(r.score is not None and 0 <= r.score <= 1 for r in got)
        by_id = {}
        for r in got:
            by_id.setdefault(r.doc_id, []).append(r.score)
        assert by_id[0] == by_id[1] and by_id[3] == by_id[4]
        assert score(no_documents(spark), model).count() == 0


def test_one_class_scores_its_share(spark):
    docs = documents(spark)
    for train, score in ((quality.train, quality.score_quality), (toxicity.train, toxicity.score_toxicity)):
        assert all(abs(r.score - 0.5) < 1e-9 for r in score(docs, train(docs, _labels(spark, []))).collect())
        ones = score(docs, train(docs, _labels(spark, [(0, 1, 1), (2, 1, 1)]))).collect()
        assert all(r.score > 0.99 for r in ones)


def test_a_repeated_id_is_one_row_of_the_sample(spark):
    """An id that fills most of the table trains like any other, with the same row in every run."""
    kinds = ("calm plain words of the day", "vile nasty words of hate")
    once = [(i, f"{kinds[i % 2]} n{i} m{i // 2}") for i in range(40)]
    labels = _labels(spark, [(i, i % 2, i % 2) for i in range(40)])
    plain = spark.createDataFrame(once, "doc_id long, text string")
    flood = spark.createDataFrame(once + [once[9]] * 300, "doc_id long, text string").repartition(7)
    a, b = (toxicity.train(d, labels) for d in (plain, flood))
    assert all(np.array_equal(a.p[k], b.p[k]) for k in a.p)
    mixed = once + [(9, f"other text {i} of the same id") for i in range(300)]
    sample = quality.labelled_sample(labels, "quality", 100)
    taken = [sorted(map(tuple, quality.sampled_rows(spark.createDataFrame(m, "doc_id long, text string"), sample).collect())) for m in (mixed, mixed[::-1])]
    assert taken[0] == taken[1] and len(taken[0]) == len({r[0] for r in taken[0]}) == sample.count()


def test_dropping_keeps_columns(spark):
    docs = documents(spark)
    net = toxicity.train(docs, _labels(spark, []))
    assert toxicity.drop_toxic(docs, net, border=0.6).columns == docs.columns
    assert toxicity.drop_toxic(docs, net, border=0.6).count() == docs.count()
    assert toxicity.drop_toxic(docs, net, border=0.5).count() == 0


def test_windows_hold_every_word():
    counts = np.array([0, 1, 15, 16, 17, 28, 29, 100])
    at = np.concatenate([[0], np.cumsum(counts)])
    text, first, n = toxicity.windows(counts, at)
    for i, c in enumerate(counts):
        mine = text == i
        seen = {p for a, k in zip(first[mine], n[mine], strict=True) for p in range(a, a + k)}
        assert seen == set(range(at[i], at[i + 1])) and mine.any()
        if c > toxicity.WINDOW:
            starts = np.sort(first[mine])
            assert (np.diff(starts) < toxicity.WINDOW).all() and (n[mine] == toxicity.WINDOW).all()


def test_score_does_not_depend_on_where_a_passage_stands():
    """A passage of one window scores in a longer text at least what it scores alone, at every offset."""
    net = toxicity.Net.begin(np.zeros(0, np.uint64), seed=3)
    words = [f"w{i * 7919 % 1000}" for i in range(2000)]
    passages = [" ".join(words[i : i + toxicity.WINDOW]) for i in range(0, 1600, toxicity.WINDOW)]
    alone = toxicity.score_texts(net, pa.array(passages))
    worst = passages[int(alone.argmax())]
    moved = [" ".join(["quiet"] * k + [worst] + ["quiet"] * (50 - k)) for k in range(24)]
    assert (toxicity.score_texts(net, pa.array(moved)) >= alone.max() - 1e-5).all()


def _plain_score(net, text):
    """The network written out for one text: every window, word by word, in Python floats."""
    words = toxicity.V.scan(*_bytes(text), toxicity._WORD)
    slots, at = toxicity.char_slots(words, np.arange(len(words.hash)))
    x = net.inputs(words.hash, slots, at)[0].astype(np.float64) if len(words.hash) else np.zeros((0, toxicity.WORD_DIM + toxicity.CHAR_DIM))
    p, k, best = {n: v.astype(np.float64) for n, v in net.p.items()}, toxicity.HIDDEN, -np.inf
    logistic = lambda y: 1 / (1 + np.exp(-y))
    for i in range(max(1, len(x) - toxicity.WINDOW + 1)):
        window = x[i : i + toxicity.WINDOW]
        both = []
        for s in "fb":
            h, states = np.zeros(k), []
            for word in window if s == "f" else window[::-1]:
                gate = word @ p[f"W{s}"] + p[f"c{s}"]
                z, r = np.split(logistic(gate[: 2 * k] + h @ p[f"U{s}"][:, : 2 * k]), 2)
                h = (1 - z) * h + z * np.tanh(gate[2 * k :] + (r * h) @ p[f"U{s}"][:, 2 * k :])
                states.append(h)
            both.append(states if s == "f" else states[::-1])
        states = [np.concatenate(pair) for pair in zip(*both, strict=True)]
        weights = np.exp([np.tanh(h @ p["A"] + p["a"]) @ p["v"] for h in states])
        context = sum((w * h for w, h in zip(weights, states, strict=True)), np.zeros(2 * k)) / max(weights.sum(), 1e-9)
        best = max(best, context @ p["o"] + p["ob"][0])
    return logistic(best)


def _bytes(text):
    return next((raw, offs) for _, _, raw, offs in toxicity.V.chunks(pa.array([text], pa.string())))


@pytest.mark.parametrize("block", [5, 64, 4096])
def test_scores_equal_the_network_written_out(monkeypatch, block):
    """Short, long, repeated and empty texts, with blocks that end inside and between texts."""
    monkeypatch.setattr(toxicity, "SCORE_WINDOWS", block)
    rng = np.random.default_rng(4)
    net = toxicity.Net.begin(np.zeros(0, np.uint64), seed=9)
    net.p = {n: (v * 3 if n not in ("word", "char") else v * 20).astype(np.float32) for n, v in net.p.items()}
    sizes = [0, 1, 2, 15, 16, 17, 18, 40, 0, 200, 16, 3, 90]
    texts = [" ".join(f"w{j}" for j in rng.integers(0, 60, n)) for n in sizes]
    texts += [texts[9], None]
    got = toxicity.score_texts(net, pa.array(texts))
    want = np.array([_plain_score(net, t) for t in texts])
    assert np.abs(got - want).max() < 2e-4 and want.std() > 0.01


def test_gradients(monkeypatch):
    rng = np.random.default_rng(0)
    net = toxicity.Net.begin(np.arange(5, dtype=np.uint64))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = rng.standard_normal((7, toxicity.WORD_DIM + toxicity.CHAR_DIM))
    idx = rng.integers(0, 7, (4, toxicity.WINDOW))
    mask = np.ones(idx.shape)
    mask[1, 9:] = 0
    mask[2, 1:] = 0
    y = np.array([1.0, 0, 1, 0])

    def loss():
        z = toxicity.forward(net, toxicity.project(net, x), idx, mask).astype(np.float64)
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    made = toxicity.forward(net, toxicity.project(net, x), idx, mask, keep=True)
    d = (1 / (1 + np.exp(-made[0])) - y) / 4
    grads, d_x = toxicity.backward(net, x, idx, mask, made, d)
    for name in ("Wf", "Uf", "cf", "Wb", "Ub", "cb", "A", "a", "v", "o", "ob"):
        flat, g = net.p[name].reshape(-1), np.asarray(grads[name], np.float64).reshape(-1)
        for i in rng.integers(0, len(flat), 4):
            old, eps = flat[i], 1e-2
            flat[i] = old + eps
            up = loss()
            flat[i] = old - eps
            down = loss()
            flat[i] = old
            assert abs((up - down) / (2 * eps) - g[i]) < 2e-3 + 0.02 * abs(g[i]), name
    for i, j in zip(rng.integers(0, 7, 6), rng.integers(0, x.shape[1], 6), strict=True):
        old, eps = x[i, j], 1e-2
        x[i, j] = old + eps
        up = loss()
        x[i, j] = old - eps
        down = loss()
        x[i, j] = old
        assert abs((up - down) / (2 * eps) - d_x[i, j]) < 2e-3


def test_indicators_are_distinct_slots():
    (one, two, none) = quality.features(pa.array(["a b a b", "a b", None]))
    assert len(np.unique(one)) == len(one) and len(none) == 0 and len(two) > 0


def test_dual_descent_separates():
    rng = np.random.default_rng(1)
    rows = [np.unique(np.concatenate([rng.integers(0, 500, 20), [1000 + i % 2]])).astype(np.uint32) for i in range(300)]
    labels = np.array([i % 2 for i in range(300)])
    model = quality.fit(rows, labels)
    got = np.array([model.score(r) for r in rows])
    assert ((got > 0.5) == (labels > 0)).mean() > 0.98
