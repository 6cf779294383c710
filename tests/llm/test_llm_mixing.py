import contextlib
import io

from flowtables.llm import mixing
from llm_cases import documents, no_documents, sentence


def _targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, left, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if most * sizes[s] <= level * w[s]}
        if not full:
            return out | {s: level * w[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def _many(spark, n=3000):
    rows = [(i, sentence(i, 5 + i % 40), None if i % 11 == 0 else f"s{min(i % 7, i % 3)}", i) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")


def _copies(r):
    """Of all rows that a plan row stands for."""
    return r["rows"] * r["base"] + r["up"]


def _check(plan):
    sizes, taken, largest, target = {}, {}, {}, {}
    for r in plan:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"] * r["rows"]
        taken[r.source] = taken.get(r.source, 0) + r["size"] * _copies(r)
        largest[r.source] = max(largest.get(r.source, 0), r["size"])  # one document, however often it is repeated
        target[r.source] = r.target
        assert 0 <= r["up"] <= r["rows"] and 0 <= _copies(r) <= 2 * r["rows"]
    want = _targets(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6
    return taken


def test_targets_and_sums(spark):
    plan = mixing.mix_plan(_many(spark)).collect()
    assert len(plan) == 3000
    _check(plan)


def test_reruns_agree_and_seeds_differ(spark):
    docs = _many(spark, 600)
    once = sorted(map(str, mixing.mix_plan(docs).collect()))
    assert once == sorted(map(str, mixing.mix_plan(docs.repartition(7)).collect()))
    assert once != sorted(map(str, mixing.mix_plan(docs, seed=99).collect()))


def test_large_and_small_documents_have_the_same_chance(spark):
    docs = spark.createDataFrame([(i, "a " * (1 + 9 * (i % 2)), "x") for i in range(800)], "doc_id long, text string, source string")
    seen = [[], []]
    for seed in (1, 2, 3):
        for r in mixing.mix_plan(docs, share=0.4, weights=(1,), seed=seed).collect():
            seen[r.doc_id % 2].append(_copies(r))
    for x in seen:
        assert abs(sum(x) / len(x) - 0.4) < 0.07


def test_edge_rows(spark):
    docs = documents(spark)
    plan = mixing.mix_plan(docs).collect()
    assert sum(r["rows"] for r in plan) == docs.count()
    _check(plan)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    copies = {(r.source, r.doc_id, r["size"]): _copies(r) for r in plan}
    got = {}
    for r in mixed.collect():
        key = (r.source, r.doc_id, len((r.text or "").encode().split()))
        got[key] = got.get(key, 0) + 1
    assert got == {k: c for k, c in copies.items() if c}


def test_nothing_to_mix(spark):
    assert mixing.mix_plan(no_documents(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert {_copies(r) for r in mixing.mix_plan(blank).collect()} == {1}


def test_targets_are_met_with_repeated_and_null_ids(spark):
    """The error stays below one document, even if one id (or none) has most rows of a source."""
    text = "w " * 100
    data = [(i, text, "a") for i in range(200)] + [(900, text, "a")] * 300 + [(None, text + f"n{i}", "b") for i in range(300)]
    data += [(1000 + i, text, "c") for i in range(250)] + [(5, text, "d")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(4)
    plan = mixing.mix_plan(docs).collect()
    taken = _check(plan)
    words = {}
    seen = {}
    for r in mixing.mix(docs).collect():
        words[r.source] = words.get(r.source, 0) + len(r.text.split())
        seen[r.source, r.doc_id, r.text] = seen.get((r.source, r.doc_id, r.text), 0) + 1
    assert words == {k: v for k, v in taken.items() if v}
    # Rows without an id differ in their copies by at most one.
    counts = [seen.get(("b", None, text + f"n{i}"), 0) for i in range(300)]
    assert max(counts) - min(counts) <= 1 and max(counts) <= 2


def test_plan_is_native(spark):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        mixing.mix_plan(_many(spark, 100)).explain("formatted")
    assert not any(x in out.getvalue() for x in ("Python", "Pandas", "Arrow"))
