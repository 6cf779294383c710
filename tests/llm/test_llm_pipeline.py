import corpus_pipeline as C
from flowtables.llm import decontam, huffman, mixing, ngram_join, toxicity
from flowtables.llm.common import cut_lineage

SF = "/root/testdata/sf0.001"


def test_stages_do_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, names = docs, [n for n, _ in C.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_ids"] and C.ORACLE_SQL is None
    kept = {}
    for name, stage in C.STAGES:
        after = cut_lineage(stage(spark, before, SF), f"test-{name}")
        if name != "token_ids":
            assert after.columns == docs.columns
        kept[name] = (before, after)
        before = after
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    a, b = kept["toxicity"]
    net = toxicity.train(a, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(b) == ids(toxicity.score_toxicity(a, net).filter("score < 0.5")) and b.count() < a.count()
    a, b = kept["near_duplicates"]
    groups = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(a).collect()}
    assert ids(b) == sorted(set(groups.values()))
    a, b = kept["decontamination"]
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    patterns = set().union(*[decontam.windows_of(t) for t in bench])
    clean = [r.doc_id for r in a.collect() if not any(p in b" " + b" ".join(decontam.words_of(r.text)) + b" " for p in patterns)]
    assert ids(b) == sorted(clean)
    a, b = kept["mixing"]
    copies = {r.doc_id: r.copies for r in mixing.mix_plan(a).collect()}
    assert ids(b) == sorted(d for d, c in copies.items() for _ in range(c))
    a, b = kept["token_ids"]
    assert ids(b) == ids(a)
    tok = huffman._tokenizer(None)
    sizes = {r.doc_id: len(tok.ids(r.text)) // 4 + 1 for r in a.collect()}
    place = 0
    for r in sorted(b.collect(), key=lambda r: r.start):
        assert (r.start, r.n_tokens) == (place, sizes[r.doc_id])
        place += r.n_tokens
