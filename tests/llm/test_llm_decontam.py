import re

from flowtables.llm import decontam
from llm_cases import documents, no_documents, rows, sentence

RULE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return RULE.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _brute(text, items):
    w = _words(text)
    hit, who = set(), set()
    for item, t in items:
        iw = _words(t)
        if not iw:
            continue
        n = min(10, len(iw))
        for k in range(len(iw) - n + 1):
            for i in range(len(w) - n + 1):
                if w[i : i + n] == iw[k : k + n]:
                    hit.update(range(i, i + n))
                    who.add(str(item))
    return len(w), len(hit), sorted(who)


def _bench(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, r_items string")


def _items():
    return [
        (1, sentence(1, 12).upper()),
        (2, "one"),
        (3, None),
        (4, "..."),
        (5, sentence(5, 40)),
        (5, sentence(7, 15)),
        (6, "façade 日本語"),
        (17, "aa " * 10),
        (8, sentence(99, 30)),
    ]


def test_against_brute_force(spark):
    docs = documents(spark).filter("doc_id <> 9 OR doc_id IS NULL")
    found = decontam.find_contamination(docs, _bench(spark, _items()))
    assert {"n_words", "n_hit", "items", "spans"} <= set(found.columns) and found.columns.count("n_hit") == 1
    want = sorted(((d, *_brute(t, _items())) for d, t in [(r.doc_id, r.text) for r in docs.collect()]), key=str)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()), key=str)
    assert got == want
    assert any(x[2] for x in want) and any(not x[2] for x in want)


def test_blocks_give_what_one_automaton_gives(spark):
    docs, bench = documents(spark), _bench(spark, _items())
    cols = ("doc_id", "n_words", "n_hit", "items", "spans")
    one = sorted(map(str, decontam.find_contamination(docs, bench).select(*cols).collect()))
    many = sorted(map(str, decontam.find_contamination(docs, bench, block_bytes=150).select(*cols).collect()))
    assert one == many


def test_one_block_at_a_time(spark):
    """Blocks are fetched when asked for, and no plan chains the automata of several blocks."""
    bench = _bench(spark, _items())
    blocks = decontam._blocks(bench, 150)
    assert iter(blocks) is blocks
    assert sorted(i for b in blocks for i, _ in b) == sorted(str(i) for i, t in _items() if t is not None)
    found = decontam.find_contamination(documents(spark), bench, block_bytes=150)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_spans_point_into_the_original(spark):
    docs = spark.createDataFrame([(1, "Ünder —  ONE two, three! four five six seven eight nine ten. Rest")], "doc_id long, text string")
    r = decontam.find_contamination(docs, _bench(spark, [(1, "one two three four five six seven eight nine ten")])).first()
    (span,) = r.spans
    assert r.text[span.start : span.end] == "ONE two, three! four five six seven eight nine ten"
    assert (span.first_word, span.last_word, r.n_hit, r.n_words) == (2, 11, 10, 13)  # the dash is a word by the rule


def test_removal_keeps_columns_and_clean_rows(spark):
    docs = documents(spark)
    kept = decontam.remove_contaminated(docs, _bench(spark, [(1, sentence(1, 30))]))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in docs.collect() if r.doc_id not in (0, 1, 2))


def test_empty_tables(spark):
    assert rows(decontam.find_contamination(no_documents(spark), _bench(spark, [(1, "a b")])), "doc_id") == []
    none = decontam.find_contamination(documents(spark), _bench(spark, []))
    assert {r.n_hit for r in none.collect()} == {0}


def test_null_item_ids(spark):
    """All rows with a null id are one item, whose id is the empty text."""
    docs = spark.createDataFrame([(1, "x a b c y"), (2, "d e f"), (3, "a b c d e f")], "doc_id long, text string")
    items = [(None, "a b c"), ("x", "a b c"), (None, "d e f"), (None, None)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    for size in (4 << 20, 4):
        found = decontam.find_contamination(docs, bench, block_bytes=size).select("doc_id", "n_hit", "items").collect()
        assert sorted((r.doc_id, r.n_hit, list(r["items"])) for r in found) == [(1, 3, ["", "x"]), (2, 3, [""]), (3, 6, ["", "x"])]
