import heapq
import zlib

import numpy as np
import pytest

from flowtables.llm import huffman as H
from flowtables.llm.common import cut_lineage, scratch_path
from llm_cases import documents, no_documents

tokenizers = pytest.importorskip("tokenizers")


def _plain_huffman_cost(counts):
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a + b
        heapq.heappush(heap, a + b)
    return cost


@pytest.mark.parametrize("seed", range(5))
def test_lengths_are_optimal_and_limited(seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 1 << int(rng.integers(2, 30)), 200)
    free = H.code_lengths(counts, 40)
    assert int((free * counts).sum()) == _plain_huffman_cost(counts)
    tight = H.code_lengths(counts, 8)
    used = tight[counts > 0].astype(float)
    assert tight.max() <= 8 and (tight[counts == 0] == 0).all() and (2.0**-used).sum() <= 1


def test_limited_lengths_against_all_choices():
    counts = np.array([1, 1, 2, 50, 90])
    best = min(
        sum(c * n for c, n in zip(counts, ls, strict=True))
        for ls in np.ndindex(*[4] * 5)
        if all(x > 0 for x in ls) and sum(2.0**-x for x in ls) <= 1
    )
    assert int((H.code_lengths(counts, 3) * counts).sum()) == best


@pytest.mark.parametrize("n,size", [(1, 1), (1, 700), (2, 300), (900, 5000)])
def test_bits_round_trip(n, size):
    ids = np.random.default_rng(n).integers(0, n, size).astype(np.uint32)
    lengths = H.code_lengths(np.bincount(ids, minlength=1000))
    payload, at = H.pack_bits(ids, lengths, H.canonical_codes(lengths))
    back = H.unpack_bits(payload, at[::64].astype("<u4"), size, 64, H.decode_table(lengths))
    assert (back == ids).all()


def _ids(text):
    tok = tokenizers.Tokenizer.from_file(__import__("public_tokenizers").path("word_bpe_49k.json"))
    return [*tok.encode(text or "", add_special_tokens=False).ids, 2]


def test_known_chunks_outlive_a_full_cache(monkeypatch):
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    met, encode = [], H.ChunkTokenizer._encode
    monkeypatch.setattr(H.ChunkTokenizer, "_encode", lambda self, c: (met.append(c), encode(self, c))[1])
    tok = H.ChunkTokenizer(path, keep=20)
    texts = ["ofte n", "b c d", "e f g h i j", "k often l", "often É <|endoftext|> É,É ÉTÉ", "m\x85n o\tp q\x1cr often", "s t u v w often x"]
    for text in texts * 2 + [f"often {a}{b}" for a in "xyz" for b in "abcdefghi"]:
        assert np.frombuffer(tok.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(tok.known) + len(tok.known.older) <= 20 + len(text.split())
    assert met.count("often") == 1


def test_files_hold_the_ids_of_the_library(spark):
    pytest.importorskip("public_tokenizers")
    docs = documents(spark)
    path = scratch_path(spark, "huffman-test")
    stored = cut_lineage(H.encode_documents(docs), "ids-test")
    H.write_ids(stored, path, block_ids=1000, step=16)  # documents run over many blocks
    got = sorted(H.read_ids(spark, path, keep_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in docs.collect()), key=lambda x: (x is None, x or 0))
    place = 0
    for r in got:
        raw = bytes(r["ids"])
        assert (r.start, r.n_tokens, r.ids_crc32) == (place, len(raw) // 4, zlib.crc32(raw))
        place += r.n_tokens
    have = sorted((str(r.doc_id), np.frombuffer(bytes(r["ids"]), "<u4").tolist()) for r in got)
    assert have == sorted((str(r.doc_id), _ids(r.text)) for r in docs.collect())


def test_no_documents(spark):
    path = scratch_path(spark, "huffman-test")
    H.write_token_files(no_documents(spark).select("doc_id", "text"), path)
    assert H.read_ids(spark, path).count() == 0


def test_an_id_of_many_rows_spans_files(spark):
    pytest.importorskip("public_tokenizers")
    docs = spark.range(900).selectExpr("IF(id < 600, 7L, id) AS doc_id", "concat('row ', id % 200, ' of many') AS text")
    path = scratch_path(spark, "huffman-test")
    stored = cut_lineage(H.encode_documents(docs), "ids-test")
    H.write_ids(stored, path, files=6, block_ids=300)
    contents = [memoryview(bytes(r.content)) for r in H._files(spark, path).collect()]
    first = [{int(d["id"]) for _, ds, _ in H.parse_file(c) for d in ds} for c in contents]
    assert sum(7 in ids for ids in first) > 1
    for c in contents:
        assert H.count_file(c) == (H.read_header(c)[0], sum(len(ids) for _, _, ids in H.parse_file(c)))
    got = sorted(H.read_ids(spark, path, keep_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in docs.collect())
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]
    have = sorted((r.doc_id, np.frombuffer(bytes(r["ids"]), "<u4").tolist()) for r in got)
    assert have == sorted((r.doc_id, _ids(r.text)) for r in docs.collect())


def test_files_grow_in_number_with_the_coded_bytes(spark, monkeypatch):
    pytest.importorskip("public_tokenizers")
    docs = spark.range(400).selectExpr("id AS doc_id", "repeat(concat('words ', id, ' '), 20) AS text")
    monkeypatch.setattr(H, "FILE_BYTES", 1024)
    path = scratch_path(spark, "huffman-test")
    H.write_token_files(docs, path)
    assert H._files(spark, path).count() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert H.read_ids(spark, path).count() == 400
