"""Token ids in length-limited canonical Huffman files.

``encode_documents`` tokenizes every text once and stores the ids;
``write_ids`` counts all ids, builds one canonical code whose words are at
most ``MAX_BITS`` long, and writes the documents in ascending id order as
independent blocks; ``read_ids`` decodes the files again with a lookup table.

File format (little-endian; one file per range of document ids):

* file header: ``HUFI``, version u32, file number u32, longest code u32,
  symbols u32, packed bytes u32, then the zlib-packed code length (u8) of each id;
* blocks: ``BLCK``, documents u32, ids u32, ids between checkpoints u32,
  checkpoints u32, payload bytes u32; per document: id i64, null flag u8,
  continues-the-last-document flag u8, ids in this block u32; per checkpoint
  its bit offset u32; the payload, most significant bit first, padded by 8 bytes;
* after the header and after each block the separator ``SEPARATOR``.

A block needs nothing but the header's code lengths, and its checkpoints let
all runs between them be decoded side by side, one table lookup per id.

The files are written by Spark's text writer (which passes bytes through), so
they go to any file system Spark knows, with task commit and retries.

Defined cases: a null text is empty; an empty text is the end id alone; null
document ids come last; rows that repeat an id are all kept, in the order of a
hash of their token ids (a hot id may span files); an empty table gives no file; extra columns are not stored.
"""

from __future__ import annotations

import re
import struct
import zlib
from codecs import charmap_decode
from collections.abc import Callable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..session import remove_folder
from .common import WORKER_CACHES, arrow_map, read_table, scratch_path, ship_package, sum_vectors, vector_rows

END_ID = 2
VOCABULARY = 49408
MAX_BITS = 16
BLOCK_IDS = 1 << 19
CHECKPOINT_IDS = 256
SEPARATOR = "\n~~\n"
#: Code words a file holds, about: a file is read as one value, and Spark's limit for that is 2 GB.
FILE_BYTES = 64 << 20
#: Known chunks a worker keeps (of at most ``CACHE_BYTES`` each): half of them the newer ones, half older ones not met since.
CACHE_CHUNKS = 700_000
CACHE_BYTES = 64

# --- tokenizing ---------------------------------------------------------

_STATE: dict = {}
WORKER_CACHES[__name__] = _STATE.clear


def _byte_letters() -> str:
    """Byte-level models write a byte as a visible character: itself where it
    is one, and otherwise the next of the characters from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return "".join(chr(b if b in visible else 0x100 + hidden.index(b)) for b in range(256))


BYTE_LETTERS = _byte_letters()


#: Packs so many ids (more are rare).
_IDS = [struct.Struct(f"<{n}I").pack for n in range(16)]


class _Chunks(dict):
    """Ids by chunk; a chunk that is not there is encoded when it is looked up.

    ``renew`` makes the chunks so far the older half; those met again come back."""

    def __init__(self, encode: Callable[[str], bytes]) -> None:
        super().__init__({"": b""})
        self.encode, self.older = encode, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.encode(chunk)
        if len(chunk) <= CACHE_BYTES:
            self[chunk] = ids
        return ids

    def renew(self) -> None:
        self.older = dict(self)
        self.clear()


class ChunkTokenizer:
    """The library's ids of a text, put together from those of its chunks.

    The tokenizer drops white space and never joins characters across it, so a
    text's ids are those of its white-space separated chunks one after the
    other (and ASCII case is lowered by it anyway).  Signs never share a piece
    with letters or digits, so a chunk may also be cut where an ASCII sign
    follows a letter or digit (but for the apostrophe, which some pieces begin
    with).  Chunks repeat, so most are looked up; they are held as strings of
    their UTF-8 bytes, which dictionaries find faster than bytes.
    """

    #: Signs after an ASCII letter or digit, or after a letter of U+00C0 to U+00FF.
    _SIGNS = re.compile(rb"[!-&(-/:-@\[-`{-~](?:(?<=[a-z0-9].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))")
    #: Chunks of letters up to U+00FF, some beyond ASCII: normalising does no more than lower them, and they are one piece.
    _LETTERS = re.compile("[a-z]*(?:\xc3[\x80-\x96\x98-\xb6\xb8-\xbf][a-z]*)+")
    #: White space of ASCII as blanks, without and with its letters lowered.
    _BLANKS = bytes.maketrans(b"\t\n\v\f\r", b" " * 5)
    _LOWER = bytes(range(256)).lower().translate(_BLANKS)

    def __init__(self, path: str, keep: int = CACHE_CHUNKS) -> None:
        from tokenizers import Tokenizer

        self.keep = keep

        self.tok = Tokenizer.from_file(path)
        self.piece = self.tok.model.tokenize
        self.known = _Chunks(self._encode)

    def ids(self, text: str | None) -> bytes:
        """uint32 ids, little-endian."""
        if not text:
            return b""
        raw = text.encode("utf-8", "surrogatepass")
        # A special token's text must stay whole, and matters by case.
        raw = raw.translate(self._BLANKS) if b"<|" in raw else self._SIGNS.sub(rb" \g<0>", raw.translate(self._LOWER))
        chunks = raw.decode("latin-1").split(" ")
        out = b"".join(itemgetter("", *chunks)(self.known))
        if len(self.known) > self.keep // 2:
            self.known.renew()
        return out

    def _encode(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha() and chunk.islower():
            ids = [t.id for t in self.piece(chunk)]
        elif self._LETTERS.fullmatch(chunk):
            low = chunk.encode("latin-1").decode().lower().encode()
            ids = [t.id for t in self.piece(charmap_decode(low, "strict", BYTE_LETTERS)[0])]
        else:
            ids = self.tok.encode(chunk.encode("latin-1").decode("utf-8", "replace"), add_special_tokens=False).ids
        return _IDS[len(ids)](*ids) if len(ids) < len(_IDS) else struct.pack(f"<{len(ids)}I", *ids)


def _tokenizer(path: str | None) -> ChunkTokenizer:
    if path not in _STATE:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if path is None:
            import public_tokenizers

            place = public_tokenizers.path("word_bpe_49k.json")
        else:
            place = path
        _STATE[path] = ChunkTokenizer(place)
    return _STATE[path]


def encode_documents(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, vocabulary: int = VOCABULARY, keep_chunks: int = CACHE_CHUNKS
) -> DataFrame:
    """``(doc_id, n, ids, slice, v)``: per document the ids of its whole text and
    the end id, as zstandard-packed bytes; and per task, in rows of their own
    (``slice`` not null), how often it met each id.

    ``tokenizer`` is the file on the executors (None: ``word_bpe_49k.json`` of
    the installed public tokenizers); all ids are below ``vocabulary``;
    ``keep_chunks`` known chunks take about 0.3 KB each in a worker.
    """
    end = struct.pack("<I", end_id)
    schema = "doc_id long, n long, ids binary, slice int, v binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        tok, pack = _tokenizer(tokenizer), zstandard.ZstdCompressor(level=1).compress
        tok.keep = keep_chunks
        total = np.zeros(vocabulary, np.int64)
        names = ["doc_id", "n", "ids", "slice", "v"]
        for b in batches:
            n, packed, held = [], [], []
            for text in b.column(1).to_pylist():
                ids = tok.ids(text) + end
                n.append(len(ids) // 4)
                a = np.frombuffer(ids, "<u4")
                held.append(a)
                packed.append(pack(a.astype("<u2").tobytes() if vocabulary <= 65536 else b"\0" + ids))
            if held:
                total += np.bincount(np.concatenate(held), minlength=vocabulary)
            nothing = [pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(packed, pa.binary()), *nothing], names)
        counts = vector_rows(total)
        rows = counts.num_rows
        none = [pa.nulls(rows, t) for t in (pa.int64(), pa.int64(), pa.binary())]
        yield pa.RecordBatch.from_arrays([*none, *counts.columns], names)

    inner = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(inner, run, schema)


def unpack_ids(packed: bytes) -> np.ndarray:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(packed)
    return np.frombuffer(raw, "<u2").astype(np.uint32) if len(raw) % 2 == 0 else np.frombuffer(raw[1:], "<u4")


# --- the code -----------------------------------------------------------


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` (package-merge); 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n == 0:
        return out
    if n == 1:
        out[used] = 1
        return out
    max_bits = max(max_bits, int(n - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, row = [], leaves
    flags = np.ones(n, bool)
    for _ in range(max_bits):
        levels.append(flags)
        packages = row[: len(row) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, packages])
        is_leaf = np.concatenate([np.ones(n, bool), np.zeros(len(packages), bool)])
        by = np.argsort(both, kind="stable")
        row, flags = both[by], is_leaf[by]
    take = 2 * n - 2
    for flags in reversed(levels):
        chosen = int(flags[:take].sum())
        out[order[:chosen]] += 1
        take = 2 * (min(take, len(flags)) - chosen)
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id), uint32, right-aligned."""
    codes = np.zeros(len(lengths), np.uint32)
    code = 0
    for bits in range(1, int(lengths.max(initial=0)) + 1):
        ids = np.flatnonzero(lengths == bits)
        codes[ids] = code + np.arange(len(ids), dtype=np.uint32)
        code = (code + len(ids)) << 1
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """``(id, length, longest)``: entries for every word of ``longest`` bits."""
    longest = int(lengths.max(initial=1))
    ids = np.flatnonzero(lengths)
    ids = ids[np.argsort(lengths[ids], kind="stable")]
    spans = 1 << (longest - lengths[ids].astype(np.int64))
    symbol, bits = np.repeat(ids.astype(np.uint32), spans), np.repeat(lengths[ids], spans)
    pad = (1 << longest) - len(symbol)  # only with a single id
    return np.pad(symbol, (0, pad), mode="edge"), np.pad(bits, (0, pad), mode="edge"), longest


def pack_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """``(payload, bit offset of each id)``."""
    bits = lengths[ids].astype(np.int64)
    at = np.cumsum(bits)
    total = int(at[-1])
    at -= bits
    byte, shift = at >> 3, at & 7
    spread = (int(lengths.max()) + 14) // 8  # bytes that a code can touch
    word = codes[ids].astype(np.uint64) << (8 * spread - bits - shift).astype(np.uint64)
    size = (total + 7) // 8 + 8
    out = np.zeros(size, np.uint8)
    for i in range(spread):
        part = (word >> np.uint64(8 * (spread - 1 - i))).astype(np.uint8)
        out += np.bincount(byte + i, weights=part, minlength=size).astype(np.uint8)[:size]  # bits do not overlap
    return out.tobytes(), at


def unpack_bits(payload: bytes, marks: np.ndarray, n: int, step: int, table) -> np.ndarray:
    """The ``n`` ids of a block; all runs between checkpoints advance together."""
    symbol, bits, longest = table
    data = np.frombuffer(payload, np.uint8)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    # One 32-bit window per byte position.
    w = padded.astype(np.uint64)
    window = (w[:-4] << np.uint64(32)) | (w[1:-3] << np.uint64(24)) | (w[2:-2] << np.uint64(16)) | (w[3:-1] << np.uint64(8)) | w[4:]
    out = np.zeros((step, len(marks)), np.uint32)
    at = marks.astype(np.int64)
    last = len(window) - 1
    mask, base = np.uint64((1 << longest) - 1), 40 - longest
    for i in range(min(step, n)):
        word = window[np.minimum(at >> 3, last)]
        code = (word >> (base - (at & 7)).astype(np.uint64)) & mask
        out[i] = symbol[code]
        at = at + bits[code]
    return out.T.reshape(-1)[:n]


# --- files --------------------------------------------------------------

_HEAD, _BLOCK = struct.Struct("<4sIIIII"), struct.Struct("<4sIIIII")
_DOC = np.dtype([("id", "<i8"), ("null", "u1"), ("more", "u1"), ("n", "<u4")])


def file_header(part: int, lengths: np.ndarray) -> bytes:
    packed = zlib.compress(lengths.tobytes(), 9)
    return _HEAD.pack(b"HUFI", 1, part, int(lengths.max(initial=1)), len(lengths), len(packed)) + packed


def pack_block(docs: list[tuple[int | None, bool, int]], ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, step: int) -> bytes:
    payload, at = pack_bits(ids, lengths, codes)
    marks = at[::step].astype("<u4")
    table = np.array([(d or 0, d is None, more, n) for d, more, n in docs], _DOC)
    return _BLOCK.pack(b"BLCK", len(docs), len(ids), step, len(marks), len(payload)) + table.tobytes() + marks.tobytes() + payload


def read_header(raw: memoryview) -> tuple[int, int, int]:
    """``(file number, where the packed code lengths begin, where they end)``."""
    magic, version, part, _, _, packed = _HEAD.unpack_from(raw, 0)
    if magic != b"HUFI" or version != 1:
        raise ValueError("not a Huffman id file")
    return part, _HEAD.size, _HEAD.size + packed


def block_places(raw: memoryview, begin: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """``(place, documents, ids, step, checkpoints, payload bytes)`` of each
    block, from the block headers alone."""
    p = begin
    while p < len(raw):
        magic, n_docs, n, step, n_marks, size = _BLOCK.unpack_from(raw, p)
        if magic != b"BLCK":
            raise ValueError("damaged Huffman id file")
        yield p, n_docs, n, step, n_marks, size
        p += _BLOCK.size + n_docs * _DOC.itemsize + 4 * n_marks + size + len(SEPARATOR)


def parse_file(raw: memoryview) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(file number, documents, ids)`` of each block."""
    part, at, end = read_header(raw)
    table = decode_table(np.frombuffer(zlib.decompress(raw[at:end]), np.uint8))
    for p, n_docs, n, step, n_marks, size in block_places(raw, end + len(SEPARATOR)):
        p += _BLOCK.size
        docs = np.frombuffer(raw, _DOC, n_docs, p)
        p += docs.nbytes
        marks = np.frombuffer(raw, "<u4", n_marks, p)
        p += marks.nbytes
        yield part, docs, unpack_bits(raw[p : p + size], marks, n, step, table)


def count_file(raw: memoryview) -> tuple[int, int]:
    """``(file number, ids)`` of a file, without decoding it."""
    part, _, end = read_header(raw)
    return part, sum(n for _, _, n, _, _, _ in block_places(raw, end + len(SEPARATOR)))


def count_ids(encoded: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs, over all documents: the sum of what the tasks counted."""
    return sum_vectors(encoded.filter("slice IS NOT NULL").select("slice", "v"), vocabulary)


def coded_bytes(counts: np.ndarray, lengths: np.ndarray) -> int:
    """Bytes of all ids' code words."""
    return int((counts * lengths.astype(np.int64)).sum() + 7) // 8


def write_ids(encoded: DataFrame, path: str, vocabulary: int = VOCABULARY, files: int | None = None, max_bits: int = MAX_BITS, block_ids: int = BLOCK_IDS, step: int = CHECKPOINT_IDS) -> None:
    """Write what ``encode_documents`` made below ``path``; ``encoded`` is read twice, so it should be stored."""
    spark = encoded.sparkSession
    counts = count_ids(encoded, vocabulary)
    lengths = code_lengths(counts, max_bits)
    shipped = spark.sparkContext.broadcast(lengths)  # one byte per id of the vocabulary
    files = files or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-coded_bytes(counts, lengths) // FILE_BYTES))
    # Rows that repeat an id (or have none) are ordered by their ids' hash and split over files by it too;
    # the stored row's place parts what is wholly equal, and is the same whenever a task runs again.
    by = ["last", "doc_id", "hash", "place"]
    ranged = (
        encoded.withColumn("place", F.monotonically_increasing_id())
        .filter("slice IS NULL")
        .select("doc_id", "ids", F.col("doc_id").isNull().alias("last"), F.xxhash64("ids").alias("hash"), "place")
        .repartitionByRange(files, *by)
        .sortWithinPartitions(*by)
        .select(F.spark_partition_id().alias("part"), "doc_id", "ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = shipped.value
        codes = canonical_codes(lengths)
        begun, docs, parts, held = False, [], [], 0
        for b in batches:
            for part, doc, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if not begun:
                    begun = True
                    yield _one(file_header(part, lengths))
                ids, more = unpack_ids(packed.as_py()), False
                while len(ids):
                    now = ids[: block_ids - held]
                    docs.append((doc, more, len(now)))
                    parts.append(now)
                    held, ids, more = held + len(now), ids[len(now) :], True
                    if held >= block_ids:
                        yield _one(pack_block(docs, np.concatenate(parts), lengths, codes, step))
                        docs, parts, held = [], [], 0
        if held:
            yield _one(pack_block(docs, np.concatenate(parts), lengths, codes, step))

    blocks = arrow_map(ranged, run, "value binary")
    blocks.select(F.col("value").cast("string").alias("value")).write.mode("overwrite").option("lineSep", SEPARATOR).text(path)


def _one(value: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([value], pa.binary())], ["value"])


def _files(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 0").select("content")
    except AnalysisException:
        return spark.range(0).select(F.lit(None).cast("binary").alias("content"))


def read_ids(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32[, ids])`` per document, decoded from
    the files; ``ids`` are little-endian u32 bytes."""
    schema = "part int, place long, doc_id long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = []
        for b in batches:
            for content in b.column(0):
                place = 0
                for part, docs, ids in parse_file(memoryview(content.as_buffer())):
                    at = 0
                    flat = ids.astype("<u4")
                    for d in docs:
                        n = int(d["n"])
                        raw = flat[at : at + n].tobytes()
                        if d["more"]:
                            rows[-1][3] += n
                            rows[-1][4] = zlib.crc32(raw, rows[-1][4])
                            rows[-1][5].append(raw) if keep_ids else None
                        else:
                            if len(rows) >= 4096:
                                yield _rows(rows, keep_ids)
                                rows = []
                            rows.append([part, place, None if d["null"] else int(d["id"]), n, zlib.crc32(raw), [raw] if keep_ids else None])
                        at += n
                        place += n
        if rows:
            yield _rows(rows, keep_ids)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counted = [count_file(memoryview(content.as_buffer())) for content in b.column(0)]
            parts, n = zip(*counted, strict=True) if counted else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(n, pa.int64())], ["part", "n"])

    found = arrow_map(_files(spark, path), run, schema)
    # One row per file, from its block headers: where its first document starts.
    totals = arrow_map(_files(spark, path), count, "part int, n long")
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select(F.col("part").alias("p"), F.coalesce(before, F.lit(0)).alias("begin"))
    cols = ["doc_id", (F.col("begin") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"] + ["ids"] * keep_ids
    return found.join(starts, F.col("part") == F.col("p")).select(*cols)


def _rows(rows: list[list], keep_ids: bool) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
    names = ["part", "place", "doc_id", "n_tokens", "ids_crc32"]
    if keep_ids:
        arrays.append(pa.array([b"".join(x) for x in cols[5]], pa.binary()))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names)


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, keep_chunks: int = CACHE_CHUNKS) -> None:
    """Tokenize ``docs(doc_id, text)`` and write the id files below ``path``."""
    spark = docs.sparkSession
    ship_package(spark)
    stored = scratch_path(spark, "ids")
    encode_documents(docs, tokenizer, keep_chunks=keep_chunks).write.option("compression", "uncompressed").parquet(stored)
    write_ids(spark.read.parquet(stored), path)
    remove_folder(spark, stored)


def op3_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "huffman")
    write_token_files(read_table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return read_ids(spark, path)
