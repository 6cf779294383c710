"""Words of many texts at once, as numpy arrays over the Arrow text buffer.

A chunk of texts is one byte array.  Word borders come from a 256-entry class
table (every word rule used here only names ASCII characters, so it can be
applied to UTF-8 bytes), and word hashes from one cumulative sum of a
polynomial hash over the whole chunk.  Nothing is done per word in Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
#: Texts are scanned in chunks of about so many bytes (a longer text is a chunk of its own).
CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over all output bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _byte_values() -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64((np.arange(256, dtype=U) + U(1)) * U(0xD6E8FEB86659FD93))


def _lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = _lower_table()
BYTE_VALUE = _byte_values()


def space_separated() -> np.ndarray:
    """Word bytes of ``[^\\x20\\x09-\\x0D]+``."""
    t = np.ones(256, dtype=bool)
    t[0x20] = False
    t[0x09:0x0E] = False
    return t


def alphanumeric() -> np.ndarray:
    """Word bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    t = np.zeros(256, dtype=bool)
    t[0x30:0x3A] = True
    t[0x41:0x5B] = True  # lower-cased before the rule applies
    t[0x61:0x7B] = True
    t[0x80:] = True
    return t


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=U)
        self.down = np.ones(1, dtype=U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(12, (n - 1).bit_length())
            inv = pow(_BASE, -1, 1 << 64)
            self.up = self._run(_BASE, size)
            self.down = self._run(inv, size)
        return self.up[:n], self.down[:n]

    @staticmethod
    def _run(base: int, n: int) -> np.ndarray:
        out = np.full(n, U(base), dtype=U)
        out[0] = U(1)
        with np.errstate(over="ignore"):
            return np.multiply.accumulate(out)


POWERS = _Powers()


@dataclass
class Words:
    """Words of the ``n`` texts of a chunk, in order."""

    data: np.ndarray  #: the chunk's bytes, lower-cased when asked for
    text_at: np.ndarray  #: n + 1 byte offsets of the texts
    start: np.ndarray  #: byte offset of each word
    end: np.ndarray
    hash: np.ndarray  #: uint64 per word
    at: np.ndarray  #: n + 1 word offsets of the texts

    @property
    def n(self) -> int:
        return len(self.text_at) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.at)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.counts())


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, n + 1 offsets)`` of a string array; nulls are empty texts."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("" if not pa.types.is_binary(arr.type) else b"")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    offs = np.frombuffer(arr.buffers()[1], np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offs[0] : offs[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def chunks(arr: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut an array of texts into ``(first, last + 1, bytes, offsets)`` of about ``limit`` bytes."""
    data, offs = text_buffer(arr)
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def scan(data: np.ndarray, offs: np.ndarray, word_bytes: np.ndarray, lower: bool = True, hashed: bool = True) -> Words:
    """Find and hash the words of one chunk."""
    n = len(data)
    if lower:
        data = LOWER[data]
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = word_bytes[data]
    begin = inside[1:] & ~inside[:-1]  # n + 1 entries
    stop = inside[:-1] & ~inside[1:]  # stop[i]: a word ends before byte i
    inner = offs[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    cut = inner[inside[inner] & inside[inner + 1]]  # borders of texts inside a run of word bytes
    begin[cut] = True
    stop[cut] = True
    start, end = np.flatnonzero(begin), np.flatnonzero(stop)
    if hashed:
        with np.errstate(over="ignore"):
            up, down = POWERS.upto(n + 1)
            total = np.zeros(n + 1, dtype=U)
            np.cumsum(BYTE_VALUE[data] * up[:n], out=total[1:])
            h = mix64((total[end] - total[start]) * down[start] + (end - start).astype(U))
    else:
        h = np.zeros(0, dtype=U)
    return Words(data, offs, start, end, h, np.searchsorted(start, offs))


def shingle_hashes(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, n + 1 offsets)`` of the k-word shingles of each text, in order
    and with repeats; a text with 1 to k - 1 words gives one, of all its words."""
    counts = w.counts()
    per = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    at = np.concatenate([[0], np.cumsum(per)])
    out = np.zeros(at[-1], dtype=U)
    if not len(out):
        return out, at
    text = np.repeat(np.arange(w.n), per)
    first = np.arange(at[-1]) - at[text] + w.at[text]
    with np.errstate(over="ignore"):
        last = len(w.hash) - 1
        for j in range(k):
            here = w.hash[np.minimum(first + j, last)] * U((_BASE * (2 * j + 3) | 1) & 0xFFFFFFFFFFFFFFFF)
            short = counts[text] <= j
            out += np.where(short, U(0), here)
        out = mix64(out + counts.clip(max=k)[text].astype(U))
    return out, at
