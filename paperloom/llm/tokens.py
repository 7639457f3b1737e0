"""Words, shingles and their 64-bit hashes for whole Arrow batches at once.

A word is a run of bytes other than space and U+0009-U+000D with A-Z in lower case; since UTF-8 keeps those bytes for
those characters, work on bytes gives what work on characters would. Two words get the same hash if they are equal, and
different ones with probability about 2**-64 each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer document is worked on alone.
CHUNK_BYTES = 1 << 20
CHUNK_ROWS = 1 << 12

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
#: Bytes that are part of a word without its punctuation: letters, digits and what is beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

#: Kinds of bytes: 1 words without punctuation, 2 punctuation.
WORD_OR_MARK = np.where(SPACE, 0, np.where(ALNUM, 1, 2)).astype(np.uint8)

_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(256)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values under which all bits of the result depend on all bits of ``h``."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def chain(h: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """The hash of a sequence from that of its head and its next element."""
    return mix(h * np.uint64(0xD6E8FEB86659FD93) + nxt)


@dataclass
class Words:
    """Words of consecutive rows: of row r those from ``first[r]`` to ``first[r + 1]``."""

    rows: slice
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def n_rows(self) -> int:
        return len(self.first) - 1

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_rows), np.diff(self.first))


def pieces(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Rows of ``texts`` (null: empty) in turn, some at a time: their bytes and the offsets of each row in them."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offs = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8) if len(texts) else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = min(max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1), at + CHUNK_ROWS)
        yield slice(at, to), data[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
        at = to


def words(texts: pa.Array, limit: int = CHUNK_BYTES, part: np.ndarray | None = None, hashed: bool = True) -> Iterator[Words]:
    """The words of ``texts``: runs of bytes of one kind, by ``part`` (0: none), or all but white space."""
    kind_of = ~SPACE if part is None else part
    for rows, data, offs in pieces(texts, limit):
        kind = kind_of[data]
        inside = kind > 0
        edge = np.zeros(len(data) + 1, bool)
        edge[offs] = True
        differs = (kind[1:] != kind[:-1]) | edge[1:-1]
        begin, last = inside.copy(), inside.copy()
        begin[1:] &= differs
        last[:-1] &= differs
        start, end = np.flatnonzero(begin), np.flatnonzero(last) + 1
        yield Words(rows, data, start, end, np.searchsorted(start, offs), hashes(data, inside, start, end) if hashed else start)


def hashes(data: np.ndarray, inside: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    at = np.cumsum(size) - size
    used = LOWER[data[inside]]
    place = np.arange(len(used)) - np.repeat(at, size)
    power = _POWERS if size.max() <= len(_POWERS) else _powers(int(size.max()))
    return mix(np.add.reduceat(_BYTE[used] * power[place], at) + size.astype(np.uint64))


def shingles(w: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, with the row of each; a row of 1 to k - 1 words is one shingle, an empty row none."""
    count = np.diff(w.first)
    row = w.row_of()
    n = len(w.hash)
    h = np.full(max(0, n - k + 1), k, np.uint64)
    for j in range(k):
        h = chain(h, w.hash[j : n - k + 1 + j])
    whole = row[: len(h)] == row[k - 1 :] if n >= k else np.zeros(0, bool)
    h, at = h[whole], row[: len(whole)][whole]
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        s = count[short].astype(np.uint64)
        for j in range(k - 1):
            more = count[short] > j
            s = np.where(more, chain(s, w.hash[np.minimum(w.first[short] + j, n - 1)]), s)
        h, at = np.concatenate([h, s]), np.concatenate([at, short])
        order = np.argsort(at, kind="stable")
        h, at = h[order], at[order]
    return h, at


#: Bits of a shingle's hash in sets; the other 12 hold the row within a chunk while a chunk is sorted.
SET_BITS = 52


def shingle_sets(w: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The set of shingles of each row, as 52-bit hashes: all of them by row and value, and where each row begins."""
    h, row = shingles(w, k)
    key = np.sort((row.astype(np.uint64) << np.uint64(SET_BITS)) | (h >> np.uint64(64 - SET_BITS)))
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    first = np.searchsorted(key >> np.uint64(SET_BITS), np.arange(w.n_rows + 1))
    return key & np.uint64((1 << SET_BITS) - 1), first


def string_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
