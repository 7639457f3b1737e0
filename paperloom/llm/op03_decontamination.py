"""Benchmark decontamination by SimHash fingerprints of item-sized windows.

Words are runs of letters and digits in lower case. Every benchmark item gets a size class: the largest window of c words
of which one stays whole in any copy that reaches the threshold, however its edits lie. All windows of c words of the item
are fingerprinted, and so are the windows of each document, at every word, that touch a shingle of an item; the others
cannot be similar to any. A fingerprint has 64 bits in eight blocks of eight: two fingerprints within a Hamming distance
of ``RADIUS`` = 7 agree in a block, so looking all eight blocks up finds every pair within it, and so every similar copy.
For each pair of document and item found so, all item-sized windows of the document are compared with the item exactly:
the weight of the item's 5-word shingles that occur there over the weight of all of them, a shingle weighing 1 over the
number of items that contain it. From ``THRESHOLD`` on the document is contaminated by the item.

The benchmark is the stated query set: it is taken in blocks of ``BLOCK`` items (about 1 MB of fingerprints each), and
every document is held against every block in place, without a shuffle or join.

Defined cases: null and empty texts, and items without words, are never contaminated and never contaminate; an item of
fewer than five words is one shingle; repeated rows get the same result; an empty table of either kind gives no hits;
item_id may be of any type; columns of the input other than doc_id and text pass through ``decontaminated`` and are ignored by ``contamination``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from .tokens import ALNUM, Words, chain, shingles, string_column, words

RADIUS = 7
#: (lowest bit, bits) of each block; one more than the radius.
BLOCKS = tuple((8 * b, 8) for b in range(8))
THRESHOLD = 0.8
#: Items that are looked up at once.
BLOCK = 2000
SHINGLE = 5
#: Bits of a shingle's hash that tell at once of most runs of words that they are in no item.
MAYBE_BITS = 20
#: Columns that are added last while documents are looked through.
ITEMS, SIMILARITY = "__benchmark_items", "__benchmark_similarity"


def plain_words(texts: pa.Array) -> Iterator[Words]:
    """Words in lower case without punctuation, so that shouted or decorated copies match too."""
    return words(pc.utf8_lower(texts), part=ALNUM)


def size_classes(most: int) -> list[int]:
    """Window sizes up to ``most``: 1 to 4, then each about half as large again."""
    out = [1, 2, 3, 4]
    while out[-1] <= most:
        out.append(out[-1] * 3 // 2)
    return out


def breaking(weight: np.ndarray, run: int) -> float:
    """The least weight of shingles that must go for no ``run`` of them in turn to be left; an edit inside takes four or more."""
    m, most = len(weight), SHINGLE - 1
    if run > m:
        return 0.0
    total = np.concatenate([[0.0], np.cumsum(weight)])
    best = np.zeros(m)  # with the last gap ending here

    def until(first: int) -> float:
        """The least weight before a gap that begins at ``first``."""
        return 0.0 if first < run else float(best[first - run : first].min())

    for i in range(m):
        first = max(0, i + 1 - most)
        best[i] = total[i + 1] - total[first] + until(first)
        if i:
            best[i] = min(best[i], best[i - 1] + weight[i])
    return min(float(best[m - run :].min()), *(total[m] - total[s] + until(s) for s in range(max(0, m + 1 - most), m)))


def class_of(n_words: int, weight: np.ndarray) -> int:
    """The class of an item whose shingles in turn have these weights: so many words stay together in any similar copy."""
    if n_words < SHINGLE:
        return n_words
    most = (1 - THRESHOLD) * weight.sum() + 1e-9
    return next((c for c in reversed(size_classes(n_words)) if c >= SHINGLE and breaking(weight, c + 1 - SHINGLE) > most), SHINGLE - 1)


def prefix_counts(h: np.ndarray) -> np.ndarray:
    """Row b, place i: how many of the first i hashes have bit b, modulo 2**16."""
    bits = np.unpackbits(h.view(np.uint8).reshape(len(h), 8), axis=1)
    out = np.zeros((64, len(h) + 1), np.int16)
    np.cumsum(bits.T, axis=1, dtype=np.int16, out=out[:, 1:])
    return out


def fingerprints(counts: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """A number for each window of ``size`` words: a bit is set if over half of the words have it."""
    if size < 1 << 14:
        set_bits = (counts[:, start + size] - counts[:, start]) > size // 2
    else:  # beyond the modulus: windows of their own
        set_bits = np.stack([(counts[:, s + 1 : s + size + 1] - counts[:, s : s + size] != 0).sum(axis=1) > size // 2 for s in start], axis=1)
    return np.ascontiguousarray(np.packbits(set_bits, axis=0).T).view(np.uint64).ravel()


def block_of(prints: np.ndarray, low: int, width: int) -> np.ndarray:
    return ((prints >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)


@dataclass
class Index:
    """Items that are looked up at once. By size class: fingerprints, their item and offset, and a table for each block."""

    ids: list
    size: np.ndarray
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]
    shingles: list[tuple[np.ndarray, np.ndarray]]


def build_index(items: list[tuple]) -> Index:
    sizes, hashes, turns, sets = [], [], [], []
    for w in plain_words(pa.array([t for _, t in items], pa.string())):
        h, row = shingles(w, SHINGLE)
        for r in range(w.n_rows):
            sizes.append(int(w.first[r + 1] - w.first[r]))
            hashes.append(w.hash[w.first[r] : w.first[r + 1]])
            turns.append(h[row == r])
            sets.append(np.unique(turns[-1]))
    seen, count = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_counts=True)
    weighted = [(s, 1.0 / count[np.searchsorted(seen, s)]) for s in sets]
    found: dict[int, list] = {}
    for i, (n, h) in enumerate(zip(sizes, hashes, strict=True)):
        if n:
            # One of several places of a shingle can go without loss.
            own, at, times = np.unique(turns[i], return_inverse=True, return_counts=True)
            c = class_of(n, np.where(times > 1, 0.0, weighted[i][1])[at])
            start = np.arange(n - c + 1)
            found.setdefault(c, []).append((fingerprints(prefix_counts(h), start, c), np.full(len(start), i), start))
    windows = {}
    for c, parts in found.items():
        prints = np.concatenate([p[0] for p in parts])
        tables = []
        for low, width in BLOCKS:
            value = block_of(prints, low, width)
            order = np.argsort(value, kind="stable")
            tables.append((order, np.searchsorted(value[order], np.arange((1 << width) + 1))))
        windows[c] = (prints, np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]), tables)
    return Index([i for i, _ in items], np.array(sizes, np.int64), windows, weighted)


@dataclass
class Shared:
    """Runs of words of documents that are a shingle of an item: the first word, the words and the shingle's hash."""

    word: np.ndarray
    size: np.ndarray
    value: np.ndarray


def known_shingles(index: Index) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of all items, and which leading bits they have."""
    values = np.unique(np.concatenate([np.zeros(0, np.uint64), *[s for s, _ in index.shingles]]))
    maybe = np.zeros(1 << MAYBE_BITS, bool)
    maybe[values >> np.uint64(64 - MAYBE_BITS)] = True
    return values, maybe


def shared_shingles(w: Words, index: Index, known: tuple[np.ndarray, np.ndarray]) -> Shared:
    values, maybe = known
    row, n = w.row_of(), len(w.hash)
    parts = []
    for k in sorted({min(int(x), SHINGLE) for x in index.size if x}):
        h = np.full(max(0, n - k + 1), k, np.uint64)
        for j in range(k):
            h = chain(h, w.hash[j : n - k + 1 + j])
        at = np.flatnonzero(maybe[h >> np.uint64(64 - MAYBE_BITS)])
        at = at[row[at] == row[at + k - 1]]
        at = at[values[np.minimum(np.searchsorted(values, h[at]), len(values) - 1)] == h[at]]
        parts.append((at, np.full(len(at), k), h[at]))
    if not parts:
        return Shared(*(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64)))
    word, size, value = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(word, kind="stable")
    return Shared(word[order], size[order], value[order])


def candidates(w: Words, index: Index, shared: Shared) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, item) of the windows that touch a shared shingle and are within the radius of a window of an item."""
    of_word = np.searchsorted(w.first, shared.word, "right") - 1
    rows = np.unique(of_word)
    length = np.diff(w.first)[rows]
    begin = np.cumsum(length) - length
    words_of = np.arange(length.sum()) + np.repeat(w.first[rows] - begin, length)
    counts = prefix_counts(w.hash[words_of])
    place = shared.word + (begin - w.first[rows])[np.searchsorted(rows, of_word)]
    row = np.repeat(np.arange(len(rows)), length)
    for c, (prints, item, _, tables) in index.windows.items():
        low, high = np.maximum(0, place + 1 - c), np.minimum(len(row), place + shared.size)
        touched = np.cumsum(np.bincount(low, minlength=len(row) + 1) - np.bincount(high, minlength=len(row) + 1))[:-1] > 0
        start = np.flatnonzero(touched[: max(0, len(row) + 1 - c)])
        start = start[row[start] == row[start + c - 1]]
        for at in range(0, len(start), 1 << 12):
            mine = fingerprints(counts, start[at : at + (1 << 12)], c)
            for (low_bit, width), (order, first) in zip(BLOCKS, tables, strict=True):
                value = block_of(mine, low_bit, width)
                head, n = first[value], first[value + 1] - first[value]
                window = np.repeat(np.arange(len(mine)), n)
                entry = order[np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(head, n)]
                near = np.flatnonzero(np.bitwise_count(mine[window] ^ prints[entry]) <= RADIUS)
                if len(near):
                    yield rows[row[start[at + window[near]]]], item[entry[near]]


def similarity(shared: Shared, begin: int, end: int, item: int, index: Index) -> float:
    """The greatest weight of the item's shingles in an item-sized window of words ``begin`` to ``end``, over the weight of all.

    A window can be moved on to the next of the item's shingles without loss, so only those that begin with one count.
    """
    values, weight = index.shingles[item]
    part = slice(*np.searchsorted(shared.word, [begin, end]))
    place = np.minimum(np.searchsorted(values, shared.value[part]), len(values) - 1)
    mine = values[place] == shared.value[part]
    word, last, place = shared.word[part][mine], (shared.word + shared.size)[part][mine], place[mine]
    until = np.searchsorted(last, word + index.size[item], "right")
    most = np.concatenate([[0.0], np.cumsum(weight[place])])
    best, held = 0.0, np.zeros(len(values), bool)
    for i in np.flatnonzero(most[until] - most[: len(word)] >= THRESHOLD * weight.sum() - 1e-9):
        held[:] = False
        held[place[i : until[i]]] = True
        best = max(best, float(weight[held].sum() / weight.sum()))
        if best >= 1.0:
            break
    return best


def hits(w: Words, index: Index, known: tuple[np.ndarray, np.ndarray]) -> dict[tuple[int, int], float]:
    """The greatest similarity by row and item, where it reaches the threshold."""
    found: dict[tuple[int, int], float] = {}
    shared = shared_shingles(w, index, known)
    parts = list(candidates(w, index, shared)) if len(shared.word) else []
    if parts:
        for row, item in np.unique(np.stack([np.concatenate(x) for x in zip(*parts, strict=True)], axis=1), axis=0):
            if (x := similarity(shared, w.first[row], w.first[row + 1], item, index)) >= THRESHOLD:
                found[row, item] = x
    return found


def blocks(benchmark: DataFrame) -> Iterator[Index]:
    rows: list = []
    for r in benchmark.select("item_id", "text").toLocalIterator():
        rows.append(tuple(r))
        if len(rows) == BLOCK:
            yield build_index(rows)
            rows = []
    if rows:
        yield build_index(rows)


def adding_hits(index: Index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: adds the hits of a block of items to the last two columns."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_shingles(index)
        for batch in batches:
            if not batch.num_rows:
                continue
            items = [list(x or ()) for x in batch.column(batch.num_columns - 2).to_pylist()]
            best = [x or 0.0 for x in batch.column(batch.num_columns - 1).to_pylist()]
            for w in plain_words(string_column(batch, "text")):
                for (row, item), x in hits(w, index, known).items():
                    items[w.rows.start + row].append(index.ids[item])
                    best[w.rows.start + row] = max(best[w.rows.start + row], x)
            items = [sorted(set(x), key=lambda i: (i is None, i)) for x in items]
            columns = [batch.column(i) for i in range(batch.num_columns - 2)] + [pa.array(items, batch.schema.field(batch.num_columns - 2).type), pa.array(best, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return add


def with_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = docs.withColumns({ITEMS: F.array().cast(ArrayType(benchmark.schema["item_id"].dataType)), SIMILARITY: F.lit(0.0)})
    for index in blocks(benchmark):
        found = found.mapInArrow(adding_hits(index), found.schema)
    return found


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, items (item_ids, ascending), similarity (the greatest) and contaminated, a row for each row of ``docs``."""
    found = with_hits(docs.select("doc_id", "text"), benchmark)
    return found.select("doc_id", F.col(ITEMS).alias("items"), F.col(SIMILARITY).alias("similarity"), (F.size(ITEMS) > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a hit, with their columns."""
    return with_hits(docs, benchmark).where(F.size(ITEMS) == 0).drop(ITEMS, SIMILARITY)
