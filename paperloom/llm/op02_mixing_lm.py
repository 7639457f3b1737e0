"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is its words in lower case (A-Z) and an end. A word of the vocabulary (the ``VOCABULARY`` most common words of the
training texts) is a path in a Huffman tree; any other takes the path of the rarer words, on which ``TRIE`` bits of its hash
follow. So a text is a sequence of bits, and each bit has three predictors: the node alone, the node after the word before,
and the node after the two words before. A predictor's probability comes from how often training texts took either branch at
the node in that context. The stretched probabilities are mixed by weights that a gate selects by how often the two contexts
were seen at the node. Every document starts with the same weights, a formula of the gate, and refines them after each
``BLOCK`` words by the gradient of the bits in them, from its first word to its last.

Contexts are counted exactly, all of them, and grow with the corpus: texts are coded in chunks of about ``CHUNK`` bytes; a
chunk's contexts are hashed, its equal pairs of context and symbol are added up, and they are dealt out by the context's hash
to as many parts as ``PART_ROWS`` asks for. A part adds up what all chunks sent, and answers each chunk with a byte for each
pair and node: the branch's share and how often the node was seen. So only compact pairs are shuffled, never a row for each
bit, and neither the driver nor a broadcast holds contexts. Contexts of hot words, which are so
common that one may take a good share of a part, are split by the first ``TOP`` bits of the symbol, whose own counts are pairs
like any other; a chunk sends at most 2 ** ``TOP`` of these for a context.

A rarer word's probability is that of its ``TRIE`` bits times its exact count's share of its hash's bucket. Words that training
had not are one event, as in the base score, whose counts know one place for all of them (V + 1): ``score`` is over the
events that the base tells apart, so the two compare. ``spelled_score`` and ``bits_per_byte`` also have the bits that spell
unseen words: their bytes are paths in a Huffman tree of bytes, predicted after one, three and five bytes from the spelling of
the rarer words of all training texts, and mixed alike.

Defined cases: a null or empty text is an end alone; repeated rows score alike; a null doc_id counts as training text;
without training text the base score is 0 for N = V = 0; an empty table gives an empty result; further columns are ignored;
a very long text is a chunk of its own, refined at the same pace; equal counts at the edge of the vocabulary stay out of it together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import dropped, stored
from .tokens import LOWER, Words, mix, string_column, words

VOCABULARY = 1 << 18
#: Bits of a rarer word's hash that are coded one by one.
TRIE = 16
#: Bits of a rarer word's hash that are not kept (the base's counts of words use all).
RARER_SHIFT = 12
#: Bits that number a symbol: of the vocabulary, the end, and the rarer words' trie.
SYMBOL_BITS = 19
#: Bytes of text in a chunk; context pairs that a part gets, about.
CHUNK, PART_ROWS = 3 << 20, 1 << 20
#: A word is hot if its contexts may fill a part by one in so many; bits of the symbol that split its contexts.
HOT, TOP = 4, 8
#: Bits of a context's hash beyond the number of training tokens: a context is taken for another with a chance of 2 ** -5 at most.
SPARE_BITS = 6
#: Slices in which chunks are scored.
SLICES = 4
#: Words after which the weights are refined, and by how much.
BLOCK, RATE = 64, 0.02
#: Places of the table for byte contexts, its blocks while it is added up, and how many of them one task adds.
BYTE_PLACES, BYTE_PART, FAN_IN = 1 << 20, 1 << 14, 32
GATES, INPUTS = 16, 3
END_OF_WORD = 256
#: A branch seen t of n times has the probability (t + PRIOR) / (n + 2 PRIOR).
PRIOR = 0.4

_SALTS = [np.uint64(x) for x in (0x9AE16A3B2F90404F, 0xC949C7DEFD4B2F3D, 0xB492B66FBE98F273, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5, 0x165667B19E3779F9)]
_START = np.uint64(0x51AF7C3B8D2E6F01)

# ---- states: a byte for the probability of a branch and for how often its node was seen (0: never)

_LEVEL_OF = np.arange(256) >> 6
#: Stretched probabilities are told in steps of so much.
_STEP = 0.75
_STRETCH_OF = np.where(_LEVEL_OF > 0, ((np.arange(256) & 63) - 31.5) * _STEP, 0.0).astype(np.float32)


def state(seen: np.ndarray, taken: np.ndarray) -> np.ndarray:
    stretch = np.log((taken + np.float32(PRIOR)) / (seen - taken + np.float32(PRIOR)))
    level = (seen >= 1).astype(np.uint8) + (seen >= 3) + (seen >= 10)
    return np.where(level > 0, level * 64 + np.clip(np.rint(stretch / _STEP + 31.5), 0, 63), 0).astype(np.uint8)


def first_weights() -> np.ndarray:
    """By gate (level after one word, then after two): the longer a context that was seen, and the oftener, the more it counts."""
    out = np.zeros((4, 4, INPUTS), np.float32)
    for one in range(4):
        for two in range(4):
            out[one, two] = ([1.0, 0.55, 0.35, 0.2][one] * [1.0, 0.5, 0.4, 0.3][two], [0.0, 0.5, 0.65, 0.8][one] * [1.0, 0.7, 0.6, 0.5][two], [0.0, 0.8, 0.9, 0.9][two])
    return out.reshape(GATES, INPUTS)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


# ---- word counts


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, value, n): 0 word hashes, 1 bytes of words (256: ends of words), 2 documents."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = rows = 0
    seen = np.zeros(257, np.int64)

    def flush() -> pa.RecordBatch:
        if not held:
            return rows_of(0, np.zeros(0, np.int64), np.zeros(0, np.int64))
        h, at = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
        return rows_of(0, h, np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64))

    def rows_of(kind: int, value: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(value), kind, np.int32)), pa.array(value.view(np.int64)), pa.array(n)], ["kind", "value", "n"])

    for batch in batches:
        rows += batch.num_rows
        for w in words(string_column(batch, "text")):
            held.append(np.unique(w.hash, return_counts=True))
            size += len(held[-1][0])
            seen[:256] += np.bincount(LOWER[w.data], minlength=256)
            seen[END_OF_WORD] += len(w.hash)
        if size > 1 << 21:
            yield flush()
            held, size = [], 0
    yield flush()
    yield rows_of(1, np.arange(257), seen)
    yield rows_of(2, np.zeros(1, np.int64), np.array([rows]))


# ---- the tree


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parents and sides of a Huffman tree's nodes: leaves first, then inner nodes, the root last."""
    n = len(counts)
    order = np.argsort(counts, kind="stable")
    leaves, weights = order.tolist(), counts[order].tolist()
    parent, side, made = [0] * (2 * n - 1), [False] * (2 * n - 1), []
    i = j = 0
    for node in range(n, 2 * n - 1):
        total = 0.0
        for taken in (False, True):
            if i < n and (j >= len(made) or weights[i] <= made[j]):
                child, total, i = leaves[i], total + weights[i], i + 1
            else:
                child, total, j = n + j, total + made[j], j + 1
            parent[child], side[child] = node, taken
        made.append(total)
    return np.array(parent, np.int32), np.array(side, bool)


@dataclass
class Tree:
    """Of each leaf its code (left-aligned), its length, and in a row of ``own`` the stretched shares of the branches on its path."""

    code: np.ndarray
    size: np.ndarray
    nodes: np.ndarray
    own: np.ndarray


def paths(parent: np.ndarray, side: np.ndarray, counts: np.ndarray, with_nodes: bool = True) -> Tree:
    """The tree of ``huffman``'s shape with the leaves' true ``counts``."""
    n, root = len(counts), len(parent) - 1
    total = np.concatenate([counts.astype(np.float64), np.zeros(max(0, len(parent) - n))])
    depth_of = np.zeros(len(parent), np.int64)
    for node in range(root - 1, n - 1, -1):
        depth_of[node] = depth_of[parent[node]] + 1
    if n > 1:
        depth_of[:n] = depth_of[parent[:n]] + 1
    for depth in range(int(depth_of.max(initial=0)), 0, -1):
        here = np.flatnonzero(depth_of == depth)
        np.add.at(total, parent[here], total[here])
    size = depth_of[:n]
    most = int(size.max(initial=0))
    code, own, nodes = np.zeros(n, np.uint64), np.zeros((n, most), np.float32), np.zeros((n, most if with_nodes else 0), np.int32)
    at, alive = np.arange(n), np.arange(n)
    for _ in range(most):
        alive = alive[at[alive] != root]
        child = at[alive]
        up, place = parent[child], depth_of[child] - 1
        code[alive] |= side[child].astype(np.uint64) << (np.uint64(31) - place.astype(np.uint64))
        own[alive, place] = np.log((total[child] + PRIOR) / (total[up] - total[child] + PRIOR))
        if with_nodes:
            nodes[alive, place] = up - n
        at[alive] = up
    return Tree(code, size, nodes, own)


@dataclass
class Model:
    """Symbols: the vocabulary by falling count, the end, then the buckets of rarer words; ``rank`` is their order by code."""

    #: The vocabulary's hashes in order, and the symbol of each; by the first bits of a hash the first of them that is not below.
    known: np.ndarray
    symbol: np.ndarray
    heads: np.ndarray
    counts: np.ndarray
    buckets: np.ndarray
    tree: Tree
    rank: np.ndarray
    by_rank: np.ndarray
    code_by_rank: np.ndarray
    #: By symbol: the rank that stands for all symbols with the same first ``TOP`` bits, and whether it is a hot word.
    top: np.ndarray
    hot: np.ndarray
    #: Bits of the path to the rarer words' trie.
    stem: int
    context_bits: int
    parts: int
    letters: Tree
    letter_bits: np.ndarray


def packed(known: np.ndarray, symbol: np.ndarray, counts: np.ndarray, buckets: np.ndarray, n_docs: int, n_tokens: int, letter_counts: np.ndarray) -> dict:
    """The model as plain arrays, small ones: broadcast values are unpickled where this package may not be installed."""
    weights = np.concatenate([counts, [max(1, n_docs), max(1.0, buckets.sum())]]).astype(np.float64)
    # Weights from a millionth of all on, so that no path is longer than the bits of a code.
    shape = huffman(np.maximum(weights, weights.sum() / (1 << 20)))
    return {"parts": (known, symbol, counts, buckets, n_docs, n_tokens, max(1, -(-n_tokens // PART_ROWS)), *shape, letter_counts)}


def unpacked(held: dict) -> Model:
    """The model of a broadcast value, which keeps it for the worker's next task."""
    if "model" not in held:
        held["model"] = built(*held["parts"])
    return held["model"]


def built(known: np.ndarray, symbol: np.ndarray, counts: np.ndarray, buckets: np.ndarray, n_docs: int, n_tokens: int, parts: int, parent: np.ndarray, side: np.ndarray, letter_counts: np.ndarray) -> Model:
    k, n = len(known), 1 << TRIE
    trunk = paths(parent, side, np.concatenate([counts, [max(1, n_docs), max(1.0, buckets.sum())]]), False)
    # The rarer words' leaf grows into a complete tree over the buckets of their hashes.
    stem = int(trunk.size[k + 1])
    level, shares = buckets.astype(np.float64), []
    for _ in range(TRIE):
        above = level.reshape(-1, 2).sum(axis=1)
        shares.append(np.log((level + PRIOR) / (np.repeat(above, 2) - level + PRIOR)))
        level = above
    own = np.zeros((k + 1 + n, max(trunk.own.shape[1], stem + TRIE)), np.float32)
    own[: k + 1, : trunk.own.shape[1]] = trunk.own[: k + 1]
    own[k + 1 :, :stem] = trunk.own[k + 1, :stem]
    for i, share in enumerate(reversed(shares)):
        own[k + 1 :, stem + i] = np.repeat(share, n >> (i + 1))
    code = np.concatenate([trunk.code[: k + 1], trunk.code[k + 1] | np.arange(n, dtype=np.uint64) << np.uint64(32 - stem - TRIE)])
    size = np.concatenate([trunk.size[: k + 1], np.full(n, stem + TRIE)]).astype(np.int32)
    order = np.argsort(code, kind="stable")
    rank = np.empty(len(code), np.uint64)
    rank[order] = np.arange(len(code), dtype=np.uint64)
    heads = code[order] >> np.uint64(32 - TOP)
    top = np.searchsorted(heads, heads).astype(np.uint64)[rank.astype(np.int64)]
    hot = np.concatenate([counts * HOT > PART_ROWS, np.zeros(1 + n, bool)])
    # A context's hash has bits beyond the number of training tokens, so that few contexts are taken for another.
    bits = min(64 - SYMBOL_BITS, max(32, int(n_tokens).bit_length() + SPARE_BITS))
    letters = paths(*huffman(letter_counts), letter_counts)
    letter_bits = (letters.code[:, None] >> (np.uint64(31) - np.arange(letters.own.shape[1], dtype=np.uint64))) & np.uint64(1)
    return Model(known, symbol, head_places(known), counts, buckets, Tree(code, size, trunk.nodes, own), rank, order, code[order], top, hot, stem, bits, parts, letters, letter_bits.astype(bool))


def head_places(known: np.ndarray) -> np.ndarray:
    """For ``position``: where the ascending ``known`` reach each value of their first bits, of which there are twice as many."""
    bits = max(1, len(known).bit_length())
    return np.searchsorted(known, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))


def position(known: np.ndarray, heads: np.ndarray, h: np.ndarray) -> np.ndarray:
    """``np.searchsorted(known, h)`` for hashes: from the first of its head on, a step at a time, and few need more than one."""
    at = heads.take((h >> np.uint64(65 - len(heads).bit_length())).astype(np.intp))
    late = np.flatnonzero(at < len(known))
    while len(late):
        late = late[known.take(at.take(late)) < h.take(late)]
        at[late] += 1
        late = late[at.take(late) < len(known)]
    return at


def reduced(h: np.ndarray, places: int, bits: int = 64) -> np.ndarray:
    """Hashes of so many bits as numbers below ``places``, in the same order."""
    return (((h >> np.uint64(bits - 32)) * np.uint64(places)) >> np.uint64(32)).astype(np.int64)


def before(h: np.ndarray, back: int) -> np.ndarray:
    out = np.zeros_like(h)
    out[back:] = h[:-back]
    return out


def expand(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For things of these sizes in turn: the thing and the place in it of each of their parts."""
    total = int(size.sum())
    kind = np.int32 if total < 1 << 31 else np.int64
    first = (np.cumsum(size) - size).astype(kind)
    return np.repeat(np.arange(len(size), dtype=kind), size), np.arange(total, dtype=kind) - np.repeat(first, size)


# ---- spelling


def spelled_bits(model: Model, letters: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of the bits of ``letters`` (at a place of their word): the letter's index, the bit, and its places in the byte table."""
    coded = (letters + 1).astype(np.uint64)
    last = [np.where(place >= j, before(coded, j), 0).astype(np.uint64) for j in range(1, 6)]
    after = [last[0], last[0] | last[1] << np.uint64(9) | last[2] << np.uint64(18)]
    after.append(after[1] | last[3] << np.uint64(27) | last[4] << np.uint64(36))
    which, depth = expand(model.letters.size[letters])
    node = model.letters.nodes[letters[which], depth].astype(np.uint64)
    return which, model.letter_bits[letters[which], depth], [reduced((mix(a ^ salt)[which] + node * _SALTS[4]) * _SALTS[0], BYTE_PLACES) for a, salt in zip(after, _SALTS[3:6], strict=True)]


def letters_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of words in lower case, each word with ``END_OF_WORD`` at its end; the word and the place in it of each."""
    size = end - start
    word, place = expand(size + 1)
    letters = np.full(len(word), END_OF_WORD, np.int64)
    inner = place < size[word]
    letters[inner] = LOWER[data[(start[word] + place)[inner]]]
    return letters, word, place


def added(rows: pa.Table) -> np.ndarray:
    total = np.zeros(2 * BYTE_PART, np.int64)
    for x in rows.column("counts"):
        total += np.frombuffer(pa.decompress(x.as_py(), BYTE_PART * 8, "zstd", asbytes=True), np.int32)
    return np.minimum(total, 2**31 - 1).astype(np.int32)


def add_parts(key: tuple, rows: pa.Table) -> pa.Table:
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "task": pa.array([key[1].as_py()], pa.int32()), "counts": pa.array([pa.compress(added(rows).tobytes(), "zstd", asbytes=True)], pa.binary())})


def byte_states(blocks: DataFrame) -> np.ndarray:
    """The states of branch one by place of the byte table, from tasks' ``blocks`` (part, task, counts): at most ``FAN_IN`` are
    added by one task, and the driver gets the finished table alone, whose size is fixed."""
    made = []
    tasks = (blocks.agg(F.max("task")).first()[0] or 0) + 1
    while tasks > 1:
        blocks = blocks.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int"))
        made.append(stored(blocks.groupBy("part", "task").applyInArrow(add_parts, "part int, task int, counts binary")))
        blocks, tasks = made[-1], (tasks - 1) // FAN_IN + 1
    table = np.zeros((BYTE_PLACES, 2), np.int32)
    for r in blocks.select("part", "counts").toLocalIterator():
        table[r["part"] * BYTE_PART : (r["part"] + 1) * BYTE_PART] = np.frombuffer(pa.decompress(bytes(r["counts"]), BYTE_PART * 8, "zstd", asbytes=True), np.int32).reshape(-1, 2)
    dropped(*made)
    return state(table.sum(axis=1).astype(np.float32), table[:, 1].astype(np.float32))


# ---- chunks and their contexts


def planes(x: np.ndarray) -> bytes:
    """Numbers by significance of their bytes, compressed."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T), "zstd", asbytes=True)


def from_planes(data: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(pa.decompress(data, n * size, "zstd", asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
    return np.ascontiguousarray(flat.reshape(size, n).T).view(kind).reshape(n)


def chunk_schema(doc_id: pa.DataType) -> pa.Schema:
    return pa.schema([("part", pa.int32()), ("counts", pa.binary()), ("doc_id", pa.list_(doc_id)), ("held", pa.bool_()), ("n_words", pa.list_(pa.int64())), ("n_bytes", pa.list_(pa.int64())), ("symbols", pa.binary()), ("rarer", pa.binary()), ("n_rarer", pa.int64()), ("spelled", pa.binary()), ("n_spelled", pa.int64())])


class Held:
    """Rows on their way to a chunk."""

    def __init__(self, held: bool):
        self.held, self.size = held, 0
        self.ids, self.n_words, self.n_bytes, self.symbols, self.rarer, self.letters = [], [], [], [], [], []

    def add(self, model: Model, w: Words, ids: list) -> None:
        at = np.minimum(position(model.known, model.heads, w.hash), max(0, len(model.known) - 1))
        rarer = model.known[at] != w.hash if len(model.known) else np.ones(len(w.hash), bool)
        bucket = len(model.known) + 1 + (w.hash >> np.uint64(64 - TRIE)).astype(np.int64)
        self.symbols.append(np.where(rarer, bucket, model.symbol[at]).astype(np.uint32) if len(model.known) else bucket.astype(np.uint32))
        self.rarer.append(w.hash[rarer])
        if self.held:
            self.letters.extend(w.data[a:b].tobytes() + b" " for a, b in zip(w.start[rarer].tolist(), w.end[rarer].tolist(), strict=True))
        else:
            taught = np.flatnonzero(rarer)
            self.taught = taught[np.unique(w.hash[taught], return_index=True)[1]]
        self.ids += ids
        self.n_words.append(np.diff(w.first))
        self.n_bytes.append(np.bincount(w.row_of(), w.end - w.start, minlength=w.n_rows).astype(np.int64) + np.diff(w.first))
        self.size += len(w.data)

    def row(self, schema: pa.Schema) -> pa.RecordBatch:
        rarer, letters = np.concatenate(self.rarer), b"".join(self.letters)
        row = [-1, None, self.ids, self.held, np.concatenate(self.n_words), np.concatenate(self.n_bytes), planes(np.concatenate(self.symbols)), planes(rarer >> np.uint64(RARER_SHIFT)), len(rarer), pa.compress(letters, "zstd", asbytes=True), len(letters)]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)


def encode(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of held-out or of training rows: their doc_id, words and bytes; symbols of the words; hashes of the rarer ones in
    turn, and in held-out rows their spelling, each followed by a space. At the end the task's blocks (part, counts) of the byte
    table, for which each megabyte tells each of its rarer training words once."""
    table, schema = np.zeros(2 * BYTE_PLACES, np.int32), None
    now = {held: Held(held) for held in (False, True)}
    for batch in batches:
        schema = schema or chunk_schema(string_column(batch, "doc_id").type)
        for held in (False, True):
            mine = batch.filter(pc.equal(string_column(batch, "held"), held))
            ids = string_column(mine, "doc_id")
            for w in words(string_column(mine, "text")):
                now[held].add(model, w, ids.slice(w.rows.start, w.n_rows).to_pylist())
                if not held:
                    teach(model, table, w, now[held].taught)
                if now[held].size >= CHUNK:
                    yield now[held].row(schema)
                    now[held] = Held(held)
    for left in now.values():
        if left.ids:
            yield left.row(schema)
    parts = table.reshape(-1, 2 * BYTE_PART)
    used = np.flatnonzero(parts.any(axis=1))
    if schema is not None and len(used):
        first = [pa.array(used.astype(np.int32)), pa.array([pa.compress(parts[i].tobytes(), "zstd", asbytes=True) for i in used], pa.binary())]
        yield pa.RecordBatch.from_arrays([*first, *(pa.nulls(len(used), f.type) for f in list(schema)[2:])], schema=schema)


def teach(model: Model, table: np.ndarray, w: Words, taught: np.ndarray) -> None:
    """Add the spelling of these words to the byte table."""
    for part in np.array_split(taught, len(taught) // 10_000 + 1):
        if len(part):
            letters, _, place = letters_of(w.data, w.start[part], w.end[part])
            _, bit, places = spelled_bits(model, letters, place)
            for p in places:
                np.add.at(table, 2 * p + bit, np.int32(1))


@dataclass
class Chunk:
    """The tokens of a chunk's rows, each row's words and its end."""

    n_words: np.ndarray
    row: np.ndarray
    place: np.ndarray
    symbol: np.ndarray
    rarer: np.ndarray
    hashes: np.ndarray


def read_chunk(model: Model, r: dict) -> Chunk:
    k, n_words = len(model.known), np.array(r["n_words"], np.int64)
    row, place = expand(n_words + 1)
    symbol = np.full(len(row), k, np.int32)
    symbol[place < n_words[row]] = from_planes(r["symbols"], int(n_words.sum()), np.uint32)
    return Chunk(n_words, row, place, symbol, symbol > k, from_planes(r["rarer"], r["n_rarer"], np.uint64) << np.uint64(RARER_SHIFT))


def token_pairs(model: Model, c: Chunk, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By token its pair of a context of ``order`` words and a symbol; the tokens whose context is split, and for each of these
    the pair that has the first bits of its symbol."""
    is_end = c.symbol == len(model.known)
    # A word as a context: by its symbol if it has one of its own; an end is what a row's first word follows.
    word = mix(c.symbol.astype(np.uint64) + np.uint64(1))
    word[c.rarer], word[is_end] = c.hashes, _START
    hot = model.hot[c.symbol] | is_end
    first = c.place == 0
    one, is_hot = before(word, 1), before(hot, 1)
    one[first], is_hot[first] = _START, True
    if order == 1:
        context = mix(one ^ _SALTS[0])
    else:
        two, two_hot = before(word, 2), before(hot, 2)
        two[first], two_hot[first] = _START, True
        two[1:][first[:-1]], two_hot[1:][first[:-1]] = _START, True
        context, is_hot = mix(mix(two ^ _SALTS[1]) ^ one), is_hot & two_hot
    top, split = model.top[c.symbol], np.flatnonzero(is_hot)
    tops = pair(model, mix(context[split] ^ _SALTS[2]), top[split])
    context[split] = mix(context[split] ^ (top[split] + np.uint64(1)) * _SALTS[5])
    return pair(model, context, model.rank[c.symbol]), split, tops


def pair_times(whole: np.ndarray, split: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a chunk's tokens, each once and ascending, and how many tokens have them."""
    every = np.sort(np.concatenate([whole, tops[tops != whole[split]]]))
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(every)), bool), every[1:] != every[:-1]]))
    return every[first], np.diff(first, append=len(every)).astype(np.uint32)


def pair_numbers(whole: np.ndarray, split: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By token the number of its pair among those of ``pair_times``, and of the one that has the first bits of its symbol."""
    every = np.concatenate([whole, tops])
    order = np.argsort(every)
    every = every.take(order)
    number = np.zeros(len(every), np.intp)
    np.cumsum(every[1:] != every[:-1], out=number[1:])
    at = np.empty_like(number)
    at[order] = number
    at_top = at[: len(whole)].copy()
    at_top[split] = at[len(whole) :]
    return at[: len(whole)], at_top


def pair(model: Model, context: np.ndarray, rank: np.ndarray) -> np.ndarray:
    return (context >> np.uint64(64 - model.context_bits)) << np.uint64(SYMBOL_BITS) | rank


def part_edges(model: Model, h: np.ndarray, bits: int) -> np.ndarray:
    """Where each part begins in ascending hashes of so many bits."""
    return np.searchsorted(reduced(h, model.parts, bits), np.arange(model.parts + 1))


def rarer_words(c: Chunk, held: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the chunk's rarer words, how often training rows have them, and which each occurrence is."""
    found, at = np.unique(c.hashes, return_inverse=True)
    return found, np.bincount(at, minlength=len(found)).astype(np.uint32) * np.uint32(not held), at


def sends(model: Model, order: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, chunk, contexts, symbols, times, n, words, word_times, n_words): what each part gets of each chunk, contexts of
    ``order`` words and, with those of one word, the counts of rarer words."""
    for batch in batches:
        for r in batch.to_pylist():
            c = read_chunk(model, r)
            pairs, times = pair_times(*token_pairs(model, c, order))
            times *= np.uint32(not r["held"])
            found, word_times, _ = rarer_words(c if order == 1 else replace(c, hashes=c.hashes[:0]), r["held"])
            of_pairs, of_words = part_edges(model, pairs >> np.uint64(SYMBOL_BITS), model.context_bits), part_edges(model, found, 64)
            out = []
            for part, (a, b, x, y) in enumerate(zip(of_pairs, of_pairs[1:], of_words, of_words[1:], strict=False)):
                if a < b or x < y:
                    words_of = planes(np.diff(found[x:y] >> np.uint64(RARER_SHIFT), prepend=np.uint64(0))), planes(word_times[x:y])
                    out.append((part, r["chunk"], *pair_planes(model, pairs[a:b]), planes(times[a:b]), int(b - a), *words_of, int(y - x)))
            yield pa.RecordBatch.from_pylist([dict(zip(_SENT.names, x, strict=True)) for x in out], schema=_SENT)


def pair_planes(model: Model, pairs: np.ndarray) -> tuple[bytes, bytes]:
    """The pairs' contexts as differences, and their symbols, in which common ones are small."""
    symbol = model.by_rank[(pairs & np.uint64((1 << SYMBOL_BITS) - 1)).astype(np.int64)]
    return planes(np.diff(pairs >> np.uint64(SYMBOL_BITS), prepend=np.uint64(0))), planes(symbol.astype(np.uint32))


def from_pair_planes(model: Model, r: dict) -> np.ndarray:
    context = np.cumsum(from_planes(r["contexts"], r["n"], np.uint64), dtype=np.uint64)
    return context << np.uint64(SYMBOL_BITS) | model.rank.take(from_planes(r["symbols"], r["n"], np.uint32))


_SENT = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("contexts", pa.binary()), ("symbols", pa.binary()), ("times", pa.binary()), ("n", pa.int64()), ("words", pa.binary()), ("word_times", pa.binary()), ("n_words", pa.int64())])


def merged(arrays: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values ascending, their sums of ``times``, and for all values in turn which it is."""
    every = np.concatenate(arrays)
    found, at = np.unique(every, return_inverse=True)
    return found, np.bincount(at, np.concatenate(times), minlength=len(found)), at


def node_states(model: Model, pairs: np.ndarray, total: np.ndarray) -> np.ndarray:
    """(depth, pair): the state of the branch that the pair's symbol takes at each node of its path, in its context."""
    rank = (pairs & np.uint64((1 << SYMBOL_BITS) - 1)).astype(np.int64)
    context, code = pairs >> np.uint64(SYMBOL_BITS), model.code_by_rank[rank]
    depths = model.tree.own.shape[1]
    # Where a symbol is alone below a node, all that was seen took its branch.
    out = np.empty((depths, len(pairs)), np.uint8)
    out[:] = state(total.astype(np.float32), total.astype(np.float32))
    head = np.ones(len(pairs), bool)
    head[1:] = context[1:] != context[:-1]
    alive = np.arange(len(pairs))
    seen = None
    for depth in range(depths + 1):
        if not len(alive):
            break
        # Of each run of one branch its size and sum, repeated for all in it.
        starts = np.flatnonzero(head)
        size = np.diff(starts, append=len(alive))
        sums = np.repeat(np.add.reduceat(total, starts), size)
        if depth:
            out[depth - 1, alive] = state(seen.astype(np.float32), sums.astype(np.float32))
        if depth == depths:
            break
        several = np.flatnonzero(np.repeat(size > 1, size))
        alive, head, seen, total, code = (x.take(several) for x in (alive, head, sums, total, code))
        bits = code >> np.uint64(31 - depth)
        head[1:] |= bits[1:] != bits[:-1]
    return out


def answer(model: Model, rows: pa.Table) -> pa.Table:
    """For each chunk that sent something: the states of its pairs and the counts of its words."""
    rows = rows.to_pylist()
    pairs, total, at = merged([from_pair_planes(model, r) for r in rows], [from_planes(r["times"], r["n"], np.uint32) for r in rows])
    # States by depth, as differences from the depth before: along most paths they hardly change.
    states = node_states(model, pairs, total)
    for depth in range(len(states) - 1, 0, -1):
        states[depth] -= states[depth - 1]
    _, counts, word_at = merged([np.cumsum(from_planes(r["words"], r["n_words"], np.uint64), dtype=np.uint64) for r in rows], [from_planes(r["word_times"], r["n_words"], np.uint32) for r in rows])
    out, a, x = [], 0, 0
    for r in rows:
        b, y = a + r["n"], x + r["n_words"]
        out.append({"chunk": r["chunk"], "part": r["part"], "n": r["n"], "states": pa.compress(states.take(at[a:b], axis=1), "zstd", asbytes=True), "n_words": r["n_words"], "word_counts": planes(counts[word_at[x:y]].astype(np.int64))})
        a, x = b, y
    return pa.Table.from_pylist(out, schema=_ANSWER)


def heard(blobs: list[tuple[bytes, int]], depths: int) -> np.ndarray:
    """The states (pair, depth) of all pairs of a chunk from what its parts answered of so many."""
    out, at = np.zeros((depths, sum(n for _, n in blobs)), np.uint8), 0
    for data, n in blobs:
        if n:
            flat = np.frombuffer(pa.decompress(data, n * depths, "zstd", asbytes=True), np.uint8)
            mine, change = out[:, at : at + n], flat.reshape(depths, n)
            mine[0] = change[0]
            for depth in range(1, depths):
                np.add(mine[depth - 1], change[depth], out=mine[depth])
            at += n
    return np.ascontiguousarray(out.T)


_ANSWER = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("n", pa.int64()), ("states", pa.binary()), ("n_words", pa.int64()), ("word_counts", pa.binary())])


# ---- scores


#: Rows that go through their texts side by side.
ROWS_AT_ONCE = 128


def refined(own: list[np.ndarray], cell: np.ndarray, gate: np.ndarray, inputs: list[np.ndarray], rows: int) -> np.ndarray:
    """Nats that the bits of each row take, given the stretched probabilities of what they are; ``own`` weights learn from them.
    ``cell``: ``GATES`` times the row, of the kind that numpy indexes by; the gate is added to it."""
    cell += gate
    z = own[0].take(cell)
    z *= inputs[0]
    for weight, x in zip(own[1:], inputs[1:], strict=True):
        z += weight.take(cell) * x
    np.clip(z, -12, 12, out=z)
    e = np.exp(np.negative(z, out=z), out=z)
    odds = e + np.float32(1)
    cost = np.log(odds)
    e /= odds
    scale = RATE / np.sqrt(np.maximum(np.bincount(cell, minlength=rows * GATES), 1))
    for weight, x in zip(own, inputs, strict=True):
        weight += scale * np.bincount(cell, e * x, minlength=rows * GATES)
    return np.bincount(cell, cost, minlength=rows * GATES).reshape(rows, GATES).sum(axis=1)


def start_weights(rows: int) -> list[np.ndarray]:
    return [np.tile(first_weights()[:, i], rows) for i in range(INPUTS)]


def coded(model: Model, c: Chunk, after: list[tuple[np.ndarray, np.ndarray]], size: np.ndarray) -> np.ndarray:
    """Nats that each row's tokens take, of whose bits the first ``size`` count; ``after`` one and two words: states of the
    pairs, and each token's pair."""
    rows, depths = len(c.n_words), model.tree.own.shape[1]
    cost = np.zeros(rows)
    by_length = np.argsort(c.n_words, kind="stable")
    group, within = np.empty(rows, np.int64), np.empty(rows, np.int64)
    group[by_length], within[by_length] = np.divmod(np.arange(rows), ROWS_AT_ONCE)
    steps = int(c.place.max(initial=0)) // BLOCK + 1
    step = group[c.row] * steps + c.place // BLOCK
    order = np.argsort(step, kind="stable")
    edges = np.flatnonzero(np.diff(step[order], prepend=-1, append=-1))
    size, every = size.astype(np.int32), np.arange(depths, dtype=np.int32)
    (one_states, one_at), (two_states, two_at) = after
    cell_of = within * GATES
    own, now = [], -1
    for lo, hi in zip(edges, edges[1:], strict=False):
        token = order[lo:hi]
        if group[c.row[token[0]]] != now:
            now, own = group[c.row[token[0]]], start_weights(ROWS_AT_ONCE)
        mine = size[token]
        # The whole paths of the tokens, and of these the places that count.
        bit = np.flatnonzero(every < mine[:, None])
        alone, one, two = (x.take(at[token], axis=0).ravel().take(bit) for x, at in ((model.tree.own, c.symbol), (one_states, one_at), (two_states, two_at)))
        gate = (one >> 6) * np.uint8(4) + (two >> 6)
        got = refined(own, np.repeat(cell_of[c.row[token]], mine), gate, [alone, _STRETCH_OF.take(one), _STRETCH_OF.take(two)], ROWS_AT_ONCE)
        rows_of = by_length[now * ROWS_AT_ONCE : (now + 1) * ROWS_AT_ONCE]
        cost[rows_of] += got[: len(rows_of)]
    return cost


def spelled(model: Model, byte_table: np.ndarray, data: bytes, row: np.ndarray, place: np.ndarray, unseen: np.ndarray, rows: int) -> np.ndarray:
    """Nats that spell the ``unseen`` ones of the words in ``data``, which stand in these rows at these places."""
    text = np.frombuffer(data, np.uint8)
    end = np.flatnonzero(text == 0x20)
    start = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
    # Rows do not depend on each other, so that only the bits of some of them are held.
    unseen, cost = np.flatnonzero(unseen), np.zeros(rows)
    edges = np.searchsorted(row[unseen], np.arange(0, rows + ROWS_AT_ONCE, ROWS_AT_ONCE))
    for lo, hi, first in zip(edges, edges[1:], range(0, rows, ROWS_AT_ONCE), strict=False):
        if lo < hi:
            mine, here = unseen[lo:hi], cost[first : first + ROWS_AT_ONCE]
            here += spelled_rows(model, byte_table, letters_of(text, start[mine], end[mine]), row[mine] - first, place[mine] // BLOCK, len(here))
    return cost


def spelled_rows(model: Model, byte_table: np.ndarray, letters_of_words: tuple[np.ndarray, np.ndarray, np.ndarray], row: np.ndarray, step: np.ndarray, rows: int) -> np.ndarray:
    """Nats that spell words, given ``letters_of`` them, and of each word the row and in how many steps its turn is."""
    letters, word, at = letters_of_words
    cost, own = np.zeros(rows), start_weights(rows)
    which, bit, places = spelled_bits(model, letters, at)
    sign = np.where(bit, 1, -1).astype(np.float32)
    found = [byte_table[p] for p in places]
    gate = (found[1] >> 6) * np.uint8(4) + (found[2] >> 6)
    inputs = [sign * _STRETCH_OF[f] for f in found]
    cell, step = (row * np.intp(GATES))[word][which], step[word][which]
    order = np.argsort(step, kind="stable")
    edges = np.flatnonzero(np.diff(step[order], prepend=-1, append=-1))
    for lo, hi in zip(edges, edges[1:], strict=False):
        now = order[lo:hi]
        cost += refined(own, cell[now], gate[now], [x[now] for x in inputs], rows)
    return cost


def score_chunk(model: Model, byte_table: np.ndarray, unseen: float, answers: list[dict], r: dict) -> dict:
    held, c, k, rows = r["held"], read_chunk(model, r), len(model.known), len(r["n_words"])
    after, depths = [], model.tree.own.shape[1]
    answers = sorted(answers, key=lambda x: (x["words"], x["part"]))
    for order in (1, 2):
        whole, top = pair_numbers(*token_pairs(model, c, order))
        states = heard([(x["states"], x["n"]) for x in answers if x["words"] == order], depths)
        # The first bits of a split context's symbol were counted apart.
        split = np.flatnonzero(whole != top)
        states[whole[split], :TOP] = states[top[split], :TOP]
        after.append((states, whole))
    of_word = np.concatenate([np.zeros(0, np.int64), *[from_planes(x["word_counts"], x["n_words"], np.int64) for x in answers]])
    count = np.zeros(len(c.row), np.float64)
    ends = c.symbol == k
    vocabulary = ~c.rarer & ~ends
    count[vocabulary] = model.counts[c.symbol[vocabulary]]
    count[c.rarer] = of_word[rarer_words(c, held)[2]]
    new = c.rarer & (count == 0)
    size = model.tree.size[c.symbol]
    size[new] = model.stem
    nats = coded(model, c, after, size)
    # Beyond its path, a rarer word is its share of its bucket, and an unseen one a single event.
    old = c.rarer & ~new
    extra = np.zeros(len(c.row))
    extra[old] = np.log(np.maximum(model.buckets[c.symbol[old] - k - 1], 1.0) / count[old]) - np.log1p(-min(unseen, 1 - 1e-12))
    extra[new] = -np.log(unseen)
    nats += np.bincount(c.row, extra, minlength=rows)
    letters = pa.decompress(r["spelled"], r["n_spelled"], "zstd", asbytes=True) if r["n_spelled"] else b""
    spelling = spelled(model, byte_table, letters, c.row[c.rarer], c.place[c.rarer], new[c.rarer], rows) if held else np.zeros(rows)
    words_only = ~ends
    return {
        "doc_id": r["doc_id"], "held_out": [held] * rows, "n_tokens": (c.n_words + 1).tolist(), "known": np.bincount(c.row, words_only & (count > 0), minlength=rows).astype(np.int64).tolist(),
        "base": np.bincount(c.row, np.where(words_only, np.log10(count + 1), 0), minlength=rows).tolist(), "score": (nats / -np.log(10)).tolist(), "spelled_score": ((nats + spelling) / -np.log(10)).tolist(),
        "bits_per_byte": ((nats + spelling) / np.log(2) / np.maximum(np.array(r["n_bytes"]), 1)).tolist(),
    }


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, spelled_score and bits_per_byte for each row of ``docs``."""
    context = docs.sparkSession.sparkContext
    counted = stored(docs.where(~held_out(F.col("doc_id"))).select("text").mapInArrow(count_words, "kind int, value long, n long").groupBy("kind", "value").agg(F.sum("n").alias("n")))
    n_docs = counted.where("kind = 2").agg(F.sum("n")).first()[0] or 0
    letter_counts = np.ones(257)
    for r in counted.where("kind = 1").collect():
        letter_counts[r["value"]] += r["n"]
    every = counted.where("kind = 0").select("value", "n")
    n_words, distinct, once = every.agg(F.sum("n"), F.count("*"), F.count(F.when(F.col("n") == 1, 1))).first()
    n_words = n_words or 0
    # How many words there are of each count: the greatest set that fits.
    least, held = None, 0
    for r in sorted(every.groupBy(F.least("n", F.lit(1 << 16)).alias("n")).agg(F.count("*").alias("words")).collect(), key=lambda r: -r["n"]):
        held += r["words"]
        if held <= VOCABULARY and r["n"] > 1:
            least = r["n"]
    common = every.where(F.col("n") >= (least or 1 << 62)).toArrow()
    known, counts = common["value"].to_numpy().view(np.uint64), common["n"].to_numpy().astype(np.float64)
    falling = np.lexsort((known, -counts))
    known, counts = known[falling], counts[falling]
    symbol = np.argsort(known).astype(np.int32)
    buckets = np.zeros(1 << TRIE)
    bucket = F.shiftrightunsigned("value", 64 - TRIE).cast("int").alias("bucket")
    summed = every.where(F.col("n") < (least or 1 << 62)).groupBy(bucket).agg(F.sum("n").alias("n")).toArrow()
    buckets[summed["bucket"].to_numpy()] = summed["n"].to_numpy()
    dropped(counted)
    # Of as many words as training had, about as many would be new as it had words that came once.
    unseen = max(1, once) / (buckets.sum() + max(1, once))
    n_all = n_words + n_docs
    shared = context.broadcast(packed(known[symbol], symbol, counts, buckets, n_docs, n_all, letter_counts))

    texts = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held"))
    key = texts.schema["doc_id"].dataType.simpleString()
    columns = f"part int, counts binary, doc_id array<{key}>, held boolean, n_words array<bigint>, n_bytes array<bigint>, symbols binary, rarer binary, n_rarer bigint, spelled binary, n_spelled bigint"
    made = stored(texts.mapInArrow(lambda batches: encode(unpacked(shared.value), batches), columns).withColumn("chunk", F.monotonically_increasing_id()).withColumn("task", F.spark_partition_id()))
    table = context.broadcast({"states": byte_states(made.where("part >= 0").select("part", "task", "counts"))})
    chunks = made.where("part < 0").select("chunk", "doc_id", "held", "n_words", "n_bytes", "symbols", "rarer", "n_rarer", "spelled", "n_spelled")

    def answers_after(order: int) -> DataFrame:
        sent = chunks.select("chunk", "held", "n_words", "symbols", "rarer", "n_rarer").mapInArrow(lambda batches: sends(unpacked(shared.value), order, batches), "part int, chunk bigint, contexts binary, symbols binary, times binary, n bigint, words binary, word_times binary, n_words bigint")
        got = sent.groupBy("part").applyInArrow(lambda rows: answer(unpacked(shared.value), rows), "chunk bigint, part int, n bigint, states binary, n_words bigint, word_counts binary")
        return stored(got.withColumn("words", F.lit(order)))

    # One after the other: the first exchange's files are gone when the second, smaller one begins.
    told_of = [answers_after(order) for order in (2, 1)]
    answers = told_of[0].unionByName(told_of[1])

    def score(answers: pa.Table, chunk: pa.Table) -> pa.Table:
        got = score_chunk(unpacked(shared.value), table.value["states"], unseen, answers.to_pylist(), chunk.to_pylist()[0])
        return pa.table({"doc_id": pa.array(got.pop("doc_id"), chunk.schema.field("doc_id").type.value_type), **got})

    schema = f"doc_id {key}, held_out boolean, n_tokens long, known long, base double, score double, spelled_score double, bits_per_byte double"
    # A slice of the chunks at a time meets its answers, so that not all of them lie in the shuffle's files at once.
    found = None
    for i in range(SLICES):
        answered, asked = (x.where(F.pmod(F.xxhash64("chunk"), F.lit(SLICES)) == i).groupBy("chunk") for x in (answers, chunks))
        mine = stored(answered.cogroup(asked).applyInArrow(score, schema))
        found = mine if found is None else found.unionByName(mine)
    dropped(made, *told_of)
    return found.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + int(n_docs > 0)).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + float(np.log10(n_docs + 1.0)) - F.col("n_tokens") * float(np.log10(n_all + (distinct or 0) + (n_docs > 0) + 1.0))).alias("base_score"),
        "score",
        "spelled_score",
        "bits_per_byte",
    )
