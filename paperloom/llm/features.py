"""Hashed n-gram features of texts, for whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tokens import ALNUM, Words, chain, words

_BIGRAM, _SKIP, _STEM = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F)


def bare_words(texts: pa.Array) -> Iterator[Words]:
    """Words in lower case without punctuation."""
    return words(pc.utf8_lower(texts), part=ALNUM)


def grams(w: Words, bits: int, skip: bool = False, stem: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of words and pairs of neighbours, with ``skip`` of pairs with a word between, and with ``stem`` of the
    first so many bytes of longer words."""
    row = w.row_of()
    rows, hashes = [row], [w.hash]
    if stem:
        longer = w.end - w.start > stem
        head = np.full(longer.sum(), _STEM, np.uint64)
        for j in range(stem):
            head = chain(head, w.data[w.start[longer] + j].astype(np.uint64))
        rows.append(row[longer])
        hashes.append(head)
    for gap, salt in ((1, _BIGRAM), (2, _SKIP))[: 2 if skip else 1]:
        same = row[:-gap] == row[gap:]
        rows.append(row[gap:][same])
        hashes.append(chain(w.hash[:-gap][same] ^ salt, w.hash[gap:][same]))
    return np.concatenate(rows), (np.concatenate(hashes) >> np.uint64(64 - bits)).astype(np.int64)


def hashed_share(column: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the value alone."""
    return F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def label_sample(labels: DataFrame, label: str, most: int, seed: int) -> DataFrame:
    """About ``most`` rows (doc_id as text, label) at most, one for each doc_id that has the label; a choice by hashed doc_id."""
    one = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy(F.col("doc_id").cast("string").alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    rows = one.count()
    return one.where(hashed_share(F.col("doc_id"), seed) < min(1.0, most / max(rows, 1)))
