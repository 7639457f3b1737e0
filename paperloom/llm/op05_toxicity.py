"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the buckets, out of 2 ** ``BITS``, of its words, their stems, neighbouring pairs and pairs with one
word between, each counted once. Training follows each coordinate at its own rate and drives weights that don't pay to exactly
zero (L1), so the model is a short list of weights and goes to the tasks with their code; its size is bounded by the
buckets, and in practice a few thousand. Scoring is one pass over the whole texts without a shuffle.

Training takes at most about ``MOST_EXAMPLES`` labelled documents (chosen by hashed doc_id), in one task: their features
are made where the documents are, and only these meet. Labels of documents whose crc32(doc_id as text) mod 5 is 0 are
never looked at.

Defined cases: null and empty texts have no feature and get the model's intercept; without any label every score is the
intercept 0.5 less a hair; repeated rows get the same score; an empty table gives an empty result; further columns, and
labels that are null, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import bare_words, grams, label_sample
from .storage import small_or_shuffled, stored
from .tokens import string_column

BITS = 20
#: Words longer than this count by their first bytes too, so that inflected forms share evidence.
STEM = 4
MOST_EXAMPLES = 16_000
EPOCHS = 5
#: FTRL-proximal: rate, its dampening, L1 and L2.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 12.0, 0.1


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hashed doc_id, label, buckets) of labelled texts, each bucket once."""
    for batch in batches:
        at = 0
        for w in bare_words(string_column(batch, "text")):
            row, bucket = grams(w, BITS, skip=True, stem=STEM)
            key = np.unique((row << BITS) | bucket)
            first = np.searchsorted(key >> BITS, np.arange(w.n_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array((key & ((1 << BITS) - 1)).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([string_column(batch, "doc_id").slice(at, w.n_rows), string_column(batch, "label").slice(at, w.n_rows), lists], ["doc_id", "label", "buckets"])
            at += w.n_rows


def fit(rows: pa.Table) -> pa.Table:
    """The weights other than zero, and the intercept as bucket -1, after FTRL-proximal over the examples in hashed order."""
    lists = rows.column("buckets").combine_chunks()
    offs, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    ids, label = rows.column("doc_id").to_numpy(), rows.column("label").to_numpy()
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    order = np.argsort(ids, kind="stable")

    def weights(at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[at]) * L1 - z[at]
        return np.where(np.abs(z[at]) <= L1, 0.0, shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    intercept = np.array([size - 1])
    for _ in range(EPOCHS):
        for i in order:
            at = np.concatenate([flat[offs[i] : offs[i + 1]], intercept])
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label[i]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(size))
    kept = np.flatnonzero(w)
    return pa.table({"bucket": pa.array(np.where(kept == size - 1, -1, kept).astype(np.int32)), "weight": pa.array(w[kept])})


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_EXAMPLES) -> tuple[np.ndarray, np.ndarray, float]:
    """Buckets (ascending) and weights of the model, and its intercept."""
    chosen = label_sample(labels.where(~held_out(F.col("doc_id"))), "toxic", most, 5)
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").join(small_or_shuffled(chosen, most), "doc_id")
    texts = texts.select(F.xxhash64("doc_id").alias("doc_id"), "text", "label")
    made = stored(texts.mapInArrow(examples, "doc_id long, label int, buckets array<int>"))
    rows = made.groupBy((F.col("label") < 0).alias("all")).applyInArrow(fit, "bucket int, weight double").collect()
    model = sorted((r["bucket"], r["weight"]) for r in rows if r["bucket"] >= 0)
    intercept = next((r["weight"] for r in rows if r["bucket"] < 0), 0.0)
    return np.array([b for b, _ in model], np.int64), np.array([w for _, w in model], np.float64), intercept


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs``."""
    buckets, weights, intercept = train(docs, labels)
    dense = np.zeros(1 << BITS, np.float32)
    dense[buckets] = weights

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for w in bare_words(string_column(batch, "text")):
                row, bucket = grams(w, BITS, skip=True, stem=STEM)
                counts = dense[bucket] != 0
                key = np.unique((row[counts] << BITS) | bucket[counts])
                logit = intercept + np.bincount(key >> BITS, dense[key & ((1 << BITS) - 1)], minlength=w.n_rows)
                yield pa.RecordBatch.from_arrays([string_column(batch, "doc_id").slice(at, w.n_rows), pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30))))], ["doc_id", "score"])
                at += w.n_rows

    found = docs.select("doc_id", "text")
    found = found.mapInArrow(scored, f"doc_id {found.schema['doc_id'].dataType.simpleString()}, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
