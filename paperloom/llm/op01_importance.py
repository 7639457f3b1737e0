"""Quality by importance resampling: hashed n-gram models of target and raw text, and a Gumbel top-k draw.

The target model counts hashed tokens (words and runs of punctuation) and pairs of neighbours, each once a document, of
documents that are labelled as good, the raw model those of all documents; counts are added up per bucket by a grouped aggregate. Both are smoothed by
``SMOOTHING`` documents, so n-grams that are too rare to have been expected in the target tell nothing. A document's
importance weight is the sum, over its n-grams, of log(target / raw), at a temperature of (n-grams + ``SHRINK``) /
``SHARPNESS``, so that texts of all lengths are held to the same ratio; a hashed Gumbel number is
added, and the k greatest sums are drawn, which samples k documents without replacement in proportion to exp(weight).

k is the number of documents whose weight reaches a cut that is found on labelled documents outside the target model.
The k-th greatest sum is
found by counting sums in ever finer bins, so nothing is sorted in one place; ties at the k-th place, however many, fall to
the greater hash of the doc_id in the same way.

Defined cases: null and empty texts have no n-gram and the weight 0; rows that repeat a doc_id share their Gumbel number and keep weights of their own; without
labels of both kinds all documents are kept; an empty table gives an empty result; further columns are ignored by
``importance`` and kept by ``resampled``; a null doc_id is kept or not by its weight like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import grams, hashed_share, label_sample
from .storage import TEXT_KEYS, small_or_shuffled, stored, with_text_keys, without
from .tokens import WORD_OR_MARK, Words, string_column, words

BITS = 18
#: Labelled documents in all (chosen by hashed doc_id).
MOST_EXAMPLES = 16_000
SMOOTHING = 5.0
#: Log ratios are drawn towards zero by this much: slight ones come from the sample's mix of languages and topics.
SLIGHT = 0.4
#: Share of the labelled documents that the cut is found on, outside the target model.
FOR_CUT = 0.3
#: A weight of one nat a n-gram counts as so many against the Gumbel numbers, whose standard deviation is 1.28.
SHARPNESS = 200.0
#: Share of good labelled documents that the cut may lose before the draw, and how far below it lies, in nats a n-gram.
LOST, MARGIN = 0.002, 0.01
#: N-grams without a preference that every document counts as having besides its own, so that short ones aren't extreme.
SHRINK = 16
SEED = 23
BINS = 4096


def distinct_grams(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket), each pair once."""
    row, bucket = grams(w, BITS)
    key = np.sort((row << BITS) | bucket)
    key = key[np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]])]
    return key >> BITS, key & ((1 << BITS) - 1)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, raw, target): n-grams of a task's rows by bucket, of all rows and of those with ``good``."""
    raw, target = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    for batch in batches:
        good, at = string_column(batch, "good").fill_null(False).to_numpy(zero_copy_only=False).astype(bool), 0
        for w in words(string_column(batch, "text"), part=WORD_OR_MARK):
            row, bucket = distinct_grams(w)
            raw += np.bincount(bucket, minlength=1 << BITS)
            if good[at : at + w.n_rows].any():
                target += np.bincount(bucket[good[at : at + w.n_rows][row]], minlength=1 << BITS)
            at += w.n_rows
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"])


def log_ratio(docs: DataFrame, labelled: DataFrame) -> np.ndarray | None:
    """log(target / raw) by bucket; null without target text. The buckets bound what the driver gets."""
    good = labelled.where("label = 1").select("doc_id", F.lit(True).alias("good"))
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").join(small_or_shuffled(good, MOST_EXAMPLES), "doc_id", "left").select("text", "good")
    sums = texts.mapInArrow(counted, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    got = sums.toArrow()
    raw, target = np.zeros(1 << BITS), np.zeros(1 << BITS)
    raw[got["bucket"].to_numpy()], target[got["bucket"].to_numpy()] = got["raw"].to_numpy(), got["target"].to_numpy()
    if not target.sum():
        return None
    expected = raw * (target.sum() / raw.sum())
    ratio = np.log((target + SMOOTHING) / (expected + SMOOTHING))
    return (np.sign(ratio) * np.maximum(np.abs(ratio) - SLIGHT, 0)).astype(np.float32)


def weighed(docs: DataFrame, ratio: np.ndarray, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_grams, mean_ratio and the columns ``keep`` for each row of ``docs``."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for w in words(string_column(batch, "text"), part=WORD_OR_MARK):
                row, bucket = distinct_grams(w)
                n = np.bincount(row, minlength=w.n_rows)
                total = np.bincount(row, ratio[bucket], minlength=w.n_rows)
                kept = [batch.column(c).slice(at, w.n_rows) for c in keep]
                yield pa.RecordBatch.from_arrays([string_column(batch, "doc_id").slice(at, w.n_rows), pa.array(n), pa.array(total.astype(np.float64) / (n + SHRINK)), *kept], ["doc_id", "n_grams", "mean_ratio", *keep])
                at += w.n_rows

    texts = docs.select("doc_id", "text", *keep)
    kinds = "".join(f", {c} {texts.schema[c].dataType.simpleString()}" for c in keep)
    return texts.mapInArrow(weigh, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, n_grams long, mean_ratio double{kinds}")


def kth_greatest(sums: DataFrame, k: int) -> tuple[float, int]:
    """The k-th greatest ``key`` and how many rows with exactly this key belong to the k greatest."""
    low, high = sums.agg(F.min("key"), F.max("key")).first()
    while low < high:
        width = (high - low) / BINS
        if low + width == low:
            break
        inside = sums.where((F.col("key") >= low) & (F.col("key") <= high))
        binned = inside.groupBy(F.least(F.lit(BINS - 1), F.floor((F.col("key") - low) / width)).alias("bin")).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
        above = sums.where(F.col("key") > high).count()
        for r in sorted(binned.collect(), key=lambda r: -r["bin"]):
            if above + r["n"] >= k:
                low, high = r["low"], r["high"]
                break
            above += r["n"]
    return high, k - sums.where(F.col("key") > high).count()


def importance(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_grams, weight, key, kept and the columns ``keep`` for each row of ``docs``."""
    labelled = stored(label_sample(labels, "quality", MOST_EXAMPLES, 1).withColumn("for_cut", hashed_share(F.col("doc_id"), 11) < FOR_CUT))
    ratio = log_ratio(docs, labelled.where("not for_cut"))
    if ratio is None:
        found = weighed(docs, np.zeros(1 << BITS, np.float32), keep)
        return found.select("doc_id", "n_grams", F.lit(0.0).alias("weight"), F.lit(0.0).alias("key"), F.lit(True).alias("kept"), *keep)
    uniform = (F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 40)) + 0.5) / F.lit(float(1 << 40))
    found = weighed(docs, ratio, keep).withColumn("weight", F.col("mean_ratio") * SHARPNESS)
    found = stored(found.withColumn("key", F.col("weight") - F.log(-F.log(uniform))))
    chosen = labelled.where("label = 1 and for_cut").select(F.col("doc_id").alias("__doc_id"))
    good = found.join(small_or_shuffled(chosen, MOST_EXAMPLES), F.col("doc_id").cast("string") == F.col("__doc_id"))
    cut = good.agg(F.percentile("mean_ratio", LOST)).first()[0]
    k = found.where(F.col("mean_ratio") >= (cut if cut is not None else float("-inf")) - MARGIN).count()
    if not k:
        return found.select("doc_id", "n_grams", "weight", "key", F.lit(False).alias("kept"), *keep)
    edge, ties = kth_greatest(found, k)
    # Of equal sums at the k-th place those with the greatest hash of the doc_id, found by the same finer bins.
    by_hash = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(SEED + 1)), 11).cast("double")
    last, _ = kth_greatest(found.where(F.col("key") == edge).select(by_hash.alias("key")), ties)
    at_edge = by_hash >= F.lit(float(last))
    return found.select("doc_id", "n_grams", "weight", "key", ((F.col("key") > edge) | ((F.col("key") == edge) & at_edge)).alias("kept"), *keep)


def resampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are drawn, with their columns. Rows that share a doc_id are told apart by their texts."""
    return without(docs, importance(with_text_keys(docs), labels, TEXT_KEYS).where("not kept"))
