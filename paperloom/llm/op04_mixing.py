"""Mixing of sources to target weights (repetition rates with one random copy).

Tokens are summed per source, each source gets a share of a token budget by its weight, and a source's repetition rate is
its target over its size. A document is emitted floor(rate) times, and once more if a number in [0, 1) that is hashed
from its doc_id and the seed is below the fraction of the rate. No draw depends on partitions or on other rows, so reruns
and retried tasks agree.

Defined cases: a null or empty text has size 0 and is still emitted by the rate of its source; a null source is a source
of its own, last in order; repeated rows draw alike; an empty table gives an empty result; further columns pass through,
and columns of the input named like those added here are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

from .storage import small_or_shuffled, stored
from .tokens import words

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: The mix takes so many times the size of all sources, and at most so many times that of each.
BUDGET, MOST = 1.5, 2
SEED = 17
ADDED = ("size", "source_size", "target", "rate", "copies", "taken")


@F.arrow_udf(LongType())
def word_count(texts: pa.Array) -> pa.Array:
    """Words of each text: runs of other characters than space and U+0009-U+000D."""
    return pa.array(np.concatenate([np.zeros(0, np.int64), *[np.diff(w.first) for w in words(texts, hashed=False)]]))


def hashed_uniform(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 sum."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST) -> tuple[DataFrame, int]:
    """``sizes`` (source, source_size) with the target of each source, and the number of sources.

    Sources are ranked by a range partitioning, so no task orders all of them. Shares above ``most`` times a source's
    size are cut there and the excess is shared by weight among the others, until none is above: each round is one
    aggregate over the sources.
    """
    order = (F.col("source").isNull().cast("int"), F.col("source"))
    placed = sizes.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    placed = stored(placed.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy(*order))))
    before, rows = [], 0
    for part, n in sorted(tuple(r) for r in placed.groupBy("part").count().collect()):
        before.append((part, rows))
        rows += n
    if not rows:
        return sizes.withColumn("target", F.lit(0.0)), 0
    offset = F.create_map(*[F.lit(x) for pair in before for x in pair])
    rank = offset[F.col("part")] + F.col("place") - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = stored(placed.select("source", "source_size", weight.alias("weight")))
    cap = F.col("source_size") * F.lit(float(most))
    total = ranked.agg(F.sum("source_size")).first()[0] * budget
    level = None
    while True:
        shut = F.lit(False) if level is None else cap <= F.lit(level) * F.col("weight")
        fixed, free = ranked.agg(F.sum(F.when(shut, cap).otherwise(0.0)), F.sum(F.when(shut, 0.0).otherwise(F.col("weight")))).first()
        new = (total - fixed) / free if free else level
        if new == level or not free:
            break
        level = new
    target = F.least(cap, F.lit(float(level)) * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target")), rows


def mix_plan(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with size, source_size, target, rate, copies and taken (words that the mix takes of a document)."""
    return plan_sized(sized(docs), seed)


def sized(docs: DataFrame) -> DataFrame:
    return docs.drop(*ADDED).withColumn("size", word_count(F.col("text")))


def plan_sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``mix_plan`` for rows that have their size."""
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets, rows = source_targets(sizes)
    targets = targets.withColumnRenamed("source", "__source")
    found = docs.join(small_or_shuffled(targets, rows), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    found = found.withColumn("rate", rate)
    extra = hashed_uniform(F.col("doc_id"), seed) < F.col("rate") - F.floor("rate")
    found = found.withColumn("copies", F.floor("rate").cast("long") + extra.cast("long"))
    return found.withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, with the number of the copy."""
    plan = mix_plan(docs.drop("copy"), seed).where("copies > 0")
    return plan.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*[c for c in docs.columns if c not in (*ADDED, "copy")], "copy")
