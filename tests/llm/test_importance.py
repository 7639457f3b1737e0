"""Importance resampling against the same sums, cut and Gumbel top-k in plain Python."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperloom.llm import op01_importance as I
from paperloom.llm.features import hashed_share, label_sample
from paperloom.llm.tokens import WORD_OR_MARK, words


def buckets(text):
    """The n-grams of one text, each once."""
    found = [I.distinct_grams(w)[1].tolist() for w in words(pa.array([text or ""]), part=WORD_OR_MARK)]
    return [b for part in found for b in part]


def test_draw_is_that_of_plain_python(spark):
    r = random.Random(4)
    good, bad, both = "river stone house garden winter letter music bridge".split(), "click buy cheap offer prize win deal now".split(), "the and of to with some".split()
    docs, labels = [], []
    for i in range(400):
        pool = (good if i % 2 else bad) + both
        docs.append((i, " ".join(r.choice(pool if r.random() < 0.9 else good + bad) for _ in range(r.randint(2, 60)))))
        if i % 3:
            labels.append((i, i % 2))
    docs += [(400, None), (401, ""), (7, docs[8][1]), docs[9]]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = I.importance(table.withColumn("said", F.col("text")), marks, ("said",)).collect()
    assert Counter((x["doc_id"], x["said"]) for x in got) == Counter(docs)

    sample = {int(x["doc_id"]): (x["label"], x["cut"]) for x in label_sample(marks, "quality", I.MOST_EXAMPLES, 1).withColumn("cut", hashed_share(F.col("doc_id"), 11) < I.FOR_CUT).collect()}
    assert len(sample) == len(labels)
    raw, target = Counter(), Counter()
    for i, text in docs:
        raw.update(buckets(text))
        if sample.get(i, (0, True)) == (1, False):
            target.update(buckets(text))
    share = sum(target.values()) / sum(raw.values())

    def ratio(b):
        x = math.log((target[b] + I.SMOOTHING) / (raw[b] * share + I.SMOOTHING))
        return math.copysign(max(abs(x) - I.SLIGHT, 0.0), x)

    mean = {}
    for i, text in docs:
        found = buckets(text)
        mean[i, text] = sum(map(ratio, found)) / (len(found) + I.SHRINK)
    hashed = {x["doc_id"]: x for x in table.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(I.SEED)), F.lit(1 << 40)).alias("u"), F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(I.SEED + 1)), 11).alias("t")).collect()}
    for x in got:
        gumbel = -math.log(-math.log((hashed[x["doc_id"]]["u"] + 0.5) / (1 << 40)))
        assert x["weight"] == pytest.approx(mean[x["doc_id"], x["said"]] * I.SHARPNESS, abs=1e-3)
        assert x["key"] == pytest.approx(x["weight"] + gumbel, abs=1e-9)
    edge = np.percentile([x["weight"] / I.SHARPNESS for x in got if sample.get(x["doc_id"]) == (1, True)], 100 * I.LOST) - I.MARGIN
    k = sum(x["weight"] / I.SHARPNESS >= edge for x in got)
    assert 100 < k < 300
    order = sorted(got, key=lambda x: (-x["key"], -hashed[x["doc_id"]]["t"]))
    assert all(x["kept"] for x in order[:k]) and not any(x["kept"] for x in order[k:])
