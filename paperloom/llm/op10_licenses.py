"""Licence scans: a trained paragraph classifier whose predictions templates confirm.

What is scored are lines, the sentences of paragraphs whose wrapped lines are joined, and, where none of these is a licence,
the paragraph as a whole; blank lines part paragraphs. A multinomial logistic regression over word n-grams (words and
neighbouring pairs, without common words), made sparse by an L1 penalty, tells licence families and an unknown class apart.
It is trained on the notices and template paragraphs below, whole, by sentence and with any word left out, against
unrelated sentences on licences and lines of the corpus (about ``MOST_LINES``, chosen by hash from whole texts). The unknown
class is calibrated on a held-out quarter: a prediction counts from the smallest probability at which no held-out unknown
line passes. It is confirmed if a window as long as a notice of the family holds ``CONFIRMED`` of the notice's words, but
for common ones, and no notice of another family is held better.

Everything is DataFrame operations. A text that holds so much of a notice has one of the notice's longest words, so a
regular expression made from these finds the parts to score; equal parts are scored once. The weights are
bounded by the n-grams of the notices and go to the tasks as a broadcast join.

Defined cases: null and empty texts have no licence; rows that repeat a doc_id get the licences of all of them; a null
doc_id has none; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .features import hashed_share
from .storage import small_or_shuffled, stored

# Short public notices of licence families.
NOTICES = {
    "Apache": ["Licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "MIT": ["Released under the MIT License", "This project is licensed under the terms of the MIT license", "SPDX-License-Identifier: MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "GPL": ["This work is licensed under the GNU General Public License, version 3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "SPDX-License-Identifier: GPL-3.0-or-later", "Licensed under the GPL version 2"],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 2.1", "SPDX-License-Identifier: LGPL-2.1-only", "Released under the LGPL"],
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3", "SPDX-License-Identifier: AGPL-3.0-only", "Released under the AGPL"],
    "BSD": ["Licensed under the BSD 3-Clause License", "Redistribution and use in source and binary forms, with or without modification, are permitted", "SPDX-License-Identifier: BSD-2-Clause", "Released under the BSD license"],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC0": ["Released under CC0 1.0 Universal", "Dedicated to the public domain under CC0"],
    "ISC": ["Released under the ISC License", "SPDX-License-Identifier: ISC"],
}
# Paragraphs of licences and of the headers they ask for.
PARAGRAPHS = {
    "Apache": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "MIT": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "GPL": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "LGPL": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "AGPL": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "CC0": ["To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide under CC0 1.0 Universal."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
}
# Sentences that use the same words without granting a licence.
UNRELATED = [
    "The driver lost his license and the car", "A fishing license is required in public waters", "The general public was informed", "All rights reserved", "The source of the river", "He studied at MIT for three years",
    "The mozilla project was founded", "They met an Apache warrior", "The terms of the contract were general", "Attribution of the painting is uncertain", "Software updates are free of charge", "Version 2.0 of the plan was published",
    "The public license office is closed", "License plates are issued here", "A copy of this letter was sent", "The commons were open to everybody", "Creative work needs time", "Any person may apply", "Copyright 2020 by the author", "Modification of the source is planned",
]
UNKNOWN = "unknown"
COMMON_WORDS = ["the", "this", "a", "an", "is", "are", "of", "to", "in", "and", "or", "under", "at", "by", "with", "without", "it", "you", "may", "for", "on", "was", "be", "that", "any"]
MOST_LINES = 2000
CONFIRMED = 0.6
#: Between sentences, and between paragraphs.
SENTENCE, BLANK = r"(?<=[.!?:])\s+(?=[\"'(]?[A-Z])", r"\n[ \t\r]*\n"


def plain(text: Column) -> Column:
    """The words of a line in lower case, without punctuation around them and common ones."""
    words = F.split(F.lower(text), r"[^a-z0-9.+\-]+")
    words = F.transform(words, lambda w: F.regexp_replace(w, r"^[.+\-]+|[.+\-]+$", ""))
    return F.filter(words, lambda w: (w != "") & ~w.isin(COMMON_WORDS))


def grams(words: Column) -> Column:
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.concat(words, F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(0)))))


def templates() -> list[tuple[str, str]]:
    """(family, notice): the notices, the paragraphs and their sentences."""
    rows = [(f, n) for f, ns in NOTICES.items() for n in ns]
    return rows + [(f, x) for f, ns in PARAGRAPHS.items() for n in ns for x in dict.fromkeys([n, *re.split(SENTENCE, n)])]


def telling_words() -> list[str]:
    """Words of which any text that holds ``CONFIRMED`` of a notice's words has one: the longest of each notice."""
    found = set()
    for _, notice in templates():
        words = {w.strip(".+-") for w in re.split(r"[^a-z0-9.+\-]+", notice.lower())} - {"", *COMMON_WORDS}
        needed = next(k for k in range(len(words) + 1) if k / len(words) >= CONFIRMED)
        found.update(sorted(words, key=lambda w: (-len(w), w))[: len(words) - needed + 1])
    return sorted(found)


def training_lines(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(family, grams, held): parts of the notices, and unknown lines."""
    notices = spark.createDataFrame(templates(), "family string, line string").withColumn("words", plain(F.col("line")))
    # Each notice whole and with any one word left out, as long as two words stay.
    parts = notices.select("family", "words", F.explode(F.sequence(F.lit(0), F.size("words"))).alias("gap"))
    left = F.filter("words", lambda w, i: i + 1 != F.col("gap"))
    parts = parts.select("family", left.alias("words")).where(F.size("words") >= 2)
    unrelated = spark.createDataFrame([(x,) for x in UNRELATED], "line string").select(F.lit(UNKNOWN).alias("family"), plain(F.col("line")).alias("words"))
    total = docs.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)).first()[0]
    every = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    lines = every.where(hashed_share(F.concat_ws("|", "doc_id", "at"), 10) < min(1.0, MOST_LINES / max(1, total or 0))).select("line")
    lines = lines.where(~F.lower("line").rlike("licen[cs]e|spdx|gnu|cc by")).select(F.lit(UNKNOWN).alias("family"), plain(F.col("line")).alias("words")).where(F.size("words") > 0)
    every = parts.unionByName(unrelated).unionByName(lines).select("family", grams(F.col("words")).alias("grams"))
    # Only these few lines meet in one task, in a fixed order; the documents are read and sampled in all.
    told = every.withColumn("held", hashed_share(F.concat_ws("|", "grams"), 3) < 0.25)
    return stored(told.repartition(1).sortWithinPartitions("family", F.concat_ws("|", "grams")))


def train(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, dict[str, float], float]:
    """(gram, weights by family) other than zero, the intercepts, and the smallest probability that counts."""
    lines = training_lines(spark, docs)
    licences = lines.where(F.col("family") != UNKNOWN)
    vectors = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=1.0).fit(licences)
    families = sorted([*NOTICES, UNKNOWN])
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")) - 1
    data = vectors.transform(lines.where(~F.col("held") | F.col("family").isin(list(NOTICES)))).withColumn("label", label.cast("double"))
    weight = F.when(F.col("family") == UNKNOWN, 0.5).otherwise(1.0)
    fitted = LogisticRegression(family="multinomial", regParam=0.0005, elasticNetParam=1.0, maxIter=60, weightCol="weight").fit(data.withColumn("weight", weight))
    matrix = fitted.coefficientMatrix.toArray()
    rows = [(g, [float(x) for x in matrix[:, i]]) for i, g in enumerate(vectors.vocabulary) if abs(matrix[:, i]).max() > 1e-6]
    weights = spark.createDataFrame(rows, "gram string, weights array<double>")
    start = dict(zip(families, (float(x) for x in fitted.interceptVector.toArray()), strict=True))
    held = lines.where("held").select("family", F.col("grams").alias("line_grams")).withColumn("line", F.monotonically_increasing_id())
    unknown = predicted(held, weights, start).where(F.col("truth") == UNKNOWN)
    highest = unknown.where(F.col("family") != UNKNOWN).agg(F.max("probability")).first()[0] or 0.0
    return weights, start, max(0.5, highest + 1e-9)


def predicted(lines: DataFrame, weights: DataFrame, start: dict[str, float]) -> DataFrame:
    """(line, truth if there, family, probability) by softmax over the sums of weights."""
    families = sorted(start)
    truth = F.first("family").alias("truth") if "family" in lines.columns else F.lit(None).alias("truth")
    asked = lines.select(*[c for c in lines.columns if c != "line_grams"], F.explode_outer("line_grams").alias("gram")).join(F.broadcast(weights), "gram", "left")
    sums = asked.groupBy("line").agg(truth, *[(F.sum(F.coalesce(F.get("weights", F.lit(i)), F.lit(0.0))) + F.lit(start[f])).alias(f"s{i}") for i, f in enumerate(families)])
    best = F.greatest(*[F.col(f"s{i}") for i in range(len(families))])
    total = F.aggregate(F.array(*[F.exp(F.col(f"s{i}") - best) for i in range(len(families))]), F.lit(0.0), lambda a, x: a + x)
    family = F.get(F.array(*[F.lit(f) for f in families]), (F.array_position(F.array(*[F.col(f"s{i}") for i in range(len(families))]), best) - 1).cast("int"))
    return sums.select("line", "truth", family.alias("family"), (F.lit(1.0) / total).alias("probability"))


def held_best(words: Column, notice: Column) -> Column:
    """The greatest share of the notice's words in a window of ``words`` as long as the notice."""
    size = F.size(notice)
    starts = F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_contains(notice, F.element_at(words, i)))
    shared = F.transform(starts, lambda i: F.size(F.array_intersect(F.slice(words, i, size), notice)))
    return F.coalesce(F.array_max(shared), F.lit(0)) / F.size(F.array_distinct(notice))


def confirmed(units: DataFrame, weights: DataFrame, start: dict[str, float], least: float) -> DataFrame:
    """(line, family, probability) of those of the distinct ``units`` (line) that are a licence."""
    grammed = units.withColumn("words", plain(F.col("line"))).select("line", grams(F.col("words")).alias("line_grams"))
    told = predicted(grammed, weights, start).where((F.col("family") != UNKNOWN) & (F.col("probability") >= least)).drop("truth")
    notices = units.sparkSession.createDataFrame(templates(), "of string, notice string").select(F.struct("of", plain(F.col("notice")).alias("words")).alias("n"))
    notices = notices.agg(F.collect_list("n").alias("notices"))
    held = told.withColumn("words", plain(F.col("line"))).where(F.size("words") > 0).crossJoin(F.broadcast(notices))
    alike = held.select("line", "family", "probability", F.transform("notices", lambda n: F.struct(n["of"].alias("of"), held_best(F.col("words"), n["words"]).alias("share"))).alias("shares"))
    own = F.array_max(F.transform(F.filter("shares", lambda x: x["of"] == F.col("family")), lambda x: x["share"]))
    best = F.array_max(F.transform("shares", lambda x: x["share"]))
    return stored(alike.where((own >= CONFIRMED) & (own >= best)).select("line", "family", "probability"))


def licences(docs: DataFrame) -> DataFrame:
    """doc_id, families (confirmed, ascending), n_lines and probability (the greatest) for each row of ``docs``.

    n_lines counts the lines that are a licence, and one for each further family of a paragraph that only joined lines tell.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    weights, start, least = train(spark, docs)
    pattern = r"(?i)(?<![a-z0-9])(?:" + "|".join(w.replace(".", r"\.").replace("+", r"\+") for w in telling_words()) + r")(?![a-z0-9])"
    paragraphs = docs.where(F.col("text").rlike(pattern)).select("doc_id", F.explode(F.split("text", BLANK)).alias("paragraph")).where(F.col("paragraph").rlike(pattern))
    paragraphs = stored(paragraphs.groupBy("doc_id", "paragraph").agg(F.count("*").alias("n")).withColumn("place", F.monotonically_increasing_id()))
    joined = F.trim(F.regexp_replace("paragraph", r"\s+", " "))
    lines = F.split("paragraph", "\n")
    sentences = F.array_except(F.split(joined, SENTENCE), lines)
    units = F.concat(F.transform(lines, lambda x: F.struct(F.lit(1).alias("times"), x.alias("line"))), F.transform(sentences, lambda x: F.struct(F.lit(0).alias("times"), x.alias("line"))))
    units = paragraphs.select("place", F.inline(units)).where(F.col("line").rlike(pattern))
    units = stored(units.groupBy("place", "line").agg(F.sum("times").alias("times")))
    told = confirmed(units.select("line").distinct(), weights, start, least)
    parts = stored(units.join(small_or_shuffled(told, told.count()), "line").select("place", "family", "probability", "times"))
    # Paragraphs of several parts without a licence in one of them, as a whole.
    known = parts.select("place").distinct()
    whole = paragraphs.where((F.size(lines) > 1) | (F.size(sentences) > 0)).join(small_or_shuffled(known, known.count()), "place", "left_anti").select("place", joined.alias("line"))
    told = confirmed(whole.select("line").distinct(), weights, start, least)
    wholes = whole.join(small_or_shuffled(told, told.count()), "line").select("place", "family", "probability", F.lit(0).cast("long").alias("times"))
    families = parts.unionByName(wholes).groupBy("place", "family").agg(F.greatest(F.sum("times"), F.lit(1)).alias("lines"), F.max("probability").alias("probability"))
    found = paragraphs.select("doc_id", "place", "n").join(families, "place").groupBy("doc_id").agg(
        F.array_sort(F.collect_set("family")).alias("families"), F.sum(F.col("n") * F.col("lines")).alias("n_lines"), F.max("probability").alias("probability")
    )
    found = stored(found)
    rows = found.count()
    joined = docs.select("doc_id").join(small_or_shuffled(found, rows), "doc_id", "left")
    return joined.select("doc_id", F.coalesce("families", F.array().cast("array<string>")).alias("families"), F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"), F.coalesce("probability", F.lit(0.0)).alias("probability"))
