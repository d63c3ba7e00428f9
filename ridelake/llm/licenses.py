"""License scans by a trained paragraph classifier.

Paragraphs (lines) become sparse counts of hashed word n-grams; a multinomial
logistic regression, trained here on the notices below and on ordinary
paragraphs of the corpus, names the licence family of a paragraph or none.  The
unknown class is calibrated: a family is named only above the probability
halfway between the least of a notice's own family and the largest that an
ordinary paragraph kept from fitting reaches.  A named family is confirmed only if enough of the
paragraph's three-word shingles, or of a notice's, occur in the other.

All of it is DataFrame and SQL work in the JVM (Spark's own feature hashing
and logistic regression included); the model is a few thousand weights.

Defined results: a line of fewer than three words is compared with no template
and names no licence; a null text has no paragraph and thus no licence; a blank
line is no paragraph; a licence named on several lines counts each line;
repeated rows add up under their id, rows without an id under null; an empty
table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import functools
import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

FEATURES = 1 << 12
# Ordinary lines learned from: those of smallest hash, at most so many.
ORDINARY = 2000
CONFIRMED = 0.5
NONE = "none"

# Public notices by licence family.
NOTICES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is released under the Apache 2.0 license.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This software is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
        "SPDX-License-Identifier: MIT",
        "Distributed under the terms of the MIT license.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Licensed under the GNU GPL version 2.",
        "Released under the GNU General Public License.",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "Released under the GNU Lesser General Public License.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Released under the BSD license.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "Released under the Mozilla Public License.",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "This article is available under the Creative Commons Attribution license CC BY 4.0.",
        "Content is licensed under CC BY-SA 4.0 unless otherwise noted.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "Available under CC BY-NC-SA 4.0 for noncommercial use only.",
        "This article is available under the Creative Commons Attribution-NonCommercial license CC BY-NC 4.0.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
        "to this work.",
        "Released into the public domain under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
}

_WORD = "[^\\p{L}\\p{N}]+"


def words(text: Column) -> Column:
    """Lower-case words: runs of letters and digits."""
    return F.filter(F.split(F.lower(text), _WORD), lambda w: w != "")


def _shingles(tokens: Column) -> Column:
    """All runs of three words."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(tokens) - 2, F.lit(1)))
    joined = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, 3), " "))
    return F.when(F.size(tokens) >= 3, joined).otherwise(F.array().cast("array<string>"))


def template_shingles() -> dict[str, list[list[str]]]:
    """Three-word shingles of the (ASCII) notices of each family."""
    out = {}
    for family, notices in sorted(NOTICES.items()):
        tokens = [re.findall("[a-z0-9]+", notice.lower()) for notice in notices]
        out[family] = [sorted({" ".join(t[i:i + 3]) for i in range(len(t) - 2)}) for t in tokens if len(t) >= 3]
    return out


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def _vectors(rows: DataFrame) -> DataFrame:
    """``features``: sparse counts of the words and word pairs of ``tokens``."""
    pairs = NGram(n=2, inputCol="tokens", outputCol="pairs").transform(rows)
    grams = pairs.withColumn("grams", F.concat("tokens", "pairs"))
    return HashingTF(numFeatures=FEATURES, inputCol="grams", outputCol="features").transform(grams)


class Classifier:
    """A trained model, the families of its labels and its threshold."""

    def __init__(self, model: LogisticRegressionModel, families: list[str], threshold: float):
        self.model, self.families, self.threshold = model, families, threshold


def train(docs: DataFrame) -> Classifier:
    """Learn from the notices and a bounded sample of the corpus' lines."""
    spark = docs.sparkSession
    families = [NONE, *sorted(NOTICES)]
    known = _strings(sorted({s for sets in template_shingles().values() for t in sets for s in t}))
    # ordinary lines: no three words in common with any notice
    lines = (docs.select(F.explode(F.split("text", "\n")).alias("line")).where(F.length(F.trim("line")) > 0)
             .select("line", F.xxhash64("line").alias("h")))
    # the share of hashes to look at holds a tenth more lines than wanted
    n_lines = lines.agg(F.approx_count_distinct("h")).first()[0]
    place = F.shiftrightunsigned("h", 1) / F.lit(float(1 << 63))
    ordinary = (lines.where(place * n_lines <= 1.1 * ORDINARY + 10).groupBy("h").agg(F.min("line").alias("line"))
                .orderBy("h").limit(ORDINARY)
                .select(F.lit(0.0).alias("label"), words(F.col("line")).alias("tokens"))
                .where((F.size("tokens") > 0) & (F.size(F.array_intersect(_shingles(F.col("tokens")), known)) == 0)))
    rows = [F.struct(F.lit(float(families.index(f))).alias("label"), F.lit(t).alias("line"))
            for f in sorted(NOTICES) for t in NOTICES[f]]
    notices = (spark.range(1).select(F.explode(F.array(*rows)).alias("x"))
               .select("x.label", words(F.col("x.line")).alias("tokens")))
    # notices also without their last word, and the halves of long ones
    n = F.size("tokens")
    cut = [F.col("tokens"), F.slice("tokens", F.lit(1), F.greatest(n - 1, F.lit(1))),
           F.when(n > 12, F.slice("tokens", F.lit(1), F.floor(n / 2).cast("int"))),
           F.when(n > 12, F.slice("tokens", F.floor(n / 2).cast("int") + 1, n))]
    varied = notices.select("label", F.explode(F.array(*cut)).alias("tokens")).where("tokens is not null")
    data = written(varied.unionByName(ordinary), "license-lines")
    rows = (_vectors(data).select("label", "features", F.xxhash64("tokens").alias("h"))
            .withColumn("weight", F.when(F.col("label") == 0, 0.05).otherwise(1.0)))
    model = LogisticRegression(maxIter=60, regParam=1e-3, weightCol="weight", family="multinomial").fit(
        rows.where("label > 0 or h % 2 = 0").coalesce(1))
    # halfway between the least probability of a notice's own family and the
    # largest that an ordinary line held out from fitting reaches
    scored = model.transform(rows.where("label > 0 or h % 2 <> 0")).select(
        "label", vector_to_array("probability").alias("p"))
    ends = scored.agg(
        F.min(F.when(F.col("label") > 0, F.element_at("p", F.col("label").cast("int") + 1))).alias("notice"),
        F.max(F.when(F.col("label") == 0, F.array_max(F.slice("p", 2, len(families) - 1)))).alias("ordinary")).first()
    threshold = (ends["notice"] + (ends["ordinary"] or 0.0)) / 2
    return Classifier(model, families, threshold)


def scan(docs: DataFrame) -> DataFrame:
    """Per ``doc_id``: ``license`` (its most probable confirmed family, none
    without one), ``families`` (all of them, sorted), ``n_paragraphs``,
    ``n_license_paragraphs`` and ``probability`` of the licence."""
    classifier = train(docs)
    families = classifier.families[1:]
    lines = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.explode_outer(F.split("text", "\n")).alias("line"))
             .select("doc_id", F.coalesce(words(F.col("line")), F.array().cast("array<string>")).alias("tokens")))
    own = F.slice("p", 2, len(families))
    scored = (classifier.model.transform(_vectors(lines))
              .select("doc_id", "tokens", vector_to_array("probability").alias("p"))
              .select("doc_id", "tokens", F.array_max(own).alias("best"),
                      (F.array_position(own, F.array_max(own)) - 1).cast("int").alias("family")))
    shingles = F.array_distinct(_shingles(F.col("tokens")))

    def confirmed(family: str) -> Column:
        alike = [F.size(F.array_intersect("shingles", _strings(t))) >= CONFIRMED * F.least(F.size("shingles"), F.lit(len(t)))
                 for t in template_shingles()[family]]
        return functools.reduce(lambda a, b: a | b, alike)

    # template comparison of the lines that reach the threshold only
    named = scored.withColumn("shingles", F.when((F.col("best") >= classifier.threshold) & (F.size("tokens") >= 3), shingles))
    found = F.col("shingles").isNotNull()
    held = [F.max(F.when(found & (F.col("family") == k) & confirmed(f), F.col("best"))).alias(f"_{k}")
            for k, f in enumerate(families)]
    sure = functools.reduce(lambda a, b: a | b, [(F.col("family") == k) & confirmed(f) for k, f in enumerate(families)])
    per = named.groupBy("doc_id").agg(
        F.sum((F.size("tokens") > 0).cast("long")).alias("n_paragraphs"),
        F.sum(F.coalesce(found & sure, F.lit(False)).cast("long")).alias("n_license_paragraphs"), *held)
    best = F.greatest(*[F.col(f"_{k}") for k in range(len(families))])
    first = F.coalesce(*[F.when(F.col(f"_{k}") == best, F.lit(f)) for k, f in enumerate(families)], F.lit(NONE))
    present = F.array_compact(F.array(*[F.when(F.col(f"_{k}").isNotNull(), F.lit(f)) for k, f in enumerate(families)]))
    return per.select("doc_id", first.alias("license"), present.alias("families"), "n_paragraphs",
                      "n_license_paragraphs", best.alias("probability"))
