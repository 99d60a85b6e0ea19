"""Licence scan by a trained paragraph classifier.

Paragraphs (lines of a text) are classified by a multinomial logistic regression over hashed word 1- to 3-grams.
It is trained here: positives are windows of the public notices below, ``unknown`` are lines of a bounded
sample of the corpus and windows that several families share. The probabilities are calibrated on windows kept
out of training (temperature scaling), and a paragraph whose best family is less likely than ``least`` is
unknown. A prediction is confirmed only if enough of the paragraph's word 3-grams stand in a notice of that family.

A paragraph without a telling word of any notice has no telling 3-gram and could never be confirmed, so it is
passed over without being scored; the result is the same.

All work on the corpus is native: column expressions and MLlib's JVM transformers. Only candidates, without
the texts they come from, are grouped again by document.

Defined cases: a null text has no paragraphs; empty and very short paragraphs are unknown; repeated rows get
equal results; ties between families go to the first in the alphabet; an empty table gives an empty result; a
column ``licences`` of the input is replaced.
Helper columns carry the prefix ``_l_``.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.sources.shared import materialize

# Notices of well-known licences, as their authors publish them.
NOTICES = {
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
        "Licensed under the GNU Affero General Public License, version 3.",
    ],
    "all-rights-reserved": ["All rights reserved.", "Copyright. All rights reserved worldwide."],
    "apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed '
        'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "This project is released under the Apache License, Version 2.0.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "cc0": [
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to "
        "this work to the public domain worldwide. This work is distributed without any warranty.",
        "Released under CC0 1.0 Universal.",
    ],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License.",
        "Licensed under the GNU Lesser General Public License, version 3.",
    ],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so.",
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT License.",
        "Licensed under the MIT License.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
}
# Words that tell nothing by themselves.
COMMON = frozenset(
    "a an and any are as at be but by can do for form found from has if in is it its kind may met not of on one only or "
    "other part shall so such that the their them then there these this those to under use was were which who whom "
    "will with you your".split()
)
UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *sorted(NOTICES)]
FEATURES = 1 << 13
WINDOWS = (3, 4, 5, 7, 10, 15, 25)
#: Expected number of corpus texts that the unknown class is learned from.
UNKNOWN_TEXTS = 500
TEMPERATURES = [0.25 * 1.25**step for step in range(16)]
LEAST = 0.5
#: Least share of a paragraph's word 3-grams that must stand in a notice of the predicted family.
CONFIRMED = 0.5
#: So many of them, or else all, so that a chance phrase in a short paragraph confirms nothing.
SHARED = 3


def _words(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def _grams(words: list[str], n: int = 3) -> list[str]:
    return [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]


def _telling(gram: str) -> bool:
    return any(w not in COMMON and not w.isdigit() for w in gram.split(" "))


ANCHORS = sorted({w for texts in NOTICES.values() for t in texts for w in _words(t) if _telling(w)})


def words_of(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), "[^a-z0-9]+"), lambda w: w != "")


def ngrams(words: Column, n: int) -> Column:
    head = F.slice(words, 1, F.greatest(F.size(words) - (n - 1), F.lit(0)))
    return F.transform(head, lambda w, i: F.array_join(F.slice(words, i + 1, n), " "))


def _featured(df: DataFrame) -> DataFrame:
    """``df`` (with ``words``) with the sparse vector ``features``."""
    tokens = F.concat("words", ngrams(F.col("words"), 2), ngrams(F.col("words"), 3))
    hashing = HashingTF(inputCol="_l_tokens", outputCol="features", numFeatures=FEATURES, binary=True)
    return hashing.transform(df.withColumn("_l_tokens", tokens)).drop("_l_tokens")


@dataclass(frozen=True)
class Classifier:
    model: LogisticRegressionModel
    temperature: float
    reference: DataFrame  # family, grams: the telling 3-grams of its notices


def _windows(spark: SparkSession) -> DataFrame:
    """(words, label) of all windows of the notices; windows of several families, or telling none, are unknown."""
    notices = [(family, _words(text)) for family, texts in NOTICES.items() for text in texts]
    rows = spark.createDataFrame(notices, "family string, notice array<string>")
    sizes = F.array(*[F.lit(n) for n in WINDOWS], F.size("notice"))
    cut = (
        rows.withColumn("size", F.explode(F.array_distinct(sizes)))
        .where("size <= size(notice)")
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.size("notice") - F.col("size") + 1)))
        .select("family", F.slice("notice", F.col("start"), F.col("size")).alias("words"))
    )
    return cut.groupBy("words").agg(
        F.when(F.count_distinct("family") == 1, F.min("family")).otherwise(UNKNOWN).alias("family")
    )


def train(corpus: DataFrame, text: str = "text", unknown_texts: int = UNKNOWN_TEXTS) -> Classifier:
    """Fit and calibrate. Of the corpus, about ``unknown_texts`` texts are read as examples of other prose."""
    spark = corpus.sparkSession
    reference = spark.createDataFrame(
        [(f, sorted({g for t in texts for g in _grams(_words(t)) if _telling(g)})) for f, texts in NOTICES.items()],
        "family string, grams array<string>",
    )
    every = sorted({g for texts in NOTICES.values() for t in texts for g in _grams(_words(t)) if _telling(g)})
    # A share of the texts that shrinks as the corpus grows: the training set keeps its size.
    one_in = max(1, corpus.count() // unknown_texts)
    prose = (
        corpus.where(F.pmod(F.xxhash64(text), F.lit(one_in)) == 0)
        .select(F.explode(F.split(text, "\n")).alias("line"))
        .select(words_of(F.col("line")).alias("words"))
        .where(F.size("words") > 0)
        .where(~F.arrays_overlap(ngrams(F.col("words"), 3), F.lit(every)))
        .select("words", F.lit(UNKNOWN).alias("family"))
    )
    label = F.array_position(F.lit(FAMILIES), F.col("family")).cast("double") - 1
    rows = _windows(spark).unionByName(prose).withColumn("label", label)
    rows = materialize(rows.withColumn("held_out", F.pmod(F.xxhash64("words", F.lit(3)), F.lit(4)) == 0))
    shares = rows.where("not held_out").groupBy("label").count()
    weighted = rows.where("not held_out").join(F.broadcast(shares), "label")  # one row per family
    weighted = weighted.withColumn("weight", 1000.0 / F.col("count"))
    regression = LogisticRegression(
        family="multinomial", regParam=1e-4, maxIter=60, weightCol="weight", standardization=False
    )
    model = regression.fit(_featured(weighted))
    raw = vector_to_array(F.col("rawPrediction"))
    tested = model.transform(_featured(rows.where("held_out"))).select("label", raw.alias("raw"))

    def loss(t: float) -> Column:
        own = F.element_at("raw", F.col("label").cast("int") + 1)
        total = F.aggregate("raw", F.lit(0.0), lambda acc, x: acc + F.exp((x - own) / t))
        return F.avg(F.log(total)).alias(f"t{t}")

    losses = tested.agg(*[loss(t) for t in TEMPERATURES]).first()
    known = [(value, t) for value, t in zip(losses, TEMPERATURES) if value is not None and math.isfinite(value)]
    return Classifier(model, min(known)[1] if known else 1.0, reference)


def classify(candidates: DataFrame, classifier: Classifier, least: float = LEAST, confirmed: float = CONFIRMED) -> DataFrame:
    """``candidates`` (with ``words``) with ``family``, calibrated ``probability`` and ``match``."""
    scored = classifier.model.transform(_featured(candidates)).withColumn("_l_raw", vector_to_array("rawPrediction"))
    top = F.array_max("_l_raw")
    weights = F.transform("_l_raw", lambda x: F.exp((x - top) / classifier.temperature))
    total = F.aggregate("_l_raw", F.lit(0.0), lambda acc, x: acc + F.exp((x - top) / classifier.temperature))
    best = F.array_position("_l_raw", top).cast("int")
    predicted = scored.withColumns(
        {"_l_best": F.element_at(F.lit(FAMILIES), best), "probability": F.element_at(weights, best) / total}
    ).drop("features", "rawPrediction", "prediction", "_l_raw")
    # The reference has one row per family.
    joined = predicted.withColumn("_l_grams", ngrams(F.col("words"), 3)).join(
        F.broadcast(classifier.reference.withColumnRenamed("family", "_l_best")), "_l_best", "left"
    )
    shared = F.size(F.array_intersect("_l_grams", "grams"))
    every = F.greatest(F.size(F.array_distinct("_l_grams")), F.lit(1))
    match = F.coalesce(shared / every, F.lit(0.0))
    enough = (match >= confirmed) & (shared >= F.least(every, F.lit(SHARED)))
    known = (F.col("_l_best") != UNKNOWN) & (F.col("probability") >= least) & F.coalesce(enough, F.lit(False))
    return joined.withColumns({"match": match, "family": F.when(known, F.col("_l_best")).otherwise(UNKNOWN)}).drop(
        "_l_best", "_l_grams", "grams"
    )


def scan(df: DataFrame, classifier: Classifier, text: str = "text", drop_text: bool = False, **limits) -> DataFrame:
    """``df`` with ``licences``: array of (line, family, probability, match) of its confirmed licence paragraphs."""
    lines = F.transform(
        F.split(F.col(text), "\n"), lambda line, i: F.struct(i.alias("line"), words_of(line).alias("words"))
    )
    found = F.filter(lines, lambda x: F.exists(x["words"], lambda w: w.isin(ANCHORS)))
    marked = df.drop("licences").withColumn("_l_found", found)
    marked = marked.drop(text) if drop_text else marked
    stored = materialize(marked.withColumn("_l_row", F.monotonically_increasing_id()))
    candidates = stored.select("_l_row", F.explode("_l_found").alias("x")).select("_l_row", "x.line", "x.words")
    licences = (
        classify(candidates, classifier, **limits)
        .where(F.col("family") != UNKNOWN)
        .groupBy("_l_row")
        .agg(F.array_sort(F.collect_list(F.struct("line", "family", "probability", "match"))).alias("licences"))
    )
    # Rows without candidates are not shuffled.
    none = F.array().cast(licences.schema["licences"].dataType)
    found = stored.where(F.size("_l_found") > 0).join(licences, "_l_row", "left")
    others = stored.where(F.coalesce(F.size("_l_found"), F.lit(0)) <= 0).withColumn("licences", none)
    return found.withColumn("licences", F.coalesce("licences", none)).unionByName(others).drop("_l_row", "_l_found")
