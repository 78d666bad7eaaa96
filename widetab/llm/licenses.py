"""Licence scans: trained paragraph classifier (operator 10), DataFrame functions only.

A paragraph is a line, and a run of adjacent lines where a notice is wrapped: a
line's n-grams go on into the first two words of the next line, so the n-grams of
joined lines are the union of theirs. A multinomial logistic regression on
sparse word n-grams (two and three words, presence) is trained on labelled
paragraphs: the licence notices and standard wordings below in several
frames, invented licence names as class ``unknown``, and ``negatives`` plain
paragraphs of the corpus (the bound is a parameter; no other step samples).
A held-out part of that sample fits the temperature that calibrates the
probabilities and the least probability of a named family. A prediction below
it, or one whose best template of the family shares less than ``confirm`` of
its n-grams with the paragraph, becomes ``unknown``.

Scoring covers every paragraph: its n-grams meet the vocabulary (bounded by the
training sample, thousands of rows) in a broadcast join, so only known n-grams
are shuffled; weights and templates are literals of that same size. Lines that share
``RUN_GRAMS`` n-grams with templates and are not confirmed by themselves form runs,
which are scored and compared as one paragraph.

Defined results: null and empty texts have no paragraphs and no licence; a
paragraph found twice in a document counts once per place; repeated rows
get the same answer (an n-gram's weight counts once a paragraph); an empty table
gives an empty table; n-grams are of letters and digits, lower-cased, so marks of
comments before a line do not matter; a line without letters and digits ends a
run; other input columns do not matter.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from widetab.llm.common import drop_shared, write_shared

NEGATIVES = 1500
CONFIRM = 0.5
RUN_GRAMS = 2

# Fixed wordings: names by which notices cite each family, and first sentences of the licences.
NAMES = {
    "MIT": ["the MIT License", "an MIT license", "the MIT licence", "the Expat License"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "Apache 2.0"],
    "GPL": ["the GNU General Public License, version 3", "the GNU General Public License version 2", "the GNU GPL v3",
            "the GNU General Public License", "GPL-3.0-or-later", "GPLv2"],
    "LGPL": ["the GNU Lesser General Public License", "the GNU LGPL, version 2.1", "LGPL-3.0"],
    "AGPL": ["the GNU Affero General Public License", "the GNU AGPL v3", "AGPL-3.0"],
    "BSD": ["the BSD License", "the BSD 3-Clause License", "the BSD 2-Clause License", "a BSD-style license"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0", "MPL 2.0"],
    "ISC": ["the ISC License", "an ISC license"],
    "EPL-2.0": ["the Eclipse Public License 2.0", "the Eclipse Public License, version 2.0", "EPL 2.0"],
    "Unlicense": ["the Unlicense", "the public domain under the Unlicense"],
    "CC0": ["CC0 1.0 Universal", "the Creative Commons CC0 1.0 dedication", "CC0"],
    "CC-BY": ["CC BY 4.0", "the Creative Commons Attribution 4.0 International License", "CC-BY 3.0"],
    "CC-BY-SA": ["CC BY-SA 4.0", "the Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 3.0"],
    "CC-BY-NC": ["CC BY-NC 4.0", "the Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 3.0"],
    "CC-BY-ND": ["CC BY-ND 4.0", "the Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA": ["CC BY-NC-SA 4.0", "the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-NC-ND": ["CC BY-NC-ND 4.0", "the Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 License"],
}
WORDINGS = {
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
            "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"],
    "Apache-2.0": ["you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"],
    "GPL": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation"],
    "LGPL": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License as published by the Free Software Foundation"],
    "AGPL": ["you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
             "the Free Software Foundation"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"],
}
FRAMES = ["Licensed under {}.", "Released under {}.", "This work is licensed under {}.", "Distributed under {}.",
          "This project is released under the terms of {}.", "The code is available under {}.", "License: {}",
          "This work is published under {}; see the file LICENSE.", "All contents are made available under {}."]
INVENTED = ["the {} License", "the {} Public License, version 2.0", "the {} Community License 1.0", "{} Terms of Use", "{} 4.0"]
STEMS = [a + b for a in ("Or", "Tel", "Bras", "Quin", "Vex", "Had", "Zem", "Lur") for b in ("vane", "mic", "tow", "lore", "ford")]
PLAIN = ["The committee granted a driving licence to the applicant.", "He had no license to speak like that.",
         "Permission to enter the building is given at the desk.", "The software was distributed to all offices in version 2.0.",
         "Apache helicopters were seen over the valley.", "The general public may visit the museum under supervision.",
         "She works under the terms of a new contract.", "It is available under the table.", "All contents are made of wood.",
         "The copy was released under pressure."]


def examples() -> list[tuple[str, str]]:
    """Labelled paragraphs (text, family), in a fixed order."""
    rows = [(f.format(n), fam) for fam, names in NAMES.items() for n in names for f in FRAMES]
    rows += [(t, fam) for fam, texts in WORDINGS.items() for t in texts for _ in range(3)]
    # Each invented name in one frame per form, so that no single name carries the class.
    rows += [(FRAMES[(n + k) % len(FRAMES)].format(i.format(s)), "unknown")
             for n, s in enumerate(STEMS) for k, i in enumerate(INVENTED)]
    return rows + [(t, "none") for t in PLAIN for _ in range(3)]


def templates() -> list[tuple[str, str]]:
    """(family, text) that confirm a prediction: each name and wording."""
    return [(fam, t) for src in (NAMES, WORDINGS) for fam, texts in src.items() for t in texts]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def ngrams_of(words: Column, own: Column | None = None) -> Column:
    """Distinct two- and three-word sequences of an array of words that begin
    among its first ``own`` (all). ``words`` must be a column that is already
    computed: it is read once per place."""
    n = F.size(words)

    def runs(k: int) -> Column:
        last = n - k if own is None else F.least(n - k, own - 1)
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.concat_ws(
            " ", *[F.get(words, i + j) for j in range(k)]))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(runs(2), runs(3)))


def with_ngrams(df: DataFrame, text: str, name: str = "grams", ahead: str | None = None) -> DataFrame:
    """``df`` with the n-grams of a text column; with ``ahead`` those that go on
    into another column's words too."""
    df = df.withColumn("words_", words_of(F.col(text)))
    if ahead is None:
        return df.withColumn(name, ngrams_of(F.col("words_"))).drop("words_")
    return df.withColumns({"own_": F.size("words_"), "words_": F.concat("words_", words_of(F.col(ahead)))}) \
        .withColumn(name, ngrams_of(F.col("words_"), F.col("own_"))).drop("words_", "own_")


def paragraphs(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(k, th, place, line, ahead) for every line with a letter or digit; ``ahead``
    holds the first two words of the next line."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    two = lambda x: F.regexp_extract(x, "^[^A-Za-z0-9]*([A-Za-z0-9]+(?:[^A-Za-z0-9]+[A-Za-z0-9]+)?)", 1)
    return docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("th"), lines.alias("ls")).select(
        "k", "th", F.posexplode(F.transform("ls", lambda x, i: F.struct(
            x.alias("line"), F.coalesce(two(F.get("ls", i + 1)), F.lit("")).alias("ahead")))).alias("place", "x")) \
        .select("k", "th", "place", "x.line", "x.ahead").filter(F.col("line").rlike("[A-Za-z0-9]"))


@dataclass
class Model:
    """Trained classifier: n-gram weights per class and calibration."""

    classes: list[str]
    vocabulary: list[str]
    weights: np.ndarray          # classes × vocabulary
    bias: np.ndarray
    temperature: float
    least: float                 # probability under which a family is unknown
    held_out_accuracy: float


def _probabilities(scores: np.ndarray, temperature: float) -> np.ndarray:
    z = scores / temperature
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _fit(rows: DataFrame, n_classes: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(vocabulary, weights, bias). The vocabulary is every n-gram of the named
    paragraphs; plain ones weigh on those."""
    vectors = CountVectorizer(inputCol="grams", outputCol="features", binary=True, vocabSize=1 << 17).fit(
        rows.filter("family <> 'none'"))
    lr = LogisticRegression(regParam=0.002, elasticNetParam=0.0, maxIter=60, family="multinomial", standardization=False)
    fitted = lr.fit(vectors.transform(rows))
    weights, bias = np.zeros((n_classes, len(vectors.vocabulary))), np.full(n_classes, -20.0)
    got = fitted.coefficientMatrix.toArray()
    weights[:got.shape[0]] = got
    bias[:got.shape[0]] = fitted.interceptVector.toArray()
    return list(vectors.vocabulary), weights, bias


def _plain_lines(docs: DataFrame, key: str, text: str, negatives: int, seed: int) -> DataFrame:
    """The ``negatives`` distinct corpus lines with the smallest seeded hashes that do
    not speak of licences. Only lines under a hash threshold meet, expected to be a
    few times as many at any size of the corpus; it is raised if they are too few."""
    lines = paragraphs(docs, key, text).filter(~F.lower("line").rlike("licen|copyright|public domain|cc0|creative commons|gpl"))
    lines = lines.select("line", F.xxhash64(F.lit(seed), "line").alias("h"))
    steps, n = 1 << 40, max(1, docs.count())
    share = min(steps, steps * 2 * negatives // n)       # a document has a line at least, nearly always
    while True:
        few = write_shared(lines.filter(F.pmod("h", F.lit(steps)) < share).distinct(), "licence-lines")
        if share >= steps or few.count() >= negatives:
            return few.orderBy(F.pmod("h", F.lit(steps)), "line").limit(negatives)
        drop_shared(few)
        share = min(steps, share * 8)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", negatives: int = NEGATIVES, seed: int = 5) -> Model:
    """Fit on the labelled paragraphs and at most ``negatives`` corpus lines
    that do not speak of licences (those with the smallest seeded hashes)."""
    spark: SparkSession = docs.sparkSession
    plain = _plain_lines(docs, key, text, negatives, seed)
    named = spark.createDataFrame(examples(), "line string, family string")
    sample = named.unionByName(plain.select("line", F.lit("none").alias("family")))
    sample = with_ngrams(sample, "line").withColumn(
        "held", F.pmod(F.xxhash64(F.lit(seed + 1), "line"), F.lit(5)) == 0)
    classes = ["none", "unknown", *NAMES]
    label = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("family")).cast("double") - 1
    sample = write_shared(sample.withColumn("label", label).coalesce(2), "licence-sample").filter(F.size("grams") > 0)
    vocabulary, weights, bias = _fit(sample.filter("not held"), len(classes))
    where = {g: i for i, g in enumerate(vocabulary)}
    held = sample.filter("held").select("grams", "label").collect()     # a fifth of the bounded sample
    scores = np.array([bias + weights[:, [where[g] for g in r["grams"] if g in where]].sum(axis=1) for r in held])
    truth = np.array([int(r["label"]) for r in held])
    scores = scores.reshape(len(held), len(classes))
    best_t, least, right = 1.0, 0.5, 0.0
    if len(held):
        loss = lambda t: -np.log(np.maximum(_probabilities(scores, t)[np.arange(len(truth)), truth], 1e-12)).mean()
        best_t = min((0.25 * 1.1 ** i for i in range(40)), key=loss)
        p = _probabilities(scores, best_t)
        right = float((p.argmax(axis=1) == truth).mean())
        # Unknown below the probability that nine in ten right family predictions reach, kept within [0.3, 0.6].
        sure = p.max(axis=1)[(p.argmax(axis=1) == truth) & (truth > 1)]
        least = float(min(0.6, max(0.3, np.quantile(sure, 0.1)))) if len(sure) else 0.5
    # Calibrated on the held-out part, then fitted on all of the sample.
    vocabulary, weights, bias = _fit(sample, len(classes))
    return Model(classes, vocabulary, weights, bias, best_t, least, right)


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def findings(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", confirm: float = CONFIRM) -> DataFrame:
    """Paragraphs that read as a licence: k, th, place, family (or
    ``unknown``), probability, similarity to the family's best template."""
    spark = docs.sparkSession
    on = np.flatnonzero(np.abs(model.weights).max(axis=0) > 1e-3)
    fixed = spark.createDataFrame(templates(), "family string, t string")
    tgrams = with_ngrams(fixed, "t").filter(F.size("grams") > 0).collect()
    by_gram: dict[str, list[int]] = {}
    for i, r in enumerate(tgrams):
        for g in r["grams"]:
            by_gram.setdefault(g, []).append(i)
    place = {g: i for i, g in enumerate(model.vocabulary)}
    keep = sorted({model.vocabulary[i] for i in on} | set(by_gram))
    zero = np.zeros(len(model.classes))
    vocabulary = spark.createDataFrame(
        [(g, [float(x) for x in (model.weights[:, place[g]] if g in place else zero)]) for g in keep],
        "gram string, w array<double>")
    grams = with_ngrams(paragraphs(docs, key, text), "line", ahead="ahead").select(
        "k", "th", "place", F.explode_outer("grams").alias("gram"))   # plain explode would repeat the n-grams in a pushed filter
    n = range(len(model.classes))
    met = grams.join(F.broadcast(vocabulary), "gram").groupBy("k", "th", "place").agg(
        *[F.sum(F.get("w", F.lit(i))).alias(f"s{i}") for i in n], F.collect_set("gram").alias("grams"), F.count("*").alias("n"))
    # Rows that repeat a document bring each n-gram as often: their sums count once.
    copies = F.col("n") / F.size("grams")
    met = met.select("k", "th", "place", "grams", *[(F.col(f"s{i}") / copies).alias(f"s{i}") for i in n])
    shared = F.size(F.array_intersect("grams", _array(sorted(by_gram))))
    t = F.lit(model.temperature)

    def judged(df: DataFrame) -> DataFrame:
        """Rows with sums s0.. and n-grams, with family (null: none), probability, similarity."""
        df = df.withColumn("z", F.array(*[(F.col(f"s{i}") + F.lit(float(b))) / t for i, b in enumerate(model.bias)]))
        top = F.array_max("z")
        total = F.aggregate(F.transform("z", lambda x: F.exp(x - F.array_max("z"))), F.lit(0.0), lambda a, x: a + x)
        df = df.withColumns({"class": F.get(_array(model.classes), F.array_position("z", top) - 1),
                             "probability": F.lit(1.0) / total}).drop("z")
        best = F.greatest(*[F.lit(0.0)] * 2, *[
            F.when(F.col("class") == r["family"], F.size(F.array_intersect("grams", _array(r["grams"]))) / F.lit(float(len(r["grams"]))))
            .otherwise(F.lit(0.0)) for r in tgrams])
        df = df.withColumn("similarity", best)
        sure = (F.col("class") != "unknown") & (F.col("probability") >= model.least) & (F.col("similarity") >= confirm)
        return df.withColumn("family", F.when(F.col("class") != "none", F.when(sure, F.col("class")).otherwise("unknown"))).drop("class")
    lines = write_shared(judged(met.withColumn("shared", shared)).filter(
        F.col("family").isNotNull() | (F.col("shared") >= RUN_GRAMS)), "licence-lines-met")
    alone = F.coalesce(F.col("family") != "unknown", F.lit(False))
    # Runs of adjacent lines that no family confirms by themselves.
    order = W.partitionBy("k", "th").orderBy("place")
    rest = lines.filter(~alone & (F.col("shared") >= RUN_GRAMS)).withColumn(
        "new", (F.col("place") - F.lag("place", 1, -2).over(order) > 1).cast("int")).withColumn("run", F.sum("new").over(order))
    joined = rest.groupBy("k", "th", "run").agg(
        F.min("place").alias("place"), F.max("place").alias("last"), *[F.sum(f"s{i}").alias(f"s{i}") for i in n],
        F.array_distinct(F.flatten(F.collect_list("grams"))).alias("grams")).filter("last > place")
    runs = judged(joined).filter(F.col("family") != "unknown").select("k", "th", "place", "last", "family", "probability", "similarity")
    runs = write_shared(runs, "licence-runs")
    found = lines.filter(F.col("family").isNotNull()).select("k", "th", "place", "family", "probability", "similarity")
    inside = runs.select(F.col("k").alias("rk"), F.col("th").alias("rth"), F.explode(F.sequence("place", "last")).alias("rplace"))
    left = found.join(inside, F.col("k").eqNullSafe(F.col("rk")) & (F.col("th") == F.col("rth")) & (F.col("place") == F.col("rplace"))
                      & (F.col("family") == "unknown"), "left_anti")
    return left.unionByName(runs.drop("last"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", confirm: float = CONFIRM, model: Model | None = None) -> DataFrame:
    """Per document: key, n_licence (paragraphs of a confirmed family), families
    (sorted, comma-joined), n_unknown (other licence paragraphs)."""
    found = findings(docs, model or train(docs, key, text), key, text, confirm)
    named = F.col("family") != "unknown"
    per = write_shared(found.groupBy("k", "th").agg(
        F.count(F.when(named, 1)).alias("n_licence"), F.count(F.when(~named, 1)).alias("n_unknown"),
        F.array_join(F.sort_array(F.collect_set(F.when(named, F.col("family")))), ",").alias("families")), "licence-found")
    rows = docs.select(F.col(key).alias("dk"), F.xxhash64(text).alias("dth"))
    return rows.join(per, F.col("dk").eqNullSafe(F.col("k")) & (F.col("dth") == F.col("th")), "left").select(
        F.col("dk").alias(key), F.coalesce("n_licence", F.lit(0)).cast("bigint").alias("n_licence"),
        F.coalesce("families", F.lit("")).alias("families"), F.coalesce("n_unknown", F.lit(0)).cast("bigint").alias("n_unknown"))
