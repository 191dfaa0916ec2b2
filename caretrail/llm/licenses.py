"""Licence scan: a trained paragraph classifier, confirmed against templates. DataFrame and SQL only.

A paragraph is a line of a text that has a word ([a-z0-9]+ after lower-casing). Features are its word
unigrams and bigrams.

1. Training rows: every template notice (``NOTICES``), whole and in ``VARIANTS`` versions with words left out
   or cut to a window; and as class `unknown` the sentences of ``DECOYS`` plus a bounded sample of distinct corpus
   paragraphs (``UNKNOWN_ROWS``, by hash; a hash threshold comes first, so no task sends more than its share) that
   resemble no template.
2. The vocabulary is n-grams of two or more notice rows that are rare among the unknown ones; on their
   presence a multinomial logistic regression is fitted with an L1 penalty, so few weights are not 0.
3. Scoring explodes every paragraph's n-grams against the vocabulary (a table whose size the templates
   bound, broadcast), so only paragraphs with a weighted n-gram reach a shuffle; all others are unknown.
   A family's margin is its log odds against `unknown`.
4. Calibration over all paragraphs of the corpus: the margin that all but ``FALSE_ALARM`` of those that resemble no
   template stay below, 0 at least, becomes the threshold of the unknown class. Repeated rows count each.
5. Every family whose margin is above the threshold is predicted, so a line may hold several. A predicted family is
   confirmed if 60 % of the bigrams of one of its notices are in the paragraph, or 70 % of the paragraph's bigrams
   (six or more) are in the notice. Families are taken by margin: once one is confirmed, the next must be confirmed by
   bigrams that no notice of the families before it holds (two at least, 60 % of them), so that a notice doesn't count
   again for its relatives (GPL and AGPL, CC BY and CC BY-SA).

Result, one row per input row: doc_id, n_paragraphs, n_predicted and n_confirmed (paragraphs with such a family),
families (confirmed, sorted), score (highest probability of a confirmed family, else 0). Defined results: null, empty
or blank texts have no paragraph and no family. Repeated paragraphs count each. Rows that share a doc_id share the union of
their findings; a null doc_id is matched like any other value. Extra columns are not read. Empty tables give
no rows; very long texts are exploded whole.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, StringIndexer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caretrail.llm.common import Stages, table

VARIANTS = 24
UNKNOWN_ROWS = 3000
RARE = 0.01
PENALTY = 0.002
FALSE_ALARM = 0.001
COVER_NOTICE, COVER_PARAGRAPH, LEAST_BIGRAMS, LEAST_OWN = 0.6, 0.7, 6, 2
#: range of the hash that a sample is drawn by, and how many more rows than wanted the hash lets through
HASHES, SURPLUS = 1 << 30, 3

#: fixed values: customary notices of each family
NOTICES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GPL version 2 or later.",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You can redistribute this library and/or modify it under the terms of the GNU Lesser General Public License.",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0.",
    ),
    "proprietary": (
        "Copyright by the publisher. All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without the prior written permission of the publisher.",
    ),
}
#: fixed values: sentences with the same vocabulary that grant nothing
DECOYS = (
    "The driver showed his license to the officer and drove on.", "She was released from hospital under the care of her doctor.",
    "You need a fishing license and the permission of the land owner.", "The general public is invited to the library on Sunday.",
    "A new version of the work was shown in the public garden.", "Students may use the software in the lab free of charge.",
    "The mozilla is a figure in an old story.", "Apache helicopters flew over the valley.", "The MIT campus lies by the river.",
    "The above picture shows a copy of the letter.", "All rights come with duties.", "The author waived his fee for the evening.",
    "The foundation published its terms for the prize.", "The commons voted on the bill last night.",
)


def _words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), "[^a-z0-9]+"), lambda w: w != "")


def _bigrams(words: Column) -> Column:
    return F.when(F.size(words) > 1, F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1),
                                                lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(F.array().cast("array<string>"))


def _grams(words: Column) -> Column:
    return F.concat(words, _bigrams(words))


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, pos, line) of all lines with a word."""
    lines = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.posexplode(F.split(F.col(text_col).cast("string"), "\n")).alias("pos", "line"))
    return lines.where(F.lower("line").rlike("[a-z0-9]"))


def notices(spark: SparkSession) -> DataFrame:
    rows = [(family, i, text) for family, texts in NOTICES.items() for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "family string, notice int, line string").withColumn("words", _words(F.col("line")))


def _resembles(words: Column, spark: SparkSession) -> Column:
    """Whether half of a notice's bigrams are among those of the words."""
    own = _bigrams(words)
    return reduce(lambda a, b: a | b, [F.size(F.array_intersect(own, F.array(*map(F.lit, grams)))) >= max(1, len(grams) // 2)
                                       for _, grams in _notice_grams(spark)])


def training_rows(docs: DataFrame, total: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(family, words, grams): notices with their variants, decoys, and the unknown sample of the corpus's ``total`` paragraphs."""
    spark = docs.sparkSession
    base = notices(spark)
    variants = base.select("family", "words", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS))).alias("v"))
    thinned = F.filter(F.col("words"), lambda w, i: F.pmod(F.xxhash64(w, i, F.col("v")), F.lit(9)) > 0)
    half = F.slice(F.col("words"), (F.pmod(F.xxhash64("v"), F.lit(3)) + 1).cast("int"), F.greatest(F.lit(4), (F.size("words") * 0.8).cast("int")))
    known = variants.select("family", F.when(F.col("v") == 0, F.col("words")).when(F.col("v") % 3 == 0, half).otherwise(thinned).alias("words"))
    decoys = spark.createDataFrame([(x,) for x in DECOYS], "line string").select(_words(F.col("line")).alias("words"))
    drawn = F.pmod(F.xxhash64("line", F.lit(5)), F.lit(HASHES))
    sample = paragraphs(docs, id_col, text_col).where(drawn < int(HASHES * min(1.0, SURPLUS * UNKNOWN_ROWS / max(1, total))))
    sample = sample.select("line").distinct().orderBy(F.xxhash64("line", F.lit(5)), "line").limit(UNKNOWN_ROWS)
    sample = sample.select(_words(F.col("line")).alias("words")).distinct()
    unknown = decoys.union(sample.where(~_resembles(F.col("words"), spark))).select(F.lit("unknown").alias("family"), "words")
    return known.union(unknown).withColumn("grams", F.array_distinct(_grams(F.col("words"))))


def _notice_grams(spark: SparkSession) -> list[tuple[str, list[str]]]:
    """(family, distinct bigrams) of each notice."""
    return [(r[0], sorted(set(r[1]))) for r in notices(spark).select("family", _bigrams(F.col("words"))).collect()]


@dataclass(frozen=True)
class Model:
    """families (position = class), vocabulary rows (gram, w: weights by class), bias, threshold of a margin."""
    families: list[str]
    vocabulary: DataFrame
    bias: list[float]
    threshold: float = 0.0


def fit(docs: DataFrame, total: int, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The regression, not yet calibrated; ``total`` is the number of paragraphs of ``docs``."""
    spark = docs.sparkSession
    stages = Stages(spark, "licences")
    rows = stages.keep(training_rows(docs, total, id_col, text_col).select("family", "grams").coalesce(2), "training")
    unknown = rows.where("family = 'unknown'").count()
    seen = rows.select("family", F.explode("grams").alias("gram")).groupBy("gram").agg(
        F.sum((F.col("family") != "unknown").cast("long")).alias("known"), F.sum((F.col("family") == "unknown").cast("long")).alias("other"))
    vocabulary = [r[0] for r in seen.where((F.col("known") >= 2) & (F.col("other") <= max(2, RARE * unknown))).select("gram").orderBy("gram").collect()]
    indexer = StringIndexer(inputCol="family", outputCol="label", stringOrderType="alphabetAsc").fit(rows)
    counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features", minTF=1.0)
    counter.setBinary(True)
    ready = counter.transform(indexer.transform(rows))
    lr = LogisticRegression(family="multinomial", regParam=PENALTY, elasticNetParam=1.0, maxIter=60, standardization=False, aggregationDepth=2).fit(ready)
    stages.drop("training")
    weights = lr.coefficientMatrix.toArray()
    kept = [(g, [float(x) for x in weights[:, j]]) for j, g in enumerate(vocabulary) if abs(weights[:, j]).max() > 1e-6]
    return Model(list(indexer.labels), spark.createDataFrame(kept, "gram string, w array<double>"), [float(x) for x in lr.interceptVector])


def margins(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Paragraphs with a family more likely than `unknown`: doc_id, pos, line, copies (equal rows), z (by class), margin
    (the highest). Equal rows are one row, scored once."""
    grams = paragraphs(docs, id_col, text_col).select("doc_id", "pos", "line", F.explode(F.array_distinct(_grams(_words(F.col("line"))))).alias("gram"))
    hits = grams.join(F.broadcast(model.vocabulary), "gram")  # as many rows as the notices have n-grams
    # a line's n-grams are distinct, so equal rows show as a multiple of them
    sums = hits.groupBy("doc_id", "pos", "line").agg(*(F.sum(F.col("w")[i]).alias(f"z{i}") for i in range(len(model.families))),
                                                     (F.count("*") / F.size(F.collect_set("gram"))).cast("bigint").alias("copies"))
    z = F.array(*(F.col(f"z{i}") / F.col("copies") + F.lit(b) for i, b in enumerate(model.bias)))
    none = model.families.index("unknown")
    scored = sums.select("doc_id", "pos", "line", "copies", z.alias("z"))
    best = F.array_max(F.transform("z", lambda x, i: F.when(i != none, x)))
    return scored.withColumn("margin", best - F.col("z")[none]).where("margin > 0")


def calibrated(model: Model, scored: DataFrame, total: int) -> Model:
    """The model with its threshold, from the margins of all paragraphs above 0 and the number of all paragraphs.

    Those at 0 or below need no rows: of ``total`` paragraphs, ``FALSE_ALARM`` may lie above the threshold, and these
    are the first of the margins sorted downwards."""
    alike = _resembles(_words(F.col("line")), scored.sparkSession)
    unlike = scored.withColumn("alike", alike).select("alike", "margin", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    above = unlike.agg(F.count(F.when(~F.col("alike"), 1)).alias("n"), F.count(F.when(F.col("alike"), 1)).alias("known")).first()
    allowed = int(FALSE_ALARM * (total - above["known"]))
    if above["n"] <= allowed:
        return replace(model, threshold=0.0)
    share = 1 - allowed / above["n"]
    cut = unlike.where(~F.col("alike")).agg(F.percentile_approx("margin", share, 10000)).first()[0]
    return replace(model, threshold=max(0.0, float(cut)))


def paragraph_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_paragraphs."""
    lines = F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "\n")
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.size(F.filter(lines, lambda x: F.lower(x).rlike("[a-z0-9]"))).cast("bigint").alias("n_paragraphs"))


def _total(counts: DataFrame) -> int:
    return counts.agg(F.coalesce(F.sum("n_paragraphs"), F.lit(0))).first()[0]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model fitted to and calibrated on ``docs``."""
    stages = Stages(docs.sparkSession, "licence-margins")
    total = _total(paragraph_counts(docs, id_col, text_col))
    model = fit(docs, total, id_col, text_col)
    out = calibrated(model, stages.keep(margins(docs, model, id_col, text_col), "margins"), total)
    stages.drop("margins")
    return out


def confirmed_families(scored: DataFrame, model: Model) -> DataFrame:
    """Paragraphs of :func:`margins` above the threshold: doc_id, pos, line, families (predicted), confirmed (those
    whose notices are there, by margin), probability (highest of a confirmed one, NULL without any)."""
    none = model.families.index("unknown")
    theirs: dict[str, list[list[str]]] = {}
    for family, grams in _notice_grams(scored.sparkSession):
        theirs.setdefault(family, []).append(grams)
    notice_of = F.array(*(F.array(*(F.array(*map(F.lit, g)) for g in theirs.get(f, []))) if f in theirs else F.array(F.array(F.lit("")))
                          for f in model.families))  # the fixed notices, by class
    ranked = F.filter(F.transform("z", lambda x, i: F.struct((x - F.col("z")[none]).alias("margin"), i.alias("k"))),
                      lambda c: (c["k"] != none) & (c["margin"] > model.threshold))
    rows = scored.where(F.col("margin") > model.threshold).withColumns(
        {"ranked": F.sort_array(ranked, asc=False), "own": F.array_distinct(_bigrams(_words(F.col("line"))))})

    def step(acc: Column, c: Column) -> Column:
        def fits(t: Column) -> Column:
            free = F.array_except(t, acc["seen"])
            rest = (F.size(free) >= LEAST_OWN) & (F.size(F.array_intersect(F.col("own"), free)) >= COVER_NOTICE * F.size(free))
            return _close(F.col("own"), t) & ((F.size(acc["found"]) == 0) | rest)
        notices_ = F.get(notice_of, c["k"])
        more = F.struct(F.concat(acc["found"], F.array(c["k"])).alias("found"), F.array_union(acc["seen"], F.flatten(notices_)).alias("seen"))
        return F.when(F.exists(notices_, fits), more).otherwise(acc)

    empty = F.struct(F.array().cast("array<int>").alias("found"), F.array().cast("array<string>").alias("seen"))
    names = F.array(*map(F.lit, model.families))
    top = F.array_max("z")
    total = F.aggregate("z", F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
    rows = rows.withColumn("found", F.aggregate("ranked", empty, step, lambda acc: acc["found"]))
    return rows.select("doc_id", "pos", "line", F.transform("ranked", lambda c: F.get(names, c["k"])).alias("families"),
                       F.transform("found", lambda k: F.get(names, k)).alias("confirmed"),
                       F.array_max(F.transform("found", lambda k: F.exp(F.get(F.col("z"), k) - top) / total)).alias("probability"))


def _close(own: Column, theirs: Column) -> Column:
    both = F.size(F.array_intersect(own, theirs))
    return (both >= COVER_NOTICE * F.size(theirs)) | ((F.size(own) >= LEAST_BIGRAMS) & (both >= COVER_PARAGRAPH * F.size(own)))


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", *, scored: DataFrame | None = None,
         counts: DataFrame | None = None) -> DataFrame:
    """One row per input row; see the module docstring. ``scored`` and ``counts`` are the :func:`margins` and
    :func:`paragraph_counts` of ``docs``, where they are at hand."""
    if scored is None:
        scored = margins(docs, model, id_col, text_col)
    if counts is None:
        counts = paragraph_counts(docs, id_col, text_col)
    found = confirmed_families(scored, model).groupBy(F.col("doc_id").alias("found_id")).agg(
        F.count("*").alias("n_predicted"), F.count(F.when(F.size("confirmed") > 0, 1)).alias("n_confirmed"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("confirmed")))).alias("families"), F.max("probability").alias("score"))
    return counts.join(found, counts.doc_id.eqNullSafe(found.found_id), "left").select(
        "doc_id", "n_paragraphs", F.coalesce("n_predicted", F.lit(0)).alias("n_predicted"), F.coalesce("n_confirmed", F.lit(0)).alias("n_confirmed"),
        F.coalesce("families", F.array().cast("array<string>")).alias("families"), F.coalesce("score", F.lit(0.0)).alias("score"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stages = table(spark, sf_dir, "documents"), Stages(spark, "licence-scan")
    counts = stages.keep(paragraph_counts(docs), "counts")
    total = _total(counts)
    model = fit(docs, total)
    scored = stages.keep(margins(docs, model), "margins")
    return scan(docs, calibrated(model, scored, total), scored=scored, counts=counts)
