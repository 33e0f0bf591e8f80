"""Licence notices in paragraphs, by a trained classifier.

A paragraph is a line of a text. A multinomial logistic regression over the word one- and two-grams of the
licence templates is trained on their sentences, whole and in part, against all paragraphs of the corpus
that name no licence (class `none`, which together weigh NONE_WEIGHT examples). All these paragraphs also
calibrate the unknown class: a prediction under the probability, in steps of 1 / STEPS, that all but one in a
thousand of them stay below is `unknown`. A prediction also has to be confirmed by template comparison: at
least CONFIRM of the word three-grams of one of the family's sentences are in the paragraph; else it is
`unknown`. Everything is DataFrame functions and the JVM's estimators.

How it runs: paragraphs with the same grams of the templates are the same example, so one aggregation
counts them by these grams, and the model and the calibration read the counts. A second pass predicts
every paragraph.

Defined cases: a null or empty text has no paragraphs; a paragraph without words is skipped; rows that
repeat a doc_id are each scanned; a null doc_id stays null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeloom.session import materialize

#: Sentences of public licence notices.
TEMPLATES = {
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "This project is released under the Apache 2.0 license.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "You can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    ],
    "mpl-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "public-domain": [
        "This work is dedicated to the public domain under CC0 1.0.",
        "This is free and unencumbered software released into the public domain.",
    ],
    "proprietary": [
        "All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
    ],
}
FAMILIES = ["none", *TEMPLATES]
#: Words that only a licence notice has; a paragraph with one is no example of `none`.
NAMED = r"(?i)licen[cs]e|copyright|public domain|all rights reserved|redistribut|creative commons"
NONE_WEIGHT = 2000.0
STEPS = 10_000
CONFIRM = 0.8


def _words(text):
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}.-]+|[.-]+(?=\s|$)"), "")


def _terms(rows: DataFrame) -> DataFrame:
    """Adds `_terms`, the one- and two-grams, to rows with `words`."""
    rows = NGram(n=2, inputCol="words", outputCol="_two").transform(rows)
    return rows.withColumn("_terms", F.concat("words", "_two")).drop("_two")


def _once(rows: DataFrame, value, name: str) -> DataFrame:
    """Adds a column that filters on it do not compute again: the optimizer moves none below an outer explode."""
    return rows.select("*", F.explode_outer(F.array(value)).alias(name))


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, text and words of the lines with a word of documents (doc_id, text)."""
    rows = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "text"))
    return _once(rows, _words("text"), "words").where("size(words) > 0")


def _templates(spark: SparkSession) -> DataFrame:
    """(family, text)"""
    return spark.createDataFrame([(k, t) for k, texts in TEMPLATES.items() for t in texts], "family string, text string")


def _examples(spark: SparkSession) -> DataFrame:
    """(label, words): each template sentence, and its first and last words in several lengths, while they name the family."""
    rows = _templates(spark).select("family", _words("text").alias("words"))
    cut = F.greatest(F.lit(2), F.ceil(F.size("words") * F.col("share")).cast("int"))
    rows = rows.withColumn("share", F.explode(F.array(*map(F.lit, [0.7, 0.85, 1.0]))))
    rows = rows.select("family", F.explode(F.array(F.slice("words", F.lit(1), cut), F.slice("words", F.greatest(F.lit(1), F.size("words") - cut + 1), cut))).alias("words"))
    label = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")) - 1
    return rows.select(label.cast("double").alias("label"), "words", F.lit(1.0).alias("weight"))


def _features(spark: SparkSession) -> Callable[[DataFrame], DataFrame]:
    """What adds `features` to rows with `words`: which grams of the templates they have."""
    terms = _terms(_templates(spark).withColumn("words", _words("text"))).select(F.explode("_terms")).distinct()
    vectors = CountVectorizerModel.from_vocabulary(sorted(r[0] for r in terms.collect()), "_terms", "features").setBinary(True)
    return lambda rows: vectors.transform(_terms(rows)).drop("_terms")


def unnamed(lines: DataFrame, features: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """features and n: how many of all paragraphs that name no licence have them."""
    plain = lines.where(~F.col("text").rlike(NAMED)).select("words")
    return features(plain).groupBy("features").agg(F.count("*").alias("n"))


def _limit(rows: DataFrame) -> float:
    """The least step that all but one in a thousand of the paragraphs (probability, n) stay below."""
    steps = rows.groupBy(F.floor(F.col("probability") * STEPS).alias("step")).agg(F.sum("n").alias("n")).collect()
    left, limit = sum(r["n"] for r in steps) / 1000, 0
    for r in sorted(steps, key=lambda r: -r["step"]):
        left -= r["n"]
        if left < 0:
            limit = r["step"] + 1
            break
    return limit / STEPS


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, family, probability, similarity, predicted (the family before the checks) of each licence notice."""
    spark = docs.sparkSession
    lines, features = paragraphs(docs), _features(spark)
    none = materialize(unnamed(lines, features), "licence-none")
    total = none.agg(F.sum("n")).first()[0] or 1
    examples = features(_examples(spark)).select("label", "features", "weight").union(
        none.select(F.lit(0.0), "features", F.col("n") * (NONE_WEIGHT / total)))
    model = LogisticRegression(regParam=1e-3, maxIter=60, weightCol="weight", family="multinomial").fit(
        materialize(examples, "licence-examples"))

    def predicted(rows: DataFrame) -> DataFrame:
        rows = _once(model.transform(rows), vector_to_array("probability"), "_p")
        best = F.array_max(F.slice("_p", 2, len(TEMPLATES)))
        return rows.select(*[c for c in rows.columns if c not in ("features", "rawPrediction", "probability", "prediction", "_p")],
                           best.alias("probability"), F.get("_p", F.lit(0)).alias("p_none"),
                           F.get(F.array(*map(F.lit, FAMILIES)), F.array_position("_p", best).cast("int") - 1).alias("predicted"))

    limit = max(0.5, _limit(predicted(none)))
    found = predicted(features(lines)).where("p_none < 0.5")
    grams = NGram(n=3, inputCol="words", outputCol="three")
    known = grams.transform(_templates(spark).withColumn("words", _words("text"))).groupBy("family").agg(
        F.collect_list("three").alias("templates"))
    found = grams.transform(found).join(F.broadcast(known), F.col("predicted") == F.col("family"), "left").drop("family")
    similarity = F.array_max(F.transform("templates", lambda t: F.when(
        F.size(t) > 0, F.size(F.array_intersect(t, F.col("three"))) / F.size(F.array_distinct(t))).otherwise(F.lit(0.0))))
    found = found.withColumn("similarity", F.coalesce(similarity, F.lit(0.0)))
    sure = (F.col("probability") >= limit) & (F.col("similarity") >= CONFIRM)
    return found.select("doc_id", "line_no", F.when(sure, F.col("predicted")).otherwise("unknown").alias("family"),
                        "probability", "similarity", "predicted")
