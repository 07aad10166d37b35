"""Licence families of paragraphs, with DataFrame functions and Spark's own learning only.

Each line of a text is a paragraph. Its words and pairs of words are hashed to a sparse vector and a multinomial
logistic regression gives a probability for each family and for ``unknown``. The model is trained at each call on
notices of each family with words left out, on sentences that only sound like licences, and on a bounded
sample of the corpus (``BACKGROUND`` whole lines in the order of a hash, without those that share two words
in a row with a notice more than once). The cut below which a paragraph is unknown is calibrated on a
second such sample: at most one in a thousand of its lines may pass. Then the paragraph is compared
with the notices of the predicted family, and stays only if at least ``CONFIRM`` of its pairs of words, or of the
notice's, are shared.

All paragraphs of all documents are scored in one pass without a shuffle.

Defined results: one row (doc_id, paragraph, family, probability, similarity) for each confirmed paragraph;
null and empty texts and lines without words give none. Repeated rows give their rows again, a null
id is carried. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vialume.llm.common import smallest_hashes, stored, table, text_or_empty

QUERY = "op5_license_scan"
FEATURES = 1 << 14
BACKGROUND = 3000
CONFIRM = 0.6
#: Each round of the training adds up the weights of all families from each task.
TRAINING_TASKS = 4
UNKNOWN = "unknown"

#: Short notices by family, as projects put them into their files.
NOTICES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "This file is made available under the Apache License 2.0; you may not use it except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0"),
    "MIT": (
        "Released under the MIT License.", "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.", "SPDX-License-Identifier: MIT"),
    "BSD": (
        "Distributed under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted.", "SPDX-License-Identifier: BSD-3-Clause"),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software; you can redistribute it under the terms of the GNU GPL version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later"),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.", "Released under the LGPL version 3.",
        "SPDX-License-Identifier: LGPL-2.1-only"),
    "AGPL": (
        "This software is licensed under the GNU Affero General Public License, version 3.", "Available under the AGPL version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only"),
    "MPL-2.0": (
        "This file is subject to the terms of the Mozilla Public License, version 2.0.", "Licensed under the MPL 2.0.",
        "SPDX-License-Identifier: MPL-2.0"),
    "CC-BY": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 License."),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 License."),
    "CC0": ("Dedicated to the public domain under CC0 1.0.", "To the extent possible under law, all copyright and related rights are waived."),
    "Unlicense": ("This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"),
}
#: Sentences about licences that are none.
DECOYS = (
    "The driving licence has to be renewed every five years.", "A licence fee is due at the begin of the year.", "The museum is open to the public.",
    "The pub lost its licence last month.", "Version 2.0 of the report was released under pressure.", "Permission to land was granted.",
    "The general public was invited.", "The work was done in common.", "A free copy of the software was sold.", "He was licensed as a pilot.",
)


def words_of(text: Column) -> Column:
    """Lower-case runs of letters, digits, points and hyphens, without points and hyphens at their ends."""
    parts = F.split(F.btrim(F.lower(text), F.lit(".-")), r"[.\-]*[^\p{L}\p{N}.\-]+[.\-]*")
    return F.filter(parts, lambda w: w != "")


def pairs_of(words: Column) -> Column:
    first = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    second = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.zip_with(first, second, lambda a, b: F.concat(a, F.lit(" "), b))


def with_features(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the columns _pairs and _features of the column ``text``."""
    rows = df.withColumn("_words", words_of(F.col(text))).withColumn("_pairs", pairs_of(F.col("_words")))
    rows = rows.withColumn("_grams", F.concat("_words", "_pairs")).drop("_words")
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="_grams", outputCol="_features").transform(rows).drop("_grams")


def variants(notice: str) -> list[str]:
    """The notice, without one of its words each, framed, and repeated in part."""
    words = notice.split()
    less = [" ".join(words[:i] + words[i + 1:]) for i in range(len(words))] if len(words) > 4 else []
    return [notice, notice, notice.upper(), f"{notice} All files.", f"Note: {notice}", f"# {notice}", *less]


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, number from 0 and text of each line."""
    return docs.select("doc_id", F.posexplode(F.split(text_or_empty(), "\n", -1)).alias("paragraph", "_line"))


def notice_table(spark: SparkSession) -> DataFrame:
    rows = pd.DataFrame([(f, n) for f, notices in NOTICES.items() for n in notices], columns=["family", "notice"])
    return spark.createDataFrame(rows, "family string, notice string").select("family", pairs_of(words_of(F.col("notice"))).alias("notice_pairs"))


def train(docs: DataFrame):
    """The model, its families by number, and the calibrated cut."""
    spark = docs.sparkSession
    families = [UNKNOWN, *NOTICES]
    number = {f: float(i) for i, f in enumerate(families)}
    known = sorted({p for r in notice_table(spark).collect() for p in r["notice_pairs"]})
    sample = smallest_hashes(paragraphs(docs), ["doc_id", "paragraph"], 2 * BACKGROUND)
    shared = F.size(F.array_intersect(pairs_of(words_of(F.col("_line"))), F.array(*map(F.lit, known))))
    lines = stored(sample.where(shared < 2).select("_line", (F.xxhash64("doc_id", "paragraph") % 2 == 0).alias("learned")), "background")
    rows = [(number[f], v) for f, notices in NOTICES.items() for n in notices for v in variants(n)]
    rows += [(0.0, t) for t in [*DECOYS * 5, "", "word"]]
    texts = spark.createDataFrame(pd.DataFrame(rows, columns=["label", "text"]), "label double, text string")
    texts = texts.unionByName(lines.where("learned").select(F.lit(0.0).alias("label"), F.col("_line").alias("text")))
    examples = with_features(texts, "text").orderBy("label", "text").select("label", "_features").coalesce(TRAINING_TASKS).persist()
    model = LogisticRegression(featuresCol="_features", labelCol="label", probabilityCol="_p", regParam=0.0005, maxIter=60, family="multinomial").fit(examples)
    examples.unpersist()
    cut = 0.5
    rest = with_features(lines.where("NOT learned"), "_line")
    best = F.array_max(F.slice(vector_to_array("_p"), 2, len(families) - 1))
    if held := [r[0] for r in model.transform(rest).select(best).collect()]:  # a number for each sampled line
        cut = max(cut, rest_quantile(held))
    return model, families, cut


def rest_quantile(values: list[float]) -> float:
    return sorted(values)[min(len(values) - 1, int(len(values) * 0.999))]


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph, family, probability and similarity of each confirmed paragraph."""
    model, families, cut = train(docs)
    rows = model.transform(with_features(paragraphs(docs), "_line"))
    p = F.slice(vector_to_array("_p"), 2, len(families) - 1)
    rows = rows.select("doc_id", "paragraph", "_pairs", p.alias("_p")).withColumn("probability", F.array_max("_p"))
    rows = rows.where(F.col("probability") > cut)
    rows = rows.withColumn("family", F.element_at(F.array(*map(F.lit, families[1:])), F.array_position("_p", F.col("probability")).cast("int")))
    notices: dict[str, list] = {}
    for r in notice_table(docs.sparkSession).collect():  # the notices are fixed
        notices.setdefault(r["family"], []).append(F.array(*map(F.lit, r["notice_pairs"])))
    own = F.size(F.array_distinct("_pairs"))
    close = {f: F.greatest(F.lit(0.0), *[
        F.size(F.array_intersect("_pairs", n)) / F.greatest(F.lit(1), F.least(own, F.size(n))) for n in known]) for f, known in notices.items()}
    similarity = F.coalesce(*[F.when(F.col("family") == f, c) for f, c in close.items()])
    return rows.select("doc_id", "paragraph", "family", "probability", similarity.alias("similarity")).where(F.col("similarity") >= CONFIRM)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


SQL = None  # a trained model; tests/llm checks the planted notices
