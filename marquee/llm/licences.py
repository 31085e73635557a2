"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

A notice stands on one line or is wrapped over several, with or without comment marks. Each line is scored on
its own, and each run of lines up to a line without words is scored whole, in overlapping windows of words that
hold any template as one. What is scored is turned into the set of its word unigrams and bigrams. A multinomial
logistic regression with an L1 penalty, so that most n-grams weigh nothing, gives the chance of each licence
family and of `unknown`. The chances are calibrated by a temperature fitted on held-out paragraphs, and a
family counts only above a threshold that few held-out unknown paragraphs pass. A prediction is confirmed
if one of the family's templates is mostly contained in it. A run gives a row per family and template that is
confirmed in one of its windows (the best) but on none of that window's lines alone; lines of such a window that
are unconfirmed pieces of the same family give none.

The classifier is trained on the fixed templates below and variants of them, not on the corpus; all texts
are scanned whole. Training and scanning are DataFrame operations (Spark ML and SQL functions).

Null and empty texts have no paragraphs. Lines and runs of any length are read whole. Rows that repeat are scanned each, and give each a row. Paragraphs
without any n-gram that weighs are unknown and give no row. Other columns are not looked at. An empty table
gives an empty result.
"""

from __future__ import annotations

import json
import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.text import let
from marquee.session import checkpointed

UNKNOWN = "unknown"
CONTAINED = 0.6
FALSE_SHARE = 0.01
VARIANTS = 14
REGULARISATION = 0.0015

#: Wordings of public licence notices, by family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU GPL version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ),
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Available under the Creative Commons Attribution license.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Available under the Creative Commons Attribution-NonCommercial license.",
    ),
    "cc0": (
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain.",
        "This is free and unencumbered software released into the public domain.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright the authors. All rights reserved.",
        "No part of this publication may be reproduced, distributed or transmitted in any form without the prior written permission of the publisher.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ),
}
#: Sentences with words of licences that grant nothing.
OTHERS = (
    "The driver showed the officer a valid license and drove on.",
    "Her version of the story was released to the public in the morning.",
    "You can obtain a copy of the report at the front desk, free of charge.",
    "The apache helicopter landed under heavy rain.",
    "He studied at MIT before the company was founded.",
    "Any person without permission shall not enter the building.",
    "The foundation published a notice about the conditions of the road.",
    "In general the public was included in the work of the committee.",
    "Rights of the workers were discussed in source after source.",
    "The software was distributed on disks and used by many people.",
    "This file is a list of the words used in the documentation.",
    "The commons were open to all, with or without the consent of the lord.",
    "A creative person may use this form of attribution in the text.",
    "The author has reserved a table for all of us.",
    "The program can be found in the library, along with the terms of use.",
    "A license is required by law to modify the source of the river.",
    "The international version of the work is subject to change.",
    "Copies of the agreement must be provided in writing to the other party.",
    "Mozilla and the free software community met in public.",
    "The law applies to every person in this domain, to the extent possible.",
)
STOP_WORDS = frozenset("a all also an and any are as at be by can for from has have if in is it no not of on or other shall should that the their this to was were with you".split())


def word_array(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    plain = F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))
    return F.split(plain, " ")


def ngrams(words: str) -> Column:
    """Distinct unigrams and bigrams."""
    pairs = F.when(
        F.size(words) > 1,
        F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.slice(words, i, 2))),
    ).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.col(words), pairs))


def _terms(text: str) -> set[str]:
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
    found = {w for w in words if w not in STOP_WORDS}
    return found | {f"{a} {b}" for a, b in zip(words, words[1:]) if not {a, b} <= STOP_WORDS}


def vocabulary() -> list[str]:
    """All n-grams of the templates but stop words."""
    return sorted({t for texts in TEMPLATES.values() for x in texts for t in _terms(x)})


def examples(seed: int = 8) -> list[tuple[str, str, bool]]:
    """(paragraph, family, held out): templates, whole and with words lost, cut off or put in, and unknown ones."""
    rng = random.Random(seed)
    everything = [w for texts in TEMPLATES.values() for x in texts for w in x.split()]
    out = []
    for family, texts in TEMPLATES.items():
        for text in texts:
            words = text.split()
            out += [(text, family, False)] * 3
            for i in range(VARIANTS):
                some = [w for w in words if rng.random() > 0.12] if len(words) > 4 else list(words)
                if len(some) > 12 and rng.random() < 0.4:
                    some = some[: rng.randint(10, len(some))]
                noise = [f"zz{rng.randrange(10**6)}" for _ in range(rng.randint(0, 12))]
                at = rng.randint(0, len(noise))
                out.append((" ".join(noise[:at] + some + noise[at:]), family, i % 4 == 0))
    for i in range(220):
        out.append((" ".join(rng.sample(everything, rng.randint(1, 7))), UNKNOWN, i % 4 == 0))
    for i in range(10):
        for text in OTHERS:
            words = [w for w in text.split() if rng.random() > 0.1]
            out.append((text if i == 0 else " ".join(words), UNKNOWN, i % 4 == 3))
    out += [(f"zz{i}", UNKNOWN, i % 4 == 0) for i in range(40)]
    return out


def _frame(spark: SparkSession, rows: list[dict], kinds: str) -> DataFrame:
    """A small fixed table, read from one JSON literal."""
    found = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{kinds}>>")
    return spark.range(1).select(F.explode(found).alias("r")).select("r.*")


def _constants(values: list[str]) -> Column:
    """An array of fixed texts without line breaks."""
    return F.split(F.lit("\n".join(values)), "\n")


class Classifier:
    """Weights per n-gram, intercepts, temperature and threshold of a fitted model."""

    def __init__(self, families: list[str], weights: dict[str, list[float]], intercepts: list[float], temperature: float = 1.0, threshold: float = 0.5):
        self.families, self.weights, self.intercepts = families, weights, intercepts
        self.temperature, self.threshold = temperature, threshold

    def table(self, spark: SparkSession) -> DataFrame:
        """term, w: one row per n-gram of the templates; most weigh nothing."""
        nothing = [0.0] * len(self.families)
        rows = [{"term": t, "w": [float(x) for x in self.weights.get(t, nothing)]} for t in vocabulary()]
        return _frame(spark, rows, "term: string, w: array<double>")

    def chances(self, sums: Column) -> Column:
        """Calibrated chances per class from the summed weights."""
        logits = F.transform(F.zip_with(sums, F.array(*[F.lit(float(b)) for b in self.intercepts]), lambda s, b: s + b), lambda x: x / self.temperature)
        top = F.array_max(logits)
        powers = F.transform(logits, lambda x: F.exp(x - top))
        return F.transform(powers, lambda p: p / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def _summed(paragraphs: DataFrame, classifier: Classifier, keys: list[str]) -> DataFrame:
    """Sum of the weights of each paragraph's n-grams, as an array `sums`; paragraphs without any are left out."""
    spark, n = paragraphs.sparkSession, len(classifier.families)
    terms = paragraphs.select(*keys, F.explode("grams").alias("term"))
    weighed = terms.join(F.broadcast(classifier.table(spark)), "term")  # bounded by the templates
    sums = weighed.groupBy(*keys).agg(*[F.sum(F.col("w")[i]).alias(f"s{i}") for i in range(n)])
    return sums.select(*keys, F.array(*[f"s{i}" for i in range(n)]).alias("sums"))


def fit(spark: SparkSession) -> Classifier:
    """Train on the examples that are not held out; calibrate on the held-out ones."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel

    rows = [{"id": i, "text": text, "family": family, "held": held} for i, (text, family, held) in enumerate(examples())]
    data = _frame(spark, rows, "id: int, text: string, family: string, held: boolean")
    families = [*TEMPLATES, UNKNOWN]
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")).cast("double") - 1
    grams = data.withColumn("words", word_array(F.col("text"))).withColumn("grams", ngrams("words")).withColumn("label", label)
    terms = vocabulary()
    vectors = CountVectorizerModel.from_vocabulary(terms, inputCol="grams", outputCol="features")
    vectors.setBinary(True)
    prepared = vectors.transform(grams).select("id", "grams", "label", "held", "features")
    model = LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=REGULARISATION, maxIter=60, standardization=False).fit(prepared.where("not held"))
    w = model.coefficientMatrix.toArray()
    weights = {t: w[:, i].tolist() for i, t in enumerate(terms) if abs(w[:, i]).max() > 1e-6}
    classifier = Classifier(families, weights, model.interceptVector.toArray().tolist())
    held = prepared.where("held").select("id", "grams", "label")
    scored = held.select("id", "label").join(_summed(held, classifier, ["id"]), "id", "left")
    none = F.array(*[F.lit(0.0)] * len(families))
    scored = scored.withColumn("sums", F.coalesce("sums", none))
    losses = []
    for t in (0.5, 0.7, 1.0, 1.4, 2.0, 2.8):
        trial = Classifier(families, weights, classifier.intercepts, t)
        own = F.element_at(trial.chances(F.col("sums")), F.col("label").cast("int") + 1)
        losses.append(F.avg(-F.log(own + 1e-12)).alias(str(t)))
    found = scored.agg(*losses).first().asDict()
    classifier.temperature = float(min(found, key=found.get))
    best = F.array_max(F.slice(classifier.chances(F.col("sums")), 1, len(families) - 1))
    passed = scored.where(F.col("label") == len(families) - 1).agg(F.percentile(best, F.lit(1 - FALSE_SHARE)).alias("p")).first()["p"]
    classifier.threshold = max(0.5, float(passed))
    return classifier


def template_table(spark: SparkSession) -> DataFrame:
    """family, templates: one row per family, each template with its bigrams that are in the vocabulary."""
    rows = [{"family": f, "template": i, "text": t} for f, texts in TEMPLATES.items() for i, t in enumerate(texts)]
    plain = _frame(spark, rows, "family: string, template: int, text: string").withColumn("words", word_array(F.col("text")))
    known = _constants([t for t in vocabulary() if " " in t])
    parts = plain.select("family", "template", F.array_intersect(ngrams("words"), known).alias("parts"))
    return parts.groupBy("family").agg(F.collect_list(F.struct("template", "parts")).alias("templates"))


def longest_template() -> int:
    """Words of the longest template."""
    return max(len("".join(c if c.isascii() and c.isalnum() else " " for c in x).split()) for texts in TEMPLATES.values() for x in texts)


def unit_rows(rows: DataFrame, step: int) -> DataFrame:
    """What is scored of rows (doc_id, row, text), as (doc_id, row, run, first, last, words): every line with words
    (run null), and every run of lines up to one without words in windows of 2 * step words, `step` apart, so that any
    `step` words lie in one window. Windows within one line are left out. `run`, `first` and `last` are numbers of
    lines, from 0. Runs are cut as texts, in which `#<line># ` precedes each line; words are split after that."""
    plain = F.split(F.regexp_replace(F.lower("text"), "[^a-z0-9\n]+", " "), "\n")
    kind = "array<struct<run: int, line: int, piece: string>>"

    def of_run(run: Column) -> Column:
        chunks = F.regexp_extract_all(run, F.lit("(?:\n?(?:#[0-9]+# )?[a-z0-9]+ ?){1,%d}" % step), F.lit(0))
        at = F.regexp_extract(run, "^#([0-9]+)#", 1).cast("int")
        pairs = let(chunks, lambda c: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(c) - 1)), lambda i: F.concat(F.get(c, i - 1), F.coalesce(F.get(c, i), F.lit("")))))
        return F.transform(F.filter(pairs, lambda w: F.instr(F.substring(w, 2, 2**30), "\n") > 0), lambda w: F.struct(at.alias("run"), F.lit(None).cast("int").alias("line"), w.alias("piece")))

    def of_lines(lines: Column) -> Column:
        each = F.transform(lines, lambda x, i: F.struct(F.lit(None).cast("int").alias("run"), i.alias("line"), F.trim(x).alias("piece")))
        numbered = F.array_join(F.transform(lines, lambda x, i: F.when(F.trim(x) == "", "").otherwise(F.concat(F.lit("#"), i.cast("string"), F.lit("# "), F.trim(x)))), "\n")
        runs = F.filter(F.split(F.btrim(numbered, F.lit("\n")), "\n\n+"), lambda r: r.contains("\n"))
        return F.concat(F.filter(each, lambda u: u["piece"] != "").cast(kind), F.flatten(F.transform(runs, of_run)).cast(kind))

    pieces = rows.select("doc_id", "row", F.explode(let(plain, of_lines)).alias("u")).select("doc_id", "row", "u.*")
    number = F.regexp_extract("piece", "#([0-9]+)#", 1).cast("int") - F.when(F.col("piece").rlike("^\n?#"), 0).otherwise(1)
    first = F.when(F.col("run").isNull(), F.col("line")).otherwise(number)
    last = F.when(F.col("run").isNull(), F.col("line")).otherwise(F.regexp_extract("piece", "(?s).*#([0-9]+)#", 1).cast("int"))
    bare = F.when(F.col("run").isNull(), F.col("piece")).otherwise(F.trim(F.regexp_replace("piece", "\n?#[0-9]+# ", " ")))
    return pieces.select("doc_id", "row", "run", first.alias("first"), last.alias("last"), F.split(bare, " ").alias("words"))


def scan(docs: DataFrame, classifier: Classifier | None = None) -> DataFrame:
    """doc_id, paragraph (its first line in the text), lines (how many), family, probability, template, contained,
    confirmed: one row for each line or wrapped paragraph that is predicted to be a licence notice."""
    spark = docs.sparkSession
    classifier = classifier or fit(spark)
    n = len(classifier.families)
    marks = sorted({w for t in vocabulary() for w in t.split() if w not in STOP_WORDS})
    # `row` and `place` tell repeated rows and units apart
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    marked = unit_rows(rows, longest_template()).where(F.arrays_overlap("words", _constants(marks)))  # others have no n-gram that weighs
    keys = ["doc_id", "row", "run", "first", "last", "place"]
    numbered = marked.withColumn("place", F.monotonically_increasing_id())
    terms = numbered.select(*keys, F.explode(ngrams("words")).alias("term"))
    weighed = terms.join(F.broadcast(classifier.table(spark)), "term")  # bounded by the templates
    sums = weighed.groupBy(*keys).agg(
        *[F.sum(F.col("w")[i]).alias(f"s{i}") for i in range(n)], F.collect_list(F.when(F.col("term").contains(" "), F.col("term"))).alias("pairs")
    )  # at most the vocabulary
    chances = sums.select(*keys, "pairs", F.array(*[f"s{i}" for i in range(n)]).alias("sums")).select(*keys, "pairs", classifier.chances(F.col("sums")).alias("p"))
    top = F.array_max(F.slice("p", 1, n - 1))
    family = F.element_at(F.array(*[F.lit(f) for f in classifier.families]), F.array_position("p", F.col("probability")).cast("int"))
    named = chances.withColumn("probability", top).withColumn("family", family)
    licences = named.where((F.col("probability") >= classifier.threshold) & (F.col("probability") > F.element_at("p", n)))
    compared = licences.join(F.broadcast(template_table(spark)), "family").withColumn(  # one row per family
        "best",
        F.array_max(F.transform("templates", lambda t: F.struct((F.size(F.array_intersect(t["parts"], F.col("pairs"))) / F.size(t["parts"])).alias("contained"), t["template"].alias("template")))),
    )
    found = compared.select("doc_id", "row", "run", "first", "last", "place", "family", "probability", "best.template", "best.contained")
    return _settled(found.withColumn("confirmed", F.col("contained") >= CONTAINED))


def _settled(found: DataFrame) -> DataFrame:
    """Lines and windows that say the same of a document, as one row each.

    All goes by (row, family): a handful of notices of one document, whatever the corpus holds.
    """
    found = checkpointed(found.where(F.col("run").isNull() | F.col("confirmed")))
    lines, windows = found.where("run is null"), found.where("run is not null")
    alone = lines.where("confirmed").select("row", "family", "template", F.col("first").alias("at"))
    inside = F.col("at").between(F.col("first"), F.col("last"))
    wrapped = windows.alias("w").join(alone.alias("a"), (F.col("w.row") == F.col("a.row")) & (F.col("w.family") == F.col("a.family")) & (F.col("w.template") == F.col("a.template")) & inside, "left_anti")
    best = F.max_by(F.struct("first", "last", "probability", "contained"), F.struct("contained", "probability", -F.col("first")))
    wrapped = wrapped.groupBy("doc_id", "row", "run", "family", "template").agg(best.alias("b"))
    wrapped = checkpointed(wrapped.select("doc_id", "row", "family", "template", "b.*", F.lit(True).alias("confirmed")))
    around = wrapped.select("row", "family", F.col("first").alias("from"), F.col("last").alias("to"))
    piece = ~F.col("l.confirmed") & F.col("l.first").between(F.col("from"), F.col("to"))
    whole = lines.alias("l").join(around.alias("a"), (F.col("l.row") == F.col("a.row")) & (F.col("l.family") == F.col("a.family")) & piece, "left_anti")
    rows = whole.drop("run", "place").unionByName(wrapped)
    return rows.select(
        "doc_id", F.col("first").cast("long").alias("paragraph"), (F.col("last") - F.col("first") + 1).cast("long").alias("lines"),
        "family", "probability", "template", "contained", "confirmed",
    )
