"""Licence scans by a trained paragraph classifier, in built-in functions only.

A paragraph is what stands between blank lines, so that wrapped notices are read whole; marks of comments are no words.
Features are word bigrams, hashed, of words with versions and spellings made alike; a sparse multinomial logistic regression, fitted by Spark's own learner on the
notices below, on spans of them, and on a bounded sample of corpus text as the unknown class, gives each licence family
a probability. A temperature calibrates it, fitted on notices that a first fit has not seen; what has no family of
``CERTAIN`` or more is unknown (a quarter, as two licences in one window share it). A prediction counts only if
comparison with a template of that family confirms it: enough of the template's bigrams occur, or nearly all of the
text's are the template's, and one of them is in no other family's, or more of them than of any other family's template.
Templates are notices and short names alone and in phrases (``FORMS``, ``PHRASES``).

What is scored are windows of 8, 16 and 64 words that overlap by half (``WINDOWS``), over the whole of each paragraph:
long notices fill the wide ones, and where two licences are named close together the narrow ones tell them apart. All
paragraphs of all documents are scored: their bigrams are joined to the weights, a table bounded by the notices, and
those that have a weight are summed by window. The sample has at most ``SAMPLE`` distinct texts (those of least hash),
and ``PIECES`` windows of each.

Defined cases: null or empty texts have no paragraph; paragraphs of one word are unknown; a very long paragraph is
scanned whole; of equally near templates the first counts; repeated rows are judged row by row; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SAMPLE, PIECES, CERTAIN, OF_TEMPLATE, OF_PARAGRAPH, LEAST = 300, 16, 0.25, 0.6, 0.8, 3
WINDOWS = (8, 16, 64)
UNKNOWN = "unknown"
BLANK = "\\r?\\n[^\\S\\n]*(?:\\r?\\n[^\\S\\n]*)+"

#: How licences are named and their identifiers.
NAMES: dict[str, tuple[list[str], list[str]]] = {
    "AGPL": (["GNU Affero General Public License", "AGPL"], ["AGPL-3.0-or-later"]),
    "Apache": (["Apache License 2.0", "Apache 2.0 license"], ["Apache-2.0"]),
    "BSD": (["BSD License", "BSD 3-Clause License", "BSD 2-Clause License"], ["BSD-3-Clause", "BSD-2-Clause"]),
    "CC-BY": (["Creative Commons Attribution 4.0 International License"], ["CC-BY-4.0"]),
    "CC-BY-NC": (["Creative Commons Attribution-NonCommercial 4.0 International License"], ["CC-BY-NC-4.0"]),
    "CC-BY-SA": (["Creative Commons Attribution-ShareAlike 4.0 International License"], ["CC-BY-SA-4.0"]),
    "CC0": (["CC0 1.0 Universal"], ["CC0-1.0"]),
    "GPL": (["GNU General Public License", "GPL"], ["GPL-3.0-or-later", "GPL-2.0-only"]),
    "ISC": (["ISC License"], ["ISC"]),
    "LGPL": (["GNU Lesser General Public License", "LGPL"], ["LGPL-2.1-or-later"]),
    "MIT": (["MIT License"], ["MIT"]),
    "MPL": (["Mozilla Public License 2.0", "MPL 2.0"], ["MPL-2.0"]),
    "Unlicense": (["Unlicense"], ["Unlicense"]),
}

#: Notices by which licences are given, from their public texts.
TEMPLATES: dict[str, list[str]] = {
    "AGPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU Affero General Public License, version 3.",
    ],
    "Apache": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed.",
    ],
    "CC-BY": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-NC": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Released under CC0 1.0 Universal, public domain dedication."],
    "GPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "The software is provided \"as is\" and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness.", "Released under the ISC License."],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "Licensed under the GNU Lesser General Public License, version 3.",
    ],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.",
    ],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
}


#: Short names of licences; those of the first list say enough alone, those of the second in a phrase.
FORMS: dict[str, tuple[list[str], list[str]]] = {
    "AGPL": (["AGPLv3", "GNU AGPL", "Affero GPL"], ["AGPL", "Affero General Public License"]),
    "Apache": (["Apache 2.0", "Apache License 2", "Apache License Version 2.0"], ["Apache", "Apache 2", "Apache License", "Apache Software License"]),
    "BSD": (["3-clause BSD", "2-clause BSD", "three-clause BSD", "two-clause BSD", "BSD 3-clause", "BSD 2-clause", "simplified BSD", "BSD-style license"], ["BSD", "new BSD", "modified BSD", "BSD-style"]),
    "CC-BY": (["CC BY 4", "CC BY 3", "CC Attribution 4", "Creative Commons Attribution 4", "Creative Commons Attribution 3", "Creative Commons BY 4"], ["CC BY", "Creative Commons Attribution"]),
    "CC-BY-NC": (["CC BY-NC", "Creative Commons Attribution-NonCommercial", "Creative Commons BY-NC"], ["Creative Commons NonCommercial"]),
    "CC-BY-SA": (["CC BY-SA", "Creative Commons Attribution-ShareAlike", "Creative Commons BY-SA"], ["Creative Commons ShareAlike"]),
    "CC0": (["CC0 1.0", "public domain (CC0)", "Creative Commons Zero", "CC0 public domain", "CC0 waiver", "CC0 dedication"], ["CC0"]),
    "GPL": (["GPLv2", "GPLv3", "GNU GPL", "GNU General Public License"], ["GPL"]),
    "ISC": (["ISC-style license"], ["ISC", "ISC-style"]),
    "LGPL": (["LGPLv2", "LGPLv3", "GNU LGPL", "GNU Lesser General Public License", "GNU Library General Public License", "Lesser GPL"], ["LGPL"]),
    "MIT": (["MIT/X11 license", "MIT/Expat"], ["MIT", "Expat", "MIT-style"]),
    "MPL": (["MPL2", "Mozilla Public License"], ["MPL"]),
    "Unlicense": (["the Unlicense"], ["Unlicense"]),
}
PHRASES = ["{} license", "under {}", "under the {}", "under the {} license", "{} licensed", "license {}", "terms of the {} license", "subject to the {} license"]
#: Of these phrases a bigram is enough to look at a window.
TELLING = ["under {}", "{} license", "{} licensed", "license {}"]


def notices() -> list[tuple[str, str]]:
    """(family, text) of all notices: those above, and each name and identifier in its usual phrases."""
    out = [(f, t) for f, ts in TEMPLATES.items() for t in ts]
    for f, (names, marks) in NAMES.items():
        out += [(f, f"licensed under the {n}") for n in names] + [(f, f"SPDX-License-Identifier: {m}") for m in marks]
    for f, (alone, phrased) in FORMS.items():
        out += [(f, n) for n in alone] + [(f, _once(p.format(n))) for n in (*alone, *phrased) for p in PHRASES]
    return list(dict.fromkeys(out))


def _once(phrase: str) -> str:
    """A phrase without a second article or a second 'license' beside the name's own."""
    return phrase.replace("license license", "license").replace("License license", "license").replace("the the", "the")


def telling() -> set[tuple[str, str]]:
    """Bigrams of short names and of what says that they are a licence."""
    said = [_once(p.format(n)) for alone, phrased in FORMS.values() for n in (*alone, *phrased) for p in TELLING]
    return {g for t in said for w in [_plain(t)] for g in zip(w, w[1:])}


#: "version 2", "v2" and "v. 2" are "2"; "GPLv3" and "Apache2" are two words.
VERSION = "(?<![a-z0-9])v(?:er(?:sion)?)?[\\s.]*(?=[0-9])|v?(?=[0-9])(?:(?<=gpl|mpl|apache)|(?<=gplv|mplv))"


def words(text: Column) -> Column:
    """Words in lower case, in one spelling of 'licence' and of versions."""
    text = F.regexp_replace(F.replace(F.lower(text), F.lit("licenc"), F.lit("licens")), VERSION, " ")
    return F.filter(F.split(text, "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def pairs(w: Column, of) -> Column:
    """of(first, second) for each two words in a row."""
    n = F.greatest(F.size(w) - 1, F.lit(0))
    return F.zip_with(F.slice(w, F.lit(1), n), F.slice(w, F.lit(2), n), of)


def spoken(w: Column) -> Column:
    return pairs(w, lambda a, b: F.concat_ws(" ", a, b))


def templates(spark: SparkSession) -> DataFrame:
    """(template, family, words) of the notices."""
    rows = [{"template": i, "family": f, "text": t} for i, (f, t) in enumerate(notices())]
    return _rows(spark, rows, "template int, family string, text string").select("template", "family", words(F.col("text")).alias("words"))


def _rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table from one literal, which a plan carries more lightly than an expression for every value."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def examples(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(family, grams, held): whole notices many times, spans of them; the same backwards as unknown; windows of the
    corpus sample in which few bigrams are a notice's. held: of a notice that the first fit does not see."""
    own = templates(docs.sparkSession).withColumn("held", F.col("template") % 5 == 4)
    spans = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - 4), F.lit(3)), lambda i: F.slice(F.col("words"), i, F.lit(12)))
    spans = own.select("family", F.explode(F.filter(spans, lambda s: F.size(s) >= 5)).alias("words"), "held")
    backwards = spans.select(F.lit(UNKNOWN).alias("family"), F.reverse("words").alias("words"), "held").where("size(words) > 9")
    spans = own.select("family", F.explode(F.array_repeat(F.col("words"), F.when(F.size("words") > 9, 20).otherwise(6))).alias("words"), "held").union(spans)
    # about four times what is wanted passes by its hash, so that no task sends on more than a few texts
    texts = docs.agg(F.approx_count_distinct(F.col(text_col).cast("string")).alias("n")).first().n
    share = min(1.0, 4 * (sample + 50) / max(1, texts))
    rows = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null").withColumn("h", F.xxhash64("text"))
    rows = rows.where(F.pmod("h", F.lit(1 << 40)) <= int(share * (1 << 40))).groupBy("h").agg(F.min("text").alias("text")).orderBy("h").limit(sample)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w")), F.lit(WINDOWS[-1])), lambda i: F.slice(F.col("w"), i, F.lit(WINDOWS[-1])))
    lines = rows.select("h", words(F.col("text")).alias("w")).where("size(w) > 1").select("h", F.slice(cut, 1, PIECES).alias("c")).select("h", F.explode("c").alias("words")).where("size(words) > 1")
    known = sorted({f"{a} {b}" for _, t in notices() for w in [_plain(t)] for a, b in zip(w, w[1:])})
    lines = lines.withColumn("g", spoken(F.col("words"))).where(F.size(F.array_intersect("g", F.array(*map(F.lit, known)))) < 0.3 * F.size("g"))
    lines = lines.select(F.lit(UNKNOWN).alias("family"), "words", (F.pmod("h", F.lit(5)) == 4).alias("held"))
    return spans.union(backwards).union(lines).select("family", spoken(F.col("words")).alias("grams"), "held")


def _plain(text: str) -> list[str]:
    """The words of a notice; these hold ASCII only."""
    text = re.sub(VERSION.replace("(?<=gpl|mpl|apache)", "(?:(?<=[gm]pl)|(?<=apache))"), " ", text.lower().replace("licenc", "licens"))
    return "".join(c if c.isalnum() else " " for c in text).split()


def trained(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> tuple[DataFrame, list[str], list[float], float]:
    """(weights by hashed bigram, families, biases, temperature)."""
    from pyspark.ml.functions import vector_to_array

    spark = docs.sparkSession
    families = [*TEMPLATES, UNKNOWN]
    of = F.array_position(F.array(*map(F.lit, families)), F.col("family")).cast("double") - 1
    rows = examples(docs, text_col, sample).withColumn("label", of).coalesce(2).cache()  # bounded by the notices and the sample
    grams = templates(spark).select(spoken(F.col("words")).alias("grams"))
    counter = CountVectorizer(inputCol="grams", outputCol="features", binary=True).fit(grams.coalesce(1))
    learner = LogisticRegression(family="multinomial", maxIter=40, regParam=1e-4, elasticNetParam=0.5, standardization=False)
    seen = learner.fit(counter.transform(rows.where("not held")))
    logits = seen.transform(counter.transform(rows.where("held"))).select("label", vector_to_array("rawPrediction").alias("z"))
    grid = [0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]
    loss = [F.avg(F.log(F.aggregate(F.transform("z", lambda v: F.exp((v - F.element_at("z", F.col("label").cast("int") + 1)) / t)), F.lit(0.0), lambda a, b: a + b))).alias(str(i)) for i, t in enumerate(grid)]
    losses = logits.agg(*loss).first()
    temperature = min(zip((math.inf if x is None else x for x in losses), grid))[1]
    model = learner.fit(counter.transform(rows))
    rows.unpersist()
    margins = [float(b) for b in model.interceptVector]
    table = model.coefficientMatrix.toArray()
    told = telling()
    terms = [{"gram": t, "w": [float(x) for x in table[:, i]], "tells": tuple(t.split(" ")) in told} for i, t in enumerate(counter.vocabulary)]
    weights = _rows(spark, terms, "gram string, w array<double>, tells boolean")
    weights = weights.select(F.xxhash64(F.split("gram", " ")[0], F.split("gram", " ")[1]).alias("gram"), "w", "tells")
    return weights, families, margins, temperature


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, model=None) -> DataFrame:
    """(id, text_hash, paragraph, family, score, confirmed, template): the families that windows of a paragraph show."""
    weights, families, biases, temperature = model or trained(docs, text_col, sample)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.posexplode(F.split(F.col(text_col).cast("string"), BLANK)).alias("paragraph", "part"))
    grams = rows.select("id", "text_hash", "paragraph", words(F.col("part")).alias("words"))  # a column, so that it is made once
    grams = grams.select("id", "text_hash", "paragraph", "words", F.greatest(F.size("words") - 1, F.lit(0)).alias("n"))
    # what has no weight goes within the array, so that no row is made of it; the array stands inside of explode, as a
    # column of its own would be made once more for the filter on empty arrays that Spark infers
    known = [r.gram for r in weights.select("gram").distinct().collect()]  # bounded by the notices
    hits = F.transform(pairs(F.col("words"), lambda a, b: F.xxhash64(a, b)), lambda g, i: F.when(g.isin(known), F.struct(i.alias("place"), g.alias("gram"))))
    grams = grams.select("id", "text_hash", "paragraph", "n", F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("hit"))
    met = grams.select("id", "text_hash", "paragraph", "n", "hit.place", "hit.gram").join(F.broadcast(weights), "gram")
    # a window of w words has w - 1 bigrams and begins every w / 2 words; the last ones of a paragraph are shorter
    inside = [F.struct(F.lit(w).alias("wide"), (F.floor(F.col("place") / (w // 2)) - k).cast("int").alias("nth")) for w in WINDOWS for k in (0, 1)]
    met = met.withColumn("at", F.explode(F.array(*inside))).where("at.nth >= 0 and place < at.nth * (at.wide div 2) + at.wide - 1")
    met = met.withColumn("n", F.least(F.col("at.wide") - 1, F.col("n") - F.col("at.nth") * (F.col("at.wide") / 2)).cast("int"))
    sums = met.groupBy("id", "text_hash", "paragraph", "at", "n").agg(F.collect_set(F.struct("gram", "w", "tells")).alias("hits"))  # a set: rows may repeat
    sums = sums.where((F.size("hits") >= LEAST) | F.exists("hits", lambda h: h["tells"]))
    zero = F.array(*map(F.lit, biases))
    z = F.aggregate("hits", zero, lambda acc, h: F.zip_with(acc, h["w"], lambda a, b: a + b))
    sums = sums.withColumn("z", F.transform(z, lambda v: v / temperature)).withColumn("top", F.array_max("z"))
    sums = sums.withColumn("z", F.transform("z", lambda v: F.exp(v - F.col("top")))).withColumn("all", F.aggregate("z", F.lit(0.0), lambda a, b: a + b))
    each = F.zip_with(F.array(*map(F.lit, families)), "z", lambda f, v: F.struct(f.alias("family"), (v / F.col("all")).alias("score")))
    likely = F.filter(each, lambda x: (x["score"] >= CERTAIN) & (x["family"] != UNKNOWN))
    sums = sums.withColumn("hits", F.transform("hits", lambda h: h["gram"])).withColumn("likely", F.explode(likely)).select("*", "likely.family", "likely.score")
    own = templates(docs.sparkSession).select("template", F.col("family").alias("of"), F.array_distinct(pairs(F.col("words"), lambda a, b: F.xxhash64(a, b))).alias("t"))
    own = own.select("template", "of", F.size("t").alias("size"), F.explode("t").alias("gram"))
    alone = own.groupBy(F.col("gram").alias("g")).agg((F.min("of") == F.max("of")).alias("alone"))
    own = own.join(F.broadcast(alone), F.col("gram") == F.col("g")).drop("g")
    window = ["id", "text_hash", "paragraph", "at", "n", "family", "score"]
    near = sums.select(*window, F.explode("hits").alias("gram")).join(F.broadcast(own), "gram").groupBy(*window, "template", "of", "size").agg(F.count("*").alias("m"), F.bool_or("alone").alias("alone"))
    share = F.greatest(F.col("m") / F.col("size") / OF_TEMPLATE, F.col("m") / F.col("n") / OF_PARAGRAPH)
    near = near.withColumn("yes", (F.col("of") == F.col("family")) & (F.col("m") >= F.least(F.lit(LEAST), "size")) & (share >= 1)).withColumn("share", share)
    of_own = F.col("of") == F.col("family")
    best = F.max_by(F.struct("template", "yes"), F.when(of_own, F.struct("yes", "share", -F.col("template"))))
    near = near.groupBy(*window).agg(best.alias("best"), F.max(F.when(of_own, F.col("m"))).alias("m"), F.max(F.when(~of_own, F.col("m"))).alias("other"), F.bool_or(of_own & F.col("alone")).alias("alone"))
    # what another family's notices say as well shows neither
    yes = F.coalesce(F.col("best.yes") & (F.col("alone") | (F.col("m") > F.coalesce("other", F.lit(0)))), F.lit(False))
    best = F.max_by(F.struct(F.col("best.template").alias("template"), yes.alias("yes"), "score"), F.struct(yes, "score", -F.col("best.template")))
    out = near.groupBy("id", "text_hash", "paragraph", "family").agg(best.alias("best"))
    return out.select("id", "text_hash", "paragraph", "family", F.col("best.score").alias("score"), F.col("best.yes").alias("confirmed"), F.when(F.col("best.yes"), F.col("best.template")).alias("template"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, model=None) -> DataFrame:
    """One row per document: id, n_paragraphs, n_licences, families (sorted, comma-joined), n_unconfirmed, score.

    n_licences counts the families of each paragraph; model: what ``trained`` returned, for many scans by one."""
    found = paragraphs(docs, id_col, text_col, sample, model).groupBy(F.col("id").alias("f_id"), F.col("text_hash").alias("f_hash")).agg(
        F.count_if("confirmed").alias("n_licences"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), ",").alias("families"), F.count_if(~F.col("confirmed")).alias("n_unconfirmed"), F.max(F.when(F.col("confirmed"), F.col("score"))).alias("score")
    )
    lines = F.coalesce(F.size(F.filter(F.split(F.col(text_col).cast("string"), BLANK), lambda x: F.trim(x) != "")), F.lit(0)).cast("long")
    every = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), lines.alias("n_paragraphs"))
    out = every.join(found, F.col("id").eqNullSafe(F.col("f_id")) & (F.col("text_hash") == F.col("f_hash")), "left")
    return out.select(F.col("id").alias(id_col), "n_paragraphs", F.coalesce("n_licences", F.lit(0)).alias("n_licences"), F.coalesce("families", F.lit("")).alias("families"), F.coalesce("n_unconfirmed", F.lit(0)).alias("n_unconfirmed"), F.coalesce("score", F.lit(0.0)).alias("score"))
