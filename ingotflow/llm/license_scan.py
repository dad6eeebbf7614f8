"""License scan: notices of known licenses inside documents, in DataFrame operations only.

MinHash bands over overlapping windows of the text retrieve templates, with so many bands that a
contained template collides almost surely; what collides is verified by exact containment of its five-word
shingles (see ``containment``). A template is found if at least 80 in 100 of them are in the document.

That many shingles do not tell versions and variants of a license apart, so ``notices`` goes on to ask for a
template's distinguishing words: each of its version numbers, and something that it has and a template
of another license, which holds 80 in 100 of its shingles too, has not. They must stand with the 80 in 100 at
one place of the document, where the words that the template's start would have lie close together. In a
template of up to ``NOTICE_WORDS`` words every number is a version number, in a longer one (a whole license
text, whose clauses are numbered) those after "version".

The default templates are common notices, as works carry them, and the terms of MIT and BSD-3-Clause: no collection
of all licenses. Identifiers of fewer than five words (``SPDX`` lines) are none; ``known`` takes any other table.

Edge cases: null and empty texts, and texts of fewer than five words, hold no template; a template of
fewer than five words is never found. Rows with a null id take no part. Rows that repeat an id are one
text, of all their shingles. Documents are read whole. Further columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingotflow.llm.common import written
from ingotflow.llm.containment import contained, shingled, shingles_of, words_of

SHINGLE, PERCENT = 5, 80
#: In templates of up to this many words every number tells versions apart, in longer ones those after "version".
NOTICE_WORDS = 64

#: Default templates, ``(license, text)``: short notices as works carry them. Fixed values.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
                   "except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the Software), to deal in the Software without restriction."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met."),
    ("BSD", "Licensed under the BSD 3-Clause License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "You can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "You can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation, either version 2 of the License, or any later version."),
    ("LGPL-2.1", "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                 "published by the Free Software Foundation, either version 2.1 of the License, or any later version."),
    ("LGPL-3.0", "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                 "published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("AGPL-3.0", "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
                 "published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS "
            "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
            "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
            "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
            "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                     "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
                     "binary form must reproduce the above copyright notice, this list of conditions and the following "
                     "disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither "
                     "the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                     "products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be "
             "held liable for any damages arising from the use of this software."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
                "software and accompanying documentation covered by this license."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0."),
    ("GPL-3.0", "Licensed under the GNU General Public License v3."),
    ("GPL-2.0", "Licensed under the GNU General Public License v2."),
    ("GPL-2.0", "You can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation; version 2 of the License."),
    ("CC-BY-3.0", "Licensed under CC BY 3.0."),
    ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
]


def templates(spark: SparkSession) -> DataFrame:
    """``template_id, license, text`` of the default templates."""
    return spark.createDataFrame([(i, *row) for i, row in enumerate(TEMPLATES)],
                                 "template_id int, license string, text string")


def scan(documents: DataFrame, known: DataFrame | None = None, size: int = SHINGLE, percent: int = PERCENT,
         key: str = "doc_id") -> DataFrame:
    """``doc_id, template_id, license, shared, n_shingles, first_word, last_word`` of each template contained.

    Templates of other versions are contained too; ``notices`` tells them apart.
    Words are counted from 0; ``last_word`` is exclusive.
    """
    known = templates(documents.sparkSession) if known is None else known
    found = contained(documents, known, size, percent, key, "template_id").withColumnsRenamed({
        "document": key, "short": "template_id", "size": "n_shingles", "first": "first_word",
        "last": "last_word"})
    return (found.join(known.select("template_id", "license"), "template_id")
            .select(key, "template_id", "license", "shared", "n_shingles", "first_word", "last_word"))


def marks_of(known: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``template_id, at, shingle, marks, n_shingles, n_marks``: what each shingle of a template distinguishes.

    A mark is a version number or, after a tilde, the template of another license that lacks the shingle.
    """
    def number(i):
        return F.get("words", i).rlike(r"^\p{N}")

    def after_version(i):
        return F.get("words", i - 1).isin("version", "v")

    rows = (known.where("template_id is not null and text is not null")
            .select("template_id", "license", words_of("text").alias("words")).where(F.size("words") >= size)
            .withColumn("hashed", F.transform("words", lambda w: F.xxhash64(w))))
    numbers = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: number(i) & (
        (F.size("words") <= NOTICE_WORDS) | F.coalesce(after_version(i), F.lit(False))
        | F.coalesce(number(i - 1) & after_version(i - 1), F.lit(False))))
    shingles = written(
        rows.select("template_id", "license", "words", numbers.alias("numbers"),
                    F.posexplode(shingles_of("hashed", size)).alias("at", "shingle"))
        .select("template_id", "license", "at", "shingle", F.transform(
            F.filter("numbers", lambda i: (i >= F.col("at")) & (i < F.col("at") + size)),
            lambda i: F.get("words", i)).alias("numbers")), "shingles")

    sets = shingles.select("template_id", "license", "shingle").distinct()
    sizes = sets.groupBy("template_id").agg(F.count("*").alias("n_shingles"))
    others = sets.select(F.col("template_id").alias("other"), F.col("license").alias("other_license"), "shingle")
    alike = (sets.join(others, "shingle").where("license <> other_license")
             .groupBy("template_id", "other").agg(F.count_distinct("shingle").alias("shared"))
             .join(sizes, "template_id").where(F.col("shared") * 100 >= F.col("n_shingles") * percent)
             .select("template_id", "other"))
    lacking = (sets.join(alike, "template_id").join(others, ["other", "shingle"], "left_anti")
               .groupBy("template_id", "shingle")
               .agg(F.collect_set(F.concat(F.lit("~"), F.col("other").cast("string"))).alias("lacking")))
    marks = shingles.join(lacking, ["template_id", "shingle"], "left").select(
        "template_id", "at", "shingle",
        F.concat("numbers", F.coalesce("lacking", F.array().cast("array<string>"))).alias("marks"))
    totals = marks.groupBy("template_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("marks")))).alias("n_marks"))
    return marks.join(sizes, "template_id").join(totals, "template_id")


def notices(documents: DataFrame, known: DataFrame | None = None, size: int = SHINGLE, percent: int = PERCENT,
            key: str = "doc_id") -> DataFrame:
    """The rows of ``scan`` whose template's distinguishing words are in the document.

    Where a template has such words, its ``shared``, ``first_word`` and ``last_word`` are those of the places
    that hold them (the most shared at one).
    """
    known = templates(documents.sparkSession) if known is None else known
    found = written(scan(documents, known, size, percent, key), "contained")
    marks = written(marks_of(known, size, percent).where("n_marks > 0"), "marks")
    marked = marks.select("template_id").distinct()
    doubtful = found.join(marked, "template_id", "left_semi").select(key, "template_id", "license")

    # written, since a filter inferred from the explosion would build all words again for each shingle
    texts = documents.join(doubtful.select(key).distinct(), key, "left_semi")
    words = (written(shingled(texts, key, "text", size), "texts")
             .select(F.col("id").alias(key), F.xxhash64("shingles").alias("row"),
                     F.posexplode("shingles").alias("word", "shingle")))
    hits = words.join(marks, "shingle").join(doubtful, [key, "template_id"])
    # starts that differ by up to a quarter of the template lie together in one of two overlapping windows
    place = F.floor((F.col("word") - F.col("at")) / (F.floor(F.col("n_shingles") / 4) + 1))
    held = (hits.withColumn("place", F.explode(F.array(place, place - 1)))
            .groupBy(key, "row", "template_id", "license", "n_shingles", "n_marks", "place")
            .agg(F.count_distinct("shingle").alias("shared"), F.min("word").alias("first"), F.max("word").alias("last"),
                 F.size(F.array_distinct(F.flatten(F.collect_set("marks")))).alias("held"))
            .where((F.col("held") == F.col("n_marks")) & (F.col("shared") * 100 >= F.col("n_shingles") * percent))
            .groupBy(key, "template_id", "license", "n_shingles")
            .agg(F.max("shared").alias("shared"), F.min("first").alias("first_word"),
                 (F.max("last") + size).alias("last_word")))
    return found.join(marked, "template_id", "left_anti").select(*found.columns).union(held.select(*found.columns))
