"""License scans: TF-IDF cosine of headers and licence files to templates, and inheritance.

Each template has a cue word at some place. Around every such word of a text the windows
of tokens are taken in which a template with this cue would stand, across line ends and
inside long lines; these are the passages. They are reduced to their distinct token
sequences before anything is weighed, so a header that half of all files carry is one
row. Tokens are weighed by their document frequency among all passages of the corpus and
the templates, and each passage is compared with the templates by cosine.

A file named like a licence, or one that a passage makes up for the most part, is a
licence file. A file without a licence of its own takes that of the nearest directory
above it that has one: each distinct directory is joined with its ancestors by path.

Everything is DataFrame operations. What is broadcast is bounded by the list of templates.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import written

#: Least cosine of a passage to be of a template's licence.
LEAST_COSINE = 0.8
#: Part of a file's tokens that one passage must have for it to be a licence file.
LICENCE_SHARE = 0.5
#: Tokens of a passage, and names of licence files.
TOKEN = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
LICENCE_NAME = r"(?i)^(licen[cs]e|copying|unlicense|notice)([._-].*)?$"
#: Words that can be a template's cue; a template with none has its longest token.
CUES = "licensed license licence spdx-license-identifier granted redistribution domain reserved".split()
#: A statement that names no licence, which any other one of the file goes before.
UNNAMED = "Proprietary"

#: Usual statements of licences, by SPDX id. Fixed values.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0-only", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("ISC", "Licensed under the ISC License"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("Proprietary", "All rights reserved"),
    ("MIT", "MIT License"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("GPL-2.0-or-later", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GPL-3.0-or-later", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("LGPL-3.0-or-later", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("AGPL-3.0-or-later", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("GPL-2.0-only", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0-only", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0-only", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0-only", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("BSD-2-Clause", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED"),
]


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def directory(path: Column) -> Column:
    """The path without its last part, and empty at the top."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def shapes(templates=TEMPLATES) -> list[tuple[str, int, int]]:
    """(cue, tokens before it, length) of the windows in which templates can stand."""
    found = set()
    for _, text in templates:
        words = re.findall(TOKEN, text.lower())
        cue = next((w for w in words if w in CUES), max(words, key=len))
        found.add((cue, words.index(cue), len(words)))
    return sorted(found)


def windows(words: Column, templates=TEMPLATES) -> Column:
    """The distinct windows around cues, each as tokens joined by spaces. Those that reach
    over an end of the text are cut there."""
    forms = shapes(templates)
    listed = F.array(*(F.struct(F.lit(c).alias("cue"), F.lit(b).alias("before"), F.lit(n).alias("length")) for c, b, n in forms))
    placed = F.transform(words, lambda t, i: F.struct(t.alias("t"), i.alias("i")))
    cues = F.filter(placed, lambda x: x["t"].isin(*sorted({c for c, *_ in forms})))

    def around(x: Column) -> Column:
        def window(s: Column) -> Column:
            start = x["i"] - s["before"]
            return F.array_join(F.slice(words, F.greatest(start, F.lit(0)) + 1, s["length"] + F.least(start, F.lit(0))), " ")

        return F.transform(F.filter(listed, lambda s: s["cue"] == x["t"]), window)

    return F.array_distinct(F.flatten(F.transform(cues, around)))


def passages_of(files: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(file, dir, named, size, key, n) of each passage of ``files(file, path, text)``: the
    file's directory, whether it is named like a licence, its number of tokens, and the
    passage's tokens, joined by spaces, and their number."""
    named = F.regexp_extract(F.col("path"), r"([^/]*)$", 1).rlike(LICENCE_NAME)
    some_cue = "|".join(re.escape(c) for c in sorted({c for c, *_ in shapes(templates)}))
    read = files.where(F.lower("text").rlike(some_cue)).select("file", directory(F.col("path")).alias("dir"), named.alias("named"), tokens(F.col("text")).alias("words"))
    found = read.select("file", "dir", "named", F.size("words").alias("size"), F.explode(windows(F.col("words"), templates)).alias("key"))
    return found.withColumn("n", F.size(F.split("key", " ")))


def best_templates(passages: DataFrame, least: float = LEAST_COSINE, templates=TEMPLATES) -> DataFrame:
    """(key, license, cosine) of the distinct passages that a template is near enough to.

    ``passages(key, copies)``. A token's weight is its count times
    ``ln((1 + all) / (1 + those with it)) + 1`` over all passages, copies counted, and all
    templates. Tokens that no template has weigh as if no passage had them. Of equally
    near templates the licence first by name is taken.
    """
    spark = passages.sparkSession
    rows = [F.struct(F.lit(i).alias("template"), F.lit(name).alias("license"), F.lit(text).alias("text")) for i, (name, text) in enumerate(templates)]
    listed = spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))
    forms = listed.select("template", "license", F.explode(tokens(F.col("text"))).alias("token")).groupBy("template", "license", "token").agg(F.count(F.lit(1)).alias("tf"))
    vocabulary = forms.groupBy("token").agg(F.count(F.lit(1)).alias("listed"))
    counted = (
        passages.select("key", "copies", F.explode(F.split("key", " ")).alias("token"))
        .groupBy("key", "token")
        .agg(F.count(F.lit(1)).alias("tf"), F.first("copies").alias("copies"))
    )
    total = F.lit(passages.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0] + len(templates))
    seen = counted.join(F.broadcast(vocabulary.select("token")), "token").groupBy("token").agg(F.sum("copies").alias("df"))
    weights = (
        vocabulary.join(seen, "token", "left")
        .select("token", (F.log((1.0 + total) / (1.0 + F.coalesce("df", F.lit(0)) + F.col("listed"))) + 1).alias("idf"))
    )
    vectors = forms.join(F.broadcast(weights), "token").select("template", "license", "token", (F.col("tf") * F.col("idf")).alias("w"))
    norms = vectors.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("template_norm"))
    vectors = vectors.join(F.broadcast(norms), "template").select("license", "template", "token", (F.col("w") / F.col("template_norm")).alias("tw"))
    weighed = (
        counted.join(F.broadcast(weights), "token", "left")
        .select("key", "token", F.col("idf").isNotNull().alias("known"), (F.col("tf") * F.coalesce("idf", F.log(1.0 + total) + 1)).alias("w"))
    )
    length = weighed.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.where("known").join(F.broadcast(vectors), "token").groupBy("key", "template", "license").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    near = dots.join(length, "key").select("key", F.struct((-F.round(F.col("dot") / F.col("norm"), 6)).alias("away"), "license").alias("best"))
    return near.groupBy("key").agg(F.min("best").alias("best")).select("key", F.col("best.license").alias("license"), (-F.col("best.away")).alias("cosine")).where(F.col("cosine") >= least)


def nearest_licences(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """(dir, license, licence_dir) of the distinct ``directories(dir)`` for which
    ``licensed(dir, license)`` has an entry at the directory or above it: the nearest one."""
    parts = F.split("dir", "/")
    ups = directories.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).alias("up"))
    met = ups.join(licensed.select(F.col("dir").alias("up"), "license"), "up")
    best = F.max(F.struct(F.length("up").alias("depth"), "up", "license")).alias("best")
    return met.groupBy("dir").agg(best).select("dir", F.col("best.license").alias("license"), F.col("best.up").alias("licence_dir"))


def scan(files: DataFrame, least: float = LEAST_COSINE, templates=TEMPLATES) -> DataFrame:
    """``file, path, license, cosine, origin, licence_dir`` of each row of ``files(file,
    path, text)``, where ``file`` tells rows apart; ``templates`` are pairs of licence and
    text.

    ``origin`` is ``header`` (own passage), ``inherited`` (from ``licence_dir``) or
    ``none``. Of several licences in a file the one whose passage is nearest to its
    template is taken, then that of the longest passage, then the first by name; one that
    is ``UNNAMED`` only if there is no other. A directory with several licence files has
    the licence that comes first in the same order. Null and empty texts have no passage;
    a null path lies in no directory and inherits nothing; an empty path is a file at the
    top. Rows that share a ``file`` share their passages; a row whose ``file`` is null has
    none of its own. Very long texts are read whole; an empty table gives no rows.
    """
    passages = written(passages_of(files, templates))
    best = written(best_templates(written(passages.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))), least, templates))
    order = F.struct((F.col("license") == UNNAMED).alias("unnamed"), (-F.col("cosine")).alias("away"), (-F.col("n")).alias("short"), "license")
    per_file = passages.join(best, "key").groupBy("file", "dir", "named", "size").agg(F.min(order).alias("best"), F.max("n").alias("n"))
    own = per_file.groupBy("file").agg(F.min("best").alias("best")).select("file", F.col("best.license").alias("license"), (-F.col("best.away")).alias("cosine"))
    licensed = (
        per_file.where(F.col("dir").isNotNull() & (F.col("named") | (F.col("n") >= LICENCE_SHARE * F.col("size"))))
        .groupBy("dir")
        .agg(F.min("best").alias("best"))
        .select("dir", F.col("best.license").alias("license"))
    )
    placed = files.select("file", "path", directory(F.col("path")).alias("dir"))
    above = nearest_licences(placed.where("dir is not null").select("dir").distinct(), licensed).withColumnRenamed("license", "above")
    joined = placed.join(own, "file", "left").join(above, "dir", "left")
    origin = F.when(F.col("license").isNotNull(), "header").when(F.col("above").isNotNull(), "inherited").otherwise("none")
    return joined.select(
        "file",
        "path",
        F.coalesce("license", "above").alias("license"),
        "cosine",
        origin.alias("origin"),
        F.when(F.col("license").isNull(), F.col("licence_dir")).alias("licence_dir"),
    )

