"""Licences of files: TF-IDF cosine to templates, then the nearest ancestor directory's licence.

The whole text is searched. Every line that speaks of licences begins passages
of 1, 2, 4 ... 32 lines, blank ones not counted: a notice, a title with its
version, a header, a short licence. Passages and templates are sparse vectors of
words weighted by term frequency and inverse document frequency over all
passages; equal texts and equal passages are scored once. A file's own licence is
that of the template with the largest cosine to any of its passages, at least
``LEAST``; where one licence is another with a clause more, the clause decides
(``EXTENDED``). So a long licence is known by its title and version, or its closing
notice, wherever they stand, and not by others that it mentions. A file without
one inherits from the nearest directory at or above its own that holds a licence
file (LICENSE, COPYING, NOTICE ...) with a licence; directories, not files, are
joined with their ancestors.

Null text counts as empty. A file with a null path is reported with its own
licence and inherits nothing. Of equal ones the licence that sorts first
holds; of several licence files in a directory, the one with the larger cosine,
then the licence that sorts first. Files with the same path, and repeated rows,
are reported each. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

LEAST = 0.5
NAMES = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)(\.[a-z]+)?$"
LINE = r"(?i)licen[cs]|copyright|copyleft|permission|redistribut|warrant|spdx|creative commons|public domain"

SIZES = (1, 2, 4, 8, 16, 32)
BLANK = r"^[ \t\r]*$"

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""
_GPL = "you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation"

#: Titles, notices and short licences by SPDX identifier (fixed values).
TEMPLATES = [
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License."),
    ("Artistic-1.0-Perl", 'The "Artistic License" Preamble'),
    ("BSD-2-Clause", _BSD),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("GFDL-1.2", "GNU Free Documentation License Version 1.2, November 2002"),
    ("GFDL-1.3", "GNU Free Documentation License Version 1.3, 3 November 2008"),
    ("GPL-1.0", "GNU GENERAL PUBLIC LICENSE Version 1, February 1989"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", f"{_GPL.format('')}; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", f"{_GPL.format('')}, either version 3 of the License, or (at your option) any later version."),
    ("ISC", _ISC),
    ("LGPL-2.0", "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", f"{_GPL.format('Lesser ')}; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License."),
    ("MIT", _MIT),
    ("MPL-1.1", "MOZILLA PUBLIC LICENSE Version 1.1"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


#: A licence, the clause that extends it, and what it then is (fixed values).
EXTENDED = [("BSD-2-Clause", r"(?i)neither\s+the\s+names?\s+of", "BSD-3-Clause")]


def passages(text: Column) -> Column:
    """The passages that begin with a line that speaks of licences, each once; an array, empty for most texts."""
    lines = F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), "\n"), lambda x: ~x.rlike(BLANK))
    starts = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(LINE), i + 1)), lambda i: i.isNotNull())
    sizes = F.array(*[F.lit(n) for n in SIZES])
    every = F.transform(starts, lambda i: F.transform(sizes, lambda n: F.array_join(F.slice(lines, i, n), "\n")))
    return F.array_distinct(F.flatten(every))


def terms(text: Column) -> Column:
    """Words of letters and digits; single dots, hyphens and pluses inside belong to a word."""
    return F.filter(F.split(F.lower(text), r"[^a-z0-9+.-]+|[+.-]+(?![a-z0-9])"), lambda w: w != "")


def scored(notices: DataFrame, templates: list[tuple[str, str]], least: float) -> DataFrame:
    """(key, license, cosine): the best template of each distinct notice; ``notices`` has key and notice."""
    spark = notices.sparkSession
    models = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "model int, license string, text string")
    words = stored(notices.select("key", F.explode(terms(F.col("notice"))).alias("term")).groupBy("key", "term").agg(F.count("*").alias("tf")))
    total = notices.select(F.count("*").alias("total"))
    known = words.groupBy("term").agg(F.count("*").alias("df"))
    model_words = models.select("model", "license", F.explode(terms(F.col("text"))).alias("term"))
    model_words = model_words.groupBy("model", "license", "term").agg(F.count("*").alias("tf"))
    n = total.first()[0]
    idf = F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.coalesce("df", F.lit(0)))) + 1
    known = stored(known.withColumn("idf", idf).select("term", "idf"))
    # template words are a few hundred rows, whatever the corpus
    weighted = model_words.join(known, "term", "left").withColumn("idf", F.coalesce("idf", F.lit(float(_log(n)))))
    weighted = weighted.withColumn("w", F.col("tf") * F.col("idf"))
    size = weighted.groupBy("model").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"))
    weighted = weighted.join(size, "model").select("license", "model", "term", (F.col("w") / F.col("size")).alias("m"))
    weighted = stored(weighted)
    vectors = words.join(known, "term").select("key", "term", (F.col("tf") * F.col("idf")).alias("w"))
    length = vectors.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"))
    dots = vectors.join(F.broadcast(weighted), "term").groupBy("key", "license", "model").agg(F.sum(F.col("w") * F.col("m")).alias("dot"))
    both = dots.join(length, "key").withColumn("cosine", F.round(F.col("dot") / F.col("size"), 6)).where(F.col("cosine") >= least)
    best = both.groupBy("key").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b"))
    return best.select("key", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"))


def _log(n: int) -> float:
    import math

    return math.log(1.0 + n) + 1


def ancestors(folder: Column) -> Column:
    """The folder and all above it, with their depth; the top folder is the empty text."""
    parts = F.filter(F.split(folder, "/"), lambda p: p != "")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("above")),
    )


def scanned(files: DataFrame, id_col="file_id", path_col="path", text_col="text",
            templates: list[tuple[str, str]] | None = None, least: float = LEAST) -> DataFrame:
    """file_id, path, own_license, own_cosine, license, via (own, inherited or none) and from_folder of every file."""
    templates = TEMPLATES if templates is None else templates
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = files.select(
        F.col(f"`{id_col}`").alias("file_id"), F.col(f"`{path_col}`").cast("string").alias("path"),
        F.when(text.rlike(LINE), F.unhex(F.md5(text))).alias("key"), F.when(text.rlike(LINE), text).alias("text"),
    )
    rows = stored(rows)
    # equal texts are cut once, equal passages scored once
    texts = stored(rows.where("key IS NOT NULL").groupBy("key").agg(F.first("text").alias("text")))
    cut = texts.select("key", F.explode(passages(F.col("text"))).alias("notice"))
    cut = stored(cut.withColumn("passage", F.unhex(F.md5("notice"))))
    notices = stored(cut.groupBy("passage").agg(F.first("notice").alias("notice")).withColumnRenamed("passage", "key"))
    scores = stored(scored(notices, templates, least)).withColumnRenamed("key", "passage")
    best = cut.select("key", "passage").join(scores, "passage")
    best = best.groupBy("key").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b"))
    clauses = texts.select("key", *[F.col("text").rlike(clause).alias(f"has{i}") for i, (_, clause, _) in enumerate(EXTENDED)])
    best = best.join(clauses, "key").select("key", F.col("b.license").alias("license"), (-F.col("b.c")).alias("own_cosine"), *clauses.columns[1:])
    named = F.col("license")
    for i, (shorter, _, longer) in enumerate(EXTENDED):
        named = F.when((F.col("license") == shorter) & F.col(f"has{i}"), longer).otherwise(named)
    best = stored(best.select(F.col("key").alias("k"), named.alias("own_license"), "own_cosine"))
    folder = F.regexp_replace(F.regexp_replace("path", r"/+", "/"), r"^/|/?[^/]*$", "")
    with_own = rows.where("key IS NOT NULL").join(best, F.col("key") == F.col("k"), "left")
    without = rows.where("key IS NULL").withColumns({"own_license": F.lit(None).cast("string"), "own_cosine": F.lit(None).cast("double")})
    keep = ["file_id", "path", "own_license", "own_cosine"]
    own = stored(with_own.select(*keep).unionByName(without.select(*keep)).withColumn("folder", folder))
    held = own.where(F.col("path").rlike(NAMES) & F.col("own_license").isNotNull())
    held = held.groupBy("folder").agg(F.min(F.struct((-F.col("own_cosine")).alias("c"), "own_license")).alias("b"))
    held = stored(held.select(F.col("folder").alias("above"), F.col("b.own_license").alias("given")))
    folders = own.where("folder IS NOT NULL").select("folder").distinct()
    lines = folders.select("folder", F.inline(ancestors(F.col("folder"))))
    nearest = lines.join(held, "above").groupBy("folder").agg(F.max(F.struct("depth", "above", "given")).alias("n"))
    nearest = stored(nearest.select(F.col("folder").alias("f"), F.col("n.above").alias("above"), F.col("n.given").alias("given")))
    out = own.join(nearest, F.col("folder") == F.col("f"), "left")
    is_own = F.col("own_license").isNotNull()
    return out.select(
        "file_id", "path", "own_license", "own_cosine", F.coalesce("own_license", "given").alias("license"),
        F.when(is_own, "own").when(F.col("given").isNotNull(), "inherited").otherwise("none").alias("via"),
        F.when(~is_own, F.col("above")).alias("from_folder"),
    )


