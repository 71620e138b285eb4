"""License scans: sparse TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest directory.

DataFrame functions only. A header is a line with a word that licences are made of, alone or with the two lines after it;
a licence file is a text that as a whole is close to a template. Files without a header
of their own get the licence of the nearest directory above them that has a licence file.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import stored

# Licences and the notices by which files and licence texts name them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3 or any later version."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related rights to this work to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; version 2.1 of the License."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3 of the License."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    # whole texts, as they stand in licence files
    ("MIT", "MIT License Copyright (c) year holder. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD-2-Clause", "Copyright (c) year, holder. Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES."),
    ("BSD-3-Clause", "Copyright (c) year, holder. Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES."),
    ("ISC", "ISC License Copyright (c) year, holder. Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]
# Fixed value: a line without any of these roots is no licence header.
MARKS = "licen[cs]|copyright|permission|redistribut|spdx|free software|public domain"
#: Lines that a wrapped header may have, and keys that the files of one directory are dealt to.
WRAP, SALT = 3, 64
#: Least cosine of a header, and of a whole text that counts as a licence file.
HEADER, FILE = 0.6, 0.5


def terms(text: Column) -> Column:
    """Lower-case runs of ASCII letters, digits, dots and hyphens, without dots and hyphens at their ends."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9](?:[a-z0-9.-]*[a-z0-9])?"), F.lit(0)), F.array().cast("array<string>"))


def _templates(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(name).alias("license"), F.lit(text).alias("text")) for i, (name, text) in enumerate(templates)])
    return spark.range(1).select(F.inline(rows))


def _counts(df: DataFrame, *keys: str) -> DataFrame:
    """keys, term, tf of df(keys, words)."""
    return df.select(*keys, F.explode("words").alias("term")).groupBy(*keys, "term").agg(F.count("*").cast("double").alias("tf"))


def scan_licenses(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, header: float = HEADER, whole: float = FILE) -> DataFrame:
    """path, license, score, how, source for every row of files(path, text).

    how is 'own' (a header or the whole text names the licence), 'inherited' (from source,
    the nearest directory above with a licence file) or 'none'. Cosines weigh terms by
    ln((1 + files) / (1 + files with the term)) + 1, counted over all files; terms outside
    the templates weigh as if no file had them. Of several licences the highest cosine wins, ties go
    to the first template; of several licence files in a directory likewise, then the
    smaller path. Texts are read whole. Null or empty texts have no header; rows with
    a null path have no directory. Every row is judged by its own text, also if it repeats a path. Other columns are
    ignored; an empty table gives no rows.
    """
    spark = files.sparkSession
    known = stored(_templates(spark, templates).withColumn("words", terms(F.col("text"))), "lic-templates")
    vocabulary = sorted({r["term"] for r in known.select(F.explode("words").alias("term")).distinct().collect()})
    words = F.array(*[F.lit(w) for w in vocabulary])
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    marked = F.filter(F.sequence(F.lit(1), F.size("all_lines")), lambda i: F.lower(F.get("all_lines", i - 1)).rlike(MARKS))
    headers = F.array_distinct(F.flatten(F.transform(marked, lambda i: F.array(F.get("all_lines", i - 1), F.array_join(F.slice("all_lines", i, WRAP), " ")))))
    rows = files.select("path", "text", lines.alias("all_lines")).select("path", "text", headers.alias("lines"))
    scanned = stored(rows.select(
        F.monotonically_increasing_id().alias("row"), "path", F.array_intersect(terms(F.col("text")), words).alias("has"), "lines",
        # the whole text is looked at again only where it has a header
        F.when(F.size("lines") > 0, F.col("text")).alias("text")), "lic-scanned")
    n = float(scanned.count())
    spread = scanned.select(F.explode("has").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = lambda df: F.log(F.lit(1 + n) / (1 + df)) + 1
    idf = stored(known.select(F.explode("words").alias("term")).distinct().join(spread, "term", "left").select("term", weight(F.coalesce("df", F.lit(0))).alias("idf")), "lic-idf")
    unseen = math.log(1 + n) + 1

    pattern = _counts(known, "template", "license").join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norms = pattern.groupBy(F.col("template").alias("t")).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("t_norm"))
    pattern = stored(pattern.join(norms, F.col("template") == F.col("t")).select("template", "license", "term", (F.col("w") / F.col("t_norm")).alias("w")), "lic-pattern")

    # passages: each header, and the text as a whole, which is number 0
    headed = scanned.filter(F.size("lines") > 0)
    passages = headed.select("row", F.posexplode("lines").alias("no", "part")).select("row", (F.col("no") + 1).alias("no"), "part").unionByName(headed.select("row", F.lit(0).alias("no"), F.col("text").alias("part")))
    vectors = stored(
        _counts(passages.select("row", "no", F.xxhash64("row", "no").alias("key"), terms(F.col("part")).alias("words")), "key", "row", "no")
        .join(idf, "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unseen))), "lic-vectors")
    lengths = vectors.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = vectors.join(pattern.withColumnRenamed("w", "p"), "term").groupBy("key", "row", "no", "template", "license").agg(F.sum(F.col("w") * F.col("p")).alias("dot"))
    cosines = dots.join(lengths, "key").withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
    best = F.max_by(F.struct("license", "score"), F.struct("score", -F.col("template")))
    own = stored(
        cosines.filter(F.when(F.col("no") == 0, F.col("score") >= whole).otherwise(F.col("score") >= header)).groupBy("row")
        .agg(best.alias("own"), F.max(F.when(F.col("no") == 0, F.struct("score", (-F.col("template")).alias("t"), "license"))).alias("file")), "lic-own")

    directory = lambda p: F.regexp_extract(p, "^(.*)/[^/]*$", 1)
    placed = scanned.select("row", "path").filter("path IS NOT NULL")
    holders = own.filter("file IS NOT NULL").select("row", "file").join(placed, "row").groupBy(directory(F.col("path")).alias("source")).agg(
        F.min_by(F.col("file.license"), F.struct(-F.col("file.score"), -F.col("file.t"), "path")).alias("inherited"))
    # every directory and those above it, the nearest first
    folders = scanned.filter("path IS NOT NULL").select(directory(F.col("path")).alias("folder")).distinct()
    parts = F.split("folder", "/")
    above = folders.select("folder", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("source")))).alias("up"))
    given = above.select("folder", "up.depth", "up.source").join(holders, "source").groupBy("folder").agg(F.max_by(F.struct("inherited", "source"), "depth").alias("given"))

    # a directory may hold a third of all files: its rows are dealt to SALT keys
    out = scanned.select("row", "path", directory(F.col("path")).alias("folder"), F.pmod(F.xxhash64("row"), F.lit(SALT)).alias("salt"))
    given = given.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
    out = out.join(own.select("row", "own"), "row", "left").join(given, ["folder", "salt"], "left")
    how = F.when(F.col("own").isNotNull(), "own").when(F.col("given").isNotNull(), "inherited").otherwise("none")
    return out.select("path", F.coalesce("own.license", "given.inherited").alias("license"), F.col("own.score").alias("score"), how.alias("how"), F.when(how == "inherited", F.col("given.source")).alias("source"))
