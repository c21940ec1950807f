"""Licence scans. Only DataFrame functions.

Three kinds of units are compared with templates of their kind by the cosine of sparse TF-IDF vectors: every line that
holds a word of licences with notices; windows of words, across lines, with notices, titles, SPDX tags and
standard headers; and the whole text of licence files with notices and whole licence texts. A window begins where
a template would have to begin for its first word of licences to stand at one of the text, and is as long as it.
A file's licence is that of a whole text from ``TEXT_THRESHOLD`` on, else of its best template from
``threshold`` on. The idf is that of the templates of a kind, and words of no template have the highest. A file without a
licence of its own inherits that of the nearest directory above it with a licence file: paths are
taken apart into their directories, which are joined with the directories of licence files.
"""

import re
from importlib.resources import files as resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import broadcast_if_small, once, words
from pairloom.sources.storage import materialize

# Notices by licence. A licence may have several.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("MPL-2.0", "This work is subject to the terms of the Mozilla Public License, version 2.0."),
]
_GPL = (
    "it under the terms of the GNU {}General Public License as published by the Free Software Foundation, "
    "either version {} of the License, or (at your option) any later version."
)
_NO_WARRANTY = (
    "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {}General Public License for more details."
)
_GNU = [("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3")]
_TAGS = (
    "AGPL-3.0 Apache-2.0 BSD-2-Clause BSD-3-Clause CC-BY-4.0 CC-BY-NC-4.0 CC-BY-SA-4.0 CC0-1.0 GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 MIT MPL-2.0"
).split()
# Titles, tags and standard headers, which may be wrapped or stand within other text.
HEADERS = [
    *[(tag, f"SPDX-License-Identifier: {tag}") for tag in _TAGS],
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    *[(name, "This program is free software: you can redistribute it and/or modify " + _GPL.format(kind, version)) for name, kind, version in _GNU],
    *[
        (name, f"This program is free software: you can redistribute it and/or modify {_GPL.format(kind, version)} This program {_NO_WARRANTY.format(kind)}")
        for name, kind, version in _GNU
    ],
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
        'agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights '
        "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:",
    ),
]
# Lines with one of these are looked at.
SIGNS = r"(?i)licen[cs]e|copyright|spdx|public domain|free of charge"
LICENCE_FILE = r"(?i)(^|/)(un)?(licen[cs]e|copying|notice)(\.[a-z]+)?$"
THRESHOLD = 0.75
# Long texts of one language share their frequent words.
TEXT_THRESHOLD = 0.9
DIGITS = 6
VERSION = "-[0-9].*$"
# Stands for a null path, which joins can't match; no path has this character.
NO_PATH = "\0"


def template_vectors(spark: SparkSession, templates=TEMPLATES) -> tuple[DataFrame, float]:
    """``(word, idf, template, licence, weight)`` with vectors of length one, and the idf of other words."""
    rows = [(k, licence, text) for k, (licence, text) in enumerate(templates)]
    each = spark.createDataFrame(rows, "template int, licence string, text string")
    tf = each.select("template", "licence", F.explode(words(F.col("text"))).alias("word"))
    tf = tf.groupBy("template", "licence", "word").agg(F.count("*").alias("tf"))
    n = len(templates)
    idf = tf.groupBy("word").agg((F.log((1 + F.lit(n)) / (1 + F.count("*"))) + 1).alias("idf"))
    weighted = tf.join(F.broadcast(idf), "word").withColumn("w", F.col("tf") * F.col("idf"))
    length = weighted.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    vectors = weighted.join(F.broadcast(length), "template")
    other = spark.range(1).select((F.log(F.lit(1 + n)) + 1).alias("idf")).first()[0]
    return vectors.select("word", "idf", "template", "licence", (F.col("w") / F.col("length")).alias("weight")), other


def licence_texts() -> list[tuple[str, str]]:
    """The whole texts of licences, which lie beside this module."""
    found = [f for f in resources("pairloom.llm").joinpath("licence_texts").iterdir() if f.name.endswith(".txt")]
    return sorted((f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in found)


def _python_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _spelt(word: Column) -> Column:
    return F.replace(word, F.lit("licence"), F.lit("license"))


def header_windows(some: DataFrame, headers: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """``(path, text_key, line, shape)`` of words that stand where a header might, and ``(template, shape)``."""
    spark, shapes = some.sparkSession, []
    for k, (_, text) in enumerate(headers):
        found = _python_words(text)
        # "free of charge" and "public domain" are signs of several words.
        begin = next((i for i in range(len(found)) if re.match(SIGNS, " ".join(found[i : i + 3]))), None)
        if begin is None:
            # A sign that begins within a word, like that of "sublicense".
            begin = next(i for i, word in enumerate(found) if re.search(SIGNS, word))
        shapes.append((k, found[begin].replace("licence", "license"), begin, len(found), f"{found[begin]} {begin} {len(found)}"))
    known = spark.createDataFrame(shapes, "template int, sign string, before int, size int, shape string")
    split = once(some.select("path", "text_key", "text"), "words", words(F.col("text"))).drop("text")
    signs = sorted({s[1] for s in shapes})
    at = F.filter(F.transform("words", lambda w, i: F.struct(_spelt(w).alias("sign"), i.alias("at"))), lambda p: p["sign"].isin(signs))
    placed = split.select("path", "text_key", "words", F.explode(at).alias("p")).select("path", "text_key", "words", "p.*")
    placed = placed.join(F.broadcast(known.drop("template").distinct()), "sign")
    first = F.greatest(F.col("at") - F.col("before"), F.lit(0))
    line = F.array_join(F.slice("words", first + 1, F.col("at") - F.col("before") + F.col("size") - first), " ")
    return placed.select("path", "text_key", line.alias("line"), "shape"), known.select("template", "shape")


def _scores(units: DataFrame, unit: list[str], templates: list[tuple[str, str]], shapes: DataFrame | None = None) -> DataFrame:
    """``(*unit, licence, score)``, with the licence's version if the unit has its number, of all pairs of units and templates that share words, and their shape if there are shapes."""
    vectors, other = template_vectors(units.sparkSession, templates)
    tf = units.select(*unit, F.explode(words(F.col("line"))).alias("word"))
    tf = tf.groupBy(*unit, "word").agg(F.count("*").alias("tf"))
    # The templates and their words are fixed, so these two tables have a fixed size.
    idf = vectors.select("word", "idf").distinct()
    tf = materialize(tf.join(F.broadcast(idf), "word", "left").select(
        *unit, "word", (F.col("tf") * F.coalesce("idf", F.lit(other))).alias("w")
    ), "terms")
    number = F.when(F.col("word").rlike("^v?[0-9]+$"), F.regexp_replace("word", "^v", ""))
    length = tf.groupBy(*unit).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"), F.collect_set(number).alias("numbers"))
    weights, on = vectors.drop("idf"), ["word"]
    if shapes is not None:
        weights, on = weights.join(F.broadcast(shapes), "template"), ["word", "shape"]
    dot = tf.join(F.broadcast(weights), on).groupBy(*unit, "template", "licence")
    dot = dot.agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dot.join(length, unit).withColumn("score", F.round(F.col("dot") / F.col("length"), DIGITS))
    # A unit without the number of the version doesn't tell it.
    version = F.regexp_extract("licence", "-([0-9]+)[0-9.]*$", 1)
    untold = (version != "") & ~F.array_contains("numbers", version)
    return scored.select(*unit, F.when(untold, F.regexp_replace("licence", VERSION, "")).otherwise(F.col("licence")).alias("licence"), "score")


def _scored(units: DataFrame, more: list[str], templates: list[tuple[str, str]], threshold: float, shapes: DataFrame | None = None) -> DataFrame:
    """``(path, text_key, licence, score)`` of ``units(path, text_key, line, *more)`` from the threshold on.

    Equal units are compared once, under a hash of their text, and only hashes of units that are like a template go back
    to the files: the texts of units are moved no further than to their equals.
    """
    key = [F.unhex(F.md5("line")).alias("key"), *more]
    distinct = units.select(*key, "line").groupBy("key", *more).agg(F.any_value("line").alias("line"))
    scored = _scores(distinct, ["key", *more], templates, shapes).where(F.col("score") >= threshold)
    scored = broadcast_if_small(materialize(scored, "scored"))
    return units.select("path", "text_key", *key).join(scored, ["key", *more]).select("path", "text_key", "licence", "score")


def own_licences(
    files: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES, headers=HEADERS, texts: list[tuple[str, str]] | None = None
) -> DataFrame:
    """``(path, text_key, licence, score)`` of ``files(path, text_key, text, whole)`` with a licence of their own.

    ``whole``: the text as a whole is compared, too. A whole licence text wins, then the highest score. Equal scores of
    versions of a licence give its name without a version, others the first licence by name.
    """
    some = materialize(files.where(F.col("text").rlike(SIGNS)).select("path", "text_key", "text", "whole"), "with_signs")
    lines = some.select("path", "text_key", F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike(SIGNS))
    wholes = some.where("whole").select("path", "text_key", F.col("text").alias("line"))
    notices = _scored(lines.unionByName(wholes), [], templates, threshold)
    embedded = [*templates, *headers]
    windows, shapes = header_windows(some, embedded)
    blocks = _scored(windows, ["shape"], embedded, threshold, shapes)
    whole_texts = _scored(wholes, [], licence_texts() if texts is None else texts, max(threshold, TEXT_THRESHOLD))
    found = notices.unionByName(blocks).withColumn("kind", F.lit(1)).unionByName(whole_texts.withColumn("kind", F.lit(0)))
    found = found.groupBy("path", "text_key", "kind", "score").agg(F.array_sort(F.collect_set("licence")).alias("names"))
    best = found.groupBy("path", "text_key").agg(F.min(F.struct("kind", (-F.col("score")).alias("down"), "names")).alias("best"))
    first = F.get("best.names", F.lit(0))
    plain = F.array_distinct(F.transform("best.names", lambda n: F.regexp_replace(n, VERSION, "")))
    licence = F.when((F.size("best.names") > 1) & (F.size(plain) == 1), F.get(plain, F.lit(0))).otherwise(first)
    return best.select("path", "text_key", licence.alias("licence"), (-F.col("best.down")).alias("score"))


def directories(path: Column) -> Column:
    """The directories above a path, nearest first, each ending in a slash; the last is the root, "/"."""
    parts = F.split(F.regexp_replace(path, "^/+", ""), "/+")
    above = F.slice(parts, F.lit(1), F.size(parts) - 1)
    counts = F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1))
    return F.transform(counts, lambda n: F.concat(F.lit("/"), F.when(n > 0, F.concat(F.array_join(F.slice(above, F.lit(1), n), "/"), F.lit("/"))).otherwise("")))


def scan_licences(
    files: DataFrame,
    path_col: str = "path",
    text_col: str = "text",
    licence_file: Column | None = None,
    threshold: float = THRESHOLD,
    templates=TEMPLATES,
) -> DataFrame:
    """``(path, own_licence, score, inherited_licence, inherited_from, licence)``, one row for each path and text.

    ``licence_file`` tells the files whose licence holds for their directory, by default from their names. Of several
    in a directory, the highest score counts, then the first path. Null and empty texts have no licence
    of their own but inherit; null paths inherit nothing. Other columns are ignored.
    """
    holds = F.col(path_col).rlike(LICENCE_FILE) if licence_file is None else licence_file
    files = files.select(
        F.coalesce(F.col(path_col), F.lit(NO_PATH)).alias("path"), F.col(text_col).alias("text"), F.coalesce(holds, F.lit(False)).alias("whole")
    ).withColumn("text_key", F.xxhash64("text"))
    own = materialize(own_licences(files, threshold, templates), "own")
    named = files.select("path", "text_key", "whole").distinct()
    both = named.join(
        broadcast_if_small(own.withColumnsRenamed({"path": "of_path", "text_key": "of_text"})),
        F.col("path").eqNullSafe(F.col("of_path")) & (F.col("text_key") == F.col("of_text")),
        "left",
    ).select("path", "text_key", "whole", "licence", "score")
    both = materialize(both, "licensed")

    holders = both.where(F.col("whole") & F.col("licence").isNotNull() & (F.col("path") != NO_PATH))
    by_directory = holders.groupBy(F.get(directories(F.col("path")), F.lit(0)).alias("directory")).agg(
        F.min(F.struct((-F.col("score")).alias("down"), "path", "licence")).alias("first")
    )
    by_directory = materialize(by_directory.select("directory", F.col("first.licence").alias("of_directory")), "directories")
    # The directories of files without a licence; a path part is repeated at most as often as it is deep.
    without = both.where(F.col("licence").isNull() & (F.col("path") != NO_PATH)).select("path").distinct()
    above = without.select("path", F.posexplode(directories(F.col("path"))).alias("up", "directory"))
    nearest = above.join(broadcast_if_small(by_directory), "directory").groupBy("path").agg(
        F.min(F.struct("up", "directory", "of_directory")).alias("near")
    )
    nearest = nearest.select(
        F.col("path").alias("for_path"), F.col("near.of_directory").alias("inherited_licence"), F.col("near.directory").alias("inherited_from")
    )
    inherits = (F.col("path") == F.col("for_path")) & F.col("licence").isNull()
    return both.join(nearest, inherits, "left").select(
        F.nullif("path", F.lit(NO_PATH)).alias("path"),
        F.col("licence").alias("own_licence"),
        "score",
        "inherited_licence",
        "inherited_from",
        F.coalesce("licence", "inherited_licence").alias("licence"),
    )
