"""Licence notices in texts: Dice coefficient over word bigrams, in DataFrame functions.

Each line of a text is normalised (lower case, runs of anything but ASCII letters and digits become one
space) and compared as a set of word bigrams with every template whose size allows it: a Dice
coefficient 2 * shared / (a + b) of at least t needs b between a * t / (2 - t) and a * (2 - t) / t, so a
template is listed under the sizes it can match and the line's size looks them up. With ``whole`` the
text is one unit, for templates of whole licences.

Templates are a parameter of the program and small; their table is the only thing that is broadcast, and
nothing else is shuffled but the matches.

Defined results: null and empty texts, and units of fewer than two words, match nothing; of templates
with equal coefficients the first name counts; rows that repeat a document, or have no id, are reported each; lines
and texts of any length are compared whole; empty tables on either side give no match. Other columns are not used.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Notices by which works name their licence, under SPDX names.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Distributed under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Released under the ISC License.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def bigrams_of(text: str) -> list[str]:
    """Sorted distinct word bigrams of a template."""
    words = re.sub("[^a-z0-9]+", " ", "".join(c.lower() if c.isascii() else c for c in text)).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def sizes_for(size: int, percent: int) -> range:
    """Sizes of units that can reach the coefficient with a template of ``size`` bigrams."""
    return range(-(-size * percent // (200 - percent)), size * (200 - percent) // percent + 1)


def _normalised(text: Column) -> Column:
    letters = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(letters, "[^a-z0-9]+", " "))


def scanned(
    docs: DataFrame, templates: dict[str, str] | None = None, *, percent: int = 80, whole: bool = False,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc, line, licence, shared, size, template_size``: the best template of each line that has one."""
    spark = docs.sparkSession
    known = {name: bigrams_of(t) for name, t in (NOTICES if templates is None else templates).items()}
    listed = [[name, grams] for name, grams in known.items() if grams]
    written = F.lit(json.dumps([{"name": name, "grams": grams} for name, grams in listed]))
    table = spark.range(1).select(
        F.explode(F.from_json(written, "array<struct<name:string,grams:array<string>>>")).alias("t")
    )
    most = F.floor(F.size("t.grams") * (200 - percent) / percent).cast("int")
    least = F.ceil(F.size("t.grams") * percent / (200 - percent)).cast("int")
    table = table.select(
        F.col("t.name").alias("licence"), F.col("t.grams").alias("grams"), F.explode(F.sequence(least, most)).alias("size")
    )
    sizes = [n for _, grams in listed for n in sizes_for(len(grams), percent)]
    units = F.array(F.col(f"`{text}`")) if whole else F.split(F.col(f"`{text}`"), "\n")
    # rows are told apart by a number, as their ids may be null or repeat
    row = F.monotonically_increasing_id().alias("row")
    ided = docs.select(F.col(f"`{key}`").alias("doc"), units.alias("units"), row)
    lines = ided.select("row", "doc", F.posexplode("units").alias("line", "unit"))
    words = F.split(_normalised(F.col("unit")), " ")
    counted = lines.select("row", "doc", "line", words.alias("words")).where(F.size("words") > max(1, min(sizes, default=0)))
    pairs = F.transform(
        F.sequence(F.lit(1), F.size("words") - 1),
        lambda i: F.concat_ws(" ", F.element_at("words", i), F.element_at("words", i + 1)),
    )
    sized = counted.select("row", "doc", "line", F.array_distinct(pairs).alias("own")).withColumn("size", F.size("own"))
    joined = sized.join(F.broadcast(table), "size")
    shared = F.size(F.array_intersect("own", "grams"))
    close = joined.select(
        "row", "doc", "line", "licence", "size", shared.alias("shared"), F.size("grams").alias("template_size")
    )
    close = close.where(200 * F.col("shared") >= percent * (F.col("size") + F.col("template_size")))
    ratio = F.col("shared") / (F.col("size") + F.col("template_size"))
    best = close.groupBy("row", "doc", "line").agg(
        F.min(F.struct((-ratio).alias("r"), "licence", "shared", "size", "template_size")).alias("b")
    )
    return best.select("doc", "line", "b.licence", "b.shared", "b.size", "b.template_size")
