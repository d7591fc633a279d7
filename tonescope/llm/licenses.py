"""Operator 8, licence scans by Dice coefficient over word bigrams, with Spark's own functions only.

Units are the lines of a text and the whole text. A unit's set of word bigrams is compared with
the sets of licence templates; Dice >= t bounds the sizes of the two sets to within a factor of
(2 - t) / t, so a unit meets only templates of fitting size, and prose meets hardly any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Usual notices of licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not '
                         "use this file except in compliance with the License.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in "
                    "the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International "
                 "License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under "
                      "the terms of the GNU General Public License as published by the Free Software "
                      "Foundation, either version 3 of the License, or (at your option) any later "
                      "version.",
    "MIT": "Released under the MIT License.",
    "MIT header": "Permission is hereby granted, free of charge, to any person obtaining a copy of "
                  'this software and associated documentation files (the "Software"), to deal in the '
                  "Software without restriction.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Lower-case words of ASCII letters and digits; everything else separates them."""
    plain = F.regexp_replace(F.translate(text, UPPER, LOWER), "[^a-z0-9]+", " ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def bigrams(words: Column) -> Column:
    """The different pairs of neighbouring words, joined by a space."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n),
                                       lambda a, b: F.concat(a, F.lit(" "), b)))


def template_set(text: str) -> list[str]:
    """The bigrams of a template, by the same rule."""
    plain = "".join(c if c.isascii() and c.isalnum() else " " for c in text).lower().split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(plain, plain[1:], strict=False)))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, line, license, dice``: a row per unit that a template fits, with the best one.

    ``line`` counts from 1; 0 is the whole text, of more than one line. Ties go to the first name.
    A null or empty text has no rows, nor has a unit of fewer than two words. Rows that repeat are
    scanned as often; a null id stays null. A very long text is one unit besides its lines, like any
    other. An empty table gives no rows. Other columns are not read.
    """
    sets = {name: template_set(t) for name, t in sorted((templates or TEMPLATES).items())}
    known = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(len(s)).alias("size"),
                               F.array(*map(F.lit, s)).alias("pairs")) for name, s in sets.items()))
    # A little wider than the bounds, as a product may be rounded; ``fitting`` decides exactly.
    low = min(len(s) for s in sets.values()) * threshold / (2 - threshold) - 1e-6
    high = max(len(s) for s in sets.values()) * (2 - threshold) / threshold + 1e-6
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    lines = F.split("text", "\n")
    units = F.when(F.size(lines) > 1, F.concat(F.array("text"), lines)).otherwise(
        F.concat(F.array(F.lit("")), lines))
    units = rows.where(F.col("text").isNotNull()).select(
        "doc_id", F.posexplode(units).alias("line", "unit"))
    # Exploded arrays of one: a filter on the result stays above, so words are made once.
    units = units.select("doc_id", "line", F.explode(F.array(words_of(F.col("unit"))))
                         .alias("words"))
    # A set has at most one bigram less than the unit has words: too short for every template.
    units = units.where(F.size("words") - 1 >= low).select(
        "doc_id", "line", F.explode(F.array(bigrams(F.col("words")))).alias("pairs"))
    sized = units.where(F.size("pairs").between(low, high)).select(
        "doc_id", "line", "pairs", F.size("pairs").alias("n"))
    # The greatest Dice that the sizes allow, computed as Dice is below.
    fitting = F.filter(known, lambda t: 2 * F.least("n", t["size"]) / (F.col("n") + t["size"])
                       >= threshold)
    scored = F.transform(fitting, lambda t: F.struct(
        (2 * F.size(F.array_intersect(F.col("pairs"), t["pairs"])) / (F.col("n") + t["size"]))
        .alias("dice"), t["name"].alias("license")))
    best = F.aggregate(scored, F.struct(F.lit(0.0).alias("dice"), F.lit("").alias("license")),
                       lambda a, b: F.when(b["dice"] > a["dice"], b).otherwise(a))
    found = sized.select("doc_id", "line", best.alias("best"))
    return found.where(F.col("best.dice") >= threshold).select("doc_id", "line", "best.license",
                                                               "best.dice")


def scan_sql(templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> str:
    """The same rows in DuckDB's SQL, without the size bounds."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    sets = {name: template_set(t) for name, t in sorted((templates or TEMPLATES).items())}
    listed = ", ".join(f"({quote(n)}, [{', '.join(map(quote, s))}])" for n, s in sets.items())
    return f"""
WITH templates(license, tset) AS (VALUES {listed}),
lines AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents
          WHERE text IS NOT NULL),
units AS (SELECT doc_id, 0 AS line, text AS unit FROM lines WHERE len(parts) > 1
          UNION ALL
          SELECT doc_id, unnest(range(1, len(parts) + 1)) AS line, unnest(parts) AS unit FROM lines),
worded AS (SELECT doc_id, line, list_filter(string_split(regexp_replace(
               translate(unit, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'), ' '),
               lambda w: w <> '') AS words FROM units),
paired AS (SELECT doc_id, line, list_distinct(list_transform(range(1, len(words)),
               lambda i: words[i] || ' ' || words[i + 1])) AS pairs FROM worded),
scored AS (SELECT doc_id, line, license,
               2 * len(list_intersect(pairs, tset)) / (len(pairs) + len(tset)) AS dice
           FROM paired, templates WHERE len(pairs) > 0)
SELECT doc_id, line, license, dice FROM scored WHERE dice >= {threshold}
QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, license) = 1"""
