"""Licence scan: Dice coefficient over word bigrams against templates.

DataFrame functions only. Texts and templates are normalised the same way
(ASCII lower case, everything but letters, digits and dots is a space). The
units compared are the lines, the paragraphs (runs of lines between lines
without a word), the sentences of both, and the text as one unit: a notice that
is wrapped, also behind comment marks, is a paragraph or a sentence of one.
A unit of ``a`` distinct bigrams can reach a Dice coefficient
of ``t`` with a template of ``b`` only if t/(2-t) <= a/b <= (2-t)/t, so a
unit's size picks the few templates worth comparing before any overlap is
counted. Texts without any word that a match must hold are not cut into units at all.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyflux.llm.common import text_or_empty

# Notices and short licence texts as they are published.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."],
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met:"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}

THRESHOLD = 0.75


#: A word: letters, digits, dots and anything beyond ASCII, with at least one that is no dot.
WORD = r"\.*[a-z0-9\x{80}-\x{10FFFF}][a-z0-9.\x{80}-\x{10FFFF}]*"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: str | Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def words(text: str | Column) -> Column:
    """Normalised words: ASCII lower case, without trailing dots."""
    return F.transform(F.regexp_extract_all(_lower(text), F.lit(WORD), F.lit(0)), lambda w: F.regexp_replace(w, r"\.+$", ""))


def bigrams(w: Column) -> Column:
    """Pairs of neighbouring words; one word alone stands for itself."""
    pairs = F.zip_with(w, F.slice(w, F.lit(2), F.size(w)), lambda x, y: F.concat_ws(" ", x, y))
    return F.slice(pairs, F.lit(1), F.greatest(F.size(w) - 1, F.lit(1)))     # the last word has no neighbour


def numbered(grams: Column) -> Column:
    """The multiset as a set: each pair with its occurrence number."""
    return F.transform(grams, lambda g, i: F.concat_ws(
        "#", g, F.size(F.filter(F.slice(grams, F.lit(1), i + 1), lambda x: x == g)).cast("string")))


def template_rows(spark, templates: dict[str, list[str]]) -> DataFrame:
    """(license, template, t_plain, t_grams, t_size) of each template."""
    rows = [(k, i, t) for k, ts in templates.items() for i, t in enumerate(ts)]
    df = spark.createDataFrame(rows, "license string, template int, t_text string")
    df = df.withColumn("w", words("t_text")).withColumn("t_plain", bigrams(F.col("w")))
    return df.select("license", "template", "t_plain", numbered(F.col("t_plain")).alias("t_grams"),
                     F.size("t_plain").alias("t_size"))


# Frequent English words, which make poor anchors.
COMMON = frozenset("a and any are as be by following for free from in is it may of or that the this to under with you".split())


def anchors(grams: list[list[str]], threshold: float) -> list[str]:
    """Words of which every matching unit holds at least one.

    A unit that reaches the threshold shares at least ``least`` pairs with the
    template, so it holds a word of ``anchors`` once fewer pairs than that are
    without one. Words are taken by how many such pairs they settle."""
    r = threshold / (2.0 - threshold)
    least = [math.ceil(threshold * (math.ceil(len(g) * r - 1e-9) + len(g)) / 2 - 1e-9) for g in grams]
    chosen: list[str] = []
    while True:
        open_pairs = [p for g, m in zip(grams, least) for rest in [[p for p in g if not set(p.split()) & set(chosen)]]
                      if len(rest) >= m for p in rest]
        if not open_pairs:
            return sorted(chosen)
        gain = Counter(w for p in open_pairs for w in set(p.split()))
        chosen.append(min(gain, key=lambda w: (w in COMMON, -gain[w] * min(len(w), 8), w)))     # longer words are rarer


def paragraphs(text: Column) -> Column:
    """``text`` with a paragraph a line: a line without any word ends one."""
    blank = F.regexp_replace(text, r"(?md)^[^A-Za-z0-9\x{80}-\x{10FFFF}\n]+$", "")
    return F.translate(F.regexp_replace(blank, r"\n\n+", "\r"), "\n\r", " \n")


def _sentences(text: Column) -> Column:
    return F.split(F.regexp_replace(text, r"([.!?])[\x20\x09-\x0D]+", "$1\n"), r"[\n\r]+")


def _sized(units: Column, lo: int, hi: int) -> Column:
    """The distinct units of ``lo`` to ``hi`` words."""
    inside = lambda u: F.abs(2 * F.regexp_count(_lower(u), F.lit(WORD)) - (lo + hi)) <= hi - lo  # noqa: E731  lo <= count <= hi
    return F.array_distinct(F.filter(units, inside))


def units(text: Column, lo: int, hi: int) -> Column:
    """Distinct lines, their sentences and the whole text, those of ``lo`` to ``hi`` words."""
    return _sized(F.concat(F.split(text, r"[\n\r]+"), _sentences(text), F.array(text)), lo, hi)


def wrapped_units(text: Column, lo: int, hi: int) -> Column:
    """Distinct paragraphs and their sentences, which run over line breaks. A
    colon at a line's end is tried both as the end of a sentence and as none."""
    flat = F.regexp_replace(text, r"\r\n?", "\n")
    whole, ended = paragraphs(flat), paragraphs(F.regexp_replace(flat, r":[\x20\x09]*\n", ":\n\n"))
    return _sized(F.concat(F.split(whole, r"\n"), _sentences(whole), _sentences(ended)), lo, hi)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                 templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """One row per (id, licence) found: id, license, dice (the best unit's),
    template (the number of the template it matched) and n_units (distinct
    units that matched; a paragraph or a sentence of one counts if no matching
    line, sentence of a line or whole text holds the same words or lies in it).

    A unit matches a template when 2 |A n B| / (|A| + |B|) >= ``threshold`` over
    their multisets of word bigrams. Null and empty texts match nothing. Ties
    of the best unit go to the smaller template number. Rows with the same id
    (null included) count as one document; other columns are ignored.
    """
    r = threshold / (2.0 - threshold)
    t = template_rows(docs.sparkSession, templates).collect()             # the template list is a parameter
    lo = min(-(-x.t_size * r // 1) for x in t)                            # bigrams; one more in words
    hi = max(x.t_size / r // 1 for x in t)
    known = sorted({g for x in t for g in x.t_plain})
    # exact pre-filter on whole texts: Unicode lower case only ever adds ASCII letters
    held = "|".join(re.escape(w) for w in anchors([x.t_plain for x in t], threshold))
    held = f"(?<![a-z0-9])(?:{held})(?![a-z0-9])"
    least, most, text = 1 if lo <= 1 else int(lo) + 1, int(hi) + 1, text_or_empty(text_col)
    u = (docs.filter(F.lower(F.col(text_col)).rlike(held))
         .select(F.col(id_col), F.md5(text).alias("of"), units(text, least, most).alias("single"), wrapped_units(text, least, most).alias("wrapped"))
         .select(id_col, "of", F.explode(F.concat(
             F.transform("single", lambda x: F.struct(x.alias("unit"), F.lit(False).alias("wrapped"))),
             F.transform(F.array_except("wrapped", "single"), lambda x: F.struct(x.alias("unit"), F.lit(True).alias("wrapped"))))).alias("u"))
         .select(id_col, "of", "u.unit", "u.wrapped"))
    u = (u.filter(F.lower("unit").rlike(held)).withColumn("w", words("unit")).withColumn("plain", bigrams(F.col("w")))   # a column each: lambdas repeat expressions
         .filter(F.arrays_overlap("plain", F.array(*[F.lit(g) for g in known])))
         .withColumn("size", F.size("plain")).withColumn("grams", numbered(F.col("plain"))))
    sized = [(x.license, x.template, x.t_grams, x.t_size, n) for x in t
             for n in range(int(-(-x.t_size * r // 1)), int(x.t_size / r // 1) + 1)]
    sized = docs.sparkSession.createDataFrame(
        sized, "license string, template int, t_grams array<string>, t_size int, size int")
    hit = u.join(F.broadcast(sized), "size")                              # templates by admissible size: fixed, small
    both = F.size(F.array_intersect("grams", "t_grams"))
    hit = hit.withColumn("dice", (F.lit(2.0) * both) / (F.col("size") + F.col("t_size"))).filter(F.col("dice") >= threshold)
    # per text: a wrapped unit around or inside a unit that matched by itself is the same place
    hit = hit.withColumn("u", F.struct("unit", F.concat(F.lit(" "), F.concat_ws(" ", "w"), F.lit(" ")).alias("said")))
    hit = hit.groupBy(id_col, "of", "license").agg(
        F.max("dice").alias("dice"), F.max_by("template", F.struct("dice", -F.col("template"))).alias("template"),
        F.collect_set(F.when(~F.col("wrapped"), F.col("u"))).alias("single"), F.collect_set(F.when(F.col("wrapped"), F.col("u"))).alias("wrapped"))
    more = F.filter("wrapped", lambda x: ~F.exists("single", lambda y: F.contains(x["said"], y["said"]) | F.contains(y["said"], x["said"])))
    hit = hit.select(id_col, "license", "dice", "template", F.explode(F.concat("single", more)).alias("u"))
    return hit.groupBy(id_col, "license").agg(
        F.max("dice").alias("dice"), F.max_by("template", F.struct("dice", -F.col("template"))).alias("template"),
        F.count_distinct("u.unit").alias("n_units"))
