"""Licence notices by Dice coefficient over word bigrams, in DataFrame functions alone.

A document's passages are its lines and their sentences, normalised to lower-case letters and digits
between single spaces. A passage is compared with a template by the sets of their word bigrams:
Dice = 2 * common / (bigrams of one + bigrams of the other). Only templates whose size allows the
threshold are compared: with threshold t, between t / (2 - t) and (2 - t) / t times the passage's.

A notice can also be wrapped over several lines or stand inside a longer sentence. So every window of
consecutive bigrams of the whole normalised text (line breaks are blanks there) is compared too, in the
lengths that the same bounds allow. A window near enough shares enough bigrams with its template, so
only templates that share as many with the whole text are tried, and only windows that begin and end
with a shared bigram: no other is nearer. Each template's nearest window counts, if no passage that
overlaps it is as near to some template, and if it doesn't lie inside near passages only while a
passage has found its licence: then it is a part of what was found.

Texts without any licence wording are passed over by two exact tests first. At threshold t a passage
shares at least t / (2 - t) of a template's n bigrams, so it holds at least one of any n - that + 1 of
them. ``KEYS`` are words chosen so that every template has that many bigrams with one of them: a text
with none of these words can't reach the threshold. And lines, sentences and windows are stretches of
the whole text's words, so none is near a template that the whole text shares too few bigrams with: only
texts that reach some template are cut into passages. Everything is computed in the row: no shuffle, no
join, no Python.

Defined results: null and empty texts and passages under two words match nothing (license_id and
dice null, empty lists); of equally near templates the first id in order wins; repeated rows are
scanned one by one; an empty table gives no rows. doc_id and text are read by name, so further
columns can have any name.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import require, table

THRESHOLD = 0.8

# Wording of public licence notices (SPDX id, notice).
TEMPLATES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def normal(text: str) -> str:
    return re.sub("[^a-z0-9]+", " ", text.lower()).strip()


def bigrams(text: str) -> list[str]:
    words = normal(text).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def least_common(m: int, threshold: float) -> int:
    """Bigrams that a passage shares at least with a template of ``m`` if it is near enough."""
    return min(c for c in range(1, m + 1) if 2.0 * c / (c + m) >= threshold)


def key_words(templates: list[list[str]], threshold: float) -> list[str]:
    """Words that every passage near enough to some template must hold at least one of: greedily those
    in most bigrams that are still wanted, long words (rarer in prose) before short ones."""
    need = [len(t) - least_common(len(t), threshold) + 1 for t in templates]
    keys: list[str] = []
    for least in (6, 3, 1):
        while True:
            gain: Counter[str] = Counter()
            for t, n in zip(templates, need, strict=True):
                left = [b for b in t if not set(b.split()) & set(keys)]
                if n > len(t) - len(left):
                    gain.update(w for b in left for w in set(b.split()) if len(w) >= least)
            if not gain:
                break
            keys.append(max(gain, key=lambda w: (gain[w], w)))
    return keys


GRAMS = [bigrams(text) for _, text in TEMPLATES]
KEYS = key_words(GRAMS, THRESHOLD)


def _normal(low: Column) -> Column:
    return F.trim(F.regexp_replace(low, "[^a-z0-9]+", " "))


def _lines(low: Column) -> Column:
    return F.split(low, "[\r\n]+")


def _sentences(low: Column) -> Column:
    return F.split(F.regexp_replace(low, r"([.!?])[ \t]+", "$1\n"), "[\r\n]+")


def _running(passage: Column) -> Column:
    """All bigrams in order."""
    words = F.split(passage, " ")
    return F.when(F.size(words) > 1, F.zip_with(
        F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b))
    ).otherwise(F.array().cast("array<string>"))


def _bigrams(passage: Column) -> Column:
    words = F.split(passage, " ")
    return F.when(F.size(words) > 1, F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(" ", words[i], words[i + 1])))
    ).otherwise(F.array().cast("array<string>"))


def _near(grams: Column, threshold: float) -> Column:
    """The templates that a passage's bigrams are near to: structs (dice, license)."""
    n = F.size(grams)
    near = []
    for (name, _), own in zip(TEMPLATES, GRAMS, strict=True):
        m = len(own)
        sizes = [k for k in range(1, 3 * m) if 2.0 * min(k, m) / (k + m) >= threshold]  # a passage may have
        common = F.size(F.array_intersect(grams, F.array(*map(F.lit, own))))
        dice = F.lit(2.0) * common / (n + m)
        near.append(F.when(n.between(sizes[0], sizes[-1]), F.struct(dice.alias("dice"), F.lit(name).alias("license"))))
    return F.filter(F.array(*near), lambda m: m.isNotNull() & (m["dice"] >= threshold))


def _templates(threshold: float) -> Column:
    """All templates as one constant: structs (license, grams, least, most), ``most`` being the bigrams of
    the longest window that can be near enough."""
    return F.array(*[F.struct(
        F.lit(name).alias("license"), F.array(*map(F.lit, own)).alias("grams"),
        F.lit(least_common(len(own), threshold)).alias("least"),
        F.lit(max(k for k in range(1, 3 * len(own)) if 2.0 * min(k, len(own)) / (k + len(own)) >= threshold)).alias("most"),
    ) for (name, _), own in zip(TEMPLATES, GRAMS, strict=True)])


def _window(grams: Column, cover: Column, licenses: Column, t: Column, threshold: float) -> Column:
    """The nearest window of a text's bigrams to template ``t`` that counts: a struct (dice, license), null if
    there is none. ``cover`` has each word's nearest passage's dice (0 if none is near), ``licenses`` what passages found."""
    own = t["grams"]
    starts = F.filter(F.sequence(F.lit(1), F.size(grams)), lambda i: F.array_contains(own, F.element_at(grams, i))
                      & (F.size(F.array_intersect(F.slice(grams, i, t["most"]), own)) >= t["least"]))

    def dice(i: Column, n: Column) -> Column:
        part, over = F.slice(grams, i, n), F.slice(cover, i, n + 1)
        near = F.lit(2.0) * F.size(F.array_intersect(part, own)) / (F.size(F.array_distinct(part)) + F.size(own))
        new = (F.array_min(over) == 0) | ~F.array_contains(licenses, t["license"])
        return F.when((near >= threshold) & (near > F.array_max(over)) & new, near)

    best = F.array_max(F.flatten(F.transform(starts, lambda i: F.transform(
        F.filter(F.sequence(t["least"], t["most"]), lambda n: F.array_contains(own, F.try_element_at(grams, i + n - 1))),
        lambda n: dice(i, n)))))
    return F.when(best.isNotNull(), F.struct(best.alias("dice"), t["license"].alias("license")))


def _cover(low: Column, passages: Column, near: Column) -> Column:
    """For each word of a text the dice of the nearest of its line and its sentence, 0 if neither is near."""
    of = F.map_from_arrays(passages, F.transform(near, lambda n: F.coalesce(F.array_max(n["dice"]), F.lit(0.0))))
    dice = lambda p: F.coalesce(F.try_element_at(of, _normal(p)), F.lit(0.0))
    return F.flatten(F.flatten(F.transform(_lines(low), lambda line: F.transform(_sentences(line), lambda p: F.array_repeat(
        F.greatest(dice(line), dice(p)), F.size(F.filter(F.split(_normal(p), " "), lambda w: w != "")))))))


def _holds(passage: Column, threshold: float) -> Column:
    """Whether a passage or text has one of the key words."""
    keys = KEYS if threshold == THRESHOLD else key_words(GRAMS, threshold)
    return F.exists(F.array(*map(F.lit, keys)), lambda w: F.contains(passage, w))


def reaching(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every document as (doc_id, grams, reach, low): the templates that its text shares enough bigrams with
    (null or empty: none), and the lower-cased text where there are any, else null."""
    # steps of their own: what several readers share (the lower-cased text, bigrams) must be made once
    docs = require(docs, ["doc_id", "text"]).select("doc_id", F.lower("text").alias("low"))
    low = F.col("low")
    docs = docs.select("doc_id", "low", F.when(_holds(low, threshold), _running(_normal(low))).alias("grams"))
    every = F.array(*map(F.lit, dict.fromkeys(b for own in GRAMS for b in own)))
    docs = docs.select("*", F.array_intersect("grams", every).alias("shared"))
    reach = F.filter(_templates(threshold), lambda t: F.size(F.array_intersect(F.col("shared"), t["grams"])) >= t["least"])
    docs = docs.select("doc_id", "low", "grams", F.when(F.size("shared") > 0, reach).alias("reach"))
    return docs.select("doc_id", "grams", "reach", F.when(F.size("reach") > 0, low).alias("low"))


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every document with its nearest licence: doc_id, license_id, dice, licenses (all found, sorted) and
    n_matches (pairs of a distinct passage and a template that reach the threshold, and templates with a
    window that counts)."""
    low = F.col("low")
    passages = F.array_distinct(F.transform(F.filter(F.concat(_lines(low), _sentences(low)), lambda p: _holds(p, threshold)), _normal))
    docs = reaching(docs, threshold).select("*", F.when(low.isNotNull(), passages).alias("passages"))
    near = F.transform(F.transform("passages", _bigrams), lambda grams: _near(grams, threshold))
    docs = docs.select("*", near.alias("near"))
    none = F.array().cast("array<struct<dice:double,license:string>>")
    docs = docs.select("*", F.coalesce(F.flatten("near"), none).alias("found"))
    cover = F.when(F.size("found") > 0, _cover(low, F.col("passages"), F.col("near"))).otherwise(
        F.array_repeat(F.lit(0.0), F.size("grams") + 1))
    docs = docs.select("doc_id", "grams", "found", "reach", F.when(F.size("reach") > 0, cover).alias("cover"))
    windows = F.filter(F.transform("reach", lambda t: _window(
        F.col("grams"), F.col("cover"), F.col("found.license"), t, threshold)), lambda m: m.isNotNull())
    docs = docs.select("doc_id", F.when(F.size("reach") > 0, F.concat("found", windows)).otherwise(F.col("found")).alias("found"))
    first = F.array_sort(F.col("found"), lambda a, b: (
        F.when(a["dice"] != b["dice"], F.when(a["dice"] > b["dice"], -1).otherwise(1))
        .when(a["license"] != b["license"], F.when(a["license"] < b["license"], -1).otherwise(1)).otherwise(0)))
    return docs.select(
        "doc_id", F.try_element_at(first, F.lit(1))["license"].alias("license_id"),
        F.try_element_at(first, F.lit(1))["dice"].alias("dice"),
        F.array_sort(F.array_distinct(F.col("found.license"))).alias("licenses"),
        F.size("found").cast("long").alias("n_matches"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, license_id, dice, licenses, n_matches."""
    return scan(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    templates = ", ".join(f"({k}, {quoted(name)}, [{', '.join(map(quoted, own))}])"
                          for k, ((name, _), own) in enumerate(zip(TEMPLATES, GRAMS, strict=True)))
    return rf"""
WITH t(template, license, grams) AS (VALUES {templates}),
p AS (
  SELECT DISTINCT doc_id, trim(regexp_replace(lower(piece), '[^a-z0-9]+', ' ', 'g')) AS passage
  FROM (SELECT doc_id, unnest(list_concat(regexp_split_to_array(text, '[\r\n]+'),
               regexp_split_to_array(regexp_replace(text, '([.!?])[ \t]+', '\1' || chr(10), 'g'), '[\r\n]+'))) AS piece
        FROM documents)),
w AS (SELECT doc_id, passage, string_split(passage, ' ') AS words FROM p),
b AS (
  SELECT doc_id, passage, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS grams
  FROM w WHERE len(words) > 1),
m AS (
  SELECT doc_id, license, 2.0::DOUBLE * len(list_intersect(b.grams, t.grams)) / (len(b.grams) + len(t.grams)) AS dice
  FROM b JOIN t ON len(list_intersect(b.grams, t.grams)) > 0),
f AS (
  SELECT doc_id, first(license ORDER BY dice DESC, license) AS license_id, max(dice) AS dice,
         list_sort(list(DISTINCT license)) AS licenses, count(*) AS n_matches
  FROM m WHERE dice >= 0.8 GROUP BY doc_id)
SELECT d.doc_id, f.license_id, f.dice, coalesce(f.licenses, []::VARCHAR[]) AS licenses, coalesce(f.n_matches, 0) AS n_matches
FROM documents d LEFT JOIN f USING (doc_id)
"""


ORACLE = _oracle()
