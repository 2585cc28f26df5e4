"""Licence scans: normalised text against licence templates by Dice coefficient over word bigrams.

Units of a document are its lines and the whole text. A unit is compared only with templates whose
number of bigrams is close enough for the threshold to be reached. Passages are searched besides: where
one of a template's rare bigrams occurs in the words of the text, whatever line breaks and comment
marks stand between them, the window of the template's size around it is compared. All of it is
one projection of built-in functions: no shuffle and no Python.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Short notices and texts of public licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"),
    "MIT": "Released under the MIT License",
    "MIT-licensed": "Licensed under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License",
    "ISC": "Licensed under the ISC License",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0",
    "CC-BY-4.0-text": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0-text": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "Proprietary": "All rights reserved",
}
# Passages of whole licence texts; only passages are compared with them, not lines.
PASSAGES = {
    "Apache-2.0-terms": (
        "\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 "
        "through 9 of this document. \"Licensor\" shall mean the copyright owner or entity authorized by the copyright "
        "owner that is granting the License."),
    "BSD-2-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution."),
    "BSD-3-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of "
        "its contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission."),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "GPL-3.0-preamble": (
        "The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    "AGPL-3.0-preamble": (
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, "
        "specifically designed to ensure cooperation with the community in the case of network server software."),
    "LGPL-3.0-terms": (
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the "
        "GNU General Public License, supplemented by the additional permissions listed below."),
}
#: Least Dice coefficient of a match.
THRESHOLD = 0.9
#: A template of this many bigrams has an anchor in each of its thirds, a smaller one has one.
LONG = 24

#: What separates words after lower case.
_BETWEEN = r"[^\p{L}\p{N}\n]+"


@dataclass(frozen=True)
class Template:
    """A licence template's name, its distinct word bigrams, its number of words, and its anchors: bigrams with the
    place of their first word."""

    name: str
    bigrams: tuple[str, ...]
    words: int
    anchors: tuple[tuple[str, int], ...]


def template_bigrams(templates: dict[str, str]) -> list[Template]:
    """Templates in name order; one of a single word has no bigrams and matches nothing.

    An anchor is the bigram that the fewest templates have, the longest of them, the first of those.
    """
    found = {}
    for name in sorted(templates):
        words = re.findall(r"[^\W_]+", templates[name].lower())
        pairs = [" ".join(p) for p in zip(words, words[1:])]
        if pairs:
            found[name] = pairs
    shared = Counter(pair for pairs in found.values() for pair in set(pairs))
    out = []
    for name, pairs in found.items():
        parts = 3 if len(pairs) >= LONG else 1
        edges = [len(pairs) * k // parts for k in range(parts + 1)]
        places = [min(range(a, b), key=lambda k: (shared[pairs[k]], -len(pairs[k]), k)) for a, b in zip(edges, edges[1:])]
        out.append(Template(name, tuple(dict.fromkeys(pairs)), len(pairs) + 1, tuple((pairs[k], k) for k in places)))
    return out


def bigrams(unit: Column) -> Column:
    """Distinct word bigrams of a normalised unit."""
    words = F.filter(F.split(unit, " "), lambda w: w != "")
    firsts, seconds = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words), F.lit(1)))
    return F.array_distinct(F.zip_with(firsts, seconds, lambda a, b: F.concat(a, F.lit(" "), b)))


def _bounds(size: int, threshold: float) -> tuple[float, float]:
    """Numbers of bigrams with which a template of ``size`` bigrams can reach the threshold.

    2 * min(a, b) / (a + b) is the most that Dice can be.
    """
    return size * threshold / (2 - threshold), size * (2 - threshold) / threshold


def _passages(words: Column, chosen: Sequence[Template], threshold: float) -> Column:
    """(start, loss, size, name) for every window that reaches the threshold, sorted.

    A window has a template's number of words, and one of the template's anchors where the template has it;
    ``start`` may be before the text.
    """
    known = F.array(*[F.struct(
        F.lit(anchor).alias("anchor"), F.lit(place).alias("place"), F.lit(t.words).alias("words"), F.lit(t.name).alias("name"),
        F.array(*[F.lit(p) for p in t.bigrams]).alias("own")) for t in chosen for anchor, place in t.anchors])

    def pair(k: Column) -> Column:
        return F.concat(F.get(words, k), F.lit(" "), F.get(words, k + 1))

    def window(k: Column, t: Column) -> Column:
        start = k - t["place"]
        pairs = F.array_distinct(F.transform(F.sequence(
            F.greatest(start, F.lit(0)), F.least(start + t["words"], F.size(words)) - 2), pair))
        dice = 2.0 * F.size(F.array_intersect(pairs, t["own"])) / (F.size(pairs) + F.size(t["own"]))
        return F.struct(start.alias("start"), (-dice).alias("loss"), (-F.size(t["own"])).alias("size"), t["name"].alias("name"))

    anchors = sorted({anchor for t in chosen for anchor, _ in t.anchors})
    hits = F.filter(F.sequence(F.lit(0), F.size(words) - 2), lambda k: pair(k).isin(anchors))
    seen = F.flatten(F.transform(hits, lambda k: F.transform(
        F.filter(known, lambda t: t["anchor"] == pair(k)), lambda t: window(k, t))))
    return F.array_sort(F.filter(seen, lambda f: -f["loss"] >= threshold - 1e-12))


def scan_licences(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None,
                  threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_units, n_candidates, n_matches, n_passages, licence, dice, licences) for every document.

    ``n_units`` counts the lines with two words and, in a text of more than one such line, the whole
    text. ``n_candidates`` counts the units that are within the size bounds of a template and so
    compared. ``n_matches`` counts the units that match. ``n_passages`` counts the places where windows that
    match begin, in all words of the text; the best template of a place counts, so a notice on a line of its own is
    a unit and a passage. ``licence`` is the best template of units and passages, the larger coefficient
    first, then the larger template, then the name that sorts first; null without a match. ``licences`` has the
    distinct best template of each matching unit and place, sorted. A passage whose anchors are all changed, or
    that has words inserted so that no window reaches the threshold, is not found. A null text has no units and no
    passages. Repeated rows are each scanned.

    By default units are compared with ``TEMPLATES`` and windows with ``PASSAGES`` too; given ``templates`` serve both.
    Templates are literals of the plan, so their number and size should stay those of a list like
    ``TEMPLATES``.
    """
    chosen: Sequence[Template] = template_bigrams(TEMPLATES | PASSAGES if templates is None else templates)
    whole = [t for t in chosen if templates is not None or t.name not in PASSAGES]
    made = ["n_units", "n_candidates", "n_matches", "n_passages", "licence", "dice", "licences"]
    normal = F.col("_normal")
    docs = docs.select(F.col(key).alias("doc_id"), F.regexp_replace(
        F.lower(F.coalesce(F.col(text), F.lit(""))), _BETWEEN, " ").alias("_normal"))
    sizes = [_bounds(len(t.bigrams), threshold) for t in whole]
    least, most = (min((a for a, _ in sizes), default=1.0), max((b for _, b in sizes), default=0.0))

    def compared(pairs: Column) -> Column:
        """The best template for a unit's bigrams, as (dice, size, name); null if none reaches the threshold."""
        n = F.size(pairs)
        results = []
        for template, (low, high) in zip(whole, sizes):
            own = F.array(*[F.lit(p) for p in template.bigrams])
            dice = 2.0 * F.size(F.array_intersect(pairs, own)) / (n + len(template.bigrams))
            fits = (n >= low - 1e-9) & (n <= high + 1e-9)
            results.append(F.when(fits & (F.when(fits, dice) >= threshold - 1e-12), F.struct(
                (-dice).alias("loss"), F.lit(-len(template.bigrams)).alias("size"), F.lit(template.name).alias("name"))))
        return F.array_min(F.array_compact(F.array(*results))) if results else F.lit(None)

    lines = F.filter(F.split(normal, "\n"), lambda line: F.trim(line).contains(" "))
    units = F.when(F.size(lines) > 1, F.concat(lines, F.array(F.translate(normal, "\n", " ")))).otherwise(lines)
    # a unit of n distinct bigrams has more than n words; long prose is out before bigrams are made
    blanks = lambda u: F.length(F.trim(u)) - F.length(F.translate(F.trim(u), " ", ""))
    near = F.filter("_units", lambda u: blanks(u) >= least - 1e-9)
    sized = F.filter(F.transform(near, bigrams), lambda p: (F.size(p) >= least - 1e-9) & (F.size(p) <= most + 1e-9))
    flat = F.regexp_replace(F.translate(normal, "\n", " "), "  +", " ")
    if not chosen:
        return docs.select("doc_id", F.size(units).cast("long").alias("n_units"), *[
            F.lit(0).cast("long").alias(n) for n in ("n_candidates", "n_matches", "n_passages")],
            F.lit(None).cast("string").alias("licence"), F.lit(None).cast("double").alias("dice"),
            F.array().cast("array<string>").alias("licences"))
    # only a text that holds an anchor is split into words
    held = reduce(or_, [F.col("_flat").contains(a) for a in sorted({a for t in chosen for a, _ in t.anchors})])
    scanned = docs.select("doc_id", units.alias("_units"), flat.alias("_flat")).select(
        "doc_id", F.size("_units").cast("long").alias("n_units"), sized.alias("_pairs"),
        F.when(held, F.split(F.trim("_flat"), " ")).alias("_words"))
    candidate = F.filter("_pairs", lambda p: F.reduce(
        F.array(*[(F.size(p) >= a - 1e-9) & (F.size(p) <= b + 1e-9) for a, b in sorted(set(sizes))]),
        F.lit(False), lambda x, y: x | y))
    matched = scanned.withColumn("_near", candidate).withColumn("_found", F.array_compact(F.transform("_near", compared)))
    matched = matched.withColumn("_all", F.when(F.col("_words").isNotNull(), _passages(F.col("_words"), chosen, threshold)))
    first = F.filter("_all", lambda f, k: (k == 0) | (F.get("_all", k - 1)["start"] != f["start"]))
    passages = F.transform(first, lambda f: F.struct(f["loss"], f["size"], f["name"]))
    both = matched.withColumn("_passages", F.coalesce(passages, F.array().cast("array<struct<loss:double,size:int,name:string>>")))
    both = both.withColumn("_found", F.concat("_found", "_passages")).withColumn("_n", F.size("_passages"))
    best = F.array_min("_found")
    return both.select(
        "doc_id", "n_units", F.size("_near").cast("long").alias("n_candidates"),
        (F.size("_found") - F.col("_n")).cast("long").alias("n_matches"), F.col("_n").cast("long").alias("n_passages"),
        best["name"].alias("licence"), (-best["loss"]).alias("dice"),
        F.array_sort(F.array_distinct(F.transform("_found", lambda f: f["name"]))).alias("licences")).select("doc_id", *made)
