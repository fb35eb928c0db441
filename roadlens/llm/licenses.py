"""Licence scan: lines, whole texts and word windows against licence templates by Dice coefficient over word bigrams.

A unit (a line, and a whole text of several lines) is normalised to words of
letters and digits.  Dice = 2 |A & B| / (|A| + |B|) over the sets of word
bigrams (a single word counts as one).  Two prunings lose nothing:

* size: Dice >= t needs ``t / (2 - t) <= |A| / |B| <= (2 - t) / t``, so a unit
  meets only templates within these bounds, and most none at all;
* signature: within the bounds at least ``ceil(t / (2 - t) * |B|)`` bigrams of
  the template occur in the unit, so one of any ``|B| - that + 1`` of them
  does.  These are chosen so that few words (anchors) stand in all of them: a
  text without an anchor is dropped before its lines are looked at, a unit
  without a signature bigram before it meets templates.

A licence that no line and not the whole text of a document reaches is looked
for in windows of as many words as its template has, from any word on and
across line ends: a notice wrapped over lines of a longer text, or beside other
words in a line.  The best window of a document counts, as one match.  The prunings
hold here too: a text meets only templates of whose bigrams it has the fewest
that can do, and only windows near a signature bigram.

Only DataFrame functions.  Texts are not shuffled: units stay in their row's
task, and only matches and document ids meet by id, after partial sums.
Templates are a fixed table in the plan.

Edge cases: null, empty and word-free texts have no licence.  Time and memory
grow in proportion to a text's length.  Ties between
templates go to the first by name.  Rows that repeat a document id are one
document.  A null id is a document of its own.  An empty table gives an empty
result.  Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii

MIN_DICE = 0.8
SPLIT = r"[^0-9a-z\x{80}-\x{10FFFF}]+"

# fixed values: public licence notices (short forms as they stand in texts, two grants, and the same two short licences whole)
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "bsd": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies."
    ),
    "mit": "Released under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
TEMPLATES |= {
    "isc-whole": TEMPLATES["isc"] + " "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "mit-whole": TEMPLATES["mit-grant"] + " "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
}


#: Words of most English texts, poor anchors.
COMMON_WORDS = frozenset("a all an and any as at be but by can for from in is it limited may no not of on or other than that the this to under use which with without you".split())


def template_words(text: str) -> list[str]:
    return re.findall("[0-9a-z\x80-\U0010ffff]+", text.translate({c: c + 32 for c in range(65, 91)}))


def template_bigrams(text: str) -> set[str]:
    words = template_words(text)
    return {f"{a} {b}" for a, b in zip(words, words[1:])} or set(words)


def bounds(size: int, min_dice: float) -> tuple[int, int]:
    """Fewest and most bigrams of a unit that can reach ``min_dice`` against a template of ``size`` bigrams."""
    return math.ceil(size * min_dice / (2 - min_dice) - 1e-9), math.floor(size * (2 - min_dice) / min_dice + 1e-9)


def signature(sets: dict[str, set[str]], min_dice: float) -> tuple[list[str], list[str]]:
    """(bigrams, anchors): ``size - fewest + 1`` bigrams of each template, and words of which each of them has one.

    Anchors are taken greedily: the word that stands in most bigrams still
    needed (ties: the longer word, then by text), a common word only where no
    other is left.
    """
    need = {name: len(s) - bounds(len(s), min_dice)[0] + 1 for name, s in sets.items()}
    left = {name: {b: set(b.split()) for b in s} for name, s in sets.items()}
    chosen: set[str] = set()
    anchors: list[str] = []
    while any(need.values()):
        gain: Counter[str] = Counter()
        for name, n in need.items():
            for word, hits in Counter(w for ws in left[name].values() for w in ws).items():
                gain[word] += min(n, hits)
        word = min(gain, key=lambda w: (w in COMMON_WORDS, -gain[w], -len(w), w))
        anchors.append(word)
        for name, n in need.items():
            taken = sorted(b for b, ws in left[name].items() if word in ws)[:n]
            chosen.update(taken)
            need[name] -= len(taken)
            left[name] = {b: ws for b, ws in left[name].items() if b not in taken}
    return sorted(chosen), anchors


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), SPLIT), "")


def pairs(words: Column) -> Column:
    """The word bigrams of an array column in order; a single word stands for itself."""
    n = F.size(words)
    found = F.zip_with(F.slice(words, 1, n - 1), F.slice(words, 2, n - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(n > 1, found).otherwise(words)


def bigrams(words: Column) -> Column:
    """The set of word bigrams of an array column; a single word stands for itself."""
    return F.array_distinct(pairs(words))


def strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def matches(docs: DataFrame, templates: dict[str, str] | None = None, min_dice: float = MIN_DICE) -> DataFrame:
    """(doc_id, line, license, dice) of every unit and template that reach ``min_dice``; line 0 is the whole text."""
    sets = {name: template_bigrams(text) for name, text in sorted((templates or TEMPLATES).items())}
    sets = {name: s for name, s in sets.items() if s}
    largest = max(bounds(len(s), min_dice)[1] for s in sets.values())
    rare, anchors = signature(sets, min_dice)
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    texts = texts.filter(F.arrays_overlap(words_of(F.col("text")), F.array(*[F.lit(w) for w in anchors])))
    lines = F.split("text", r"\r\n|\r|\n")
    whole = F.when(F.size(lines) > 1, F.col("text"))  # line 0
    units = texts.select("doc_id", F.posexplode(F.concat(F.array(whole), lines)).alias("line", "unit")).filter("unit IS NOT NULL")
    units = units.select("doc_id", "line", bigrams(words_of(F.col("unit"))).alias("have"))
    units = units.filter((F.size("have") > 0) & (F.size("have") <= largest))
    units = units.filter(F.arrays_overlap("have", F.array(*[F.lit(b) for b in rare])))
    rows = [F.struct(F.lit(name).alias("license"), F.array(*[F.lit(b) for b in sorted(s)]).alias("want")) for name, s in sets.items()]
    met = units.withColumn("t", F.explode(F.array(*rows))).select("doc_id", "line", "have", F.col("t.license").alias("license"), F.col("t.want").alias("want"))
    a, b = F.size("have"), F.size("want")
    ratio = F.lit(min_dice / (2 - min_dice))
    met = met.filter((a >= F.ceil(b * ratio - 1e-9)) & (b >= F.ceil(a * ratio - 1e-9)))
    dice = 2.0 * F.size(F.array_intersect("have", "want")) / (a + b)
    return met.select("doc_id", "line", "license", dice.alias("dice")).filter(F.col("dice") >= min_dice)


def windows(docs: DataFrame, templates: dict[str, str] | None = None, min_dice: float = MIN_DICE) -> DataFrame:
    """(doc_id, license, dice) of windows that reach ``min_dice``, the best of each stretch of a text; a window has as many words as its template."""
    chosen = {name: (template_bigrams(text), max(1, len(template_words(text)) - 1)) for name, text in sorted((templates or TEMPLATES).items())}
    chosen = {name: found for name, found in chosen.items() if found[0]}
    rare, anchors = signature({name: s for name, (s, _) in chosen.items()}, min_dice)
    single = {name for name, text in (templates or TEMPLATES).items() if len(template_words(text)) == 1}
    texts = docs.select("doc_id", words_of(F.coalesce(F.col("text"), F.lit(""))).alias("words")).filter(F.arrays_overlap("words", strings(anchors)))
    texts = texts.select("doc_id", "words", pairs(F.col("words")).alias("steps"))
    # a template of one word is looked for among the words, any other among the bigrams
    known = F.array_intersect(F.concat("steps", "words") if single else F.col("steps"), strings(sorted({b for s, _ in chosen.values() for b in s})))
    rows = [
        F.struct(
            F.lit(name).alias("license"), strings(sorted(s)).alias("want"), strings(sorted(s.intersection(rare))).alias("rare"),
            F.lit(bounds(len(s), min_dice)[0]).alias("least"), F.lit(m).alias("m"), F.lit(name in single).alias("single"),
        )
        for name, (s, m) in chosen.items()
    ]
    texts = texts.withColumn("known", known).filter(F.size("known") > 0)
    met = texts.withColumn("t", F.explode(F.filter(F.array(*rows), lambda t: F.size(F.array_intersect("known", t["want"])) >= t["least"])))
    steps = F.when(F.col("t.single"), F.col("words")).otherwise(F.col("steps"))
    met = met.select("doc_id", "t.*", steps.alias("steps")).filter(F.size("steps") >= F.col("m"))
    # every window with a signature bigram begins in the stretch of m places that has the bigram, or in the one before it
    place = F.filter(F.transform("steps", lambda b, i: F.when(F.array_contains(F.col("rare"), b), F.floor(i / F.col("m")))), lambda i: i.isNotNull())
    stretches = F.array_distinct(F.flatten(F.transform(F.array_distinct(place), lambda i: F.array(F.greatest(i - 1, F.lit(0)), i))))
    # the places of a stretch and of the windows that begin there, cut out before the rows part: a row carries its own places only
    near = F.transform(stretches, lambda s: F.slice("steps", (s * F.col("m") + 1).cast("int"), 2 * F.col("m") - 1))
    met = met.select("doc_id", "license", "want", "m", F.explode(near).alias("steps")).filter(F.size("steps") >= F.col("m"))

    def dice(start: Column) -> Column:
        have = F.array_distinct(F.slice("steps", start, F.col("m")))
        return 2.0 * F.size(F.array_intersect(have, F.col("want"))) / (F.size(have) + F.size("want"))

    best = F.array_max(F.transform(F.sequence(F.lit(1), F.size("steps") - F.col("m") + 1), dice))
    return met.select("doc_id", "license", F.explode(F.filter(F.array(best), lambda d: d >= min_dice)).alias("dice"))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, min_dice: float = MIN_DICE) -> DataFrame:
    """One row per document: doc_id, license (best, null if none), dice (of the best, 0 if none), n_matches, licenses (all, comma-joined)."""
    found = matches(docs, templates, min_dice).select("doc_id", "line", "license", "dice")
    found = found.unionByName(windows(docs, templates, min_dice).withColumn("line", F.lit(-1)))
    ids = docs.select("doc_id", F.lit(None).cast("int").alias("line"), F.lit(None).cast("string").alias("license"), F.lit(None).cast("double").alias("dice"))
    unit = F.when(F.col("line") >= 0, F.col("dice"))
    per_license = found.unionByName(ids).groupBy("doc_id", "license").agg(
        F.coalesce(F.max(unit), F.max("dice")).alias("dice"), F.greatest(F.count(unit), F.least(F.count("line"), F.lit(1))).alias("n")
    )
    best = F.min(F.when(F.col("license").isNotNull(), F.struct((-F.col("dice")).alias("d"), F.col("license").alias("l"))))
    return per_license.groupBy("doc_id").agg(
        best.alias("best"),
        F.sum("n").alias("n_matches"),
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
    ).select("doc_id", F.col("best.l").alias("license"), F.coalesce(-F.col("best.d"), F.lit(0.0)).alias("dice"), "n_matches", "licenses")
