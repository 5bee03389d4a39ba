"""Licence statements in texts: a trained paragraph classifier, confirmed by templates.

Word uni- and bigrams of a paragraph have weights for each licence family and for ``unknown``,
learnt by sparse logistic regression from the templates below, varied, and from text that only
sounds like them or names no version. Statements that take no part in training set the
temperature of the probabilities and the threshold under which a paragraph stays unknown. A
paragraph ends at a blank line, and is scored in passages: its lines, and overlapping windows of
its words that run on over ends of lines. A prediction stands if enough of a template of the
family is found in the passage, a key word of it among them and the whole of its short name, if it has one, and no other family's template fits as well. Scoring is joins and
sums on Spark; the model and the templates have a fixed size.
"""

from __future__ import annotations

import functools
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.operators.skew import split_join
from cellweave.session import prepare, written

UNKNOWN = "unknown"
#: Statements of which most words are the licence's own. The licences' public texts.
STATEMENTS = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("BSD", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation"),
    ("BSD", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("BSD", "Released under the BSD License"),
    ("BSD", "The 3-Clause BSD License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("ISC", "Released under the ISC License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("EPL-2.0", "Licensed under the Eclipse Public License, version 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("CC0", "Licensed under CC0 1.0"),
    ("CC0", "Creative Commons CC0 1.0 Universal Public Domain Dedication"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software"),
    ("zlib", "Released under the zlib License"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("proprietary", "All rights reserved"),
    ("proprietary", "This software is proprietary and confidential. Unauthorized copying of this file is strictly prohibited"),
)
#: Versions of the licences that share one wording: family, name and version.
VERSIONED = (
    ("GPL-2.0", "GNU General Public License", "2"), ("GPL-3.0", "GNU General Public License", "3"), ("LGPL-2.1", "GNU Lesser General Public License", "2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3"), ("AGPL-3.0", "GNU Affero General Public License", "3"),
)
#: How such a version is named.
WORDINGS = (
    "This work is licensed under the {name}, version {v}", "{name} Version {v}", "{name} v{v}", "released under the terms of the {name} v{v}",
    "under the terms of the {name} as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version",
    "{name}; either version {v} of the License, or (at your option) any later version",
    "either version {v} of the {name}, or (at your option) any later version",
)
#: Terms of the licences that combine them.
TERMS = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
COMBINED = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
COMBINED_WORDINGS = ("Licensed under CC {short} 4.0", "licensed under a Creative Commons {long} license", "Creative Commons {long} 4.0 International License", "Creative Commons {long} 3.0 Unported License")
#: Short names of the licences, and how a line says that they hold, or that they do not.
NAMES = {
    "Apache-2.0": ("Apache 2.0", "Apache License 2.0"), "MIT": ("MIT",), "BSD": ("BSD", "BSD-3-Clause", "2-Clause BSD"), "ISC": ("ISC",), "MPL-2.0": ("MPL 2.0", "MPLv2", "MPLv2.0"), "EPL-2.0": ("EPL 2.0", "EPLv2"),
    "GPL-2.0": ("GPLv2", "GPL 2.0", "GPL v2", "GPL version 2"), "GPL-3.0": ("GPLv3", "GPL 3.0", "GPL v3", "GPL version 3"), "LGPL-2.1": ("LGPLv2.1", "LGPL 2.1", "LGPL v2.1"), "LGPL-3.0": ("LGPLv3", "LGPL 3.0", "LGPL v3"),
    "AGPL-3.0": ("AGPLv3", "AGPL 3.0", "AGPL v3"), "zlib": ("zlib",), "BSL-1.0": ("Boost 1.0", "BSL 1.0"), "CC0": ("CC0", "CC0 1.0"),
}
SHORT = ("License: {n}", "Licensed under {n}", "This is licensed under {n}", "Licensed under the {n} license", "{n} licensed", "This file is {n} licensed", "under the {n} license", "licensed under the terms of the {n} license")
DENIED = ("not released under the {n} license", "This is not licensed under {n}", "no longer licensed under the {n} license")
#: Identifiers that name a family in one line.
IDENTIFIERS = {
    "Apache-2.0": "Apache-2.0", "MIT": "MIT", "BSD-2-Clause": "BSD", "BSD-3-Clause": "BSD", "ISC": "ISC", "MPL-2.0": "MPL-2.0", "EPL-2.0": "EPL-2.0", "Unlicense": "Unlicense", "CC0-1.0": "CC0",
} | {f"{family}-{how}": family for family, *_ in VERSIONED for how in ("only", "or-later")} | {f"CC-{short}-4.0": f"CC-{short}" for short in COMBINED}
#: Statements that sound alike and name no family, or not which version of it.
OTHERS = (
    "the driver renewed a licence at the office", "this licence is void", "permission was granted to enter", "a public version of the work", "copyright belongs to the authors",
    "released under pressure", "the general public came to see this work", "free of charge for any person", "version 2.0 of the plan", "in source and binary forms",
    "all roads reserved for the public", "rights of the person", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by",
    "GNU General Public License", "GNU Lesser General Public License as published by the Free Software Foundation", "the Free Software Foundation, either version of the License, or",
    "either version 3 of the plan, or any later version", "you should have received a copy of the License along with this program", "licensed under the terms of the agreement",
    "Creative Commons license", "licensed under a license of the city", "SPDX-License-Identifier", "a license to drive, version 3", "the name of the author of this file",
    "the following conditions are met by all members", "this list of members and the following paragraph", "the software is distributed by mail", "made available under the terms of the contract",
    "a copy of this document was obtained at the office", "the mit is a university", "the cc list of the letter", "it is strictly prohibited to smoke", "public domain", "the fee for any purpose",
)
#: Statements that only set temperature and threshold.
CALIBRATION = (
    ("Apache-2.0", "Distributed under the Apache License, Version 2.0; see the file LICENSE"), ("Apache-2.0", "This project uses the Apache License, Version 2.0"),
    ("MIT", "This project is released under the MIT License, see below"), ("MIT", "Licensed under the MIT License"), ("MIT", "This code is under the MIT license"),
    ("BSD", "This code is released under the BSD License"), ("GPL-3.0", "This code is licensed under the GNU General Public License, version 3 or later"),
    ("GPL-2.0", "This kernel is licensed under the GNU General Public License version 2"), ("GPL-2.0", "GNU General Public License v2"), ("LGPL-2.1", "this library is under the GNU Lesser General Public License, version 2.1"),
    ("AGPL-3.0", "The server is released under the GNU Affero General Public License version 3"), ("MPL-2.0", "This file is subject to the Mozilla Public License, version 2.0"),
    ("CC-BY", "This picture is licensed under CC BY 4.0"), ("CC-BY-SA", "Text is licensed under CC BY-SA 4.0"), ("CC-BY-NC", "Figures are licensed under CC BY-NC 4.0 by the museum"),
    ("CC-BY-NC-ND", "This article is licensed under CC BY-NC-ND 4.0"), ("proprietary", "Copyright 2019 by the company. All rights reserved."), ("EPL-2.0", "Released under the Eclipse Public License, version 2.0"),
    (UNKNOWN, "the museum is open to the general public under the terms of its statute"), (UNKNOWN, "licensed to carry goods of any kind, version 2"), (UNKNOWN, "a license for the software"),
    (UNKNOWN, "permission to copy the key was granted by the owner"), (UNKNOWN, "the above notice was included in all copies of the newspaper"), (UNKNOWN, "GNU General Public License of any version"),
    ("zlib", "This library is released under the zlib License"), ("BSL-1.0", "Use is subject to the Boost Software License, Version 1.0"), (UNKNOWN, "the book is not licensed under any license"),
    (UNKNOWN, "reserved seats for all members"), (UNKNOWN, "released under a new name"), (UNKNOWN, "redistribution of land in source regions"), (UNKNOWN, "creative work in common"),
)
#: The same for each short name, in words that training does not use.
CALIBRATION_SHORT = ("This repository is licensed under {n}", "All code here is under the {n} license", "{n} licensed, see the file LICENSE")
CALIBRATION_DENIED = ("Nothing here is released under the {n} license, it is not licensed under {n}",)
WORD = r"[a-z0-9]+"
CONFIRM = 0.6
#: Words of a window and from one to the next: a statement of up to 49 words is whole in one.
WINDOW, STEP = 64, 16
#: Words that any text may hold.
COMMON = frozenset("a all an and any are as at be by can for from i in is it its may must no nor not of on or that the their this to use used which with you 0 1 2 3 4 v above any below "
                   "distributed file files following form forms free general http included later law made material materials name names obtain person provided public purpose released required "
                   "will versions such being original plainly marked express implied event authors held arising "
                   "software source terms under use version without work your program condition conditions copies copy list binary documentation derived holder international products promote".split())


def named_templates() -> list[tuple[str, str, str]]:
    """(family, statement, name) of all statements, written out; a statement with a short name needs all of it."""
    out = list(STATEMENTS)
    out += [(family, w.format(name=name, v=v)) for family, name, v in VERSIONED for w in WORDINGS]
    out += [(f"CC-{short}", w.format(short=short, long="-".join(TERMS[t] for t in short.split("-")))) for short in COMBINED for w in COMBINED_WORDINGS]
    out += [(family, f"SPDX-License-Identifier: {name}") for name, family in IDENTIFIERS.items()]
    return [(f, t, "") for f, t in out] + [(f, w.format(n=n), n) for f, names in NAMES.items() for n in names for w in SHORT]


def templates() -> list[tuple[str, str]]:
    return [(f, t) for f, t, _ in named_templates()]


def others() -> list[str]:
    """Statements of no family."""
    return [*OTHERS, *(w.format(n=n) for names in NAMES.values() for n in names for w in DENIED)]


def calibration() -> list[tuple[str, str]]:
    out = list(CALIBRATION)
    for family, names in NAMES.items():
        for n in names:
            out += [(family, w.format(n=n)) for w in CALIBRATION_SHORT] + [(UNKNOWN, w.format(n=n)) for w in CALIBRATION_DENIED]
    return out


def grams_of(text: str) -> set[str]:
    words = re.findall(WORD, text.lower())
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))}


@functools.cache
def anchors() -> list[str]:
    """Key words: each template has one at least, and is only found where one of its own is.

    So passages without any of them are unknown, and leaving them out changes no result.
    """
    left = [set(re.findall(WORD, t.lower())) - COMMON for _, t in templates()]
    chosen: list[str] = []
    while left:
        count: dict[str, int] = {}
        for words in left:
            for w in words:
                count[w] = count.get(w, 0) + 1
        chosen.append(max(count, key=lambda w: (count[w], w)))
        left = [words for words in left if chosen[-1] not in words]
    return sorted(chosen)


def anchor() -> str:
    return rf"(?i)(?<![a-z0-9])(?:{'|'.join(anchors())})(?![a-z0-9])"


class Rows:
    """Sparse rows of 0 and 1: the columns of each, one row after another."""

    def __init__(self, rows: list[list[int]]) -> None:
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.column = np.array([c for r in rows for c in r], np.int64)
        self.n = len(rows)
        self.by_column = np.argsort(self.column, kind="stable")

    @staticmethod
    def _summed(values: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
        """Sums of runs of equal ascending ``key``."""
        out = np.zeros((n, values.shape[1]))
        if len(key):
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            out[key[first]] = np.add.reduceat(values, first)
        return out

    def times(self, weight: np.ndarray) -> np.ndarray:
        return self._summed(weight[self.column], self.row, self.n)

    def transposed_times(self, error: np.ndarray, columns: int) -> np.ndarray:
        return self._summed(error[self.row[self.by_column]], self.column[self.by_column], columns)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@functools.cache
def train(seed: int = 5, variants: int = 6, epochs: int = 200) -> tuple[list[str], dict[str, np.ndarray], np.ndarray, float]:
    """Families, weights of n-grams, biases (both over the temperature) and the threshold."""
    rng = np.random.default_rng(seed)
    known = templates()
    families = [UNKNOWN, *sorted({f for f, _ in known})]
    index = {g: i for i, g in enumerate(vocabulary())}
    columns = lambda text: sorted(index[g] for g in grams_of(text) if g in index)
    filler = sorted({w for t in OTHERS for w in re.findall(WORD, t.lower())} | COMMON - {"not"})
    long = [t for _, t, n in named_templates() if not n]
    everything = [w for t in long for w in t.split()]
    rows, target = [], []
    for family, text in (*known, *((UNKNOWN, t) for t in others())):
        short = len(text.split()) < 8
        # families of few statements are varied more often
        for k in range(variants * max(1, 6 // max(1, sum(f == family for f, _ in known)))):
            # words of a short statement all count; a longer one may lose some
            words = [w for w in text.split() if k == 0 or short or rng.random() > 0.1]
            noise = [] if k == 0 else list(rng.choice(filler, rng.integers(0, 24)))
            at = int(rng.integers(len(noise) + 1))
            rows.append(columns(" ".join([*noise[:at], *words, *noise[at:]])))
            target.append(families.index(family))
    for _ in range(variants * len(long) // 4):  # words of all longer templates in no order, and parts of one
        rows.append(columns(" ".join(rng.choice(everything, rng.integers(1, 12)))))
        words = long[int(rng.integers(len(long)))].split()
        rows.append(columns(" ".join(words[: len(words) // 3])))
        target += [0, 0]
    x, y = Rows(rows), np.array(target)
    weight, bias = np.zeros((len(index), len(families))), np.zeros(len(families))
    goal = np.eye(len(families))[y]
    step, velocity, drift = 12.0, np.zeros_like(weight), np.zeros_like(bias)
    for _ in range(epochs):
        error = (_softmax(x.times(weight) + bias) - goal) / len(y)
        velocity = 0.9 * velocity - step * (x.transposed_times(error, len(index)) + 1e-5 * weight)
        drift = 0.9 * drift - step * error.sum(axis=0)
        weight, bias = weight + velocity, bias + drift
    held = Rows([columns(t) for _, t in calibration()])
    right = np.array([families.index(f) for f, _ in calibration()])
    logits = held.times(weight) + bias
    temperature = min(np.linspace(0.5, 6, 56), key=lambda t: -np.log(_softmax(logits / t)[np.arange(len(right)), right] + 1e-12).mean())
    p = _softmax(logits / temperature)
    best, sure = p.argmax(axis=1), p.max(axis=1)
    # the smallest threshold at which at least 98 in 100 named families are right on statements not learnt from
    grid = np.linspace(0.5, 0.95, 19)
    share = [((best == right) & (best > 0) & (sure >= t)).sum() / max(1, ((best > 0) & (sure >= t)).sum()) for t in grid]
    threshold = float(next((t for t, r in zip(grid, share, strict=True) if r >= 0.98), grid[-1]))
    return families, {g: weight[i] / temperature for g, i in index.items()}, bias / temperature, threshold


def _grams(text: Column) -> Column:
    """Distinct word uni- and bigrams."""
    words = F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))
    pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.concat(words, pairs))


def _passages(paragraph: Column) -> Column:
    """Distinct lines and windows that hold an anchor, in lower case, one space between words."""
    low = F.lower(paragraph)
    # a match begins at a word, so that no run of other characters is tried at each of its places
    word = "(?:[a-z0-9]++[^a-z0-9]*+)"
    windows = F.regexp_extract_all(low, F.lit(f"(?=({word}{{1,{WINDOW}}}+)){word}{{1,{STEP}}}+"), F.lit(1))
    plain = F.transform(F.concat(F.split(low, "\n"), windows), lambda x: F.trim(F.regexp_replace(x, "[^a-z0-9]+", " ")))
    return F.array_distinct(F.filter(plain, lambda x: x.rlike(anchor())))


def _parts(text: Column) -> Column:
    """The paragraphs of a text that hold a word."""
    return F.filter(F.split(text, r"\n\s*\n"), lambda p: p.rlike("[A-Za-z0-9]"))


@functools.cache
def vocabulary() -> list[str]:
    """All n-grams that have a weight: those of the templates and of what only sounds like them."""
    return sorted(set().union(*(grams_of(t) for _, t in templates()), *(grams_of(t) for t in others())))


def passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, number, grams, h1, h2) of the passages that hold an anchor, of every whole text.

    ``grams`` are those of the vocabulary, all that a passage's class depends on; two digests name them.
    """
    whole = F.col(text).cast("string")
    rows = docs.where(whole.rlike(anchor())).select(F.col(key).alias("doc_id"), F.xxhash64(whole).alias("text_hash"), F.posexplode(_parts(whole)).alias("number", "paragraph"))
    rows = rows.where(F.col("paragraph").rlike(anchor())).select("doc_id", "text_hash", "number", F.explode(_passages(F.col("paragraph"))).alias("passage"))
    known = vocabulary()
    rows = rows.select("doc_id", "text_hash", "number", F.array_sort(F.filter(_grams(F.col("passage")), lambda g: g.isin(known))).alias("grams"))
    return rows.withColumns({"h1": F.xxhash64("grams", F.lit(1)), "h2": F.xxhash64("grams", F.lit(2))})


def classify(distinct: DataFrame) -> DataFrame:
    """(h1, h2, family, probability) of those of the distinct ``grams`` (h1, h2, grams) that have a family.

    Of families whose probability is the same the first by name is taken. Templates are compared
    for passages with a likely family only.
    """
    spark = distinct.sparkSession
    families, weights, bias, threshold = train()
    table = spark.createDataFrame([(g, [float(x) for x in w]) for g, w in weights.items()], "gram string, weights array<double>")
    known = spark.createDataFrame(
        [(t, f, len(grams_of(s)), len(grams_of(n)), g, g in anchors(), g in grams_of(n)) for t, (f, s, n) in enumerate(named_templates()) for g in sorted(grams_of(s))],
        "template int, family string, size int, named int, gram string, key boolean, name boolean",
    )
    name = ["h1", "h2"]
    # both tables are as large as the templates above, whatever the corpus
    sums = [F.sum(F.get("weights", F.lit(i))).alias(f"w{i}") for i in range(len(families))]
    scores = distinct.select(*name, F.explode("grams").alias("gram")).join(F.broadcast(table), "gram").groupBy(name).agg(*sums)
    logits = [F.round(F.col(f"w{i}") + float(bias[i]), 9) for i in range(len(families))]
    top = F.greatest(*logits)
    best = F.coalesce(*(F.when(x == top, F.lit(f)) for f, x in zip(families, logits, strict=True)))
    total = sum((F.exp(x - top) for x in logits[1:]), F.exp(logits[0] - top))
    scores = scores.select(*name, best.alias("best"), F.round(1 / total, 9).alias("probability")).where((F.col("best") != UNKNOWN) & (F.col("probability") >= threshold))
    likely = written(distinct.join(scores, name), "licence-likely")
    match = likely.select(*name, "best", "probability", F.explode("grams").alias("gram")).join(F.broadcast(known), "gram")
    match = match.groupBy(*name, "best", "probability", "family", "template").agg((F.count("*") / F.max("size")).alias("found"), F.max("key").alias("key"), (F.count_if("name") == F.max("named")).alias("whole")).where("key AND whole")
    own = F.col("family") == F.col("best")
    fits = match.groupBy(*name, "best", "probability").agg(F.max(F.when(own, F.col("found"))).alias("found"), F.coalesce(F.max(F.when(~own, F.col("found"))), F.lit(0.0)).alias("other"))
    return fits.where((F.col("found") >= CONFIRM) & (F.col("found") > F.col("other"))).select(*name, F.col("best").alias("family"), "probability")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Licence families of each row of ``docs``.

    Returns doc_id, n_paragraphs (that hold a word), n_licences (of them with a family), families
    (sorted, comma-joined; empty if none) and confidence (greatest probability of a named
    family, else 0). A paragraph has the families of all its passages. A passage that many
    documents share is classified once. Null and empty texts have no paragraphs; very long ones
    are scored window by window; each of several equal rows, or rows that repeat a key, null or
    not, has its own text's result; an empty table gives no rows. Only key and text are read.
    """
    prepare(docs.sparkSession)
    found = written(passages(docs, key, text), "licence-passages")
    distinct = written(found.groupBy("h1", "h2").agg(F.any_value("grams").alias("grams"), F.count("*").alias("n")), "licence-distinct")
    named = written(classify(distinct.select("h1", "h2", "grams")).join(distinct.select("h1", "h2", "n"), ["h1", "h2"]), "licence-classes")
    hits = split_join(found.select("doc_id", "text_hash", "number", "h1", "h2"), named, ["h1", "h2"], "n")
    per_doc = hits.groupBy(F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash")).agg(
        F.count_distinct("number").alias("n_licences"), F.concat_ws(",", F.array_sort(F.collect_set("family"))).alias("families"), F.max("probability").alias("confidence"),
    )
    whole = F.col(text).cast("string")
    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(whole).alias("text_hash"), F.coalesce(F.size(_parts(whole)), F.lit(0)).cast("long").alias("n_paragraphs"))
    out = rows.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash")), "left")
    return out.select(
        "doc_id", "n_paragraphs", F.coalesce("n_licences", F.lit(0)).cast("long").alias("n_licences"), F.coalesce("families", F.lit("")).alias("families"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
