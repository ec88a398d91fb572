"""Licence scan with DataFrame functions only.

Texts are cut into units (lines, and sentences within them). A unit is
compared with short notices by the cosine of sparse TF-IDF vectors. Whole
licence texts (``license_texts``) and standard headers are compared in the
same way with blocks: the whole file, its leading comment, runs of a few
paragraphs, and windows of a licence's own length at every eighth of it, so
that a licence of any length inside a longer file lies in one; comment marks
are taken off. An SPDX
identifier names its licence by itself. A document that is named like a
licence file, or of whose words half lie in licence units or in one licence
block, is one. Files without a licence of their own inherit that of
the nearest ancestor directory with a licence file.

Candidate units are those that hold an anchor term, and of some template
terms enough for the threshold. Anchors are chosen so
that without any of them no cosine can reach the threshold: a template's
other terms have too small a norm (Cauchy-Schwarz). So the filter loses
nothing, and since equal units are compared once, a line that a third of
all documents share costs one comparison. Blocks are made only of texts
whose distinct terms hold, of some template, a share of the norm that lets a
block reach the threshold; only sums of those shares are shuffled to find
them. Blocks are long, so their terms are counted inside the row and only
sums per block are shuffled. Templates are a fixed small table; only they
are sent to every task.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clasp.functions.stopwords import ENGLISH_STOP_WORDS
from clasp.llm.common import WORD_PATTERN, cut

#: Short public notices and the first words of licence texts.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This work is subject to the terms of the Mozilla Public License, version 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Released under the ISC License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
)
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
UNIT_END = r"\n|(?<=[.;!?])\s+"
LICENSE_NAME = r"(?i)(^|/)(un)?(licen[cs]e|copying|notice)[^/]*$"
THRESHOLD = 0.7
FILE_SHARE = 0.5
#: Words that are no terms, and terms that are anchors only where others don't suffice.
STOP = frozenset("a an and any in into is of the this to was".split())
COMMON = frozenset("by free general public under version work".split())

_GNU = ("{0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free "
        "Software Foundation, {2}.",
        "{0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details.",
        "You should have received a copy of the GNU {1} along with {0}. If not, see https://www.gnu.org/licenses")
_FORMS = ("either version {0} of the License, or (at your option) any later version", "version {0} of the License")
_GNU_NAMES = (("GPL-2.0", "2", "General Public License"), ("GPL-3.0", "3", "General Public License"),
              ("LGPL-2.1", "2.1", "Lesser General Public License"), ("LGPL-3.0", "3", "Lesser General Public License"),
              ("AGPL-3.0", "3", "Affero General Public License"))
#: Standard headers of source files; GNU's also without its later paragraphs, as many files have it.
HEADERS: tuple[tuple[str, str], ...] = (
    *((short, " ".join(_GNU[:n]).format("This program", name, form.format(version)))
      for short, version, name in _GNU_NAMES for form in _FORMS for n in (1, 2, 3)),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
     "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
     'agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS '
     "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the "
     "License."),
    ("Apache-2.0", "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file "
     "distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to You under the "
     'Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a '
     "copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
     'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either '
     "express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)
#: Fixed values of the block comparison.
BLOCK_STOP = STOP | frozenset(ENGLISH_STOP_WORDS)
EVERYDAY = COMMON | frozenset("also author change changes conditions copies copy file following form given law list may means must name "
                              "new notice one person program provided rights section source terms text time use used without".split())
MARKS = r"(?m)^[ \t]*(?:(?:/\*+|\*+/|\*+|//+|#+|--+|;+|%+|<!--+|\"{3}|'{3}|dnl\b)[ \t]*)?|[ \t]*(?:\*+/|--+>)[ \t]*$"
COMMENT = r"^\s*(?:(?:#|//|/?\*|--|;|%)[^\n]*(?:\n[ \t]*|$)){2,}+"
PARAGRAPH_END = r"\n[ \t]*(?:\r?\n[ \t]*)+"
#: Paragraphs of a run: those of the longest header or short licence, and one. Longer licences are met by windows.
RUN = 8
PIECE_PARAGRAPHS, PIECE_WORDS = 200, 30_000
WINDOWS, WINDOW_STEP = (0.75, 1.0, 1.25), 8  # lengths of windows, as parts of a template's, and starts in each length
SPDX = r"(?i)SPDX-License-Identifier:[ \t]*([^\n\r*]+)"


def block_templates() -> tuple[tuple[str, str], ...]:
    """Whole licence texts, named by their files, the paragraph of MIT and
    ISC that tells them apart, and the standard headers."""
    folder = resources.files("clasp.llm") / "license_texts"
    texts = sorted((f.name.removesuffix(".txt"), f.read_text()) for f in folder.iterdir() if f.name.endswith(".txt"))
    grants = [(name, part) for name, t in texts if name in ("MIT", "ISC") for part in t.split("\n\n") if part.startswith("Permission")]
    return (*texts, *grants, *HEADERS)


def template_terms(templates=TEMPLATES, stop=STOP) -> tuple[dict[str, float], list[tuple[int, str, dict[str, float]]]]:
    """IDF over the templates, and each as ``(number, licence, weights)``."""
    split = [[w for w in re.findall(TERM, t.lower()) if w not in stop] for _, t in templates]
    counts = [Counter(s) for s in split]
    held = Counter(w for c in counts for w in c)
    idf = {w: math.log((1 + len(split)) / (1 + n)) + 1 for w, n in held.items()}
    return idf, [(n, name, {w: k * idf[w] for w, k in c.items()}) for n, ((name, _), c) in enumerate(zip(templates, counts))]


def unseen_idf(templates=TEMPLATES) -> float:
    """Weight of a term that no template has."""
    return math.log(1 + len(templates)) + 1


def anchors(templates=TEMPLATES, threshold: float = THRESHOLD, stop=STOP, common=COMMON) -> list[str]:
    """Terms of which a text needs one to reach the threshold anywhere."""
    out: set[str] = set()
    for _, _, weights in template_terms(templates, stop)[1]:
        rest = sum(w * w for w in weights.values())
        whole = rest
        for term, w in sorted(weights.items(), key=lambda x: (x[0] in common, -x[1], x[0])):
            if rest < threshold * threshold * whole:
                break
            out.add(term)
            rest -= w * w
    return sorted(out)


def _template_table(spark: SparkSession, templates) -> DataFrame:
    _, split = template_terms(templates)
    rows = []
    for n, name, weights in split:
        norm = math.sqrt(sum(w * w for w in weights.values()))
        rows += [(n, name, term, w / norm) for term, w in weights.items()]
    return spark.createDataFrame(rows, "template int, license string, term string, weight double")


def terms_of(text: Column) -> Column:
    """Distinct terms of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})")))


def _any_of(terms: Column, wanted: list[str]) -> Column:
    return F.coalesce(F.arrays_overlap(terms, F.array(*map(F.lit, wanted))), F.lit(False))


def near_enough(unit: Column, templates=TEMPLATES, threshold: float = THRESHOLD) -> Column:
    """Whether a unit's terms hold a share of some template's norm that lets
    their cosine reach the threshold (Cauchy-Schwarz)."""
    idf, split = template_terms(templates)
    norms = [sum(w * w for w in weights.values()) for _, _, weights in split]
    parts = F.array(*[F.array(*[F.struct(F.lit(t).alias("term"), F.lit(w * w / norm).alias("share")) for t, w in weights.items()])
                      for (_, _, weights), norm in zip(split, norms)])

    def reached(hits: Column) -> Column:
        return F.exists(parts, lambda template: F.aggregate(template, F.lit(0.0), lambda total, p: total + F.when(
            F.array_contains(hits, p["term"]), p["share"]).otherwise(0.0)) >= threshold * threshold - 1e-9)
    return F.exists(F.array(F.array_intersect(F.array(*map(F.lit, idf)), terms_of(unit))), reached)


def units_of(text: Column, pattern: str, templates=TEMPLATES, threshold: float = THRESHOLD) -> Column:
    """Distinct candidate units of a text."""
    lines = F.filter(F.split(text, UNIT_END), lambda u: F.rlike(F.lower(u), F.lit(pattern)))
    return F.filter(F.array_distinct(F.transform(lines, lambda u: F.trim(u))), lambda u: near_enough(u, templates, threshold))


def cosines(units: DataFrame, templates=TEMPLATES) -> DataFrame:
    """Distinct ``unit`` texts -> ``unit, license, score`` of the nearest
    template (ties to the first)."""
    spark = units.sparkSession
    idf, _ = template_terms(templates)
    weights = F.broadcast(spark.createDataFrame(list(idf.items()), "term string, idf double"))  # the templates' terms
    # dealt by id once: all that follows groups and joins by it and needs no other shuffle
    named = units.withColumn("id", F.md5("unit")).repartition("id")
    counts = (named.select("id", F.explode(F.regexp_extract_all(F.lower("unit"), F.lit(f"({TERM})"))).alias("term"))
              .where(~F.col("term").isin(*STOP)).groupBy("id", "term").agg(F.count(F.lit(1)).alias("n")))
    weighed = counts.join(weights, "term", "left").select(
        "id", "term", (F.col("n") * F.coalesce("idf", F.lit(unseen_idf(templates)))).alias("w"))
    norms = weighed.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = (weighed.join(F.broadcast(_template_table(spark, templates)), "term").groupBy("id", "template", "license")
            .agg(F.sum(F.col("w") * F.col("weight")).alias("dot")))
    best = (dots.join(norms, "id").withColumn("score", F.round(F.col("dot") / F.col("norm"), 9))
            .groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("far"), "template", "license")).alias("best")))
    return named.join(best, "id").select("unit", F.col("best.license").alias("license"), (-F.col("best.far")).alias("score"))


def _once(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def spdx_licenses(text: Column) -> Column:
    """Licences that SPDX identifiers in a text name, as written there;
    ``-only``, ``-or-later``, ``+`` and exceptions are no licences of their own."""
    names = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(SPDX)), lambda e: F.regexp_extract_all(
        F.regexp_replace(e, r"(?i)\bWITH\s+\S+|\b(AND|OR)\b", " "), F.lit(r"([A-Za-z][A-Za-z0-9.\-]*[A-Za-z0-9])"))))
    return F.array_distinct(F.transform(names, lambda n: F.regexp_replace(n, r"(?i)-(only|or-later)$", "")))


def _bare(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, MARKS, ""))


def _pieces(items: Column, size: int, more: int) -> Column:
    """An array in pieces of ``size`` items, each with the next ``more``."""
    return _once(items, lambda a: F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / size).cast("int")),
                                              lambda k: F.slice(a, k * size + 1, size + more)))


def blocks_of(texts: DataFrame, pattern: str, lengths: Column, longest: int) -> DataFrame:
    """``key, text, templates`` -> ``key, block``: the whole text, its leading
    comment, runs of up to ``RUN`` paragraphs from each that holds an anchor,
    and windows of the ``lengths`` (in words) of its templates, of which none
    is over ``longest``. Very long texts are taken in overlapping pieces, so
    that a row never holds more than a piece's blocks."""
    def runs(parts: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.least(F.lit(PIECE_PARAGRAPHS), F.size(parts))),
                          lambda i: F.rlike(F.lower(F.element_at(parts, i)), F.lit(pattern)))
        return F.flatten(F.transform(starts, lambda i: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(RUN), F.size(parts) - i + 1)), lambda n: F.array_join(F.slice(parts, i, n), "\n"))))

    def windows(words: Column, n: Column) -> Column:
        starts = F.sequence(F.lit(1), F.least(F.lit(PIECE_WORDS), F.size(words)), F.greatest(F.lit(1), F.floor(n / WINDOW_STEP).cast("int")))
        return F.flatten(F.transform(starts, lambda i: F.transform(
            F.array(*map(F.lit, WINDOWS)), lambda f: F.array_join(F.slice(words, i, F.ceil(n * f).cast("int")), " "))))
    bare = texts.select("key", lengths.alias("lengths"), _bare(F.col("text")).alias("text"), F.regexp_extract("text", COMMENT, 0).alias("comment"))
    whole = bare.select("key", F.explode(F.array(F.col("text"), _bare(F.col("comment")))).alias("block"))
    parts = bare.select("key", F.explode(_pieces(F.split("text", PARAGRAPH_END), PIECE_PARAGRAPHS, RUN)).alias("piece"))
    words = bare.select("key", "lengths", F.explode(_pieces(F.split("text", r"\s+"), PIECE_WORDS, math.ceil(longest * max(WINDOWS)))).alias("piece"))
    each = words.select("key", F.explode(F.flatten(F.transform("lengths", lambda n: windows(F.col("piece"), n)))).alias("block"))
    return (whole.unionByName(parts.select("key", F.explode(runs(F.col("piece"))).alias("block"))).unionByName(each)
            .where("block <> ''"))


def term_counts(text: Column) -> Column:
    """``term, n`` of a text's terms, and one of the empty term."""
    terms = F.filter(F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})")), lambda t: ~t.isin(*sorted(BLOCK_STOP)))

    def lengths(a: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda i: (i == 0) | (F.get(a, i) != F.get(a, i - 1)))
        return _once(starts, lambda b: F.transform(b, lambda i, j: F.struct(
            F.get(a, i).alias("term"), (F.coalesce(F.get(b, j + 1), F.size(a)) - i).alias("n"))))
    return _once(F.array_sort(F.concat(F.array(F.lit("")), terms)), lengths)


def block_hits(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``key, text, hits`` (the text's distinct template terms) -> ``key,
    held, far, license`` of each block at the threshold; ``held`` counts its
    words. Rows of one key hold one text."""
    spark, templates = files.sparkSession, block_templates()
    pattern = r"\b(" + "|".join(re.escape(a) for a in anchors(templates, threshold, BLOCK_STOP, EVERYDAY)) + r")\b"
    idf, split = template_terms(templates, BLOCK_STOP)
    norms = [math.sqrt(sum(w * w for w in weights.values())) for _, _, weights in split]
    table = F.broadcast(spark.createDataFrame(
        [(t, i, [(-1, 0.0)] + [(n, weights[t] / norms[n]) for n, _, weights in split if t in weights]) for t, i in idf.items()],
        "term string, idf double, parts array<struct<template int, weight double>>"))
    names = F.broadcast(spark.createDataFrame([(n, name) for n, name, _ in split], "template int, license string"))
    # no block of a text is nearer to a template than the norm of the terms they share (Cauchy-Schwarz)
    shares = (files.select("key", F.explode("hits").alias("term")).join(table, "term")
              .select("key", F.explode("parts").alias("x")).where("x.template >= 0").groupBy("key", "x.template")
              .agg(F.sum(F.col("x.weight") * F.col("x.weight")).alias("share")))
    wanted = cut(shares.where(F.col("share") >= threshold * threshold - 1e-9).groupBy("key")
                 .agg(F.sort_array(F.collect_set("template")).alias("templates")), "license-wanted")
    texts = cut(files.select("key", "text").join(wanted, "key"), "license-texts")
    sizes = F.array(*[F.lit(len(text.split())) for _, text in templates])
    lengths = F.array_distinct(F.transform("templates", lambda t: F.element_at(sizes, t + 1)))
    blocks = blocks_of(texts, pattern, lengths, max(len(text.split()) for _, text in templates)).select(
        "key", F.md5("block").alias("b"), F.regexp_count("block", F.lit(WORD_PATTERN)).alias("held"),
        term_counts(F.col("block")).alias("terms"))
    # the counts are made below the explosion, once a block
    counts = blocks.select("key", "b", "held", F.explode("terms").alias("x")).select("key", "b", "held", "x.term", "x.n")
    first = F.col("term") == ""  # one a copy of the block
    w = F.when(first, 0.0).otherwise(F.col("n") * F.coalesce("idf", F.lit(unseen_idf(templates))))
    own = F.array(F.struct(F.lit(-1).alias("template"), F.lit(0.0).alias("weight")))  # its sum is the block's own norm
    sums = cut(counts.join(table, "term", "left")
               .select("key", "b", "held", first.cast("int").alias("m"), w.alias("w"), F.explode(F.coalesce("parts", own)).alias("x"))
               .groupBy("key", "b", "x.template").agg(
                   F.max("held").alias("held"), F.sum("m").alias("m"),
                   F.sum(F.when(F.col("x.template") < 0, F.col("w") * F.col("w")).otherwise(F.col("w") * F.col("x.weight"))).alias("s")),
               "license-blocks")
    norm = sums.where("template < 0 and s > 0").select("key", "b", "held", "m", F.col("s").alias("square"))
    dots = sums.where("template >= 0").select("key", "b", "template", F.col("s").alias("dot"))
    score = F.round(F.col("dot") / F.sqrt(F.col("square") * F.col("m")), 9)
    return (norm.join(dots, ["key", "b"]).where(score >= threshold).join(names, "template")
            .select("key", "held", (-score).alias("far"), "license"))


def parents(path: Column) -> Column:
    """Directories of a path, nearest first, down to the root ``''``."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1)),
                       lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def scan(files: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: Column | str = "path",
         threshold: float = THRESHOLD, file_share: float = FILE_SHARE, templates=TEMPLATES) -> DataFrame:
    """``doc_id, license, found, score``, one row per input row.

    A unit at the ``threshold`` is a licence unit, a block at it a licence
    block, and an SPDX identifier scores 1; a document's best one counts,
    ties to the licence first by name. ``found`` is ``file`` (a
    licence file), ``header``, ``inherited`` or ``none``. A directory with
    several licence files has the licence with the best score, ties by name.
    Null and empty texts have no licence of their own; a null path has no
    directory and no name. Repeated rows are judged alike, and a unit that
    a text repeats counts once. Other columns are ignored; an empty table
    gives no rows.
    """
    pattern = r"\b(" + "|".join(re.escape(a) for a in anchors(templates, threshold)) + r")\b"
    place = F.col(path) if isinstance(path, str) else path
    text = F.col(text_col)
    source = files.select(F.col(id_col).alias("doc_id"), place.cast("string").alias("path"), text.alias("text"))
    key = F.md5(F.to_json(F.struct("path", "text")))
    legal = anchors(block_templates(), threshold, BLOCK_STOP, EVERYDAY)
    vocabulary = F.array(*map(F.lit, template_terms(block_templates(), BLOCK_STOP)[0]))
    nothing = F.array().cast("array<string>")
    # a unit or block at the threshold holds an anchor among its terms, and so does its text
    seen = source.withColumn("terms", terms_of(F.col("text"))).select(
        "doc_id", "path", "text",
        F.when(_any_of(F.col("terms"), anchors(templates, threshold)), units_of(F.col("text"), pattern, templates, threshold)).otherwise(nothing).alias("units"),
        F.when(_any_of(F.col("terms"), ["spdx"]), spdx_licenses(F.col("text"))).otherwise(nothing).alias("tags"),
        F.when(_any_of(F.col("terms"), legal), F.array_intersect("terms", vocabulary)).alias("hits"))
    candidate = (F.size("units") > 0) | (F.size("tags") > 0) | F.col("hits").isNotNull()
    rows = cut(seen.select("doc_id", "path", "units", "tags", "hits", F.when(F.col("hits").isNotNull(), F.col("text")).alias("text"),
                           F.when(candidate, F.regexp_count("text", F.lit(WORD_PATTERN))).alias("words"),
                           F.when(candidate, key).alias("key")), "license-rows")
    given = rows.where("key is not null")
    each = given.select("key", F.explode("units").alias("unit")).distinct()
    judged = cut(cosines(each.select("unit").distinct(), templates).where(F.col("score") >= threshold), "license-units")
    hits = (each.withColumnRenamed("unit", "u").join(judged, F.col("u") == judged["unit"]).groupBy("key")
            .agg(F.sum(F.regexp_count("unit", F.lit(WORD_PATTERN))).alias("held"),
                 F.min(F.struct((-F.col("score")).alias("far"), "license")).alias("best")))
    tagged = given.select("key", F.explode("tags").alias("license")).groupBy("key").agg(
        F.lit(0).cast("long").alias("held"), F.min(F.struct(F.lit(-1.0).alias("far"), "license")).alias("best"))
    blocks = block_hits(given.where("hits is not null").select("key", "text", "hits"), threshold).groupBy("key").agg(
        F.max("held").cast("long").alias("held"), F.min(F.struct("far", "license")).alias("best"))
    named = F.coalesce(F.rlike("path", F.lit(LICENSE_NAME)), F.lit(False))
    found = hits.unionByName(tagged).unionByName(blocks).groupBy("key").agg(F.max("held").alias("held"), F.min("best").alias("best"))
    own = cut(given.select("key", "path", "words").distinct().join(found, "key")
              .select("key", "path", "best", (named | (F.col("held") >= F.col("words") * file_share)).alias("is_file")),
              "license-own")
    # directories: few columns and no texts from here on
    folders = (own.where("is_file and path is not null").select(parents(F.col("path"))[0].alias("dir"), "best")
               .groupBy("dir").agg(F.min("best").alias("best")))
    here = parents(F.col("path"))
    bare = rows.where("path is not null").select(here[0].alias("home"), here.alias("dirs")).distinct()
    above = (bare.select("home", F.posexplode("dirs").alias("steps", "dir")).join(folders, "dir")
             .groupBy("home").agg(F.min(F.struct("steps", "best")).alias("nearest")))
    above = cut(above.select("home", F.col("nearest.best").alias("given")), "license-folders")
    full = (rows.where("key is null").select("doc_id", "path", F.lit(None).cast("boolean").alias("is_file"),
                                             F.lit(None).cast(dict(own.dtypes)["best"]).alias("best"))
            .unionByName(given.select("doc_id", "path", "key").join(own.select("key", "is_file", "best"), "key", "left").drop("key")))
    out = full.withColumn("home", here[0]).join(above, "home", "left")
    mine, theirs = F.col("best").isNotNull(), F.col("given").isNotNull()
    return out.select(
        "doc_id", F.coalesce(F.col("best.license"), F.col("given.license")).alias("license"),
        F.when(mine & F.col("is_file"), "file").when(mine, "header").when(theirs, "inherited").otherwise("none").alias("found"),
        F.when(mine, -F.col("best.far")).when(theirs, -F.col("given.far")).otherwise(0.0).alias("score"))
