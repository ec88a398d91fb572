"""Licence scan against a plain one, and inheritance along paths."""

import math
import re

import pytest
from pyspark.sql import functions as F

from clasp.llm.licenses import (BLOCK_STOP, COMMENT, EVERYDAY, FILE_SHARE, LICENSE_NAME, MARKS, PARAGRAPH_END, RUN, STOP, TEMPLATES, TERM, THRESHOLD,
                                UNIT_END, WINDOW_STEP, WINDOWS, anchors, block_hits, block_templates, cosines, scan, template_terms, terms_of,
                                unseen_idf)

SCHEMA = "doc_id long, text string, path string, license string, units int"


def plain(rows):
    idf, templates = template_terms()

    def best(unit):
        terms = [t for t in re.findall(TERM, unit.lower()) if t not in STOP]
        w = {t: terms.count(t) * idf.get(t, unseen_idf()) for t in terms}
        norm = math.sqrt(sum(x * x for x in w.values())) or 1
        scores = [(-round(sum(w.get(t, 0) * x for t, x in ws.items()) / norm / math.sqrt(sum(x * x for x in ws.values())), 9), n, name)
                  for n, name, ws in templates]
        far, _, name = min(scores)
        return -far, name

    own, folders = [], {}
    for _, text, path in rows:
        text = text or ""
        units = {u.strip(" "): best(u.strip(" ")) for u in re.split(UNIT_END, text)}
        hits = {u: h for u, h in units.items() if h[0] >= THRESHOLD}
        named = bool(path and re.search(LICENSE_NAME, path))
        is_file = bool(hits) and (named or sum(len(u.split()) for u in hits) >= FILE_SHARE * len(text.split()))
        lic = min((-s, n) for s, n in hits.values()) if hits else None
        own.append((lic, is_file))
        if lic and is_file and path is not None:
            d = path.rpartition("/")[0]
            folders[d] = min(folders.get(d, lic), lic)
    out = []
    for (i, _, path), (lic, is_file) in zip(rows, own):
        how = "none" if not lic else "file" if is_file else "header"
        d = path
        while not lic and d:
            d = d.rpartition("/")[0]
            if d in folders:
                lic, how = folders[d], "inherited"
        out.append((i, lic and lic[1], how, -lic[0] if lic else 0.0))
    return out


def got(df, **more):
    return [(r.doc_id, r.license, r.found, round(r.score, 9)) for r in scan(df, **more).collect()]


order = lambda r: tuple(str(x) for x in r)


def test_cases(spark):
    mit, apache = TEMPLATES[0][1], TEMPLATES[3][1]
    prose = "plain words of a text. And more of them, by the way under any general version\n"
    rows = [
        (1, prose + "  " + mit + " \n" + prose, "a/b/one.txt"), (2, prose, "a/b/two.txt"), (3, apache, "a/LICENSE"),
        (4, prose, "a/b/c/d/four.txt"), (5, prose, "z/five"), (6, prose * 50 + apache, "z/y/COPYING.md"),
        (7, prose, "z/y/x/seven"), (8, None, "a/b/eight"), (9, "", None), (10, prose + mit + "\n" + apache, None),
        (None, mit.upper(), "q/only"), (12, "no licence", "q/r/s"), (13, mit, "q/only"), (13, mit, "q/only"),
        (14, "Licensed under CC BY-NC 4.0.\n" + "w " * 30_000, "m/n"), (15, "This work is licensed under the GNU General Public "
         "License, version 3. " + prose, "r15/root"), (16, "in the root", "top"), (17, "the LICENSE", "m/LICENSE"), (18, prose, "LICENSE2/x"),
    ]
    df = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    want = plain(rows)
    assert sorted(got(df), key=order) == sorted([(a, b, c, round(d, 9)) for a, b, c, d in want], key=order)
    found = {r[0]: r[1:3] for r in want}
    assert found[1] == ("MIT", "header") and found[4] == ("Apache-2.0", "inherited") and found[7] == ("Apache-2.0", "inherited")
    assert found[5] == (None, "none") and found[12] == ("MIT", "inherited") and found[14] == ("CC-BY-NC-4.0", "header")


def test_anchor_terms_lose_nothing():
    for t in (THRESHOLD, 0.9):
        keep = set(anchors(threshold=t))
        for _, _, w in template_terms()[1]:
            assert math.sqrt(sum(x * x for k, x in w.items() if k not in keep)) < t * math.sqrt(sum(x * x for x in w.values()))


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_documents(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    df = df.withColumn("path", F.concat_ws("/", "source", F.floor(F.col("doc_id") / 200), "doc_id"))
    rows = [(r.doc_id, r.text, r.path) for r in df.collect()]
    want = plain(rows)
    assert sorted(got(df)) == sorted((a, b, c, round(d, 9)) for a, b, c, d in want) if all(x[1] for x in want) else sorted(
        got(df), key=order) == sorted([(a, b, c, round(d, 9)) for a, b, c, d in want], key=order)
    assert sum(w[2] == "header" for w in want) > 10


def test_empty(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []


def packaged(name, end):
    from importlib.metadata import distribution
    return next(f.locate() for f in distribution(name).files if str(f).endswith(end)).read_text()


def test_real_texts_headers_and_spdx(spark):
    """Licences of installed packages and usual headers, none a template's words."""
    gpl = ("#!/usr/bin/env python\n# frob -- a tool\n# Copyright (C) 2011 Some One\n#\n# Frob is free software: you can redistribute it\n"
           "# and/or modify it under the terms of the GNU General Public License\n# as published by the Free Software Foundation, either\n"
           "# version 3 of the License, or (at your option) any later version.\n#\n# Frob is distributed in the hope that it will be\n"
           "# useful, but WITHOUT ANY WARRANTY; without even the implied warranty of\n# MERCHANTABILITY or FITNESS FOR A PARTICULAR\n"
           "# PURPOSE.  See the GNU General Public License for more details.\n\nimport os\n" + "total = os.getpid()\n" * 300)
    isc = ("/*\n * Copyright (c) 2004 Some One <one@example.org>\n *\n * Permission to use, copy, modify, and distribute this software for any\n"
           " * purpose with or without fee is hereby granted, provided that the above\n * copyright notice and this permission notice appear\n"
           " * in all copies.\n *\n * THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES\n * WITH REGARD TO THIS SOFTWARE "
           "INCLUDING ALL IMPLIED WARRANTIES OF\n * MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR\n * ANY SPECIAL, DIRECT, "
           "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES\n * WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS.\n */\n" + "int main(void) { return 0; }\n" * 200)
    readme = "# thing\n\n" + "It does a thing quite well.\n\n" * 60 + packaged("pytest", "licenses/LICENSE") + "\n\nGoodbye to all.\n" * 60
    cases = [(gpl, "GPL-3.0", "header"), (isc, "ISC", "header"), (readme, "MIT", "header"),
             (packaged("attrs", "licenses/LICENSE"), "MIT", "file"), (packaged("idna", "LICENSE.md"), "BSD-3-Clause", "file"),
             (packaged("pygments", "licenses/LICENSE"), "BSD-2-Clause", "file"), (packaged("requests", "licenses/LICENSE"), "Apache-2.0", "file"),
             ("// SPDX-License-Identifier: MIT\nint x;\n" + "y();\n" * 50, "MIT", "header"),
             ("# SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0\n" + "y()\n" * 50, "GPL-2.0", "header"),
             ("/* SPDX-License-Identifier: (EUPL-1.2 OR MIT) */\n" + "y()\n" * 50, "EUPL-1.2", "header"),
             ("The software may be used by one person, without notice.\n\nThe author of the program has rights.", None, "none")]
    rows = [(i, text, f"d{i}/f", None, None) for i, (text, _, _) in enumerate(cases)]
    once = sorted(got(spark.createDataFrame(rows, SCHEMA)), key=lambda r: r[0])
    assert [(r[1], r[2]) for r in once] == [c[1:] for c in cases]
    assert sorted(got(spark.createDataFrame(rows * 2, SCHEMA)), key=lambda r: r[0])[::2] == once  # repeated rows


def plain_blocks(text):
    """(words, score, licence) of the blocks of a text at the threshold."""
    templates = block_templates()
    idf, split = template_terms(templates, BLOCK_STOP)
    legal = anchors(templates, THRESHOLD, BLOCK_STOP, EVERYDAY)
    bare = re.sub(MARKS, "", text).strip(" ")
    comment = re.match(COMMENT, text)
    parts = re.split(PARAGRAPH_END, bare)
    blocks = {bare, re.sub(MARKS, "", comment.group()).strip(" ") if comment else ""}
    blocks |= {"\n".join(parts[i:i + n]) for i in range(len(parts)) for n in range(1, RUN + 1)
               if i + n <= len(parts) and any(re.search(rf"\b{re.escape(a)}\b", parts[i].lower()) for a in legal)}
    words = re.split(r"\s+", bare)
    known = set(re.findall(TERM, text.lower()))
    near = [sum(x * x for t, x in ws.items() if t in known) >= THRESHOLD ** 2 * sum(x * x for x in ws.values()) for _, _, ws in split]
    for size in {len(t.split()) for (_, t), wanted in zip(templates, near) if wanted}:
        for i in range(0, len(words), max(1, size // WINDOW_STEP)):
            blocks |= {" ".join(words[i:i + math.ceil(size * f)]) for f in WINDOWS}
    out = set()
    for block in blocks - {""}:
        terms = [t for t in re.findall(TERM, block.lower()) if t not in BLOCK_STOP]
        w = {t: terms.count(t) * idf.get(t, unseen_idf(templates)) for t in set(terms)}
        norm = math.sqrt(sum(x * x for x in w.values())) or 1
        for n, name, ws in split:
            score = sum(w.get(t, 0) * x for t, x in ws.items()) / norm / math.sqrt(sum(x * x for x in ws.values()))
            if round(score, 9) >= THRESHOLD:
                out.add((len(block.split()), round(score, 6), name))
    return out


def test_blocks_equal_plain(spark):
    mit, isc = (next(t for n, t in block_templates() if n == name) for name in ("MIT", "ISC"))
    split_up = "\n\n".join(mit.split(". "))  # a licence in more paragraphs
    each_line = "\n\n".join(isc.replace(", ", ",\n").splitlines())
    texts = ["prose " * 60 + "\n\n" + split_up + "\n\n" + "more prose here\n\n" * 30, each_line + "\n\n" + "code(); " * 90, "// " + mit.replace("\n", "\n// "),
             "The software may be used by one person.", "", "words only"]
    vocabulary = list(template_terms(block_templates(), BLOCK_STOP)[0])
    files = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "key string, text string").withColumn(
        "hits", F.array_intersect(terms_of(F.col("text")), F.array(*map(F.lit, vocabulary))))
    found = {str(i): set() for i in range(len(texts))}
    for x in block_hits(files).collect():
        found[x.key].add((x.held, round(-x.far, 6), x.license))
    assert found == {str(i): plain_blocks(t) for i, t in enumerate(texts)}
    assert max(found["0"], key=lambda x: x[1])[2] == "MIT" and max(found["1"], key=lambda x: x[1])[2] == "ISC"


def test_long_texts(spark):
    """Long licences inside longer texts, a very long comment, and long
    texts full of anchor terms, in time that grows with their length."""
    import time
    texts = dict(block_templates())
    prose = "the act of one may add another version 15 or license notice terms by any party\n\n"
    rows = [(1, prose * 600 + texts["GPL-3.0"] + "\n\n" + prose * 600, "a/one"), (2, "word " * 20_000 + "\n\n" + texts["MPL-2.0"], "b/two"),
            (3, "# " + "\n# ".join(texts["LGPL-2.1"].splitlines()) + "\nimport os\n" * 20_000, "c/three"), (4, prose * 1_500, "d/four"),
            (5, "word " * 300_000, "e/five")]
    began = time.time()
    out = {r[0]: r[1:3] for r in got(spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA))}
    assert out == {1: ("GPL-3.0", "header"), 2: ("MPL-2.0", "header"), 3: ("LGPL-2.1", "header"), 4: (None, "none"), 5: (None, "none")}
    assert time.time() - began < 240


def test_units_are_shuffled_once(spark):
    """A unit's terms never cross the network: all exchanges are by unit alone."""
    units = spark.createDataFrame([("Released under the MIT License.",), ("nothing of the kind",)], "unit string")
    found = cosines(units)
    plan = found._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert keys and all(re.fullmatch(r"id#\d+", k) for k in keys), keys
    assert [(r.unit, r.license, r.score) for r in found.where("score >= 0.7").collect()] == [("Released under the MIT License.", "MIT", 1.0)]
