from __future__ import annotations

import re

from churnlens.llm.licenses import TEMPLATES, license_matches
from tests.llm.frames import awkward, none, words


def split(text):
    return [x for x in re.sub(r"[^0-9a-z\x80-\U0010ffff]+", " ", re.sub("[A-Z]", lambda m: m.group().lower(), text)).split(" ") if x]


def brute(text, templates, threshold=0.8):
    """All units by Dice over their bigram sets, sizes bounded by counts."""
    out = []
    text = text or ""
    units = [("line", i, x) for i, x in enumerate(text.split("\n"))]
    units += [("paragraph", i, x) for i, x in enumerate(re.split(r"\n[ \t\r]*\n", text)) if "\n" in x]
    room = (2 - threshold) / threshold
    for kind, i, x in units:
        w = split(x)
        grams = {*zip(w, w[1:])}
        best = None
        for name, t in sorted(templates.items()):
            u = split(t)
            own = {*zip(u, u[1:])}
            if grams and (len(u) - 1) / room <= len(w) - 1 <= (len(u) - 1) * room:
                dice = 2 * len(grams & own) / (len(grams) + len(own))
                if dice >= threshold and (best is None or dice > best[0]):
                    best = (dice, name)
        if best:
            out.append((kind, i, best[1], round(best[0], 9)))
    return out


def test_equals_brute_force(spark):
    texts = [None, "", "one", "\n\n"]
    for i, t in enumerate(TEMPLATES.values()):
        w = t.split()
        texts += [t, t.upper() + "!!", "intro\n" + t + "\noutro", " ".join(w[: len(w) * 3 // 4]),
                  "\n".join(" ".join(w[k:k + 6]) for k in range(0, len(w), 6)) + "\n\n" + "x y z",
                  " ".join(words(i, 40)) + " " + t, t + " and more words here", t + " " + t]
    rows = list(enumerate(texts))
    got = license_matches(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = sorted((i, *m) for i, t in rows for m in brute(t, TEMPLATES))
    assert sorted((r["doc_id"], r["unit"], r["unit_no"], r["license"], round(r["dice"], 9)) for r in got) == want
    assert len(want) > 60


def test_usual_notices_in_comments(spark):
    gpl = """#!/bin/sh
# Copyright (C) 2020 Ann Lee
#
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details.

echo"""
    mit = "/*\n * Copyright (c) 2021 B\n *\n" + "".join(f" * {x}\n" for x in (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated",
        "documentation files (the 'Software'), to deal in the Software without restriction, including without limitation",
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and",
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:", "",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions",
        "of the Software.", "", "THE SOFTWARE IS PROVIDED 'AS IS', WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,",
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND",
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER",
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH",
        "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")) + " */"
    texts = [gpl, mit, "code\n// SPDX-License-Identifier: MIT\nmore", "This project is licensed under the MIT License."]
    got = license_matches(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["license"]) for r in got} == {
        (0, "GPL-3.0-or-later-warranty"), (1, "MIT-text"), (2, "MIT-spdx"), (3, "MIT-project")}
    assert len({tuple(split(t)) for t in TEMPLATES.values()}) == len(TEMPLATES)


def test_ties_go_to_the_first_name(spark):
    docs = spark.createDataFrame([(1, "one two three four")], "doc_id long, text string")
    got = license_matches(docs, {"b": "one two three four", "a": "One, two. Three four!"}).collect()
    assert [r["license"] for r in got] == ["a"]


def test_awkward_rows(spark):
    assert license_matches(awkward(spark)).collect() == []
    licensed = awkward(spark, [(None, "Released under the MIT License.", None, None)] * 2)
    assert [(r["doc_id"], r["license"]) for r in license_matches(licensed).collect()] == [(None, "MIT")] * 2
    assert license_matches(none(spark)).collect() == []
