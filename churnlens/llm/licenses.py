"""License scans: text units against licence templates by the Dice coefficient
of their word bigrams.

A unit is a line, or a paragraph of several lines (split at blank lines).
Units and templates are normalised alike.  A template is compared only with
units whose number of bigrams can reach the threshold at all: Dice >= t needs
max(a, b) <= min(a, b) * (2 - t) / t.  Everything is an expression on one row:
no shuffle, no join, and nothing grows with the corpus but the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Licence notices as their stewards publish them, one unit each.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
    "except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
    "License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring "
    "rights to this work.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of "
    "the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, "
    "or (at your option) any later version.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of "
    "the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, "
    "or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
    "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
    "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


#: Whole notices, as they stand in one comment, and usual short wordings.
_GNU = ("This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name}General "
        "Public License as published by the Free Software Foundation, either version {n} of the License, or (at your "
        "option) any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "{name}General Public License for more details.")
_GNU_COPY = " You should have received a copy of the GNU {name}General Public License along with this {what}. {rest}"
_SEE, _OLD_SEE = "If not, see <https://www.gnu.org/licenses/>.", (
    "if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.")
for _id, _what, _name, _n, _rest in (
        ("GPL-2.0-or-later", "program", "", "2", _OLD_SEE), ("GPL-3.0-or-later", "program", "", "3", _SEE),
        ("LGPL-2.1-or-later", "library", "Lesser ", "2.1", _OLD_SEE), ("LGPL-3.0-or-later", "library", "Lesser ", "3", _SEE),
        ("AGPL-3.0-or-later", "program", "Affero ", "3", _SEE)):
    _parts = {"what": _what, "name": _name, "n": _n, "rest": _rest}
    TEMPLATES[f"{_id}-warranty"] = _GNU.format(**_parts)
    TEMPLATES[f"{_id}-notice"] = (_GNU + _GNU_COPY).format(**_parts)
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
          "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
          "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
          "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
          "IN THE SOFTWARE.")
_NOTICE = " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
TEMPLATES |= {
    "MIT-permission-notice": TEMPLATES["MIT-permission"] + _NOTICE,
    "MIT-text": TEMPLATES["MIT-permission"] + _NOTICE + " " + _AS_IS,
    "Apache-2.0-notice": TEMPLATES["Apache-2.0-header"] + " Unless required by applicable law or agreed to in writing, "
    "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
    "KIND, either express or implied. See the License for the specific language governing permissions and limitations "
    "under the License.",
    "ISC-text": TEMPLATES["ISC"] + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD "
    "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
    "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
    "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
}
for _id, _words in {"MIT": "MIT License", "Apache-2.0": "Apache License, Version 2.0", "GPL-2.0": "GNU General Public License v2.0",
                    "GPL-3.0": "GNU General Public License v3.0", "BSD-3-Clause": "BSD 3-Clause License",
                    "MPL-2.0": "Mozilla Public License 2.0", "ISC": "ISC License"}.items():
    TEMPLATES[f"{_id}-project"] = f"This project is licensed under the {_words}."
    TEMPLATES[f"{_id}-distributed"] = f"Distributed under the terms of the {_words}."
    TEMPLATES[f"{_id}-see"] = f"This project is licensed under the {_words} - see the LICENSE file for details."
for _id in ("MIT", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-or-later",
            "LGPL-3.0-or-later", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "CC0-1.0", "Unlicense"):
    TEMPLATES[f"{_id}-spdx"] = f"SPDX-License-Identifier: {_id}"


def normalised_words(text: Column) -> Column:
    """Words of ASCII letters (lower-cased) and digits and of non-ASCII characters."""
    bare = F.regexp_replace(F.translate(text, _UPPER, _LOWER), r"[^0-9a-z\x{80}-\x{10FFFF}]+", " ")
    return F.split(F.btrim(bare), " ")


def _bigrams(words: Column) -> Column:
    return F.array_distinct(F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1))), F.lit(1), F.size(words) - 1))


def _template_array(spark: SparkSession, templates: dict[str, str], threshold: float) -> tuple[Column, int, int]:
    """The templates as a constant array, and the least and greatest number of
    bigrams that a unit can have to match any.  Templates of fewer than two
    words are refused."""
    words = spark.createDataFrame(sorted(templates.items()), "id string, text string").withColumn(
        "words", normalised_words(F.col("text")))
    rows = words.select("id", (F.size("words") - 1).alias("n"), _bigrams(F.col("words")).alias("bigrams")).collect()
    if any(r["n"] < 1 for r in rows):
        raise ValueError("a template needs two words")
    room = (2 - threshold) / threshold
    parts, least, most = [], None, 0
    for r in rows:
        low, high = int(-(-r["n"] // room)), int(r["n"] * room)
        least, most = min(low, least or low), max(most, high)
        grams = ", ".join(f"{x}L" if x != -(1 << 63) else "bigint('-9223372036854775808')" for x in r["bigrams"])
        name = r["id"].replace("\\", "\\\\").replace("'", "\\'")
        parts.append(f"named_struct('id', '{name}', 'low', {low}, 'high', {high}, 'bigrams', array({grams}))")
    return F.expr(f"array({', '.join(parts)})"), least or 0, most


def license_matches(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = 0.8,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, unit, unit_no, license, n_shared, dice): the best template of
    every unit that reaches the threshold, ties to the first name in order.

    ``unit`` is `line` or `paragraph`, ``unit_no`` its place from 0 among the
    text's lines or paragraphs.  Size bounds count bigrams with repeats, the
    coefficient counts different ones.  Null and empty texts have no unit that
    matches; repeated rows and null ids give their rows again.
    """
    if not templates:
        raise ValueError("no templates")
    known, least, most = _template_array(docs.sparkSession, templates, threshold)
    text = F.coalesce(F.col(text_col), F.lit(""))

    def sized(kind: str, parts: Column, wanted=None) -> Column:
        numbered = F.transform(parts, lambda x, i: F.struct(
            F.lit(kind).alias("unit"), i.cast("long").alias("unit_no"), x.alias("t")))
        if wanted:
            numbered = F.filter(numbered, wanted)
        return F.filter(
            F.transform(numbered, lambda x: F.struct(
                x["unit"].alias("unit"), x["unit_no"].alias("unit_no"), normalised_words(x["t"]).alias("words"))),
            lambda x: (F.size(x["words"]) - 1).between(least, most))

    # Outer explodes: for others the optimizer adds a filter that evaluates their input once more.
    units = docs.select(F.col(id_col).alias("_id"), F.explode_outer(F.concat(
        sized("line", F.split(text, "\n")),
        sized("paragraph", F.split(text, r"\n[ \t\r]*\n"), lambda x: x["t"].contains("\n")))).alias("u")).select(
        "_id", "u.*").filter("unit is not null")
    grams = units.select("_id", "unit", "unit_no", (F.size("words") - 1).alias("n"),
                         _bigrams(F.col("words")).alias("bigrams"))
    n, own = F.col("n"), F.col("bigrams")
    shared = F.transform(
        F.filter(known, lambda t: n.between(t["low"], t["high"])),
        lambda t: F.struct(F.size(F.array_intersect(own, t["bigrams"])).cast("long").alias("shared"),
                           (F.size(own) + F.size(t["bigrams"])).alias("total"), t["id"].alias("id")))
    ranked = F.transform(shared, lambda s: F.struct(
        (-(F.lit(2.0) * s["shared"] / s["total"])).alias("minus"), s["id"].alias("id"), s["shared"].alias("shared")))
    best = grams.select("_id", "unit", "unit_no", F.array_min(ranked).alias("best"))
    # Not a filter on `best`: pushed down, it would evaluate the whole expression inside its own lambdas.
    found = best.select("_id", "unit", "unit_no", F.explode_outer(F.filter(
        F.array("best"), lambda x: x["minus"] <= -threshold)).alias("best")).filter("best is not null")
    return found.select(F.col("_id").alias(id_col), "unit", "unit_no", F.col("best.id").alias("license"),
                        F.col("best.shared").alias("n_shared"), (-F.col("best.minus")).alias("dice"))
