"""License scan: sparse TF-IDF cosine to templates, then inheritance by path (DataFrame functions only).

Units of a text are its lines, its paragraphs and the whole text, each once. A
unit is a sparse vector of its terms (``[a-z0-9]+``): a term weighs its
count times ``ln((1 + N) / (1 + df)) + 1`` with N and df counted over all
documents, whether a template has it or not. The products with all templates are
formed in the row. Only units that can reach MIN_SCORE leave it: a text without any of a template's rarest terms, whose rest is
too light for the score, cannot, nor can a unit whose product with the
templates is too small for its norm with every other word at the least weight
(``able_units``). These tests drop none that counts.

A document's own license is its best unit's (higher score, then name). A
directory's license is the one that most licence files directly in it state (files
named like a licence, or whose whole text fits a template; then the first by
name): a notice in one source file licenses that file alone. Documents without a
license inherit from the nearest ancestor directory that has one. Directories are few compared with documents and are
resolved first; documents join their directory's answer.

Frequencies are counted once for all terms, combined map-side; a term outside
them and the templates is in one document. The other words of the able units
are joined with them for the norm. Null and empty texts have no units, a null path no directory: own
license or none. Repeated rows count as often as they come.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.tables import stored

MIN_SCORE = 0.6

# Public license notices and licence files, by SPDX name.
_BSD_GRANT = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
              "conditions are met: ")
_BSD_CONDITIONS = ("1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
                   "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
                   "disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
              "derived from this software without specific prior written permission. ")
_BSD_DISCLAIMER = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
                   "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
                   "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
                   "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
                   "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
                   "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
            "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("MIT", "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, "
            "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
            "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
            "shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
            "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
            "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
            "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
            "OTHER DEALINGS IN THE SOFTWARE."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License version 2 as published by the Free Software Foundation"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                 "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                 "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
                 "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_CONDITIONS + _BSD_NAMES + _BSD_DISCLAIMER),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                     "products derived from this software without specific prior written permission"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_CONDITIONS + _BSD_DISCLAIMER),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
                "which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright under CC0 1.0 Universal"),
)


#: Names of files that state the license of their directory.
LICENSE_FILE = r"(?i)(^|/)(un)?(licen[cs]e|copying|notice)[^/]*$|\.licen[cs]e$"


def terms(text: Column) -> Column:
    """The terms of a text; an empty first or last element may stand for its edges."""
    return F.split(F.lower(text), "[^a-z0-9]+")


def template_terms() -> list[dict[str, int]]:
    """Term counts of each template."""
    import re
    out = []
    for _, text in TEMPLATES:
        counts: dict[str, int] = {}
        for t in re.findall("[a-z0-9]+", text.lower()):
            counts[t] = counts.get(t, 0) + 1
        out.append(counts)
    return out


def vocabulary() -> list[str]:
    """The terms of all templates."""
    return sorted({t for counts in template_terms() for t in counts})


def term_frequencies(documents: DataFrame) -> DataFrame:
    """(term, df) of the terms in more than one document, and of the templates' terms in one; counts are combined map-side."""
    held = documents.select(F.explode(F.array_distinct(terms(F.col("text").cast("string")))).alias("term")).where("term <> ''")
    return held.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where((F.col("df") > 1) | F.col("term").isin(vocabulary()))


class Weights:
    """Template vectors under the corpus' frequencies, and the terms that a fitting unit must touch.

    ``needed`` has the rarest terms of each template, so many that the others are too
    light for the score.
    """

    def __init__(self, total: int, frequency: dict[str, int], min_score: float):
        self.total = total
        templates = template_terms()
        self.terms = vocabulary()
        idf = {t: math.log((1 + total) / (1 + frequency.get(t, 0))) + 1 for t in self.terms}
        self.idf = [idf[t] for t in self.terms]
        vectors, needed = [], set()
        for counts in templates:
            weights = {t: c * idf[t] for t, c in counts.items()}
            norm = math.sqrt(sum(w * w for w in weights.values()))
            vectors.append({t: w / norm for t, w in weights.items()})
            rest = 1.0
            for t in sorted(weights, key=lambda t: (-weights[t] ** 2 / (1 + frequency.get(t, 0)), t)):
                if rest < (min_score * 0.999) ** 2:
                    break
                needed.add(t)
                rest -= (weights[t] / norm) ** 2
        #: What one occurrence of a term adds to the product with each template.
        self.parts = [[idf[t] * v.get(t, 0.0) for v in vectors] for t in self.terms]
        self.needed = sorted(needed)


def _doubles(values: list[float]) -> str:
    return f"array({', '.join(f'{v!r}D' for v in values)})"


def able_units(documents: DataFrame, weights: Weights, min_score: float) -> DataFrame:
    """(path, doc_id, unit_id, whole, license, part, own, others) of the units that can reach the score.

    ``part`` is the product with the best template, ``own`` the template terms' share
    of the squared norm, ``others`` the unit's other words in their order. A word
    weighs 1 at least, so a unit's norm is at least the root of ``own`` and its other
    words; that bound is tested where the unit is read, and the units below it go no
    further.
    """
    listed, needed = (F.array(*[F.lit(t) for t in words]) for words in (weights.terms, weights.needed))
    text = F.coalesce(F.col("text"), F.lit(""))
    units = F.array_distinct(F.concat(F.split(text, "\n", -1), F.split(text, r"\n[\x20\t\r]*\n[\s]*", -1), F.array(text)))
    idf, parts = F.expr(_doubles(weights.idf)), F.expr(f"array({', '.join(_doubles(p) for p in weights.parts)})")
    zeros = F.expr(_doubles([0.0] * len(TEMPLATES)))

    def split(u: Column) -> Column:
        return F.struct(F.xxhash64(u).alias("unit_id"), (u == text).alias("whole"), terms(u).alias("terms"))

    def sorted_out(u: Column) -> Column:
        known = F.filter(u["terms"], lambda t: t.isin(weights.terms))
        others = F.filter(u["terms"], lambda t: (t != "") & ~t.isin(weights.terms))
        return F.struct(u["unit_id"], u["whole"], others.alias("others"), known.alias("known"), F.array_distinct(known).alias("distinct"))

    def counted(u: Column) -> Column:
        each = F.transform(u["distinct"], lambda t: F.struct(
            F.array_position(listed, t).cast("int").alias("at"), F.size(F.filter(u["known"], lambda x: x == t)).cast("double").alias("tf")))
        return F.struct(u["unit_id"], u["whole"], u["others"], each.alias("counts"))

    def multiplied(u: Column) -> Column:
        product = F.aggregate(u["counts"], zeros, lambda acc, c: F.zip_with(acc, F.element_at(parts, c["at"]), lambda x, w: x + c["tf"] * w))
        own = F.aggregate(u["counts"], F.lit(0.0), lambda acc, c: acc + F.pow(c["tf"] * F.element_at(idf, c["at"]), 2))
        return F.struct(u["unit_id"], u["whole"], u["others"], product.alias("product"), own.alias("own"))

    found = F.filter(F.transform(units, split), lambda u: F.arrays_overlap(u["terms"], needed))
    found = F.transform(F.transform(F.transform(found, sorted_out), counted), multiplied)
    found = F.filter(found, lambda u: F.array_max(u["product"]) >= min_score * 0.999 * F.sqrt(u["own"] + F.size(u["others"])))
    names = F.array(*[F.lit(name) for name, _ in TEMPLATES])
    rows = documents.where(F.arrays_overlap(terms(text), needed)).select("path", "doc_id", F.inline(found))
    best = F.array_max("product")
    return rows.select("path", "doc_id", "unit_id", "whole", F.element_at(names, F.array_position("product", best).cast("int")).alias("license"),
                       best.alias("part"), "own", "others")


def scores(documents: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """(path, doc_id, license, score, whole) of each document's best unit that reaches the score.

    ``whole``: the whole text does so too, for that license.
    """
    docs = documents.select("path", "doc_id", F.col("text").cast("string").alias("text"))
    frequencies = stored(term_frequencies(docs), "frequencies")
    held = {r["term"]: r["df"] for r in frequencies.where(F.col("term").isin(vocabulary())).collect()}  # as many rows as templates have terms
    weights = Weights(docs.count(), held, min_score)
    unit = ["path", "doc_id", "unit_id", "whole", "license", "part", "own"]
    units = stored(able_units(docs, weights, min_score).dropDuplicates(unit[:4]), "units")
    words = units.select(*unit, F.explode_outer("others").alias("term")).groupBy(*unit, "term").agg(F.count(F.lit(1)).alias("tf"))
    weight = F.col("tf") * (F.log(F.lit(1.0 + weights.total) / (F.coalesce("df", F.lit(1)) + 1)) + 1)
    weighed = words.join(frequencies, "term", "left").withColumn("square", F.when(F.col("term").isNull(), 0.0).otherwise(F.pow(weight, 2)))
    norms = weighed.groupBy(*unit).agg(F.sqrt(F.col("own") + F.sum("square")).alias("norm"))
    scored = norms.select("path", "doc_id", "whole", "license", F.round(F.col("part") / F.col("norm"), 6).alias("score"))
    best = scored.where(F.col("score") >= min_score).groupBy("path", "doc_id", "license").agg(F.max("score").alias("score"), F.max("whole").alias("whole"))
    first = F.min(F.struct(F.negative("score").alias("minus"), "license", "whole")).alias("first")
    return best.groupBy("path", "doc_id").agg(first).select("path", "doc_id", F.col("first.license").alias("license"), (-F.col("first.minus")).alias("score"),
                                                            F.col("first.whole").alias("whole"))


def directory(path: Column) -> Column:
    """The directory of a path, null at the top."""
    return F.nullif(F.regexp_replace(path, "/?[^/]*$", ""), F.lit(""))


def ancestors(folder: Column) -> Column:
    """The directory itself and those above it, nearest first."""
    parts = F.split(folder, "/")
    return F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def inherited(folders: DataFrame, own: DataFrame) -> DataFrame:
    """(folder, license, from, distance) of the nearest directory with a license, for each folder that has one.

    A directory's license is stated by files named like a licence, and by files that are one as a whole.
    """
    stating = own.where(F.col("whole") | F.col("path").rlike(LICENSE_FILE))
    stated = (stating.withColumn("folder", directory(F.col("path"))).where("folder is not null")
              .groupBy("folder", "license").agg(F.count(F.lit(1)).alias("n")))
    stated = stated.groupBy("folder").agg(F.min(F.struct(F.negative("n").alias("minus"), "license")).alias("first"))
    stated = stated.select(F.col("folder").alias("above"), F.col("first.license").alias("license"))
    up = folders.select("folder", F.posexplode(ancestors(F.col("folder"))).alias("distance", "above"))
    near = up.join(stated, "above").groupBy("folder").agg(F.min(F.struct("distance", "above", "license")).alias("near"))
    return near.select("folder", F.col("near.license").alias("inherited"), F.col("near.above").alias("inherited_from"),
                       F.col("near.distance").alias("distance"))


def licenses(documents: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """(doc_id, path, own_license, own_score, license, inherited_from, distance) per (doc_id, path) row.

    ``documents`` has path, doc_id and text.
    """
    docs = documents.select("path", "doc_id", F.col("text").cast("string").alias("text"))
    own = stored(scores(docs, min_score), "own-licenses")
    named = docs.select("path", "doc_id", directory(F.col("path")).alias("folder"))
    near = stored(inherited(named.select("folder").where("folder is not null").distinct(), own), "inherited-licenses")
    o = own.select(F.col("path").alias("o_path"), F.col("doc_id").alias("o_id"), F.col("license").alias("own_license"), F.col("score").alias("own_score"))
    joined = named.join(o, F.col("path").eqNullSafe(F.col("o_path")) & F.col("doc_id").eqNullSafe(F.col("o_id")), "left").drop("o_path", "o_id")
    joined = joined.join(near, "folder", "left")
    none = F.col("own_license").isNull()
    return joined.select("doc_id", "path", "own_license", "own_score", F.coalesce("own_license", "inherited").alias("license"),
                         F.when(none, F.col("inherited_from")).alias("inherited_from"),
                         F.when(none, F.col("distance")).alias("distance"))
