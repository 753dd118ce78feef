"""Licence scan: normalised text compared to licence templates by the Dice coefficient over word bigrams.

Units are the lines of a text and, where it has more than one, the whole text. A unit is lower-cased and all but
a-z and 0-9 becomes a space; its set holds the distinct pairs of neighbouring words. A template is a match when
``2 * common >= threshold * (size of unit + size of template)``. As common is at most the smaller size, only units whose
size lies within the template's bounds can match: others are pruned before any set is made.

A notice may also stand inside a line or be wrapped over several. So each template is compared to windows of the whole
text's words too, whatever lines they lie in: to all that begin and end with a pair of the template (others score no
better for it) and have at most ``(2 - threshold) / threshold`` times its pairs. A match needs ``threshold / (2 - threshold)``
of the template's pairs, so texts that have fewer are left out before any window is made.

All templates that match are given with their best scores, best first, beside the best one.

Cases: a null or empty text, or one with no match, has no licence: null name, score 0, no matches, empty list. Equal scores take the
template with most pairs (a long notice may hold a short one), then the one whose name sorts first. Lines and texts of any length are read whole. Repeated rows give repeated
results. Extra columns pass through; output columns that clash get a numbered name. An empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

THRESHOLD = 0.8

_WARRANTY = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_BSD_WARRANTY = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_BSD_TERMS = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_ISC_WARRANTY = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'

#: Customary wording of public licence notices and of whole short licences.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc0-1.0": "Released under CC0 1.0 Universal, public domain dedication.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit": "Released under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}
TEMPLATES |= {
    "bsd-2-clause-text": f"{TEMPLATES['bsd-notice']} {_BSD_TERMS} {_BSD_WARRANTY}",
    "bsd-3-clause-text": f"{TEMPLATES['bsd-notice']} {_BSD_TERMS} {_BSD_THIRD} {_BSD_WARRANTY}",
    "isc-text": f"{TEMPLATES['isc']} {_ISC_WARRANTY}",
    "mit-text": f"{TEMPLATES['mit-grant']} The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_WARRANTY}",
    "zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
}


def neighbours(text: str) -> list[str]:
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def bigrams(text: str) -> list[str]:
    return sorted(set(neighbours(text)))


def scan(df: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """Adds ``license`` (best template or null), ``license_score`` and ``license_matches`` (units that match some template; where only windows do, the templates these match), ``license_all`` (array of (license, score): every template that matches, best first)."""
    sets = sorted((name, bigrams(text)) for name, text in (TEMPLATES if templates is None else templates).items())
    sets = [(name, grams) for name, grams in sets if grams]
    longest = {name: len(neighbours(text)) for name, text in (TEMPLATES if templates is None else templates).items()}
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    best, score, count, every_one = fresh(df, "license"), fresh(df, "license_score"), fresh(df, "license_matches"), fresh(df, "license_all")
    if not sets:
        return df.withColumns({best: F.lit(None).cast("string"), score: F.lit(0.0), count: F.lit(0), every_one: F.array().cast("array<struct<license:string,score:double>>")})
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split(text, "\n")

    def neighbouring(words: Column) -> Column:
        return F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat(w, F.lit(" "), F.get(words, i + 1)))

    def normal(u: Column) -> Column:
        return F.split(F.trim(F.regexp_replace(F.lower(u), "[^a-z0-9]+", " ")), " ")

    def ranked(k: int, value: Column) -> Column:
        return F.struct(value.alias("score"), F.lit(len(sets[k][1])).alias("pairs"), F.lit(-k).alias("order"))

    def dice(grams: Column) -> Column:
        """(score, pairs, order) of one set for each template; templates whose size bounds exclude it are not compared."""
        size = F.size(grams)
        return F.array(*[
            ranked(k, F.when(size.between(math.ceil(low * len(g) - 1e-9), math.floor(high * len(g) + 1e-9)), F.lit(2.0) * F.size(F.array_intersect(grams, F.lit(g))) / (size + len(g))).otherwise(F.lit(0.0)))
            for k, (_, g) in enumerate(sets)
        ])

    def let(value: Column, then: Callable[[Column], Column]) -> Column:
        return F.get(F.transform(F.array(value), then), F.lit(0))

    def windows(row: Column, hits: Column, held: Column, k: int) -> Column:
        """Best score of template ``k`` in the windows of a text. row: its pairs; hits: (place, pair) of those of any template; held: their set."""
        name, g = sets[k]
        need, most = math.ceil(low * len(g) - 1e-9), math.floor(high * longest[name] + 1e-9)

        def from_start(s: Column, own: Column) -> Column:
            ends = F.filter(own, lambda e: e["i"].between(s["i"], s["i"] + most - 1))
            score = lambda e, j, near: F.lit(2.0) * F.size(F.array_distinct(F.slice(near["p"], 1, j + 1))) / (F.size(F.array_distinct(F.slice(row, s["i"] + 1, e["i"] - s["i"] + 1))) + len(g))
            return let(ends, lambda near: F.when(F.size(near) >= need, F.array_max(F.transform(near, lambda e, j: score(e, j, near)))).otherwise(F.lit(0.0)))

        own = F.filter(hits, lambda h: h["p"].isin(g))
        best = let(own, lambda own: F.array_max(F.transform(own, lambda s: from_start(s, own))))
        return ranked(k, F.when(F.size(F.filter(held, lambda p: p.isin(g))) >= need, best).otherwise(F.lit(0.0)))

    row, hits, held, inside, at, scores = (fresh(df, f"license_{x}") for x in ("row", "hits", "held", "inside", "found", "scores"))
    every = sorted({x for _, g in sets for x in g})
    out = df.withColumn(row, let(normal(text), neighbouring))
    out = out.withColumn(hits, F.filter(F.transform(F.col(row), lambda p, i: F.when(p.isin(every), F.struct(i.alias("i"), p.alias("p")))), lambda x: x.isNotNull()))
    out = out.withColumn(held, F.array_distinct(F.col(hits)["p"]))
    out = out.withColumn(inside, F.filter(F.array(*[windows(F.col(row), F.col(hits), F.col(held), k) for k in range(len(sets))]), lambda x: x["score"] >= threshold))
    grams = F.transform(F.transform(lines, normal), lambda words: F.array_distinct(neighbouring(words)))
    grams = F.when(F.size(lines) > 1, F.concat(grams, F.array(F.array_distinct(F.col(row))))).otherwise(grams)
    matched = F.filter(F.transform(grams, dice), lambda u: F.exists(u, lambda x: x["score"] >= threshold))
    out = out.withColumn(at, matched)
    out = out.withColumn(scores, F.filter(F.concat(F.flatten(F.col(at)), F.col(inside)), lambda x: x["score"] >= threshold))
    top = F.array_max(F.col(scores))
    names = F.lit([name for name, _ in sets])
    each = F.transform(F.array_distinct(F.col(scores)["order"]), lambda o: F.struct((-F.array_max(F.filter(F.col(scores), lambda x: x["order"] == o)["score"])).alias("less"), F.get(names, -o).alias("license")))
    return out.withColumns({
        best: F.get(names, -top["order"]),
        score: F.coalesce(top["score"], F.lit(0.0)),
        count: F.when(F.size(F.col(at)) > 0, F.size(F.col(at))).otherwise(F.size(F.col(inside))),
        every_one: F.transform(F.array_sort(each), lambda x: F.struct(x["license"].alias("license"), (-x["less"]).alias("score"))),
    }).drop(row, hits, held, inside, at, scores)
