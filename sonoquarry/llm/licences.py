"""License scans: Dice coefficient over word bigrams between normalised text and licence templates.

Texts are normalised to lower-case words of letters and digits. Units of comparison are a text's lines,
its paragraphs of several lines, and the whole text. A unit's and a template's distinct word bigrams A and B
give 2 |A and B| / (|A| + |B|); it can reach a threshold t only if |A| lies between t / (2 - t) and
(2 - t) / t times |B|, so most units are dropped by their word count, and most templates for the rest
by theirs, before any bigram is made. The best template that reaches the threshold is reported.

What reaches the threshold shares t / (2 - t) of |B| bigrams at least. So each template has a few marker
words: the bigrams without any of them are too few, and a unit without any of them can't reach it. Texts
in which no template's marker occurs are done after a plain search for the markers.

Templates are a parameter, not data: they stand in the plan, grouped by size, and nothing is shuffled.
All is DataFrame work. Defined results: null, empty and wordless texts have no findings; units of one
word have no bigrams; a text that is one line is one unit; ties go to the template whose name is smaller;
repeated rows each return a row; an empty table returns an empty table. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoquarry.llm.shared import documents_of

THRESHOLD = 0.8
# Licence notices and whole licence texts: fixed texts, in public use.
TEMPLATES = {
    "0BSD-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-grant": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-2-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSD-3-Clause-head": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BSD-3-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-4.0-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    "ISC-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Zlib-text": "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "reserved": "All rights reserved.",
}


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def bigrams_of(text: str) -> list[str]:
    w = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:], strict=False)})


def _bigrams(words: Column) -> Column:
    pairs = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(pairs)


def _bounds(size: int, threshold: float) -> tuple[int, int]:
    """Fewest and most bigrams of what can reach the threshold against so many."""
    return math.ceil(size * threshold / (2 - threshold) - 1e-9), math.floor(size * (2 - threshold) / threshold + 1e-9)


def _best(grams: Column, templates: dict[str, list[str]], threshold: float) -> Column:
    """The best template of those given as struct(dice, name), or null."""
    size, out = F.size(grams), []
    for name, own in sorted(templates.items()):
        dice = 2.0 * F.size(F.array_intersect(grams, F.array(*[F.lit(x) for x in own]))) / (size + len(own))
        least, most = _bounds(len(own), threshold)
        fits = (size >= least) & (size <= most)
        out.append(F.when(fits, dice))
    top = F.greatest(*out, F.lit(-1.0))
    name = None
    for n, d in zip(sorted(templates), out, strict=True):
        name = F.when(d == top, n) if name is None else name.when(d == top, n)
    return F.when(top >= threshold, F.struct(name.alias("licence"), top.alias("dice")))


# Words so common in English that they mark nothing: fixed values.
COMMON = frozenset("all an and any are as at be but by can for from has have if in is it its not of on or such that the this to under use used was were will with you".split())


def markers(templates: dict[str, list[str]], threshold: float) -> list[str]:
    """Words of which every unit that reaches the threshold against some template holds one.

    Words that are markers already are taken before new ones, words of five letters before shorter ones; of those, the
    ones in most of the bigrams left.
    """
    out: list[str] = []
    for _, grams in sorted(templates.items(), key=lambda x: (len(x[1]), x[0])):
        need = _bounds(len(grams), threshold)[0]  # bigrams shared at least
        rest = [set(g.split(" ")) for g in grams]
        while len(rest) >= need:
            held = Counter(w for g in rest for w in g)
            word = min(held, key=lambda w: (w not in out, w in COMMON or w.isdigit(), len(w) < 5, -held[w], -len(w), w))
            rest = [g for g in rest if word not in g]
            if word not in out:
                out.append(word)
    return [w for w in out if not any(v != w and v in w for v in out)]  # a text with w also has v


def findings(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_units (compared), licences (sorted names), best_dice and unit numbers of the findings."""
    own = {n: g for n, t in (TEMPLATES if templates is None else templates).items() if (g := bigrams_of(t))}
    docs = documents_of(docs, id_col, text_col)
    none = docs.select("doc_id", F.array().cast("array<string>").alias("licences"), F.lit(0).cast("long").alias("n_found"), F.lit(None).cast("double").alias("best_dice"))
    if not own:
        return none
    least = _bounds(min(map(len, own.values())), threshold)[0]
    most = _bounds(max(map(len, own.values())), threshold)[1]
    text = F.coalesce(F.col("text"), F.lit(""))
    # A paragraph of one line is that line; units are taken once each.
    paragraphs = F.filter(F.split(text, r"\n[ \t\r]*\n"), lambda x: F.contains(F.trim(x), F.lit("\n")))
    units = F.array_distinct(F.concat(F.split(text, "\n"), paragraphs, F.array(text)))
    held = lambda low: reduce(or_, [F.contains(low, F.lit(word)) for word in markers(own, threshold)])
    found = F.get(F.transform(F.array(F.lower(text)), held), 0)  # lower-cased once, not for each marker
    units = F.when(found, units).otherwise(F.array().cast("array<string>"))
    # Distinct bigrams are fewer than words, and words at most half the characters plus one: cheap bounds first.
    units = F.filter(units, lambda x: F.length(x) >= 2 * least + 1)
    words = lambda x: F.filter(F.split(F.lower(x), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    listed = F.filter(F.transform(units, words), lambda w: F.size(w) - 1 >= least)
    grams = F.filter(F.transform(listed, _bigrams), lambda g: (F.size(g) >= least) & (F.size(g) <= most))
    found = F.filter(F.transform(grams, lambda g: _best(g, own, threshold)), lambda x: x.isNotNull())
    return docs.select("doc_id", found.alias("found")).select(
        "doc_id",
        F.array_sort(F.array_distinct(F.transform("found", lambda x: x["licence"]))).alias("licences"),
        F.size("found").cast("long").alias("n_found"),
        F.round(F.array_max(F.transform("found", lambda x: x["dice"])), 9).alias("best_dice"),
    )
