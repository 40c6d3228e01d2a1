"""Licences of files: TF-IDF cosine to templates, then inheritance from directories."""

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricewave.llm.common import cut

_TERM = re.compile(r"[a-z0-9]+")
#: A number of one digit, with what comes before it where it is a version: "version 2" and "version 3" are terms of their own.
_NUMBER = re.compile(r"(?<!\d)(\d)(?:\.(\d))?(?!\d)")
_BEFORE = re.compile(r"(?:\bv(?:ersion)?[. ]*|gpl[- v]*|(?:apache|mpl|epl|bsl|zero)[- ]|\bcc[-a-z0 ]*)$")
#: How a comment line starts; the signs are those of common languages.
_COMMENT = re.compile(r"\s*(#|//|/?\*|--|;|%|\"\"\")")

# The texts and usual notices of common licences, and the names that they go by.
_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_ISC_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_TWO = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_THREE = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_AS_IS = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_APACHE = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
_APACHE_REST = 'You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'
_MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
_MPL_REST = "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
_GNU = "This {thing} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free Software Foundation{either} version {version} of the License, or (at your option) any later version."
_GNU_REST = "This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} for more details. You should have received a copy of the GNU {kind} along with this {thing}."
_ZERO_BSD = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."
_BSD_FOUR = (
    "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software "
    "developed by the organization. 4. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the "
    "use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
    "redistribute it freely, subject to the following restrictions:"
)
_ZLIB_REST = (
    "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, "
    "an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must "
    "not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
)
_BOOST = (
    'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this '
    'license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to '
    "permit third-parties to whom the Software is furnished to do so, all subject to the following:"
)
_BOOST_REST = (
    "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be "
    "included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in "
    "the form of machine-executable object code generated by a source language processor."
)
_ECLIPSE = "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
#: How the texts of long licences begin: a licence file is known by these paragraphs.
_HEADS = (
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", 'TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. "License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.'),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
)
#: Lines that offer a choice of two licences name both.
_CHOICES = (
    ("Apache-2.0 OR MIT", ("Apache License, Version 2.0", "MIT license")), ("Apache-2.0 OR MIT", ("MIT license", "Apache License, Version 2.0")),
    ("GPL-2.0 OR MIT", ("GNU General Public License, version 2", "MIT license")), ("GPL-2.0 OR MIT", ("MIT license", "GNU General Public License, version 2")),
)
_UNLICENSE = "This is free and unencumbered software released into the public domain."
_GNU_KINDS = (
    ("GPL-2.0", "program", ";", "General Public License", "2"),
    ("GPL-3.0", "program", ":", "General Public License", "3"),
    ("LGPL-2.1", "library", ";", "Lesser General Public License", "2.1"),
    ("LGPL-3.0", "library", ":", "Lesser General Public License", "3"),
    ("AGPL-3.0", "program", ":", "Affero General Public License", "3"),
)
_TITLES = (
    ("Apache-2.0", "Apache License, Version 2.0"), ("Apache-2.0", "Apache License 2.0"), ("MIT", "MIT License"), ("ISC", "ISC License"), ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"),
    *((name, f"GNU {kind}, version {version}") for name, _, _, kind, version in _GNU_KINDS), *((name, f"{name.split('-')[0]}v{version}") for name, _, _, _, version in _GNU_KINDS),
    ("MPL-2.0", "Mozilla Public License 2.0"), ("CC0-1.0", "CC0 1.0 Universal"), ("CC-BY-4.0", "CC BY 4.0"), ("CC-BY-SA-4.0", "CC BY-SA 4.0"), ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International License"), ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"), ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
)
#: Licences of a family share most of their wording; a text that fits two of them alike is given to the family.
FAMILIES = {"BSD-2-Clause": "BSD", "BSD-3-Clause": "BSD", "BSD-4-Clause": "BSD", "GPL-2.0": "GPL", "GPL-3.0": "GPL", "LGPL-2.1": "LGPL", "LGPL-3.0": "LGPL", "AGPL-3.0": "AGPL", "CC-BY-4.0": "CC", "CC-BY-SA-4.0": "CC", "CC-BY-NC-4.0": "CC"}
MARGIN = 0.01


def _templates():
    """(licence, text); a text without a licence is a rival that tells what only looks like one."""
    yield "MIT", _MIT
    yield "MIT", f"{_MIT} {_AS_IS}"
    yield "ISC", _ISC
    yield "ISC", f"{_ISC} {_ISC_AS_IS}"
    yield "BSD", _BSD
    yield "BSD-2-Clause", f"{_BSD} {_BSD_TWO}"
    yield "BSD-2-Clause", f"{_BSD} {_BSD_TWO} {_BSD_AS_IS}"
    yield "BSD-3-Clause", f"{_BSD} {_BSD_TWO} {_BSD_THREE}"
    yield "BSD-3-Clause", f"{_BSD} {_BSD_TWO} {_BSD_THREE} {_BSD_AS_IS}"
    yield None, _AS_IS
    yield None, _BSD_AS_IS
    yield None, _ISC_AS_IS
    yield "Apache-2.0", _APACHE
    yield "Apache-2.0", f"{_APACHE} {_APACHE_REST}"
    yield "MPL-2.0", _MPL
    yield "MPL-2.0", f"{_MPL} {_MPL_REST}"
    for name, thing, mark, kind, version in _GNU_KINDS:
        for either in (", either", ";"):
            notice = _GNU.format(thing=thing, mark=mark, kind=kind, version=version, either=either)
            yield name, notice
            yield name, notice + " " + _GNU_REST.format(thing=thing, kind=kind)
        yield name, f"under the terms of the GNU {kind} version {version} as published by the Free Software Foundation."
    yield "0BSD", _ZERO_BSD
    yield "0BSD", f"{_ZERO_BSD} {_ISC_AS_IS}"
    yield "BSD-4-Clause", f"{_BSD} {_BSD_TWO} {_BSD_FOUR}"
    yield "BSD-4-Clause", f"{_BSD} {_BSD_TWO} {_BSD_FOUR} {_BSD_AS_IS}"
    yield "Zlib", _ZLIB
    yield "Zlib", f"{_ZLIB} {_ZLIB_REST}"
    yield "BSL-1.0", _BOOST
    yield "BSL-1.0", f"{_BOOST} {_BOOST_REST}"
    yield "BSL-1.0", f"{_BOOST} {_BOOST_REST} {_AS_IS}"
    yield "EPL-2.0", _ECLIPSE
    yield from _HEADS
    for name, (one, two) in _CHOICES:
        yield name, f"Licensed under either of {one} or {two} at your option."
        yield name, f"Dual licensed under the {one} and the {two}."
        yield name, f"Licensed under the {one} or the {two}, at your option."
    for name in ("Apache-2.0 OR MIT", "MIT OR Apache-2.0"):
        yield "Apache-2.0 OR MIT", f"SPDX-License-Identifier: {name}"
    for name in ("0BSD", "Zlib", "BSL-1.0", "EPL-2.0", "BSD-4-Clause"):
        yield name, f"SPDX-License-Identifier: {name}"
    yield "Unlicense", _UNLICENSE
    yield "CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."
    for name, title in _TITLES:
        yield name, f"Licensed under the {title}."
        yield name, f"Released under the {title}."
        yield name, f"This work is licensed under a {title}."
        yield None, f"Not licensed under the {title}."
        yield None, f"This file is not licensed under the {title}."
    for name in dict.fromkeys(name for name, _ in _TITLES):
        yield name, f"SPDX-License-Identifier: {name}"


TEMPLATES = tuple(_templates())
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)([.\-_][^/]*)?$"


def _versions(low: str) -> list[str]:
    out = []
    for m in _NUMBER.finditer(low):
        if low.startswith(("-clause", " clause"), m.end()):
            out.append(f"@clause {m[1]}")
        elif _BEFORE.search(low[max(0, m.start() - 24) : m.start()]):
            out.append(f"@{m[1]}.{m[2] or 0}")
    return out


def terms(text: str) -> list[str]:
    """Runs of letters and digits in lower case, and versions and clause numbers as terms of their own."""
    low = text.lower()
    return _TERM.findall(low) + _versions(low)


class Index:
    """Templates as an inverted index of TF-IDF weights of unit length."""

    def __init__(self, templates, frequency: dict, units: int):
        self.unseen = math.log(1 + units) or 1.0
        self.idf = {t: math.log((1 + units) / (1 + frequency.get(t, 0))) + 1e-6 for _, text in templates for t in terms(text)}
        self.postings: dict = {t: [] for t in self.idf}
        self.names = [name for name, _ in templates]
        for k, (_, text) in enumerate(templates):
            tf = Counter(terms(text))
            norm = math.sqrt(sum((n * self.idf[t]) ** 2 for t, n in tf.items()))
            for t, n in tf.items():
                self.postings[t].append((k, n * self.idf[t] / norm))

    def scores(self, found: list[str], threshold: float = 0.0):
        """({template: cosine}, length) of a unit's terms; None if no cosine can reach the threshold."""
        known = [t for t in found if t in self.idf]
        if not known:
            return None
        weights = {t: n * self.idf[t] for t, n in Counter(known).items()}
        held = sum(x * x for x in weights.values())
        # Templates have only known terms and unit length, so a cosine is at most the share of those terms; each other term counts once at least.
        if held < threshold * threshold * (held + self.unseen**2 * (len(found) - len(known))):
            return None
        norm = math.sqrt(held + sum((n * self.unseen) ** 2 for n in Counter(t for t in found if t not in self.idf).values()))
        if math.sqrt(held) < threshold * norm:
            return None
        scores: dict = {}
        for t, x in weights.items():
            for k, w in self.postings[t]:
                scores[k] = scores.get(k, 0.0) + x * w
        return {k: v / (norm or 1.0) for k, v in scores.items()}, norm

    def best(self, unit: str | list[str], threshold: float = 0.0):
        """(weight, score, licence) of the template most similar to a text or its terms, the earlier of equals; None below the threshold, or if it is no licence.

        weight is the part of the unit's length that the template explains. Where
        another licence of the same family comes within MARGIN, the family is given.
        """
        found = self.scores(terms(unit) if isinstance(unit, str) else unit, threshold)
        if not found:
            return None
        scores, norm = found
        k = max(scores, key=lambda k: (scores[k], -k))
        name, score = self.names[k], scores[k]
        if score < threshold or name is None:
            return None
        family = FAMILIES.get(name)
        if family and any(v > score - MARGIN and self.names[j] != name and FAMILIES.get(self.names[j]) == family for j, v in scores.items()):
            name = family
        return score * norm, score, name


def _units(text: str) -> list[list[str]]:
    """The terms of a file's units: each line, each block of several lines (a paragraph, or a run of comment lines), and the whole text."""
    low = text.lower()
    lines = [(x, _TERM.findall(x)) for x in low.split("\n")]
    full = [(x, found) for x, found in lines if x.strip()]
    units = [found + _versions(x) for x, found in full]
    if len(full) < 2:
        return units
    block, was = [], None
    for x, found in [*lines, ("", [])]:
        mark = bool(_COMMENT.match(x))
        if not found or mark != was:
            if 1 < len(block) < len(full):
                units.append([t for _, each in block for t in each] + _versions("\n".join(line for line, _ in block)))
            block = []
        if found:
            block.append((x, found))
            was = mark
    return [*units, [t for _, each in full for t in each] + _versions(low)]


def _frequencies(vocabulary):
    schema = pa.schema([("term", pa.string()), ("n", pa.int64())])

    def run(batches):
        count = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for unit in _units(text):
                    count[""] += 1
                    count.update(vocabulary.intersection(unit))
        yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], schema=schema)

    return run


def evidence(files: DataFrame, templates=TEMPLATES, threshold: float = 0.6) -> DataFrame:
    """(path, licence, score) of files with a line, a block of lines or a whole text whose cosine to a template reaches the threshold.

    Weights are TF-IDF: how many units (lines, blocks and whole texts) of all files hold
    each template term is counted over the whole table; terms of no template
    weigh as terms never seen. Of a file's units that reach the threshold the one
    counts of which a template explains most, so that a whole text or a header
    goes before one of its lines; its best template names the licence, the earlier
    of equals, or the family where two of its licences fit alike.
    """
    rows = files.select("path", F.coalesce("text", F.lit("")).alias("text"))
    vocabulary = frozenset(t for _, text in templates for t in terms(text))
    counted = rows.select("text").mapInArrow(_frequencies(vocabulary), "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row per template term
    frequency = {r["term"]: r["n"] for r in counted}
    index = Index(templates, frequency, frequency.get("", 0))
    schema = pa.schema([("path", pa.string()), ("licence", pa.string()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            out = []
            for path, text in zip(batch.column("path").to_pylist(), batch.column("text").to_pylist()):
                found = [b for u in _units(text) if (b := index.best(u, threshold))]
                if found:
                    _, score, name = max(found, key=lambda b: b[:2])
                    out.append((path, name, score))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return rows.mapInArrow(run, "path string, licence string, score double")


def scan(files: DataFrame, templates=TEMPLATES, threshold: float = 0.6) -> DataFrame:
    """One row per distinct path: path, own, score, licence, source, distance.

    own and score are the file's own evidence (null without); a file without
    takes the licence of the licence file in the nearest directory above it,
    its own directory first; source is that file's path, or the file's own, and
    distance the number of directories between. Of several licence files in a
    directory the highest score counts, then the smallest path. Paths are cut at
    "/"; a null path is a file in no directory, and null or empty texts have no
    evidence. Rows that repeat a path count as one file with their best
    evidence. An empty table gives no rows.
    """
    best = F.max_by(F.struct("licence", "score"), F.struct("score", "licence")).alias("e")
    own = cut(evidence(files, templates, threshold).groupBy("path").agg(best).select("path", "e.*"))
    folder = F.regexp_replace("path", "/?[^/]*$", "").alias("folder")
    licensed = cut(
        own.where(F.col("path").rlike(LICENCE_FILE))
        .select(folder, "path", "licence", "score")
        .groupBy("folder")
        .agg(F.min_by(F.struct(F.col("licence").alias("given"), F.col("path").alias("giver")), F.struct(-F.col("score"), "path")).alias("g"))
        .select("folder", "g.*")
    )  # written, so that the join can split the rows of a folder high up
    paths = files.select("path").distinct()
    every = paths.join(own.withColumnRenamed("path", "p"), F.col("path").eqNullSafe(F.col("p")), "left").drop("p").withColumn("in_folder", folder)
    # Each folder is resolved once: those above a/b are "", "a" and "a/b", named by depth.
    parts = F.filter(F.split("in_folder", "/", -1), lambda x: F.col("in_folder") != "")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(F.array_join(F.slice(parts, 1, i), "/").alias("folder"), (F.size(parts) - i).alias("distance")))
    above = cut(
        every.select("in_folder").where("in_folder is not null").distinct()
        .select("in_folder", F.explode(up).alias("f"))
        .select("in_folder", "f.folder", "f.distance")
        .join(licensed, "folder")
        .groupBy("in_folder")
        .agg(F.min_by(F.struct("given", "giver", "distance"), "distance").alias("a"))
        .select("in_folder", "a.*")
    )
    mine = F.col("licence").isNotNull()
    return every.join(above, "in_folder", "left").select(
        "path",
        F.col("licence").alias("own"),
        "score",
        F.coalesce("licence", "given").alias("licence"),
        F.when(mine, F.col("path")).otherwise(F.col("giver")).alias("source"),
        F.when(mine, 0).otherwise(F.col("distance")).cast("int").alias("distance"),
    )
