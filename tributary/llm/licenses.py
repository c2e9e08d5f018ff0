"""License scan: passages against license templates by the Dice coefficient of their word bigrams.

A text's words are its lower-cased runs of letters and digits. A passage is a run of whole lines; of a line with more
bigrams than a passage that matches can have, any part is one too, so a run may begin or end within such a line. It
matches a template if the Dice coefficient of their sets of word bigrams, 2 |A and B| / (|A| +
|B|), is at least `threshold`; of a template's matches the largest coefficient counts, then the fewest lines, then the
first. Sizes bound the coefficient: a passage of m distinct bigrams and a template of n reach t only if m is between n t /
(2 - t) and n (2 - t) / t, and a text that holds fewer than n t / (2 - t) of a template's bigrams cannot match it at all,
which leaves most texts without a candidate template after one look at their bigrams.

Templates are sent to the executors as they are. A table of more than BLOCK_BYTES of them is read in blocks by
scan_table(): each block is a pass over the texts, and a text's matches of all blocks are united. Null and empty texts, and those without a match, have no license. Repeated rows are repeated in the result. Extra columns are
ignored. Texts are scanned whole, however long.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

THRESHOLD, BLOCK_BYTES = 0.8, 4 << 20
_WORD = re.compile(r"[^\W_]+")

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
)
_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
_BSD3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_AS_IS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."

# Public license texts and notices: fixed values.
TEMPLATES = {
    "MIT": _MIT + _AS_IS,
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": _BSD + _BSD_AS_IS,
    "BSD-3-Clause": _BSD + _BSD3 + _BSD_AS_IS,
    "BSD-3-Clause-notice": "Licensed under the BSD 3-Clause License.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "GPL-2.0-or-later": _GNU.format(name="General Public License", version=2),
    "GPL-3.0-or-later": _GNU.format(name="General Public License", version=3),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0-or-later": _GNU.format(name="Lesser General Public License", version=3),
    "AGPL-3.0-or-later": _GNU.format(name="Affero General Public License", version=3),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "BSL-1.0-notice": "Distributed under the Boost Software License, Version 1.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
}


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def dice(a: set, b: set) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


class Scanner:
    def __init__(self, templates: dict[str, str], threshold: float = THRESHOLD) -> None:
        self.threshold, self.factor = threshold, threshold / (2 - threshold)
        found = {name: words(text) for name, text in templates.items()}
        self.templates = {name: set(zip(w, w[1:])) for name, w in sorted(found.items()) if len(w) > 1}
        self.holders: dict[tuple, list[str]] = defaultdict(list)
        for name, pairs in self.templates.items():
            for pair in pairs:
                self.holders[pair].append(name)

    def __call__(self, text: str) -> list[tuple[str, float, int, int]]:
        """(license, dice, first line, line after the last) of each template that a passage matches, by name."""
        whole = words(text)
        known = self.holders.keys() & set(zip(whole, whole[1:]))
        held: dict[str, int] = defaultdict(int)
        for pair in known:
            for name in self.holders[pair]:
                held[name] += 1
        candidates = [n for n in sorted(held) if held[n] >= self.factor * len(self.templates[n]) - 1e-9]
        if not candidates:
            return []
        lines = [words(x) for x in text.split("\n")]
        found = []
        for name in candidates:
            best = self._best(lines, self.templates[name])
            if best:
                found.append((name, best[0], best[1], best[2]))
        return found

    def _best(self, lines: list[list[str]], template: set) -> tuple[float, int, int] | None:
        """The best run of lines, or of words where a line is too long: each start is followed until the run has more bigrams than can match."""
        least, most = self.factor * len(template), len(template) / self.factor
        units: list[list[str]] = []
        line_of: list[int] = []
        for k, line in enumerate(lines):
            parts = [[w] for w in line] if len(line) - 1 > most and len(set(zip(line, line[1:]))) > most + 1e-9 else [line]
            units += parts
            line_of += [k] * len(parts)
        # The first word after each unit.
        after: list[str | None] = [None] * len(units)
        for k in range(len(units) - 2, -1, -1):
            after[k] = units[k + 1][0] if units[k + 1] else after[k + 1]
        # A run that matches starts and ends with a unit that adds a bigram of the template, or it could be shorter.
        terms = {w for pair in template for w in pair}
        at = [k for k, unit in enumerate(units) if any(w in terms for w in unit)]
        best: tuple[float, int, int] | None = None
        for i, start in enumerate(at):
            if len(units[start]) == 1 and (units[start][0], after[start]) not in template:
                continue
            pairs: set = set()
            shared = 0
            last = None
            done = done_last = start
            for end in at[i:]:
                again = False
                for k in range(done, end + 1):
                    unit = units[k]
                    # Without its first unit a run has the same bigrams, if that unit and the word after it come again.
                    if unit and k > start + 1 and done_last > start and units[done_last] == units[start] and unit[0] == after[start]:
                        again = True
                        break
                    run = [last, *unit] if last is not None else unit
                    for pair in zip(run, run[1:]):
                        if pair not in pairs:
                            pairs.add(pair)
                            shared += pair in template
                    if unit:
                        last, done_last = unit[-1], k
                if again:
                    break
                done = end + 1
                if len(pairs) > most + 1e-9:
                    break
                if len(pairs) >= least - 1e-9:
                    value = 2 * shared / (len(pairs) + len(template))
                    first, stop = line_of[start], line_of[end] + 1
                    if value >= self.threshold - 1e-12 and (best is None or (-value, stop - first, first) < (-best[0], best[2] - best[1], best[1])):
                        best = (value, first, stop)
        return best


def blocks(templates: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[dict[str, str]]:
    """Templates (license, text) in blocks of bounded size; a larger one is a block of its own, rows with a null are left out."""
    block: dict[str, str] = {}
    size = 0
    frame = templates.select(F.col("license").cast("string").alias("license"), F.col("text").cast("string").alias("text"))
    for row in frame.where("license is not null and text is not null").toLocalIterator():
        n = len(row["text"].encode())
        if block and (size + n > block_bytes or row["license"] in block):
            yield block
            block, size = {}, 0
        block[row["license"]] = row["text"]
        size += n
    yield block


FOUND = "doc_id bigint, found array<struct<license:string,dice:double,first_line:bigint,end_line:bigint>>"
_FOUND = pa.struct([("license", pa.string()), ("dice", pa.float64()), ("first_line", pa.int64()), ("end_line", pa.int64())])


def scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id and the licenses found, best first."""
    chosen = TEMPLATES if templates is None else templates

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen, threshold)
        for batch in batches:
            found = [sorted(scanner(x.as_py() or ""), key=lambda m: (-m[1], m[0])) for x in batch.column(1)]
            rows = [[{"license": n, "dice": d, "first_line": a, "end_line": b} for n, d, a, b in f] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(_FOUND))], ["doc_id", "found"])

    return common.map_batches(docs, [F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")], step, FOUND)


def scan_table(docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """scan() with a table of templates (license, text) of any size; of templates that share a name the best match counts."""
    left = blocks(templates, block_bytes)
    first, more = next(left), next(left, None)
    if more is None:
        return scan(docs, first, id_col, text_col, threshold)
    rows = common.stored(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("row")), "rows")
    path = common.scratch(docs.sparkSession, "licenses")
    block: dict[str, str] | None = first
    while block is not None:
        scan(rows, block, "row", "text", threshold).where(F.size("found") > 0).write.mode("append").parquet(path)
        block, more = more, next(left, None) if more is not None else None
    best = docs.sparkSession.read.schema(FOUND).parquet(path).select("doc_id", F.explode("found").alias("m"))
    best = best.groupBy("doc_id", "m.license").agg(F.min(F.struct((-F.col("m.dice")).alias("d"), (F.col("m.end_line") - F.col("m.first_line")).alias("n"), F.col("m.first_line").alias("a"), F.col("m.end_line").alias("b"))).alias("x"))
    ranked = F.array_sort(F.collect_list(F.struct("x.d", "license", "x.a", "x.b")))
    found = F.transform(ranked, lambda m: F.struct(m["license"].alias("license"), (-m["d"]).alias("dice"), m["a"].alias("first_line"), m["b"].alias("end_line")))
    united = best.groupBy(F.col("doc_id").alias("row")).agg(found.alias("found"))
    return rows.join(united, "row", "left").select("doc_id", F.coalesce("found", F.array().cast(FOUND.partition(", found ")[2])).alias("found"))


def op7_licenses(spark, sf_dir: str) -> DataFrame:
    found = scan(common.table(spark, sf_dir, "documents"))
    best = F.get("found", F.lit(0))
    return found.select(
        "doc_id",
        F.size("found").cast("bigint").alias("n_licenses"),
        best["license"].alias("license"),
        best["dice"].alias("dice"),
        F.array_join(F.transform("found", lambda m: F.concat_ws(":", m["license"], m["first_line"], m["end_line"])), ",").alias("found"),
    )
