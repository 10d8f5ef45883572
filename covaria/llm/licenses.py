r"""License scans: Dice coefficient over word bigrams, in built-in functions only.

Each line of a text, and each block of lines between blank ones, is a segment. A segment and
a template are compared by the sets of their word bigrams, words being runs of ASCII letters
and digits (with dots between digits), lowered. With a and b bigrams and Dice at least t,

    b t / (2 - t) <= a <= b (2 - t) / t,

so a segment's size names the templates it can match; others are never compared, and a
segment whose size suits no template is dropped before its bigrams are built. A document is
one row throughout; nothing is shuffled.

Defined results: a null text counts as empty; a document without a match has no licence,
Dice 0 and no matched segment. Of equally good templates the first in order is named. A
block of one line counts once. Repeated rows get equal results. Other columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covaria.llm.text import let

THRESHOLD = 0.8
WORD = r"[a-z0-9]+(?:\.[0-9]+)*"
# Names and published texts of licence notices and short licences.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "This project is licensed under the Apache License, Version 2.0."),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the MIT License."),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("bsd-3-clause", "Licensed under the BSD 3-Clause License."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)


def template_bigrams(text: str) -> list[str]:
    words = re.findall(WORD, text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def size_range(bigrams: int, threshold: float) -> tuple[float, float]:
    """Fewest and most bigrams of a segment that can reach the threshold."""
    return bigrams * threshold / (2 - threshold) - 1e-9, bigrams * (2 - threshold) / threshold + 1e-9


def _distinct_bigrams(words: Column) -> Column:
    pairs = F.zip_with(
        F.slice(words, F.lit(1), F.size(words) - 1),
        F.slice(words, F.lit(2), F.size(words) - 1),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.array_distinct(pairs)


def matches(
    docs: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and its segments that match: arrays of (segment, place, licence, dice)."""
    known = [(name, template_bigrams(text)) for name, text in templates]
    ranges = [size_range(len(b), threshold) for _, b in known]
    table = F.array(*[
        F.struct(
            F.lit(k).alias("k"), F.lit(name).alias("name"), F.lit(len(b)).alias("n"),
            F.lit(low).alias("low"), F.lit(high).alias("high"), F.array(*[F.lit(x) for x in b]).alias("bigrams"),
        )
        for k, ((name, b), (low, high)) in enumerate(zip(known, ranges))
    ])
    most = max(high for _, high in ranges)
    least = min(low for low, _ in ranges)
    text = F.coalesce(F.col(text_col), F.lit(""))

    def segments(kind: str, parts: Column) -> Column:
        return F.transform(parts, lambda p, i: F.struct(F.lit(kind).alias("segment"), i.alias("place"), p.alias("text")))

    blocks = F.filter(F.split(text, r"\n[\x20\x09\x0B-\x0D]*(?:\n|$)"), lambda b: b.contains("\n"))
    every = F.concat(segments("line", F.split(text, "\n")), segments("block", blocks))
    worded = F.transform(
        every,
        lambda s: F.struct(
            s["segment"].alias("segment"),
            s["place"].alias("place"),
            F.regexp_extract_all(F.lower(s["text"]), F.lit(WORD), F.lit(0)).alias("words"),
        ),
    )
    # Bigrams are as many as pairs of words, or fewer where pairs repeat.
    some = F.filter(worded, lambda s: F.size(s["words"]) > least)

    def compared(s: Column) -> Column:
        def best(bigrams: Column) -> Column:
            n = F.size(bigrams)
            fitting = F.filter(table, lambda t: (n >= t["low"]) & (n <= t["high"]))
            scored = F.transform(
                fitting,
                lambda t: F.struct(
                    (2.0 * F.size(F.array_intersect(bigrams, t["bigrams"])) / (n + t["n"])).alias("dice"),
                    (-t["k"]).alias("order"),
                    t["name"].alias("licence"),
                ),
            )
            return F.when(n <= most, F.array_max(scored))

        top = let(_distinct_bigrams(s["words"]), best)
        return let(
            top,
            lambda m: F.struct(
                s["segment"].alias("segment"), s["place"].alias("place"), m["licence"].alias("licence"), m["dice"].alias("dice")
            ),
        )

    rows = docs.select(F.col(id_col).alias("doc_id"), some.alias("segments"))
    found = F.filter(F.transform("segments", compared), lambda m: m["dice"] >= threshold)
    return rows.select("doc_id", found.alias("matches"))


def scanned(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, licences (distinct names in order), n_matches, dice (the best)."""
    found = matches(docs, threshold, TEMPLATES, id_col, text_col)
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["licence"])))
    best = F.array_max(F.transform("matches", lambda m: m["dice"]))
    return found.select(
        "doc_id",
        F.array_join(names, ",").alias("licences"),
        F.size("matches").cast("long").alias("n_matches"),
        F.coalesce(best, F.lit(0.0)).alias("dice"),
    )
