"""Licence scans by canonical digests.

A text is brought to a canonical form: lower case, without copyright lines, equivalent spellings made
one, everything but letters and digits turned into single blanks. The digest of an entire unit of text is
then looked up among the digests of known licences by a hash join. Units are the whole text, its blocks
between blank lines and its lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise

# Known licence texts and notices (fixed values; their wording is that of the licences).
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_GPL3 = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
LICENSES = [
    ("MIT", _MIT), ("MIT", "MIT License\n\n" + _MIT), ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC), ("ISC", "ISC License\n\n" + _ISC), ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", _APACHE), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-or-later", _GPL3), ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."), ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
]

# Steps to the canonical form, in order: lines that only say who holds the rights go, equivalent spellings become
# one, punctuation and blanks become single blanks. Both engines read the patterns alike.
RIGHTS = [
    (r"\r", ""),
    (r"(?m)^[^a-z0-9\n©]*(?:copyright[^a-z0-9\n©]*(?:\(c\)|©|[0-9]{4}|by |c [0-9])|\(c\) *[0-9]{4}|© *[0-9]{4})[^\n]*(?:\n|$)", ""),
    (r"(?m)^[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*(?:\n|$)", ""),
]
SPELLINGS = [
    ("licence", "license"), ("sub-license", "sublicense"), ("non-commercial", "noncommercial"), ("non-infring", "noninfring"), ("per cent", "percent"),
    ("copyright owner", "copyright holder"), ("isation", "ization"), ("behaviour", "behavior"), ("favour", "favor"),
    ("acknowledgement", "acknowledgment"), ("https://", "http://"), ("&", " and "),
]
BLANKS = [(r"[^a-z0-9\n\x{80}-\x{10FFFF}]+", " "), (r" ?\n ?", "\n"), (r"^[ \n]+|[ \n]+$", "")]
UNITS = ["text", "block", "line"]


def canonical(text: F.Column) -> F.Column:
    """The canonical form, lines and blank lines kept apart."""
    out = F.lower(text)
    for pattern, replacement in RIGHTS:
        out = F.regexp_replace(out, pattern, replacement)
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    for pattern, replacement in BLANKS:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def known_digests(spark: SparkSession, licenses: list[tuple[str, str]] = LICENSES) -> DataFrame:
    """``license, digest, octets`` of known texts; as large as the list."""
    rows = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(n).alias("license"), F.lit(t).alias("known")) for n, t in licenses])))
    form = F.regexp_replace(canonical(F.col("known")), "\n+", " ")
    return rows.select("license", F.sha2(form, 256).alias("digest"), F.octet_length(form).alias("octets")).distinct()


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", licenses: list[tuple[str, str]] = LICENSES) -> DataFrame:
    """``id, license, unit`` for every licence a row's text is or holds; ``unit`` is the widest that fits.

    NULL and empty texts hold none. Rows that repeat an id are taken together; ids may be NULL. The
    registry is a list in the program, so its broadcast is of fixed size.
    """
    known = materialise(known_digests(docs.sparkSession, licenses), "licenses")
    # equal digests have equal lengths: only units as long as a known text are hashed
    lengths = [r.octets for r in known.select("octets").distinct().collect()]
    fits = lambda x: F.octet_length(x).isin(lengths)

    def ranked(rank: int, parts: F.Column) -> F.Column:
        return F.transform(F.filter(parts, fits), lambda x: F.struct(F.lit(rank).alias("rank"), x.alias("form")))

    def units(form: F.Column) -> F.Column:
        return F.concat(ranked(0, F.array(F.regexp_replace(form, "\n+", " "))), ranked(1, F.split(form, "\n\n+")), ranked(2, F.split(form, "\n+")))

    # the canonical form is bound once per row and not worked out for each use
    every = F.flatten(F.transform(F.array(canonical(docs[text_col].cast("string"))), units))
    each = docs.select(docs[id_col].alias("id"), F.inline(every)).select("id", "rank", F.sha2(F.regexp_replace("form", "\n", " "), 256).alias("digest"))
    found = each.join(F.broadcast(known.drop("octets")), "digest")
    widest = found.groupBy("id", "license").agg(F.min("rank").alias("rank"))
    return widest.select("id", "license", F.element_at(F.array(*map(F.lit, UNITS)), F.col("rank") + 1).alias("unit"))


def by_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", licenses: list[tuple[str, str]] = LICENSES) -> DataFrame:
    """``id`` and ``licenses`` (names with units, sorted) for every row; an empty list where nothing was found."""
    found = scan(docs, id_col, text_col, licenses).groupBy(F.col("id").alias("__id")).agg(F.array_sort(F.collect_list(F.struct("license", "unit"))).alias("licenses"))
    ids = docs.select(docs[id_col].alias("id"))
    joined = ids.join(found, ids.id.eqNullSafe(F.col("__id")), "left")
    return joined.select("id", F.coalesce("licenses", F.array().cast("array<struct<license:string,unit:string>>")).alias("licenses"))
