"""Known licences by the digest of their canonical text, in SQL functions only.

Texts are made canonical: copyright lines go, case, marks and white space are
evened out, and equivalent spellings become one. What is left is digested and
hash-joined with the digests of known texts, made the same way. Two units are
looked up, each as a whole: the document, and each of its lines, which finds the
one-line notices that stand at the head of files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that licence matching treats as equal, the first becomes the second.
EQUIVALENT = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("fulfil", "fulfill"),
    ("organisation", "organization"),
    ("organisations", "organizations"),
    ("merchantibility", "merchantability"),
    ("acknowledgement", "acknowledgment"),
    ("favour", "favor"),
    ("behaviour", "behavior"),
    ("centre", "center"),
    ("analogue", "analog"),
    ("judgement", "judgment"),
    ("per cent", "percent"),
    ("copyright holder", "copyright owner"),
    ("copyright holders", "copyright owners"),
    ("http", "https"),
)

# Public licence texts, without their copyright lines, and common one-line notices.
KNOWN = (
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "Zlib",
        """This software is provided 'as-is', without any express or implied warranty. In
no event will the authors be held liable for any damages arising from the use of
this software.

Permission is granted to anyone to use this software for any purpose, including
commercial applications, and to alter it and redistribute it freely, subject to
the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim
that you wrote the original software. If you use this software in a product, an
acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "Licensed under the GNU General Public License, version 2."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
)

COPYRIGHT = (
    r"(\A|\n)[^\p{L}\p{N}\n(©]*"
    r"(?:copyright[ \t]*(?:\(c\)|©|[0-9]{4})|\(c\)[ \t]*[0-9]{4}|©|all rights reserved)[^\n]*"
)
LINE = "\n"


def canonical_lines(text: Column) -> Column:
    """Canonical text that keeps its line ends; copyright lines are empty."""
    plain = F.regexp_replace(F.lower(text), r"\r\n?", "\n")
    plain = F.regexp_replace(plain, COPYRIGHT, "$1")
    plain = F.regexp_replace(plain, r"[^\p{L}\p{N}\n]+", " ")
    spelled = F.concat(F.lit(" "), F.replace(plain, F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    for old, new in EQUIVALENT:
        spelled = F.replace(spelled, F.lit(f" {old} "), F.lit(f" {new} "))
    return spelled


def evened(canonical: Column) -> Column:
    """A canonical text or line with single blanks, line ends included."""
    return F.trim(F.regexp_replace(canonical, r"\s+", " "))


def digest(canonical: Column) -> Column:
    return F.sha2(evened(canonical), 256)


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """``digest``, ``license`` of the known texts; of equal digests the first name counts."""
    rows = spark.createDataFrame(list(known), "license string, body string")
    made = rows.select(digest(canonical_lines(F.col("body"))).alias("digest"), "license")
    return made.groupBy("digest").agg(F.min("license").alias("license"))


def find_licenses(
    docs: DataFrame,
    known: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each unit that is a known text: the id, ``unit``, ``line``, ``digest``, ``license``.

    ``unit`` is ``text`` (then ``line`` is -1) or ``line`` (counted from 0). A
    document of one line that is a notice has both rows. Null and empty texts,
    and units of nothing but marks and copyright lines, have none. Rows are
    independent: repeated rows and null ids have rows of their own.
    """
    known = known_digests(docs.sparkSession) if known is None else known
    canonical = docs.select(
        F.col(id_col), canonical_lines(F.col(text_col)).alias("_hl_canonical")
    )
    whole = F.array(F.struct(F.lit(-1).alias("line"), F.col("_hl_canonical").alias("body")))
    lines = F.transform(
        F.split("_hl_canonical", LINE), lambda body, i: F.struct(i.alias("line"), body.alias("body"))
    )
    units = (
        canonical.select(id_col, F.explode(F.concat(whole, lines)).alias("u"))
        .select(id_col, "u.line", evened(F.col("u.body")).alias("body"))
        .where(F.length("body") > 0)
        .select(id_col, "line", F.sha2("body", 256).alias("digest"))
    )
    unit = F.when(F.col("line") < 0, "text").otherwise("line")
    return units.join(known, "digest").select(id_col, unit.alias("unit"), "line", "digest", "license")
