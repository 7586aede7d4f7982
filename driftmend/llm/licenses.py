"""Licence texts by the digest of their canonical form.

A text is lower-cased, its copyright lines are dropped, punctuation and white space become single blanks, and spellings
that mean the same are made one. The digest of what is left is looked up by a hash join among those of known licences.
Single lines are looked up as well, among known notices. All work is DataFrame expressions.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmend.sources.sinks import staged

# Spellings that licence matching guidelines treat as one.
SPELLINGS = (
    ("licence", "license"), ("https", "http"), ("copyright holders", "copyright holder"), ("copyright owners", "copyright holder"),
    ("copyright owner", "copyright holder"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("per cent", "percent"),
    ("whilst", "while"), ("favour", "favor"), ("acknowledgement", "acknowledgment"), ("judgement", "judgment"),
    ("organisation", "organization"), ("authorisation", "authorization"), ("fulfilment", "fulfillment"), ("wilful", "willful"), ("labour", "labor"),
)

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.\n"
)
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES '
    "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
    "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
    "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
# The public wording of short licences, as (identifier, text).
LICENSES = (
    (
        "MIT",
        "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, '
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be "
        f"included in all copies or substantial portions of the Software.\n\n{_WARRANTY} IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("BSD-2-Clause", f"{_BSD_START}\n{_BSD_END}"),
    (
        "BSD-3-Clause",
        f"{_BSD_START}3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        f"derived from this software without specific prior written permission.\n\n{_BSD_END}",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        f"the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_END}",
    ),
    ("0BSD", f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n{_ISC_END}"),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must "
        "not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly "
        "marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any "
        "source distribution.",
    ),
)
# One-line notices, as (identifier, text).
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
)

# Standard headers and notices that the SQL form does not list, as (identifier, line).
MORE_NOTICES = (
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *((name, f"SPDX-License-Identifier: {name}") for name in ("0BSD", "BSD-2-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "ISC", "Unlicense", "Zlib")),
    *((name, f"SPDX-License-Identifier: {name}-{end}") for name in ("AGPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0") for end in ("only", "or-later")),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
)
#: Longer licences, a file each; what follows the end of their terms may be left out.
TEXTS = Path(__file__).parent / "license_texts"
END = "END OF TERMS AND CONDITIONS"

MARKS = "‘’“”–— ©"
_PUNCTUATION = "[\\x00-/:-`{-\\x7f]+"
_COPYRIGHT = "^ *(copyright ([0-9]{4}|c( |$))|c [0-9]{4}|all rights reserved *$)"


def canonical(line: Column) -> Column:
    """The canonical form of one line; empty for a copyright line."""
    low = F.lower(F.replace(line, F.lit("©"), F.lit("(c)")))
    plain = F.trim(F.regexp_replace(F.translate(low, MARKS, " " * len(MARKS)), _PUNCTUATION, " "))
    for other, one in SPELLINGS:
        plain = F.replace(plain, F.lit(other), F.lit(one))
    return F.when(plain.rlike(_COPYRIGHT), F.lit("")).otherwise(plain)


def _lines(text: Column) -> Column:
    return F.transform(F.split(F.coalesce(text.cast("string"), F.lit("")), "\n"), canonical)


def _whole(lines: Column) -> Column:
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def known_texts(spark: SparkSession) -> DataFrame:
    """(part, license, text): LICENSES and the files of TEXTS as whole texts (part 0), NOTICES and MORE_NOTICES as lines (part 1)."""
    rows = [(0, *x) for x in LICENSES] + [(1, *x) for x in (*NOTICES, *MORE_NOTICES)]
    for path in sorted(TEXTS.glob("*.txt")):
        text = path.read_text("utf-8")
        rows.append((0, path.stem, text))
        if END in text:
            rows.append((0, path.stem, text[: text.index(END) + len(END)]))
    return spark.createDataFrame(rows, "part int, license string, text string")


def known_digests(known: DataFrame) -> DataFrame:
    """(digest, part, license) of ``known`` (part, license, text), the first name of each; texts without a word are left out."""
    whole = known.select(_whole(_lines(F.col("text"))).alias("whole"), F.col("part").cast("int"), "license")
    return whole.where("whole <> '' AND license IS NOT NULL").select(F.sha2(F.col("whole").cast("binary"), 256).alias("digest"), "part", "license").groupBy("digest", "part").agg(F.min("license").alias("license"))


def license_digests(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(doc_id, digest, license, n_notices, notices) of each row of ``docs`` (doc_id, text, ...).

    ``known`` (part, license, text) are the known whole texts (part 0) and notices of one line (part 1), by default
    those of ``known_texts``; a table of any size, written once as digests so that the planner knows its size.

    digest is the SHA-256 of the whole text's canonical form, license the known licence whose text that is, or null.
    notices are line:license of the lines, counted from 1, that are known notices, in order and joined by commas. A
    null or empty text has the digest of no text and no licence. Repeated rows each get their row, a null doc_id is
    passed on, other columns play no part, an empty table gives none.
    """
    named = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"), _lines(F.col("text")).alias("lines"))
    units = F.concat(F.array(_whole(F.col("lines"))), F.col("lines"))
    each = named.select("doc_id", "key", F.posexplode(units).alias("line", "unit"))
    each = each.where("line = 0 OR unit <> ''").select(
        "doc_id", "key", "line", F.sha2(F.col("unit").cast("binary"), 256).alias("digest"), F.when(F.col("line") == 0, 0).otherwise(1).alias("part")
    )
    digests = staged(known_digests(known_texts(docs.sparkSession) if known is None else known), "known")
    found = each.join(digests, ["digest", "part"], "left").where("line = 0 OR license IS NOT NULL")
    # Rows with the same id and text are folded and counted.
    notice = F.when(F.col("line") > 0, F.struct("line", "license"))
    folded = found.groupBy("doc_id", "key").agg(
        F.count_if(F.col("line") == 0).alias("copies"),
        F.max(F.when(F.col("line") == 0, F.col("digest"))).alias("digest"),
        F.max(F.when(F.col("line") == 0, F.col("license"))).alias("license"),
        F.array_sort(F.collect_set(notice)).alias("found"),
    )
    text = F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["line"].cast("string"), s["license"])), ",")
    return folded.select(
        "doc_id", "digest", "license", F.size("found").cast("long").alias("n_notices"), text.alias("notices"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    ).drop("copy")


def oracle_sql() -> str:
    """The same rows in DuckDB's SQL."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    plain = f"trim(regexp_replace(translate(lower(replace(x, '©', '(c)')), {quoted(MARKS)}, '{' ' * len(MARKS)}'), '{_PUNCTUATION}', ' ', 'g'))"
    for other, one in SPELLINGS:
        plain = f"replace({plain}, '{other}', '{one}')"
    lines = f"list_transform(list_transform(string_split(text, chr(10)), lambda x: {plain}), lambda y: CASE WHEN regexp_matches(y, '{_COPYRIGHT}') THEN '' ELSE y END)"
    known = ", ".join(f"({part}, {quoted(name)}, {quoted(text)})" for part, texts in enumerate((LICENSES, NOTICES)) for name, text in texts)
    whole = "array_to_string(list_filter(lines, lambda x: x <> ''), ' ')"
    return f"""
WITH known_texts(part, license, text) AS (VALUES {known}),
known AS (SELECT DISTINCT part, license, sha256({whole}) AS digest FROM (SELECT part, license, {lines} AS lines FROM known_texts)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {lines} AS lines FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
units AS (SELECT r, unnest(lines) AS unit, unnest(range(1, len(lines) + 1)) AS line FROM docs),
notices AS (
    SELECT r, count(*) AS n, string_agg(line || ':' || license, ',' ORDER BY line, license) AS notices
    FROM units JOIN known ON known.part = 1 AND known.digest = sha256(unit) AND unit <> '' GROUP BY r)
SELECT doc_id, sha256({whole}) AS digest, license, coalesce(n, 0)::BIGINT AS n_notices, coalesce(notices, '') AS notices
FROM docs LEFT JOIN known ON known.part = 0 AND known.digest = sha256({whole}) LEFT JOIN notices USING (r)
"""
