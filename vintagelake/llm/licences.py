"""Licence scans by canonical digest.

A text is brought to a canonical form: case, punctuation, copyright lines and spellings that vary make
no difference. The digest of the whole form is looked up among the digests of known licences with a hash
join; so is each line's, against the short notices that point to a licence. All of it is DataFrame
functions, and the SQL below says the same.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.common import prepare

# Texts of public licences, without their copyright lines.
_MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted"""
_ISC_TERMS = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.
"""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.
If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.
3. This notice may not be removed or altered from any source distribution."""
TEXTS = [
    ("MIT", "MIT License\n" + _MIT_BODY),
    ("MIT", _MIT_BODY),
    ("ISC", "ISC License\n" + _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_TERMS),
    ("ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_TERMS),
    ("0BSD", _ISC_GRANT + ".\n" + _ISC_TERMS),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("Zlib", "zlib License\n" + _ZLIB),
    ("Zlib", _ZLIB),
]
# Usual titles of the short ones beside those above.
_TITLES = {
    "MIT": ["The MIT License (MIT)", "MIT License (MIT)", "The MIT License"],
    "ISC": ["The ISC License", "ISC License (ISC)"],
    "0BSD": ["Zero-Clause BSD", "BSD Zero Clause License", "Zero-Clause BSD License"],
    "BSD-2-Clause": ["The BSD 2-Clause License", "Simplified BSD License", "BSD License"],
    "BSD-3-Clause": ["The BSD 3-Clause License", "New BSD License", "BSD License"],
    "Zlib": ["The zlib License", "zlib/libpng License"],
}
_BARE = {name: text for name, text in TEXTS if not text.startswith(("MIT", "ISC", "BSD", "zlib"))}
TEXTS += [(name, f"{title}\n{_BARE[name]}") for name, titles in _TITLES.items() for title in titles]
# Long ones are files; most end with advice on their use, which copies may leave out.
_END = "END OF TERMS AND CONDITIONS"
for _file in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")):
    _text = _file.read_text(encoding="utf-8")
    TEXTS += [(_file.stem, t) for t in dict.fromkeys((_text, _text.partition(_END)[0] + _END * (_END in _text), _text.partition(_END)[0]))]
# One-line notices.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
]
# Spellings that mean the same, in the order in which they are replaced.
SPELLINGS = [
    ("sub licen", "sublicen"), ("licence", "license"), ("sublicence", "sublicense"), ("non infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"), ("merchantibility", "merchantability"), ("organisation", "organization"),
    ("authorisation", "authorization"), ("favour", "favor"), ("fulfilment", "fulfillment"), ("per cent", "percent"),
    ("copyright owner", "copyright holder"), ("https", "http"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A line that names who holds the copyright, or reserves all rights.
_HOLDER = r"(^|\n)[ \t]*((copyright|\(c\)|©)[ \t]*(\(c\)|©|[0-9<\[{])[^\n]*|all rights reserved[ .\r]*)"
# What separates words: all but line feeds, and letters, the marks on them and numbers of any script.
_MARKS = r"[^a-z0-9\n\p{L}\p{M}\p{N}]+"
# A line of these that reserves all rights.
_RESERVED = r"(?im)^[ \t]*(?:(?:copyright|\(c\)|©)[^\n]*?)?all rights reserved[ .\r]*$"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canonical(text: str, engine: str) -> str:
    """SQL for the canonical form, lines kept apart by line feeds. The two engines differ in escapes alone."""
    if engine == "spark":
        q, one, flags = (lambda s: "r" + _quoted(s)), "$1", ""
    else:
        q, one, flags = _quoted, r"\1", ", 'g'"
    x = f"translate({text}, '{_UPPER}', '{_LOWER}')"
    x = f"regexp_replace({x}, {q(_HOLDER)}, {q(one)}{flags})"
    x = f"regexp_replace({x}, {q(_MARKS)}, ' '{flags})"
    for old, new in SPELLINGS:
        x = f"replace({x}, '{old}', '{new}')"
    return x


def digests(spark, texts: list[tuple[str, str]]) -> DataFrame:
    """digest, licence of known texts. Each digest once."""
    rows = spark.createDataFrame(texts, "licence string, text string").selectExpr("licence", _canonical("text", "spark") + " AS form")
    whole = F.trim(F.regexp_replace("form", "[ \n]+", " "))
    return rows.select(F.md5(whole).alias("digest"), "licence").groupBy("digest").agg(F.min("licence").alias("licence"))


def scanned(docs: DataFrame, texts: list[tuple[str, str]] = TEXTS, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """doc_id, digest, licence, n_notices, notices, n_reserved for each row of docs (doc_id, text).

    digest is the MD5 of the canonical whole text (null if nothing is left of it), licence the known licence
    with that digest or null, n_notices the number of lines that are known notices, and notices their licences,
    distinct, sorted and joined by commas. n_reserved is the number of lines that reserve all rights, alone or after a
    copyright. Null, empty and blank texts have none. texts and notices are (licence, text) and may be longer
    than those above. Repeated rows are
    scanned alike; an empty table gives an empty result. The known lists are broadcast: they are fixed, a
    few dozen digests.
    """
    spark = prepare(docs.sparkSession)
    known = digests(spark, texts)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select(
        "doc_id", F.expr(_canonical("text", "spark")).alias("form"), F.regexp_count("text", F.lit(_RESERVED)).cast("bigint").alias("n_reserved")
    )
    whole = F.trim(F.regexp_replace("form", "[ \n]+", " "))
    # All forms of the usual notices have this word; a quick look spares most texts the digests.
    short = spark.createDataFrame(notices, "licence string, text string").selectExpr(_canonical("text", "spark") + " AS form")
    wanted = F.lit(True) if short.where(~F.col("form").contains("license")).count() else F.col("form").contains("license")
    names = {r.digest: r.licence for r in digests(spark, notices).collect()}
    table = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    lines = F.filter(F.transform(F.split("form", "\n"), lambda x: F.element_at(table, F.md5(F.trim(x)))), lambda x: x.isNotNull())
    rows = rows.select(
        "doc_id", F.when(whole != "", F.md5(whole)).alias("digest"),
        F.when(wanted, lines).otherwise(F.array().cast("array<string>")).alias("found"), "n_reserved",
    )
    return rows.join(F.broadcast(known), "digest", "left").select(
        "doc_id", "digest", "licence", F.size("found").cast("bigint").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("notices"), "n_reserved",
    )


def sql() -> str:
    """The same in the other engine's SQL, over the table documents."""
    form = _canonical("coalesce(text, '')", "duckdb")

    def listed(values: list[tuple[str, str]]) -> str:
        rows = ", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in values)
        return (
            f"SELECT md5(trim(regexp_replace(form, '[ \n]+', ' ', 'g'))) AS digest, min(licence) AS licence FROM"
            f" (SELECT licence, {_canonical('text', 'duckdb')} AS form FROM (VALUES {rows}) AS v(licence, text)) GROUP BY 1"
        )

    return f"""
    WITH known AS ({listed(TEXTS)}), short AS ({listed(NOTICES)}),
    forms AS (SELECT row_number() OVER () AS n, doc_id, {form} AS form FROM documents),
    lines AS (SELECT n, unnest(string_split(form, '\n')) AS line FROM forms WHERE contains(form, 'license')),
    found AS (SELECT n, count(*) AS n_notices, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices
      FROM lines JOIN short ON md5(trim(line)) = digest GROUP BY n),
    whole AS (SELECT n, doc_id, nullif(trim(regexp_replace(form, '[ \n]+', ' ', 'g')), '') AS text FROM forms)
    SELECT doc_id, md5(text) AS digest, licence, coalesce(n_notices, 0) AS n_notices, coalesce(notices, '') AS notices
    FROM whole LEFT JOIN known ON md5(text) = digest LEFT JOIN found USING (n)"""
