"""License scans by canonical digest lookup.

A text is brought into a canonical form: statements of copyright away, ASCII letters in
lower case, punctuation and blanks joined into single spaces, equivalent spellings made
one. The SHA-256 of the form is hash-joined to the digests of known licence texts, so
only an entire text can match, in any layout that keeps its paragraphs. Where a
statement ends depends on the layout: its line is it in a header of short lines, its
paragraph where lines were filled again. So a text with a statement has two forms, one
without these lines and one without these paragraphs, as has every known text, and either
may match; ``digest`` is that of the first. Notices of one line, which often stand inside
other texts, are looked up the same way, line by line and without leaving the row.

The long texts stand in ``license_texts``; ``scan`` takes a table of further ones. Known
digests are broadcast up to BROADCAST_LICENSES of them, and shuffled beyond.

Defined results: a null text counts as empty, and a text whose canonical form is empty
matches nothing; texts of any length are digested whole; equal rows get equal results;
an empty table gives an empty table. Other columns are left out.
"""

from __future__ import annotations

import re
from functools import cache, reduce
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, text_or_empty

# Pairs of equivalent spellings, lower case.
SPELLINGS = [
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("judgement", "judgment"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("authorised", "authorized"),
    ("modernised", "modernized"),
    ("fulfil ", "fulfill "),
    ("wilful", "willful"),
    ("while stocks", "whilst stocks"),
    ("https://", "http://"),
]

#: A line that states a copyright: behind an optional comment mark the word or sign with
#: a sign, a year or its placeholder, or a name. A line of the body that merely begins with
#: the word ("copyright notice, this list ...") or with an item "(c)" is none.
_MARK = "(?:[#;%!]+|/{2,}|/?\\*+|--+|<!--|(?i:dnl|rem)(?=[ \\t]))"
_STATES = (
    f"[ \\t]*(?:{_MARK}[ \\t]*)?(?:"
    "(?i:copyright)[ \\t:]*(?:\\([cC]\\)|©|[\\[<{(]?(?:[0-9]{4}|[0-9]{2}[yY]{2}|[yY]{4}|(?i:years?)[\\]>})])|[\\[<{](?i:name|copyright|holder|owner))"
    "|Copyright[ \\t:]+(?:by[ \\t]+)?(?!(?i:notices?|holders?|owners?|licen[cs]es?|laws?|acts?|interests?|statements?|and|or|rights?)\\b)\\p{Lu}"
    "|(?i:copyright)[ \\t]+by[ \\t]+\\p{Lu}"
    "|©"
    "|\\([cC]\\)[ \\t]*(?:(?i:copyright)|[\\[<{]?(?:[0-9]{4}|[yY]{4}))"
    ")"
)
COPYRIGHT_STATEMENT = f"(?m)^{_STATES}[^\\n]*$"
#: A paragraph that begins with such a line, behind the beginning or an empty line, which stays.
_EMPTY = f"[ \\t]*(?:{_MARK}?[ \\t]*)?"
COPYRIGHT_PARAGRAPH = f"(\\A|\\n(?:{_EMPTY}\\n)+){_STATES}(?s:.*?)(?=\\n{_EMPTY}(?:\\n|\\z)|\\z)"
#: What the oracle's SQL removes, which knows no comment marks and takes lines of the body as well.
COPYRIGHT_LINE = "(?m)^[ \\t]*(?:copyright|\\(c\\)|©)[^\\n]*$"
NOT_A_WORD = "[\\x00-/:-@\\[-`{-\\x7f]+"

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_AS_IS_ISC = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

# Public licence texts.
LICENSES = {
    "MIT": """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _AS_IS_ISC,
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n" + _AS_IS_ISC,
    "BSD-2-Clause": f"{_BSD_HEAD}\n{_BSD_TAIL}",
    "BSD-3-Clause": f"{_BSD_HEAD}\n{_BSD_THIRD}\n{_BSD_TAIL}",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "WTFPL": """DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION

0. You just DO WHAT THE FUCK YOU WANT TO.""",
}

# Notices of one line.
NOTICES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."],
    "CC0-1.0": ["Released under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"],
    "LicenseRef-All-Rights-Reserved": ["All rights reserved."],
}

#: What may stand before a short licence text, apart from copyright lines.
_TITLES = {
    "MIT": ["", "MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["", "ISC License", "The ISC License"],
    "BSD-2-Clause": ["", "BSD 2-Clause License", "The 2-Clause BSD License"],
    "BSD-3-Clause": ["", "BSD 3-Clause License", "The 3-Clause BSD License"],
}
#: After this line long texts tell how to apply them; they are known with and without that.
_END_OF_TERMS = "END OF TERMS AND CONDITIONS"
#: Known digests that are sent to every task; more are joined by a shuffle.
BROADCAST_LICENSES = 100_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _joined(text: str) -> str:
    """A spelling as it stands in a form."""
    return re.sub(NOT_A_WORD, " ", text)


def _states_copyright(text: Column) -> Column:
    """Every form of statement has one of these, and most texts have none."""
    return F.lower(text).contains("copyright") | F.lower(text).contains("(c)") | text.contains("©")


def canonical(text: Column, paragraphs: bool = False) -> Column:
    """The form without the lines, or with ``paragraphs`` without the paragraphs, that state a copyright."""
    removed = F.regexp_replace(F.replace(text, F.lit("\r"), F.lit("")), COPYRIGHT_PARAGRAPH, "$1") if paragraphs else F.regexp_replace(text, COPYRIGHT_STATEMENT, "")
    stated = F.when(_states_copyright(text), removed).otherwise(text)
    # blanks are joined before spellings are compared, as a line may end inside one
    words = F.trim(F.regexp_replace(F.translate(stated, _UPPER, _LOWER), NOT_A_WORD, " "))
    return reduce(lambda t, pair: F.replace(t, F.lit(_joined(pair[0])), F.lit(_joined(pair[1]))), SPELLINGS, words)


def canonical_digest(text: Column, paragraphs: bool = False) -> Column:
    """Hex SHA-256 of the canonical form; null where that is empty."""
    form = canonical(text, paragraphs)
    return F.when(form != "", F.sha2(form, 256))


def known_texts() -> list[tuple[str, str]]:
    """License id and text of every known licence, in each of its usual forms, and of every notice."""
    out = [(k, t) for k, t in LICENSES.items()] + [(k, t) for k, texts in NOTICES.items() for t in texts]
    for k, titles in _TITLES.items():
        body = LICENSES[k].removeprefix(f"{k} License\n\n")
        out += [(k, f"{title}\n\n{rights}\n{body}") for title in titles for rights in ("", "All rights reserved.")]
    for file in sorted(resources.files(__package__).joinpath("license_texts").iterdir(), key=lambda f: f.name):
        text = file.read_text(encoding="utf-8")
        out.append((file.name.removesuffix(".txt"), text))
        if _END_OF_TERMS in text:
            terms = text[: text.index(_END_OF_TERMS)]
            out += [(out[-1][0], terms), (out[-1][0], terms + _END_OF_TERMS)]
    return out


@cache
def _default_digests() -> list[tuple[str, str]]:
    """Computed once a process, so that the long texts stay out of the plans."""
    rows = SparkSession.active().createDataFrame(known_texts(), "license_id string, text string")
    forms = F.array(canonical_digest(F.col("text")), canonical_digest(F.col("text"), True))
    return [tuple(r) for r in rows.select("license_id", F.explode(F.array_distinct(F.array_compact(forms)))).collect()]


def known_digests(spark: SparkSession, known: DataFrame | None = None) -> DataFrame:
    """license_id and digest of every known text and notice, and of those of ``known`` (license_id, text), which go first."""
    entries = F.array(*[F.struct(F.lit(k).alias("license_id"), F.lit(d).alias("digest")) for k, d in _default_digests()])
    rows = spark.range(1).select(F.inline(entries)).withColumn("place", F.lit(1))
    if known is not None:
        forms = F.array(canonical_digest(F.col("text")), canonical_digest(F.col("text"), True))
        given = known.select("license_id", F.explode(F.array_distinct(F.array_compact(forms))).alias("digest"), F.lit(0).alias("place"))
        rows = given.filter("digest IS NOT NULL AND license_id IS NOT NULL").unionByName(rows)
    return rows.groupBy("digest").agg(F.min(F.struct("place", "license_id"))["license_id"].alias("license_id")).select("license_id", "digest")


def notice_lines(text: Column) -> Column:
    """The licence ids of the lines that are a known notice as a whole, in order."""
    known = F.map_from_entries(F.array(*[F.struct(canonical(F.lit(t)), F.lit(k)) for k, texts in NOTICES.items() for t in texts]))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("(?i)licen|reserved|released"))
    found = F.filter(F.transform(lines, lambda x: F.try_element_at(known, canonical(x))), lambda k: k.isNotNull())
    # most texts need not be cut into lines
    worth = F.lower(text).contains("licen") | F.lower(text).contains("reserved") | F.lower(text).contains("released")
    return F.when(worth, found).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, digest, license_id of the entire text (or null), its notices and how many lines they are.

    ``known`` adds licence texts (license_id, text) to those known by default.
    """
    text = text_or_empty("text")
    other = F.when(_states_copyright(text), canonical_digest(text, True)).alias("_other")
    digested = docs.select("doc_id", canonical_digest(text).alias("digest"), other, notice_lines(text).alias("_notices"))
    digests = known_digests(docs.sparkSession, known)
    if known is not None:
        digests = checkpointed(digests)
    small = F.broadcast if known is None or digests.count() <= BROADCAST_LICENSES else lambda x: x
    by_paragraph = digests.select(F.col("digest").alias("_other"), F.col("license_id").alias("_license"))
    found = digested.join(small(digests), "digest", "left").join(small(by_paragraph), "_other", "left")
    return found.select(
        "doc_id",
        "digest",
        F.coalesce("license_id", "_license").alias("license_id"),
        F.array_join(F.array_sort(F.array_distinct("_notices")), ",").alias("notices"),
        F.size("_notices").cast("long").alias("n_notice_lines"),
    )


def oracle() -> str:
    """The same scan as DuckDB SQL over ``documents``."""

    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def form(t: str) -> str:
        out = f"regexp_replace(translate({t}, '{_UPPER}', '{_LOWER}'), {q(COPYRIGHT_LINE)}, '', 'g')"
        out = f"trim(regexp_replace({out}, {q(NOT_A_WORD)}, ' ', 'g'))"
        for a, b in SPELLINGS:
            out = f"replace({out}, {q(_joined(a))}, {q(_joined(b))})"
        return out

    rows = [(k, t) for k, t in LICENSES.items()] + [(k, t) for k, texts in NOTICES.items() for t in texts]
    notices = [(k, t) for k, texts in NOTICES.items() for t in texts]
    values = lambda pairs: ", ".join(f"({q(k)}, {q(t)})" for k, t in pairs)
    return f"""
WITH known AS (SELECT DISTINCT license_id, sha256({form('t')}) AS digest FROM (VALUES {values(rows)}) v(license_id, t)),
notice AS (SELECT license_id, {form('t')} AS form FROM (VALUES {values(notices)}) v(license_id, t)),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
digested AS (SELECT doc_id, CASE WHEN form <> '' THEN sha256(form) END AS digest FROM (SELECT doc_id, {form('text')} AS form FROM d)),
lines AS (SELECT doc_id, {form('line')} AS form FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE length(line) BETWEEN 10 AND 400 AND regexp_matches(line, '(?i)licen|reserved|released')),
hits AS (SELECT doc_id, license_id FROM lines JOIN notice USING (form)),
per AS (SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices, count(*) AS n FROM hits GROUP BY doc_id)
SELECT x.doc_id, x.digest, known.license_id, coalesce(per.notices, '') AS notices, coalesce(per.n, 0)::BIGINT AS n_notice_lines
FROM digested x LEFT JOIN known ON x.digest = known.digest LEFT JOIN per ON x.doc_id = per.doc_id
"""
