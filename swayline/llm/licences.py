"""Licence scans: a text is a licence when its canonical digest is that of a known licence text.

Canonical form, by column functions only: lower case; lines that state a copyright are dropped; everything but ASCII letters and
digits becomes one space, so it does not matter where lines break; equivalent spellings are made one; digest by SHA-256. Known texts go through the same form, so the lookup
is one equality join on the digest, of rows that no longer hold the text. The known table is joined without a hint: Spark
broadcasts it when its size allows, and otherwise adaptive execution splits a digest that many documents share.

Null and empty texts have the digest of the empty form and match nothing. Rows are neither dropped nor merged. Known texts with
equal canonical forms are named by the smallest id.

A digest is that of a whole text: a notice or a licence inside a longer text matches nothing.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swayline.llm.common import whole_text

_YEAR = r"[<\[{(]?(?:[0-9]{4}|19yy|yyyy|year)\b"
_SIGN = r"(?:\(c\)|©|&copy;)"
#: A line that states a copyright: the word and a sign or a year, a sign and a year, a sign and a reservation, or a reservation alone. A
#: line of the terms that begins with one of these words (a clause "(c)", "copyright holder") is none.
NOTICE_LINE = (rf"(?md)^[^a-z0-9\n]*(?:(?:{_SIGN}[ \t]*)?copyright[ \t,:]*(?:{_SIGN}|{_YEAR})|{_SIGN}[ \t]*{_YEAR}|{_SIGN}[^\n]*all rights reserved"
               r"|all rights reserved[^a-z0-9\n]*$)[^\n]*$")

#: Equivalent words of the published matching guidelines, in the form of lower-case words with one space between; the
#: canonical one second. Parts of words count, so endings need no entries of their own.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authoris", "authoriz"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("capitalis", "capitaliz"),
    ("catalogue", "catalog"),
    ("categoris", "categoriz"),
    ("centre", "center"),
    ("copyright owner", "copyright holder"),
    ("emphasis", "emphasiz"),
    ("favour", "favor"),
    ("fulfill", "fulfil"),
    ("initialis", "initializ"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("maximis", "maximiz"),
    ("modelled", "modeled"),
    ("modelling", "modeling"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("offence", "offense"),
    ("optimis", "optimiz"),
    ("organis", "organiz"),
    ("per cent", "percent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realis", "realiz"),
    ("recognis", "recogniz"),
    ("signalling", "signaling"),
    ("sub license", "sublicense"),
    ("utilis", "utiliz"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("https ", ""),
    ("http ", ""),
)

#: Published licence texts and notices.
KNOWN = {
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "notice: Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "notice: CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "notice: GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "notice: MIT": "Released under the MIT License.",
}

#: Title lines that files put before a text that has none.
TITLES = {
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License'),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License'),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "Zlib": ("zlib License", "The zlib License"),
}
LAST_LINE = "END OF TERMS AND CONDITIONS"  # after it, texts say how to apply them; files have that part or not


def _published() -> dict[str, str]:
    """The files of ``licence_texts``, whole and up to their last line of terms, and texts under each of their titles."""
    texts = {f.stem: f.read_text("utf-8") for f in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))}
    short = {f"{name}, terms only": text[:text.index(LAST_LINE) + len(LAST_LINE)] for name, text in texts.items() if LAST_LINE in text}
    bare = {f"{name}, terms only, no last line": text.removesuffix(LAST_LINE) for name, text in ((n.removesuffix(", terms only"), t) for n, t in short.items())}
    titled = {f"{name}, titled: {title}": f"{title}\n\n{({**KNOWN, **texts})[name]}" for name, titles in TITLES.items() for title in titles}
    return {**texts, **short, **bare, **titled}


KNOWN |= _published()


def canonical(text: Column) -> Column:
    form = F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), NOTICE_LINE, ""), "[^a-z0-9]+", " "))
    for spelt, spelling in SPELLINGS:
        form = F.replace(form, F.lit(spelt), F.lit(spelling))
    return form


def known_licences(spark: SparkSession) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(k).alias("licence_id"), F.lit(v).alias("text")) for k, v in sorted(KNOWN.items())])
    return spark.range(1).select(F.inline(rows))


def scan(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``canonical_sha256`` and ``licence_id`` (null where the text is no known licence)."""
    form = canonical(whole_text("text"))
    named = (known.select("licence_id", form.alias("form")).filter("form <> ''")
             .groupBy(F.sha2("form", 256).alias("canonical_sha256")).agg(F.min("licence_id").alias("licence_id")))
    rows = docs.select(F.col(doc_id), F.sha2(canonical(whole_text(text)), 256).alias("canonical_sha256"))
    return rows.join(named, "canonical_sha256", "left").select(doc_id, "canonical_sha256", "licence_id")
