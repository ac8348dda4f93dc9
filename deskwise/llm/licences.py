"""Licence texts found by canonical digest, in DataFrame operations alone.

A text is brought to a canonical form: lower case, no copyright lines, punctuation and white space as
single spaces, and one spelling for words and phrases that licences spell in two ways. Texts whose canonical
digests equal that of a known licence are that licence; whole texts are compared, never parts.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings to be treated as equal, from public matching guidelines for licences.
EQUIVALENT_SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "https": "http",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licenced": "licensed",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "sublicence": "sublicense",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "wilfull",
}

# The same for phrases and for spellings of several words, as patterns of folded texts.
EQUIVALENT_PHRASES = {
    r"\bcopyright owner": "copyright holder",
    r"\bnon commercial": "noncommercial",
    r"\bper cent\b": "percent",
    r"\bsub licen([cs])": "sublicen$1",
}

# Texts by which works state their licence, and two licences in full without a title.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN
NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
]

# Further licences in full, a file each by its name; the first paragraph of a file is the title.
TEXTS = Path(__file__).with_name("licence_texts")
# Titles under which short licences are found, besides those of their files.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "BSD-2-Clause": ["The BSD 2-Clause License", "Simplified BSD License", "BSD License"],
    "BSD-3-Clause": ["The BSD 3-Clause License", "New BSD License", "BSD License"],
    "0BSD": ["Zero-Clause BSD", "BSD Zero Clause License (0BSD)"],
    "Zlib": ["The zlib License", "zlib/libpng License"],
    "Unlicense": ["Unlicense"],
}
TERMS_END = "END OF TERMS AND CONDITIONS"


def _known() -> list[tuple[str, str]]:
    """The notices, and each full text with and without titles, what follows its terms, and numbers."""
    whole = [(name, "", text) for name, text in NOTICES if "\n" in text]
    for file in sorted(TEXTS.glob("*.txt")):
        title, body = file.read_text(encoding="utf-8").strip().split("\n\n", 1)
        whole.append((file.stem, title, body))
    known = list(NOTICES)
    for name, title, body in whole:
        bodies = [body]
        if TERMS_END in body:
            bodies.append(body[: body.index(TERMS_END) + len(TERMS_END)])
            bodies.append(body[: body.index(TERMS_END)])
        if name.startswith("BSD-"):
            bodies.append(body.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* "))
        titles = [t for t in [title, *TITLES.get(name, [])] if t]
        known += [(name, b) for b in bodies] + [(name, f"{t}\n\n{b}") for t in titles for b in bodies]
    return known


# (licence, text) of all known texts.
KNOWN_LICENCES = _known()

# Lines that state a copyright: by a sign, a year, a name behind 'by' or a place for them, or as the first
# line of a text or paragraph. A line of a licence may begin with 'copyright' wherever it is wrapped.
COPYRIGHT_LINE = (
    r"(?m)(?:\A|\n)[^\p{L}\p{N}\n]*(?:"
    r"copyright[ \t:,]*(?:\(c\)|©|[<\[{(]*(?:\d{4}|year|yyyy)|by\b)[^\n]*"
    r"|copyright[^\n]*all rights reserved[^\n]*"
    r"|\(c\)[ \t]*(?:copyright|[<\[{(]*(?:\d{4}|year|yyyy))[^\n]*"
    r"|©[^\n]*"
    r"|all rights reserved[^\p{L}\p{N}\n]*$)"
    r"|(?:\A|\n[ \t\r]*\n)[ \t#*/%;.-]*copyright[ \t][^\n]*"
    r"|\A[ \t#*/%;.-]*\(c\)[ \t][^\n]*"
)
NOT_WORDS = r"[^\p{L}\p{N}]+"


def folded(text: Column) -> Column:
    """Lower case, without copyright lines, words apart by single spaces, one form for each phrase."""
    plain = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    words = F.trim(F.regexp_replace(plain, NOT_WORDS, " "))
    for phrase, form in EQUIVALENT_PHRASES.items():
        words = F.regexp_replace(words, phrase, form)
    return words


def respelled(words: Column) -> Column:
    """One spelling for each of the equivalent words of a folded text."""
    pairs = [F.lit(x) for pair in EQUIVALENT_SPELLINGS.items() for x in pair]
    spelling = F.create_map(*pairs)
    return F.array_join(F.transform(F.split(words, " "), lambda w: F.coalesce(spelling[w], w)), " ")


def canonical(text: Column) -> Column:
    return respelled(folded(text))


def known_digests(spark: SparkSession, licences: list[tuple[str, str]] = KNOWN_LICENCES) -> DataFrame:
    return digests_of(spark.createDataFrame(licences, "licence string, known string"))


def digests_of(texts: DataFrame) -> DataFrame:
    """licence, digest and the number of words of each canonical form; one row per digest.

    ``texts`` has licence and known, the full text: the known licences, or any table of that form.
    """
    words = texts.select("licence", canonical(F.col("known")).alias("canonical"))
    return (
        words.groupBy(F.sha2("canonical", 256).alias("digest"))
        .agg(F.min("licence").alias("licence"), F.max(F.size(F.split("canonical", " "))).alias("words"))
    )


def find_licences(texts: DataFrame, keys: list[str], text: str, known: DataFrame) -> DataFrame:
    """Rows whose whole text is a known licence: the keys, licence and digest.

    A text that is null, empty or nothing but punctuation and copyright lines is no licence. A known
    text that is two licences' counts as the alphabetically first. Rows are matched one by one, so
    repeated ones appear as often as they occur. Other columns are not read.
    """
    # Spelling changes words one for one, so only a text with as many words as some licence needs it.
    # Known licences are a parameter of the scan: their word counts are a short list.
    sizes = sorted({r.words for r in known.select("words").distinct().collect()})
    rows = texts.select(*keys, folded(F.col(text)).alias("folded"))
    spaces = F.length("folded") - F.length(F.replace(F.col("folded"), F.lit(" ")))
    candidates = rows.where((spaces + 1).isin(sizes)).where(F.col("folded") != "")
    digests = candidates.select(*keys, F.sha2(respelled(F.col("folded")), 256).alias("digest"))
    return digests.join(known.select("digest", "licence"), "digest").select(*keys, "licence", "digest")


def document_licences(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Licences of documents (line is null) and of single lines of them (line counts from 1).

    Returns doc_id, line, licence and digest.
    """
    known = known if known is not None else known_digests(docs.sparkSession)
    lines = F.posexplode(F.split(F.col("text"), "\n"))
    whole = docs.select("doc_id", F.lit(None).cast("int").alias("line"), "text")
    each = docs.select("doc_id", lines.alias("line", "text")).withColumn("line", F.col("line") + 1)
    return find_licences(whole.unionByName(each), ["doc_id", "line"], "text", known)
