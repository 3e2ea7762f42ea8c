"""Licence lookup by canonical digest of entire texts.

A text is brought to a canonical form (lower case, copyright lines removed, punctuation to spaces, equivalent
spellings unified, white space collapsed), and its digest is joined with the digests of known licences. Everything runs as
SQL functions; the registry is an ordinary table (``known_licenses``, or any frame with ``license_id`` and ``text``).

The form doesn't depend on where lines are wrapped, unless refilling a paragraph joins a copyright line with other text.

Null and empty texts, and texts that are empty once canonical, match nothing. If several licences of the registry have the
same canonical form, the smallest ``license_id`` is given, so there is one result row per row. Extra columns are not read.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Spellings that count as the same.
EQUIVALENT = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("behaviour", "behavior"),
    ("favour", "favor"),
    ("fulfilment", "fulfillment"),
    ("judgement", "judgment"),
    ("merchantibility", "merchantability"),
    ("noncommercial", "non commercial"),
    ("organisation", "organization"),
    ("https", "http"),
)

# Texts of known licences and of one-line notices.
KNOWN = {
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"
        " INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY"
        " SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR"
        " PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION"
        " WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
        " to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above"
        " copyright notice and this permission notice shall be included in all copies or substantial portions of the"
        " Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT"
        " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT"
        " SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION"
        " OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
        " DEALINGS IN THE SOFTWARE."
    ),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "MIT-notice": "Released under the MIT License.",
}

# whole texts, one file a licence
KNOWN |= {p.stem: p.read_text(encoding="utf-8") for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}

# Title lines that files have above a text without one; such a form has its own id, ending in -titled.
TITLES = {
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License"),
    "ISC": ("ISC License", "The ISC License"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "Zlib": ("zlib License", "The zlib/libpng License"),
}
KNOWN |= {
    f"{name}-titled" + (f"-{i}" if i else ""): f"{title}\n\n{KNOWN[name]}"
    for name, titles in TITLES.items() for i, title in enumerate(titles)
}

# a whole line that begins with "copyright" and has a sign, a year or a place for one, or begins with a sign and has a year;
# a sentence that a line break has put "copyright" or "(c)" at the head of is none
COPYRIGHT_LINE = (
    r"(?m)^[ \t#*/;-]*(?:copyright\b[^\n]*(?:\(c\)|©|[0-9]{4}|<year>|\[yyyy\])[^\n]*|(?:\(c\)|©)[^\n]*[0-9]{4}[^\n]*|all rights reserved\.?[ \t]*)$"
)


def canonical(text: Column) -> Column:
    form = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, " ")
    # two spaces between words, so that each of two spellings side by side has its own on either side
    form = F.regexp_replace(form, r"[^\p{L}\p{N}]+", "  ")
    form = F.concat(F.lit("  "), form, F.lit("  "))
    for other, usual in EQUIVALENT:
        form = F.replace(form, F.lit(f" {other} "), F.lit(f" {usual.replace(' ', '  ')} "))
    return F.trim(F.regexp_replace(form, " +", " "))


def known_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(KNOWN.items()), "license_id string, text string")


def scan_licenses(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, ``canonical_sha256`` (null without canonical text), ``license_id`` (null if unknown)."""
    form = F.nullif(canonical(F.col(text)), F.lit(""))
    rows = docs.select(F.col(doc_id), F.sha2(form, 256).alias("canonical_sha256"))
    registry = known.select(F.sha2(F.nullif(canonical(F.col("text")), F.lit("")), 256).alias("canonical_sha256"), "license_id")
    registry = registry.filter("canonical_sha256 IS NOT NULL").groupBy("canonical_sha256").agg(F.min("license_id").alias("license_id"))
    return rows.join(registry, "canonical_sha256", "left").select(doc_id, "canonical_sha256", "license_id")
