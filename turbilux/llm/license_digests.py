"""Licence scan by canonical digests; DataFrame operations only.

Whole texts, and each of their lines, are brought to a canonical form and joined by SHA-256 with the known licence texts and
notices in the same form.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Licence identifiers with texts and notices as published.
KNOWN_TEXTS = (
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
)

# whole texts as published, read by the driver: one file for each licence, named by its identifier
FOLDER = Path(__file__).resolve().parent / "licenses"
# headings with which a text is often published
TITLES = {
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "BSD License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "Unlicense": ("The Unlicense", "Unlicense"),
}
# where the appendix on how to apply the licence begins; files often end before it
APPENDIX = (
    "   APPENDIX: How to apply the Apache License",
    "            How to Apply These Terms to Your New Programs",
    "           How to Apply These Terms to Your New Libraries",
    "Exhibit A - Source Code Form License Notice",
)


def full_texts() -> tuple[tuple[str, str], ...]:
    """Licence identifiers with whole texts: each alone, under its headings, and without its appendix."""
    bodies = [(p.stem, p.read_text(encoding="utf-8")) for p in sorted(FOLDER.glob("*.txt"))]
    bodies += [(i, t) for i, t in KNOWN_TEXTS if "\n" in t]
    bodies += [(i, t[: t.index(a)]) for i, t in bodies for a in APPENDIX if a in t]
    return tuple(bodies) + tuple((i, f"{title}\n{t}") for i, t in bodies for title in TITLES.get(i, ()))


# Spellings that mean the same, applied to lower-case text in this order.
SPELLINGS = (
    ("licenc", "licens"),
    ("sub-licens", "sublicens"),
    ("non-commercial", "noncommercial"),
    ("non-infring", "noninfring"),
    ("merchantibility", "merchantability"),
    ("creative commons attribution", "cc by"),
    ("gnu gpl", "gnu general public license"),
    ("https:", "http:"),
)
# lines that name a holder and a year, not terms; a line of the terms may begin with "copyright" or "(c)" when it is wrapped
HOLDER = r"(copyright\b[^\n]*(\(c\)|©|[12][0-9]{3})|(\(c\)|©)[^\n]*[12][0-9]{3}|all rights reserved)[^\n]*$"
COPYRIGHT_LINE = r"(?m)^[ \t]*" + HOLDER
# the same lines behind the mark of a comment
COMMENTED_COPYRIGHT_LINE = r"(?mi)^[ \t]*(#+|//+|/?\*+|;+|--+)[ \t]*" + HOLDER
VERSION_MARK = r"\b(version|ver\.|v) ?([0-9])"
NO_WORD = r"[^\p{L}\p{N}\n]+"
LINE_EDGE = r"(?m)^ | $"


def canonical(text: Column) -> Column:
    """Lower case without copyright lines and punctuation, one spelling of equivalent words, line by line."""
    text = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    for old, new in SPELLINGS:
        text = F.replace(text, F.lit(old), F.lit(new))
    text = F.regexp_replace(text, VERSION_MARK, "version $2")
    return F.regexp_replace(F.regexp_replace(text, NO_WORD, " "), LINE_EDGE, "")


def one_line(text: Column) -> Column:
    """The canonical lines of a text as one, empty lines left out."""
    return F.trim(F.regexp_replace(text, "[ \n]+", " "))


def known_digests(spark: SparkSession, texts=None) -> DataFrame:
    """digest, license_id of the known texts and notices: as many rows as the fixed list, whatever the input."""
    texts = KNOWN_TEXTS + full_texts() if texts is None else texts
    rows = spark.createDataFrame(list(texts), "license_id string, text string")
    return rows.select(F.sha2(one_line(canonical(F.col("text"))).cast("binary"), 256).alias("digest"), "license_id").distinct()


def scan_licenses(docs: DataFrame, texts=None) -> DataFrame:
    """One row per document: doc_id, text_digest, license_id, line_licenses, n_license_lines.

    license_id is the licence that the entire text is (null if none), copyright lines, also commented ones, left out; line_licenses lists, sorted and comma-joined, the licences
    of which a line is the entire text or notice, and n_license_lines counts these lines.  ``docs`` needs doc_id and text; other
    columns are ignored.  A null text counts as empty, an empty text has a digest but no licence; rows that repeat a doc_id with
    the same text give one row each with the same findings.
    """
    known = F.broadcast(known_digests(docs.sparkSession, texts))
    rows = docs.select(
        "doc_id",
        F.xxhash64("doc_id", "text").alias("row_key"),
        canonical(F.col("text")).alias("lines"),
        # only texts with such lines are brought to canonical form again
        F.when(
            F.col("text").rlike(COMMENTED_COPYRIGHT_LINE), canonical(F.regexp_replace("text", COMMENTED_COPYRIGHT_LINE, ""))
        ).alias("uncommented"),
    )
    whole = rows.select(
        "doc_id",
        "row_key",
        "lines",
        F.sha2(one_line(F.col("lines")).cast("binary"), 256).alias("text_digest"),
        F.sha2(one_line(F.col("uncommented")).cast("binary"), 256).alias("uncommented_digest"),
    )
    lines = F.transform(F.split("lines", "\n"), lambda x: F.sha2(x.cast("binary"), 256))
    units = whole.select(
        "doc_id", "row_key", "text_digest", F.posexplode(F.concat(F.array("text_digest", "uncommented_digest"), lines)).alias("unit", "digest")
    )
    matched = units.join(known, "digest", "left")
    in_line = F.when(F.col("unit") > 1, F.col("license_id"))
    found = matched.groupBy("doc_id", "row_key", "text_digest").agg(
        F.sum((F.col("unit") == 0).cast("long")).alias("copies"),
        F.first(F.when(F.col("unit") <= 1, F.col("license_id")), ignorenulls=True).alias("license_id"),
        F.array_join(F.array_sort(F.collect_set(in_line)), ",").alias("line_licenses"),
        F.count(in_line).alias("lines_of_copies"),
    )
    return found.select(
        "doc_id",
        "text_digest",
        "license_id",
        "line_licenses",
        F.expr("lines_of_copies div copies").alias("n_license_lines"),
        F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")
