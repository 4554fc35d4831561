"""Licence scan by canonical digest look-up."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.session import materialize

# Notices and short licences that are looked up, as published.
MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy
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
SOFTWARE."""
ISC_BODY = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
KNOWN = [
    ("MIT", MIT_BODY),
    ("MIT", "MIT License\n\n" + MIT_BODY),
    ("MIT", "The MIT License (MIT)\n\n" + MIT_BODY),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", ISC_BODY),
    ("ISC", "ISC License\n\n" + ISC_BODY),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
]
#: Full texts as published, by name, in a folder beside this module.
TEXTS = {f.stem: f.read_text("utf-8")
         for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
#: Where the terms end and the advice to users of the licence begins.
ADVICE = re.compile(r"\n *(?:APPENDIX: How to apply|(?:How to Apply|Appendix: How to Apply) )", re.I)
APACHE_HEADER = TEXTS["Apache-2.0"][TEXTS["Apache-2.0"].rindex("Licensed under"):]
TITLES = {"BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License"}


def _forms(name: str, text: str) -> list[str]:
    """The text with and without the advice at its end; of short ones with points for numbers and
    with a title."""
    out = [text]
    if ADVICE.search(text):
        out.append(text[:ADVICE.search(text).start()])
    if name in TITLES:
        out.append(re.sub(r"(?m)^ *[0-9]\.", "*", text))
        out += [t.replace("COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR") for t in out]
        out += [f"{TITLES[name]}\n\n{t}" for t in out]
    return out


KNOWN += [(name, form) for name, text in TEXTS.items() for form in _forms(name, text)]
KNOWN.append(("Apache-2.0", APACHE_HEADER))
# Spellings that count as the same, applied in this order.
SPELLINGS = [
    ("licence", "license"), ("licencing", "licensing"), ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorise", "authorize"), ("calibre", "caliber"),
    ("catalogue", "catalog"), ("centre", "center"), ("emphasise", "emphasize"),
    ("favour", "favor"), ("fulfilment", "fulfillment"), ("initialise", "initialize"),
    ("judgement", "judgment"), ("labelling", "labeling"), ("organisation", "organization"),
    ("organise", "organize"), ("programme", "program"), ("recognise", "recognize"),
    ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
    ("non infringement", "noninfringement"), ("sub license", "sublicense"),
]
#: A line that only says whose the text is; it begins with the mark and a year, name or sign.
COPYRIGHT_LINE = (r"(?m)^[^\p{L}\p{N}\n©(]*(?:copyright[ \t]*(?:\(c\)|©|[0-9])|\(c\)[ \t]*(?:copyright|[0-9])"
                  r"|©|all rights reserved)[^\n]*$")
#: The same by a name or a blank to fill in, before case is made alike: prose goes on in lower case.
NAMED_LINE = (
    r"(?m)^[^\p{L}\p{N}\n©(]*(?:(?i:copyright)(?:[ \t]*[:,]?[ \t]*[\[<{]|[ \t]*:[ \t]*[\p{Lu}0-9]"
    r"|[ \t]+(?!(?i:notices?|holders?|owners?|and|or|laws?|licen[cs]es?|treaty|statements?|interests?|"
    r"rights?|permissions?|in|is|on|of|to|the|protection|ownership|disclaimers?|by law)\b)"
    r"(?:\p{Lu}|[^\n]*\b(?:19|20)[0-9]{2}\b))|(?i:\(c\))[ \t]+[^\n]*\b(?:19|20)[0-9]{2}\b)[^\n]*$")
NOT_WORD = r"[^\p{L}\p{N}\n]+"


def canonical_lines(text: Column) -> Column:
    """The text with case, punctuation, copyright lines and spellings made alike; lines remain."""
    out = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), NAMED_LINE, ""))
    out = F.regexp_replace(out, COPYRIGHT_LINE, "")
    out = F.regexp_replace(out, NOT_WORD, " ")
    for said, meant in SPELLINGS:
        out = F.replace(out, F.lit(said), F.lit(meant))
    return out


def canonical(lines: Column) -> Column:
    """One line of single-spaced words, from :func:`canonical_lines`."""
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def known_digests(spark: SparkSession, known=None) -> DataFrame:
    """``digest, license`` of the looked-up texts, one row per digest; as large as the list given."""
    rows = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(text).alias("text"))
                     for name, text in (KNOWN if known is None else known)])
    return (spark.range(1).select(F.inline(rows))
            .select(F.sha2(canonical(canonical_lines(F.col("text"))), 256).alias("digest"),
                    "license")
            .groupBy("digest").agg(F.min("license").alias("license")))


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 known=None) -> DataFrame:
    """Per row: id, ``digest`` of the canonical whole text, ``whole_license`` (null if the text is
    no known one), ``n_notices`` and ``licenses`` (sorted names, comma between) of single lines
    whose whole text is a known one.

    Null texts are empty texts; a text without a word has the digest of the empty text and matches
    nothing. Every row gives one row, repeated ones too; null ids stay null. Other columns are not
    read. The known table is a list in this module (or ``known``, pairs of name and text), so its
    size is that of the code and both look-ups are hash joins with a broadcast side.
    """
    lines = F.array_distinct(F.filter(
        F.transform(F.split("_lines", "\n"), lambda x: F.trim(x)), lambda x: x != ""))
    rows = materialize(
        df.select(F.monotonically_increasing_id().alias("_uid"), F.col(id_col).alias("_id"),
                  canonical_lines(F.col(text_col)).alias("_lines"))
        .select("_uid", "_id", F.sha2(canonical(F.col("_lines")), 256).alias("digest"),
                F.transform(lines, lambda x: F.sha2(x, 256)).alias("_each")), "licenses")
    table = F.broadcast(known_digests(df.sparkSession, known).where(
        F.col("digest") != F.sha2(F.lit(""), 256)))
    found = (
        rows.select("_uid", F.explode("_each").alias("digest")).join(table, "digest")
        .groupBy("_uid").agg(F.count("*").alias("n_notices"),
                             F.concat_ws(",", F.array_sort(F.collect_set("license"))).alias(
                                 "licenses")))
    return (
        rows.select("_uid", "_id", "digest").join(table, "digest", "left").join(
            found, "_uid", "left")
        .select(F.col("_id").alias(id_col), "digest", F.col("license").alias("whole_license"),
                F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
                F.coalesce("licenses", F.lit("")).alias("licenses")))
