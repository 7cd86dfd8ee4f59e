"""Operator 4: licence scan by canonical digest, in DataFrame operations only.

Method: case, punctuation, copyright lines and equivalent spellings are
normalised, and the digest of the entire text is joined to the digests of known
licence texts.  Texts are looked up at two scales: each line of a document, since
notices are mostly lines of a longer text, and the document as a whole.  A full
licence (a known text of several lines) also counts where a longer document holds
its normalised text as a stretch of whole words, however its lines are broken:
a document that has the licence's first words (its anchor) is joined to the licence
on them, and only then compared with it.

Both joins send the known side to all tasks, after a count: beyond
``MOST_DIGESTS`` the digests are joined as Spark sees fit, and full texts, which
are anchors of a plan, may be ``MOST_FULL`` at most.  A document's units stay in its
task; what is grouped afterwards is the matches, by row.

Defined cases: NULL or empty text matches nothing; texts that are empty after
normalising match nothing; each row is a document of its own, so rows that repeat
or lack a doc_id are told apart; very long texts are normalised whole, and line by
line; a line or text known under several licences has them all; an empty table
gives no rows; other columns are ignored.
"""
from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

#: Licence texts as published, a file each, by SPDX name.
FOLDER = Path(__file__).with_name("known_licenses")

# Known notices and licence texts, as published.
KNOWN = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Released under the GNU General Public License version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("proprietary", "All rights reserved."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
)

# Equivalent spellings, after lower-casing.
SPELLINGS = (
    ("licence", "license"), ("sub-license", "sublicense"), ("non-commercial", "noncommercial"),
    ("merchantibility", "merchantability"), ("organisation", "organization"), ("copyright holder's", "copyright holder"),
    ("copyright holders", "copyright holder"),
    ("https:", "http:"),
)
#: Lines that name the holder: (c), © or a year or a placeholder after "copyright".
COPYRIGHT_LINE = r"(?m)^[^\p{L}\n(©]*(?:copyright\s*(?:\(c\)|©|[<\[(]?(?:\d{4}|year|yyyy))|\(c\)\s|©)[^\n]*$"
#: Title lines of the short licences, which are often left out.
TITLE_LINE = (r"(?m)^[^\p{L}\p{N}\n]*(?:the )?(?:mit|isc|x11|zlib|(?:new |modified |simplified |revised )?bsd|bsd zero clause"
              r"|zero-clause bsd|[0-4]-clause bsd|bsd [0-4]-clause)(?: [\"'(]?(?:new|revised|simplified)[\"')]?)? licen[cs]e"
              r"(?: \([^()\n]{1,30}\))?[^\p{L}\p{N}\n]*$")
#: Words of a full text that a document must have to be compared with it.
ANCHOR_WORDS = 8
#: Bounds of what is sent to all tasks: distinct normalised texts, and full ones among them.
MOST_DIGESTS = 100_000
MOST_FULL = 500
#: Numbers of list items, which some copies have as bullets.
ITEM = r"(?m)^[\x20\t]*\d{1,2}[.)]\s"


def canonical(text: Column) -> Column:
    """Normalised text: lower case, holder and title lines and item numbers
    dropped, one spelling, runs of anything but letters and digits as one space."""
    x = F.regexp_replace(F.lower(text), f"{COPYRIGHT_LINE}|{TITLE_LINE}|{ITEM}", "")
    for a, b in SPELLINGS:
        x = F.replace(x, F.lit(a), F.lit(b))
    return F.btrim(F.regexp_replace(x, r"[^\p{L}\p{N}]+", " "))


def known_texts(spark) -> DataFrame:
    """(license, known) of the notices above and the texts of ``known_licenses``."""
    files = sorted(FOLDER.glob("*.txt"))
    return spark.createDataFrame([*KNOWN, *((f.stem, f.read_text(encoding="utf-8")) for f in files)], "license string, known string")


def known_forms(known: DataFrame) -> DataFrame:
    """(license, full, form): the normalised texts; a full one, of several lines, is
    also known without its appendix."""
    body = F.substring_index("canon", " end of terms and conditions", 1)
    return known.select("license", F.contains("known", F.lit("\n")).alias("full"), canonical(F.col("known")).alias("canon")) \
        .where("canon <> ''").withColumn("form", F.explode(F.array_distinct(F.array("canon", body)))) \
        .select("license", (F.col("full") & (F.col("form") == body)).alias("full"), "form").distinct()


def _padded(c: Column) -> Column:
    return F.concat(F.lit(" "), c, F.lit(" "))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per document row: doc_id, licenses (ascending, without
    repeats), n_notices (lines that matched, and licences that the text is or
    holds), whole_license.  ``known`` has license, known, as ``known_texts``."""
    forms = known_forms(known_texts(docs.sparkSession) if known is None else known)
    full = forms.where("full").withColumn("anchor", _padded(F.substring_index("form", " ", ANCHOR_WORDS)))
    anchors = sorted(r.anchor for r in full.select("anchor").distinct().limit(MOST_FULL + 1).collect())
    if len(anchors) > MOST_FULL:
        raise ValueError(f"more than {MOST_FULL} full licence texts")
    digests = forms.groupBy(F.sha2("form", 256).alias("digest")).agg(F.collect_set("license").alias("same"))
    if digests.limit(MOST_DIGESTS + 1).count() <= MOST_DIGESTS:
        digests = F.broadcast(digests)
    held = F.broadcast(full.groupBy("anchor").agg(F.collect_set(F.struct("license", _padded(F.col("form")).alias("form"))).alias("texts")))

    text = F.col("text").cast("string")
    unit = lambda line, c: F.struct(F.lit(line).alias("line"), c.alias("text"))
    whole = F.array(unit(False, F.col("text")))
    lines = F.transform(F.split("text", "\n"), lambda x: unit(True, x))
    units = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text")) \
        .select("row", "doc_id", F.explode(F.when(F.contains("text", F.lit("\n")), F.concat(whole, lines)).otherwise(whole)).alias("u")) \
        .select("row", "doc_id", "u.line", canonical(F.col("u.text")).alias("canon")) \
        .withColumn("canon", F.when(F.col("canon") != "", F.col("canon"))) \
        .select("row", "doc_id", "line", F.sha2("canon", 256).alias("digest"),
                F.when(~F.col("line"), _padded(F.col("canon"))).alias("unit"))
    none = F.array().cast("array<string>")
    hits = F.array_compact(F.array(*[F.when(F.contains("unit", F.lit(a)), F.lit(a)) for a in anchors])) if anchors else none
    found = units.withColumn("anchor", F.explode_outer(hits)).join(digests, "digest", "left").join(held, "anchor", "left") \
        .select("row", "doc_id", "line", F.coalesce("same", none).alias("same"),
                F.coalesce(F.transform(F.filter("texts", lambda t: F.contains(F.col("unit"), t["form"])), lambda t: t["license"]),
                           none).alias("held"))
    of_text = F.when(~F.col("line"), F.array_union("same", "held")).otherwise(none)
    by_row = found.groupBy("row", "doc_id").agg(
        F.flatten(F.collect_set(F.array_union("same", "held"))).alias("all"),
        F.sum(F.when(F.col("line"), F.size("same")).otherwise(0)).alias("n_lines"),
        F.flatten(F.collect_set(of_text)).alias("of_text"),
        F.min(F.when(~F.col("line"), F.array_min("same"))).alias("whole_license"))
    return by_row.select("doc_id", F.array_sort(F.array_distinct("all")).alias("licenses"),
                         (F.col("n_lines") + F.size(F.array_distinct("of_text"))).alias("n_notices"), "whole_license")
