"""Known licence statements and texts in documents, by digests of their canonical form.

A text and each of its lines is brought to a canonical form: lower case, equivalent
spellings made one, copyright lines dropped, every run of other characters than letters
and digits one space. What is left is hashed as a whole and joined with the digests of the known
texts in the same form. A run of lines that begins like a known text is cut to the length of that
text and hashed as well, so a text matches however it is wrapped and whatever stands before
and after it. Only lines, runs of whole lines and documents that are a known text from its first to its
last word match. All of it is DataFrame expressions.

Known are the statements below and the whole texts in ``licence_texts``, one file for each SPDX
name, with and without their heading and what follows their terms.

A null, empty or blank text matches nothing. Rows are matched one by one, repeated ones
too, and a null doc_id is kept. Other columns are ignored. An empty table, or an empty table of
known texts, gives an empty result.
"""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Spellings that count as one, as patterns for words in lower case.
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("copyright owner", "copyright holder"),
    ("version 2 0", "version 2"),
    ("version 3 0", "version 3"),
    ("v2", "version 2"),
    ("v3", "version 3"),
    ("https", "http"),
)

# Public licence texts and the statements by which texts refer to a licence.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
KNOWN = (
    ("MIT", MIT),
    ("MIT", "MIT License\n" + MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", ISC),
    ("ISC", "ISC License\n" + ISC),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
)

# Where the terms of the whole texts begin and end; headings carry years, names and old addresses.
BEGINS = r"^[ \t]*(Everyone is permitted to copy|Redistribution and use|Permission is hereby|This software is provided|By exercising the Licensed Rights)"
ENDS = r"^[ \t]*END OF TERMS AND CONDITIONS[ \t]*$"
MARKERS = r"(?m)^[ \t]*(?:[0-9]+\.|[*-])(?=[ \t])"
HEAD = 24  # characters by which a run of lines is found to begin like a known text

COPYRIGHT_LINE = r"^[^a-z0-9]*(copyright|\(c\)|©)([^a-z]|\(c\))*[0-9].*$|^[^a-z0-9]*all rights reserved[^a-z0-9]*$"


def canonical_line(line: Column) -> Column:
    """Words of a line in canonical form, each after one space; empty for a copyright line."""
    low = F.lower(line)
    kept = F.when(F.regexp_like(low, F.lit(COPYRIGHT_LINE)), F.lit("")).otherwise(low)
    words = F.concat(F.lit(" "), F.trim(F.regexp_replace(kept, "[^a-z0-9]+", " ")), F.lit(" "))
    for other, one in SPELLINGS:
        words = F.replace(words, F.lit(f" {other} "), F.lit(f" {one} "))
    return F.trim(words)


def canonical_lines(text: Column) -> Column:
    """The lines with words, in canonical form."""
    return F.filter(F.transform(F.split(text, "\r\n|\r|\n"), canonical_line), lambda w: w != "")


def _across(lines: Column) -> Column:
    """Lines in canonical form with the spellings of several words made one across their ends, too."""
    text = F.array_join(lines, "\n")
    for other, one in SPELLINGS:
        if " " in other:
            first, second, *third = other.split(" ")
            pattern = rf"(?<![^ \n]){first}([ \n]){second}{''.join(rf'[ \n]{w}' for w in third)}(?![^ \n])"
            text = F.regexp_replace(text, pattern, one.replace(" ", "$1"))
    return F.split(text, "\n")


def whole_texts() -> list[tuple[str, str]]:
    """Name and text of the licences in ``licence_texts``, in each of their forms."""
    found = []
    for file in sorted(resources.files(__package__).joinpath("licence_texts").iterdir(), key=lambda f: f.name):
        if not file.name.endswith(".txt"):
            continue
        text = file.read_text(encoding="utf-8")
        begin, end = re.search(BEGINS, text, re.M), re.search(ENDS, text, re.M)
        for at in {0, begin.start() if begin else 0}:
            for to in {len(text), *((end.start(), end.end()) if end else ())}:
                found.append((file.name.removesuffix(".txt"), text[at:to]))
        if file.name.startswith("BSD-"):  # its conditions are as often bulleted as numbered
            found.append((file.name.removesuffix(".txt"), re.sub(MARKERS, "", text[begin.start() :])))
    return found


def known_digests(spark: SparkSession, known=None) -> DataFrame:
    """licence, digests, head and lengths of the known texts: a fixed, small table."""
    if known is None:
        known = [*KNOWN, *whole_texts()]
    rows = spark.createDataFrame(list(known), "licence string, text string")
    whole = F.array_join(canonical_lines(F.col("text")), " ")
    return (
        rows.select("licence", whole.alias("words"))
        .where("words != ''")
        .withColumn("run", F.array_join(_across(F.array("words")), " "))
        .select(
            "licence",
            F.sha2("words", 256).alias("digest"),
            F.sha2("run", 256).alias("run_digest"),
            F.substring("run", 1, HEAD).alias("head"),
            F.length("run").alias("size"),
            F.size(F.split("run", " ")).alias("n_words"),
        )
        .distinct()
    )


def _runs(lines: Column, known: Column) -> Column:
    """Licence and last line of each run of two or more lines that is a known text."""
    first_word = lambda w: F.substring_index(w, " ", 1)
    likely = F.filter(
        F.transform(
            lines, lambda w, i: F.when(F.array_contains(known["firsts"], first_word(w)), i).otherwise(F.lit(-1))
        ),
        lambda i: i >= 0,
    )
    # a line has a letter or digit at least, and one space follows it
    head = lambda i: F.substring(F.array_join(F.slice(lines, i + 1, F.lit(HEAD // 2)), " "), 1, HEAD)
    begins = F.filter(likely, lambda i: F.array_contains(known["heads"], head(i)))

    def ends(run: Column, size: Column) -> Column:
        """The number of lines whose words have this length together, or 0."""
        start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"), F.lit(0).alias("hit"))

        def step(s: Column, w: Column) -> Column:
            to = s["at"] + F.length(w)
            return F.struct(
                (to + 1).alias("at"),
                (s["n"] + 1).alias("n"),
                F.when(to == size, s["n"] + 1).otherwise(s["hit"]).alias("hit"),
            )

        return F.aggregate(run, start, step, lambda s: s["hit"])

    def hits(i: Column, run: Column, words: Column) -> Column:
        same = F.filter(
            known["texts"],
            lambda k: (k["head"] == F.substring(words, 1, HEAD))
            & (k["run_digest"] == F.sha2(F.substring(words, F.lit(1), k["size"]), 256)),
        )
        placed = F.transform(same, lambda k: F.struct(k["licence"].alias("licence"), ends(run, k["size"]).alias("n")))
        return F.transform(
            F.filter(placed, lambda p: p["n"] > 1), lambda p: F.struct(p["licence"], (p["n"] + i).alias("last"))
        )

    # each value is worked out once by a function over an array of one element
    def at(i: Column) -> Column:
        run = F.array(F.slice(lines, i + 1, known["longest"]))
        return F.flatten(
            F.transform(run, lambda r: F.get(F.transform(F.array(F.array_join(r, " ")), lambda w: hits(i, r, w)), F.lit(0)))
        )

    return F.array_distinct(F.flatten(F.transform(begins, at)))


def find_licences(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, licence, the number of places that state it, and whether it is the whole text.

    A place (``n_lines``) is a line or, within a text that is not the licence as a whole, a run of lines.
    """
    lines = docs.select(F.col("doc_id").cast("bigint"), canonical_lines(F.col("text")).alias("lines"))
    texts = known.agg(
        F.collect_list(F.struct("licence", "digest", "run_digest", "head", "size")).alias("texts"),
        F.collect_set("head").alias("heads"),
        F.collect_set(F.substring_index("head", " ", 1)).alias("firsts"),
        F.coalesce(F.max("n_words"), F.lit(0)).alias("longest"),
    ).select(F.struct("*").alias("known"))
    whole = F.sha2(F.array_join("lines", " "), 256)
    likely = F.exists("lines", lambda w: F.array_contains("known.firsts", F.substring_index(w, " ", 1)))
    run_lines = F.when(likely, _across(F.col("lines"))).otherwise(F.array().cast("array<string>"))
    none = F.lit(None).cast("string")
    # a row of all known texts, a fixed table, beside each document
    found = (
        lines.where(F.size("lines") > 0)
        .crossJoin(F.broadcast(texts))
        .select("doc_id", "lines", "known", whole.alias("whole"), run_lines.alias("run_lines"))
        .withColumn("runs", _runs(F.col("run_lines"), F.col("known")))
    )
    own = lambda r: F.exists(
        "known.texts", lambda k: (k["licence"] == r["licence"]) & (k["digest"] == F.col("whole"))
    )
    # each line, the whole text, and the runs of lines as units of their own
    unit = lambda digest, line, licence: F.struct(
        digest.alias("digest"), F.lit(line).alias("line"), licence.alias("stated")
    )
    units = F.concat(
        F.transform("lines", lambda w: unit(F.sha2(w, 256), 1, none)),
        F.array(unit(F.col("whole"), 0, none)),
        F.transform(F.filter("runs", lambda r: ~own(r)), lambda r: unit(none, 2, r["licence"])),
    )
    single = found.select("doc_id", F.inline(units))
    small = F.broadcast(known.select("digest", "licence"))  # a fixed table of a few rows
    return (
        single.join(small, "digest", "left")
        .withColumn("licence", F.coalesce("licence", "stated"))
        .where("licence IS NOT NULL")
        .groupBy("doc_id", "licence")
        .agg(
            F.count_if(F.col("line") > 0).alias("n_lines"),
            (F.min("line") == 0).alias("whole_text"),
        )
    )
