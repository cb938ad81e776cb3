"""Licence scans by canonical digests, from DataFrame functions only.

A text is normalised: case, punctuation, white space, copyright lines and equivalent spellings go, so that the many printed forms of a licence
become one.  The SHA-256 digest of the result is joined with the digests of known licences.  Whole texts are looked up, and every line as a
text of its own (a notice).  Only digests are shuffled; the known digests are few, and their table is left to Spark to broadcast
by its measured size.  A line in a third of all texts is counted before the exchange.

Defined results: a null or empty text has no digest and no licence; a text that is nothing but copyright lines neither; repeated rows are
looked up each for itself; with several names for one digest the first by name holds.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homelake.functions import bound
from homelake.llm.common import table
from homelake.session import cut_lineage

# Equivalent spellings, applied in this order to lower-cased words between single spaces.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense", "analogue": "analog", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "behaviour": "behavior", "centre": "center", "defence": "defense",
    "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "judgement": "judgment", "labelled": "labeled", "labour": "labor",
    "modelled": "modeled", "organisation": "organization", "organisations": "organizations", "organise": "organize", "practise": "practice",
    "programme": "program", "recognise": "recognize", "utilisation": "utilization", "whilst": "while", "wilful": "willful", "noncommercial": "non commercial",
    "copyright owner": "copyright holder", "per cent": "percent", "web site": "website", "sub license": "sublicense",
}

# Notices and short licences as published.
NOTICES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License");',
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License, version 3.",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0.", "Released under CC BY-NC 4.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."],
}
LICENSES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the"
        ' "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,'
        " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject"
        " to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial"
        ' portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT'
        " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
        " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING"
        " FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the"
        ' above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL'
        " WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE"
        " LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,"
        " WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF"
        " THIS SOFTWARE."
    ),
}


# Title lines that a licence file may begin with.
TITLES = {"MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"], "ISC": ["ISC License", "The ISC License"]}
# Every built-in notice and licence holds one of these word beginnings, so other lines need no look-up in the built-in list.
HINT = r"(?i)licen[cs]|permission|copyright"
# A line that begins with a mark, a year or a holder; a licence's own words on copyright stay.
_COPYRIGHT_LINE = (
    r"(?:^|\n)[ \t*#/;%-]*+"
    r"(?:[cC][oO][pP][yY][rR][iI][gG][hH][tT][ \t]*(?:\([cC]\)|©|[0-9]{4}|[bB][yY] )|\([cC]\)|©|[aA]ll [rR]ights [rR]eserved)[^\n]*"
)


def canonical(text: Column) -> Column:
    """Lower-case words between single spaces, without copyright lines and in one spelling."""
    lines = F.regexp_replace(text, _COPYRIGHT_LINE, "\n")
    words = F.trim(F.regexp_replace(F.lower(lines), r"[^\p{L}\p{N}]+", " "))
    out = F.concat(F.lit(" "), words, F.lit(" "))
    for spelling, usual in SPELLINGS.items():
        out = F.replace(out, F.lit(f" {spelling} "), F.lit(f" {usual} "))
    return F.trim(out)


def digest(text: Column) -> Column:
    """SHA-256 of the canonical text; null if nothing is left."""
    return bound(canonical(text), lambda plain: F.when(plain != "", F.sha2(plain, 256)))


# A first line that names the licence, with an empty line after it.
_TITLE = r"(?i)^\s*[^\n]{0,80}licen[cs]e[^\n]{0,80}\n\s*\n"


def known_texts() -> list[tuple[str, str]]:
    """(license, text) of the built-in notices and licences; licences with and without a title line.

    Besides the texts above, ``texts`` next to this module holds one published licence per file, named by its short identifier.
    """
    whole = list(LICENSES.items()) + [(name, f"{title}\n\n{LICENSES[name]}") for name, titles in TITLES.items() for title in titles]
    whole += [(path.stem, path.read_text(encoding="utf-8")) for path in sorted(Path(__file__).with_name("texts").glob("*.txt"))]
    untitled = [(name, re.sub(_TITLE, "", text, count=1)) for name, text in whole if re.match(_TITLE, text)]
    return [(name, text) for name, texts in NOTICES.items() for text in texts] + whole + untitled


def known_licenses(spark: SparkSession, texts: list[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """(digest, license) of known (license, text) rows, each text with and without its title line; a DataFrame may hold any number."""
    known = texts if isinstance(texts, DataFrame) else spark.createDataFrame(known_texts() if texts is None else texts, "license string, text string")
    untitled = F.when(F.col("text").rlike(_TITLE), F.regexp_replace("text", _TITLE, ""))
    every = known.select("license", F.explode(F.array("text", untitled)).alias("text")).select("license", digest(F.col("text")).alias("digest"))
    return cut_lineage(every.where("digest is not null").groupBy("digest").agg(F.min("license").alias("license")))


def scan_licenses(docs: DataFrame, known: DataFrame, text: str = "text", hint: str | None = None) -> DataFrame:
    """``docs`` without the text, with digest and license of the whole text and notices (distinct licences of its lines, sorted).

    ``hint`` is a pattern that every text behind ``known`` holds; lines without it are not looked up.
    """
    kept = [name for name in docs.columns if name not in (text, "digest", "license", "notices")]
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    if hint is not None:
        lines = F.filter(lines, lambda line: line.rlike(hint))
    scanned = cut_lineage(docs.select(
        F.monotonically_increasing_id().alias("__row"), *kept, digest(F.col(text)).alias("digest"),
        F.transform(lines, digest).alias("__lines")))
    found = scanned.select("__row", F.explode("__lines").alias("digest")).join(known, "digest")
    notices = found.groupBy("__row").agg(F.sort_array(F.collect_set("license")).alias("notices"))
    return (
        scanned.drop("__lines").join(known, "digest", "left").join(notices, "__row", "left")
        .withColumn("notices", F.coalesce("notices", F.array().cast("array<string>"))).select(*kept, "digest", "license", "notices")
    )


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), known_licenses(spark), hint=HINT)
    return found.select("doc_id", "digest", "license", F.array_join("notices", ",").alias("notices"))


def _sql_digest(text: str) -> str:
    quote = lambda value: "'" + value.replace("'", "''") + "'"
    lines = f"regexp_replace({text}, {quote(_COPYRIGHT_LINE.replace('*+', '*'))}, chr(10), 'g')"
    out = f"' ' || trim(regexp_replace(lower({lines}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' '"
    for spelling, usual in SPELLINGS.items():
        out = f"replace({out}, {quote(f' {spelling} ')}, {quote(f' {usual} ')})"
    return f"(CASE WHEN trim({out}) <> '' THEN sha256(trim({out})) END)"


def oracle() -> str:
    """DuckDB SQL with the same rows as :func:`op6_licenses`."""
    quote = lambda value: "'" + value.replace("'", "''") + "'"
    values = ", ".join(f"({quote(name)}, {quote(text)})" for name, text in known_texts())
    return f"""
WITH known AS (
  SELECT {_sql_digest("t")} AS digest, min(l) AS license FROM (VALUES {values}) AS v(l, t) GROUP BY 1),
docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
lines AS (SELECT rid, line FROM docs, unnest(string_split(text, chr(10))) AS u(line) WHERE regexp_matches(line, '{HINT}')),
notices AS (
  SELECT rid, string_agg(license, ',' ORDER BY license) AS notices
  FROM (SELECT DISTINCT rid, license FROM lines JOIN known ON known.digest = {_sql_digest("line")}) GROUP BY rid),
whole AS (SELECT rid, doc_id, {_sql_digest("text")} AS digest FROM docs)
SELECT doc_id, whole.digest, license, coalesce(notices, '') AS notices
FROM whole LEFT JOIN known ON known.digest = whole.digest LEFT JOIN notices USING (rid)
"""
