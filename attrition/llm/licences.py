"""Licence scan by canonical digest lookup.

A text is brought to a canonical form: A-Z lower-cased, copyright lines dropped, everything but
a-z and 0-9 turned into single blanks, equivalent spellings unified. Its digest is looked up
among the digests of known licences by a hash join, so a whole text is recognised in any
typesetting and never by resemblance. Each line of a text is looked up the same way among known
one-line notices.

Built from DataFrame functions alone. The known texts are a fixed list, so their side of the
join is broadcast. Only lines of a notice's exact canonical length are digested, which loses none.

Defined results: null and empty text have the digest of the empty form and no licence; repeated
rows each get their row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import documents

# Licence texts.
_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
          "and associated documentation files (the \"Software\"), to deal in the Software without "
          "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
          "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
          "Software is furnished to do so, subject to the following conditions: The above copyright notice "
          "and this permission notice shall be included in all copies or substantial portions of the "
          "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
          "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
          "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
          "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
          "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_DISCLAIMER = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
                   "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL "
                   "THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
                   "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
                   "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
                   "OR PERFORMANCE OF THIS SOFTWARE.")
_BSD_HEAD = ("Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met: 1. Redistributions of source code must retain "
             "the above copyright notice, this list of conditions and the following disclaimer. "
             "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
             "conditions and the following disclaimer in the documentation and/or other materials provided "
             "with the distribution. ")
_BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to "
              "endorse or promote products derived from this software without specific prior written "
              "permission. ")
_BSD_DISCLAIMER = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS "
                   "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
                   "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
                   "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
                   "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
                   "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
                   "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
                   "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
                   "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

TEXTS = [
    ("MIT", _GRANT),
    ("MIT", "MIT License\n" + _GRANT),
    ("ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_DISCLAIMER),
    ("0BSD", _ISC_GRANT + ". " + _ISC_DISCLAIMER),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_DISCLAIMER),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_NAMES + _BSD_DISCLAIMER),
]

# One-line notices.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
]

# A line that only states a copyright, after lower-casing.
COPYRIGHT = (r"^[ \t/*#;.-]*(copyright[ \t]+(\(c\)|©|[0-9]{4}|<year>|\[yyyy\])|(\(c\)|©)[ \t]*(copyright[ \t]*)?[0-9]{4}"
             r"|all rights reserved[. \t]*$)")

# Equivalent spellings in the canonical form, the second one is kept.
SPELLINGS = [
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"), ("copyright owner", "copyright holder"),
    ("organisation", "organization"), ("authorisation", "authorization"), ("favour", "favor"),
    ("behaviour", "behavior"), ("honour", "honor"), ("merchantibility", "merchantability"),
    ("redistribution s", "redistributions"), ("per cent", "percent"),
]

_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _line(line: Column) -> Column:
    """Canonical form of one line that has no capitals; a copyright line becomes empty."""
    plain = F.trim(F.regexp_replace(line, "[^a-z0-9]+", " "))
    return F.when(line.rlike(COPYRIGHT), F.lit("")).otherwise(plain)


def lines(text: Column) -> Column:
    """Non-empty canonical lines, spellings unified within each line."""
    lowered = F.split(F.translate(F.coalesce(text, F.lit("")), *_LOWER), "\n")
    return F.filter(F.transform(lowered, lambda x: spelled(_line(x))), lambda x: x != "")


def spelled(plain: Column) -> Column:
    for seen, kept in SPELLINGS:
        plain = F.replace(plain, F.lit(seen), F.lit(kept))
    return plain


def digest(plain_lines: Column) -> Column:
    """md5 of the whole canonical text; spellings may also join across line ends."""
    return F.md5(spelled(F.array_join(plain_lines, " ")).cast("binary"))


def _table(spark, texts) -> DataFrame:
    """The fixed list as rows (license, text)."""
    rows = [F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in texts]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def known(spark, texts) -> DataFrame:
    """Distinct digests of known texts with their licence."""
    return (_table(spark, texts).select("license", digest(lines(F.col("text"))).alias("digest"))
            .groupBy("digest").agg(F.min("license").alias("license")))


def scan(docs: DataFrame, texts=TEXTS, notices=NOTICES) -> DataFrame:
    """Every document: doc_id, digest, license (of the whole text, else null), notices (sorted
    distinct licences of its notice lines, comma-joined, else null)."""
    spark = docs.sparkSession
    canonical = documents(docs, "doc_id", "text").select("doc_id", lines(F.col("text")).alias("lines"))
    sizes = _table(spark, notices).select(
        F.length(F.array_join(lines(F.col("text")), " ")).alias("n")).distinct().collect()
    sized = [r["n"] for r in sizes] or [-1]
    whole = canonical.select(
        "doc_id", digest(F.col("lines")).alias("digest"),
        F.array_distinct(F.transform(F.filter("lines", lambda x: F.length(x).isin(sized)),
                                     lambda x: F.md5(x.cast("binary")))).alias("marks"))
    texts_known = F.broadcast(known(spark, texts))
    out = whole.join(texts_known, "digest", "left")
    # A document has at most as many marks as there are notices of its lines' lengths; looking
    # them up in the fixed list needs no explode.
    table = {r["digest"]: r["license"] for r in known(spark, notices).collect()}
    found = F.array_sort(F.array_distinct(F.filter(F.transform(
        "marks", lambda m: _lookup(m, table)), lambda x: x.isNotNull())))
    return out.select("doc_id", "digest", "license",
                      F.when(F.size(found) > 0, F.array_join(found, ",")).alias("notices"))


def _lookup(mark: Column, table: dict) -> Column:
    out = F.lit(None).cast("string")
    for key, name in table.items():
        out = F.when(mark == key, F.lit(name)).otherwise(out)
    return out


def _sql_spelled(x: str) -> str:
    for seen, kept in SPELLINGS:
        x = f"replace({x}, '{seen}', '{kept}')"
    return x


def sql(docs: str = "documents") -> str:
    """The same scan in DuckDB SQL."""
    lowered = f"string_split(translate(coalesce(text, ''), '{_LOWER[0]}', '{_LOWER[1]}'), chr(10))"
    pattern = COPYRIGHT.replace("'", "''")
    line = _sql_spelled(f"CASE WHEN regexp_matches(x, '{pattern}') THEN '' "
                        "ELSE trim(regexp_replace(x, '[^a-z0-9]+', ' ', 'g')) END")
    plain = f"list_filter(list_transform({lowered}, lambda x: {line}), lambda x: x <> '')"
    whole = f"md5({_sql_spelled(chr(39).join(['array_to_string(lines, ', ' ', ')']))})"
    values = lambda rows: ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in rows)
    return f"""
WITH known AS (SELECT {whole} AS digest, min(license) AS license FROM
    (SELECT license, {plain} AS lines FROM (VALUES {values(TEXTS)}) t(license, text)) GROUP BY 1),
  notice AS (SELECT {whole} AS digest, min(license) AS license FROM
    (SELECT license, {plain} AS lines FROM (VALUES {values(NOTICES)}) t(license, text)) GROUP BY 1),
  canon AS (SELECT doc_id, {plain} AS lines FROM {docs}),
  numbered AS (SELECT row_number() OVER () AS row, doc_id, lines, {whole} AS digest FROM canon),
  marks AS (SELECT row, string_agg(license, ',' ORDER BY license) AS notices FROM
    (SELECT DISTINCT row, n.license FROM (SELECT row, unnest(lines) AS x FROM numbered) l
     JOIN notice n ON md5(l.x) = n.digest) GROUP BY row)
SELECT doc_id, digest, license, notices
FROM numbered LEFT JOIN known USING (digest) LEFT JOIN marks USING (row)"""
