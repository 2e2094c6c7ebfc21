"""Licence scan by canonical digest.

A text is brought to one canonical form: lower case, copyright lines dropped, equivalent spellings made one, and all
runs of anything but letters and digits of ASCII turned into single spaces. Its MD5 is looked up among the digests of
known licence texts. Whole documents are looked up, and so is each of their lines, because notices such as "Released
under the MIT License." stand as lines within other text.

Null and empty texts match nothing. Repeated lines of a document count once per licence. Rows that repeat a document
are reported each. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that mean the same, as (pattern, replacement) on lower-case text.
SPELLINGS = (
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("v([0-9])", "version $1"),
    ("merchantibility", "merchantability"), ("http:", "https:"),
)
# Public notices and short licences, one name for each.
KNOWN = (
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS
IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""),
)
BROADCAST_DIGESTS = 100_000  # known texts that may be broadcast, about 5 MB
COPYRIGHT_LINE = r"(^|\n)[\x20\t]*(copyright[\x20\t]*(\(c\)|©|[0-9])|\(c\)|©|all rights reserved)[^\n]*"


def canonical_lines(text: Column) -> Column:
    """The canonical form of every line of a text; a dropped line is empty. One pass of each pattern serves all units of a text."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "$1")
    for pattern, replacement in SPELLINGS:
        out = F.regexp_replace(out, pattern, replacement)
    return F.transform(F.split(F.regexp_replace(out, "[^a-z0-9\n]+", " "), "\n", -1), lambda line: F.trim(line))


def joined(lines: Column) -> Column:
    """The canonical form of the text that has these lines."""
    return F.array_join(F.filter(lines, lambda line: line != ""), " ")


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """``license`` and ``digest`` of every known text."""
    rows = spark.createDataFrame(list(known), "license string, body string")
    return rows.select("license", F.md5(joined(canonical_lines(F.col("body"))).cast("binary")).alias("digest")).dropDuplicates(["digest"])


def scan(df: DataFrame, key: str, text: str, known: DataFrame) -> DataFrame:
    """One row per matching unit: key, ``scope`` (``text`` or ``line``), ``line_no`` from 1 (0: whole text), ``license``.

    Texts aren't shuffled: units become digests within the scan and meet the digests of ``known``, which are broadcast if they
    are few, and otherwise joined as the planner sees fit.
    """
    named = df.select(F.col(key).alias("key"), canonical_lines(F.col(text)).alias("lines"))
    whole, single = F.array(joined(F.col("lines"))), F.array().cast("array<string>")
    units = named.select("key", F.posexplode(F.concat(whole, F.when(F.size("lines") > 1, F.col("lines")).otherwise(single))).alias("line_no", "unit"))
    hashed = units.filter("unit <> ''").select("key", "line_no", F.md5(F.col("unit").cast("binary")).alias("digest"))
    scope = F.when(F.col("line_no") == 0, "text").otherwise("line")
    if known.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS:
        known = F.broadcast(known)
    return hashed.join(known, "digest").select(F.col("key").alias(key), scope.alias("scope"), "line_no", "license")
