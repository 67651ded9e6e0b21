"""Licence scans by canonical digest.

A text is canonical when case, punctuation, copyright lines and equivalent spellings no
longer tell texts apart; its SHA-256 is then looked up by a hash join among the digests
of known licence texts, treated the same. Looked up are the entire text of a document
and each of its lines, so that a notice appended to prose is found too.

A copyright line is one that begins with a copyright mark or reserves all rights; it
counts as empty. Line breaks only separate words, so wrapping does not matter to the
digest of an entire text. A null text counts as empty, and the empty text is no licence.
Every row, repeated ones too, gives one row. A text known under two names gives both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.llm.common import sized, stored

# Notices and short licence texts by their usual identifiers.
KNOWN = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Apache License, Version 2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "MIT License",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
        OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
        "SPDX-License-Identifier: MIT",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under CC BY-NC 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0"),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "ISC": (
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
        IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE.""",
        "SPDX-License-Identifier: ISC",
    ),
    "MPL-2.0": (
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
        "SPDX-License-Identifier: MPL-2.0",
    ),
}

# Spellings that count as one, replaced in this order in canonical text.
SPELLINGS = (
    (r"\blicence", "license"),
    (r"\bsub licens", "sublicens"),
    (r"\bnon infringement\b", "noninfringement"),
    (r"\bhttps\b", "http"),
    (r"\bversion\b", "v"),
    (r"\bcopyright owner", "copyright holder"),
)
COPYRIGHT_LINE = r"^[^\p{L}\p{N}]*(copyright\b|©|\(c\) |all rights reserved)"
NOT_WORDS = r"[^\p{L}\p{N}]+"
BREAKS = r"[\n\r]+"


def canonical_line(line: Column) -> Column:
    lowered = F.lower(line)
    text = F.regexp_replace(lowered, NOT_WORDS, " ")
    for pattern, one in SPELLINGS:
        text = F.regexp_replace(text, pattern, one)
    return F.when(lowered.rlike(COPYRIGHT_LINE), F.lit("")).otherwise(F.trim(text))


def canonical_lines(text: Column) -> Column:
    """Canonical lines that are not empty."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), BREAKS), canonical_line)
    return F.filter(lines, lambda x: x != "")


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def known_licenses(spark: SparkSession, known: dict[str, tuple[str, ...]] = KNOWN) -> DataFrame:
    """license, digest of the given texts."""
    rows = [(name, text) for name, texts in known.items() for text in texts]
    raw = spark.createDataFrame(rows, "license string, text string")
    # The texts are written over several lines, of which none is a copyright line.
    whole = F.array_join(canonical_lines(F.col("text")), " ")
    return raw.select("license", _digest(whole).alias("digest")).distinct()


def scan_licenses(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_digest, text_license, line_licenses, n_license_lines for every row.

    ``known`` has license and digest; several names are joined by commas.
    """
    known = stored(known_licenses(docs.sparkSession) if known is None else known.select("license", "digest"), "license-known")
    lines = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("rid"), canonical_lines(F.col(text_col)).alias("lines"))
    found = lines.select(
        "doc_id", "rid", _digest(F.array_join("lines", " ")).alias("text_digest"), F.transform("lines", _digest).alias("line_digests")
    )
    found = stored(found, "license-digests")
    small = sized(known)
    units = found.select("rid", F.lit(True).alias("whole"), F.col("text_digest").alias("digest")).unionAll(
        found.select("rid", F.lit(False), F.explode("line_digests"))
    )
    # Sums of the lines that match; unmatched lines end at the join.
    hits = units.join(small, "digest").groupBy("rid", "whole", "license").agg(F.count(F.lit(1)).alias("n"))
    names = F.array_join(F.array_sort(F.collect_set(F.when(~F.col("whole"), F.col("license")))), ",")
    whole_names = F.array_join(F.array_sort(F.collect_set(F.when(F.col("whole"), F.col("license")))), ",")
    per_row = hits.groupBy("rid").agg(
        F.when(whole_names != "", whole_names).alias("text_license"),
        F.when(names != "", names).alias("line_licenses"),
        F.sum(F.when(~F.col("whole"), F.col("n"))).alias("n_license_lines"),
    )
    joined = found.select("doc_id", "rid", "text_digest").join(per_row, "rid", "left")
    return joined.select("doc_id", "text_digest", "text_license", "line_licenses", F.coalesce("n_license_lines", F.lit(0)).cast("long").alias("n_license_lines"))
