"""Licence scan by canonical digests.

A text is brought to a canonical form - lower case, copyright lines gone,
equivalent spellings made one, punctuation and white space made single
spaces - and its SHA-256 is looked up among the digests of known licence
texts, prepared by the same expressions.  The lookup takes entire texts: the
whole document, and each of its lines as a text of its own, so that a notice
line in an article is found too.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm.common import staged, text_or_empty

#: Spellings taken as equal, as substrings of the lower-cased text.
EQUIVALENT = (
    ("licence", "license"), ("licencing", "licensing"), ("sub-license", "sublicense"),
    ("sub license", "sublicense"), ("non-commercial", "noncommercial"), ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"),
    ("cancelled", "canceled"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("copyright owner", "copyright holder"), ("favour", "favor"), ("fulfil ", "fulfill "),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("modelled", "modeled"), ("organisation", "organization"),
    ("organise", "organize"), ("per cent", "percent"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"),
    ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"), ("http:", "https:"),
)

#: A copyright line: it begins with the mark (after comment signs) and is not a condition's sentence.
COPYRIGHT_LINE = (r"(?m)^[ \t*#/;\-]*(?:(?:copyright[ \t]*(?:\(c\)|©|[\d<\[{])|(?:\(c\)|©)[ \t]*[\d<\[{])[^\n]*"
                  r"|all rights reserved\.?[ \t]*)$")

_BODIES = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form
or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to
the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in
perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>"""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
)
#: Title lines that stand above a body in licence files.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License',
                     "Simplified BSD License", "BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License',
                     "New BSD License", "BSD License"),
    "Unlicense": ("The Unlicense",),
}


def _forms(bodies) -> list[tuple[str, str]]:
    """Every body as it is; entire licences also without numbers of conditions, and under each of their titles."""
    out = list(bodies)
    for name, body in bodies:
        if name in TITLES and "\n" in body:
            plain = re.sub(r"(?m)^\d\. ", "", body)
            out += [(name, plain)] * (plain != body)
            out += [(name, f"{t}\n{b}") for t in TITLES[name] for b in dict.fromkeys((body, plain))]
    return out


#: Known texts, (identifier, text); long licences are files, named by identifier.
KNOWN_TEXTS = (*_forms(_BODIES), *((p.name.removesuffix(".txt"), p.read_text(encoding="utf-8")) for p in sorted(
    Path(__file__).with_name("known_licenses").glob("*.txt"))))


def canonical_lines(text: Column) -> Column:
    """The canonical forms of a text's lines, in order; lines without a letter or digit are empty."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    for spelling, same in EQUIVALENT:
        out = F.replace(out, F.lit(spelling), F.lit(same))
    return F.transform(F.split(F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " "), "\n", -1), lambda x: F.trim(x))


def joined(lines: Column) -> Column:
    """The canonical form of the text whose canonical lines these are."""
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def known_digests(spark: SparkSession, texts=KNOWN_TEXTS) -> DataFrame:
    """Digest table (digest, license) of known texts; equal texts count once."""
    frame = spark.createDataFrame(list(texts), "license string, known string")
    return frame.groupBy(F.sha2(joined(canonical_lines(F.col("known"))), 256).alias("known_digest")).agg(
        F.min("license").alias("known_license"))


def scan_licenses(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, digest, license, line_licenses, n_notice_lines.

    ``license`` is that of the whole text or null; ``line_licenses`` are the
    distinct ones of lines that are a known text each, sorted (empty array if
    none).  Null counts as empty, and an empty canonical form is no licence.
    Rows that repeat both doc_id and text get the same result; other columns
    are not read.  ``known`` is a frame as ``known_digests`` gives it.
    """
    known = known_digests(docs.sparkSession) if known is None else known
    # as a table of known size Spark sees whether it is small enough to broadcast
    known = staged(known.where(F.col("known_digest") != F.sha2(F.lit(""), 256)), "license-known")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("check"), canonical_lines(F.col("text")).alias("lines"))
    # texts are normalised in one pass; what goes on are digests
    rows = staged(rows.select(
        "doc_id", "check", F.sha2(joined(F.col("lines")), 256).alias("digest"),
        F.transform(F.filter("lines", lambda x: x != ""), lambda x: F.unhex(F.sha2(x, 256))).alias("line_digests")),
        "license-digests")
    lines = rows.select("doc_id", "check", F.posexplode("line_digests").alias("pos", "line_digest"))
    k = known.select(F.unhex("known_digest").alias("known_line"), F.col("known_license").alias("l"))
    found = (lines.join(k, F.col("line_digest") == F.col("known_line"))
             .groupBy("doc_id", "check", "pos").agg(F.min("l").alias("l"))
             .groupBy(F.col("doc_id").alias("of"), F.col("check").alias("of_check"))
             .agg(F.sort_array(F.collect_set("l")).alias("line_licenses"),
                  F.count(F.lit(1)).alias("n_notice_lines")))
    whole = rows.join(known, F.col("digest") == F.col("known_digest"), "left")
    return whole.join(found.hint("merge"), F.col("doc_id").eqNullSafe(F.col("of"))
                      & (F.col("check") == F.col("of_check")), "left").select(
        "doc_id", "digest", F.col("known_license").alias("license"),
        F.coalesce("line_licenses", F.array().cast("array<string>")).alias("line_licenses"),
        F.coalesce("n_notice_lines", F.lit(0)).cast("long").alias("n_notice_lines"))
