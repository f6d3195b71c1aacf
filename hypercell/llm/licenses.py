"""License scans by canonical digests of entire texts.

A unit (a document, a block between blank lines, or a line) is brought to canonical form and its digest is joined with the
digests of known licence texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypercell.llm.common import chunks, id_text, lean, ship
from hypercell.llm.decontaminate import NORMAL

# Equivalent spellings: each first form counts as the second.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact", "authorisation": "authorization",
    "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled", "capitalisations": "capitalizations", "catalogue": "catalog",
    "categorise": "categorize", "centre": "center", "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling", "labour": "labor", "licence": "license",
    "licenced": "licensed", "licences": "licenses", "maximise": "maximize", "modelled": "modeled", "modelling": "modeling", "offence": "offense",
    "optimise": "optimize", "organisation": "organization", "organise": "organize", "practise": "practice", "programme": "program", "realise": "realize",
    "recognise": "recognize", "signalling": "signaling", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_START = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n"
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
#: Known texts by licence. More than one text may stand for a licence.
KNOWN: tuple[tuple[str, str], ...] = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_DISCLAIMER),
    ("0BSD", _ISC_GRANT + ".\n" + _ISC_DISCLAIMER),
    ("BSD-2-Clause", _BSD_START + _BSD_DISCLAIMER),
    ("BSD-3-Clause", _BSD_START + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n" + _BSD_DISCLAIMER),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.\nYou should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)

_WORD = rb"(?<![^ ])(?:" + "|".join(sorted(SPELLINGS, key=len, reverse=True)).encode() + rb")(?![^ ])"
_SPELLED = re.compile(_WORD)
_RESPELL = {a.encode(): b.encode() for a, b in SPELLINGS.items()}
_COPYRIGHT = re.compile(rb"(?:copyright (?:c|\xc2\xa9|[0-9]{4})|c [0-9]{4})(?: |$)|\xc2\xa9")


def canonical_line(line: str) -> bytes:
    """Lower-case words with single spaces in their usual spelling; nothing for a copyright line."""
    out = b" ".join(line.encode().translate(NORMAL).split())
    if out[:1] in (b"c", b"\xc2") and _COPYRIGHT.match(out):
        return b""
    return _SPELLED.sub(lambda m: _RESPELL[m[0]], out)


def canonical(text: str) -> bytes:
    """The canonical lines of a text that have words, joined by spaces."""
    return b" ".join(filter(None, map(canonical_line, text.split("\n"))))


def units(text: str) -> Iterator[tuple[str, int, bytes]]:
    """Kind, place and canonical form of each distinct unit with words: lines, blocks of several lines, and the whole text.

    A line without words, a copyright line included, ends a block; the whole text has all lines.
    """
    lines = [canonical_line(x) for x in text.split("\n")]
    block: list[bytes] = []
    start = 0
    for i, line in enumerate([*lines, b""]):
        if line:
            if not block:
                start = i
            block.append(line)
            yield "line", i, line
        elif block:
            if len(block) > 1:
                yield "block", start, b" ".join(block)
            block = []
    if any(lines):
        yield "text", 0, b" ".join(filter(None, lines))


def digests(known: Sequence[tuple[str, str]] = KNOWN) -> list[tuple[str, str]]:
    """Licence and digest of the canonical form of each known text."""
    return sorted({(name, hashlib.sha256(canonical(text)).hexdigest()) for name, text in known})


def matches(df: DataFrame, known: Sequence[tuple[str, str]] = KNOWN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per unit that is a known licence text as a whole: ``id_col``, ``unit`` (line, block or text), ``place`` (line
    number from 0) and ``license``.

    Null and empty texts have no units; repeated rows repeat their matches; other columns are left out. ``known`` is
    a list that the caller holds in memory; that bounds what is broadcast.
    """
    spark = df.sparkSession
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = hashlib.sha256
        for batch in batches:
            for part in chunks(batch, 1, 4 << 20):
                ids, kinds, places, found = [], [], [], []
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    for kind, place, form in units(text):
                        ids.append(i)
                        kinds.append(kind)
                        places.append(place)
                        found.append(sha(form).digest())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(kinds, pa.string()), pa.array(places, pa.int64()), pa.array(found, pa.binary())], ["id", "unit", "place", "digest"])

    table = digests(known)
    right = spark.createDataFrame([(n, bytes.fromhex(h)) for n, h in table], "license string, digest binary")
    if len(table) <= 10_000:
        right = F.broadcast(right)
    found = id_text(df, id_col, text_col).mapInArrow(lean(run), "id long, unit string, place long, digest binary")
    return found.join(right, "digest").select(F.col("id").alias(id_col), "unit", "place", "license")


def scan(df: DataFrame, known: Sequence[tuple[str, str]] = KNOWN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct id: ``id_col``, ``licenses`` (sorted names, comma-joined), ``n_matches`` (units that are a known text)
    and ``whole`` (the whole text is one). Ids without a match get an empty string, 0 and false; null ids count as one id.
    """
    found = matches(df, known, id_col, text_col).groupBy(id_col).agg(
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"), F.count("*").alias("n_matches"), F.max(F.col("unit") == "text").alias("whole")
    )
    ids = df.select(F.col(id_col).cast("long").alias("id")).distinct()
    return ids.join(found, ids["id"].eqNullSafe(found[id_col]), "left").select(
        ids["id"].alias(id_col), F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"), F.coalesce("whole", F.lit(False)).alias("whole")
    )
