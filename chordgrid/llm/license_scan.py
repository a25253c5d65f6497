"""License scans by diagonal voting.

All rolling word k-gram hashes of all documents meet the template positions in a Spark join. A match at
document word i and template word j votes for the diagonal i - j; votes are counted by document,
template and diagonal, diagonals that lie close together (words were put in or left out) are merged,
and every merged span with enough votes is verified word by word against its template. A vote counts once
for each place of the template, and merging stays within bands twice as wide as the template: each
diagonal is in one band of two overlapping rows of them, so what one occurrence spans is in one band.

Phrases are looked for word by word in the same pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chordgrid.llm.shared import sized_hint, work_folder, written
from chordgrid.llm.words import ALNUM, LOWER, Words, pieces, text_bytes, whole, windows

K = 3
#: Neighbouring diagonals up to so far apart are one span.
GAP = 4
#: Votes a span needs, as a share of its template's k-grams, and words it must match in order.
MIN_VOTES, MIN_MATCH = 0.4, 0.8

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: The whole texts of short licences and of common notices.
_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_BSD_TWO = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
WHOLE_TEXTS = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS),
    ("bsd-2-clause", _BSD_TWO + " " + _BSD_END),
    ("bsd-3-clause", _BSD_TWO + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + _BSD_END),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("gpl-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]

#: Wordings of common notices and their labels.
NOTICES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
]


TEMPLATES = NOTICES + WHOLE_TEXTS


def hashed(text: str) -> np.ndarray:
    data, bounds = text_bytes(pa.array([text]))
    return Words(LOWER[data], bounds, ALNUM).hashes()


def template_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (template, text): (h, template, t_pos, grams) for each k-gram of a template, and their number."""
    for batch in batches:
        for template, text in zip(batch.column("template").to_pylist(), batch.column("text").to_pylist()):
            grams = windows(hashed(text or ""), K).view(np.int64)
            n = len(grams)
            yield pa.record_batch([pa.array(grams), pa.array(np.full(n, template)), pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, n, np.int32))], ["h", "template", "t_pos", "grams"])


def template_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (template, label, text): (template, label, wanted), the hashes of the template's words."""
    for batch in batches:
        words = [hashed(t or "").view(np.int64).tolist() for t in batch.column("text").to_pylist()]
        yield pa.record_batch([batch.column("template"), batch.column("label"), pa.array(words, pa.list_(pa.int64()))], ["template", "label", "wanted"])


def scan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (id, th, text): a row of counts for each document, and a row for each rolling k-gram (n_words null)."""
    phrases = [hashed(p) for p in PHRASES]
    names = ["id", "th", "h", "pos", "n_words", "n_base", "first_word", "last_word", "base"]
    for piece in pieces(batches, "text"):
        data, bounds = text_bytes(piece.column("text"))
        words = Words(LOWER[data], bounds, ALNUM)
        h, row = words.hashes(), words.row
        n = len(words.count)
        count, base = np.zeros(n, np.int64), np.zeros(n, np.int32)
        first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
        for p, own in enumerate(phrases):
            m = len(own)
            ok = whole(words.first, m, len(h))
            for j in range(m):
                ok = ok & (h[j : j + len(ok)] == own[j])
            at = np.flatnonzero(ok)
            of = row[at]
            place = at - words.first[of]
            count += np.bincount(of, minlength=n)
            base[of] |= 1 << p
            np.minimum.at(first, of, place)
            np.maximum.at(last, of, place)
        bounds_ = [pa.array(x, mask=np.asarray(count == 0)) for x in (first, last)]
        yield pa.record_batch([piece.column("id"), piece.column("th"), pa.array(np.zeros(n, np.int64)), pa.nulls(n, pa.int32()), pa.array(words.count), pa.array(count), *bounds_, pa.array(base)], names)
        ok = np.flatnonzero(whole(words.first, K, len(h)))
        of = pa.array(row[ok])
        grams = windows(h, K)[ok] if len(ok) else np.zeros(0, np.uint64)
        pos = (ok - words.first[row[ok]]).astype(np.int32)
        z = len(ok)
        yield pa.record_batch(
            [piece.column("id").take(of), piece.column("th").take(of), pa.array(grams.view(np.int64)), pa.array(pos), *(pa.nulls(z, pa.int64()) for _ in range(4)), pa.nulls(z, pa.int32())], names)


def in_order(a: list, b: list) -> int:
    """Length of the longest common subsequence; a row of its table is the bits of one number."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for y in b:
        hit = row & places.get(y, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def verify_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (id, th, text, spans): (id, th, label, start, stop, match) of the spans that hold their template."""
    for piece in pieces(batches, "text"):
        data, bounds = text_bytes(piece.column("text"))
        words = Words(LOWER[data], bounds, ALNUM)
        h, rows, out = words.hashes(), [], []
        for i, spans in enumerate(piece.column("spans").to_pylist()):
            text = h[words.first[i] : words.first[i + 1]]
            for s in spans:
                wanted = s["wanted"]
                # the template's words before its first and after its last matching k-gram may have changed
                a, b = max(0, s["start"] - s["t_start"] - GAP), s["stop"] + len(wanted) - s["t_stop"] + GAP
                match = in_order(wanted, text[a:b].view(np.int64).tolist()) / len(wanted)
                if match >= MIN_MATCH:
                    rows.append(i)
                    out.append((s["label"], s["start"], s["stop"], match))
        at = pa.array(rows, pa.int64())
        label, start, stop, match = zip(*out) if out else ((), (), (), ())
        yield pa.record_batch([piece.column("id").take(at), piece.column("th").take(at), pa.array(label, pa.string()), pa.array(start, pa.int32()), pa.array(stop, pa.int32()), pa.array(match, pa.float64())], ["id", "th", "label", "start", "stop", "match"])


class LicenseScan:
    """``documents``: a row of counts for each row of docs; ``spans``: verified (id, th, label, start, stop, match).

    ``templates``: a table (label, text) of whole licence texts or notices, by default ``TEMPLATES``. It is broadcast up to a
    bound on its k-grams; a larger one meets the documents' k-grams in a shuffled join. Templates below K
    words have no k-gram and are never found.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, templates: DataFrame | None = None):
        spark = docs.sparkSession
        folder = folder or work_folder(spark)
        texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
        field, long, int_ = texts.schema["id"], T.LongType(), T.IntegerType()
        made = T.StructType([field, *(T.StructField(c, t) for c, t in (("th", long), ("h", long), ("pos", int_), ("n_words", long), ("n_base", long), ("first_word", long), ("last_word", long), ("base", int_)))])
        if templates is None:
            templates = spark.createDataFrame(TEMPLATES, "label string, text string")
        own = templates.select("label", "text").distinct().withColumn("template", F.xxhash64("label", "text"))
        table = written(own.select("template", "text").mapInArrow(template_grams, "h long, template long, t_pos int, grams int"), folder, "template_grams")
        words = written(own.mapInArrow(template_words, "template long, label string, wanted array<long>"), folder, "template_words")
        grams, hint = texts.mapInArrow(scan_rows, made), sized_hint(table)
        if hint == "broadcast":
            # one more row, for hash 0, lets the documents' own rows through
            table = table.unionByName(spark.createDataFrame([(0, None, None, None)], table.schema))
            grams = grams.join(F.broadcast(table), "h").where("(template is null) = (n_words is not null)")
        else:
            # documents' own rows are spread by their texts' hashes and meet nothing
            grams = grams.withColumn("own", F.col("n_words").isNotNull()).withColumn("h", F.when(F.col("own"), F.col("th")).otherwise(F.col("h")))
            grams = grams.join(table.withColumn("own", F.lit(False)).hint(hint), ["h", "own"], "left").where("own or template is not null")
        rows = written(grams, folder, "matches")
        self.documents = rows.where("template is null").select("id", "th", "n_words", "n_base", "first_word", "last_word", "base")

        key = ["id", "th", "template"]
        votes = rows.where("template is not null").groupBy(*key, (F.col("pos") - F.col("t_pos")).alias("diagonal")).agg(
            F.collect_set("t_pos").alias("places"), F.min("pos").alias("start"), F.max("pos").alias("stop"), F.min("t_pos").alias("t_start"), F.max("t_pos").alias("t_stop"), F.first("grams").alias("grams"))
        wide = F.col("grams") + (K - 1 + GAP)  # words of the template, and a gap
        bands = votes.withColumn("row", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("band", F.floor((F.col("diagonal") + F.col("row") * wide) / (2 * wide)))
        along = Window.partitionBy(*key, "row", "band").orderBy("diagonal")
        new = (F.col("diagonal") - F.lag("diagonal", 1).over(along) > GAP).cast("int")
        merged = bands.withColumn("part", F.sum(F.coalesce(new, F.lit(0))).over(along)).groupBy(*key, "row", "band", "part").agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("votes"), F.min("start").alias("start"), (F.max("stop") + K).alias("stop"),
            F.min("t_start").alias("t_start"), (F.max("t_stop") + K).alias("t_stop"), F.first("grams").alias("grams"))
        enough = merged.where(F.col("votes") >= MIN_VOTES * F.col("grams")).select("id", "th", "template", "start", "stop", "t_start", "t_stop").distinct()
        named = enough.join(words.hint(sized_hint(words, "wanted")), "template")
        spans = named.groupBy("id", "th").agg(F.collect_list(F.struct("label", "wanted", "start", "stop", "t_start", "t_stop")).alias("spans"))
        spans = written(spans.withColumnsRenamed({"id": "s_id", "th": "s_th"}), folder, "spans")
        same = texts["id"].eqNullSafe(spans["s_id"]) & (texts["th"] == spans["s_th"])
        found = texts.join(spans.hint(sized_hint(spans, "spans")), same).select("id", "th", "text", "spans")
        made = T.StructType([field, T.StructField("th", long), T.StructField("label", T.StringType()), T.StructField("start", int_), T.StructField("stop", int_), T.StructField("match", T.DoubleType())])
        self.spans = written(found.mapInArrow(verify_spans, made), folder, "verified")


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: DataFrame | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score
    (the best share of a template's words that the text holds in order; 0 without a verified span).

    A null or empty text has no words and no labels (an empty string); texts of any length are scanned
    whole. Rows that repeat an id are scanned each by its own text. Other columns are not read. An empty
    table gives an empty result.
    """
    scan = LicenseScan(docs, id_col, text_col, templates=templates)
    base = F.filter(F.array(*[F.when(F.col("base").bitwiseAND(1 << i) > 0, F.lit(label)) for i, label in enumerate(PHRASES.values())]), lambda x: x.isNotNull())
    found = scan.spans.groupBy("id", "th").agg(F.collect_set("label").alias("found"), F.max("match").alias("score")).withColumnsRenamed({"id": "s_id", "th": "s_th"})
    rows = scan.documents.withColumn("own", base)
    rows = rows.join(found.hint("merge"), rows["id"].eqNullSafe(found["s_id"]) & (rows["th"] == found["s_th"]), "left")
    every = F.array_union("own", F.coalesce("found", F.array().cast("array<string>")))
    return rows.select(
        F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("own"), ",").alias("base_labels"), F.array_join(F.array_sort(every), ",").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
