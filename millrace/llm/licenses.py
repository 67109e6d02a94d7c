"""License scans: text units against licence templates, by Dice coefficient over word bigrams.

A text is normalised to lower-case runs of ASCII letters and digits joined by one blank. The units of a document
are each of its lines, the whole text, and passages: runs of as many words as a template has, wherever they begin, so
that a notice is found however it is wrapped and whatever stands around it. With ``n`` words a unit has ``n - 1``
bigrams, counted with repetition; Dice is 2 * common / (sum of both counts). A template of ``m`` bigrams can only
reach threshold ``t`` on a unit with ``n - 1`` between ``m * t / (2 - t)`` and ``m * (2 - t) / t``, so lines and whole
texts join templates on their bigram count and no bigram is built for any other unit. DataFrame functions only.

A unit that reaches the threshold holds at least a share ``t / (2 - t)`` of the template's bigrams. So the bigrams of all
documents are first joined to those of the templates and counted; only documents with that share of a
template's bigrams are read again, and their units are compared with no other template. For passages, a hit says where the
template would begin; beginnings that one in ``VOTES`` of the template's bigrams, or ``ENOUGH`` of them, name are compared
in full. (A notice with words put in or left out so often that nowhere so many bigrams keep their distance is not found.)

A document's row per line and for the whole text names the best licence of that unit (``line_no`` from 1, 0 for the
whole); its best passage of each licence is a row with a null ``line_no`` and the number of its first word in
``word_no``, unless a better passage of another licence overlaps it (of equal ones the smaller licence id stays), or
a line or the whole text of the document already names that licence.

Null and empty texts, and units under two words, match nothing. Rows with one doc_id
are scanned each on its own text and share the key in the result; equal hits of one key and
unit become one. Ties go to the smaller licence id, then to the earlier word. Extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import mark, stored, table

THRESHOLD = 0.8
VOTES, ENOUGH = 8, 6  # a passage begins where an eighth of the template's bigrams, or six of them, say so
MAX_TEMPLATE_WORDS = 400_000  # of all templates: some MB, broadcast once

# Public licence texts and notices, as their licences ask to be written.
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
    " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
    " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
    " Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
    " conditions: The above copyright notice and this permission notice shall be included in all copies or"
    " substantial portions of the Software."
)
MIT_WARRANTY = (
    " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO"
    " THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE"
    " AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF"
    " CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS"
    " IN THE SOFTWARE."
)
BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of"
    " conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,"
    " this list of conditions and the following disclaimer in the documentation and/or other materials provided with the"
    " distribution."
)
BSD_WARRANTY = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES,"
    " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
    " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
    " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
    " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,"
    " WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE"
    " OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", MIT_GRANT),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on"
        " an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for"
        " the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "MIT License Copyright (c) <year> <copyright holders> " + MIT_GRANT + MIT_WARRANTY),
    ("MIT", MIT_GRANT + MIT_WARRANTY),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE"
        " IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED"
        " WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,"
        " INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,"
        " WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE"
        " USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("BSD-2-Clause", BSD_HEAD + BSD_WARRANTY),
    (
        "BSD-3-Clause",
        BSD_HEAD + " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or"
        " promote products derived from this software without specific prior written permission." + BSD_WARRANTY,
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held"
        " liable for any damages arising from the use of this software. Permission is granted to anyone to use this"
        " software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject"
        " to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that"
        " you wrote the original software. If you use this software in a product, an acknowledgment in the product"
        " documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such,"
        " and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from"
        " any source distribution.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,"
        " use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any"
        " purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the"
        " author or authors of this software dedicate any and all copyright interest in the software to the public domain."
        " We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors."
        " We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to"
        " this software under copyright law.",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and"
        " accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute,"
        " execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties"
        " to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and"
        " this entire statement, including the above license grant, this restriction and the following disclaimer, must be"
        " included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such"
        " copies or derivative works are solely in the form of machine-executable object code generated by a source language"
        " processor.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY"
        " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU"
        " General Public License for more details. You should have received a copy of the GNU General Public License along"
        " with this program. If not, see <https://www.gnu.org/licenses/>.",
    ),
)


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def bigrams(text: Column) -> Column:
    """Word pairs of a normalised text of two words or more."""
    words = F.split(text, " ")
    return F.zip_with(
        F.slice(words, F.lit(1), F.size(words) - 1),
        F.slice(words, F.lit(2), F.size(words) - 1),
        lambda a, b: F.concat_ws(" ", a, b),
    )


def pair_count(text: Column) -> Column:
    """Bigrams of a normalised text, without building them."""
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))


def counted(grams: Column) -> Column:
    """Bigrams with the number of each repetition, so that a bag becomes a set."""
    ordered = F.array_sort(grams)

    def numbered(s: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(s) - 1)
        begins = F.filter(places, lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        ends = F.concat(F.slice(begins, F.lit(2), F.greatest(F.size(begins) - 1, F.lit(0))), F.array(F.size(s)))
        runs = F.zip_with(
            begins, ends, lambda x, y: F.transform(F.sequence(F.lit(1), y - x), lambda k: F.concat_ws(" ", F.get(s, x), k))
        )
        return F.flatten(runs)

    # the one-element array gives the sorted bigrams a name
    return F.transform(F.array(ordered), numbered)[0]


def words_in(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """One row per template: template, license, grams, bag (counted bigrams) and m; grows with the templates only."""
    words = sum(len(words_in(text)) for _, text in templates)
    if words > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of {words} words exceed {MAX_TEMPLATE_WORDS}, the bound for a broadcast")
    rows = [(k, name, text) for k, (name, text) in enumerate(templates) if len(words_in(text)) > 1]
    listed = spark.createDataFrame(rows, "template int, license string, t string")
    grams = bigrams(normalised(F.col("t")))
    return listed.select("template", "license", grams.alias("grams"), counted(grams).alias("bag"), F.size(grams).alias("m"))


def candidates(documents: DataFrame, listed: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents with enough bigrams of a template for one of their units to match it: doc_id, mark, template, license, m."""
    grams = documents.select("doc_id", mark().alias("mark"), F.explode(bigrams(normalised(F.coalesce("text", F.lit(""))))).alias("gram"))
    kinds = F.broadcast(listed.select("template", F.explode(F.array_distinct("grams")).alias("gram")))
    counts = grams.join(kinds, "gram").groupBy("doc_id", "mark", "template").agg(F.count("*").alias("n"))
    enough = counts.join(F.broadcast(listed.select("template", "license", "m")), "template")
    return enough.where(F.col("n") >= F.col("m") * (threshold / (2 - threshold))).drop("n")


def same_document(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.mark") == F.col(f"{b}.mark"))


def units(documents: DataFrame) -> DataFrame:
    """Lines (from 1) and the whole text (line 0) of each document, normalised, with two words or more."""
    text = F.coalesce("text", F.lit(""))
    lines = F.split(text, "\n")
    both = documents.select(
        "doc_id",
        mark().alias("mark"),
        F.posexplode(F.when(F.size(lines) > 1, F.concat(F.array(text), lines)).otherwise(F.array(text))).alias("line_no", "unit"),
    )
    plain = both.select("doc_id", "mark", F.col("line_no").cast("bigint").alias("line_no"), normalised(F.col("unit")).alias("unit"))
    return plain.withColumn("n_bigrams", pair_count(F.col("unit"))).where("n_bigrams > 0")


def common(own: Column, grams: Column, bag: Column) -> Column:
    """Bigrams in common, with repetition; without repetition in the unit they are a set."""

    def size(o: Column) -> Column:
        plain = F.size(F.array_intersect(o, grams))
        return F.when(F.size(F.array_distinct(o)) == F.size(o), plain).otherwise(F.size(F.array_intersect(counted(o), bag)))

    # the one-element array gives the unit's bigrams a name
    return F.transform(F.array(own), size)[0]


def passages(documents: DataFrame, rich: DataFrame, listed: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Runs of a template's length that reach the threshold: doc_id, template, license, word_no, size (words) and dice.

    ``rich`` names the templates (``candidates``) that the documents are searched for.
    """
    body = normalised(F.coalesce("text", F.lit("")))
    rows = documents.select("doc_id", mark().alias("mark"), body.alias("body")).distinct()
    placed = rows.select("doc_id", "mark", pair_count(F.col("body")).alias("total"), F.posexplode(bigrams(F.col("body"))).alias("p", "gram"))
    key = ["doc_id", "mark", "template"]
    places = listed.select("template", F.posexplode("grams").alias("q", "gram"))
    wanted = placed.alias("p").join(F.broadcast(places).alias("q"), "gram").join(
        rich.alias("r"), same_document("p", "r") & (F.col("q.template") == F.col("r.template"))
    )
    begin = F.greatest(F.col("p") - F.col("q"), F.lit(0)).alias("word_no")
    hits = stored(wanted.select("r.doc_id", "r.mark", "r.template", "r.license", "r.m", "total", "p", "gram", begin), "hits")
    votes = hits.select(*key, "total", "license", "m", "word_no", "p").distinct().groupBy(*key, "total", "license", "m", "word_no").agg(
        F.count("*").alias("votes")
    )
    starts = votes.where((F.col("votes") * VOTES >= F.col("m")) | (F.col("votes") >= ENOUGH)).alias("s")
    each = hits.select(*key, "p", "gram").distinct().alias("e")
    inside = (F.col("e.p") >= F.col("s.word_no")) & (F.col("e.p") < F.col("s.word_no") + F.col("s.m"))
    held = starts.join(each, same_document("s", "e") & (F.col("s.template") == F.col("e.template")) & inside).groupBy(
        "s.doc_id", "s.mark", "s.template", "s.total", "s.license", "s.m", "s.word_no", "e.gram"
    ).agg(F.count("*").alias("c"))
    times = listed.select("template", F.explode("grams").alias("gram")).groupBy("template", "gram").agg(F.count("*").alias("t"))
    counts = held.join(F.broadcast(times), ["template", "gram"])
    sums = counts.groupBy(*key, "total", "license", "m", "word_no").agg(F.sum(F.least("c", "t")).alias("common"))
    n = F.least("m", F.col("total") - F.col("word_no"))
    score = 2.0 * F.col("common") / (n + F.col("m"))
    return sums.select(
        "doc_id", "template", "license", F.col("word_no").cast("bigint").alias("word_no"), (n + 1).alias("size"), score.alias("dice")
    ).where(F.col("dice") >= threshold)


def scan(documents: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Best licence of each unit that reaches the threshold: doc_id, line_no, word_no, license, dice."""
    listed = stored(template_table(documents.sparkSession, templates), "templates")
    rich = stored(candidates(documents, listed, threshold), "rich")
    keys = rich.select("doc_id", "mark").distinct().alias("k")
    few = documents.withColumn("mark", mark()).alias("d").join(keys, same_document("d", "k"), "left_semi")
    few = stored(few.select("doc_id", "text"), "read-again")
    m, n = F.col("m"), F.col("n_bigrams")
    bounded = (n >= F.ceil(m * threshold / (2 - threshold))) & (n <= F.floor(m * (2 - threshold) / threshold))
    paired = units(few).alias("u").join(rich.alias("r"), same_document("u", "r")).where(bounded)
    known = F.broadcast(listed.select("template", "grams", "bag"))
    compared = paired.select("u.doc_id", "line_no", "unit", "n_bigrams", "template", "license", "m").join(known, "template")
    scored = compared.select(
        "doc_id", "line_no", "license", (2.0 * common(bigrams(F.col("unit")), F.col("grams"), F.col("bag")) / (n + m)).alias("dice")
    ).where(F.col("dice") >= threshold)
    best = scored.groupBy("doc_id", "line_no").agg(F.min(F.struct((-F.col("dice")).alias("d"), "license")).alias("b"))
    lines = stored(best.select("doc_id", "line_no", "b.license", (-F.col("b.d")).alias("dice")), "lines")

    runs = passages(few, rich, listed, threshold).groupBy("doc_id", "license").agg(
        F.min(F.struct((-F.col("dice")).alias("d"), "word_no", "size")).alias("b")
    )
    # at most one row per document and licence
    found = stored(runs.select("doc_id", "license", (-F.col("b.d")).alias("dice"), "b.word_no", "b.size"), "passages")
    x, y = found.alias("x"), found.alias("y")
    overlap = (F.col("x.word_no") < F.col("y.word_no") + F.col("y.size")) & (F.col("y.word_no") < F.col("x.word_no") + F.col("x.size"))
    better = F.struct(-F.col("y.dice"), F.col("y.license")) < F.struct(-F.col("x.dice"), F.col("x.license"))
    clear = x.join(y, F.col("x.doc_id").eqNullSafe(F.col("y.doc_id")) & overlap & better, "left_anti")
    named = lines.select(F.col("doc_id").alias("other_id"), F.col("license").alias("named")).distinct()
    more = clear.join(named, F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("license") == F.col("named")), "left_anti")
    nothing = F.lit(None).cast("bigint")
    return lines.select("doc_id", "line_no", nothing.alias("word_no"), "license", "dice").unionByName(
        more.select("doc_id", nothing.alias("line_no"), "word_no", "license", "dice")
    )


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


_VALUES = ",\n".join("({}, '{}', '{}')".format(k, name, text.replace("'", "''")) for k, (name, text) in enumerate(TEMPLATES))

# whole texts are compared up to twice the longest template, as longer ones cannot match
ORACLE_SQL = f"""
WITH templates(template, license, t) AS (VALUES {_VALUES}),
tgrams AS (
    SELECT template, license, len(w) - 1 AS m, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] AS h
    FROM (SELECT template, license, string_split(trim(regexp_replace(lower(t), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM templates)),
places AS (SELECT template, license, m, unnest(range(m)) AS q, unnest(h) AS gram FROM tgrams),
template_counts AS (SELECT template, license, m, gram, count(*) AS c FROM places GROUP BY ALL),
bodies AS (SELECT doc_id, coalesce(text, '') AS text,
    string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM documents),
lines AS (
    SELECT doc_id, 0 AS line_no, text AS unit FROM bodies
    UNION ALL
    SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)), unnest(string_split(text, chr(10)))
    FROM bodies WHERE contains(text, chr(10))),
grams AS (
    SELECT doc_id, line_no, len(w) - 1 AS n, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS gram
    FROM (SELECT doc_id, line_no, string_split(trim(regexp_replace(lower(unit), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM lines)
    WHERE len(w) BETWEEN 2 AND 500),
scored AS (
    SELECT doc_id, line_no, license, template, 2.0::DOUBLE * sum(least(u.c, v.c)) / (n + m) AS dice
    FROM (SELECT doc_id, line_no, n, gram, count(*) AS c FROM grams GROUP BY ALL) u JOIN template_counts v USING (gram)
    GROUP BY doc_id, line_no, license, template, n, m),
best AS (SELECT doc_id, line_no, license, dice FROM scored WHERE dice >= {THRESHOLD}
    QUALIFY row_number() OVER (PARTITION BY doc_id, line_no ORDER BY dice DESC, license) = 1),
positions AS (SELECT doc_id, len(w) - 1 AS total, unnest(range(len(w) - 1)) AS p,
    unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS gram FROM bodies WHERE len(w) > 1),
votes AS (
    SELECT doc_id, total, template, license, m, greatest(p - q, 0) AS s
    FROM positions JOIN places USING (gram) GROUP BY ALL HAVING count(DISTINCT p) * {VOTES} >= m OR count(DISTINCT p) >= {ENOUGH}),
runs AS (
    SELECT doc_id, license, s, n + 1 AS size, 2.0::DOUBLE * sum(least(u.c, v.c)) / (n + v.m) AS dice
    FROM (SELECT o.doc_id, o.template, o.s, least(o.m, o.total - o.s) AS n, gram, count(*) AS c
        FROM votes o JOIN positions k ON k.doc_id = o.doc_id AND k.p >= o.s AND k.p < o.s + o.m GROUP BY ALL) u
    JOIN template_counts v USING (template, gram) GROUP BY doc_id, license, template, s, n, v.m),
passages AS (SELECT * FROM runs WHERE dice >= {THRESHOLD}
    QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY dice DESC, s, size) = 1)
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, CAST(NULL AS BIGINT) AS word_no, license, CAST(dice AS DOUBLE) AS dice FROM best
UNION ALL
SELECT doc_id, NULL, CAST(s AS BIGINT), license, CAST(dice AS DOUBLE) FROM passages r
WHERE NOT EXISTS (SELECT 1 FROM best b WHERE b.doc_id = r.doc_id AND b.license = r.license)
    AND NOT EXISTS (SELECT 1 FROM passages o WHERE o.doc_id = r.doc_id AND r.s < o.s + o.size AND o.s < r.s + r.size
        AND (o.dice > r.dice OR o.dice = r.dice AND o.license < r.license))
"""
