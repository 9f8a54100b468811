"""Licence scan: text compared to licence templates by the Dice coefficient over word bigrams.

Compared are each line, each paragraph (between blank lines) and the whole text, normalised to lower-case words
of letters and digits. A template of b bigrams can only reach the coefficient t with a unit of
[b t/(2-t), b (2-t)/t] bigrams: templates are looked up by the unit's size, so others are never compared. And a
unit that reaches t shares over b t/(2-t) bigrams with it, hence holds one of the anchor words, which are chosen
so that fewer bigrams than that avoid them. DataFrame functions only; the templates are a fixed, small table.

Null and empty texts match nothing; a null doc_id is kept. Rows that repeat id and text count once. An empty
table gives no rows. Extra columns are ignored. Long texts are compared whole.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 0.8

# Public licence notices.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "isc": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "mit-line": "Released under the MIT License.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}
#: Words too common in any prose to be worth an anchor.
COMMON = set("a all and any are as at be by can case either for from if in is it later may more new no not of on one or other out see that the their this to use was will with without work writing you your".split())


def words(text: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def bigrams(text: str) -> list[str]:
    w = words(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def size_bounds(n: int, least: float) -> range:
    low, high = n * least / (2 - least), n * (2 - least) / least
    return range(max(1, int(low)), int(high) + 2)


def anchors(templates: dict[str, str], least: float) -> list[str]:
    """Words of which each text that reaches ``least`` with some template holds one, rare ones first."""
    chosen: set[str] = set()
    for t in templates.values():
        pairs = [p.split() for p in bigrams(t)]
        need = len(pairs) * least / (2 - least)
        left = [p for p in pairs if not chosen & set(p)]
        while len(left) >= need - 1e-9:
            count = Counter(w for p in left for w in set(p))
            best = min(count, key=lambda w: (w in COMMON, len(w) < 3, -count[w], w))
            chosen.add(best)
            left = [p for p in left if best not in p]
    return sorted(chosen)


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """(doc_id, template, dice, units): the templates that a document reaches, with the best coefficient and how many units do."""
    templates = templates or TEMPLATES
    spark = docs.sparkSession
    found = anchors(templates, least)
    anchored = F.array(*[F.lit(a) for a in found])
    hint = "(?i)(?:" + "|".join(found) + ")"
    sets = {t: bigrams(x) for t, x in templates.items()}
    by_size = spark.createDataFrame([(n, t, sets[t]) for t in sets for n in size_bounds(len(sets[t]), least)], "size int, template string, wanted array<string>")
    units = (
        docs.where(F.col("text").isNotNull())
        .select("doc_id", "text")
        .where(F.col("text").rlike(hint))
        .distinct()
        .select("doc_id", F.xxhash64("doc_id", "text").alias("row"), F.explode(F.array_distinct(F.concat(F.split("text", "\n"), F.split("text", r"\n\s*\n"), F.array("text")))).alias("unit"))
        .where(F.col("unit").rlike(hint))
        .withColumn("w", F.split(_normal(F.col("unit")), " "))
        .where(F.arrays_overlap("w", anchored) & (F.size("w") > 1))
        .withColumn("held", F.array_distinct(F.zip_with(F.expr("slice(w, 1, size(w) - 1)"), F.expr("slice(w, 2, size(w) - 1)"), lambda a, b: F.concat_ws(" ", a, b))))
        .withColumn("size", F.size("held"))
        .select("doc_id", "row", "held", "size")
    )
    shared = F.size(F.array_intersect("held", "wanted"))
    return (
        units.join(F.broadcast(by_size), "size")
        .withColumn("dice", 2 * shared / (F.size("held") + F.size("wanted")))
        .where(F.col("dice") >= least)
        .groupBy("doc_id", "template")
        .agg(F.max("dice").alias("dice"), F.count("*").alias("units"))
    )


def oracle_sql(templates: dict[str, str] | None = None, least: float = LEAST) -> str:
    """The same in DuckDB's SQL, over the view ``documents``, without pruning."""
    rows = ", ".join("('{}', '{}')".format(t, " ".join(words(x))) for t, x in (templates or TEMPLATES).items())
    pairs = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH t AS (SELECT template, {pairs} AS wanted FROM (SELECT col0 AS template, string_split(col1, ' ') AS w FROM (VALUES {rows}))),
units AS (
  SELECT doc_id, unit FROM (
    SELECT doc_id, text, unnest(list_distinct(list_concat(string_split(text, chr(10)), regexp_split_to_array(text, '\\n\\s*\\n'), [text]))) AS unit
    FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL))
), held AS (
  SELECT doc_id, {pairs} AS held FROM (
    SELECT doc_id, string_split(trim(regexp_replace(lower(unit), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w FROM units) WHERE len(w) > 1
), scored AS (
  SELECT doc_id, template, 2 * len(list_intersect(held, wanted))::DOUBLE / (len(held) + len(wanted)) AS dice FROM held, t
  WHERE len(held) BETWEEN len(wanted) * {least} / (2 - {least}) - 1 AND len(wanted) * (2 - {least}) / {least} + 1
)
SELECT doc_id, template, max(dice) AS dice, count(*) AS units FROM scored WHERE dice >= {least} GROUP BY doc_id, template
"""
