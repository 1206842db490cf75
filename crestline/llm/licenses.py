"""Licence scan: text compared to licence templates by Dice over word bigrams.

Units compared are the whole text, its lines and its sentences, and windows of words: wherever one of
the ``ANCHORS`` longest words that stand once in a template is found, as many words as the template has,
placed so that the word is where it is in the template.  Windows know no line ends and no comment
marks, so they find notices wrapped inside other text.  A unit is normalised (letters
A-Z lowered, all but a-z and 0-9 turned into single blanks); A and B being the distinct word
bigrams of unit and template, Dice = 2 |A n B| / (|A| + |B|).  At a threshold t only templates
with t / (2 - t) <= |A| / |B| <= (2 - t) / t can pass: other templates are not compared.  A
passing unit, which is not a window, also shares more than a fixed share of the template's bigrams, so it holds a word
of any set of bigrams that leaves fewer than that; units without such a word are never cut.

The templates are constants of this module, so the plan has no join and no shuffle: one scan.

Texts are read whole, however long; only the named columns are read, whatever others are called.

Defined cases: null or empty text, or text of a single word, has no licence; a unit equally near
to two templates counts for the first in the list; repeated rows each give their row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.llm.common import read_table

THRESHOLD = 0.8
ANCHORS = 3

# Notices as the licences and their users word them.
TEMPLATES: dict[str, str] = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "mit": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "mit-license": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "isc-license": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE "
        "COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS "
        "OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY "
        "WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.translate(str.maketrans(UPPER, LOWER)))


def anchors() -> dict[str, list[tuple[int, int, int]]]:
    """Word: the templates it is an anchor of, its place there, and their words."""
    found: dict[str, list[tuple[int, int, int]]] = {}
    for n, text in enumerate(TEMPLATES.values()):
        words = words_of(text)
        once = sorted((w for w in words if words.count(w) == 1), key=lambda w: -len(w))
        for w in once[:ANCHORS]:
            found.setdefault(w, []).append((n, words.index(w), len(words)))
    return found


def bigrams(text: str) -> list[str]:
    words = words_of(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def trigger_words(threshold: float) -> list[str]:
    """Words of which every unit that passes holds one.

    Of |B| bigrams a passing unit shares at least t |B| / (2 - t), so it holds one of any
    |B| - that + 1 of them; those with the longest words are taken, and the longer word of each.
    """
    words: set[str] = set()
    for text in TEMPLATES.values():
        own = bigrams(text)
        need = -(-int(len(own) * threshold / (2 - threshold) * 1e9) // 10**9) or 1
        own.sort(key=lambda b: -max(map(len, b.split())))
        words |= {max(b.split(), key=len) for b in own[: len(own) - need + 1]}
    return sorted(w for w in words if not any(v in w and v != w for v in words))


def _words(unit: Column) -> Column:
    clean = F.regexp_replace(F.translate(unit, UPPER, LOWER), "[^a-z0-9]+", " ")
    return F.split(F.trim(clean), " ")


def _bigrams(words: Column) -> Column:
    pairs = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: key, numbers of licence units and windows, licences, best dice."""
    templates = F.array(*[
        F.struct(F.lit(i).alias("n"), F.lit(name).alias("name"), F.array(*[F.lit(b) for b in bigrams(t)]).alias("grams"))
        for i, (name, t) in enumerate(TEMPLATES.items())
    ])
    body = F.coalesce(F.col(text), F.lit(""))
    holds = lambda c: F.lower(c).rlike("|".join(trigger_words(threshold)))
    small = F.lower(body)
    some = F.lit(False)
    for w in trigger_words(threshold):
        some = some | small.contains(w)
    sentences = F.split(F.regexp_replace(body, "([.!?])[ \t\r\n]+", "$1\n"), "\n")
    units = F.array_distinct(F.concat(F.array(body), F.split(body, "\n"), sentences))
    units = F.when(some, F.filter(units, holds)).otherwise(F.array().cast("array<string>"))

    def best(unit_grams: Column) -> Column:
        n = F.size(unit_grams)
        near = F.filter(
            templates,
            lambda t: (n >= F.size(t["grams"]) * (threshold / (2 - threshold))) & (n <= F.size(t["grams"]) * ((2 - threshold) / threshold)),
        )
        scored = F.transform(
            near,
            lambda t: F.struct(
                (-2.0 * F.size(F.array_intersect(unit_grams, t["grams"])) / (n + F.size(t["grams"]))).alias("d"),
                t["n"].alias("n"), t["name"].alias("name"),
            ),
        )
        return F.array_min(scored)

    hits = F.filter(F.transform(F.transform(F.col("units"), lambda u: _bigrams(_words(u))), best), lambda b: b["d"] <= -threshold)

    known = anchors()
    places = F.create_map(*[
        x for word, of in known.items()
        for x in (F.lit(word), F.array(*[F.struct(F.lit(n).alias("n"), F.lit(o).alias("o"), F.lit(size).alias("size")) for n, o, size in of]))
    ])
    holds_anchor = F.lit(False)
    for w in known:
        holds_anchor = holds_anchor | small.contains(w)
    words = F.when(holds_anchor, _words(body)).otherwise(F.array().cast("array<string>"))
    marked = F.filter(
        F.transform(F.col("words"), lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(*known)
    )
    starts = lambda x: F.transform(
        F.element_at(places, x["w"]),
        lambda a: F.struct(a["n"].alias("n"), F.greatest(x["i"] - a["o"] + 1, F.lit(1)).alias("start"), a["size"].alias("size")),
    )
    windows = F.array_distinct(F.flatten(F.transform(marked, starts)))

    def compared(x: Column) -> Column:
        own, template = _bigrams(F.slice(F.col("words"), x["start"], x["size"])), F.element_at(templates, x["n"] + 1)
        dice = -2.0 * F.size(F.array_intersect(own, template["grams"])) / (F.size(own) + F.size(template["grams"]))
        return F.struct(dice.alias("d"), x["n"].alias("n"), template["name"].alias("name"))

    near = F.filter(F.transform(windows, compared), lambda b: b["d"] <= -threshold)
    found = docs.select(F.col(key).alias("key"), units.alias("units"), words.alias("words")).select(
        "key", hits.alias("hits"), near.alias("near")
    )
    both = F.concat("hits", "near")
    return found.select(
        "key",
        F.size("hits").cast("long").alias("n_units"),
        F.size("near").cast("long").alias("n_windows"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(both, lambda h: h["name"]))), ",").alias("licenses"),
        F.round(-F.array_min(F.transform(both, lambda h: h["d"])), 6).alias("best_dice"),
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents").select("doc_id", "text")).withColumnRenamed("key", "doc_id")


def _sql_templates() -> str:
    rows = [
        f"({i}, '{name}', [{', '.join(repr(b) for b in bigrams(t))}])" for i, (name, t) in enumerate(TEMPLATES.items())
    ]
    return ", ".join(rows)


def _sql_anchors() -> str:
    return ", ".join(f"('{w}', {n}, {o}, {size})" for w, of in anchors().items() for n, o, size in of)


# Every unit against every template of fitting size, without looking for trigger words.
LICENSES_SQL = f"""
WITH templates(n, name, grams) AS (VALUES {_sql_templates()}),
anchors(word, n, place, size) AS (VALUES {_sql_anchors()}),
bodies AS (
  SELECT row_number() OVER () AS r, doc_id,
         string_split(trim(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')), ' ') AS words
  FROM documents
), marks AS (
  SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM bodies
), windows AS (
  SELECT DISTINCT r, n, greatest(p - place, 1) AS s, size FROM marks JOIN anchors USING (word)
), held AS (
  SELECT r, doc_id, n, s, words[s:s + size - 1] AS v FROM windows JOIN bodies USING (r)
), near AS (
  SELECT r, doc_id, name,
         2.0 * len(list_intersect(own, grams)) / CAST(len(own) + len(grams) AS DOUBLE) AS dice
  FROM (SELECT *, list_distinct(list_transform(range(1, len(v)), lambda i: v[i] || ' ' || v[i + 1])) AS own FROM held)
  JOIN templates USING (n)
  WHERE dice >= {THRESHOLD}
),
u AS (
  SELECT doc_id, unnest(list_distinct(list_concat([body], string_split(body, chr(10)),
         string_split(regexp_replace(body, '([.!?])[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), chr(10))))) AS unit
  FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)
), w AS (
  SELECT doc_id, row_number() OVER () AS id,
         string_split(trim(regexp_replace(translate(unit, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w
  FROM u
), g AS (
  SELECT doc_id, id, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams
  FROM w WHERE len(w) > 1
), d AS (
  SELECT doc_id, id, n, name,
         2.0 * len(list_intersect(g.grams, t.grams)) / CAST(len(g.grams) + len(t.grams) AS DOUBLE) AS dice
  FROM g JOIN templates t
    ON len(g.grams) >= len(t.grams) * {THRESHOLD / (2 - THRESHOLD)!r} AND len(g.grams) <= len(t.grams) * {(2 - THRESHOLD) / THRESHOLD!r}
  WHERE list_has_any(g.grams, t.grams)
), hits AS (
  SELECT * FROM d WHERE dice >= {THRESHOLD} QUALIFY row_number() OVER (PARTITION BY id ORDER BY dice DESC, n) = 1
), per AS (
  SELECT doc_id, count(*) FILTER (unit) AS n_units, count(*) FILTER (NOT unit) AS n_windows,
         list_sort(list_distinct(list(name))) AS names, round(max(dice), 6) AS best
  FROM (SELECT doc_id, name, dice, TRUE AS unit FROM hits UNION ALL SELECT doc_id, name, dice, FALSE FROM near) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_units, 0) AS n_units, coalesce(n_windows, 0) AS n_windows, coalesce(array_to_string(names, ','), '') AS licenses, best AS best_dice
FROM documents LEFT JOIN per USING (doc_id)"""
