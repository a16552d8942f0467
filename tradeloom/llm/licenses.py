"""License scans: normalised text compared with licence templates by the Dice coefficient over word bigrams.

Units of a document are its lines, its paragraphs (between empty lines) and the whole text. A unit meets only those
templates whose number of bigrams allows the threshold: with sizes a and b the coefficient is at most
2 min(a, b) / (a + b), so b must lie within a t / (2 - t) and a (2 - t) / t. Everything is DataFrame functions inside
the document's row; nothing is shuffled, and the templates are literals.

A licence need not be a unit: its text may run over several paragraphs or share its lines with others. So templates and
full licence texts are also compared with runs of consecutive words of the whole text. A run that reaches the threshold
t holds at least b t / (2 - t) of a template's b distinct bigrams; only texts that hold as many are looked at further.
One more template bigram at an end never lowers the coefficient, so a run begins and ends where a stretch of template
bigrams does, and is no longer than the template's own bigrams times (2 - t) / t. It does not begin at a stretch that
loses by being cut off from the one before: where the former's bigrams that never come later are more than the words between,
each run from there is better. So an edited licence has few beginnings, and one pass from each finds its best end. Of
runs that overlap the best is taken. A licence that no unit matches, but such a run, counts as one match.

Defined results: null and empty texts, and units of fewer than two words, match nothing; ties go to the template first
in the list, then to the run that begins first, then to the shorter; repeated rows are judged one by one; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import words
from tradeloom.llm.license_texts import TEXTS

#: Public licence texts and notices. Placeholders for years and holders are left out.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE
SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
License for more details. You should have received a copy of the GNU General Public License along with this program. If
not, see <https://www.gnu.org/licenses/>."""),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be
used to endorse or promote products derived from this software without specific prior written permission."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,
for any purpose, commercial or non-commercial, and by any means."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
)


@dataclass(frozen=True)
class Template:
    license: str
    bigrams: tuple[str, ...]
    low: int
    high: int


def bigrams_of(text: str) -> tuple[str, ...]:
    """The distinct word bigrams of a normalised text, as the DataFrame form makes them."""
    found = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    return tuple(dict.fromkeys(f"{a} {b}" for a, b in zip(found, found[1:])))


def prepared(templates=TEMPLATES, threshold: float = 0.8) -> list[Template]:
    out = []
    for name, text in templates:
        own = bigrams_of(text)
        sizes = [n for n in range(1, 4 * len(own) + 2) if 2 * min(n, len(own)) >= threshold * (n + len(own)) - 1e-9]
        out.append(Template(name, own, min(sizes), max(sizes)))
    return out


def _pairs(unit: Column) -> Column:
    """Bigrams of a unit in order; letters and digits of ASCII make its words, as in every template."""
    return F.transform(F.slice(unit, 1, F.greatest(F.size(unit) - 1, F.lit(0))), lambda x, i: F.concat(x, F.lit(" "), unit[i + 1]))


def _bigrams(unit: Column) -> Column:
    return F.array_distinct(_pairs(unit))


MATCH = "array<struct<dice:double,order:int,license:string,first:int,last:int>>"


def _listed(bigrams) -> str:
    return ", ".join(f"'{b}'" for b in bigrams)  # letters, digits and a space only


def _need(own, threshold: float) -> int:
    """How many of a template's distinct bigrams a match holds at least."""
    return math.ceil(threshold * len(own) / (2 - threshold) - 1e-9)


def _holds(own, threshold: float) -> Column:
    """Whether `seen` holds as many of a template's bigrams as a match does."""
    need = _need(own, threshold)
    return F.expr(f"size(seen) >= {need} AND size(array_intersect(seen, split('{'|'.join(own)}', '[|]'))) >= {need}")


def _linked(frame: DataFrame) -> DataFrame:
    """Adds `links`: for each place p of `bigrams`, where its bigram stood before (-1: nowhere) and whether it comes
    again. Only for texts that are looked at further."""
    frame = frame.withColumn("sorted", F.expr("CASE WHEN likely THEN sort_array(transform(bigrams, (b, p) -> struct(b, p))) END"))
    return frame.withColumn(
        "links",
        F.expr(
            "sort_array(transform(sorted, (e, j) -> struct(e.p AS p, IF(get(sorted, j - 1).b = e.b, get(sorted, j - 1).p, -1) AS before,"
            " coalesce(get(sorted, j + 1).b = e.b, false) AS again)))"
        ),
    ).drop("sorted")


def _runs(template: tuple[str, str], order: int, threshold: float) -> Column:
    """The best run of each beginning in `bigrams` (the whole text's, in order) that reaches the threshold, if `seen`
    (those in any template) holds enough of this one's."""
    name, text = template
    own = bigrams_of(text)
    need = _need(own, threshold)
    total = len(re.sub(r"[^a-z0-9]+", " ", text.lower()).split()) - 1
    longest = math.floor(total * (2 - threshold) / threshold + 1e-9)
    # held: whether a place holds a template bigram; hits: the places that do; stretches: the first place of each
    # stretch of hits (p) and its number among the hits (i). A place counts as distinct in a run that begins at s.p if
    # its bigram did not stand between s.p and it. Places of the result are negative where the smaller is to win.
    value = f"2.0D * (a.x + IF(e.before < s.p AND held[e.p], 1, 0)) / (a.d + IF(e.before < s.p, 1, 0) + {len(own)})"
    ends = "held[e.p] AND NOT coalesce(get(held, e.p + 1), false)"
    # The hits from the stretch before on that come nowhere later, against the places between that are none: the former
    # alone, if more, make any run longer by that stretch a better one.
    gain = "size(filter(slice(hits, r.i + 1, s.i - r.i), p -> NOT links[p].again)) - (s.p - r.p - (s.i - r.i))"
    reach = f"element_at(filter(slice(hits, s.i + 1, {longest}), p -> p - s.p < {longest}), -1)"
    return F.expr(f"""
        CASE WHEN size(seen) >= {need} AND size(array_intersect(seen, split('{'|'.join(own)}', '[|]'))) >= {need} THEN
        filter(flatten(transform(array(transform(bigrams, b -> b IN ({_listed(own)}))), held ->
          flatten(transform(array(filter(transform(held, (h, p) -> IF(h, p, -1)), p -> p >= 0)), hits ->
            flatten(transform(
              array(filter(transform(hits, (p, i) -> struct(p AS p, i AS i)), e -> coalesce(get(hits, e.i - 1) <> e.p - 1, true))),
              stretches -> transform(
                filter(transform(stretches, (s, k) -> struct(s.p AS p, s.i AS i, get(stretches, k - 1) AS r)), s ->
                  coalesce(get(hits, s.i + {need - 1}) - s.p < {longest}, false)
                  AND NOT coalesce(transform(array(s.r), r -> {gain} > 0 AND {reach} - r.p < {longest})[0], false)),
                s -> aggregate(
                  slice(links, s.p + 1, {longest}),
                  struct(0 AS x, 0 AS d, 0.0D AS dice, s.p AS last),
                  (a, e) -> struct(
                    a.x + IF(e.before < s.p AND held[e.p], 1, 0) AS x, a.d + IF(e.before < s.p, 1, 0) AS d,
                    IF({ends}, greatest(a.dice, {value}), a.dice) AS dice,
                    IF({ends}, IF({value} > a.dice, e.p, a.last), a.last) AS last),
                  a -> struct(a.dice AS dice, {-order} AS `order`, '{name}' AS license, -s.p AS first, -a.last AS last)))))))
        )), m -> m.dice >= {threshold!r}D) END""").cast(MATCH)


def scan(documents: DataFrame, threshold: float = 0.8, templates=TEMPLATES, texts=TEXTS) -> DataFrame:
    """One row per document: doc_id, license (its best match or null), dice (of that match, 0 if none), n_matches (how
    many of its units match a template, and licences that only runs match) and licenses (all that match, each once).
    Units are compared with `templates`, runs with `texts` too."""
    known = prepared(templates, threshold)
    low, high = min(t.low for t in known), max(t.high for t in known)
    text = F.lower(F.coalesce("text", F.lit("")))
    # A unit's words follow each other in the whole text, so its bigrams are among those of the text: one that holds too
    # few bigrams of each template has no match, and its units are never made.
    whole = [*templates, *texts]
    owns = [bigrams_of(t) for _, t in whole]
    every = _listed(dict.fromkeys(b for own in owns for b in own))
    normal = lambda u: words(F.regexp_replace(u, "[^a-z0-9]+", " "))
    frame = documents.select("doc_id", text.alias("t")).withColumn("w", normal(F.col("t")))
    frame = frame.select("doc_id", "t", _pairs(F.col("w")).alias("bigrams"))
    frame = frame.withColumn("seen", F.expr(f"array_distinct(filter(bigrams, b -> b IN ({every})))"))
    frame = frame.withColumn("likely", reduce(or_, (_holds(own, threshold) for own in owns)))
    units = F.array_distinct(F.concat(F.split("t", "\n"), F.split("t", r"\n[ \t\x0b\f\r]*\n")))
    # Distinct bigrams are at most the words less one; a unit of too few words cannot reach any template. Repeated
    # bigrams make a long unit small, so only the lower bound can be told before they are counted.
    lists = F.filter(F.transform(F.array_remove(units, F.col("t")), normal), lambda u: F.size(u) > low)
    frame = _linked(frame).select(
        "doc_id", "bigrams", "seen", "likely", "links",
        F.when(F.col("likely"), F.concat(F.transform(lists, _bigrams), F.array(F.array_distinct("bigrams")))).alias("units"),
    )
    sized = F.filter("units", lambda b: (F.size(b) >= low) & (F.size(b) <= high))
    frame = frame.withColumn("units", F.coalesce(sized, F.array().cast("array<array<string>>")))

    def dice(unit: Column, template: Template) -> Column:
        own = F.array(*(F.lit(b) for b in template.bigrams))
        value = 2.0 * F.size(F.array_intersect(unit, own)) / (F.size(unit) + len(template.bigrams))
        return F.when(F.size(unit).between(template.low, template.high), value).otherwise(0.0)

    def best(unit: Column) -> Column:
        scores = [F.struct(dice(unit, t).alias("dice"), F.lit(-i).alias("order"), F.lit(t.license).alias("license")) for i, t in enumerate(known)]
        return F.greatest(*scores)

    none = F.array().cast(MATCH)
    runs = F.concat(*(F.coalesce(_runs(t, i, threshold), none) for i, t in enumerate(whole)))
    frame = frame.select(
        "doc_id",
        F.filter(F.transform("units", best), lambda m: m["dice"] >= threshold).alias("matches"),
        F.when(F.col("likely"), runs).otherwise(none).alias("runs"),
    )
    apart = lambda taken, m: ~F.exists(taken, lambda t: (-m["first"] <= -t["last"]) & (-t["first"] <= -m["last"]))
    best_apart = F.aggregate(F.sort_array("runs", asc=False), none, lambda taken, m: F.when(apart(taken, m), F.array_append(taken, m)).otherwise(taken))
    frame = frame.select("doc_id", "matches", best_apart.alias("runs"))
    # Of the runs of one licence the first, which is the best.
    fresh = F.filter("runs", lambda m, i: ~F.exists("matches", lambda u: u["license"] == m["license"]) & ~F.exists(F.slice("runs", 1, i), lambda r: r["license"] == m["license"]))
    more = F.transform(fresh, lambda m: F.struct(m["dice"].alias("dice"), m["order"].alias("order"), m["license"].alias("license")))
    frame = frame.select("doc_id", F.concat("matches", more).alias("matches"))
    top = F.array_max("matches")
    return frame.select(
        "doc_id",
        top["license"].alias("license"),
        F.coalesce(top["dice"], F.lit(0.0)).alias("dice"),
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"]))), ",").alias("licenses"),
    )
