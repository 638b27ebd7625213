"""Licence texts in documents, by Dice coefficient over word bigrams.

A text is normalised (lower case, everything but letters and digits of ASCII to single spaces) and looked at through
windows of consecutive words, wherever they begin: a notice is found in the middle of a line, spread over paragraphs, or
with words put in, left out or replaced. Two sets of a and b bigrams can only reach a Dice coefficient of t if a lies
between b t / (2 - t) and b (2 - t) / t, and if they have at least b t / (2 - t) bigrams in common. So a text meets those
templates alone with which it has that many in common, and a window of a template

- begins with a bigram of the template (without another one at its front, the coefficient is no smaller),
- has the needed number of bigrams in common within the largest admitted length, which is counted in places, so that an
  exact copy of a template that repeats a bigram still fits.

From such a beginning all ends are tried in one walk that counts distinct bigrams. A long text is cut into parts that
overlap by the largest length, so work and memory per row do not depend on the length of the text.

One of the needed bigrams holds one of any words that more than the rest of the template's bigrams hold; a text without any
such word of any template is left before its bigrams are made.
"""

import math
import re
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardsentry.session import small_table

DICE = 0.8
PART = 1024  # places where windows begin in one part of a text
VOWEL = re.compile("[aeiouy]")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Wording of public licence notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
]


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), "[^a-z0-9]+", " "))


def bigrams(words: Column) -> Column:
    """Neighbouring pairs of an array of words, in order."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat_ws(" ", a, b))


def pairs_of(text: str) -> list[str]:
    kept = [c if c.isascii() and c.isalnum() else " " for c in text.lower()]
    words = "".join(kept).split()
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def bigrams_of(text: str) -> set[str]:
    return set(pairs_of(text))


def bounds(text: str, dice: float) -> tuple[int, int]:
    """(bigrams that a window must have in common with the template, places it may have at most)."""
    least = math.ceil(len(bigrams_of(text)) * dice / (2 - dice) - 1e-9)
    return max(least, 1), math.floor(len(pairs_of(text)) * (2 - dice) / dice + 1e-9)


def telling_words(templates: list[tuple[str, str]], dice: float) -> list[str]:
    """For every template its longest words, as many as more bigrams hold than may be missing; of equally long ones first
    those without a vowel, which are rarer."""
    out: set[str] = set()
    for _, text in templates:
        left = bigrams_of(text)
        b = len(left)
        for word in sorted({w for pair in left for w in pair.split()}, key=lambda w: (-len(w), bool(VOWEL.search(w)), w)):
            if b - len(left) > b - b * dice / (2 - dice) + 1e-9:
                break
            out.add(word)
            left = {pair for pair in left if word not in pair.split()}
    return sorted(out)


def best_end(piece: Column, n: Column) -> Column:
    """(dice, places) of the best of the windows that begin where ``piece`` does, the shortest of equals. ``piece`` holds a
    positive number for a bigram of the template of ``n`` bigrams, a negative one for others."""
    fresh = F.transform(
        piece, lambda x, i: F.struct((x > 0).cast("int").alias("hit"), (F.array_position(piece, x) == i + 1).cast("int").alias("new"))
    )
    start = F.struct(*(F.lit(0).alias(c) for c in ("places", "common", "size", "at")), F.lit(0.0).alias("dice"))

    def step(acc: Column, x: Column) -> Column:
        common, size = acc["common"] + x["hit"] * x["new"], acc["size"] + x["new"]
        dice = 2 * common / (size + n)
        better = dice > acc["dice"]
        return F.struct(
            (acc["places"] + 1).alias("places"),
            common.alias("common"),
            size.alias("size"),
            F.when(better, acc["places"] + 1).otherwise(acc["at"]).alias("at"),
            F.when(better, dice).otherwise(acc["dice"]).alias("dice"),
        )

    return F.aggregate(fresh, start, step, lambda acc: F.struct(acc["dice"].alias("dice"), acc["at"].alias("places")))


def spans(docs: DataFrame, dice: float = DICE, templates: list[tuple[str, str]] | None = None, part: int = PART) -> DataFrame:
    """The best window per doc_id of ``docs(doc_id, text)`` and template that reaches ``dice``: doc_id, template (its
    place in the list), licence, dice, first_word (from 0, in the normalised text) and n_words. Of equally good windows
    the first, then the shortest. Null and empty texts have none; the texts of one doc_id are searched one by one."""
    templates = TEMPLATES if templates is None else templates
    limits = [bounds(t, dice) for _, t in templates]
    bags = [sorted(bigrams_of(t)) for _, t in templates]
    table = small_table(
        docs.sparkSession,
        [(i, name, bag, len(bag), *ends) for i, ((name, _), bag, ends) in enumerate(zip(templates, bags, limits, strict=True))],
        "template int, licence string, bag array<string>, n int, least int, longest int",
    )
    marks = defaultdict(list)
    for word in telling_words(templates, dice):
        marks[word[0]].append(word[1:])
    pattern = "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in marks.items())  # one branch a letter
    told = docs.where(F.translate("text", UPPER, LOWER).rlike(pattern or "$^"))
    words = told.select("doc_id", F.split(normal(F.col("text")), " ").alias("words"))
    own = words.select("doc_id", bigrams(F.col("words")).alias("own")).withColumn("known", F.array_distinct("own"))
    held = [
        F.when(F.size(F.array_intersect("known", F.array(*map(F.lit, bag)).cast("array<string>"))) >= least, F.lit(i))
        for i, (bag, (least, _)) in enumerate(zip(bags, limits, strict=True))
    ]
    fit = F.filter(F.array(*held).cast("array<int>"), lambda t: t.isNotNull())
    near = own.select("doc_id", "own", F.explode(fit).alias("template"))
    near = near.join(F.broadcast(table), "template")  # one row a template

    def number(x: Column) -> Column:
        at = F.array_position("bag", x)
        return F.when(at > 0, at).otherwise(-1 - F.abs(F.shiftright(F.xxhash64(x), 1)))

    keep = ["doc_id", "template", "licence", "n", "least", "longest"]
    numbered = near.select(*keep, F.transform("own", number).alias("ids"))
    offsets = F.sequence(F.lit(0), F.size("ids") - 1, F.lit(part))
    cut = F.transform(offsets, lambda o: F.struct(o.alias("offset"), F.slice("ids", o + 1, F.col("longest") + part - 1).alias("ids")))
    parts = numbered.select(*keep, F.explode(cut).alias("p")).select(*keep, "p.offset", "p.ids")
    places = F.filter(F.transform("ids", lambda x, i: F.when(x > 0, i + 1)), lambda i: i.isNotNull())
    parts = parts.withColumn("at", places)
    # the place of a bigram in common, where enough of them follow within the largest length
    begins = F.zip_with(
        "at", F.slice("at", F.col("least"), F.size("at")), lambda a, b: F.when((b - a < F.col("longest")) & (a <= part), a)
    )
    parts = parts.withColumn("begins", F.filter(begins, lambda a: a.isNotNull()))
    pieces = F.transform("begins", lambda a: F.struct(a.alias("at"), F.slice("ids", a, F.col("longest")).alias("piece")))
    windows = parts.select(*keep, "offset", F.explode(pieces).alias("w"))
    windows = windows.select(*keep, (F.col("offset") + F.col("w.at") - 1).alias("first"), F.col("w.piece").alias("piece"))
    ends = windows.select("doc_id", "template", "licence", "first", best_end(F.col("piece"), F.col("n")).alias("e"))
    hits = ends.where(F.col("e.dice") >= dice)
    order = F.struct("e.dice", (-F.col("first")).alias("first"), (-F.col("e.places")).alias("places"))
    best = hits.groupBy("doc_id", "template", "licence").agg(F.max(order).alias("b"))
    return best.select(
        "doc_id",
        "template",
        "licence",
        F.col("b.dice").alias("dice"),
        (-F.col("b.first")).alias("first_word"),
        (1 - F.col("b.places")).alias("n_words"),
    )


def scan(docs: DataFrame, dice: float = DICE, templates: list[tuple[str, str]] | None = None, part: int = PART) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, licences (ids in order, comma-joined, empty if none), n_matches
    (templates that a window matches at ``dice`` or more), best_dice (0 if none) and best_licence (null if none; the first
    id among equals).

    Null and empty texts match nothing. Rows of the same doc_id are one document: their matches are pooled and the row is
    returned once; null ids are one too. An empty table gives an empty one; other columns are ignored.
    """
    hits = spans(docs, dice, templates, part).select("doc_id", "template", "licence", "dice")
    nothing = {"template": "int", "licence": "string", "dice": "double"}
    every = docs.select("doc_id", *(F.lit(None).cast(t).alias(c) for c, t in nothing.items()))
    best = F.min(F.when(F.col("licence").isNotNull(), F.struct((-F.col("dice")).alias("d"), "licence")))
    return (
        hits.union(every)
        .groupBy("doc_id")
        .agg(
            F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("licences"),
            F.count("template").alias("n_matches"),
            F.round(F.coalesce(F.max("dice"), F.lit(0.0)), 6).alias("best_dice"),
            best.alias("best"),
        )
        .select("doc_id", "licences", "n_matches", "best_dice", F.col("best.licence").alias("best_licence"))
    )


def scan_sql(dice: float = DICE, templates: list[tuple[str, str]] | None = None) -> str:
    """The same in SQL, over the view ``documents``: every window of an admitted length of every text that has enough
    bigrams in common with the template."""
    templates = TEMPLATES if templates is None else templates
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    normal_sql = lambda x: f"trim(regexp_replace(translate({x}, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'))"
    pairs = lambda w: f"[{w}[i] || ' ' || {w}[i + 1] FOR i IN range(1, len({w}))]"
    values = ", ".join(f"({i}, {quoted(name)}, {quoted(t)})" for i, (name, t) in enumerate(templates))
    split = lambda x: f"string_split({normal_sql(x)}, ' ')"
    return f"""WITH t0 AS (SELECT template, licence, {split("text")} w FROM (VALUES {values}) v(template, licence, text)),
t1 AS (SELECT template, licence, {pairs("w")} own FROM t0),
t AS (SELECT template, licence, list_distinct(own) bag,
 greatest(ceil(len(list_distinct(own)) * {dice!r}::DOUBLE / (2 - {dice!r}::DOUBLE) - 1e-9), 1)::BIGINT least,
 floor(len(own) * (2 - {dice!r}::DOUBLE) / {dice!r}::DOUBLE + 1e-9)::BIGINT longest FROM t1),
u0 AS (SELECT doc_id, {split("text")} w FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, {pairs("w")} own FROM u0),
near AS (SELECT doc_id, template, licence, own, bag, least, longest FROM u, t
 WHERE len(list_intersect(list_distinct(own), bag)) >= least),
begins AS (SELECT *, unnest(range(1, len(own) + 1)) s FROM near),
ends AS (SELECT *, unnest(range(least, longest + 1)) n FROM begins),
windows AS (SELECT doc_id, template, licence, bag, list_distinct(own[s:s + n - 1]) seen FROM ends WHERE s + n - 1 <= len(own)),
hits AS (SELECT doc_id, template, licence, max(2 * len(list_intersect(seen, bag))::DOUBLE / (len(seen) + len(bag))) dice
 FROM windows GROUP BY ALL),
a AS (SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) licences, count(*) n_matches, max(dice) best_dice,
 first(licence ORDER BY dice DESC, licence) best_licence
 FROM hits WHERE dice >= {dice!r} GROUP BY doc_id)
SELECT d.doc_id, coalesce(licences, '') licences, coalesce(n_matches, 0)::BIGINT n_matches,
 round(coalesce(best_dice, 0::DOUBLE), 6) best_dice, best_licence
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN a ON d.doc_id IS NOT DISTINCT FROM a.doc_id"""
