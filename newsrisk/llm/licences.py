"""Licence scans, in DataFrame operations only.

Every line of a text is normalised (A-Z in lower case, anything but a-z and 0-9 a blank) and
compared with licence templates by the Dice coefficient of the sets of word bigrams.  Sizes
come first: a set of n bigrams can only reach ``PERCENT`` with templates of between
n * P / (200 - P) and n * (200 - P) / P bigrams, and only if as many of its bigrams occur in
any template.  What is left is compared with the templates of fitting size; the best match
is kept, the first name of equal ones.  All of it happens within the row.

``spans`` scans texts as a whole instead, across lines and within them, also for the full
texts of licences.  Its windows run from where a run of a template's bigrams starts to where
one ends: whatever else reaches ``PERCENT`` gains, or loses nothing, by being carried on or
cut back to these.  Every line that ``scan`` reports thus overlaps a span.

A missing or empty text and a line of fewer than two words match nothing.  Rows that repeat
a doc_id are scanned one by one.  Extra columns do not matter.
"""

from __future__ import annotations

import pkgutil
import re

from pyspark.sql import Column, DataFrame, functions as F

PERCENT = 80
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Notices as their licences word them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "Apache-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is '
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
)

#: Licences with a full text in ``licence_texts``.
BODIES = (
    "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0",
    "MIT", "MPL-2.0",
)


def whole_templates() -> tuple[tuple[str, str], ...]:
    """The notices and the full texts."""
    text = lambda name: pkgutil.get_data(__package__, f"licence_texts/{name}.txt").decode()
    return (*TEMPLATES, *((name, text(name)) for name in BODIES))


def template_bigrams(text: str) -> list[str]:
    """The distinct word bigrams of a template, normalised as lines are."""
    words = re.sub("[^a-z0-9]+", " ", text.translate({ord(c): c.lower() for c in UPPER})).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def words_of(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.translate(text, UPPER, UPPER.lower()), "[^a-z0-9]+", " ")), " ")


def line_bigrams(line: Column) -> Column:
    words = words_of(line)
    pairs = F.zip_with(
        F.slice(words, 1, F.size(words) - 1),
        F.slice(words, 2, F.size(words) - 1),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.when(F.size(words) > 1, F.array_distinct(pairs))


def scan(docs: DataFrame, templates=TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """(doc_id, line, licence, dice) for every line that matches a template.

    ``line`` counts from 0.  The templates become literals of the plan: they are few.
    """
    known = sorted((name, template_bigrams(text)) for name, text in templates)
    known = [(name, grams) for name, grams in known if grams]
    every = sorted({g for _, grams in known for g in grams})
    low = min(len(g) for _, g in known) * percent / (200 - percent)
    high = max(len(g) for _, g in known) * (200 - percent) / percent
    table = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(len(grams)).alias("size"), F.lit(grams).alias("grams"))
            for name, grams in known
        ]
    )
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "content"))
    sized = lines.select("doc_id", "line", line_bigrams(F.col("content")).alias("grams"))
    n = F.size("grams")
    fit = sized.where(n.between(low, high)).withColumn("n", n)
    # Whatever template it is, so many bigrams must be common to both.
    fit = fit.where((200 - percent) * F.size(F.array_intersect("grams", F.lit(every))) >= percent * F.col("n"))
    fitting = F.filter(
        table,
        lambda t: ((200 - percent) * t["size"] >= percent * F.col("n"))
        & (percent * t["size"] <= (200 - percent) * F.col("n")),
    )
    scored = F.transform(
        fitting,
        lambda t: F.struct(
            (2 * F.size(F.array_intersect(F.col("grams"), t["grams"])) / (F.col("n") + t["size"])).alias("dice"),
            t["name"].alias("licence"),
        ),
    )
    top = F.array_max(F.transform(scored, lambda s: s["dice"]))
    best = F.array_min(F.transform(F.filter(scored, lambda s: s["dice"] == top), lambda s: s["licence"]))
    found = fit.select("doc_id", "line", best.alias("licence"), top.alias("dice"))
    return found.where(F.col("dice") >= percent / 100)


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def windows(grams: Column, t: Column, percent: int) -> Column:
    """(common, dice, name, start, end) of all windows of ``grams`` that reach ``percent`` with t.

    A matching window has at most ``most`` distinct bigrams.  Where 3 * size bigrams hold more,
    no longer window of that start needs to be tried.
    """
    most, far = t["size"] * (200 - percent) / percent, 3 * t["size"]
    size = F.size(grams)

    def ending(s: Column, ends: Column) -> Column:
        short = F.size(F.array_distinct(F.slice(grams, s["at"] + 1, far))) > most
        return let(
            F.when(short, s["at"] + far).otherwise(size),
            lambda stop: F.transform(
                # As many bigrams of the template must lie between start and end.
                F.filter(
                    ends,
                    lambda e: (e["at"] < stop)
                    & ((200 - percent) * (e["nth"] - s["nth"] + 1) >= percent * t["size"]),
                ),
                lambda e: let(
                    F.array_distinct(F.slice(grams, s["at"] + 1, e["at"] - s["at"] + 1)),
                    lambda g: let(
                        F.size(F.array_intersect(g, t["grams"])),
                        lambda c: F.struct(
                            (-c).alias("common"), (-2 * c / (F.size(g) + t["size"])).alias("dice"),
                            t["name"].alias("name"), s["at"].alias("start"), (-e["at"]).alias("end"),
                        ),
                    ),
                ),
            ),
        )

    def runs(places: Column) -> Column:
        at = F.transform(places, lambda x, k: F.struct(x.alias("at"), k.alias("nth")))
        starts = F.filter(at, lambda x: F.coalesce(F.get(places, x["nth"] - 1) < x["at"] - 1, F.lit(True)))
        ends = F.filter(at, lambda x: F.coalesce(F.get(places, x["nth"] + 1) > x["at"] + 1, F.lit(True)))
        return let(ends, lambda e: F.flatten(F.transform(starts, lambda s: ending(s, e))))

    places = F.filter(F.sequence(F.lit(0), size - 1), lambda i: F.array_contains(t["grams"], F.get(grams, i)))
    return F.filter(let(places, runs), lambda w: w["dice"] <= -percent / 100)


def without_overlaps(found: Column) -> Column:
    """Of windows that share words the one with most bigrams in common, then the best match."""
    shares = lambda h, w: (h["start"] <= 1 - w["end"]) & (w["start"] <= 1 - h["end"])
    return F.aggregate(
        F.array_sort(found),
        F.slice(found, 1, 0),
        lambda have, w: F.when(F.exists(have, lambda h: shares(h, w)), have).otherwise(F.concat(have, F.array(w))),
    )


def spans(docs: DataFrame, templates=None, percent: int = PERCENT) -> DataFrame:
    """(doc_id, line, licence, dice) for every notice or licence anywhere in a text.

    ``line`` is that of the first word, from 0.  Several spans may start in one line.
    """
    known = sorted((name, template_bigrams(text)) for name, text in templates or whole_templates())
    known = [(name, grams) for name, grams in known if grams]
    every = ", ".join(f"'{g}'" for g in sorted({g for _, grams in known for g in grams}))
    # One literal each, folded to constants: the full texts are long.
    table = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"), F.lit(len(grams)).alias("size"),
                F.split(F.lit("|".join(grams)), "[|]").alias("grams"),
            )
            for name, grams in known
        ]
    )

    def grams_of(words: Column) -> Column:
        n = F.size(words) - 1
        return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))

    def fitting(seen: Column) -> Column:
        """Templates of which the text holds as many bigrams as any match needs."""
        need = lambda t, n: (200 - percent) * n >= percent * t["size"]
        return F.filter(
            table, lambda t: need(t, F.size(seen)) & need(t, F.size(F.array_intersect(seen, t["grams"])))
        )

    def found(grams: Column) -> Column:
        fit = let(F.expr(f"array_distinct(filter(_grams, g -> g IN ({every})))"), fitting)
        return let(F.flatten(F.transform(fit, lambda t: windows(grams, t, percent))), without_overlaps)

    # Words up to the end of each line.
    length = lambda x: let(words_of(x), lambda w: F.when(F.get(w, F.lit(0)) != "", F.size(w)).otherwise(0))
    counts = F.transform(F.split("text", "\n"), length)
    upto = F.aggregate(
        counts,
        F.array(F.lit(0)),
        lambda have, n: F.concat(have, F.array(F.element_at(have, -1) + n)),
        lambda have: F.slice(have, 2, F.size(have) - 1),
    )
    # explode_outer: nothing is inferred from it that would compute the windows twice.
    out = docs.select("doc_id", "text", let(words_of(F.col("text")), grams_of).alias("_grams"))
    out = out.select("doc_id", "text", F.explode_outer(F.array(found(F.col("_grams")))).alias("spans"))
    out = out.where(F.size("spans") > 0).select("doc_id", "spans", upto.alias("upto"))
    out = out.select("doc_id", "upto", F.explode_outer("spans").alias("w"))
    return out.select(
        "doc_id",
        F.size(F.filter("upto", lambda n: n <= F.col("w.start"))).alias("line"),
        F.col("w.name").alias("licence"),
        (-F.col("w.dice")).alias("dice"),
    )


def scan_sql(templates=TEMPLATES, percent: int = PERCENT) -> str:
    """The same scan in SQL, every line against every template."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quote(name)}, {quote(text)})" for name, text in templates)
    words = "string_split(trim(regexp_replace(translate({}, '" + UPPER + "', '" + UPPER.lower() + "'), '[^a-z0-9]+', ' ', 'g')), ' ')"
    pairs = "list_distinct([{0}[i] || ' ' || {0}[i + 1] for i in range(1, len({0}))])"
    return f"""
WITH template AS (SELECT name, {words.format('content')} AS w FROM (VALUES {values}) AS t(name, content)),
known AS (SELECT name, {pairs.format('w')} AS grams FROM template),
line AS (
  SELECT doc_id, unnest(range(len(parts))) AS line, unnest(parts) AS content
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)
),
cut AS (SELECT doc_id, line, {words.format('content')} AS w FROM line),
gram AS (SELECT doc_id, line, {pairs.format('w')} AS grams FROM cut WHERE len(w) > 1),
scored AS (
  SELECT doc_id, line, name AS licence,
         CAST(2 * len(list_intersect(g.grams, k.grams)) AS DOUBLE) / CAST(len(g.grams) + len(k.grams) AS DOUBLE) AS dice
  FROM gram g, known k
)
SELECT doc_id, CAST(line AS INTEGER) AS line, licence, dice FROM scored WHERE dice >= {percent / 100}
QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, licence) = 1
"""
