"""License scans: MinHash bands over overlapping windows of text, then exact containment.

A license template is a text of at least five words. Template and documents are cut into words
(runs of letters and digits, lower case) and five-word shingles. Templates are put into classes
by their number of shingles; for a class of up to ``c`` shingles, windows of ``c`` plus a quarter
of ``c`` shingles are taken every quarter of ``c``, so that any place of a template lies whole in
one window. Window and template then have a Jaccard similarity of at least ``LEAST_SIMILARITY``
(containment 0.8, a template 20 % shorter than its class, a window 25 % longer). With
``BANDS`` bands of ``ROWS`` min-hashes they meet in one band with a probability of at least
``1 - (1 - LEAST_SIMILARITY**ROWS)**BANDS`` = 0.9999. A met pair is kept when the window holds at
least ``CONTAINMENT`` of the template's distinct shingles.

For templates of up to ``LONG`` shingles windows are taken only around anchors. A template's
anchors are words of it, at least five words apart, so many that a text without any of them lacks
more than a fifth of its shingles; so no window without an anchor can be a match. Longer templates
are looked for in all windows of the texts that hold enough of the template's words for a match.

Of a license the best place is given. It is left out where another license's best place overlaps it
and holds all of its shingles that were found there, and more: a GPL-3 notice is not GPL-2 as well.

All of it is DataFrame functions; the templates' bands are broadcast while there are at most
``BROADCAST_TEMPLATES`` templates.

Defined results: null and empty texts have no matches. Repeated rows (equal ids) give their
matches once per id. Templates of fewer than five words are refused. No documents or no templates
give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import written

SIZE = 5
CONTAINMENT = 0.8
LEAST_SIMILARITY = 0.45
ROWS, BANDS = 2, 41
CLASS_GROWTH = 1.25
BROADCAST_TEMPLATES = 5_000
#: Templates of more shingles are looked for in whole texts that hold enough of their words.
LONG = 90
#: Of at most so many long templates the words are compared; for more, all texts long enough are taken.
COMPARED = 200
TEXTS = Path(__file__).parent / "license_texts"

# Notices that public licenses ask for, by SPDX identifier.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
     "use this file except in compliance with the License. You may obtain a copy of the License "
     "at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it "
     "under the terms of the GNU General Public License as published by the Free Software "
     "Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
     "modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. "
     "2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
     "https://mozilla.org/MPL/2.0/."),
)
_FSF = "it under the terms of the GNU {} License as published by the Free Software Foundation"
_LATER = "of the License, or (at your option) any later version."
_CC = "licensed under a Creative Commons {} 4.0 International License."

#: Further notices, and the texts of ``TEXTS``; Creative Commons licenses and AGPL by notice only.
MORE_NOTICES = (
    *((f"{name}-or-later", f"This {what} is free software{sign} you can redistribute it and/or modify "
       f"{_FSF.format(kind)}{sign if sign == ';' else ','} either version {name.rsplit('-', 1)[1].removesuffix('.0')} {_LATER}")
      for name, what, kind in (
          ("GPL-2.0", "program", "General Public"),
          ("LGPL-2.0", "library", "Library General Public"),
          ("LGPL-2.1", "library", "Lesser General Public"),
          ("LGPL-3.0", "library", "Lesser General Public"),
          ("LGPL-3.0", "program", "Lesser General Public"),
          ("AGPL-3.0", "program", "Affero General Public"))
      for sign in ";:"),
    *((f"CC-{short}-4.0", f"This work is {_CC.format(name)}") for short, name in (
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"),
        ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
        ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related "
     "or neighboring rights to this work."),
)


def words_of(text: Column) -> Column:
    """The words of a text, as an array."""
    return F.array_remove(
        F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), ""
    )


def shingles_of(words: Column) -> Column:
    """Hashes of the shingles, in order."""
    starts = F.when(
        F.size(words) >= SIZE, F.sequence(F.lit(1), F.size(words) - (SIZE - 1))
    ).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(words, i, SIZE), " ")))


def bands_of(shingles: Column) -> Column:
    """``BANDS`` hashes of ``ROWS`` min-hashes each, with the band's number mixed in."""
    def least(seed: int) -> Column:
        return F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(seed))))

    return F.array(*(
        F.xxhash64(F.lit(b), *(least(b * ROWS + r) for r in range(ROWS))) for b in range(BANDS)
    ))


def class_sizes(most: int) -> list[int]:
    """The class sizes up to the one that holds ``most`` shingles."""
    sizes = [1]
    while sizes[-1] < most:
        sizes.append(max(sizes[-1] + 1, int(sizes[-1] * CLASS_GROWTH)))
    return sizes


def _missing(words: list[str]) -> int:
    """How many of its shingles, repeated ones counted each, a match of a template may lack."""
    shingles = [tuple(words[k : k + SIZE]) for k in range(len(words) - SIZE + 1)]
    times = sorted(Counter(shingles).values(), reverse=True)
    return sum(times[: len(times) * (100 - round(100 * CONTAINMENT)) // 100])


def _anchors(words: list[str]) -> list[str]:
    """Words of a template of which a window with enough of its shingles has at least one."""
    shingles = len(words) - SIZE + 1
    if shingles <= SIZE:  # one word lies in more than a fifth of them
        inner = words[shingles - 1 : SIZE] or words[SIZE - 1 : SIZE]
        return [max(inner, key=lambda w: (len(w), w))]
    needed = _missing(words) // SIZE + 1
    if needed > 1 and needed * SIZE > shingles - SIZE + 1:  # mostly repetitions; a match holds some word
        return sorted(set(words))
    step = (shingles - SIZE + 1) / needed
    segments = [(SIZE - 1 + int(k * step), SIZE - 1 + int((k + 1) * step)) for k in range(needed)]
    segments[-1] = (segments[-1][0], shingles + SIZE - 1)  # nothing follows the last one
    return [
        max(words[begin : max(begin + 1, end - SIZE + 1)], key=lambda w: (len(w), w))
        for begin, end in segments
    ]


def public_licenses() -> list[tuple[str, str]]:
    """(license, text) of all notices and whole texts."""
    texts = [(path.stem, path.read_text(encoding="utf-8")) for path in sorted(TEXTS.glob("*.txt"))]
    return [*NOTICES, *MORE_NOTICES, *texts]


def _holding(words: Column, listed: list[list[str]], size_of) -> Column:
    """The classes of the long templates that a text can hold, by its distinct words.

    A word that a text lacks costs a match all shingles around the word's places; places ``SIZE``
    apart share none. So a text lacks at most as many of these words as shingles may be missing,
    divided by ``SIZE``.
    """
    found = []
    for own in listed:
        least = len(own) - SIZE + 1 - _missing(own)
        enough = F.size(words) >= least
        if len(listed) <= COMPARED:
            sample = sorted({*own[SIZE - 1 : len(own) - SIZE + 1 : SIZE]})
            known = F.split(F.lit(" ".join(sample)), " ")
            held = F.size(F.array_intersect(known, words))
            enough = enough & (held >= len(sample) - _missing(own) // SIZE)
        found.append(F.when(enough, F.lit(size_of(len(own) - SIZE + 1))))
    return F.array_distinct(F.array_compact(F.array(*found)))


def templates(spark: SparkSession, notices: Sequence[tuple[str, str]] = NOTICES) -> DataFrame:
    """(license, text) of pairs."""
    rows = F.array(*(
        F.struct(F.lit(name).alias("license"), F.lit(text).alias("text")) for name, text in notices
    ))
    return spark.range(1).select(F.inline(rows))


def scan(documents: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, license, start, words, containment): the best place of each license found in a row;
    rows that repeat both id and text are one.

    ``known`` is a table of templates (license, text). ``start`` counts words from 0.
    """
    known = written(
        known.select("license", words_of(F.col("text")).alias("words"))
        .withColumn("shingles", F.array_distinct(shingles_of(F.col("words"))))
        .withColumn("template", F.monotonically_increasing_id()),
        "license_templates",
    )
    listed = known.select("words").collect()
    short = [" ".join(row["words"]) for row in listed if len(row["words"]) < SIZE]
    if short:
        raise ValueError(f"templates of fewer than {SIZE} words: {short}")
    short = [row["words"] for row in listed if len(row["words"]) - SIZE + 1 <= LONG]
    long = [row["words"] for row in listed if len(row["words"]) - SIZE + 1 > LONG]
    every = class_sizes(max((len(row["words"]) - SIZE + 1 for row in listed), default=1))

    def class_of(shingles: int) -> int:
        return min(s for s in every if s >= shingles)

    of_class: dict[int, set] = {} if short else {1: {""}}
    for words in short:
        of_class.setdefault(class_of(len(words) - SIZE + 1), set()).update(_anchors(words))
    anchors, sizes = sorted(set().union(*of_class.values())), sorted(of_class)
    long_sizes = sorted({class_of(len(words) - SIZE + 1) for words in long})

    # Contexts: the words around each anchor, wide enough for the largest window.
    reach = max(s + max(1, s // 4) + SIZE for s in sizes)
    # Rows are told apart by id and text: results of one text belong to one row.
    text_id = F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_id")
    with_words = documents.select("doc_id", text_id, words_of(F.col("text")).alias("words"))
    places = F.filter(
        F.transform("words", lambda w, i: F.when(w.isin(anchors), i)),
        lambda i: i.isNotNull(),
    )
    contexts = with_words.select("doc_id", "text_id", "words", F.explode(places).alias("place")).select(
        "doc_id", "text_id", "place", F.greatest(F.col("place") - reach, F.lit(0)).alias("begin"), "words",
        F.element_at("words", F.col("place") + 1).alias("anchor"),
    ).select(
        "doc_id", "text_id", "place", "begin", "anchor",
        F.slice("words", F.col("begin") + 1, F.lit(2 * reach + 1)).alias("words"),
    )
    # Windows: for each class, those of a fixed grid of the text that hold the anchor.
    spec = F.array(*(
        F.struct(F.lit(s).alias("size"), F.lit(max(1, s // 4)).alias("step"),
                 F.lit(s + max(1, s // 4) - 1 + SIZE - 1).alias("width"),
                 F.split(F.lit(" ".join(sorted(of_class[s]))), " ").alias("anchors")) for s in sizes
    ))
    first = F.greatest(
        F.ceil((F.col("place") - F.col("s.width") + 1) / F.col("s.step")), F.lit(0)
    ) * F.col("s.step")
    last = F.floor(F.col("place") / F.col("s.step")) * F.col("s.step")
    starts = F.sequence(first.cast("int"), last.cast("int"), F.col("s.step"))
    windows = (
        contexts.withColumn(
            "s", F.explode(F.filter(spec, lambda s: F.array_contains(s["anchors"], F.col("anchor"))))
        )
        .withColumn("start", F.explode(starts))
        .select(
            "doc_id", "text_id", F.col("s.size").alias("size"), "start",
            F.slice("words", F.col("start") - F.col("begin") + 1, F.col("s.width")).alias("words"),
        )
        .filter(F.size("words") >= SIZE)
        .select("doc_id", "text_id", "size", "start",
                F.array_distinct(shingles_of(F.col("words"))).alias("shingles"))
    )
    if long:
        # Whole texts that can hold a long template: all windows of the template's class.
        least = min(len(words) - SIZE + 1 - _missing(words) for words in long)
        step = F.greatest(F.floor(F.col("size") / 4), F.lit(1)).cast("int")
        whole = documents.filter(F.length("text") >= least).select(
            "doc_id", text_id, words_of(F.col("text")).alias("words")
        ).select("doc_id", "text_id", "words", F.explode(_holding(F.col("words"), long, class_of)).alias("size"))
        windows = windows.union(
            whole.withColumn("step", step)
            .withColumn("start", F.explode(F.sequence(F.lit(0), F.size("words") - SIZE, F.col("step"))))
            .select("doc_id", "text_id", "size", "start", F.array_distinct(shingles_of(F.slice(
                F.col("words"), F.col("start") + 1, F.col("size") + F.col("step") + (SIZE - 2)
            ))).alias("shingles"))
        )
    banded = written(windows, "license_windows").select(
        "doc_id", "text_id", "size", "start", "shingles", F.explode(bands_of(F.col("shingles"))).alias("band")
    )
    size_of = F.array_min(F.filter(
        F.array(*map(F.lit, sorted({*sizes, *long_sizes}))), lambda s: s >= F.size("words") - (SIZE - 1)
    ))
    few = len(listed) <= BROADCAST_TEMPLATES
    wanted = known.select("template", size_of.alias("size"), F.explode(bands_of(F.col("shingles"))).alias("band"))
    described = known.select(
        "license", "template", F.col("shingles").alias("template_shingles"),
        F.size("words").alias("template_words"),
    )
    met = banded.join(F.broadcast(wanted) if few else wanted, ["size", "band"])
    met = met.join(F.broadcast(described) if few else described, "template")
    found = met.withColumn("held", F.array_intersect("shingles", "template_shingles")).withColumn(
        "containment", F.size("held") / F.size("template_shingles")
    ).filter(F.col("containment") >= CONTAINMENT)
    best = F.max(F.struct(
        "containment", (-F.col("start")).alias("before"), "template_words", "size", "held"
    ))
    best = written(found.groupBy("doc_id", "text_id", "license").agg(best.alias("best")).select(
        "doc_id", "text_id", "license", (-F.col("best.before")).cast("long").alias("start"),
        F.col("best.template_words").cast("long").alias("words"),
        F.col("best.containment").alias("containment"), F.col("best.size").alias("size"),
        F.col("best.held").alias("held"),
    ), "license_found")
    # A place that another license explains wholly, and more of it, is not this license's.
    a, b = best.alias("a"), best.alias("b")
    explained = (
        F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_id") == F.col("b.text_id"))
        & (F.col("a.license") != F.col("b.license"))
        & (F.size("b.held") > F.size("a.held"))
        & (F.col("a.start") < F.col("b.start") + F.col("b.size") * 5 / 4 + SIZE)
        & (F.col("b.start") < F.col("a.start") + F.col("a.size") * 5 / 4 + SIZE)
        & (F.size(F.array_except("a.held", "b.held")) == 0)
    )
    return a.join(b, explained, "left_anti").select("doc_id", "license", "start", "words", "containment")
