"""Operator 6: license scans by MinHash bands over overlapping windows.

A text's words give hashes of five-word shingles. Templates fall into classes
by size (powers of two); a class has windows of so many shingles, and so far
apart, that any place where one of its templates stands lies whole in one
window. A window's MinHash keys (one hash function and one row a band) fetch
the templates with an equal key. The number of bands follows from the least
Jaccard index that a window holding a template to the asked containment can
have, so that such a window fetches it with ``PROBABILITY`` or more. The
containment of the template's shingles in the window is then counted exactly.

A band's key equals a template's only if its lowest shingle is one of the
template's, so windows (and texts) without any template shingle are passed
over before their keys are made; this changes no result. Only DataFrame
functions run; the templates, a parameter, are the only broadcast side.

Defined results
  null or empty text, or fewer than five words: no match
  very long text: its shingles that templates have become rows; split into words in one row's memory
  templates of fewer than five words are refused
  equal best windows: the first; repeated rows (equal doc_id and text): one result
  empty table: no rows; extra columns of the input are ignored
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.llm.common import text_key

SHINGLE = 5
CONTAINMENT = 80  # per cent of a template's shingles
PROBABILITY = 0.999
#: Bound of the template table (words of all templates together).
MAX_TEMPLATE_WORDS = 200_000
#: A word: letters and digits, and . + - inside.
WORD = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"

#: Public license notices and opening paragraphs.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "cc-by-4.0": "Licensed under CC BY 4.0 International terms.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                 "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                 "following conditions are met.",
    "apache-2.0-header": "You may not use this file except in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                  "Public License as published by the Free Software Foundation.",
}


def shingle_hashes(text: Column) -> Column:
    """Hashes of a text's five-word shingles, in order."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    hashes = lambda w: F.transform(F.slice(w, 1, F.greatest(F.size(w) - (SHINGLE - 1), F.lit(0))),
                                   lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, SHINGLE)]))
    return F.transform(F.array(words), hashes)[0]  # the words are extracted once


def class_of(size: int) -> tuple[int, int, int]:
    """(window length, step, bands) for templates of ``size`` shingles: those of
    more than half of ``top`` and at most ``top``."""
    top = 1 << (size - 1).bit_length()
    step = max(1, top // 2)
    length = top + step - 1
    least = top // 2 + 1 if top > 1 else 1
    inside = math.ceil(CONTAINMENT * least / 100)
    jaccard = inside / (length + least - inside)
    bands = 1 if jaccard == 1 else math.ceil(math.log(1 - PROBABILITY) / math.log(1 - jaccard))
    return length, step, bands


def template_frame(spark, templates: dict[str, str]) -> list[tuple[str, list[int]]]:
    """(license, distinct shingles) of each template, hashed by the same expressions."""
    words = sum(len(t.split()) for t in templates.values())
    if words > MAX_TEMPLATE_WORDS:
        raise ValueError(f"{words} words of templates; the broadcast side is bounded to {MAX_TEMPLATE_WORDS}")
    frame = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    rows = frame.select("license", F.array_distinct(shingle_hashes(F.col("text"))).alias("shingles")).collect()
    if short := [r.license for r in rows if not r.shingles]:
        raise ValueError(f"templates of fewer than {SHINGLE} words: {short}")
    return [(r.license, sorted(r.shingles)) for r in rows]


def band_keys(shingles: Column, bands: Column) -> Column:
    """One struct (band, band_key) for each band: the lowest of its hashes."""
    key = lambda b: F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, b)))
    return F.transform(F.sequence(F.lit(0), bands - 1), lambda b: F.struct(b.alias("band"), key(b).alias("band_key")))


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, license, containment (0.8 to 1), first_word (of the best window)."""
    spark = docs.sparkSession
    known = template_frame(spark, templates or TEMPLATES)
    every = F.lit(sorted({h for _, own in known for h in own}))
    # a generator's output is a column: the filter on it does not make it again
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"),
                       F.explode(F.array(shingle_hashes(F.col("text").cast("string")))).alias("hashes")) \
        .where(F.arrays_overlap("hashes", every))
    classes: dict[tuple[int, int, int], list] = {}
    for name, own in known:
        classes.setdefault(class_of(len(own)), []).append((name, own))
    shape = F.array(*[
        F.struct(F.lit(length).alias("length"), F.lit(step).alias("step"), F.lit(bands).alias("bands"),
                 F.lit(sorted({h for _, own in v for h in own})).alias("of_class"))
        for (length, step, bands), v in sorted(classes.items())])
    cut = lambda at: F.struct(at.alias("start"), F.slice("hashes", at + 1, F.col("length")).alias("window"))
    windows = rows.select("doc_id", "key", "hashes", F.inline(shape)) \
        .select("doc_id", "key", "length", "of_class", "bands", F.inline(F.transform(
            F.sequence(F.lit(0), F.size("hashes") - 1, F.col("step")), cut))) \
        .where(F.arrays_overlap("window", "of_class")).drop("of_class")
    keyed = windows.select("doc_id", "key", "length", "start", "window", F.inline(band_keys(F.col("window"), F.col("bands"))))
    targets = [(name, own, shape_[0], shape_[2]) for shape_, v in classes.items() for name, own in v]
    frame = spark.createDataFrame(targets, "license string, shingles array<long>, length int, bands int")
    bands = frame.select("license", "shingles", "length", F.inline(band_keys(F.col("shingles"), F.col("bands"))))
    inside = F.size(F.array_intersect("window", "shingles"))
    found = keyed.join(F.broadcast(bands), ["length", "band", "band_key"]) \
        .where(100 * inside >= CONTAINMENT * F.size("shingles")) \
        .select("doc_id", "key", "license", (inside / F.size("shingles")).alias("containment"), "start")
    return found.groupBy("doc_id", "key", "license").agg(
        F.max("containment").alias("containment"), F.min(F.struct(-F.col("containment"), "start"))["start"].alias("first_word")) \
        .drop("key")
