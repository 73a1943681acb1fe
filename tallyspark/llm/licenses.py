"""License scans: MinHash bands over overlapping text windows find templates, exact containment confirms them.

A text's words give five-word shingles, and each run of ``WINDOW`` shingles is a window. Its MinHash under a permutation
is the least of its shingles' hashes after an exclusive-or with the permutation's constant. A template's shingles are
signed in the same way: a template no longer than a window as a whole, a longer one by every window it has, so changed
words hide it only if they leave no run of ``WINDOW`` shingles. With one row per band, a text's window equal to a signed
one meets it in every band, and one whose shingles share s of both windows' together meets it in at least one of b bands
with probability 1 - (1 - s)^b. A run of more than ``WINDOW`` shingles has an equal window; a run of just ``WINDOW`` has
one or else two windows with three shingles of it, which are missed with (1 - 3/5)^24. A single shingle lies in
``WINDOW / STEP`` windows, so even a template of one shingle is missed with (1 - 1/4)^(2 * 24), about one in a million.

All of it is built-in functions: windows are rows only inside one stage, from which those in no band never leave.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
WINDOW = 4
STEP = 2
BANDS = 24
CONTAINMENT = 0.8
# Lines and short notices by which licenses are declared, by their SPDX names.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance'
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on"
        ' an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction, including without'
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
    ),
}


def _tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _shingles(tokens: Column) -> Column:
    """The hash of each five words in a row; of fewer than five words, none."""
    hashes = F.transform(tokens, lambda x, i: F.xxhash64(x, *[F.get(tokens, i + k) for k in range(1, SHINGLE)]))
    return F.slice(hashes, 1, F.greatest(F.lit(0), F.size(tokens) - (SHINGLE - 1)))


def _permutations(spark: SparkSession, bands: int) -> list[int]:
    return list(spark.range(1).select(*[F.xxhash64(F.lit(k)).alias(f"c{k}") for k in range(bands)]).first())


def template_shingles(spark: SparkSession, templates: dict[str, tuple[str, ...]]) -> list[tuple[str, list[int]]]:
    """Each template's license and shingle hashes, by the same functions as the texts'."""
    texts = [(name, text) for name, all_of in templates.items() for text in all_of]
    rows = spark.createDataFrame(texts, "name string, text string").select("name", _tokens(F.col("text")).alias("w"))
    found = [(r["name"], r["s"]) for r in rows.select("name", _shingles(F.col("w")).alias("s")).collect()]
    if short := [n for n, s in found if not s]:
        raise ValueError(f"templates of fewer than {SHINGLE} words: {short}")
    return found


def _signatures(shingles: list[int], constants: list[int]) -> list[list[int]]:
    """The MinHashes of the windows by which a template is found."""
    starts = range(max(1, len(shingles) - WINDOW + 1))
    return [[min(x ^ c for x in shingles[s : s + WINDOW]) for c in constants] for s in starts]


def scan(
    docs: DataFrame,
    templates: dict[str, tuple[str, ...]] | None = None,
    containment: float = CONTAINMENT,
    bands: int = BANDS,
) -> DataFrame:
    """``doc_id``, ``license``, ``containment`` and ``word`` for each license that a row's text declares.

    A license counts if the text holds at least ``containment`` of the shingles of one of its templates, near the window
    that found it; ``word`` is where the first such window begins, and the highest containment is given. NULL, empty and
    short texts declare none and have no row. Repeated rows and rows without id are told apart by their texts only, so
    equal ones give one row; an empty table gives no row; other columns are not looked at.
    """
    spark = docs.sparkSession
    constants = _permutations(spark, bands)
    known = template_shingles(spark, TEMPLATES if templates is None else templates)
    words = docs.select("doc_id", _tokens(F.col("text")).alias("w"))
    rows = words.select("doc_id", F.xxhash64("w").alias("key"), _shingles(F.col("w")).alias("s"))
    # Each window as columns next to the whole array, of which a row keeps a reference until it passes the filter.
    shifted = F.arrays_zip(*[F.slice("s", 1 + k, F.size("s")).alias(f"x{k}") for k in range(WINDOW)])
    # A MinHash that equals a template's comes from one of its shingles, so a text without any has no window to sign.
    # Told to the generator and not by a filter, which would be moved below and compute the shingles again.
    all_shingles = F.array(*[F.lit(x) for x in sorted({x for _, s in known for x in s})])
    shifted = F.when(F.arrays_overlap("s", all_shingles), shifted)
    at = rows.select("doc_id", "key", "s", F.posexplode(shifted).alias("at", "x"))
    at = at.filter((F.col("at") % STEP == 0) | (F.col("at") + WINDOW == F.size("s")))
    # Beyond the text's end a window has fewer shingles, which ``least`` skips as NULL.
    signed = [F.least(*[F.col(f"x.x{k}").bitwiseXOR(F.lit(c)) for k in range(WINDOW)]) for c in constants]
    values = [sorted({sig[b] for _, s in known for sig in _signatures(s, constants)}) for b in range(bands)]
    in_band = reduce(lambda a, b: a | b, [h.isin(v) for h, v in zip(signed, values)])
    hits = at.filter(in_band)
    longest = max(len(s) for _, s in known)
    near = F.slice("s", F.greatest(F.lit(1), F.col("at") + 1 - longest), 2 * longest + WINDOW)
    checked = []
    for name, s in known:
        template = F.array(*[F.lit(x) for x in sorted(set(s))])
        share = F.size(F.array_intersect(F.col("near"), template)) / F.lit(len(set(s)))
        checked.append(F.struct(F.lit(name).alias("license"), share.alias("containment")))
    found = hits.select("doc_id", "key", "at", near.alias("near")).select("doc_id", "key", "at", F.explode(F.array(*checked)).alias("c"))
    found = found.filter(F.col("c.containment") >= containment)
    best = found.groupBy("doc_id", "key", "c.license").agg(
        F.max("c.containment").alias("containment"), F.min("at").cast("long").alias("word")
    )
    return best.select("doc_id", "license", "containment", "word")
