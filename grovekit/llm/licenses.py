"""License scans (10): templates found in overlapping text windows by MinHash bands and exact containment.

A template of up to ``step`` shingles (a power of two) is looked for in windows of ``2 * step`` shingles that begin every
``step``, so that an occurrence of up to ``step + 1`` shingles lies within one window, wherever it begins.  A longer one
may not: of ISC (30 shingles, step 32) with 12 words put in in its middle, 26 shingles are left in the text, but of those that
begin 25 to 29 past a window's start no window holds the 24 that are needed.  If ``percent`` per cent of a template lie in a window, the two have
a Jaccard similarity of at least 0.19 (at 80 per cent); one-row bands are taken, as many as make a miss rarer than ``miss``
at the lowest such similarity.  What collides is verified by counting common shingles.

Only DataFrame functions.  A window without any shingle of a template cannot collide, and is not built: shingles are first
looked up in the set of the templates' shingles.  Templates come in blocks whose sets are bounded; each block meets all
documents.  Nothing but windows that hold a template's shingle leaves the row of its document.

Words are the runs of ``[a-z0-9]`` of the lower-cased text; a shingle is five words.  Defined cases: null or empty texts, and
those of fewer than five words, match nothing; a template needs five words.  Rows that repeat id and text are one document.
Null ids are kept.  Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovekit.llm.common import keyed
from grovekit.session import local_table

SIZE = 5

# Public license notices.
TEMPLATES = {
    "MIT notice": "Released under the MIT License.",
    "Apache notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
    "this permission notice shall be included in all copies or substantial portions of the Software.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with "
    "the distribution.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
    "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
    "later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
    "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
    "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
    "purpose, commercial or non-commercial, and by any means.",
}


def template_words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def window_step(shingles: int) -> int:
    return 1 << max(0, (shingles - 1).bit_length())


def bands_needed(percent: int, miss: float) -> int:
    """One-row bands that find a passing window but for a chance of ``miss``.

    The least similarity: a template of just over half of ``step`` shingles, ``percent`` per cent of it in the window.
    """
    common = percent / 100 / 2
    least = common / (2 + 0.5 - common)
    return math.ceil(math.log(miss) / math.log(1 - least))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often a lambda inside refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingles(text: Column) -> Column:
    """Fingerprints of the shingles of ``text``, in order."""
    words = F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")
    each = lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - SIZE), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(SIZE)])
    )
    none = F.array().cast("array<bigint>")
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.when(F.size(h) >= SIZE, each(h)).otherwise(none))


def template_blocks(templates: dict[str, str], block_shingles: int) -> Iterator[dict[str, str]]:
    block, size = {}, 0
    for name, text in templates.items():
        n = len(template_words(text))
        if n < SIZE:
            raise ValueError(f"template {name!r} has fewer than {SIZE} words")
        block[name], size = text, size + n
        if size >= block_shingles:
            yield block
            block, size = {}, 0
    if block:
        yield block


def scan_block(docs: DataFrame, templates: dict[str, str], percent: int, miss: float) -> DataFrame:
    spark = docs.sparkSession
    bands = bands_needed(percent, miss)
    signature = lambda column: F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.array_min(F.transform(column, lambda s: F.xxhash64(s, b)))
    )
    given = local_table(spark, list(templates.items()), "license string, text string")
    held = given.select("license", F.array_distinct(shingles(F.col("text"))).alias("own")).collect()
    # As many rows as there are templates in the block.
    rows = [(r["license"], window_step(len(r["own"])), r["own"]) for r in held]
    own = local_table(spark, rows, "license string, step int, own array<bigint>")
    known = sorted({s for _, _, found in rows for s in found})
    steps = sorted({step for _, step, _ in rows})

    # Rows of one element: what is exploded is computed once, and its parts are columns from there on.
    once = lambda value, name: F.explode(F.array(value)).alias(name)
    places = lambda s: F.filter(
        F.transform(s, lambda x, i: F.when(x.isin(known), i)), lambda i: i.isNotNull()
    )
    texts = keyed(docs).select("doc_id", "f", once(shingles(F.col("text")), "shingles"))
    texts = texts.select("doc_id", "f", "shingles", once(places(F.col("shingles")), "places")).filter(F.size("places") > 0)
    texts = texts.withColumn("step", F.explode(F.array(*[F.lit(s) for s in steps])))
    starts = F.transform("places", lambda i: F.floor(i / F.col("step")).cast("int"))
    starts = F.array_distinct(F.concat(starts, F.transform(starts, lambda k: k - 1)))
    windows = texts.select("doc_id", "f", "step", "shingles", F.explode(F.filter(starts, lambda k: k >= 0)).alias("k"))
    first = F.col("k") * F.col("step")
    window = F.array_distinct(F.slice("shingles", first + 1, 2 * F.col("step")))
    windows = windows.select("doc_id", "f", "step", first.alias("start"), once(window, "window"))
    banded = windows.select("*", F.posexplode(signature("window")).alias("band", "value"))
    wanted = own.select("license", "step", F.posexplode(signature("own")).alias("band", "value"))
    met = banded.join(F.broadcast(wanted), ["step", "band", "value"]).join(F.broadcast(own.drop("step")), "license")
    common = F.size(F.array_intersect("window", "own"))
    checked = met.select("doc_id", "f", "license", "start", common.alias("common"), F.size("own").alias("n"))
    return (
        checked.filter(f"100 * common >= {percent} * n")
        .groupBy("doc_id", "f", "license")
        .agg(
            F.max("n").cast("long").alias("n_shingles"),
            F.max("common").cast("long").alias("n_common"),
            F.min("start").cast("long").alias("first_window"),
            F.count_distinct("start").alias("n_windows"),
        )
    )


def find_licenses(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    percent: int = 80,
    miss: float = 1e-3,
    block_shingles: int = 4000,
) -> DataFrame:
    """``doc_id, f, license, n_shingles, n_common, first_window, n_windows``: templates found in documents.

    ``n_common`` of the template's ``n_shingles`` lie in its best window; ``first_window`` is the word at which the first
    passing window begins.
    """
    found = [scan_block(docs, block, percent, miss) for block in template_blocks(templates, block_shingles)]
    out = found[0] if found else docs.sparkSession.createDataFrame(
        [], "doc_id long, f long, license string, n_shingles long, n_common long, first_window long, n_windows long"
    )
    for more in found[1:]:
        out = out.union(more)
    return out
