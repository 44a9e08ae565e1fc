"""Licence scan: banded MinHash over overlapping windows, then containment.

DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlake.llm.common import once

# The notices and texts that mark a work's licence.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
}

#: Bands of one row each.
BANDS = 16
SHINGLE = 5
CONTAINMENT = 0.8
#: One mask per band: the order of (hash xor mask) is the band's permutation.
#: The leading four bits count the bands up, the rest come from a fixed odd
#: multiplier, so no two bands order hashes alike.
MASKS = [((b << 60) ^ ((b + 1) * 0x9E3779B97F4A7C15 & ((1 << 60) - 1))) - (1 << 64 if b > 7 else 0) for b in range(BANDS)]


def collision_probability(shingles: int, bands: int = BANDS, containment: float = CONTAINMENT) -> float:
    """Least probability that a window holding ``containment`` of a template
    shares a band with it: windows of ``shingles + stride - 1`` shingles every
    ``stride`` hold the occurrence whole."""
    window = shingles + stride(shingles) - 1
    shared = math.ceil(containment * shingles)
    return 1.0 - (1.0 - shared / (window + shingles - shared)) ** bands


def stride(shingles: int) -> int:
    return (shingles + 1) // 2


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(words: Column) -> Column:
    """Hash of every run of SHINGLE words, by its first word."""
    at = lambda i, k: F.get(words, i + k)
    return F.when(
        F.size(words) >= SHINGLE,
        F.transform(F.sequence(F.lit(0), F.size(words) - SHINGLE), lambda i: F.xxhash64(*[at(i, k) for k in range(SHINGLE)])),
    ).otherwise(F.array().cast("array<bigint>"))


def band_minima(hashes: Column) -> Column:
    """The shingle that gives each band's minimum."""

    def least(mask: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(F.lit(mask)))).bitwiseXOR(F.lit(mask))

    return F.array(*[least(m) for m in MASKS])


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, licence, n_windows, first_word, containment``: one row per
    document row and template of which a window holds at least CONTAINMENT of
    the 5-word shingles.

    A template of T shingles is looked for in windows of T + stride - 1
    shingles, stride T / 2, that share one of BANDS MinHash bands with it.  A
    band can only collide in a window that holds the very shingle of the
    template's minimum, so signatures are computed for the windows around
    such shingles alone; all other windows cannot collide.  Every candidate
    is verified on the shingles themselves (as word sequences, by their set).

    The templates' signatures (templates x BANDS rows) are the only broadcast.
    Null and short texts match nothing; a null id is passed on; repeated rows
    are reported once each (``row_number`` of the written scan keeps them
    apart); empty tables give no rows.  Templates under five words are refused.
    """
    spark: SparkSession = docs.sparkSession
    known = spark.createDataFrame(list(templates.items()), "licence string, body string").select("licence", words_of(F.col("body")).alias("tw"))
    known = known.select("licence", "tw", shingle_hashes(F.col("tw")).alias("th"))
    signed = known.select("licence", F.size("th").alias("n"), band_minima(F.col("th")).alias("minima")).collect()
    if any(r["n"] == 0 for r in signed):
        raise ValueError(f"a template needs at least {SHINGLE} words")
    widest = max(r["n"] + stride(r["n"]) for r in signed)
    anchors = sorted({m for r in signed for m in r["minima"]})
    bands = spark.createDataFrame(
        [(m, r["licence"], r["n"], b) for r in signed for b, m in enumerate(r["minima"])], "anchor long, licence string, n int, band int"
    )
    texts = spark.createDataFrame(
        [(k, _shingles(v)) for k, v in templates.items()], "licence string, shingles array<string>"
    )

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), once(words_of(F.col(f"`{text_col}`"))).alias("w"))
    rows = rows.withColumn("h", once(shingle_hashes(F.col("w"))))
    # a text is cut into segments of `widest` words (with as many before and behind), and only
    # those with a hit go on, so what a row holds grows with its text, not with its hits
    hits = F.filter(F.transform("h", lambda h, i: F.when(h.isin(anchors), F.floor(i / widest))), lambda s: s.isNotNull())
    rows = rows.withColumn("segments", once(F.array_distinct(hits))).filter(F.size("segments") > 0)
    before = lambda s: F.greatest((s - 1) * widest, F.lit(0)).cast("int")
    cut = F.transform(
        "segments",
        lambda s: F.struct(
            (s * widest).cast("int").alias("core"),
            before(s).alias("low"),
            F.slice("h", before(s) + 1, F.lit(3 * widest)).alias("h"),
            F.slice("w", before(s) + 1, F.lit(3 * widest + SHINGLE)).alias("w"),
        ),
    )
    parts = rows.withColumn("row_number", F.monotonically_increasing_id()).select("row_number", "doc_id", F.explode(cut).alias("x")).select("row_number", "doc_id", "x.*")
    place = lambda h, i: F.when(h.isin(anchors) & (i + F.col("low")).between(F.col("core"), F.col("core") + (widest - 1)), i + F.col("low"))
    near = parts.withColumn("at", F.explode(F.filter(F.transform("h", place), lambda i: i.isNotNull())))
    near = near.withColumn("anchor", F.get(F.col("h"), F.col("at") - F.col("low")))
    step = F.floor((F.col("n") + 1) / 2).cast("int")
    width = F.col("n") + step - 1
    first = F.ceil(F.greatest(F.col("at") - width + 1, F.lit(0)) / step)
    windows = (
        near.join(F.broadcast(bands), "anchor")
        .withColumn("k", F.explode(F.sequence(first, F.floor(F.col("at") / step))))
        .withColumn("from", (F.col("k") * step).cast("int"))
        .withColumn("wh", once(F.slice("h", F.col("from") - F.col("low") + 1, width)))
    )
    mask = F.element_at(F.array(*map(F.lit, MASKS)), F.col("band") + 1)
    low = F.array_min(F.transform("wh", lambda h: h.bitwiseXOR(mask)))
    collided = windows.filter(low == F.col("anchor").bitwiseXOR(mask))
    spans = F.transform(
        F.sequence(F.lit(0), F.size("wh") - 1),
        lambda i: F.concat_ws(" ", F.slice(F.col("w"), F.col("from") - F.col("low") + 1 + i, F.lit(SHINGLE))),
    )
    candidates = collided.groupBy("row_number", "doc_id", "licence", "from").agg(F.first(spans).alias("spans"))
    verified = candidates.join(F.broadcast(texts), "licence").withColumn(
        "containment", F.size(F.array_intersect("spans", "shingles")) / F.size("shingles")
    )
    return (
        verified.filter(F.col("containment") >= CONTAINMENT)
        .groupBy("row_number", "doc_id", "licence")
        .agg(F.count("*").alias("n_windows"), F.min("from").alias("first_word"), F.max("containment").alias("containment"))
        .drop("row_number")
    )


def _shingles(text: str) -> list[str]:
    words = [w for w in "".join(c if c.isalnum() else " " for c in text.lower()).split()]
    return sorted({" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)})
