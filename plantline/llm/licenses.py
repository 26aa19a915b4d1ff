"""License scans by MinHash bands over overlapping text windows, in DataFrame operations only.

Templates are partitioned by size. For the partition of up to s shingles a
document is cut into windows of 2 * s shingles that begin every s shingles, so
that any passage of the template's length lies whole in one window. A window
that holds the template to ``percent`` has a similarity with it of at least
share * q / (2 * s + (1 - share) * q), for a template of q shingles; each
partition takes so many hash functions, one to a band, that such a pair shares
none with a probability below ``MISS``. What shares a band is verified: the
template's exact shingles against those of every window of the document.

A window without any template shingle has no least value in common with a
template, whatever the hash function, so it is signed only if it holds one. All
words of all documents are hashed into shingles to find those windows.

Notices of a few words have a shingle length of their own, their word count, so
that they are found inside a document by the same windows, bands and exact check.

Defined results: words are lower-case runs of letters and digits; a template or
document with fewer words than its shingle counts as one shingle of all its words;
null or wordless texts match nothing; equal rows are reported once; a document
is reported once for each template it holds, with the best window; rows without
an id are found like others; an empty table or no templates give no rows.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantline.llm.common import bound, pieces, row_key, shingle_hashes, stored, words

#: Probability with which a window that holds a template shares no band with it.
MISS = 1e-6
#: Words of a document in one piece, at least; pieces share the longest window.
PIECE = 4096

# Texts of public license notices. Fixed values.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
    " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights"
    " to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
    " Public License as published by the Free Software Foundation",
    "LGPL-notice": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "AGPL-notice": "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY": "This work is licensed under a Creative Commons Attribution",
    "CC0": "To the extent possible under law, the person who associated CC0 with this work has waived all copyright",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "ISC-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "All-rights-reserved": "All rights reserved. No part of this publication may be reproduced",
}
# Notices shorter than a shingle; each is looked up with shingles of its own word count.
SHORT = {"All-rights-reserved-line": "All rights reserved"}


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def functions_needed(shingles: int, power: int, percent: int) -> int:
    """Hash functions for a template of ``shingles`` in windows of 2 ** (power + 1)."""
    held = shingles * percent / 100
    similarity = held / (2 ** (power + 1) + shingles - held)
    return 1 if similarity >= 1 else math.ceil(math.log(MISS) / math.log(1 - similarity))


def windows(hashes: Column, power: int, known: list[int]) -> Column:
    """Windows of 2 ** (power + 1) shingles, beginning every 2 ** power, that hold one of ``known``; the last may be shorter."""

    def cut(held: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(held) - 2**power, F.lit(1)), F.lit(2**power))
        every = F.transform(starts, lambda at: F.slice(held, at, 2 ** (power + 1)))
        return F.filter(every, lambda window: F.arrays_overlap(window, F.lit(known)))

    return bound(hashes, cut)


def bands(hashes: Column, functions: int) -> Column:
    """Least value of the shingles under each function of the family; an agreement in one is a band."""
    return F.transform(
        F.sequence(F.lit(1), F.lit(functions)), lambda i: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, i)))
    )


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    shingle: int = 5,
    percent: int = 80,
    short: dict[str, str] | None = None,
) -> DataFrame:
    """(row_key, doc_id, license, containment) for each template that a document holds.

    ``short`` are templates whose shingle is at most their word count; by default ``SHORT``, or none beside given templates.
    """
    spark = docs.sparkSession
    short = (SHORT if templates is None else {}) if short is None else short
    templates = TEMPLATES if templates is None else templates
    if both := sorted(templates.keys() & short.keys()):
        raise ValueError(f"templates and short notices share names: {both}")
    rows = [(name, template_words(text), shingle) for name, text in sorted(templates.items())]
    rows += [(name, held := template_words(text), min(shingle, len(held))) for name, text in sorted(short.items())]
    rows = [row for row in rows if row[1]]
    sizes = sorted({size for *_, size in rows})
    hashed = lambda size: shingle_hashes(F.col("tokens"), size)
    named = spark.createDataFrame(rows, "license string, tokens array<string>, size int").withColumn(
        "shingles", F.array_distinct(F.coalesce(F.lit(None).cast("array<bigint>"), *[F.when(F.col("size") == n, hashed(n)) for n in sizes]))
    )
    # Shingle length and size of a partition.
    shingles_of: dict[int, dict[str, list[int]]] = {}
    for r in named.select("license", "size", "shingles").collect():
        shingles_of.setdefault(r["size"], {})[r.license] = r.shingles
    parts: dict[tuple[int, int], list[str]] = {}
    for size, held_by in shingles_of.items():
        for name, held in held_by.items():
            parts.setdefault((size, math.ceil(math.log2(len(held)))), []).append(name)
    if not parts:
        return docs.select(
            row_key().alias("row_key"), "doc_id", F.lit("").alias("license"), F.lit(0.0).alias("containment")
        ).limit(0)

    longest = 2 ** (max(power for _, power in parts) + 1) + max(sizes)
    known = {size: sorted({h for held in held_by.values() for h in held}) for size, held_by in shingles_of.items()}
    # One read of the documents gives the shingles of every length; those of a length without a known one are dropped.
    def held_of(size: int) -> Column:
        wanted = lambda h: F.when(F.arrays_overlap(h, F.lit(known[size])), F.struct(F.lit(size).alias("size"), h.alias("hashes")))
        return bound(hashed(size), wanted)

    cut = stored(
        docs.select(
            "doc_id", row_key().alias("row_key"),
            F.explode(pieces(words(F.col("text")), max(PIECE, 4 * longest), longest)).alias("tokens"),
        )
        .select("doc_id", "row_key", F.explode(F.array(*map(held_of, sizes))).alias("held"))
        .where("held is not null")
        .select("doc_id", "row_key", "held.size", "held.hashes"),
        "license-pieces",
    )

    matches = None
    for (size, power), names in sorted(parts.items()):
        own_of = {n: shingles_of[size][n] for n in names}
        functions = max(functions_needed(len(held), power, percent) for held in own_of.values())
        own = sorted({h for held in own_of.values() for h in held})
        # Templates times functions.
        signed = F.broadcast(
            named.where(F.col("license").isin(names)).select(
                "license", "shingles", F.explode(bands(F.col("shingles"), functions)).alias("band")
            )
        )
        # Windows that share a band are verified at once, so only counts are shuffled.
        exact = (
            cut.where(F.col("size") == size)
            .select("doc_id", "row_key", F.explode(windows(F.col("hashes"), power, own)).alias("window"))
            .select("doc_id", "row_key", "window", F.explode(F.array_distinct(bands(F.col("window"), functions))).alias("band"))
            .join(signed, "band")
            .select(
                "row_key", "doc_id", "license", F.size("shingles").alias("n"),
                F.size(F.array_intersect("window", "shingles")).alias("held"),
            )
        )
        matches = exact if matches is None else matches.unionByName(exact)
    best = matches.groupBy("row_key", "doc_id", "license").agg(F.max("held").alias("held"), F.max("n").alias("n"))
    return best.where(F.col("held") * 100 >= F.col("n") * percent).select(
        "row_key", "doc_id", "license", (F.col("held") / F.col("n")).alias("containment")
    )
