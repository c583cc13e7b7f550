"""License scans: MinHash bands over overlapping text windows, then exact shingle containment.

Templates are grouped by length; a class of templates with at most s shingles is looked for in windows of
2 s shingles that overlap by half, so an occurrence lies whole in some window.  A window and a template
become a candidate if one of the class's bands agrees; the number of bands follows from the least Jaccard
similarity that a window with enough of the template can have, for a collision probability of at least
COLLISION.  A band can only agree in windows that hold the template's own least shingle, so signatures are
worked out for those windows alone: the candidates are the same.  Candidates are verified exactly: at least
CONTAINED of the template's distinct shingles must be in the window.

Defined results: words are runs of letters and digits in lower case; a missing or empty text and texts
shorter than WORDS words match nothing (nor can templates that short be given); repeated rows of a doc_id
are one document; ties are all reported; an empty table gives an empty one; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache
from importlib.resources import files

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import whole_text

WORDS = 5
CONTAINED = 0.75
COLLISION = 0.999
MAX_TEMPLATES = 1_000     # templates are a parameter; their bands are sent to every task

# Notices by which public licenses are named in files.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at"),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met"),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation"),
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

# Further header variants and namings, used beside NOTICES and the full texts.
HEADERS = {
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "BSD-style": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "EPL-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
        "available at"),
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    "ISC": "Released under the ISC License.",
    "LGPL-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    "MIT-licensed": "Licensed under the MIT License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
PASSAGE = 36              # words of a passage of a full text; its name is the license's and "#" with a number


@lru_cache(maxsize=1)
def all_templates() -> dict[str, str]:
    """NOTICES, HEADERS and the full texts in `license_texts`, split into passages; a last short one is filled from before."""
    out = NOTICES | HEADERS
    for file in sorted((files(__package__) / "license_texts").iterdir(), key=lambda f: f.name):
        words = [w for w in re.split(r"[\W_]+", file.read_text(encoding="utf-8")) if w]
        for n, start in enumerate(range(0, len(words), PASSAGE)):
            at = max(0, min(start, len(words) - PASSAGE))
            out[f"{file.name.removesuffix('.txt')}-text#{n}"] = " ".join(words[at:at + PASSAGE])
    return out


def bands_for(size: int, rows: int = 1, contained: float = CONTAINED, collision: float = COLLISION) -> int:
    """Bands of a class: its shortest template has size / 2 + 1 shingles (size 1: one), its windows 2 size."""
    shortest = size // 2 + 1 if size > 1 else 1
    common = math.ceil(contained * shortest)
    least = common / (2 * size + shortest - common)
    return max(1, math.ceil(math.log(1 - collision) / math.log(1 - least ** rows)))


def _runs(hashes: Column) -> Column:
    places = F.when(F.size(hashes) >= WORDS, F.sequence(F.lit(0), F.size(hashes) - WORDS)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(WORDS)]))


def with_shingles(docs: DataFrame, text: str, out: str) -> DataFrame:
    words = F.split(F.lower(whole_text(text)), r"[^\p{L}\p{N}]+")
    hashed = docs.withColumn("__w", F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))
    return hashed.withColumn(out, _runs(F.col("__w"))).drop("__w")


def _least_of(shingles: str, band: int) -> Column:
    """(band, value, anchor): the least hash of a band's permutation and the shingle that has it."""
    pairs = F.transform(shingles, lambda x: F.struct(F.xxhash64(x, F.lit(band)).alias("value"), x.alias("anchor")))
    least = F.array_min(pairs)
    return F.struct(F.lit(band).alias("band"), least["value"].alias("value"), least["anchor"].alias("anchor"))


def _windows_around(at: Column, size: int) -> Column:
    """The two half-overlapping windows of a class that hold each of the given places."""
    blocks = F.flatten(F.transform(at, lambda i: F.array(F.floor(i / size).cast("int") - 1, F.floor(i / size).cast("int"))))
    return F.transform(F.array_distinct(F.filter(blocks, lambda k: k >= 0)),
                       lambda k: F.struct(F.lit(size).alias("size"), k.alias("k")))


class LicenseScanner:
    """Templates with their classes and bands; at most MAX_TEMPLATES."""

    def __init__(self, spark, templates: dict[str, str] | None = None):
        templates = NOTICES if templates is None else templates
        if len(templates) > MAX_TEMPLATES:
            raise ValueError(f"more than {MAX_TEMPLATES} templates")
        rows = spark.createDataFrame(sorted(templates.items()), "license string, text string")
        rows = with_shingles(rows, "text", "sh").select("license", F.array_distinct("sh").alias("sh"))
        self.templates = [(r.license, list(r.sh)) for r in rows.collect()]
        if short := [name for name, sh in self.templates if not sh]:
            raise ValueError(f"templates of fewer than {WORDS} words: {short}")
        self.size_of = {name: 1 << (len(sh) - 1).bit_length() for name, sh in self.templates}
        keyed = spark.createDataFrame([(n, sh, self.size_of[n]) for n, sh in self.templates], "license string, sh array<bigint>, size int")
        # Band values of each template, and the shingle that attains each: the only places where it can collide.
        parts = []
        for size in sorted(set(self.size_of.values())):
            own = keyed.filter(F.col("size") == size)
            bands = F.array(*[_least_of("sh", b) for b in range(bands_for(size))])
            parts += own.select("license", "size", F.inline(bands)).collect()
        self.bands = [(r.license, r.size, r.band, r.value) for r in parts]
        self.anchors = {size: sorted({r.anchor for r in parts if r.size == size}) for size in set(self.size_of.values())}
        self.spark = spark

    @staticmethod
    def _among(value: str, anchors: list[int]) -> str:
        # As SQL: thousands of literals are parsed at once instead of being sent to the JVM one by one.
        return f"{value} in ({', '.join(f'{a}L' for a in anchors)})"

    @classmethod
    def _holding(cls, anchors: list[int]) -> Column:
        return F.expr(f"filter(at, i -> {cls._among('get(sh, i)', anchors)})")

    def windows(self, docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Windows (doc_id, size, k, sh) in which some band of a template can agree."""
        rows = with_shingles(docs.select(doc_id, text), text, "sh").select(doc_id, "sh")
        every = sorted({a for own in self.anchors.values() for a in own})
        places = F.expr(f"filter(transform(sh, (x, i) -> if({self._among('x', every)}, i, null)), i -> i is not null)")
        # The few places are worked out once, before anything is made of them.
        rows = rows.select(doc_id, "sh", F.explode(F.array(places)).alias("at")).filter("size(at) > 0")
        wanted = []
        for size, own in self.anchors.items():
            mine = self._holding(own)
            wanted.append(_windows_around(mine, size))
        rows = rows.select(doc_id, "sh", F.explode(F.concat(*wanted)).alias("w"))
        return rows.select(doc_id, "w.size", "w.k", F.slice("sh", F.col("w.k") * F.col("w.size") + 1, 2 * F.col("w.size")).alias("sh"))

    def scan(self, docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """One row per document and license: containment (best window), first_word (0-based), n_windows."""
        windows = self.windows(docs, doc_id=doc_id, text=text)
        most = max(bands_for(s) for s in self.anchors)
        values = F.transform(F.sequence(F.lit(0), F.lit(most - 1)),
                             lambda b: F.array_min(F.transform("sh", lambda x: F.xxhash64(x, b))))
        signed = windows.select(doc_id, "size", "k", "sh", F.posexplode(values).alias("band", "value"))
        bands = F.broadcast(self.spark.createDataFrame(self.bands, "license string, size int, band int, value bigint"))
        shingles = F.broadcast(self.spark.createDataFrame(self.templates, "license string, template array<bigint>"))
        candidates = (signed.join(bands, ["size", "band", "value"]).select(doc_id, "size", "k", "sh", "license")
                      .dropDuplicates([doc_id, "size", "k", "license", "sh"]))
        share = F.size(F.array_intersect("template", "sh")) / F.size("template")
        first = F.array_position(F.transform("sh", lambda x: F.array_contains("template", x)), True) - 1
        return (candidates.join(shingles, "license").withColumn("share", share).filter(F.col("share") >= CONTAINED)
                .withColumn("first", F.col("k") * F.col("size") + first)
                .groupBy(doc_id, "license").agg(F.max("share").alias("containment"), F.min("first").alias("first_word"),
                                                F.count("*").alias("n_windows")))


def scan_documents(docs: DataFrame, templates: dict[str, str] | None = None, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_licenses, licenses (names in order, joined by commas; empty if none).

    A template's name counts up to "#", so the passages of one license are one name.
    """
    found = LicenseScanner(docs.sparkSession, templates).scan(docs, doc_id=doc_id, text=text)
    per_doc = found.groupBy(F.col(doc_id).alias("__id")).agg(F.array_sort(F.collect_set(F.substring_index("license", "#", 1))).alias("names"))
    return (docs.select(doc_id).join(per_doc, F.col(doc_id).eqNullSafe(F.col("__id")), "left")
            .select(doc_id, F.when(F.col("names").isNull(), 0).otherwise(F.size("names")).cast("long").alias("n_licenses"),
                    F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses")))
