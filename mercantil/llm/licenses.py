"""License scan: TF-IDF cosine to templates, then inheritance from the nearest directory.

A notice is a passage of lines around a word that only license texts use. Its sparse
TF-IDF vector is compared with those of the templates; a template's text in a header, a
footer or a licence file gives the file a license of its own. Files without one take
that of the nearest directory above them that has a licence file. Directories, not
files, are joined to their ancestors, so a host with very many files costs one row a
directory.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercantil.llm.common import texts

# Notices and opening passages of widely used licenses.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the software without restriction",
        "SPDX-License-Identifier: MIT",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: neither the name of the copyright holder",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
}
LICENSE_FILES = r"(?i)^(licen[cs]e|copying|notice|unlicense)([._-].*)?$"
THRESHOLD = 0.6
#: A notice starts at a line with one of these words.
CUES = re.compile(r"licen[cs]|spdx|redistribut|hereby granted|copyright", re.I)
#: Characters of a line that belong to a notice, from the cue on and before it.
REACH = 400
_TAGS = re.compile(r"<[^>]*>")
_TERMS = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*").findall


def terms(text: str) -> Counter:
    found = _TERMS(text.lower())
    return Counter(found) + Counter(f"{a} {b}" for a, b in zip(found, found[1:]))


class Matcher:
    """Best template for a passage by TF-IDF cosine."""

    def __init__(self, templates: dict[str, list[str]], counts: dict[str, int] | None = None, documents: int = 0):
        """``counts``: documents that hold a term, of ``documents`` in all."""
        flat = [(name, terms(text)) for name, passages in templates.items() for text in passages]
        self.idf = {t: 1.0 + math.log((documents + len(flat) + 1) / ((counts or {}).get(t, 0) + sum(t in c for _, c in flat) + 1))
                    for t in {t for _, c in flat for t in c}}
        self.vectors = [(name, self.vector(c)) for name, c in flat]

    def vector(self, counts: Counter) -> dict[str, float]:
        # Terms of no template only lengthen the vector: they count as the rarest ones do.
        rare = max(self.idf.values(), default=1.0)
        raw = {t: n * self.idf.get(t, rare) for t, n in counts.items()}
        norm = math.sqrt(sum(x * x for x in raw.values())) or 1.0
        return {t: x / norm for t, x in raw.items() if t in self.idf}

    def best(self, passage: str) -> tuple[str | None, float]:
        """Ties go to the first template in order."""
        own, found = self.vector(terms(passage)), (None, 0.0)
        for name, vector in self.vectors:
            score = sum(x * vector.get(t, 0.0) for t, x in own.items())
            if score > found[1] + 1e-12:
                found = (name, score)
        return found

    def scan(self, text: str) -> tuple[str | None, float]:
        """Best license over all notices of a text, whole lines and single sentences."""
        best: tuple[str | None, float] = (None, 0.0)
        for line in text.split("\n"):
            for cue in CUES.finditer(line):
                near = line[max(0, cue.start() - REACH):cue.end() + REACH]
                at = min(cue.start(), REACH)
                before = max(near.rfind(". ", 0, at) + 1, 0)
                after = re.search(r"\.(\s|$)", near[at:])
                sentence = near[before:at + after.end() if after else len(near)]
                # A version number may hold the full stop.
                for passage in (sentence, near):
                    found = self.best(passage)
                    if found[1] > best[1] + 1e-12:
                        best = found
        return best if best[1] >= THRESHOLD else (None, best[1])


def visible(html: str) -> str:
    return _TAGS.sub("\n", html)


def _template_counts(rows: DataFrame, templates: dict[str, list[str]], html: bool) -> tuple[dict[str, int], int]:
    """Documents that hold each template term, over all rows: at most one count a term comes back."""
    wanted = {t for passages in templates.values() for p in passages for t in terms(p)}
    single = {t for t in wanted if " " not in t}

    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = _TERMS((visible(text) if html else text).lower())
                seen = single.intersection(found)
                total.update(seen)
                # A pair can only be one of a template when both its words are.
                pairs = {f"{a} {b}" for a, b in zip(found, found[1:]) if a in seen and b in seen}
                total.update(pairs & wanted)
                total[""] += 1
        yield pa.record_batch([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["t", "n"])

    counts = {r["t"]: r["n"] for r in rows.select("_t").mapInArrow(run, "t string, n long")
              .groupBy("t").agg(F.sum("n").alias("n")).collect()}
    return counts, counts.pop("", 0)


def url_path(url: Column) -> Column:
    """``host/dir/name`` of a URL, without scheme, www., query and fragment."""
    return F.regexp_replace(F.regexp_replace(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(www\.)?", ""), r"[?#].*$", "")


def license_scan(df: DataFrame, id_col: str, text_col: str, path: Column, html: bool = False,
                 templates: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per row of ``df``: ``id, path, license, score, origin, from_directory``.

    ``origin`` is "own", "inherited" or "none". A directory's license is that of its
    licence files (by name) or of its index page (a path that ends in "/"); of several
    the best score, then the first name, counts. A null path inherits nothing; a null
    or empty text has no license of its own.
    """
    templates = TEMPLATES if templates is None else templates
    rows = texts(df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t")), "_id", "_t")
    counts, documents = _template_counts(rows, templates, html)

    def run(batches):
        matcher = Matcher(templates, counts, documents)
        for batch in batches:
            found = [matcher.scan(visible(t) if html else t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array([n for n, _ in found], pa.string()),
                                   pa.array([round(s, 6) for _, s in found], pa.float64())],
                                  names=["id", "path", "own", "score"])

    files = (df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_t"),
                       path.alias("path"))
             .mapInArrow(run, "id long, path string, own string, score double")
             .withColumn("directory", F.regexp_replace("path", r"/?[^/]*$", "")))
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    # The best file decides: one number sorts by score, the name breaks ties.
    declared = (files.filter(F.col("own").isNotNull() & (name.rlike(LICENSE_FILES) | (name == "")))
                .groupBy("directory", "own").agg(F.max("score").alias("s"))
                .groupBy("directory").agg(F.min(F.struct(-F.col("s"), "own"))["own"].alias("license")))
    parts = F.split("directory", "/")
    ancestors = (files.select("directory").filter("directory IS NOT NULL").distinct()
                 .select("directory", F.explode(F.sequence(F.lit(1), F.size(parts))).alias("depth"), parts.alias("parts"))
                 .select("directory", "depth", F.array_join(F.slice("parts", 1, F.col("depth")), "/").alias("above")))
    nearest = (ancestors.join(declared.withColumnRenamed("directory", "above"), "above")
               .groupBy("directory").agg(F.max(F.struct("depth", "above", "license")).alias("n"))
               .select("directory", F.col("n.above").alias("from_directory"), F.col("n.license").alias("inherited")))
    joined = files.join(nearest, "directory", "left")
    own = F.col("own").isNotNull()
    return joined.select(
        "id", "path", F.coalesce("own", "inherited").alias("license"), "score",
        F.when(own, "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~own, F.col("from_directory")).alias("from_directory"))
