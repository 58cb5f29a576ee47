"""Licence scans: sparse TF-IDF cosine of texts to templates, and inheritance from the nearest ancestor directory.

Compared with every template, as sparse vectors of their words, are: each line of each file; each run of as many words as the template
has, over the ends of lines and without comment markers (all of a shorter file; not for titles, which are lines); and the whole text of a
licence file (LICENSE..., COPYING...). Templates are notices, titles and full texts. A word weighs ``ln(1 + N / df)``, df over all
files. An SPDX line names its licences itself, with similarity 1. A file's own licence is its best match from ``threshold`` up; a match
of a full text goes before notices and titles, and a mere reservation of rights gives way to any licence.

The table of df is never held in one place: tasks get the weights of the templates' words. With these, and the least and largest weight
that another word can have, a first pass settles most files; of the others it lists the words that matter, whose df is joined, and a
second pass over these files alone is exact.

A directory has the licence of its licence files. A file without one of its own takes that of its directory, else of the
nearest directory above that has one. Directories are made distinct before their ancestors are listed and joined, so a directory
with very many files is joined once.

Defined results: null text is empty; a null path lies in no directory and inherits nothing; of equal similarities the template name that
sorts first wins; similarities are rounded to 12 digits; repeated rows each get their result; an empty table gives no rows; of other
columns, those in ``keep`` are in ``row``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.runtime import hold, ship, stored

THRESHOLD = 0.8

# Licence names and the notices by which they are known.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
]

#: More notices, titles (compared with lines only) and full texts, which lie beside this file under their names.
NOTICES = [
    ("Apache-2.0", "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
     "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
     "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "Licensed under the MIT License."),
]
TITLES = [
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("GPL-2.0", "GNU General Public License, Version 2"),
    ("GPL-3.0", "GNU General Public License, Version 3"),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
]
TEXTS = Path(__file__).with_name("licence_texts")
#: The name of what gives way to any licence.
RESERVED = "Proprietary"

WORD = re.compile(r"[^\W_]+")
MARKER = re.compile(r"^\W*(?:rem|dnl)\b", re.I)
SPDX = re.compile(r"SPDX-License-Identifier:([^\n]*)", re.I)
SCANNED = "own string, similarity double, open array<string>"
#: Distinct words that a task counts before it passes them on.
COUNTED = 200_000
EPS = 1e-6


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def full_texts() -> list[tuple[str, str]]:
    return [(p.stem, p.read_text()) for p in sorted(TEXTS.glob("*.txt"))]


class Matcher:
    """Templates as sparse unit vectors over their words; titles are not compared with runs of words."""

    def __init__(self, notices: Sequence[tuple[str, str]], titles: Sequence[tuple[str, str]], texts: Sequence[tuple[str, str]],
                 df: dict[str, int], n_files: int, threshold: float):
        self.threshold, self.n_files = threshold, n_files
        kinds = ((texts, True, 0), (notices, True, 1), (titles, False, 1))
        parts = [(name, words(text), run, 2 if name == RESERVED else rank) for some, run, rank in kinds for name, text in some]
        self.weight = {w: self.weigh(df.get(w, 0)) for _, t, _, _ in parts for w in t}
        # No word is in more files than all or in fewer than one.
        self.least, self.most = self.weigh(n_files), self.weigh(1)
        self.names = {name for name, *_ in parts}
        self.templates, self.shares = [], {}
        for name, text, run, rank in parts:
            vector = {w: n * self.weight[w] for w, n in Counter(text).items()}
            norm = math.sqrt(sum(x * x for x in vector.values()))
            if norm:
                for w in vector:
                    vector[w] /= norm
                    self.shares.setdefault(w, []).append((len(self.templates), vector[w] ** 2))
                self.templates.append((name, vector, len(text) if run else 0, rank))

    def weigh(self, df: int) -> float:
        return math.log(1 + self.n_files / max(1, df)) if self.n_files else 0.0

    def able(self, found: set[str]) -> list[int]:
        """The templates that some text of these words could match: no cosine exceeds the norm of what they share."""
        mass: dict[int, float] = {}
        for w in found & self.shares.keys():
            for t, x in self.shares[w]:
                mass[t] = mass.get(t, 0.0) + x
        return [t for t, x in mass.items() if x >= self.threshold**2 - EPS]

    def _bag(self, found: list[str], t: int, weight: dict[str, float]) -> tuple[float, float]:
        """The largest and the least cosine that ``found`` can have; the same where all weights are known."""
        vector, dot, mass, other = self.templates[t][1], [], [], 0
        for w, n in Counter(found).items():
            if (x := weight.get(w)) is None:
                other += n * n
                continue
            mass.append((n * x) ** 2)
            if w in vector:
                dot.append(n * x * vector[w])
        top, known = math.fsum(dot), math.fsum(mass)
        if not top:
            return 0.0, 0.0
        return top / math.sqrt(known + self.least**2 * other), top / math.sqrt(known + self.most**2 * other)

    def _runs(self, found: list[str], t: int, weight: dict[str, float]) -> Iterator[tuple[float, float, int, int]]:
        """Bounds, to within EPS, of the runs of the template's length that can match, with their ends."""
        _, vector, n, _ = self.templates[t]
        n = min(n, len(found))
        counts: dict[str, int] = {}
        dot = mass = 0.0
        other = 0
        for i, w in enumerate(found):
            c = counts[w] = counts.get(w, 0) + 1
            if (x := weight.get(w)) is None:
                other += 2 * c - 1
            else:
                mass += x * x * (2 * c - 1)
                dot += x * vector.get(w, 0.0)
            if i >= n:
                w = found[i - n]
                c = counts[w] = counts[w] - 1
                if (x := weight.get(w)) is None:
                    other -= 2 * c + 1
                else:
                    mass -= x * x * (2 * c + 1)
                    dot -= x * vector.get(w, 0.0)
            if i >= n - 1 and dot > EPS:
                high = dot / math.sqrt(mass + self.least**2 * other)
                if high >= self.threshold - EPS:
                    yield high, dot / math.sqrt(mass + self.most**2 * other), i + 1 - n, i + 1

    def scan(self, text: str, whole: bool, more: dict[str, float] | None = None) -> tuple[str | None, float | None, list[str] | None]:
        """The licence and its similarity; or the words without a known weight on which they depend. ``more`` has such weights."""
        named = [(1.0, n) for rest in SPDX.findall(text) for x in re.findall(r"[\w.+-]+", rest) if (n := re.sub(r"(-only|-or-later|\+)$", "", x)) in self.names]
        if named:
            return min(n for _, n in named), 1.0, None
        able = self.able(set(words(text)))
        if not able:
            return None, None, None
        weight = self.weight if more is None else more | self.weight
        lines = [x for line in text.split("\n") if (x := words(MARKER.sub("", line)))]
        found = [w for line in lines for w in line]
        units = []  # largest and least cosine, template, words
        for line in {tuple(x): x for x in lines}.values():
            units += [(*self._bag(line, t, weight), t, line) for t in self.able(set(line))]
        if whole:
            units += [(*self._bag(found, t, weight), t, found) for t in able]
        runs = [(high, low, t, a, b) for t in able if self.templates[t][2] for high, low, a, b in self._runs(found, t, weight)]
        open_, hits = set(), []
        for rank in range(3):
            mine = [u for u in [*units, *runs] if self.templates[u[2]][3] == rank and u[0] >= self.threshold - EPS]
            floor = max([self.threshold, *(u[1] for u in mine)]) - EPS
            for u in mine:
                if u[0] < floor:
                    continue
                part = u[3] if len(u) == 4 else found[u[3] : u[4]]
                lacking = {w for w in part if w not in weight}
                open_ |= lacking
                if not lacking:
                    score = round(self._bag(part, u[2], weight)[0], 12)
                    if score >= self.threshold:
                        hits.append((rank, -score, self.templates[u[2]][0]))
            if hits and not open_:
                break
        if open_:
            return None, None, sorted(open_)
        return (min(hits)[2], -min(hits)[1], None) if hits else (None, None, None)


def is_licence_file(path: Column) -> Column:
    return F.coalesce(F.element_at(F.split(path, "/"), -1).rlike("^(?i)(licen[cs]e|copying)"), F.lit(False))


def directory(path: Column) -> Column:
    """The path up to its last slash; empty at the top."""
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many files of a task have each word; the empty word stands for all files."""
    hold("licences")
    counts: Counter[str] = Counter()
    for batch in batches:
        for text in batch["text"]:
            counts.update({"", *words(text or "")})
            if len(counts) >= COUNTED:
                yield pd.DataFrame(counts.items(), columns=["word", "df"])
                counts.clear()
    yield pd.DataFrame(counts.items(), columns=["word", "df"]).astype({"word": str, "df": "int64"})


def file_frequency(files: DataFrame) -> DataFrame:
    """word, df: how many files have each word; the empty word has the number of files."""
    ship(files.sparkSession)
    return files.select("text").mapInPandas(_count, "word string, df long").groupBy("word").agg(F.sum("df").alias("df"))


def own_licences(files: DataFrame, *, templates=None, threshold: float = THRESHOLD, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``row`` (the columns ``keep``), path, own licence or null, and its similarity: for files of (path, text)."""
    spark = ship(files.sparkSession)
    kinds = (TEMPLATES + NOTICES, TITLES, full_texts()) if templates is None else (templates, [], [])
    frequency = stored(file_frequency(files), "licence-words")
    known = sorted({"", *(w for some in kinds for _, t in some for w in words(t))})
    df = {r["word"]: r["df"] for r in frequency.where(F.col("word").isin(known)).collect()}  # words of the templates only
    matcher = spark.sparkContext.broadcast(Matcher(*kinds, df, df.pop("", 0), threshold))

    @F.pandas_udf(SCANNED)
    def scan(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, whole in batches:
            found = [matcher.value.scan(t or "", bool(w)) for t, w in zip(texts, whole, strict=True)]
            yield pd.DataFrame(found, columns=["own", "similarity", "open"])

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples():
                weights = {x["word"]: matcher.value.weigh(x["df"]) for x in row.dfs}
                out.append((row.id, *matcher.value.scan(row.text, bool(row.whole), weights)[:2]))
            yield pd.DataFrame(out, columns=["id", "own", "similarity"])

    rows = files.select(
        F.struct(*keep).alias("row"), "path", "text", is_licence_file(F.col("path")).alias("whole"),
        scan(F.col("text"), is_licence_file(F.col("path"))).alias("found"))
    first = stored(rows.select(
        F.monotonically_increasing_id().alias("id"), "row", "path", "whole", "found.*",
        F.when(F.col("found.open").isNotNull(), F.col("text")).alias("text")), "licence-first")
    left = first.where("open is not null")
    if left.isEmpty():
        return first.select("row", "path", "own", "similarity")
    lacking = left.select("id", F.explode("open").alias("word")).join(frequency, "word")
    dfs = lacking.groupBy("id").agg(F.collect_list(F.struct("word", "df")).alias("dfs"))
    last = left.select("id", "text", "whole").join(dfs, "id").mapInPandas(settle, "id long, own string, similarity double")
    both = first.join(last.select("id", F.struct("own", "similarity").alias("last")), "id", "left")
    return both.select("row", "path", F.coalesce("own", "last.own").alias("own"), F.coalesce("similarity", "last.similarity").alias("similarity"))


def inherit(scanned: DataFrame) -> DataFrame:
    """``row``, path, own, similarity, licence (own, else inherited) and ``declared_in``: the file's path or the directory."""
    placed = scanned.withColumn("directory", F.when(F.col("path").contains("/"), directory(F.col("path"))).when(F.col("path").isNotNull(), ""))
    by_dir = (
        placed.where(is_licence_file(F.col("path")) & F.col("own").isNotNull())
        .groupBy("directory").agg(F.min_by("own", F.struct(-F.col("similarity"), F.col("own"))).alias("licence"))
    )
    parts = F.split(F.col("directory"), "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(
        n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("ancestor")))
    dirs = placed.where("directory is not null").select("directory").distinct()
    each = dirs.select("directory", F.explode(above).alias("a")).select("directory", "a.depth", "a.ancestor")
    near = (
        each.join(by_dir.withColumnRenamed("directory", "ancestor"), "ancestor")
        .groupBy("directory").agg(F.max_by(F.struct("licence", "ancestor"), "depth").alias("near"))
    )
    out = placed.join(near, "directory", "left")
    return out.select(
        "row", "path", "own", "similarity", F.coalesce("own", "near.licence").alias("licence"),
        F.when(F.col("own").isNotNull(), F.col("path")).otherwise(F.col("near.ancestor")).alias("declared_in"),
    )


def scan_licences(files: DataFrame, *, templates=None, threshold: float = THRESHOLD, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    return inherit(stored(own_licences(files, templates=templates, threshold=threshold, keep=keep), "licences"))
