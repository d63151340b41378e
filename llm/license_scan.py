"""Operator 1: licences of files, by sparse TF-IDF cosine to templates and inheritance along directories.

A file's units are its lines, cut further after sentences, so that a notice
is found wherever it stands. A unit and a template sentence are vectors of
term counts times ln((1 + N) / (1 + df)) + 1, with N and df counted over all
files, for every term. A unit with a cosine of ``SIMILAR`` or more, and two
terms in common, carries the licence of its best template.

Document frequencies of all terms are a table, counted by ``groupBy``; the
driver sees those of the templates' terms alone. A first pass keeps the units
that could still be similar if their other terms were in every file, which is
as light as a term gets. The terms of these units are joined with their
frequencies, the ``FREQUENT`` most frequent ones by broadcast, and the units
are then scored exactly.

A file has the licence of its best unit. A file is a licence file if its name
says so or if at least half of its terms stand in units of its licence; it
gives its licence to its directory. A file without a licence takes that of
the nearest directory above it that has one.

Directories are resolved first (each distinct one once, joined with its own
prefixes), then joined to files, so that a directory with a third of all files
is one row among directories; what they inherit is broadcast to the files up to
32 MB, beyond which the join is split where it is skewed.

Rows: null and empty texts have no licence of their own. An empty table gives
no rows; columns beside doc_id, path and text are not looked at. Very long
texts are a batch of their own. Files without a path inherit none. Ties: the first licence by name, the first unit, and of a
directory's licence files the best score, then the first path. Rows that
repeat a path are files like others.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import _tables as T
from llm import _words as W
from panelsight.operators.joins import sized_broadcast

SIMILAR = 0.7
TERM = re.compile(r"[^\W_]+")
UNIT = re.compile(r"\n|(?<=[.!?;:])\s+")
NAMED = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.-].*)?$"

# FIXED VALUES: sentences of well-known licence notices, by SPDX id
TEMPLATES = {
    "AGPL-3.0": ["This program is licensed under the GNU Affero General Public License, version 3.", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3"],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\");",
        "you may not use this file except in compliance with the License.",
        "Apache License Version 2.0, January 2004",
    ],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", "BSD 2-Clause License"],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.", "BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related rights to this work."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "ISC License"],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3.", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "The MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v.", "Mozilla Public License Version 2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
VOCABULARY = sorted({w for ts in TEMPLATES.values() for t in ts for w in TERM.findall(t.lower())})


def terms(text: str) -> list[str]:
    return TERM.findall(text.lower())


FREQUENT = 1000  # terms whose frequencies are broadcast


def _frequencies(batches):
    """Files of each term in a slice, and their number as those of the term ''."""
    for b in W.slices(batches, "text"):
        n = Counter()
        for t in b.column("text").to_pylist():
            n.update(set(terms(t or "")))
        yield pa.RecordBatch.from_arrays([pa.array(["", *n]), pa.array([b.num_rows, *n.values()], pa.int64())], ["term", "n"])


def idf(files: int, df: int) -> float:
    return math.log((1 + files) / (1 + df)) + 1


class Model:
    """Template vectors, by term, for files of which ``df['']`` there are; ``df`` has the templates' terms."""

    def __init__(self, df: dict[str, int]):
        self.files = df.get("", 0)
        self.idf = {w: idf(self.files, df.get(w, 0)) for w in VOCABULARY}
        self.index: dict[str, list[tuple[int, float]]] = {}
        self.licence: list[str] = []
        for licence in sorted(TEMPLATES):
            for t in TEMPLATES[licence]:
                w = {x: c * self.idf[x] for x, c in Counter(terms(t)).items()}
                norm = math.sqrt(sum(v * v for v in w.values()))
                for x, v in w.items():
                    self.index.setdefault(x, []).append((len(self.licence), v / norm))
                self.licence.append(licence)

    def best(self, unit: dict[str, int], others: dict[str, float] | None = None) -> tuple[str, float] | None:
        """Licence and cosine of the best template, if they are similar.

        ``others`` weighs the terms that no template has; without it they weigh
        1, the least there is, so that no cosine is underrated.
        """
        inside, outside = 0.0, 0.0
        weights = {}
        for x, c in unit.items():
            if x in self.idf:
                weights[x] = v = c * self.idf[x]
                inside += v * v
            else:
                outside += (c * others[x] if others is not None else c) ** 2
        if inside < SIMILAR**2 * (inside + outside) or len(weights) < 2:  # no template's cosine is greater than sqrt of this share
            return None
        dots: dict[int, float] = {}
        shared: Counter = Counter()
        for x, v in weights.items():
            for t, w in self.index[x]:
                dots[t] = dots.get(t, 0.0) + v * w
                shared[t] += 1
        score, t = max(((round(d / math.sqrt(inside + outside), 9), -t) for t, d in dots.items() if shared[t] > 1), default=(0.0, 0))
        return (self.licence[-t], min(1.0, score)) if score >= SIMILAR else None

    def candidates(self, text: str | None) -> tuple[list[tuple[int, dict[str, int]]], int]:
        """Numbered units that may be similar to a template, and the number of all terms."""
        units = [Counter(terms(u)) for u in UNIT.split(text or "")]
        return [(k, u) for k, u in enumerate(units) if self.best(u)], sum(sum(u.values()) for u in units)

    def file(self, units: list[tuple[dict[str, int], dict[str, float]]]) -> tuple[str | None, float, int]:
        """(licence, score, terms in units of that licence) of units in order, each with the weights of its other terms."""
        found = [(self.best(u, others), sum(u.values())) for u, others in units]
        own = [(-b[1], b[0]) for b, _ in found if b]
        if not own:
            return None, 0.0, 0
        score, licence = min(own)
        return licence, -score, sum(n for b, n in found if b and b[0] == licence)


UNITS = pa.list_(pa.struct([("unit", pa.int32()), ("term", pa.string()), ("c", pa.int32())]))


def scan(files: DataFrame) -> DataFrame:
    """One row per row of ``files(doc_id, path, text)``: doc_id, path, dir, own, score, is_file (a licence file)."""
    rows = files.select("doc_id", F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    frequencies = T.store(rows.select("text").mapInArrow(_frequencies, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")), "frequencies")
    df = {r.term: r.n for r in frequencies.filter(F.col("term").isin(["", *VOCABULARY])).collect()}  # a row for each term of the templates

    def pick(batches):
        model = Model(df)
        for b in W.slices(batches, "text"):
            got = [model.candidates(t) for t in b.column("text").to_pylist()]
            units = [[{"unit": k, "term": x, "c": c} for k, u in units for x, c in u.items()] for units, _ in got]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("path"), pa.array(units, UNITS), pa.array([n for _, n in got], pa.int64())], ["doc_id", "path", "units", "terms"])

    def score(batches):
        model = Model(df)
        for b in batches:
            out = []
            for unit_terms in b.column("t").to_pylist():
                units: dict[int, tuple[dict, dict]] = {}
                for r in unit_terms:
                    unit, others = units.setdefault(r["unit"], ({}, {}))
                    unit[r["term"]], others[r["term"]] = r["c"], idf(model.files, r["n"])
                out.append(model.file([units[k] for k in sorted(units)]))
            yield pa.RecordBatch.from_arrays([b.column("uid"), *(pa.array([o[k] for o in out], t) for k, t in enumerate((pa.string(), pa.float64(), pa.int64())))], ["uid", "own", "score", "inside"])

    kind = files.schema["doc_id"].dataType.simpleString()
    picked = rows.mapInArrow(pick, f"doc_id {kind}, path string, units array<struct<unit:int,term:string,c:int>>, terms long")
    picked = T.store(picked.withColumn("uid", F.monotonically_increasing_id()), "units")
    asked = picked.select("uid", F.inline("units"))
    common = frequencies.filter("term <> ''").orderBy(F.desc("n"), "term").limit(FREQUENT).select(F.col("term").alias("of"), "n")
    often = asked.join(F.broadcast(common), F.col("term") == F.col("of")).drop("of")
    seldom = asked.join(F.broadcast(common), F.col("term") == F.col("of"), "left_anti").join(frequencies.withColumnRenamed("term", "of"), F.col("term") == F.col("of")).drop("of")
    grouped = often.unionByName(seldom).groupBy("uid").agg(F.collect_list(F.struct("unit", "term", "c", "n")).alias("t"))  # of a file
    scored = grouped.mapInArrow(score, "uid long, own string, score double, inside long").withColumnRenamed("uid", "of")
    found = picked.join(scored, F.col("uid") == F.col("of"), "left")
    named = F.coalesce(F.element_at(F.split("path", "/"), -1).rlike(NAMED), F.lit(False))
    return found.select("doc_id", "path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir"), "own", F.coalesce("score", F.lit(0.0)).alias("score"),
                        (F.col("own").isNotNull() & (named | (2 * F.col("inside") >= F.col("terms")))).alias("is_file"))


def licences(files: DataFrame) -> DataFrame:
    """One row per row of ``files(doc_id, path, text)``: doc_id, path, licence, origin (own, inherited or none), score, from_dir."""
    found = T.store(scan(files), "licences")
    declared = (found.filter("is_file and path is not null").groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("worse"), "path", "own")).alias("best"))
                .select(F.col("dir").alias("above"), F.col("best.own").alias("given")))
    wanted = found.filter("own is null and path is not null").select("dir").distinct()
    parts = F.split("dir", "/")
    prefixes = wanted.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("prefix")).distinct()
    nearest = (prefixes.join(declared, F.col("prefix") == F.col("above")).groupBy("dir").agg(F.max(F.struct(F.length("prefix").alias("depth"), "prefix", "given")).alias("near"))
               .select(F.col("dir").alias("in_dir"), F.col("near.prefix").alias("prefix"), F.col("near.given").alias("given")))
    joined = found.join(sized_broadcast(nearest), (F.col("dir") == F.col("in_dir")) & F.col("own").isNull() & F.col("path").isNotNull(), "left")
    origin = F.when(F.col("own").isNotNull(), "own").when(F.col("given").isNotNull(), "inherited").otherwise("none")
    return joined.select("doc_id", "path", F.coalesce("own", "given").alias("licence"), origin.alias("origin"), "score", F.col("prefix").alias("from_dir"))


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """``documents`` as files: source and language are directories."""
    docs = T.documents(spark, sf_dir)
    return licences(docs.select("doc_id", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"), "text"))
