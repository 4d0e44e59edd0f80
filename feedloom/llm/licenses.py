"""License scans: TF-IDF cosines of notices to templates, then inheritance from the nearest directory.

A file's lines are compared with the templates as sparse vectors.  A template's heaviest terms are its anchors: so many
that a line without any of them cannot reach the threshold, however it is composed, so lines are passed over by one
array test and nothing is lost.  For the lines left, dot products run over their terms and the templates' weights, which
are constants of the plan (their number is fixed here), so scanning moves no row.  Before a text is cut into lines and
terms at all, it is searched for the terms without which none of its lines or windows can reach the threshold.

Notices that wrap over lines or stand inside long ones are found in the whole text's terms: windows as long as a
template are compared with it, so line breaks, paragraphs and comment marks do not count.  Windows of short notices
begin at every term of the notice; those of full license texts (``texts``) at every eighth of their length.  A window
counts if it reaches the threshold and holds more than half of the template's distinct terms; terms a template does not
have weigh as unknown ones.  Only templates whose terms in the file could reach the threshold at all are slid over it,
and only windows whose norm without repeats allows it are measured, so again nothing is lost.

A file with a notice has that license.  A licence file is one whose terms as a whole (without copyright lines) reach the
threshold with a notice or a full text, or that full texts hold at least ``HELD`` of.  It also speaks for its directory: files without a notice take the
license of the nearest directory above them that has one.  That is looked up per directory, not per file: ancestors of
distinct directories are joined with licensed directories by path, and files then join their directory.

Defined results: null text has no notice; null path lies in the root directory ``""``; a full text goes before notices,
and of several of one kind the highest cosine counts, ties by license name; of several licence files of one directory the highest cosine, ties by license
name; repeated rows are judged each; no rows, no result.  Native: DataFrame functions only.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from functools import lru_cache, reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import stage

THRESHOLD = 0.7
#: Share of a licence file's terms that full texts hold, where it is a collection of several.
HELD = 0.5
#: Windows of a full text begin at every such part of its length.
STEPS = 8
SPLIT = r"[^a-z0-9.+-]+"
#: Words of ordinary prose, no terms here.
COMMON = set("a all and any are as at be by can for from has in is it may not of on or that the this to under use with you".split())
#: Customary notices, by SPDX name.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See LICENSE in the project root for license information."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

#: Notices that are looked for in windows alone, beside the templates: they differ from those by the version or name only.
HEADERS = [
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
]
#: Full license texts by SPDX name; that of AGPL-3.0 is GPL-3.0's with its name.
BODIES = [(p.stem, p.read_text("utf-8")) for p in sorted((Path(__file__).parent / "texts").glob("*.txt"))]
#: Lines that name the owner are no part of a license.
OWNER = r"(?im)^[^a-z0-9\n]*(copyright|\(c\)|\u00a9|all rights reserved)[^\n]*$"


def terms(text: str) -> list[str]:
    """Terms of a text, as ``term_array`` has them; words of ordinary prose are none."""
    return [t for t in (x.strip(".-") for x in re.split(SPLIT, text.lower())) if t and t not in COMMON]


def term_array(text: Column) -> Column:
    cut = F.transform(F.split(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), SPLIT), lambda t: F.trim(t, F.lit(".-")))
    return F.filter(cut, lambda t: (t != "") & ~t.isin(sorted(COMMON)))


def model(templates=TEMPLATES, threshold: float = THRESHOLD) -> tuple[list[tuple[int, str, str, float, float]], float, set[str]]:
    """Rows (template, license, term, idf, unit weight), the idf of a term in no template, and the anchors."""
    bags = [(name, Counter(terms(text))) for name, text in templates]
    frequency = Counter(t for _, bag in bags for t in bag)
    idf = {t: 1 + math.log((1 + len(bags)) / (1 + f)) for t, f in frequency.items()}
    rows, anchors = [], set()
    for i, (name, bag) in enumerate(bags):
        weight = {t: n * idf[t] for t, n in bag.items()}
        norm = math.sqrt(sum(w * w for w in weight.values()))
        unit = {t: w / norm for t, w in weight.items()}
        rows += [(i, name, t, idf[t], w) for t, w in unit.items()]
        left = 1.0
        for t in sorted(unit, key=lambda t: (-unit[t], t)):
            if math.sqrt(max(left, 0.0)) < threshold:  # what is left bounds the cosine of a line without the anchors
                break
            anchors.add(t)
            left -= unit[t] ** 2
    return rows, 1 + math.log(1 + len(bags)), anchors


def needed(templates, threshold: float = THRESHOLD) -> set[str]:
    """Terms of which a text must have one for anything in it to reach the threshold with any of the templates.

    A cosine is at most the root of the squared weights of the template's terms that are there.  So many terms are
    taken that those left stay below the threshold: long words first, as prose hardly has them.
    """
    rows, _, _ = model(templates, threshold)
    chosen = set()
    for i in range(len(templates)):
        left, unit = 1.0, {t: u for k, _, t, _, u in rows if k == i}
        for t in sorted(unit, key=lambda t: (len(t) < 5 or t.isdigit(), -unit[t], t)):
            if left < (threshold - 1e-6) ** 2:
                break
            chosen.add(t)
            left -= unit[t] ** 2
    return chosen


def few_needed(templates, threshold: float = THRESHOLD) -> set[str]:
    """As ``needed``, but as few strings as a greedy choice finds for all templates together.

    A string stands for all terms that it is part of, and each one is taken for what it adds where most is missing.
    """
    rows, _, _ = model(templates, threshold)
    need = 1 - (threshold - 1e-6) ** 2 + 1e-9
    open_ = [{t: u * u for k, _, t, _, u in rows if k == i} for i in range(len(templates))]
    got, chosen = [0.0] * len(open_), set()
    terms_ = sorted({t for own in open_ for t in own})
    within = {t: [x for x in terms_ if t in x] for t in terms_}
    while any(g < need for g in got):
        gain = {t: sum(min(need - g, sum(own.get(x, 0.0) for x in within[t])) for own, g in zip(open_, got, strict=True) if g < need) for t in terms_}
        best = max(terms_, key=lambda t: (gain[t] > 1e-9, min(len(t), 4), t.isalpha(), gain[t], t))  # prose has few of the longer ones
        chosen.add(best)
        for i, own in enumerate(open_):
            got[i] += sum(own.pop(x, 0.0) for x in within[best])
    return chosen


@lru_cache(maxsize=4)
def _searches(templates: tuple, headers: tuple, bodies: tuple, threshold: float) -> tuple[tuple[str, ...], str]:
    """Strings of which a text must have one, and a pattern of which it must have a match: each loses nothing."""
    kinds = [templates, (*templates, *headers), bodies]
    strings = set().union(*(few_needed(k, threshold) for k in kinds))
    return tuple(sorted(strings)), _any_of(set().union(*(needed(k, threshold) for k in kinds)))


def _any_of(names: set[str]) -> str:
    """Pattern of texts with one of some terms, by their first letters; a hit need not be a whole term."""
    heads: dict[str, list[str]] = {}
    for t in sorted(names):
        heads.setdefault(t[0], []).append(re.escape(t[1:]))
    return "(?i)(?<![a-z0-9+])(?:" + "|".join(f"{re.escape(h)}(?:{'|'.join(rest)})" for h, rest in heads.items()) + ")(?![a-z0-9+])"


def _weights(pairs: list[tuple[str, float]]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs for x in pair])


def notice_lines(text: Column, templates=TEMPLATES, threshold: float = THRESHOLD) -> Column:
    """Lines of a text that reach the threshold: array of (cosine, license, terms), whole text, in order."""
    return _matching_lines(F.transform(F.split(text, "\n"), term_array), templates, threshold)


def _matching_lines(cut: Column, templates, threshold: float) -> Column:
    rows, unknown, anchors = model(templates, threshold)
    idf = _weights(sorted({(t, w) for _, _, t, w, _ in rows}))
    weigh = lambda t: F.coalesce(idf[t], F.lit(unknown))
    shapes = F.array(*[F.struct(F.lit(name).alias("license"), _weights([(t, u) for k, _, t, _, u in rows if k == i]).alias("unit")) for i, (name, _) in enumerate(templates)])
    lines = F.filter(cut, lambda ts: F.arrays_overlap(ts, F.array(*map(F.lit, sorted(anchors)))))

    def measured(ts: Column) -> Column:
        counted = F.transform(F.array_distinct(ts), lambda t: F.size(F.filter(ts, lambda x: x == t)) * weigh(t))
        return F.struct(ts.alias("terms"), F.sqrt(F.aggregate(counted, F.lit(0.0), lambda s, w: s + w * w)).alias("norm"))

    def score(line: Column) -> Column:
        dot = lambda unit: F.aggregate(line["terms"], F.lit(0.0), lambda s, t: s + weigh(t) * F.coalesce(unit[t], F.lit(0.0)))
        best = F.array_min(F.transform(shapes, lambda k: F.struct((-F.round(dot(k["unit"]) / line["norm"], 9)).alias("order"), k["license"].alias("license"))))
        return F.struct(best.alias("best"), F.size(line["terms"]).alias("terms"))

    scored = F.transform(F.transform(lines, measured), score)
    named = F.transform(scored, lambda x: F.struct((-x["best"]["order"]).alias("cosine"), x["best"]["license"].alias("license"), x["terms"].alias("terms")))
    return F.filter(named, lambda x: x["cosine"] >= threshold)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _shapes(templates, threshold: float, steps: int | None) -> tuple[Column, list[str], int]:
    """Templates to slide, as a constant; the terms by which files are passed over; how few of those can ever do."""
    rows, unknown, _ = model(templates, threshold)
    shapes, seen, fewest = [], set(), len(rows)
    for i, (name, text) in enumerate(templates):
        own = {t: (idf, unit) for k, _, t, idf, unit in rows if k == i}
        heavy, need = {t: unit**2 for t, (_, unit) in own.items()}, threshold**2 - 1e-9
        most, length = len(own) // 2 + 1, len(terms(text))
        seen, fewest = seen | set(heavy), min(fewest, most)
        weight = {t: {"idf": idf, "dot": idf * unit} for t, (idf, unit) in own.items()}
        shapes.append({"license": name, "length": length, "step": max(1, length // steps) if steps else 1, "most": most, "need": need, "unknown": unknown, "heavy": heavy, "weight": weight})
    kind = "array<struct<license:string,length:int,step:int,most:int,need:double,unknown:double,heavy:map<string,double>,weight:map<string,struct<idf:double,dot:double>>>>"
    return F.from_json(F.lit(json.dumps(shapes)), kind), sorted(seen), fewest


def _measure(window: Column, k: Column) -> Column:
    """Cosine of some terms to a template, and how many of its distinct terms they hold."""

    def add(s: Column, t: Column) -> Column:
        run = F.when(t == s["last"], s["run"] + 1).otherwise(F.lit(1))
        own = k["weight"][t]
        return _let(F.struct(run.alias("run"), own.alias("own")), lambda x: F.struct(
            t.alias("last"), x["run"].alias("run"),
            (s["square"] + (2 * x["run"] - 1) * F.pow(F.coalesce(x["own"]["idf"], k["unknown"]), F.lit(2.0))).alias("square"),
            (s["dot"] + F.coalesce(x["own"]["dot"], F.lit(0.0))).alias("dot"),
            (s["known"] + F.when((x["run"] == 1) & x["own"].isNotNull(), 1).otherwise(0)).alias("known"),
        ))

    start = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0.0).alias("square"), F.lit(0.0).alias("dot"), F.lit(0).alias("known"))
    return F.aggregate(F.sort_array(window), start, add, lambda s: F.struct(F.coalesce(F.round(s["dot"] / F.sqrt(F.nullif(s["square"], F.lit(0.0))), 9), F.lit(0.0)).alias("cosine"), s["known"].alias("known")))


def _windows(ts: Column, k: Column, threshold: float) -> Column:
    """Windows of a template's length that match it: array of (cosine, license, start, stop)."""
    weights = F.transform(ts, lambda t: _let(k["weight"][t], lambda w: F.struct(F.coalesce(w["dot"], F.lit(0.0)).alias("dot"), F.pow(F.coalesce(w["idf"], k["unknown"]), F.lit(2.0)).alias("square"))))

    def likely(ws: Column, p: Column) -> Column:
        sums = F.aggregate(F.slice(ws, p + 1, k["length"]), F.struct(F.lit(0.0).alias("dot"), F.lit(0.0).alias("square")), lambda s, w: F.struct((s["dot"] + w["dot"]).alias("dot"), (s["square"] + w["square"]).alias("square")))
        begins = (k["step"] > 1) | (ws[p]["dot"] > 0)
        return F.when(begins, _let(sums, lambda s: s["dot"] >= (threshold - 1e-6) * F.sqrt(s["square"]))).otherwise(F.lit(False))

    starts = _let(weights, lambda ws: F.filter(F.sequence(F.lit(0), F.size(ws) - 1, k["step"]), lambda p: likely(ws, p)))
    found = F.transform(starts, lambda p: _let(_measure(F.slice(ts, p + 1, k["length"]), k), lambda m: F.struct(m["cosine"].alias("cosine"), k["license"].alias("license"), p.alias("start"), F.least(p + k["length"], F.size(ts)).alias("stop"), (m["known"] >= k["most"]).alias("whole"))))
    return F.transform(F.filter(found, lambda x: (x["cosine"] >= threshold) & x["whole"]), lambda x: F.struct(x["cosine"].alias("cosine"), x["license"].alias("license"), x["start"].alias("start"), x["stop"].alias("stop")))


LINES = "array<struct<cosine:double,license:string,terms:int>>"
SPANS = "array<struct<cosine:double,license:string,start:int,stop:int>>"


def matches(text: Column, templates=TEMPLATES, threshold: float = THRESHOLD, headers=HEADERS, bodies=BODIES, low: Column | None = None) -> Column:
    """What a text has of the templates: its lines, windows of its terms that match notices (``short``) and full texts
    (``full``), whether it does so as a whole, and the number of its terms; null without any term that a match needs.
    The raw text (``low``: in lower case) is searched for these first, as strings and by a pattern; it is cut into terms once."""
    strings, likely = _searches(tuple(templates), tuple(headers), tuple(bodies), threshold)
    low = F.lower(text) if low is None else low
    passed = reduce(Column.__or__, (low.contains(s) for s in strings)) & text.rlike(likely)
    kinds = {"short": _shapes([*templates, *headers], threshold, None), "full": _shapes(bodies, threshold, STEPS)}
    anchors = sorted(model(templates, threshold)[2])
    heavy = sorted({*anchors, *(t for _, seen, _ in kinds.values() for t in seen)})

    def possible(present: Column, shapes: Column, fewest: int) -> Column:
        can = F.filter(shapes, lambda k: F.aggregate(present, F.lit(0.0), lambda s, t: s + F.coalesce(k["heavy"][t], F.lit(0.0))) >= k["need"])
        return F.when(F.size(present) >= fewest, can).otherwise(F.slice(shapes, 1, 0))

    def like(bare: Column, ks: Column) -> Column:
        return F.exists(ks, lambda k: _let(_measure(bare, k), lambda m: (m["cosine"] >= threshold) & (m["known"] >= k["most"])))

    def compared(ts: Column, ks: Column) -> Column:
        bare = term_array(F.regexp_replace(text, OWNER, " "))
        found = F.struct(F.flatten(F.transform(ks, lambda k: _windows(ts, k, threshold))).alias("windows"), _let(bare, lambda b: like(b, ks)).alias("whole"))
        return F.when(F.size(ks) > 0, found).otherwise(F.struct(F.array().cast(SPANS).alias("windows"), F.lit(False).alias("whole")))

    def judged(lines: Column, ts: Column) -> Column:
        present = F.array_distinct(F.filter(ts, lambda t: t.isin(heavy)))
        return _let(present, lambda p: F.struct(
            F.when(F.arrays_overlap(p, F.array(*map(F.lit, anchors))), _matching_lines(lines, templates, threshold)).otherwise(F.array().cast(LINES)).alias("lines"),
            F.size(ts).alias("terms"),
            *[_let(possible(p, shapes, fewest), lambda ks: compared(ts, ks)).alias(kind) for kind, (shapes, _, fewest) in kinds.items()],
        ))

    cut = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), term_array)
    return F.when(passed, _let(cut, lambda lines: _let(F.flatten(lines), lambda ts: judged(lines, ts))))


def _held(spans: Column) -> Column:
    """Terms in the union of windows."""
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"))))
    grown = lambda s, x: F.struct(F.greatest(s["end"], x["stop"]).alias("end"), (s["held"] + F.greatest(F.lit(0), x["stop"] - F.greatest(s["end"], x["start"]))).alias("held"))
    return F.aggregate(ordered, F.struct(F.lit(0).alias("end"), F.lit(0).alias("held")), grown, lambda s: s["held"])


def parent(path: Column) -> Column:
    """Directory of a path; the root is the empty string."""
    return F.regexp_extract(F.coalesce(path, F.lit("")), r"^(.*)/[^/]*$", 1)


def ancestors(directory: Column) -> Column:
    """A directory and all above it, down to the root: array of (depth, directory)."""
    parts = F.filter(F.split(directory, "/"), lambda p: p != "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("ancestor")))


def scan(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, headers=HEADERS, bodies=BODIES) -> DataFrame:
    """Per row of ``files`` (doc_id, path, text): its own notice and cosine, its license, and the directory it comes from.

    ``inherited_from`` is null where the license is the file's own or where there is none.
    """
    lowered = files.select("doc_id", parent(F.col("path")).alias("directory"), "text", F.lower("text").alias("low"))
    found = lowered.select("doc_id", "directory", matches(F.col("text"), templates, threshold, headers, bodies, F.col("low")).alias("m")).select("doc_id", "directory", "m.*")
    ranked = lambda spans, rank: F.transform(spans, lambda x: F.struct(F.lit(rank).alias("rank"), (-x["cosine"]).alias("order"), x["license"].alias("license")))
    best = F.array_min(F.concat(ranked("lines", 1), ranked(F.col("short.windows"), 1), ranked(F.col("full.windows"), 0)))
    held = F.size("full.windows") > 0
    licence = F.col("short.whole") | F.col("full.whole") | (held & (_held(F.col("full.windows")) >= HELD * F.col("terms")))
    marked = found.select("doc_id", "directory", best.alias("best"), F.coalesce(licence, F.lit(False)).alias("is_licence_file"))
    marked = marked.select("doc_id", "directory", F.col("best.license").alias("own_license"), (-F.col("best.order")).alias("own_cosine"), (F.col("is_licence_file") & F.col("best").isNotNull()).alias("is_licence_file"))
    marked = stage(marked, "lic-files")
    licensed = marked.filter("is_licence_file").groupBy(F.col("directory").alias("ancestor")).agg(F.min(F.struct((-F.col("own_cosine")).alias("order"), F.col("own_license").alias("license")))["license"].alias("license"))
    above = marked.select("directory").distinct().select("directory", F.explode(ancestors(F.col("directory"))).alias("up")).select("directory", "up.depth", "up.ancestor")
    nearest = above.join(licensed, "ancestor").groupBy("directory").agg(F.max(F.struct("depth", "ancestor", "license")).alias("near"))
    out = marked.join(nearest, "directory", "left")
    takes = F.col("own_license").isNull()
    return out.select(
        "doc_id", "directory", "is_licence_file", "own_license", "own_cosine", F.coalesce("own_license", "near.license").alias("license"), F.when(takes, F.col("near.ancestor")).alias("inherited_from")
    )
