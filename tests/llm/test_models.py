"""Language, toxicity and license operators: brute force on small models, held-out accuracy on the driver's tables."""

import itertools
import math
import random
import re
import textwrap

import numpy as np

from feedloom.llm import langid, licenses, toxicity
from feedloom.llm.common import source


def test_filters_agree_with_plain_sets(spark):
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate([("the thing there", "en"), ("der die das", "de"), ("le la les", "fr")] * 20)]
    filters = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string, score string"))
    assert filters.languages == ["de", "en", "fr"]
    for text in ("the there", "la das der", "zz"):
        codes = langid.trigrams(text)
        sets = {lang: {c for i, t, x, _ in rows if x == lang for c in langid.trigrams(t).tolist()} for lang in filters.languages}
        want = max(filters.languages, key=lambda x: sum(c in sets[x] for c in codes.tolist()))
        said, sure = langid.decide(text, filters)
        assert said == want and abs(sure - sum(c in sets[want] for c in codes.tolist()) / len(codes)) < 0.01
    assert langid.decide(None, filters) == langid.decide("12 %", filters) == ("und", 0.0)


def test_trigrams_pad_words_and_skip_other_characters():
    spelled = ["".join(chr(int(c) >> s & 0x1FFFFF) for s in (42, 21, 0)) for c in langid.trigrams("Ab, c1d")]
    assert spelled == [" ab", "ab ", "b c", " c ", "c d", " d "]


def test_languages_of_held_out_texts(spark, sf_dir):
    docs = source(spark, sf_dir)
    got = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    rows = docs.select("doc_id", "lang").collect()
    held = [(got[r["doc_id"]]["lang_pred"], r["lang"]) for r in rows if got[r["doc_id"]]["held_out"]]
    assert len(got) == len(rows) and np.mean([a == b for a, b in held]) > 0.95


def test_language_without_training_rows(spark):
    rows = spark.createDataFrame([(1, "text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(rows).collect()} == {("und", 0.0)}
    assert langid.identify(rows.limit(0)).count() == 0


def test_marginals_match_enumeration():
    rnd = np.random.default_rng(1)
    odds, first = rnd.normal(0, 2, 9), np.array([1, 0, 0, 0, 1, 0, 1, 0, 0], bool)
    move, start = rnd.normal(0, 1, (2, 2)), -0.7
    weight, hits, moves = 0.0, np.zeros(9), np.zeros((2, 2))
    for y in itertools.product((0, 1), repeat=9):
        w = math.exp(sum(o for o, s in zip(odds, y) if s) + sum(start for f, s in zip(first, y) if f and s) + sum(move[y[i - 1], y[i]] for i in range(1, 9) if not first[i]))
        weight += w
        hits += w * np.array(y)
        for i in range(1, 9):
            if not first[i]:
                moves[y[i - 1], y[i]] += w
    got, moved = toxicity.marginals(odds, first, move, start)
    assert np.allclose(got, hits / weight) and np.allclose(moved, moves / weight)
    long = np.concatenate([odds] * 50)
    assert np.allclose(toxicity.marginals(long, np.concatenate([first] * 50), move, start)[0], np.tile(got, 50))


def toxic_rows(n=600):
    rnd = random.Random(6)
    clean = ["".join(rnd.choice("aeioulmnrst") for _ in range(5)) for _ in range(300)]
    rows = []
    for i in range(n):
        words = [rnd.choice(clean) for _ in range(rnd.randrange(3, 40))]
        toxic = int(i % 7 == 0)
        if toxic:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(["bad", "vile"]) + rnd.choice(["", "ly", "ness"]))
        rows.append((i, " ".join(words).capitalize() + ".", toxic))
    return rows


def test_toxic_texts_and_spans(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([(*r[:2], 1.0) for r in rows] + [(5000, None, 0.0), (5001, "", 0.0), (None, "1 2", 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5000, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    held = [(got[i]["predicted"], y) for i, _, y in rows if got[i]["held_out"]]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert got[5000]["predicted"] == got[5001]["predicted"] == got[None]["predicted"] == 0
    i, text, _ = rows[0]
    assert {text[s["start"] : s["end"]].lower() for s in got[i]["spans"]} == set(re.findall(r"\b(?:bad|vile)\w*", text.lower()))


def test_places_are_those_of_the_text_itself():
    text = "\u0130\u0130 a\u0130b vileness \u0130, end"
    assert [text[a:b] for a, b in toxicity.places(text) if text[a:b].isascii()] == ["b", "vileness", "end"]
    plain = "Bad, VILE x1y"
    assert [plain[a:b] for a, b in toxicity.places(plain)] == ["Bad", "VILE", "x", "y"]
    assert len(toxicity.places(text)) == len(toxicity.TOKEN.findall(text.lower()))


def test_toxicity_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert [(r["score"], r["predicted"]) for r in toxicity.score(docs, labels.limit(0)).collect()] == [(0.0, 0)]
    assert toxicity.score(docs.limit(0), labels).count() == 0


def brute_cosines(line, templates):
    rows, unknown, _ = licenses.model(templates)
    idf = {t: w for _, _, t, w, _ in rows}
    bag = {t: licenses.terms(line).count(t) * idf.get(t, unknown) for t in licenses.terms(line)}
    norm = math.sqrt(sum(w * w for w in bag.values())) or 1.0
    return max((round(sum(w * u for _, _, t, _, u in (r for r in rows if r[0] == k) for w in [bag.get(t, 0.0)]) / norm, 9), name) for k, (name, _) in enumerate(templates))


def test_notices_match_brute_force(spark):
    rnd, lines = random.Random(8), []
    for _, text in licenses.TEMPLATES:
        words = text.split()
        lines += [text, text.upper(), " ".join(rnd.sample(words, len(words))), " ".join(words[: len(words) * 2 // 3]), text + " " + " ".join(["other"] * len(words)), " ".join(w for w in words if rnd.random() < 0.8)]
    lines += ["", "plain words only", "license license"]
    frame = spark.createDataFrame([(i, "intro\n" + t + "\nend") for i, t in enumerate(lines)], "i int, text string")
    got = {r["i"]: r["found"] for r in frame.select("i", licenses.notice_lines(frame["text"]).alias("found")).collect()}
    for i, line in enumerate(lines):
        cosine, _ = brute_cosines(line, licenses.TEMPLATES)
        assert [round(x["cosine"], 6) for x in got[i]] == ([round(cosine, 6)] if cosine >= licenses.THRESHOLD else []), line
        if line in dict((t, n) for n, t in licenses.TEMPLATES):
            assert got[i][0]["license"] == {t: n for n, t in licenses.TEMPLATES}[line]


def test_the_search_ahead_loses_no_match():
    strings, pattern = licenses._searches(tuple(licenses.TEMPLATES), tuple(licenses.HEADERS), tuple(licenses.BODIES), licenses.THRESHOLD)
    found = lambda text: any(s in text.lower() for s in strings) and re.search(pattern, text)
    rnd, seen = random.Random(2), [0, 0]
    for _, text in licenses.TEMPLATES:
        for _ in range(300):
            line = " ".join(w for w in text.split() if rnd.random() < 0.75)
            match = brute_cosines(line, licenses.TEMPLATES)[0] >= licenses.THRESHOLD if licenses.terms(line) else False
            seen[match] += 1
            assert found(line) or not match
    assert min(seen) > 100
    assert not found("the code is free: copy it into 4 or 5 small things, smith and omit")
    assert all(found(text) for _, text in [*licenses.HEADERS, *licenses.BODIES])


def test_licenses_are_inherited_from_the_nearest_directory(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [(1, "LICENSE", mit), (2, "a/LICENSE", gpl), (3, "a/b/c/x.txt", "text"), (4, "d/y.txt", "text"), (5, "a/own.txt", "word " * 200 + "\n" + mit), (6, None, None), (7, "ab/z.txt", ""), (3, "a/b/c/x.txt", "text")]
    got = sorted(((r["doc_id"], r["license"], r["inherited_from"], r["is_licence_file"]) for r in licenses.scan(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, path string, text string, license string")).collect()))
    assert got == [(1, "MIT", None, True), (2, "GPL-3.0", None, True), (3, "GPL-3.0", "a", False), (3, "GPL-3.0", "a", False), (4, "MIT", "", False), (5, "MIT", None, False), (6, "MIT", "", False), (7, "MIT", "", False)]
    assert licenses.scan(spark.createDataFrame([], "doc_id long, path string, text string")).count() == 0


def wrapped(text, width, mark=""):
    return "\n".join(mark + line for part in text.split("\n\n") for line in [*textwrap.wrap(" ".join(part.split()), width), ""])


def test_wrapped_and_embedded_licenses(spark):
    bodies = dict(licenses.BODIES)
    gpl2 = 'This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.'
    apache = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
    prose, code = "garden river " * 300, "value = call(argument)\n" * 500
    cases = [(name, "The License\n\nCopyright (c) 2020 Some One\n\n" + wrapped(text, width), name, True) for name, text in bodies.items() for width in (40, 79)]
    cases += [(f"{name} in code", wrapped(bodies[name], 60, " * ") + code, name, False) for name in ("MIT", "BSD-3-Clause", "BSD-2-Clause", "ISC")]
    cases += [("both", bodies["MIT"] + "\n\n" + bodies["Apache-2.0"], {"MIT", "Apache-2.0"}, True), ("owner", "Copyright (c) 2020 Some One and others\nReleased under the MIT License.", "MIT", True)]
    cases += [("gpl2", wrapped(gpl2, 40, "# ") + code, "GPL-2.0", False), ("apache", wrapped(apache, 30, "// ") + code, "Apache-2.0", False)]
    cases += [("long line", f"{prose}{notice} {prose}", name, False) for notice, name in ((apache, "Apache-2.0"), (gpl2, "GPL-2.0"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"))]
    cases += [("prose", prose, None, False), ("mit mit", "mit mit den und mit " + prose, None, False), ("null", None, None, False)]
    frame = spark.createDataFrame([(i, f"{i}/x", text) for i, (_, text, _, _) in enumerate(cases)], "doc_id long, path string, text string")
    got = {r["doc_id"]: r for r in licenses.scan(frame).collect()}
    wrong = [(what, got[i]["own_license"], got[i]["own_cosine"], got[i]["is_licence_file"]) for i, (what, _, name, whole) in enumerate(cases) if (got[i]["own_license"] not in name if isinstance(name, set) else got[i]["own_license"] != name) or got[i]["is_licence_file"] != whole]
    assert not wrong
    assert all(got[i]["own_cosine"] > 0.9 for i, (_, _, name, _) in enumerate(cases) if name)


def test_every_offending_stem_is_chosen(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    bad = ["".join(x) for x in itertools.islice(itertools.product("cdef", letters, letters), 420)]
    rows = [(f"{word} {plain}", 1) for word in bad for plain in ("alpha", "beta", "gamma")]
    rows += [(f"alpha beta gamma x{a}{b}", 0) for a in letters[:10] for b in letters[:10]]
    sample = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, toxic int")
    assert {s.removeprefix("=") for s in toxicity.offending_stems(sample)} == set(bad)
