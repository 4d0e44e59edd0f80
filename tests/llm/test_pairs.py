"""Near-duplicates of texts and vectors against brute force."""

import random

import numpy as np

from feedloom.llm import blocks, components, embeddings, neardup

SCHEMA = "doc_id long, text string, node string, n long"


def closed(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingle_set(text):
    words = (text or "").encode().translate(neardup.lower_words.__globals__["LOWER"]).split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return closed(sets, links), sets


def corpus(seed=5):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(900)]
    rows, passage = [], [rnd.choice(vocabulary) for _ in range(40)]
    for base in range(12):
        text = [rnd.choice(vocabulary) for _ in range(rnd.choice((6, 60, 200)))]
        for _ in range(rnd.choice((1, 3, 25))):
            copy = list(text)
            for _ in range(rnd.choice((0, 1, 2, 4))):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            rows.append(" ".join(copy))
        rows.append(" ".join(passage + text[:20]))
    rows += ["", "  \t ", None, "one two", "ONE  two", "one two three", "X " * 3000, "x " * 3000]
    return list(enumerate(rows))


def test_near_duplicates_match_brute_force(spark):
    rows = corpus()
    got = {r["doc_id"]: r for r in neardup.near_duplicates(spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)).collect()}
    want, sets = brute(rows)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (i == want[i]) for i, r in got.items())


def test_dense_group_is_compared_in_blocks(spark, monkeypatch):
    rows = corpus(9)
    monkeypatch.setattr(blocks, "BLOCK", 8)
    monkeypatch.setattr(blocks.blocked, "__defaults__", (8,))
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)).collect()}
    assert got == brute(rows)[0]


def test_null_ids_and_repeated_rows(spark):
    text = " ".join(f"a{i}" for i in range(30))
    rows = [(None, text), (4, text), (4, text), (9, text + " more"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs).collect()) == [
        ((False, 4), 4, True), ((False, 4), 4, True), ((False, 7), 7, True), ((False, 9), 4, False), ((True, 0), 4, False)]
    assert sorted(r["doc_id"] for r in neardup.first_of_class(docs).collect()) == [4, 7]
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_no_text_is_lost_where_ids_repeat_or_are_missing(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (2, b + " more"), (None, c), (None, c), (None, c + " end"), (None, a + " x"), (3, ""), (3, ""), (None, None), (5, c + " q r"), (6, "lone text"), (6, "lone text")]
    docs = spark.createDataFrame([(*r, 7, "k") for r in rows], "doc_id long, text string, rows int, times string")
    kept = neardup.first_of_class(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect())
    assert got == sorted((str(i), str(t)) for i, t in [(1, a), (1, b), (5, c + " q r"), (3, ""), (3, ""), (None, None), (6, "lone text")])


def test_first_of_class_matches_brute_force(spark):
    rows = corpus(4)
    want, _ = brute(rows)
    got = neardup.first_of_class(spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)).collect()
    assert sorted(r["doc_id"] for r in got) == sorted({c for c in want.values()})


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(100, 129)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}


def vectors():
    rnd = np.random.default_rng(4)
    rows, base = [], rnd.standard_normal((60, 24))
    for v in base:
        for _ in range(int(rnd.integers(1, 6))):
            rows.append((v * rnd.uniform(0.1, 9) + rnd.normal(0, 0.09 * np.abs(v).mean() * rnd.integers(0, 5), 24)).astype(np.float32).tolist())
    rows += [base[0].tolist()] * 30 + [[0.0] * 24, None, [], [float("nan")] * 24, [1.0, None] + [0.0] * 22, [1.0, 2.0], [2.0, 4.0], [1e300, 1e300], [float("inf"), 0.0]]
    return list(enumerate(rows))


def brute_vectors(rows):
    sound = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    unit = {i: (s := v / np.abs(v).max()) / np.sqrt((s * s).sum()) for i, v in sound.items()}
    links = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]
    degree = {i: 0 for i, _ in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    return degree, closed(degree, links)


def test_vectors_match_brute_force(spark, monkeypatch):
    rows = vectors()
    for block in (blocks.BLOCK, 4):
        monkeypatch.setattr(blocks.blocked, "__defaults__", (block,))
        got = {r["vec_id"]: r for r in embeddings.near_vectors(spark.createDataFrame([(i, v, 3) for i, v in rows], "vec_id long, embedding array<double>, copies int")).collect()}
        degree, root = brute_vectors(rows)
        assert {i: r["n_links"] for i, r in got.items()} == degree
        assert {i: r["component_id"] for i, r in got.items()} == root
        assert all(r["kept"] == (i == root[i]) for i, r in got.items())


def test_vector_links_are_found_at_the_threshold(spark):
    """Recall of pairs that lie just above the threshold, against all of them."""
    rnd, rows = np.random.default_rng(8), []
    for i in range(300):
        a = rnd.standard_normal(64)
        b = rnd.standard_normal(64)
        a /= np.linalg.norm(a)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist()), (2 * i + 1, (0.951 * a + np.sqrt(1 - 0.951**2) * b).tolist())]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sum(r["n_links"] for r in got.collect()) >= 2 * 300 * 0.97
