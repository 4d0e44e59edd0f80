"""Spelling variants and token counts against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from feedloom.llm import spelling, tokens
from feedloom.llm.common import Recent, source


def brute_variants(rows, every=31, ratio=10):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near, less = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            short = w[:i] + w[i + 1 :]
            less[i, short].add(w)
            if short in n:
                near[w].add(short)
                near[short].add(w)
    for same in less.values():
        for w in same:
            near[w] |= same - {w}
    best = {w: min(near[w], key=lambda v: (-n[v], v)) for w in n if near[w]}
    form = {w: b for w, b in best.items() if n[b] >= ratio * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n)


def told(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_variants_match_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in source(spark, sf_dir).collect()]
    assert told(spelling.variants(source(spark, sf_dir))) == brute_variants(rows)


@pytest.mark.parametrize("block", [1024, 16])
def test_dense_words_chains_and_odd_rows(spark, block):
    rnd = random.Random(4)
    words = {"".join(rnd.choice("abé×") for _ in range(rnd.choice([6, 7, 8, 9, 40]))) for _ in range(900)}
    text = " ".join(w for w in words for _ in range(rnd.choice([1, 2, 3, 30])))
    chain = "aaaaaaaax " * 2000 + "aaaaaaabx " * 150 + "aaaaaabbx " * 12 + "X" * 300 + " " + "x" * 300 + " " + "x" * 299 + "y " + "x" * 299 + "Y"
    rows = [(1, text), (1, text), (None, text), (2, chain), (3, None), (4, ""), (5, "Seven77seven seven"), (2**40, "ABCDEFGÉ abcdefgÉ")]
    df = spark.createDataFrame([(d, t, 1, "k", "w") for d, t in rows], "doc_id long, text string, n int, m string, word string")
    assert told(spelling.variants(df, block=block)) == brute_variants(rows)


def test_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(empty).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")).count() == 0


def test_common_lengths():
    a = np.frombuffer(b"abcdabxx", np.uint8).reshape(1, 2, 4)
    assert spelling.common(a, a).tolist() == [[[4, 2], [2, 4]]]


TEXTS = [
    None, "", " ", "it's IT'S '''s a<|endoftext|>b <|STARTOFTEXT|> <|", "İstanbul éa ſ's K's ﬁ x²y ª × ÷ ß",
    "漢字 abc漢字def 'LL'll 're''VE", "a b c\u0085d\x1cd\x1fe", "12½3 ١٢", " ́a", "≮|endoftext|>", "a\x00b \x7f",
    "x" * 3000, "long word, 漢 " * 120_000,
]


def library_counts(texts):
    encode = tokens.counts(tokens.tokenizer_path(tokens.TOKENIZER)).tokenizer.encode
    return [len(encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_token_counts_are_the_library_s(spark, sf_dir):
    rnd = random.Random(1)
    alphabet = [chr(i) for i in range(1, 0x250)] + list("̸́ςΣẞ 　一가각‍﻿ΩÅ\U0001f600")
    texts = TEXTS + ["".join(rnd.choice(alphabet if rnd.random() < 0.5 else "aeST's lr <|>!1\n") for _ in range(rnd.randint(1, 40))) for _ in range(3000)]
    texts += [r["text"] for r in source(spark, sf_dir).collect()]
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_bytes int, n_tokens int, part string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokens.token_counts(df, sample=200).collect()}
    want = library_counts(texts)
    assert got == {i: (len((t or "").encode()), n, n > 2048) for i, (t, n) in enumerate(zip(texts, want, strict=True))}


def test_token_counts_of_odd_tables(spark):
    schema = "doc_id long, text string"
    assert tokens.token_counts(spark.createDataFrame([], schema)).count() == 0
    got = tokens.token_counts(spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], schema)).collect()
    assert sorted((r["doc_id"] is None, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == [(False, 0, 0, False), (True, 3, 2, False), (True, 3, 2, False)]


def test_summaries_are_bounded_and_keep_the_frequent():
    import pyarrow as pa

    texts = [" ".join(["the", "of", *(f"{chr(97 + i % 26)}q{'z' * (i // 26)}" for i in range(k, k + 40))]) for k in range(0, 4000, 40)]
    found = tokens.summary([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])], 50)
    assert len(found) <= 50 and {"the", "of"} <= {p for p, _ in found}


def test_recent_keeps_what_is_met_again():
    calls = []

    def compute(keys):
        calls.extend(keys)
        return [len(k) for k in keys]

    cache = Recent(lambda key: compute([key])[0], limit=40_000)
    for i in range(3000):
        assert cache.values_of(["hot", f"cold{i}"], compute) == {"hot": 3, f"cold{i}": len(f"cold{i}")}
        assert cache["warm"] == 4
    assert calls.count("hot") == calls.count("warm") == 1 and len(cache) + len(cache.old) < 300
    assert cache["y" * 999] == 999 and "y" * 999 not in cache
    assert cache.values_of(["y" * 999], compute) == {"y" * 999: 999}
