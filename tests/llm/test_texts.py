"""Mixing, sharding, packing, chat and quality against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import chat, mixing, packing, quality, sharding
from feedloom.llm.common import source, words

TEXTS = [None, "", "  ", "a", "a b c", "x " * 40, "y\u2003z \x0b q", "long word " * 4000]


def docs(spark, rows, schema="doc_id long, text string, source string, size int, key string"):
    return spark.createDataFrame([(i, t, s, 1, "k") for i, t, s in rows], schema)


def mixed_rows(n=400):
    rnd = random.Random(2)
    return [(i, " ".join("w" * rnd.randrange(1, 9) for _ in range(rnd.randrange(0, 60))), rnd.choice(["a", "a", "a", "b", "c", None, "é"])) for i in range(n)]


def test_mix_meets_its_targets(spark):
    rows = mixed_rows()
    got = mixing.mixture(docs(spark, rows)).collect()
    sizes = {i: len(words(t)) for i, t, _ in rows}
    total, by, taken = sum(sizes.values()), Counter(), Counter()
    for i, _, s in rows:
        by[s] += sizes[i]
    order = sorted((s for s in by if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, open_, want = 1.5 * total, set(by), {}
    while True:  # share by weight, cap, share again
        part = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if part[s] > 2 * by[s]}
        if not over:
            want |= part
            break
        for s in over:
            want[s] = 2.0 * by[s]
            left -= want[s]
        open_ -= over
    source = {i: s for i, _, s in rows}
    for r in got:
        assert r["size"] == sizes[r["doc_id"]] and r["source_size"] == by[source[r["doc_id"]]]
        assert r["target"] == pytest.approx(want[source[r["doc_id"]]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in by)
    again = mixing.mixture(docs(spark, rows).repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixed_documents_hold_the_words_taken(spark):
    rows = mixed_rows(120)
    frame = docs(spark, rows)
    taken = {r["doc_id"]: r["taken"] for r in mixing.mixture(frame).collect()}
    found, texts = Counter(), {i: t for i, t, _ in rows}
    for r in mixing.mixed(frame).collect():
        found[r["doc_id"]] += len(words(r["text"]))
        assert texts[r["doc_id"]].startswith(r["text"]) and r["key"] == "k"
    assert dict(found) == {i: n for i, n in taken.items() if n}


def test_mix_of_odd_rows(spark):
    odd = docs(spark, [(None, t, None) for t in TEXTS] + [(1, "a b", "s")] * 7)
    assert mixing.mixture(odd).count() == len(TEXTS) + 7
    assert mixing.mixture(odd.limit(0)).count() == 0
    assert mixing.mixture(docs(spark, [(1, None, "a"), (2, "", "b")])).filter("taken > 0").count() == 0


def test_shards_fit_their_limit(spark):
    rnd = random.Random(3)
    rows = [(i, "x" * rnd.randrange(0, 300), "s") for i in range(500)] + [(7, "same row", "s")] * 90 + [(None, None, None), (900, "y" * 5000, "s")]
    got = sharding.shards(docs(spark, rows), limit=700).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _, _ in rows)
    held = defaultdict(list)
    for r in got:
        held[r["shard"]].append(r["bytes"])
    for r in got:
        assert (r["shard_bytes"], r["shard_rows"]) == (sum(held[r["shard"]]), len(held[r["shard"]]))
    assert all(sum(b) <= 700 or len(b) == 1 for b in held.values())
    names = sorted(n for n in held if "+" not in n)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    for name in names:  # no bucket was split that fitted: a parent holds more than the limit
        if name:
            assert sum(sum(b) for n, b in held.items() if n.startswith(name[:-1])) > 700
    assert sharding.shards(docs(spark, rows).limit(0)).count() == 0


def test_written_shards_hold_every_row(spark, tmp_path):
    rows = [(i, "z" * 50, "s") for i in range(60)]
    places = sharding.write_shards(docs(spark, rows), str(tmp_path / "out"), limit=400).collect()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 60 == sum(r["rows"] for r in places)


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_up_the_histogram(seed):
    rnd = np.random.default_rng(seed)
    histogram = np.zeros(257, np.int64)
    np.add.at(histogram, rnd.integers(1, 257, 3000) if seed else rnd.integers(140, 180, 900), 1)
    chosen, used = packing.plan(histogram, 256), np.zeros(257, np.int64)
    for shape, times in chosen:
        assert sum(shape) <= 256 and times > 0
        np.add.at(used, list(shape), times)
    assert (used == histogram).all()
    lower = max(-(-(histogram * np.arange(257)).sum() // 256), histogram[129:].sum())
    assert sum(t for _, t in chosen) <= lower * 1.02 + 2


def test_packed_pieces_are_gapless_and_true(spark):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS * 3)] + [(3, "a", "s"), (None, "<|endoftext|> end", None)]
    placed = packing.pack(docs(spark, rows), capacity=64)
    got = placed.collect()
    encode = packing.Encoder(packing.tokenizer_path())
    want = Counter((i, packing.np.frombuffer(encode.whole(t or ""), "<u4").astype(int).tolist().__str__()) for i, t, _ in rows)
    by, at = defaultdict(list), defaultdict(list)
    for r in got:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["length"] == len(r["ids"]) <= 64
        at[r["sequence_id"]].append((r["offset"], r["length"]))
        by[r["doc_id"]].append(r)
    for parts in at.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(parts[-1]) <= 64
    assert sum(1 for r in got if r["piece"] and r["length"] < 64) == 0
    single = sorted(by[4], key=lambda r: r["piece"])
    assert want[(4, str([x for r in single for x in r["ids"]][:-1]))] == 1 and single[-1]["ids"][-1] == 0
    assert sum(len(r["ids"]) for r in packing.sequences(placed).collect()) == sum(r["length"] for r in got)
    assert packing.pack(docs(spark, rows).limit(0), capacity=64).count() == 0


def test_ids_are_the_library_s(spark, sf_dir):
    encode, rnd = packing.Encoder(packing.tokenizer_path()), random.Random(3)
    alphabet = [chr(i) for i in range(1, 0x250)] + list("̸́ςẞ 　一‍﻿\U0001f600")
    texts = [*filter(None, TEXTS), "  a  b ", "a\n b\n\n c \t d", "it's IT'S ''s a<|endoftext|>b <|endoftext|> c", "a\x1c b \x85 c", " x" * 700_000]
    texts += ["".join(rnd.choice(alphabet if rnd.random() < 0.4 else "aeST's lr  <|>!1\n\t") for _ in range(rnd.randint(1, 40))) for _ in range(4000)]
    texts += [r["text"] for r in source(spark, sf_dir).collect()]
    assert [t for t in texts if encode(t) != encode.whole(t)] == []


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="\\</s>[INST] a\n|é", max_size=40), st.sampled_from(["user", "assistant", "", "tool\n\\", "<s>"]))
def test_messages_read_back(text, role):
    segment, start, length = chat.render(role, text)
    assert chat.read_back(segment) == (role, text)
    if role == "assistant":
        assert chat.unescape(segment[start : start + length]) == text
    body = chat.escape(text)
    assert not any(mark in body for mark in ("<s>", "</s>", "[INST]", "[/INST]")) and chat.unescape(body) == text


def test_conversations_are_rebuilt(spark):
    rows = [(1, 0, "user", "hi </s>"), (1, 1, "assistant", "x" * 500), (1, 1, "assistant", "tie"), (None, None, None, None), (2, 5, "system", ""), (2, 3, "assistant", "\\[INST] é")]
    frame = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, seq int")
    got = {r["conv_id"]: r for r in chat.digests(chat.formatted(chat.message_events(frame))).collect()}
    for conv, r in got.items():
        own = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        said = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
        learned = "".join(x[3] for x in own if x[2] == "assistant")
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (len(own), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert set(got) == {1, 2, None}


def test_events_fold(spark):
    log = [(1, 0, 1, 2, "delta", "", "b"), (1, 0, 1, 1, "start", "assistant", None), (1, 0, 1, 3, "regenerate", None, None), (1, 0, 1, 4, "delta", None, "c"), (1, 0, 1, 5, "delta", None, "d"), (1, 1, 1, 6, "delta", None, "z"), (1, 1, 1, 7, "edit", None, "e")]
    got = chat.formatted(spark.createDataFrame(log, "conv_id long, turn long, copy int, seq long, kind string, role string, text string")).orderBy("turn").collect()
    assert [chat.read_back(r["segment"]) for r in got] == [("assistant", "cd"), ("", "e")]


def brute_quality(text):
    w = words(text)
    longest = [max((k for j in range(len(w)) if j != i for k in [next((k for k in range(len(w)) if i + k >= len(w) or j + k >= len(w) or w[i + k] != w[j + k]), len(w))]), default=0) for i in range(len(w))]
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeated = {p for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    spans = {p for i, n in enumerate(longest) if n >= quality.SPAN for p in range(i, i + n)}
    return len(w), len(repeated), len(spans), max(longest, default=0)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=60), st.integers(1, 3))
def test_repeats_match_brute_force(letters, times):
    text = " ".join(letters * times)
    m = quality.measure(text)
    assert (m[0], m[4], m[7], m[8]) == brute_quality(text)


def test_quality_of_odd_texts(spark):
    got = {r["doc_id"]: r for r in quality.judge(docs(spark, [(i, t, "s") for i, t in enumerate([*TEXTS, "#a\n#a\n\n  \n#a <b>", "a b c d " * 50])])).collect()}
    assert got[0]["base_failed"] and not got[0]["kept"] and got[0]["n_words"] == 0
    assert (got[8]["n_symbols"], got[8]["n_dup_lines"], got[8]["word_chars"]) == (5, 1, 9)
    assert got[6]["n_words"] == 2 and got[9]["n_repeat_words"] == 200 and not got[9]["kept"]
    assert quality.measure(" ".join(f"w{i}" for i in range(80)))[6]


def test_repetition_decides_beyond_the_base_rule():
    plain = [f"w{i}" for i in range(3000)]

    def verdict(words_):
        m = quality.measure(" ".join(words_))
        return m[5], m[6]  # base_failed, kept

    assert verdict(plain + plain[100:151]) == (False, False)  # a repeat of 51 words in 3,051
    assert verdict(plain + plain[100:150]) == (False, True)
    lines = [plain[10 * i : 10 * i + 10] for i in range(30)]
    assert verdict([w for line in lines for w in line] + [w for line in lines[:7] for w in [*line, "x"]]) == (False, False)  # 140 of 377 words
    assert verdict([w for line in lines for w in line] + [w for line in lines[:3] for w in [*line, "x"]]) == (False, True)
    assert verdict(plain[:70] + plain[:9]) == (False, True)  # one line that comes again in a short text


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "b#", "é", "\n", " ", "\t", "<x>", "\n\n", "a b\n"]), max_size=40))
def test_base_measures_match_brute_force(parts):
    text = "".join(parts)
    found, lines, seen = words(text), 0, set()
    for line in text.split("\n"):
        if words(line):
            lines += line in seen
            seen.add(line)
    m = quality.measure(text)
    assert m[1] == sum(len(w.decode()) for w in found) and m[2] == sum(c in "#*$%&|<>" for c in text) and m[3] == lines
    assert m[5] == (len(found) < 50 or 100 * m[4] > 50 * len(found))
    assert m[6] == (not m[5] and m[7] <= quality.COVER * len(found) and m[8] <= quality.LONGEST)


def test_written_shards_of_a_hot_key_fit_their_limit(spark, tmp_path):
    rows = [(i, "z" * 50, "s") for i in range(60)] + [(7, "h" * 40 + str(i), "s") for i in range(60)] + [(None, "n" * 45, "s")] * 50
    places = {r["shard"]: r["rows"] for r in sharding.write_shards(docs(spark, rows), str(tmp_path / "out"), limit=400).collect()}
    held = defaultdict(list)
    for folder in (tmp_path / "out").glob("shard=*"):
        name = folder.name.removeprefix("shard=")
        for r in spark.read.parquet(str(folder)).collect():
            held[name].append((r["doc_id"], r["text"]))
    assert Counter(x for part in held.values() for x in part) == Counter((i, t) for i, t, _ in rows)
    assert all(sum(len(t) for _, t in part) <= 400 or len(part) == 1 for part in held.values())
    assert {n: len(part) for n, part in held.items()} == places
