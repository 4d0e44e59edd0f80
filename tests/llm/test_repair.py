"""Conversation repair against an exhaustive search and an independent fold."""

import hashlib
import itertools
import random
import zlib

import pytest

from feedloom.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """Least (cost, audit) over all edits with at most two inserts in a row, by plain enumeration; rows are (initial, must, truncated)."""
    best, inserts = None, ["", "u", "a", "ua", "au"]
    choices = [[(p, e) for p in inserts for e in (["D"] if must else ["D", "K", "U", "A"])] for _, must, _ in rows]
    for end in inserts:
        for picked in itertools.product(*choices):
            said, audit, cost = "", "", 0
            for (before, edit), (initial, _, truncated) in zip(picked, rows, strict=True):
                said, audit, cost = said + before, audit + "I" * len(before), cost + 2 * len(before)
                if edit == "D":
                    audit, cost = audit + "D", cost + 3
                else:
                    said += initial if edit == "K" else edit.lower()
                    audit, cost = audit + ("K" if edit == "K" else "R"), cost + (edit != "K") * 2 + truncated
            said, audit, cost = said + end, audit + "I" * len(end), cost + 2 * len(end)
            body = said.removeprefix("s")
            if (said == "" or body) and body == "ua" * (len(body) // 2) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def test_edits_are_the_cheapest():
    rnd = random.Random(3)
    for _ in range(60):
        rows = [(rnd.choice("suaax"), rnd.random() < 0.2, rnd.random() < 0.3) for _ in range(rnd.randrange(0, 4))]
        fold = repair.Repair()
        for initial, must, truncated in rows:
            fold.row(initial, must, truncated and not must)
        cost, trail = fold.cheapest()
        assert (cost, trail.translate(repair.AUDIT)) == cheapest([(i, m, t and not m) for i, m, t in rows]), rows


def test_stacks_are_shared():
    fold = repair.Repair()
    for i in range(2000):
        fold.row("sua"[i % 3], False, False)
    assert len(repair.STACKS.nodes) < 20 and len(fold.cheapest()[1]) >= 2000


def plain(rows):
    """Counts, audit and repaired turns of one conversation's damaged rows, its audit by plain strings."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, counts, tops, last = set(), [0, 0, 0, 0], {"": (0, "", ())}, None
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("p", "u"): "u", ("u", "a"): "p"}

    def insert(tops):
        for _ in range(3):
            for (state, (cost, audit, out)), (x, role) in itertools.product(list(tops.items()), (("u", "user"), ("a", "assistant"))):
                to = moves.get((state, x))
                new = (cost + 2, audit + "I", (*out, (role, "")))
                if to is not None and (to not in tops or new < tops[to]):
                    tops[to] = new
        return tops

    tops = insert(tops)
    for _, role, text in rows:
        letters = text.rstrip(" \t\n\x0b\x0c\r")
        fault = 0 if not letters else 1 if (role, text) in seen else 2 if letters[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        counts[3] += last is not None and last + "|" + role[:1] not in ("s|u", "u|a", "a|u")
        last, after = role[:1], {}
        for state, (cost, audit, out) in tops.items():
            ways = [(state, cost + 3, "D", ())]
            if fault not in (0, 1):
                more = fault == 2
                ways += [(moves.get((state, last)), cost + more, "K", ((role, text),))]
                ways += [(moves.get((state, x)), cost + more + 2, "R", ((to, text),)) for x, to in (("u", "user"), ("a", "assistant"))]
            for to, c, edit, said in ways:
                new = (c, audit + edit, out + said)
                if to is not None and (to not in after or new < after[to]):
                    after[to] = new
        tops = insert(after)
    cost, audit, out = min(v for k, v in tops.items() if k in ("", "p"))
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    return (gaps, *counts, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()), out


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if h == 1 else text.translate(str.maketrans("", "", ".!?")) if h == 2 else text
        for _ in range(0 if h == 0 else 2 if h == 3 else 1):
            yield conv, turn, "user" if h == 4 else role, text


def conversations():
    rnd, rows = random.Random(5), []
    for c in range(120):
        for i in range(rnd.randint(1, 14)):
            rows.append((None if rnd.random() < 0.02 else c, rnd.choice([i, i, i + 1, None, 0]), rnd.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "A"]), rnd.choice(["a.", "b!", "c", "", " \n", None, "d?", "é…", "same.", "same.", "x. \t"])))
    return rows + [(900, i, "user" if i % 2 else "assistant", "hot." if i % 3 else f"{i}.") for i in range(3000)] + [(901, 2**62, "user", "a."), (901, -(2**62), "user", "long " * 50_000)]


def told(df):
    return {r["conv_id"]: tuple(r[c] for c in (*repair.COUNTS, "audit", "repaired_sha256")) for r in df.collect()}


def test_repairs_match_a_plain_fold(spark):
    rows = conversations()
    groups = {r[0]: [] for r in rows}
    for conv, turn, role, text in damage(rows):
        groups[conv].append((turn, role, text))
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", step int, edit string").repartition(5)
    repaired = repair.repair(repair.damaged(df))
    want = {conv: plain(rows) for conv, rows in groups.items()}
    assert told(repair.digests(repaired)) == {conv: summary for conv, (summary, _) in want.items()}
    out = {}
    for r in sorted(repair.turns(repaired).collect(), key=lambda r: r["step"]):
        out.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert out == {conv: list(said) for conv, (_, said) in want.items() if said}


def test_conversations_without_rows(spark):
    assert repair.digests(repair.repair(spark.createDataFrame([], SCHEMA))).count() == 0
    gone = next(t for t in range(100) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(7, gone, "user", "a."), (None, None, None, None)], SCHEMA)
    got = told(repair.digests(repair.repair(repair.damaged(df))))
    nothing = hashlib.sha256(b"").hexdigest()
    assert got == {7: (0, 0, 0, 0, 0, 0, "", nothing), None: (0, 1, 0, 0, 0, 3, "D", nothing)}


@pytest.mark.parametrize("text,repeated,want", [("", False, "blank"), (" \x0b", True, "blank"), (" ", False, "truncated"), ("a.", True, "duplicate"), ("a. \n", False, None), ("a. ", False, "truncated")])
def test_faults(text, repeated, want):
    assert repair.fault(text, repeated) == want
