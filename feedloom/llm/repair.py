"""Conversation structure repair: generalised LR over the role grammar, with weighted edits.

    conversation -> nothing | pairs | s pairs        pairs -> u a | pairs u a

The input symbols are the initials of a conversation's roles.  Its stacks form one graph, whose nodes (a state above
another node) are shared by all that reach them.  Each row extends every live stack top by Keep (cost 0), Rerole to
user or assistant (2) and Delete (3); between rows, Insert (2) shifts an empty user or assistant text.  Blank and
duplicate rows must be deleted; a truncated row that stays costs 1 more.  Equal stack tops merge by the minimum of
(cost, audit), where the audit is the string of edits; the cheapest top that the grammar accepts is the repair.
Audits are compared by rank: those of tops that have just read a row are never prefixes of each other, so ranks
among them, and the inserts since then, order all longer ones, and no step looks back.  A top keeps its trail as a
shared chain.

Rows are sorted by conversation and turn.  Repeats within a conversation are found by a grouping on digests before
that, so no task holds texts: the fold sends rows on as it reads them, and edits after the last one, and a second
sort brings both together.  One conversation is folded by one task, since the grammar (and a digest) reads it in
order; the task holds one row and about a byte for each edit.

Defined results: null roles and texts are one space; null ids and turns are values of their own, first in order;
rows of one turn follow each other by role and text; a role's initial is its first character as it is; an empty
text is blank; texts of any length pass through one by one; other columns are ignored; a conversation without rows
is repaired to nothing; no conversations, no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: The automaton: states by what lies on the stack; 5 and 7 have read a pair and reduce at once.
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 5, (3, "u"): 6, (4, "u"): 6, (6, "a"): 7}
REDUCE = {5: 2, 7: 3}  # symbols that a reduction to pairs takes off
GOTO = {0: 3, 1: 4}
ACCEPTED = (0, 3, 4)
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
#: Edits in trails: K, D, rerole to user (U) or assistant (A), insert user (u) or assistant (a); an audit shows initials.
AUDIT = str.maketrans("UAua", "RRII")


class Stacks:
    """The graph of stacks: nodes are (state, node below), each held once; ``shift`` gives the node after a symbol."""

    def __init__(self):
        self.nodes, self.known, self.after = [(0, None)], {(0, None): 0}, {}

    def _node(self, state: int, below: int | None) -> int:
        if (node := self.known.get((state, below))) is None:
            node = self.known[state, below] = len(self.nodes)
            self.nodes.append((state, below))
        return node

    def shift(self, node: int, symbol: str) -> int | None:
        """The node after a symbol and the reductions that it completes; None if it may not follow."""
        if (node, symbol) not in self.after:
            state = SHIFT.get((self.nodes[node][0], symbol))
            if state is None:
                self.after[node, symbol] = None
            else:
                top = self._node(state, node)
                while (taken := REDUCE.get(self.nodes[top][0])) is not None:
                    for _ in range(taken):
                        top = self.nodes[top][1]
                    top = self._node(GOTO[self.nodes[top][0]], top)
                self.after[node, symbol] = top
        return self.after[node, symbol]

    def accepts(self, node: int) -> bool:
        return self.nodes[node][0] in ACCEPTED


STACKS = Stacks()  # at most eight stacks live: pairs are reduced as they are read


class Repair:
    """The live stack tops of one conversation, each as (cost, rank of its audit, edits since, trail)."""

    def __init__(self):
        self.tops = {0: (0, 0, "", (None, ""))}
        self._insert()

    def _insert(self) -> None:
        """Tops reached by inserted messages; costs rise, so this ends."""
        shift, tops, open_ = STACKS.shift, self.tops, list(self.tops)
        while open_:
            node = open_.pop()
            cost, rank, since, trail = tops[node]
            for symbol in "ua":
                top = shift(node, symbol)
                if top is not None:
                    new = (cost + INSERT, rank, since + "I")
                    if top not in tops or new < tops[top][:3]:
                        tops[top] = (*new, _longer(trail, symbol))
                        open_.append(top)

    def row(self, initial: str, delete: bool, truncated: bool) -> None:
        """Reads a row: every top goes on by every edit, equal tops merge."""
        shift, best = STACKS.shift, {}

        def offer(top, cost, rank, audit, trail, code):
            if top not in best or (cost, rank, audit) < best[top][:3]:
                best[top] = (cost, rank, audit, trail, code)

        for node, (cost, rank, since, trail) in self.tops.items():
            offer(node, cost + DELETE, rank, since + "D", trail, "D")
            if delete:
                continue
            stays = cost + TRUNCATED if truncated else cost
            if (top := shift(node, initial)) is not None:
                offer(top, stays + KEEP, rank, since + "K", trail, "K")
            for symbol, code in (("u", "U"), ("a", "A")):
                if (top := shift(node, symbol)) is not None:
                    offer(top, stays + REROLE, rank, since + "R", trail, code)
        ranks = {k: i for i, k in enumerate(sorted({v[1:3] for v in best.values()}))}
        self.tops = {top: (v[0], ranks[v[1:3]], "", _longer(v[3], v[4])) for top, v in best.items()}
        self._insert()

    def cheapest(self) -> tuple[int, str]:
        """Cost and trail of the cheapest accepted top."""
        cost, _, _, trail = min(v for top, v in self.tops.items() if STACKS.accepts(top))
        parts = []
        while trail is not None:
            trail, held = trail
            parts.append(held)
        return cost, "".join(reversed(parts))


def _longer(trail: tuple, code: str) -> tuple:
    """A trail with one more edit: a chain of strings of up to 256 edits."""
    before, held = trail
    return ((before, held), code) if len(held) >= 256 else (before, held + code)


def fault(text: str, repeated: bool) -> str | None:
    """The first fault of a row."""
    letters = text.rstrip(SPACE)
    if not letters:
        return "blank"
    if repeated:
        return "duplicate"
    return "truncated" if letters[-1] not in ".!?" else None


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
LOG = "conv_id long, row long, kind int, edits string, role string, text string, " + ", ".join(f"{c} long" for c in COUNTS)


class _Log:
    """Rows of the fold's output, as batches."""

    def __init__(self, size: int = 1000, limit: int = 4 << 20):
        self.rows, self.size, self.limit, self.held = [], size, limit, 0

    def add(self, conv, row, kind, edits=None, role=None, text=None, counts=(None,) * len(COUNTS)) -> bool:
        self.rows.append((conv, row, kind, edits, role, text, *counts))
        self.held += len(text or "")
        return len(self.rows) >= self.size or self.held >= self.limit

    def batch(self) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), *[pa.int64()] * len(COUNTS))
        names = ("conv_id", "row", "kind", "edits", "role", "text", *COUNTS)
        columns = list(zip(*self.rows, strict=True)) or [()] * len(names)
        self.rows, self.held = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


class _Conversation:
    """What the fold knows of the conversation it is in."""

    def __init__(self, conv):
        self.conv, self.repair, self.rows = conv, Repair(), 0
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal, self.initial, self.last = 0, None, None
        self.first_turn = self.turn = None
        self.turns = 0

    def read(self, turn, role: str, text: str, repeated: bool) -> None:
        if turn is not None and turn != self.turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turn, self.turns = turn, self.turns + 1
        found = fault(text, repeated)
        if found:
            self.faults[found] += 1
        initial = role[:1]
        if self.rows and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.repair.row(initial, found in ("blank", "duplicate"), found == "truncated")
        self.initial, self.rows = initial, self.rows + 1

    def edits(self) -> Iterator[tuple[int, str]]:
        """Row number, and the inserts before that row followed by its own edit."""
        row, held = 0, ""
        for code in self.trail:
            held += code
            if code not in "ua":
                yield row, held
                row, held = row + 1, ""
        if held:
            yield row, held

    def close(self) -> tuple:
        cost, self.trail = self.repair.cheapest()
        gaps = 0 if self.turn is None else min(self.turn - self.first_turn + 1 - self.turns, (1 << 63) - 1)
        return (gaps, *self.faults.values(), self.illegal, cost)


def _fold(batches):
    """Sorted rows: each goes on with its number (kind 1); a conversation's edits (0) and summary (-1) follow."""
    now, log = None, _Log()

    def close():
        counts = now.close()
        log.add(now.conv, -1, -1, now.trail.translate(AUDIT), counts=counts)
        for row, codes in now.edits():
            if log.add(now.conv, row, 0, codes):
                yield log.batch()

    for batch in batches:
        for conv, turn, role, text, dropped, first in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "dropped", "first_turn")), strict=True):
            if now is None or now.conv != conv:
                if now is not None:
                    yield from close()
                now, before = _Conversation(conv), None
            if dropped:
                continue
            # ``first`` is set where a role and text occur more than once: (has a turn, turn) of the first one
            place = (turn is not None, turn)
            repeated = first is not None and (place != (first["known"], first["turn"]) or before == (place, role, text))
            now.read(turn, role, text, repeated)
            before = (place, role, text)
            if log.add(conv, now.rows - 1, 1, role=role, text=text):
                yield log.batch()
    if now is not None:
        yield from close()
    yield log.batch()


def _merge(batches):
    """Sorted log: a row's edits meet the row.  One output row for each edit, after a summary (step 0)."""
    names = ("conv_id", "step", "edit", "role", "text", "audit", *COUNTS)
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), *[pa.int64()] * len(COUNTS))
    none, step, code = (None,) * (1 + len(COUNTS)), 0, None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            conv = row["conv_id"]
            if row["kind"] == -1:
                step = 0
                out.append((conv, 0, None, None, None, row["edits"], *(row[c] for c in COUNTS)))
            elif row["kind"] == 0:
                code = None
                for c in row["edits"]:
                    if c in ROLES:
                        step += 1
                        out.append((conv, step, "I", ROLES[c], "", *none))
                    else:
                        code = c
            else:
                step += 1
                role = ROLES[code.lower()] if code in "UA" else row["role"]
                out.append((conv, step, code.translate(AUDIT), role, row["text"], *none))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def repair(rows: DataFrame) -> DataFrame:
    """Edits of ``rows (conv_id, turn, role, text[, dropped])``: conv_id, step, edit, role, text after the edit.

    Step 0 of each conversation carries its audit and counts.  ``dropped`` marks rows that only name their conversation.
    """
    dropped = F.coalesce("dropped", F.lit(False)) if "dropped" in rows.columns else F.lit(False)
    space = F.lit(" ")
    clean = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), dropped.alias("dropped"))
    digest = F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256)
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = clean.filter("not dropped").groupBy(F.col("conv_id").alias("of"), digest.alias("digest")).agg(F.min(place).alias("first_turn"), F.count("role").alias("times")).filter("times > 1")
    told = clean.withColumn("d", F.when(~F.col("dropped"), digest)).join(again, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("d") == F.col("digest")), "left")
    dealt = told.select("conv_id", "turn", "role", "text", "dropped", "first_turn").repartition("conv_id")
    log = dealt.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text").mapInArrow(_fold, LOG)
    both = log.repartition("conv_id").sortWithinPartitions("conv_id", "row", "kind")
    return both.mapInArrow(_merge, "conv_id long, step long, edit string, role string, text string, audit string, " + ", ".join(f"{c} long" for c in COUNTS))


def turns(repaired: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, step, role, text."""
    return repaired.filter("edit in ('K', 'R', 'I')").select("conv_id", "step", "role", "text")


def digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation: its counts, its audit, and the digest of its repaired ``role:text`` lines.

    Reads ``repair``'s rows as they stand, each conversation's together and in order.
    """
    names = ("conv_id", *COUNTS, "audit", "repaired_sha256")
    types = (pa.int64(), *[pa.int64()] * len(COUNTS), pa.string(), pa.string())

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def digest(batches):
        summary, hashed, first = None, None, True
        for part in batches:
            out = []
            columns = [part.column(c).to_pylist() for c in ("conv_id", "step", "edit", "role", "text", "audit", *COUNTS)]
            for conv, step, edit, role, text, audit, *counts in zip(*columns, strict=True):
                if step == 0:
                    if summary:
                        out.append((*summary, hashed.hexdigest()))
                    summary, hashed, first = (conv, *counts, audit), hashlib.sha256(), True
                elif edit != "D":
                    hashed.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
            if out:
                yield batch(out)
        if summary:
            yield batch([(*summary, hashed.hexdigest())])

    return repaired.mapInArrow(digest, f"conv_id long, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults by ``crc32(conv_id:turn) % 20``: 0 drops a row, 1 empties its text, 2 takes out its
    ``[.!?]``, 3 repeats it, 4 makes its role user; nulls are one space."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    made = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("kind") == 0).alias("dropped"), copies.alias("copy"))
    return made.drop("copy")
