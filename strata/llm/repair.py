"""Repair of conversation structure by lightest derivation (operator 12).

A conversation is well formed when the first letters of its roles read
``(s?(ua)+)?``: an optional system turn, then pairs of user and assistant. Edits
make it so: Keep (0), Rerole to user or assistant (2), Delete (3; the only edit
for a blank or repeated row) and Insert an empty user or assistant turn (2). A
truncated row that is not deleted adds 1.

Knuth's generalisation of the shortest path finds the cheapest edits. Items are
``rest(i, q)``: the rows from i on, with the grammar in state q. An edit item
(its letter and cost) and a rest item derive the rest item before them:

    edit(row i, x), rest(i + 1, q')  |-  rest(i, q)     where q reads x to q'
    insert(x),      rest(i, q')      |-  rest(i, q)

The weight is (cost, audit) in that order; the deduction's function is
``(c, x), (c', s) -> (c + c', xs)``. The audit grows at its front, so the
function is monotone also where one audit is the beginning of another. Keep
costs nothing, so the agenda pops by (cost, rows covered): then every function
is superior (what it gives comes after what it takes), an item is final when
popped, and the goal ``rest(0, start)`` ends the search. Ties of cost go to the
ASCII-least audit.

In Spark, twice one sort by conversation and place: first of narrow rows
(initial, flags, digest), which give the faults and the audit of each
conversation; then of the texts behind their audit, streamed through the
replayed edits. A task holds, of one conversation at a time, a few bytes per row
and one batch of texts, whatever the conversation's size.

Rows: order is by turn, nulls first; rows of one turn by role, then by digest.
A null ``conv_id`` is a conversation of its own; a null role or text is one space
(such a role cannot be kept, such a text is blank). An empty role cannot be kept
either. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import fresh, stage, table

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, OPEN_END = 0, 2, 3, 2, 1
#: The grammar as states: what each reads, and where that leads.
START, NEXT, DONE = 0, {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}, (0, 3)
ROLES = {"u": "user", "a": "assistant"}


# ---------------------------------------------------------------------------
# Lightest derivation
# ---------------------------------------------------------------------------

class Audit:
    """A string that grows at its front and shares its end with others."""

    __slots__ = ("letter", "rest")

    def __init__(self, letter: str, rest: "Audit | None"):
        self.letter, self.rest = letter, rest


def _before(a: Audit | None, b: Audit | None) -> bool:
    """``a`` is less than ``b`` as a string."""
    while a is not b:
        if a is None or b is None:
            return a is None
        if a.letter != b.letter:
            return a.letter < b.letter
        a, b = a.rest, b.rest
    return False


def edits_of(initial: str, fault: int) -> list[tuple[str, int, str]]:
    """The edit items of a row: letter, cost, and the symbol it leaves."""
    out = [("D", DELETE, "")]
    if fault not in (BLANK, DUPLICATE):
        more = OPEN_END if fault == TRUNCATED else 0
        if initial in ("s", "u", "a"):
            out.append(("K", KEEP + more, initial))
        out += [("R", REROLE + more, symbol) for symbol in ROLES]
    return out


def lightest(initials: list[str], faults: list[int]) -> tuple[int, str]:
    """Cost and audit of the cheapest edits of one conversation."""
    n = len(initials)
    back: dict[str, dict[int, list[int]]] = {}
    for state, reads in NEXT.items():
        for symbol, to in reads.items():
            back.setdefault(symbol, {}).setdefault(to, []).append(state)
    back[""] = {state: [state] for state in NEXT}
    known: dict[tuple[int, int], tuple[int, Audit | None]] = {(n, q): (0, None) for q in DONE}
    agenda = [(0, 0, n, q) for q in DONE]
    final = set()
    while agenda:
        cost, covered, i, state = heappop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        audit = known[i, state][1]
        if (i, state) == (0, START):
            break
        steps = [("I", INSERT, symbol, i) for symbol in ROLES]
        if i:
            steps += [(*edit, i - 1) for edit in edits_of(initials[i - 1], faults[i - 1])]
        for letter, weight, symbol, at in steps:
            for before in back[symbol].get(state, ()):
                if (at, before) in final:
                    continue
                total, old = cost + weight, known.get((at, before))
                if old is None or total < old[0]:
                    heappush(agenda, (total, n - at, at, before))
                elif total > old[0] or not _before(Audit(letter, audit), old[1]):
                    continue
                known[at, before] = (total, Audit(letter, audit))
    cost, audit = known[0, START]
    letters = []
    while audit is not None:
        letters.append(audit.letter)
        audit = audit.rest
    return cost, "".join(letters)


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------

def _or_space(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def described(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, digest, initial, blank, cut, text``: nulls read as
    one space; what the faults of a row rest on."""
    filled = rows.select(F.col("conv_id").cast("long").alias("conv_id"),
                         F.col("turn").cast("long").alias("turn"),
                         _or_space("role").alias("role"), _or_space("text").alias("text"))
    end = F.rtrim("text", F.lit(SPACE))
    return filled.select(
        "conv_id", "turn", "role",
        F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
        .alias("digest"), F.substring("role", 1, 1).alias("initial"),
        (F.translate("text", SPACE, "") == "").alias("blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut"), "text")


def _together(rows: DataFrame, *order: str) -> DataFrame:
    """Conversations side by side, each in its order."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def _columns(batches: Iterator[pa.RecordBatch], size: int = 1024) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, size).columns))


PLAN_SCHEMA = ("conv_id long, rows long, gaps long, blank long, duplicate long, truncated long, "
               "illegal long, cost long, audit string")
LONG_MAX = (1 << 63) - 1


class _Conversation:
    """What the plan of one conversation rests on: a few bytes per row."""

    def __init__(self):
        self.initials, self.faults, self.digests = [], [], set()
        self.low = self.high = None
        self.turns = self.illegal = 0

    def add(self, turn, initial, digest, blank, cut) -> None:
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.initials:
            self.illegal += self.initials[-1] + initial not in ("su", "ua", "au")
        self.initials.append(initial)
        seen = digest in self.digests
        self.digests.add(digest)
        self.faults.append(BLANK if blank else DUPLICATE if seen else TRUNCATED if cut else 0)

    def row(self, conv_id) -> tuple:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, LONG_MAX)
        cost, audit = lightest(self.initials, self.faults)
        return (conv_id, len(self.initials), gaps, *map(self.faults.count, (BLANK, DUPLICATE, TRUNCATED)),
                self.illegal, cost, audit)


def plans(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (``conv_id, turn, role, text``): its rows,
    gaps, faults, illegal neighbours, and cost and audit of the cheapest edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in PLAN_SCHEMA.split(", ")]
        types = [pa.string() if n == "audit" else pa.int64() for n in names]

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        held, key, out = None, None, []
        for conv_id, turn, initial, digest, blank, cut in _columns(batches):
            if held is None or conv_id != key:
                if held is not None:
                    out.append(held.row(key))
                held, key = _Conversation(), conv_id
            held.add(turn, initial, digest, blank, cut)
            if len(out) >= 1024:
                yield batch_of(out)
                out = []
        if held is not None:
            out.append(held.row(key))
        if out:
            yield batch_of(out)

    narrow = described(rows).drop("text")
    ordered = _together(narrow, "turn", "role", "digest")
    return ordered.select("conv_id", "turn", "initial", "digest", "blank", "cut").mapInArrow(run, PLAN_SCHEMA)


REPAIRED_SCHEMA = "conv_id long, place long, edit string, role string, text string"


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: ``place`` counts from 0, ``edit``
    is K, R or I. ``audits`` are the ``conv_id, audit`` of :func:`plans`; a
    conversation without any turn left has no row. Rows of a conversation stand
    together and in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in REPAIRED_SCHEMA.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        key, audit, at, state, place, out = None, "", 0, START, 0, []

        def emit(edit: str, symbol: str, role: str, text: str) -> None:
            nonlocal state, place
            out.append((key, place, edit, role, text))
            state, place = NEXT[state][symbol], place + 1

        def inserts() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                symbol = "a" if state == 2 else "u"
                emit("I", symbol, ROLES[symbol], "")
                at += 1

        for conv_id, own_audit, role, initial, text in _columns(batches):
            if own_audit is not None:                      # the first row of a conversation
                key, audit, at, state, place = conv_id, own_audit, 0, START, 0
                inserts()
                continue
            edit = audit[at]
            at += 1
            if edit == "K":
                emit("K", initial, role, text)
            elif edit == "R":
                symbol = "a" if state == 2 else "u"
                emit("R", symbol, ROLES[symbol], text)
            inserts()
            if len(out) >= 256:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    texts = described(rows).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "initial",
                                   "text", F.lit(None).cast("string").alias("audit"))
    none = F.lit(None)
    heads = audits.select("conv_id", F.lit(0).alias("kind"), none.cast("long").alias("turn"),
                          none.cast("string").alias("role"), none.cast("binary").alias("digest"),
                          none.cast("string").alias("initial"), none.cast("string").alias("text"), "audit")
    ordered = _together(texts.union(heads), "kind", "turn", "role", "digest")
    return ordered.select("conv_id", "audit", "role", "initial", "text").mapInArrow(run, REPAIRED_SCHEMA)


def digests(turns: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of the turns that :func:`repaired` gives:
    ``role:text``, joined by newlines, hashed as they stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, None, []
        for conv_id, place, role, text in _columns(batches):
            if place == 0:
                if held is not None:
                    out.append((key, held.hexdigest()))
                key, held = conv_id, hashlib.sha256()
            held.update((f"{role}:{text}" if place == 0 else f"\n{role}:{text}").encode())
        if held is not None:
            out.append((key, held.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()),
                                          pa.array([d for _, d in out], pa.string())],
                                         ["conv_id", "repaired_sha256"])

    return turns.select("conv_id", "place", "role", "text").mapInArrow(
        run, "conv_id long, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Planted faults by the hash of ``conv_id:turn``: of 20 rows one is dropped,
    one emptied, one loses its ends of sentences, one stands twice and one
    becomes a user's."""
    case = fresh(rows, "case")
    key = F.concat_ws(":", _or_space("conv_id"), _or_space("turn"))
    marked = rows.select("conv_id", "turn", _or_space("role").alias("role"), _or_space("text").alias("text"),
                         (F.crc32(key.cast("binary")) % 20).alias(case)).where(F.col(case) != 0)
    text = (F.when(F.col(case) == 1, F.lit(""))
            .when(F.col(case) == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    role = F.when(F.col(case) == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(1), F.when(F.col(case) == 3, 2).otherwise(1))
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                         F.explode(copies).alias("copy")).drop("copy")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    rows = damaged(given)
    planned = stage(spark, plans(rows), "conversation-plans")
    hashed = stage(spark, digests(repaired(rows, planned.select("conv_id", "audit"))), "conversation-digests")
    ids = given.select(F.col("conv_id").cast("long").alias("id")).distinct()
    out = (ids.join(planned, F.col("id").eqNullSafe(planned["conv_id"]), "left").drop("conv_id")
           .join(hashed, F.col("id").eqNullSafe(hashed["conv_id"]), "left").drop("conv_id"))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c)
            for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
