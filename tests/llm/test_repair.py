"""Conversation repair against all edit scripts and a plain reading of the contract."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import repair as R

WELL_FORMED = re.compile(r"(s?(ua)+)?\Z")


def brute(initials, faults):
    """(cost, audit) over all scripts of at most ``len + 3`` inserts, by text."""
    n = len(initials)
    options = [R.edits_of(i, f) for i, f in zip(initials, faults)]
    best = None
    for gaps in itertools.product(range(3), repeat=n + 1):
        if sum(gaps) > 3:
            continue
        for inserted in itertools.product("ua", repeat=sum(gaps)):
            for edits in itertools.product(*options):
                symbols, at, out, audit, cost = iter(inserted), 0, [], [], 0
                for i in range(n + 1):
                    for _ in range(gaps[i]):
                        out.append(next(symbols))
                        audit.append("I")
                        cost += 2
                    if i < n:
                        letter, weight, symbol = edits[i]
                        out.append(symbol)
                        audit.append(letter)
                        cost += weight
                if WELL_FORMED.match("".join(out)):
                    found = (cost, "".join(audit))
                    best = found if best is None else min(best, found)
    return best


@pytest.mark.parametrize("seed", range(40))
def test_lightest_against_all_scripts(seed):
    rng = random.Random(seed)
    n = rng.randint(0, 4)
    initials = [rng.choice("ssuuaax") for _ in range(n)]
    faults = [rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
    assert R.lightest(initials, faults) == brute(initials, faults)


def reference(initials, faults):
    """The same by dynamic programming over all (rows, state), whole strings."""
    best = {q: (0, "") for q in R.DONE}
    for i in range(len(initials), -1, -1):
        if i < len(initials):
            row = {}
            for letter, weight, symbol in R.edits_of(initials[i], faults[i]):
                for q in R.NEXT:
                    to = q if not symbol else R.NEXT[q].get(symbol)
                    if to in best:
                        c, s = best[to]
                        row[q] = min(row.get(q, (1 << 60, "")), (c + weight, letter + s))
            best = row
        for _ in range(4):
            for q, reads in R.NEXT.items():
                for symbol, to in reads.items():
                    if symbol != "s" and to in best:
                        c, s = best[to]
                        best[q] = min(best.get(q, (1 << 60, "")), (c + 2, "I" + s))
    return best[R.START]


def contract(rows):
    """Expected row of each conversation, read off the contract."""
    out = {}
    for conv in {r[0] for r in rows}:
        after = []
        for _, turn, role, text in [r for r in rows if r[0] == conv]:
            role, text = (" " if role is None else role), (" " if text is None else text)
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            case = zlib.crc32(key.encode()) % 20
            if case == 0:
                continue
            if case == 1:
                text = ""
            if case == 2:
                text = re.sub("[.!?]", "", text)
            if case == 4:
                role = "user"
            after += [(turn, role, text)] * (2 if case == 3 else 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(
            f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()))
        initials, faults, seen = [r[1][:1] for r in after], [], set()
        for _, role, text in after:
            body = text.strip(R.SPACE)
            faults.append(1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0)
            seen.add((role, text))
        turns = [r[0] for r in after if r[0] is not None]
        cost, audit = reference(initials, faults)
        state, at, turns_out = R.START, 0, []
        for letter in audit:
            symbol = "a" if state == 2 else "u"
            if letter == "I":
                turns_out.append(f"{R.ROLES[symbol]}:")
            else:
                _, role, text = after[at]
                at += 1
                if letter == "D":
                    continue
                if letter == "K":
                    symbol = role[:1]
                turns_out.append(f"{role if letter == 'K' else R.ROLES[symbol]}:{text}")
            state = R.NEXT[state][symbol]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                     faults.count(1), faults.count(2), faults.count(3),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                     cost, audit, hashlib.sha256("\n".join(turns_out).encode()).hexdigest())
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def result(spark, rows, tmp_path):
    folder = str(tmp_path / "sf")
    frame = spark.createDataFrame(rows, SCHEMA)
    frame.withColumn("case", F.lit("own")).withColumn("digest", F.lit(1)).withColumn("audit", F.lit("x")).write.parquet(
        f"{folder}/conversations.parquet")
    return {r.conv_id: tuple(r)[1:] for r in R.op12_repair(spark, folder).collect()}


def test_given_conversations(spark, small_sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{small_sf}/conversations.parquet").collect()]
    got = R.op12_repair(spark, small_sf).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == contract(rows) and len(got) == len({r[0] for r in rows})


def test_made_up_conversations(spark, tmp_path):
    rng, rows = random.Random(11), []
    for conv in [None, *range(60)]:
        used = set()
        for turn in range(rng.randint(0, 9)):
            turn = rng.choice([turn, turn, turn, turn + 3, None])
            role = rng.choice(["user", "assistant", "system", "tool", None, "", "Ünknown"])
            text = rng.choice(["Yes.", "Yes.", "No way", "", None, " \t\x0b", "Why?\n ", "ende。", "x" * 50_000 + "!"])
            if (turn, role) not in used:                 # one row per turn and role: the order is given
                used.add((turn, role))
                rows.append((conv, turn, role, text))
    assert result(spark, rows, tmp_path) == contract(rows)


def test_long_conversation(spark, tmp_path):
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["Fine.", "cut", f"Turn {t}."])) for t in range(1500)]
    assert result(spark, rows, tmp_path) == contract(rows)


def test_conversation_that_loses_all_rows_and_empty_table(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert result(spark, [(gone, 0, "user", "Hi.")], tmp_path) == {gone: (0, 0, 0, 0, 0, 0, "", empty)}
    assert result(spark, [], tmp_path / "none") == {}


def test_repaired_turns(spark):
    rows = spark.createDataFrame([(1, 0, "assistant", "Hello."), (1, 1, "user", "Why"), (2, 0, "user", " ")], SCHEMA)
    audits = R.plans(rows)
    assert {r.conv_id: (r.cost, r.audit) for r in audits.collect()} == {1: (5, "IKD"), 2: (3, "D")}
    turns = R.repaired(rows, audits.select("conv_id", "audit")).collect()
    assert all(r.conv_id == 1 for r in turns)
    assert WELL_FORMED.match("".join(r.role[0] for r in sorted(turns, key=lambda r: r.place)))
