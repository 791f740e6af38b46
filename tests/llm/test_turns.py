"""Conversation repair against plain dynamic programming over all edits, and its cases."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tidegauge.llm import turns

ROLES = {"u": "user", "a": "assistant"}
AFTER = {"": "su", "s": "u", "u": "a", "a": "u"}


def plain(rows):
    """Cheapest edits by relaxing all states until nothing changes; rows: (role, fault). State: place, last initial."""
    best = {(0, ""): (0, "")}
    for i in range(len(rows) + 1):
        for _ in range(6):  # inserted turns stay at one place
            for (at, last), (cost, path) in list(best.items()):
                if at == i:
                    to = AFTER[last][-1]
                    best[i, to] = min(best.get((i, to), (cost + 3, path + "I")), (cost + 3, path + "I"))
        if i == len(rows):
            break
        role, fault = rows[i]
        more = 3 if fault == 3 else 0
        for (at, last), (cost, path) in list(best.items()):
            if at != i:
                continue
            ways = [(last, cost + 4, "D")]
            if fault not in (1, 2):
                ways.append((AFTER[last][-1], cost + 3 + more, "R"))
                if role[:1] and role[0] in AFTER[last]:
                    ways.append((role[0], cost + more, "K"))
            for to, c, e in ways:
                best[i + 1, to] = min(best.get((i + 1, to), (c, path + e)), (c, path + e))
    return min(v for (at, last), v in best.items() if at == len(rows) and last in ("", "a"))


def rebuild(rows, edits):
    out, rows = [], iter(rows)
    for e in edits:
        role, text = ("", "") if e == "I" else next(rows)
        if e != "D":
            last = out[-1][0][0] if out else ""
            out.append((role, text) if e == "K" else (ROLES[AFTER[last][-1]], text))
    assert next(rows, None) is None and re.fullmatch(r"(s?(ua)+)?", "".join(r[0] for r, _ in out))
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def coded(rows):
    return bytes(turns.code(r[:1], f) for r, f in rows)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_all_short_conversations(n):
    for rows in itertools.product(itertools.product(["system", "user", "assistant", "tool", ""], range(4)), repeat=n):
        if n < 3 or hash(rows) % 7 == 0:
            assert turns.cheapest(coded(rows)) == plain(rows), rows


@pytest.mark.parametrize("segment", [1, 2, 5, 64])
def test_segments_change_nothing(segment):
    rng = random.Random(segment)
    for _ in range(150):
        rows = [(rng.choice(["system", "user", "user", "assistant", "assistant", "x"]), rng.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(1, 40))]
        assert turns.cheapest(coded(rows), segment) == plain(rows)


def test_long_conversation():
    rng = random.Random(1)
    rows = [(("user", "assistant")[i % 2] if rng.random() < 0.8 else "user", rng.choice([0] * 12 + [1, 2, 3])) for i in range(3000)]
    assert turns.cheapest(coded(rows)) == plain(rows)


def by_hand(table):
    """What the contract says, in plain Python."""
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for _, turn, role, text in (r for r in table if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        digest = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r)))
        seen, faults = set(), []
        for _, role, text in rows:
            solid = text.strip(" \t\n\x0b\x0c\r")
            faults.append(1 if not solid else 2 if (role, text) in seen else 3 if solid[-1] not in ".!?" else 0)
            seen.add((role, text))
        at = [t for t, _, _ in rows if t is not None]
        illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in itertools.pairwise(rows))
        cost, audit = plain([(r, f) for (_, r, _), f in zip(rows, faults, strict=True)])
        gaps = max(at) - min(at) + 1 - len(set(at)) if at else 0
        out[conv] = (gaps, *(faults.count(k) for k in (1, 2, 3)), illegal, cost, audit, rebuild([r[1:] for r in rows], audit))
    return out


SCHEMA = "conv_id long, turn long, role string, text string, digest string, fault long, part string"


def test_conversations(spark):
    rng = random.Random(5)
    words = ["yes.", "No!", "what?", "cut off", "", " \n", "é.", "one. two. ", "x" * 5000 + "."]
    table = []
    for conv in [None, *range(150)]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["system"] if turn == 0 and rng.random() < 0.3 else ["user", "assistant", "assistant", "user", "tool", None, ""])
            table += [(conv, rng.choice([turn, turn, turn, turn + 3, None]), role, rng.choice([*words, None, f"text {turn}."]))] * rng.choice([1, 1, 1, 2])
    table += [(999, t, ("user", "assistant")[t % 2], f"turn {t % 50}" + "." * (t % 7 > 0)) for t in range(400)]
    rows = spark.createDataFrame([(*r, "d", 1, "p") for r in table], SCHEMA).repartition(5)
    got = turns.repaired(turns.damaged(rows), rows.select("conv_id"))
    assert got.columns == ["conv_id", *turns.LONGS, "audit", "repaired_sha256"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == by_hand(table)
    assert got.count() == 152
    none = rows.limit(0)
    assert turns.repaired(turns.damaged(none), none.select("conv_id")).count() == 0


def test_all_rows_dropped(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = spark.createDataFrame([(conv, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    got = turns.repaired(turns.damaged(rows), rows.select("conv_id")).collect()
    assert [tuple(r) for r in got] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
