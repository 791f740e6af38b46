"""Conversation structure repair: the cheapest edits that give a conversation a legal order of roles.

A conversation's rows stand by turn (nulls first; ties by role, then by digest of the text). Each row may be kept (0, 3 more if its text is
cut off), given the role that the place calls for (3, likewise), or deleted (4); an empty turn may be inserted anywhere (3).
Blank rows and repeats must go. The initials of the roles must read `(s?(ua)+)?` afterwards. The cheapest edits are
searched by iterative-deepening A*: depth first, edits in ASCII order (Delete, Insert, Keep, Rerole) under a cost bound that
rises to the least cost that was beyond it; the bound's lower estimate is what the rows to come cost at least. States that
failed are remembered with the budget that was left, across bounds, so that no state is searched again with no more. The
first path accepted is the cheapest, and the least in ASCII order among the cheapest.

A conversation of any length is searched in segments of SEGMENT rows, from each state it can be entered in to each state it
can be left in; of paths that meet in a state only the best goes on. That is exact: among equal costs no path's string is
the beginning of another's, since more inserted turns cost more. Texts are not held: one pass finds the faults, one
finds the edits from a byte for each row, and a last one streams the texts in order into the hash.

Cases: null ids, turns, roles and texts count as one space where they are text, as the damage does; a null conv_id is a
conversation of its own. Equal turns are told apart by role and text; equal rows are repeats. A long text is read once and
held alone. A role without any character has no initial. A conversation without rows has no edits. An empty table gives an empty
result. Other columns are not read, whatever they are called.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidegauge.llm.common import batches, rows_of, stored

SEGMENT = 64
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
#: What has been read so far: nothing, a system turn, a user's, an assistant's; which role's initial may follow as it is.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {START: "su", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLES = {"u": "user", "a": "assistant"}
#: Where edits may end.
ACCEPTED = (START, ASSISTANT)
#: Faults of a row.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)


def code(initial: str, fault: int) -> int:
    """A row as one byte: what its initial may be, and its fault."""
    return 4 * ("sua".find(initial) + 1 if initial else 0) + fault


def _edits(row: int, state: int) -> list[tuple[str, int, int, int]]:
    """(initial, cost, rows taken, next state) in ASCII order; row is a code, or -1 after the last."""
    new = FOLLOWS[state][-1]
    insert = ("I", INSERT, 0, AFTER[new])
    if row < 0:
        return [insert]
    initial, fault = " sua"[row // 4], row % 4
    if fault in (BLANK, DUPLICATE):
        return [("D", DELETE, 1, state), insert]
    more = CUT if fault == TRUNCATED else 0
    out = [("D", DELETE, 1, state), insert]
    if initial in FOLLOWS[state]:
        out.append(("K", KEEP + more, 1, AFTER[initial]))
    return [*out, ("R", REROLE + more, 1, AFTER[new])]


#: For every row code and state.
EDITS = {(row, state): _edits(row, state) for row in range(-1, 16) for state in range(4)}


def least(rows: bytes) -> list[int]:
    """What rows[i:] cost at least, for each i."""
    out = [0]
    for row in reversed(rows):
        out.append(out[-1] + (0, DELETE, DELETE, min(CUT, DELETE))[row % 4])
    return out[::-1]


class Search:
    """Cheapest edits of some rows that end in one of the states `ends`."""

    def __init__(self, rows: bytes, ends: tuple[int, ...]):
        self.rows, self.ends, self.floor = rows, ends, least(rows)
        self.needs: dict[tuple[int, int], int] = {}  # places and states that failed: what they cost at least

    def reaches(self, state: int) -> bool:
        """Whether any edits lead from the state to an end: a system turn cannot be made, nor left unread."""
        kept = any(row // 4 == 1 and row % 4 in (SOUND, TRUNCATED) for row in self.rows)
        return any(e in (USER, ASSISTANT) or e == state or (e == SYSTEM and state == START and kept) for e in self.ends)

    def path(self, state: int) -> tuple[int, str]:
        """(cost, edits) from a state that reaches an end."""
        bound = self.floor[0]
        while (found := self._within(state, bound)) is None:
            bound = self.needs[0, state]
        return bound, found

    def _within(self, state: int, bound: int) -> str | None:
        """The first path that costs no more than the bound, depth first on a list, since paths may be long."""
        rows, n, needs, floor = self.rows, len(self.rows), self.needs, self.floor
        at, left, need, path, stack = 0, bound, 1 << 60, "", []
        mine = iter(EDITS[rows[0], state])
        while True:
            for edit, cost, taken, to in mine:
                i, rest = at + taken, left - cost
                if i == n and to in self.ends:
                    if rest >= 0:
                        return path + edit
                    need = min(need, cost)
                elif (more := max(floor[i], needs.get((i, to), 0))) > rest:
                    need = min(need, cost + more)
                else:
                    stack.append((at, state, left, need, path, mine, cost))
                    at, state, left, need, path = i, to, rest, 1 << 60, path + edit
                    mine = iter(EDITS[rows[i] if i < n else -1, to])
                    break
            else:
                needs[at, state] = child = need
                if not stack:
                    return None
                at, state, left, need, path, mine, cost = stack.pop()
                need = min(need, cost + child)


def cheapest(rows: bytes, segment: int = SEGMENT) -> tuple[int, str]:
    """(cost, edits) of a whole conversation: the least cost, and the first such edits in ASCII order."""
    if not rows:
        return 0, ""
    done: list[str] = []
    ways = {START: (0, "")}  # for each state the best way there, without what all ways have in common
    for at in range(0, len(rows), segment):
        part = rows[at : at + segment]
        last = at + segment >= len(rows)
        after: dict[int, tuple[int, str]] = {}
        for ends in [ACCEPTED] if last else [(e,) for e in range(4)]:
            search = Search(part, ends)
            for state, (cost, path) in ways.items():
                if search.reaches(state):
                    more, edits = search.path(state)
                    way = (cost + more, path + edits)
                    after[ends[0]] = min(after.get(ends[0], way), way)
        same = len(os.path.commonprefix([path for _, path in after.values()]))
        done.append(next(iter(after.values()))[1][:same])
        ways = {state: (cost, path[same:]) for state, (cost, path) in after.items()}
    (cost, path), = ways.values()
    return cost, "".join(done) + path


class Repaired:
    """Applies edits to rows that come one after the other, and hashes what is left."""

    def __init__(self, edits: str):
        self.edits, self.state, self.hash, self.first = iter(edits), START, hashlib.sha256(), True

    def _put(self, role: str, text: str) -> None:
        self.hash.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.first, self.state = False, AFTER[role[0]]

    def row(self, role: str, text: str) -> None:
        for edit in self.edits:
            if edit != "I":
                if edit != "D":
                    self._put(role if edit == "K" else ROLES[FOLLOWS[self.state][-1]], text)
                return
            self._put(ROLES[FOLLOWS[self.state][-1]], "")

    def end(self) -> str:
        for _ in self.edits:
            self._put(ROLES[FOLLOWS[self.state][-1]], "")
        return self.hash.hexdigest()


class Tally:
    """What one conversation's rows amount to, row by row in order."""

    def __init__(self):
        self.codes, self.faults, self.illegal, self.before = bytearray(), [0] * 4, 0, None
        self.first, self.last, self.turns = None, None, 0

    def row(self, turn: int | None, initial: str, fault: int) -> None:
        self.codes.append(code(initial, fault))
        self.faults[fault] += 1
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1

    def end(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (gaps, *self.faults[1:], self.illegal, *cheapest(bytes(self.codes)))


LONGS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _summaries(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, turn, initial, fault) sorted by conversation and place to one for each conversation. A null fault only names it."""

    def found():
        tally = None
        for conv, turn, initial, fault in rows_of(stream):
            if tally is None or conv != whose:
                if tally is not None:
                    yield whose, *tally.end()
                whose, tally = conv, Tally()
            if fault is not None:
                tally.row(turn, initial, fault)
        if tally is not None:
            yield whose, *tally.end()

    longs = [(c, pa.int64()) for c in ("conv_id", *LONGS)]
    yield from batches(found(), pa.schema([*longs, ("audit", pa.string())]), 256)


def _hashed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, edits, role, text), the edits of a conversation first and then its rows, to (conv_id, sha256)."""

    def found():
        now: Repaired | None = None
        for conv, edits, role, text in rows_of(stream, 64):
            if edits is None:
                now.row(role, text)
            else:
                if now is not None:
                    yield whose, now.end()
                whose, now = conv, Repaired(edits)
        if now is not None:
            yield whose, now.end()

    yield from batches(found(), pa.schema([("conv_id", pa.int64()), ("sha256", pa.string())]))


def _faults(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text) -> conv_id, turn, role, digest, initial, fault, again (whether role and text came before)."""
    text = F.col("text")
    own = rows.select(
        "conv_id", "turn", "role",
        F.unhex(F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text"))).alias("digest"),
        F.substring("role", 1, 1).alias("initial"),
        (~text.rlike(r"[^\x20\x09-\x0D]")).alias("is_blank"),
        (~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("is_cut"),
    )
    again = F.row_number().over(W.partitionBy("conv_id", "digest").orderBy(F.asc_nulls_first("turn"))) > 1
    own = own.withColumn("again", again)
    fault = F.when(F.col("is_blank"), BLANK).when(F.col("again"), DUPLICATE).when(F.col("is_cut"), TRUNCATED).otherwise(SOUND)
    return own.select("conv_id", "turn", "role", "digest", "again", "initial", fault.alias("fault"))


def repaired(turns: DataFrame, named: DataFrame | None = None) -> DataFrame:
    """turns (conv_id, turn, role, text) -> conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    One row for each conversation, also for those of `named` (conv_id) that have no rows. The texts are shuffled once; what the
    search gets of a row are its turn, its initial and its fault.
    """
    longs = lambda df, *more: df.select(F.col("conv_id").cast("long").alias("conv_id"), *more)
    text_of = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = longs(turns, F.col("turn").cast("long").alias("turn"), text_of("role"), text_of("text"))
    marks = _faults(rows)
    if named is not None:
        names = longs(named).distinct()
        marks = marks.unionByName(names, allowMissingColumns=True)
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest"]
    found = marks.repartition("conv_id").sortWithinPartitions(*order, "again").select("conv_id", "turn", "initial", "fault")
    found = found.mapInArrow(_summaries, ", ".join(f"{c} long" for c in ("conv_id", *LONGS)) + ", audit string")
    found = stored(found, "edits")
    head = found.select("conv_id", F.lit(0).alias("part"), F.col("audit").alias("edits"))
    digest = F.unhex(F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text"))).alias("digest")
    both = head.unionByName(rows.select("*", F.lit(1).alias("part"), digest), allowMissingColumns=True)
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", "part", *order[1:]).select("conv_id", "edits", "role", "text")
    hashes = both.mapInArrow(_hashed, "conv_id long, sha256 string")
    same = found["conv_id"].eqNullSafe(hashes["conv_id"])
    return found.join(hashes, same).select(found["conv_id"], *LONGS, "audit", F.col("sha256").alias("repaired_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """Rows after damage by crc32(`conv_id:turn`) % 20: 0 drops, 1 empties the text, 2 takes its [.!?] out, 3 repeats the row, 4 makes
    it the user's. Null ids, turns, roles and texts count as one space."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(word("text"), "[.!?]", "")).otherwise(word("text"))
    role = F.when(kind == 4, "user").otherwise(word("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1)))
    return turns.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_")).drop("_")


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repaired(damaged(turns), turns.select("conv_id"))
