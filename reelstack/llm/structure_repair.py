"""Repair of conversation structure by target alignment.

The roles of a conversation, as initials, are to read ``(s?(ua)+)?``: an optional
system turn, then user and assistant in turn. Its turns are aligned to each
feasible length of that string by Wagner and Fischer's edit table. Lengths that
end alike share the cells of their common rest: cell (i, r) is the least cost of
bringing turns i.. onto the last r characters, so one table, filled from the end,
serves every length. Ukkonen's band bounds it: an alignment that costs no more
than the incumbent (insert wherever the next turn is not the one awaited) strays
from the diagonal by what its excess over the unavoidable costs pays for.

From every length of the least total the audit is traced back taking the
ASCII-least edit that stays optimal, and the least of these audits wins. An audit
fixes the repaired turns.

Cells are kept for every ``sqrt(turns)``-th turn and filled again block by block
for the trace, so memory grows with band times the root of the turns. A
conversation so long and damaged that its band would hold more than ``CELLS`` cells
has the same table with all lengths of one parity in one cell: as every length is
feasible, only the awaited role matters then, and the result is the same. Rows are
partitioned by conversation and sorted by turn; the turns of one conversation are
held by one task at a time, as its repaired text is one result.

Defined results: a null role or text is one space, so a null text is a blank
turn; turns go by number, null first, equal numbers by role and text; a null
conv_id is a conversation of its own; repeated rows are duplicates; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reelstack.llm.common import SPACES, only

# Fixed values of the contract.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NAMES = {"u": "user", "a": "assistant"}
STOPS = ".!?"

INF = np.int32(1 << 29)
# Cells of a banded table; beyond them lengths of one parity share a cell.
CELLS = 1 << 26

SCHEMA = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired array<struct<role: string, text: string>>")


# --------------------------------------------------------------- the alignment


def awaited(rest: int) -> str:
    """First character of the last ``rest`` characters of uaua...ua."""
    return "a" if rest % 2 else "u"


def incumbent(initials: str) -> int:
    """Cost over the unavoidable of one valid repair: keep a leading s, insert
    the awaited turn before one that comes too early, rerole all others."""
    cost, want = 0, "u"
    kept_s = initials[:1] == "s" and len(initials) > 1
    for c in initials[1:] if kept_s else initials:
        if c in NAMES and c != want:
            cost += INSERT
        else:
            cost += REROLE * (c not in NAMES)
            want = "a" if want == "u" else "u"
    return cost + INSERT * (want == "a")


def band(initials: str, truncated: list[bool]) -> tuple[int, int]:
    """(down, width) of the band: how far the rest may fall behind the turns that
    are left by deletions, and how many cells a row has."""
    excess, cheap = incumbent(initials), sum(truncated)
    over = DELETE - TRUNCATED  # what deleting a truncated turn costs over the unavoidable
    spent = min(cheap, excess // over)
    down = min(len(initials), spent + (excess - spent * over) // DELETE)
    return down, down + excess // INSERT + 1


class Table:
    """Banded costs of aligning turns i.. (initials, truncated flags) to the last
    r characters: cell k of row i is r = n - i - down + k."""

    def __init__(self, initials: str, truncated: list[bool]):
        self.n = len(initials)
        self.extra = [TRUNCATED * t for t in truncated]
        self.down, self.width = band(initials, truncated)
        self.match = {c: np.array([REROLE * (c != awaited(r)) for r in (0, 1)], np.int32) for c in set(initials)}
        self.initials = initials
        self.step = max(1, math.isqrt(self.n))
        self.marks: dict[int, np.ndarray] = {}
        # (cost, turns deleted before, rest) where turn i is kept as the leading s.
        self.heads: list[tuple[int, int, int]] = []
        row = self.last()
        for i in range(self.n, -1, -1):
            if i < self.n:
                if initials[i] == "s" and i <= self.down:
                    rest = self.rests(i + 1)
                    some = (rest >= 2) & (rest % 2 == 0) & (row < INF)
                    self.heads += [(DELETE * i + self.extra[i] + int(c), i, int(r)) for c, r in zip(row[some], rest[some])]
                row = self.above(i, row)
            if i % self.step == 0 or i == self.n:
                self.marks[i] = row
        self.top = row

    def rests(self, i: int) -> np.ndarray:
        return np.arange(self.n - i - self.down, self.n - i - self.down + self.width, dtype=np.int32)

    def last(self) -> np.ndarray:
        rest = self.rests(self.n)
        return np.where(rest >= 0, INSERT * rest, INF).astype(np.int32)

    def above(self, i: int, below: np.ndarray) -> np.ndarray:
        """Row i from row i + 1."""
        rest = self.rests(i)
        deleted = np.append(below[1:], INF) + DELETE
        matched = below + self.match[self.initials[i]][rest % 2] + self.extra[i]
        best = np.minimum(deleted, np.where(rest >= 1, matched, INF))
        best = np.where(rest >= 0, best, INF)
        run = np.minimum.accumulate(best - INSERT * rest) + INSERT * rest
        return np.where(rest >= 0, np.minimum(run, INF), INF).astype(np.int32)

    def block(self, low: int) -> list[np.ndarray]:
        """Row ``low`` (a mark) to the next mark, filled again from there."""
        high = min(low + self.step, self.n)
        rows = [self.marks[high]]
        for i in range(high - 1, low - 1, -1):
            rows.append(self.above(i, rows[-1]))
        return rows[::-1]

    def cost(self, row: np.ndarray, i: int, rest: int) -> int:
        k = rest - (self.n - i - self.down)
        return int(row[k]) if rest >= 0 and 0 <= k < self.width else int(INF)

    def starts(self) -> tuple[int, list[tuple[int, int, bool]]]:
        """The least cost, and (turn, rest, leading s kept before it) of every
        length that reaches it."""
        rest = self.rests(0)
        ends = [(int(c), 0, int(r), False) for c, r in zip(self.top, rest) if r >= 0 and r % 2 == 0]
        ends += [(c, i + 1, r, True) for c, i, r in self.heads]
        least = min(c for c, *_ in ends)
        return least, [(i, r, s) for c, i, r, s in ends if c == least]


def audits(table: Table, before: list[int]) -> tuple[int, str]:
    """The least cost and the ASCII-least audit of it. ``before[i]`` turns that
    must go stand before turn i (the last entry: at the end); D being the least
    letter, they go as soon as they are met."""
    cost, starts = table.starts()
    traces = []
    for i, rest, kept in starts:
        head = "D" * (i - 1 + sum(before[:i])) + "K" if kept else ""
        traces.append([i, rest, [head, "D" * before[i]]])
    for low in range(0, table.n, table.step):
        rows = table.block(low)
        high = low + len(rows) - 1
        for trace in traces:
            i, rest, audit = trace
            while low <= i < high:
                here, below = table.cost(rows[i - low], i, rest), rows[i - low + 1]
                if here == DELETE + table.cost(below, i + 1, rest):
                    audit.append("D")
                elif rest and here == INSERT + table.cost(rows[i - low], i, rest - 1):
                    audit.append("I")
                    rest -= 1
                    continue
                else:
                    audit.append("K" if table.initials[i] == awaited(rest) else "R")
                    rest -= 1
                i += 1
                audit.append("D" * before[i])
            trace[0], trace[1] = i, rest
    return cost, min("".join(audit) + "I" * rest for _, rest, audit in traces)


def shared_cells(initials: str, truncated: list[bool], before: list[int]) -> tuple[int, str]:
    """``audits`` of the table whose cells hold the least cost over all rests of
    one parity (0: a user's turn is awaited, or nothing), and over those of two
    characters and more."""
    n = len(initials)
    cells = np.zeros((n + 1, 2), np.int64)
    some = np.zeros(n + 1, np.int64)
    cells[n], some[n] = (0, INSERT), 2 * INSERT
    heads = []
    for i in range(n - 1, -1, -1):
        extra, c = TRUNCATED * truncated[i], initials[i]
        even, odd = int(cells[i + 1, 0]), int(cells[i + 1, 1])
        user, assistant = REROLE * (c != "u") + extra + odd, REROLE * (c != "a") + extra + even
        low_even, low_odd = min(DELETE + even, user), min(DELETE + odd, assistant)
        cells[i] = min(low_even, INSERT + low_odd), min(low_odd, INSERT + low_even)
        some[i] = min(DELETE + int(some[i + 1]), user, INSERT + int(cells[i, 1]))
        if c == "s":
            heads.append((DELETE * i + extra + int(some[i + 1]), i + 1))
    cost = min([int(cells[0, 0]), *[c for c, _ in heads]])
    found = [walk(initials, truncated, before, cells, some, 0, False)] if cells[0, 0] == cost else []
    for c, i in heads:
        if c == cost:
            head = "D" * (i - 1 + sum(before[:i])) + "K"
            found.append(head + walk(initials, truncated, before, cells, some, i, True))
    return cost, min(found)


def walk(initials, truncated, before, cells, some, i: int, must: bool) -> str:
    """The ASCII-least audit from turn i on; ``must`` while a rest of two
    characters at least is due."""
    n, parity, out = len(initials), 0, ["D" * before[i]]
    at = lambda i, parity, must: int(some[i]) if must else int(cells[i, parity])
    while i < n or parity or must:
        here = at(i, parity, must)
        if i < n and here == DELETE + at(i + 1, parity, must):
            out.append("D")
        elif here == INSERT + at(i, 1 - parity, False):
            out.append("I")
            parity, must = 1 - parity, False
            continue
        else:
            out.append("K" if initials[i] == "ua"[parity] else "R")
            parity, must = 1 - parity, False
        i += 1
        out.append("D" * before[i])
    return "".join(out)


def least_audit(initials: list[str], must: list[bool], truncated: list[bool]) -> tuple[int, str]:
    """Cost and audit of the cheapest repair; ``must`` turns are deleted."""
    before, free, cut = [0], [], []
    for c, gone, short in zip(initials, must, truncated):
        if gone:
            before[-1] += 1
        else:
            free.append(c if c in ("s", "u", "a") else "?")
            cut.append(short)
            before.append(0)
    initials = "".join(free)
    wide = len(free) * band(initials, cut)[1] > CELLS
    cost, audit = shared_cells(initials, cut, before) if wide else audits(Table(initials, cut), before)
    return cost + DELETE * sum(must), audit


def applied(turns: list[tuple[str, str]], audit: str) -> list[dict]:
    """The repaired turns of an audit."""
    total = len(audit) - audit.count("D")
    out, turn = [], iter(turns)
    for edit in audit:
        role, text = next(turn) if edit != "I" else ("", "")
        if edit == "D":
            continue
        if edit != "K":
            role = NAMES[awaited(total - len(out))]
        out.append({"role": role, "text": text})
    return out


# ------------------------------------------------------------------ the turns


def repaired(numbers: list, turns: list[tuple[str, str]]) -> tuple:
    """The columns of one conversation after its id."""
    known = [t for t in numbers if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [role[:1] for role, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    seen, blank, duplicate, truncated = set(), [], [], []
    for turn in turns:
        end = turn[1].rstrip(SPACES)[-1:]
        blank.append(not end)
        duplicate.append(bool(end) and turn in seen)
        truncated.append(bool(end) and turn not in seen and end not in STOPS)
        seen.add(turn)
    cost, audit = least_audit(initials, [b or d for b, d in zip(blank, duplicate)], truncated)
    return (gaps, sum(blank), sum(duplicate), sum(truncated), illegal, cost, audit, applied(turns, audit))


def repair_batches(batches) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, turn, role, text, gone) sorted by conversation and turn to
    one row per conversation."""
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in
                        ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()),
                        ("repaired", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])
    done: list[tuple] = []
    size, now, numbers, turns = 0, None, [], []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    for given in batches:
        for conv_id, turn, role, text, gone in zip(*[c.to_pylist() for c in given.columns]):
            if now is None or conv_id != now[0]:
                if now is not None:
                    done.append((now[0], *repaired(numbers, turns)))
                    if size > 1 << 22:
                        yield batch()
                        done, size = [], 0
                now, numbers, turns = (conv_id,), [], []
            if not gone:
                numbers.append(turn)
                turns.append((role, text))
                size += len(text)
    if now is not None:
        done.append((now[0], *repaired(numbers, turns)))
        yield batch()


def repair(conversations: DataFrame) -> DataFrame:
    """Per conversation of (conv_id, turn, role, text[, gone]) rows: its counts
    of faults, the least cost, the audit, and the repaired turns. Rows marked ``gone``
    only name their conversation."""
    rows = only(conversations, "conv_id", "turn", "role", "text", *(["gone"] if "gone" in conversations.columns else []))
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       space("role"), space("text"),
                       (F.col("gone") if "gone" in rows.columns else F.lit(False)).alias("gone"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    return rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(repair_batches, SCHEMA)


# ----------------------------------------------------------------- the damage


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults drawn by a checksum of ``conv_id:turn`` (fixed
    values of the contract): of 20 draws 0 drops the row (it stays, marked
    ``gone``), 1 empties its text, 2 takes out its stops, 3 repeats it, 4 makes
    it a user's. A null is one space."""
    rows = only(conversations, "conv_id", "turn", "role", "text")
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw: Column = F.crc32(F.concat_ws(":", space("conv_id"), space("turn"))) % 20
    text = (F.when(draw == 1, F.lit("")).when(draw == 2, F.regexp_replace(space("text"), "[.!?]", ""))
            .otherwise(space("text")))
    return rows.select(
        "conv_id", "turn", F.when(draw == 4, F.lit("user")).otherwise(space("role")).alias("role"), text.alias("text"),
        (draw == 0).alias("gone"), F.explode(F.sequence(F.lit(1), F.when(draw == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def digests(repairs: DataFrame) -> DataFrame:
    """The repaired turns as the digest of their lines."""
    lines = F.concat_ws("\n", F.transform("repaired", lambda r: F.concat_ws(":", r["role"], r["text"])))
    return repairs.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                          F.sha2(lines, 256).alias("repaired_sha256"))
