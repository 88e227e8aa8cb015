"""Repair of a conversation's structure by iterative-deepening A* (operator 13).

A conversation's rows are reduced to the first letter of their role and their first
fault.  Edits, in ASCII order, are Delete (4), Insert an empty user or assistant
turn (3), Keep (0) and Rerole to user or assistant (3); a truncated row that
stays adds 3; blank and repeated rows must go.  The role initials must read
``(s?(ua)+)?``.  That expression leaves each edit one role to choose, so a state is
(next row, last initial) and a string of edits stands for one repair.

The search goes depth first in ASCII order of edits under a cost bound, which
grows to the least cost that cut off the pass before.  The transposition table
keeps, per state, a cost below which it is known to fail (first the heuristic: 4
per row that must go, 3 per truncated row); a state whose entry exceeds what is left
of the bound is not entered.  Under the least sufficient bound the first
accepting path is the ASCII-least of the cheapest.

Deepening from the first row alone would walk a long conversation once per step of
cost, the square of its length.  So rows are cut into segments of ``SEGMENT`` which
are searched from the last to the first, each from every last initial; reaching
a segment's end costs what the next one is known to cost from there.  Those
costs are exact, so a segment's first accepting path under its least bound begins the
whole conversation's, and the answer chains them.  Work grows with the length.

Only letters and digests go to Python (Arrow); texts stay in the JVM, where
expressions put the repaired turns together.

Defined results: a null role or text is one space (so a null text is blank and a null
role fits nowhere); a null turn sorts first and takes no part in gaps; rows of one
turn are sorted by role, then text; repeated rows are duplicates; a very long text is
one digest; rows without a conversation id form a conversation; a conversation left
without rows gives zeros and empty strings; an empty table gives an empty result;
other columns are ignored, whatever their names.  A conversation's repaired text is
one value of the result, so it must fit a Spark string (2 GB).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELETE, INSERT, KEEP, REROLE = "DIKR"
COST = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
STAYS_TRUNCATED = 3
SEGMENT = 32
# last initial -> initials that may follow; "" is the beginning
AFTER = {"": "su", "s": "u", "u": "a", "a": "u"}
# what the expression still asks for behind the last row
ENDING = {"": 0, "a": 0, "u": COST[INSERT], "s": 2 * COST[INSERT]}
ROLES = {"u": "user", "a": "assistant"}
BLANK, DUPLICATE, TRUNCATED, SOUND = "bdt-"
SPACE = " \t\n\x0b\x0c\r"
EDIT_TYPE = ("audit string, cost long, blank long, duplicate long, truncated long, illegal long, "
             "sources array<int>, roles array<string>")


class Search:
    """The cheapest, ASCII-least edits of one conversation (initials and faults per row)."""

    def __init__(self, initials: list[str], faults: list[str]):
        self.initials, self.faults, n = initials, faults, len(initials)
        self.table: dict = {(n, last): cost for last, cost in ENDING.items()}
        self.entry: dict = {}                       # segment start and initial -> path, initial behind it
        self.ahead = [0] * (n + 1)                  # heuristic: forced cost to the segment's end and beyond
        end = n
        while end > 0:
            start = max(0, end - 1) // SEGMENT * SEGMENT
            self.ahead[end] = min(self.table[end, last] for last in AFTER)
            for i in range(end - 1, start - 1, -1):
                f = faults[i]
                self.ahead[i] = self.ahead[i + 1] + (
                    STAYS_TRUNCATED if f == TRUNCATED else 0 if f == SOUND else COST[DELETE])
            for last in AFTER if start else ("",):
                self.deepen(start, last, end)
            end = start

    def moves(self, i: int, last: str):
        """(edit, cost, next row, next initial) in ASCII order."""
        follow = AFTER[last][-1]
        yield DELETE, COST[DELETE], i + 1, last
        yield INSERT, COST[INSERT], i, follow
        if self.faults[i] in (SOUND, TRUNCATED):
            more = STAYS_TRUNCATED if self.faults[i] == TRUNCATED else 0
            if self.initials[i] in AFTER[last]:
                yield KEEP, COST[KEEP] + more, i + 1, self.initials[i]
            yield REROLE, COST[REROLE] + more, i + 1, follow

    def bound(self, i: int, last: str) -> int:
        return self.table.get((i, last), self.ahead[i])

    def first_path(self, i: int, last: str, left: int, end: int):
        """(edits, last initial) of the first path to the segment's end within ``left``, or None."""
        if i == end:
            return "", last
        for edit, cost, j, after in self.moves(i, last):
            if cost + self.bound(j, after) <= left:
                found = self.first_path(j, after, left - cost, end)
                if found:
                    return edit + found[0], found[1]
        self.table[i, last] = min(c + self.bound(j, after) for _, c, j, after in self.moves(i, last))
        return None

    def deepen(self, start: int, last: str, end: int) -> None:
        limit = self.bound(start, last)
        while not (found := self.first_path(start, last, limit, end)):
            limit = self.table[start, last]
        self.table[start, last] = limit
        self.entry[start, last] = found

    def answer(self) -> tuple[str, int]:
        """(audit, cost)."""
        out, i, last, n = [], 0, "", len(self.initials)
        while i < n:
            edits, last = self.entry[i, last]
            out.append(edits)
            i = min(n, i + SEGMENT)
        return "".join(out) + INSERT * (ENDING[last] // COST[INSERT]), self.table[0, ""]


def faults_of(codes) -> list[str]:
    """First fault per row from (initial, own fault, digest) codes."""
    seen, out = set(), []
    for c in codes:
        out.append(BLANK if c[1] == BLANK else DUPLICATE if c[2:] in seen else c[1])
        seen.add(c[2:])
    return out


def edited(audit: str, initials: list[str]):
    """Per repaired turn: its row (-1: inserted) and its new role (None: its own)."""
    sources, roles, i, last = [], [], 0, ""
    for e in audit:
        if e != DELETE:
            last = initials[i] if e == KEEP else AFTER[last][-1]
            sources.append(-1 if e == INSERT else i)
            roles.append(None if e == KEEP else ROLES[last])
        i += e != INSERT
    return sources, roles


def repair_codes(codes) -> tuple:
    initials, faults = [c[0] for c in codes], faults_of(codes)
    audit, cost = Search(initials, faults).answer()
    return (audit, cost, faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            *edited(audit, initials))


def repair_batch(codes: pd.Series) -> pd.DataFrame:
    names = [f.split()[0] for f in EDIT_TYPE.split(", ")]
    return pd.DataFrame([repair_codes(c) for c in codes], columns=names)


def code_of(role: Column, text: Column) -> Column:
    """Initial, own fault and a digest of role and text, as one string."""
    last = F.substring(F.rtrim(text, F.lit(SPACE)), -1, 1)
    fault = (F.when(last == "", BLANK).when(last.isin(".", "!", "?"), SOUND).otherwise(TRUNCATED))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.rpad(F.substring(role, 1, 1), 1, " "), fault, F.sha2(whole, 256))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", present: Column | None = None) -> DataFrame:
    """One row per conversation: id, gaps, fault counts, cost, audit and ``repaired`` turns.

    Conversations whose rows all fail ``present`` are kept, without turns.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    turn = F.struct(F.col(turn_col).alias("turn"), space(role_col).alias("role"),
                    space(text_col).alias("text"))
    here = F.lit(True) if present is None else present
    repair_udf = F.pandas_udf(repair_batch, EDIT_TYPE)
    chats = (rows.select(F.col(conv_col).alias("conv"), F.when(here, turn).alias("turn"))
             .groupBy("conv").agg(F.sort_array(F.collect_list("turn")).alias("turns")))
    numbers = F.filter("turns.turn", lambda t: t.isNotNull())
    chats = chats.select("conv", "turns", F.coalesce(
        F.array_max(numbers) - F.array_min(numbers) + 1 - F.size(F.array_distinct(numbers)),
        F.lit(0)).cast("long").alias("gaps"), repair_udf(F.transform(
            "turns", lambda t: code_of(t["role"], t["text"]))).alias("edit"))
    repaired = F.zip_with("edit.sources", "edit.roles", lambda at, role: F.struct(
        F.coalesce(role, F.get(F.col("turns"), at)["role"]).alias("role"),
        F.when(at < 0, "").otherwise(F.get(F.col("turns"), at)["text"]).alias("text")))
    return chats.select(F.col("conv").alias(conv_col), "gaps", "edit.blank", "edit.duplicate",
                        "edit.truncated", "edit.illegal", "edit.cost", "edit.audit",
                        repaired.alias("repaired"))


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage; a dropped row stays as a row with ``present`` false."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    out = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                      F.coalesce("text", F.lit(" ")).alias("text"),
                      (F.crc32(key.cast("binary")) % 20).alias("hit"))
    return out.select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"), (F.col("hit") != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("hit") == 3, 2).otherwise(1))).alias("copy")
    ).drop("copy")


def op13_repair(spark, sf_dir: str) -> DataFrame:
    """Contract query: every conversation, damaged by rule and repaired."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    out = repair(damaged(rows), present=F.col("present"))
    text = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                      F.sha2(text, 256).alias("repaired_sha256"))
