"""Conversation structure repair: the cheapest edits that make turns alternate, by integer dynamic programming.

A path through a conversation is one integer: its high digits are the cost, its low digits the audit letters. Each row has a
slot of two octal digits (an insertion in front of it, if any, then what happens to the row, zeros at the end), so among
equally cheap paths the smaller integer is the one with the ASCII-least audit: a slot is never the beginning of another one.
The minimum of the integers at the last node decides everything; its digits are the audit.

Two insertions in one gap are never cheapest: leaving both out (or deleting a lone system turn) is legal and costs less.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 512  # rows in one integer; longer conversations go on from the order of the states at the end of a block
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4  # letters in ASCII order
COST = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
TRUNCATED = 5
_LETTERS = str.maketrans("1234", "DIKR", "0")
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}
_LEGAL = {"su", "ua", "au"}


def _wanted(state: int) -> str:
    return "a" if state == _USER else "u"


def _steps(state: int, initial: str, delete: bool, truncated: bool) -> Iterator[tuple[int, int, int]]:
    """``(slot, cost, next state)`` of everything that can happen in front of and to a row."""
    for inserted in (False, True):
        at, cost, first = (_NEXT[state, _wanted(state)], COST[INSERT], INSERT) if inserted else (state, 0, 0)
        slot = lambda letter: first << 3 | letter if inserted else letter << 3
        yield slot(DELETE), cost + COST[DELETE], at
        if not delete:
            if (at, initial) in _NEXT:
                yield slot(KEEP), cost + COST[KEEP] + TRUNCATED * truncated, _NEXT[at, initial]
            yield slot(REROLE), cost + COST[REROLE] + TRUNCATED * truncated, _NEXT[at, _wanted(at)]


_KNOWN = {(q, i, d, t): list(_steps(q, i, d, t)) for q in range(4) for i in ("s", "u", "a", "") for d in (False, True) for t in (False, True)}


class Repair:
    """The dynamic programme over one conversation's rows, given one by one."""

    def __init__(self):
        self.weight = {_START: 0}  # cost, then two bits for the order at the start of the block, then the slots
        self.origin = [_START]
        self.rows, self.blocks = 0, []

    def add(self, initial: str, delete: bool, truncated: bool) -> None:
        if self.rows == BLOCK:
            self._close()
        self.rows += 1
        width, initial = 2 + 6 * self.rows, initial if initial in ("s", "u", "a") else ""
        new: dict[int, int] = {}
        for state, w in self.weight.items():
            for slot, cost, to in _KNOWN[state, initial, delete, truncated]:
                v = (w << 6) + slot + (cost << width)
                if to not in new or v < new[to]:
                    new[to] = v
        self.weight = new

    def _close(self) -> None:
        width = 6 * self.rows
        low = {q: w & (1 << width + 2) - 1 for q, w in self.weight.items()}
        self.blocks.append({q: (self.origin[v >> width], v & (1 << width) - 1) for q, v in low.items()})
        self.origin = sorted(low, key=lambda q: (low[q], q))
        self.weight = {q: (self.weight[q] >> width + 2) << 2 | k for k, q in enumerate(self.origin)}
        self.rows = 0

    def best(self) -> tuple[int, str]:
        """Cost and audit of the cheapest repair."""
        width = 2 + 6 * self.rows + 3
        ends = [(self.weight[q] << 3, q) for q in (_START, _ASSISTANT) if q in self.weight]
        if _USER in self.weight:
            ends.append(((self.weight[_USER] << 3) + INSERT + (COST[INSERT] << width), _USER))
        w, _ = min(ends)
        low = w & (1 << width) - 1
        parts = [format(low & (1 << width - 2) - 1, f"0{2 * self.rows + 1}o")]
        state = self.origin[low >> width - 2]
        for block in reversed(self.blocks):
            state, digits = block[state]
            parts.append(format(digits, "o"))
        return w >> width, "".join(reversed(parts)).translate(_LETTERS)


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by conversation and place; only the one before is remembered."""
    names = ["conv", "n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    none = object()
    conv, dp = none, None

    def done():
        gaps = last - least + 1 - distinct if distinct else 0
        return (conv, n, gaps, *faults, illegal, *dp.best())

    for batch in batches:
        out = []
        for c, turn, role, digest, later, blank, cut in zip(*(batch.column(k).to_pylist() for k in range(7))):
            if c != conv or conv is none:
                if conv is not none:
                    out.append(done())
                conv, dp, n, before, initial, illegal = c, Repair(), 0, None, None, 0
                faults, least, last, distinct = [0, 0, 0], None, None, 0
            duplicate = later or (turn, role, digest) == before
            before = (turn, role, digest)
            kind = 0 if blank else 1 if duplicate else 2 if cut else None
            if kind is not None:
                faults[kind] += 1
            illegal += initial is not None and initial + role[:1] not in _LEGAL
            initial = role[:1]
            if turn is not None and (distinct == 0 or turn != last):
                least, last, distinct = turn if distinct == 0 else least, turn, distinct + 1
            n += 1
            dp.add(initial, kind in (0, 1), kind == 2)
        if out:
            yield _batch(out, names)
    if conv is not none:
        yield _batch([done()], names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    text = {"audit", "role", "text", "edit", "sha256"}
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n in text else pa.int64()) for c, n in zip(columns, names)], names=names)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, int, str, str, str] | None]:
    """``conv, place, role, text, edit`` of each turn that stays, in order; None after every batch."""
    role_of = {"u": "user", "a": "assistant"}
    conv, audit, at, state, place = None, "", 0, _START, 0

    def inserted():
        nonlocal at, state, place
        while audit[at : at + 1] == "I":
            role = _wanted(state)
            state, at, place = _NEXT[state, role], at + 1, place + 1
            yield conv, place - 1, role_of[role], "", "I"

    for batch in batches:
        for c, head, role, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if head is not None:
                yield from inserted()
                conv, audit, at, state, place = c, head, 0, _START, 0
                continue
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "D":
                continue
            initial = role[:1] if edit == "K" else _wanted(state)
            state, place = _NEXT[state, initial], place + 1
            yield conv, place - 1, role if edit == "K" else role_of[initial], text, edit
        yield None
    yield from inserted()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for turn in _repaired(batches):
        if turn is not None:
            out.append(turn)
            size += len(turn[3])
        if out and (turn is None or size > 1 << 22):
            yield _batch(out, ["conv", "place", "role", "text", "edit"])
            out, size = [], 0
    if out:
        yield _batch(out, ["conv", "place", "role", "text", "edit"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, digest, out = None, None, []
    for turn in _repaired(batches):
        if turn is None:
            if out:
                yield _batch(out, ["conv", "sha256"])
                out = []
            continue
        c, place, role, text, _ = turn
        if place == 0:
            if digest is not None:
                out.append((conv, digest.hexdigest()))
            conv, digest = c, hashlib.sha256()
        digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
    if digest is not None:
        out.append((conv, digest.hexdigest()))
    if out:
        yield _batch(out, ["conv", "sha256"])


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with one row in 20 dropped, emptied, stripped of its stops, repeated, or given the user's role.

    A hash of conversation and turn decides. Null roles and texts become one space, as null ids and turns do in what is hashed.
    """
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), (F.crc32(key) % 20).alias("_d")).where("_d <> 0")
    d = F.col("_d")
    text = F.when(d == 1, "").when(d == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(d == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), F.when(d == 3, 2).otherwise(1))).alias("_copy")).drop("_copy")


def _ordered(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
                                blank(f"`{role}`").alias("role"), blank(f"`{text}`").alias("text"))
    return rows.withColumn("digest", F.sha2("text", 256))


def repair(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, n_rows, gaps, blank, duplicate, truncated, illegal, cost, audit`` of each conversation.

    Rows are taken by turn (nulls first; ties by role, then SHA-256 of the text). A row's first fault counts: blank text,
    role and text seen earlier in the conversation, text that does not end in a stop. ``gaps`` are turns missing between the
    smallest and the largest, ``illegal`` neighbours whose roles' initials are not su, ua or au. ``audit`` holds the edits
    (Delete, Insert, Keep, Rerole) of the cheapest way, ASCII-least on ties, to initials ``(s?(ua)+)?``.

    Null roles and texts count as one space, a null conversation is one of its own, other columns are ignored; no rows, no
    result. A conversation is read in order by one task, which holds no text and about 3 bytes a row; duplicates are found
    by counting before.
    """
    rows = _ordered(conversations, conv_id, turn, role, text)
    slim = rows.select("conv", "turn", "role", "digest", (~F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))).alias("blank"),
                       (~F.rlike("text", F.lit(r"[.!?][\x20\x09-\x0D]*\z"))).alias("cut"))
    place = F.struct(F.col("turn").isNotNull().alias("p"), F.coalesce("turn", F.lit(0)).alias("t"))
    same = slim.groupBy("conv", "role", "digest").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").drop("last")
    same = same.withColumnsRenamed({"conv": "c", "role": "r", "digest": "d"})
    slim = slim.join(same, slim["conv"].eqNullSafe(same["c"]) & (slim["role"] == same["r"]) & (slim["digest"] == same["d"]), "left")
    slim = slim.select("conv", "turn", "role", "digest", F.coalesce(F.col("first") < place, F.lit(False)).alias("later"), "blank", "cut")
    slim = slim.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "digest")
    return slim.mapInArrow(_reports, "conv long, n_rows long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def _with_audits(conversations: DataFrame, report: DataFrame, names: tuple[str, str, str, str]) -> DataFrame:
    rows = _ordered(conversations, *names).select("conv", F.lit(None).cast("string").alias("audit"), "role", "text", "turn", "digest")
    none = F.lit(None).cast("string")
    heads = report.select("conv", "audit", none.alias("role"), none.alias("text"), F.lit(None).cast("long").alias("turn"), none.alias("digest"))
    both = rows.unionAll(heads).repartition("conv")
    return both.sortWithinPartitions("conv", F.isnull("audit"), F.asc_nulls_first("turn"), "role", "digest").select("conv", "audit", "role", "text")


def repaired_rows(conversations: DataFrame, report: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, place, role, text, edit``: the turns that the audits of ``repair`` leave, with inserted ones (empty text)."""
    return _with_audits(conversations, report, (conv_id, turn, role, text)).mapInArrow(_rows, "conv long, place long, role string, text string, edit string")


def repaired_digests(conversations: DataFrame, report: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, sha256`` of each repaired conversation with turns left: ``role:text`` joined by newlines, hashed turn by turn."""
    return _with_audits(conversations, report, (conv_id, turn, role, text)).mapInArrow(_digests, "conv long, sha256 string")
