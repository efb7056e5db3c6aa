"""Conversation structure repair: the cheapest edits that make a conversation alternate, found in one sorted stream.

Rows are dealt by conversation and sorted by turn; a task reads them in Arrow batches and carries, across batches, the cost of
the best edits so far for each of four role states. Every row adds four one-byte backpointers. A conversation of ordinary size
is traced back as soon as its last row is read. A giant one never lies in memory: its backpointers are spilled in blocks into a
written table of the shared folder, a second stream reads the blocks from last to first and carries the state back, and a third
one applies the steps to the rows.

Wanted: role initials ``(s?(ua)+)?``. Edits: K keeps a row (0), R gives it the role user or assistant (1), D deletes it (2, a
must for blank and duplicate rows), I inserts a row with empty text and role user or assistant (5). A truncated row that stays
costs 5 more. Among the cheapest edits those whose initials come first in ASCII order are taken. They are found going forward:
best prefixes of different states, each ending with the edit of the same row, never begin one another, so their order is that
of their ranks, whatever follows.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.sources.lake import Scratch

GIANT_ROWS, GIANT_BYTES = 20_000, 32 << 20  # a conversation beyond either is spilled; also the rows of a spilled block
INSERT_COST, REROLE_COST, DELETE_COST, TRUNCATED_COST = 5, 1, 2, 5
SPACE = " \t\n\x0b\x0c\r"

_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}
_OTHER = (_USER, _USER, _ASSISTANT, _USER)  # where an inserted or re-roled row leads
_NAME = ("user", "user", "assistant", "user")  # and its role
_D, _K, _R = range(3)  # in ASCII order
_LETTER = "DKR"
_LEGAL = {"su", "ua", "au"}
_NEVER = 1 << 60

SUMMARY = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
TURNS = "place long, edit string, role string, text string"
_SPILL = ("block long, first_turn long, first_role string, first_text string, pointers binary, end_state int, end_insert boolean, "
          "gaps long, blank long, duplicate long, truncated long, illegal long, cost long")


def damage(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, present) with faults planted by a checksum of ``conv_id:turn``; nulls count as one space.

    Dropped rows stay with ``present`` false, so their conversation is not forgotten.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), space).alias("role"),
                        F.coalesce(F.col("text"), space).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("_n"))
    text = F.when(F.col("_n").isin(0, 1), "").when(F.col("_n") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("_n") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (F.col("_n") != 0).alias("present"),
                       F.explode(F.when(F.col("_n") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


def repair(turns: DataFrame, scratch: Scratch, giant_rows: int = GIANT_ROWS, giant_bytes: int = GIANT_BYTES) -> DataFrame:
    """One row for each conversation of ``turns``: conv_id, faults before the repair, cost, ``audit`` and a hash of the result.

    ``turns`` has conv_id, turn, role, text and, if wanted, present: rows where that is false only name their conversation. Rows
    are read by turn (nulls first), then role, then text. A row's first fault counts: blank, duplicate (role and text seen
    earlier), truncated (last character that is no white space is none of ``.!?``). ``gaps`` are whole turns missing between the
    smallest and the largest, ``illegal`` adjacent initials that may not follow each other. Null roles and texts are empty; null
    conv_ids form one conversation; one without rows has zeros, an empty audit and the hash of the empty string; no rows give
    none. Other columns are ignored.
    """
    return _run(turns, scratch, SUMMARY, giant_rows, giant_bytes)


def repaired_turns(turns: DataFrame, scratch: Scratch, giant_rows: int = GIANT_ROWS, giant_bytes: int = GIANT_BYTES) -> DataFrame:
    """The repaired rows themselves: conv_id, place (from 0), edit (K, R or I), role, text; deleted rows are left out."""
    return _run(turns, scratch, TURNS, giant_rows, giant_bytes)


def _run(turns: DataFrame, scratch: Scratch, schema: str, giant_rows: int, giant_bytes: int) -> DataFrame:
    kind = turns.schema["conv_id"].dataType
    present = F.coalesce(F.col("present"), F.lit(True)) if "present" in turns.columns else F.lit(True)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"), present.alias("present"))
    large = (rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_rows"), F.sum(F.octet_length("text")).alias("_bytes"))
                 .filter((F.col("_rows") > giant_rows) | (F.col("_bytes") > giant_bytes)).select("conv_id"))
    large = scratch.write(large)
    ids = f"conv_id {kind.simpleString()}"
    if large.isEmpty():
        return _sorted(rows.withColumn("later", F.lit(None).cast("boolean"))).mapInArrow(
            lambda batches: _stream(batches, schema, giant_rows), f"{ids}, {schema}")
    same = rows["conv_id"].eqNullSafe(large["conv_id"])
    small = _sorted(rows.join(large, same, "left_anti").withColumn("later", F.lit(None).cast("boolean"))).mapInArrow(
        lambda batches: _stream(batches, schema, giant_rows), f"{ids}, {schema}")
    giants = scratch.write(_with_earlier_copies(rows.join(large, same, "left_semi")))
    spilled = scratch.write(_sorted(giants).mapInArrow(lambda batches: _stream(batches, None, giant_rows), f"{ids}, {_SPILL}"))
    steps = (spilled.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))
                    .mapInArrow(_trace_back, f"{ids}, {_SPILL}"))
    steps = scratch.write(steps)
    nothing = {c: F.lit(None) for c in ("pointers", "end_insert", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    both = giants.withColumns({"is_row": F.lit(True), "block": F.lit(None).cast("long"), **nothing}).drop("later").unionByName(steps.select(
        "conv_id", F.col("first_turn").alias("turn"), F.col("first_role").alias("role"), F.col("first_text").alias("text"),
        F.lit(False).alias("is_row"), "block", F.lit(False).alias("present"), *nothing))
    return small.unionByName(_sorted(both, "is_row", "block").mapInArrow(lambda batches: _apply(batches, schema), f"{ids}, {schema}"))


def _sorted(rows: DataFrame, *more: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", *more)


def _with_earlier_copies(rows: DataFrame) -> DataFrame:
    """Adds ``later``: an equal role and text stands at a smaller turn of the conversation. Equal rows of one turn lie side by side."""
    present = rows.filter("present")
    first = present.groupBy("conv_id", "role", "text").agg(
        F.count_if(F.col("turn").isNull()).alias("_no_turn"), F.min("turn").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    left, right = rows.alias("l"), first.alias("r")
    on = (F.col("l.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("l.role") == F.col("r.role")) & (F.col("l.text") == F.col("r.text")))
    later = F.col("l.turn").isNotNull() & ((F.col("r._no_turn") > 0) | (F.col("r._first") < F.col("l.turn")))
    return left.join(right, on, "left").select("l.*", F.coalesce(later, F.lit(False)).alias("later"))


class _Forward:
    """State of one conversation while its rows go by."""

    def __init__(self):
        self.costs, self.ranks = [0, _NEVER, _NEVER, _NEVER], [0, 1, 2, 3]
        self.gaps = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.last = None
        self.distinct = 0
        self.seen: set[bytes] = set()
        self.initial: str | None = None

    def row(self, turn: int | None, role: str, text: str, later: bool | None) -> bytes:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.distinct = turn, self.distinct + 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in _LEGAL:
            self.illegal += 1
        self.initial = initial
        mark = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        again = mark in self.seen if later is None else later or mark == self.last
        self.last = mark
        if later is None:
            self.seen.add(mark)
        bare = text.rstrip(SPACE)
        extra = 0
        if not bare:
            self.blank += 1
        elif again:
            self.duplicate += 1
        elif bare[-1] not in ".!?":
            self.truncated += 1
            extra = TRUNCATED_COST
        return self._step(initial, extra, not bare or again)

    def _step(self, initial: str, extra: int, gone: bool) -> bytes:
        """Best (cost, rank of the state before, insert, edit) for each state after this row; its backpointers."""
        best: list = [None] * 4

        def offer(state: int, cost: int, before: int, insert: int, edit: int):
            # an insert's I sorts after D and before K and R; both follow the same prefix
            key = (cost, self.ranks[before], (1, edit) if insert else (0, 0) if edit == _D else (2, edit))
            if best[state] is None or key < best[state][0]:
                best[state] = key, before, insert, edit
        for before in range(4):
            cost = self.costs[before]
            if cost >= _NEVER:
                continue
            offer(before, cost + DELETE_COST, before, 0, _D)
            if gone:
                continue
            for insert, at in ((0, before), (1, _OTHER[before])):
                paid = cost + insert * INSERT_COST + extra
                kept = _NEXT.get((at, initial))
                if kept is not None:
                    offer(kept, paid, before, insert, _K)
                offer(_OTHER[at], paid + REROLE_COST, before, insert, _R)
        order = sorted((s for s in range(4) if best[s]), key=lambda s: best[s][0][1:])
        self.ranks = [order.index(s) if best[s] else 4 for s in range(4)]
        self.costs = [b[0][0] if b else _NEVER for b in best]
        return bytes(b[1] << 3 | b[2] << 2 | b[3] if b else 255 for b in best)

    def end(self) -> tuple[int, bool, int]:
        """(last state of the rows, whether an assistant is added at the end, cost)."""
        ends = [(self.costs[s] + (INSERT_COST if s == _USER else 0), self.ranks[s], s) for s in (_START, _ASSISTANT, _USER)]
        cost, _, state = min(ends)
        return state, state == _USER, cost

    def counts(self) -> tuple[int, ...]:
        gaps = self.high - self.low + 1 - self.distinct if self.distinct else 0
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.end()[2]


def _back(pointers: bytes, state: int) -> tuple[bytes, int]:
    """(one byte a row: state before, insert, edit; the state before the first row) of rows that end in ``state``."""
    steps = bytearray(len(pointers) // 4)
    for k in range(len(steps) - 1, -1, -1):
        steps[k] = pointers[4 * k + state]
        state = steps[k] >> 3
    return bytes(steps), state


class _Result:
    """Audit, hash and rows of one conversation while its steps are applied."""

    def __init__(self, keep_rows: bool):
        self.audit, self.hash, self.rows, self.keep_rows, self.place = bytearray(), hashlib.sha256(), [], keep_rows, 0

    def _out(self, edit: str, role: str, text: str) -> None:
        line = f"{role}:{text}".encode("utf-8", "surrogatepass")
        self.hash.update(b"\n" + line if self.place else line)
        if self.keep_rows:
            self.rows.append((self.place, edit, role, text))
        self.place += 1

    def step(self, step: int, role: str, text: str) -> None:
        before, insert, edit = step >> 3, step >> 2 & 1, step & 3
        if insert:
            self.insert(before)
            before = _OTHER[before]
        self.audit += _LETTER[edit].encode()
        if edit != _D:
            self._out(_LETTER[edit], role if edit == _K else _NAME[before], text)

    def insert(self, state: int) -> None:
        self.audit += b"I"
        self._out("I", _NAME[state], "")


def _arrow(schema: str, ids: pa.DataType) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([("conv_id", ids), *[(n, kinds[t]) for n, t in (c.split() for c in schema.split(", "))]])


def _values(batches: Iterator[pa.RecordBatch], found: list) -> Iterator[tuple]:
    for batch in batches:
        found[:] = [batch.schema.field("conv_id").type]
        for at in range(0, batch.num_rows, 1000):
            yield from zip(*[c.to_pylist() for c in batch.slice(at, 1000).columns], strict=True)


class _Out:
    """Collected output rows, handed on as Arrow batches of bounded size."""

    def __init__(self, schema: str, kind: list):
        self.schema, self.kind, self.rows, self.size = schema, kind, [], 0

    def add(self, row: tuple, size: int = 100) -> None:
        self.rows.append(row)
        self.size += size

    def ready(self, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
        if self.rows and self.size >= most:
            schema = _arrow(self.schema, self.kind[0])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.rows, strict=True), schema, strict=True)], schema=schema)
            self.rows, self.size = [], 0


def _emit(out: _Out, conv, counts: tuple, result: _Result, schema: str) -> None:
    if schema == SUMMARY:
        out.add((conv, *counts, result.audit.decode(), result.hash.hexdigest()), 200 + len(result.audit))
    for row in result.rows:
        out.add((conv, *row), 60 + 2 * len(row[3]))
    result.rows = []


def _stream(batches: Iterator[pa.RecordBatch], schema: str | None, block_rows: int) -> Iterator[pa.RecordBatch]:
    """Forward over sorted rows. Conversations are traced and applied when they end or, without ``schema``, spilled in blocks."""
    kind: list = []
    out = _Out(schema or _SPILL, kind)
    now, conv = None, None
    rows: list[tuple[str, str]] = []
    pointers, first, block = bytearray(), None, 0

    def finish() -> None:
        nonlocal block
        state, insert, _ = now.end()
        if schema is None:
            spill(state, insert, now.counts())
            return
        result = _Result(schema == TURNS)
        for step, (role, text) in zip(_back(bytes(pointers), state)[0], rows, strict=True):
            result.step(step, role, text)
        if insert:
            result.insert(_USER)
        _emit(out, conv, now.counts(), result, schema)

    def spill(state: int | None = None, insert: bool | None = None, counts: tuple = (None,) * 6) -> None:
        nonlocal block, first
        turn, role, text = first or (None, "", "")
        out.add((conv, block, turn, role, text, bytes(pointers), state, insert, *counts), 200 + len(pointers) + 2 * len(text))
        pointers.clear()
        block, first = block + 1, None

    for conv_id, turn, role, text, present, later in _values(batches, kind):
        if now is None or conv_id != conv:
            if now is not None:
                finish()
                yield from out.ready()
            now, conv, rows, pointers, first, block = _Forward(), conv_id, [], bytearray(), None, 0
        if not present:
            continue
        if schema is None and len(pointers) >= 4 * block_rows:
            spill()
            yield from out.ready()
        first = first or (turn, role, text)
        pointers += now.row(turn, role, text, later)
        if schema is not None:
            rows.append((role, text))
    if now is not None:
        finish()
        yield from out.ready(1)


def _trace_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a conversation from last to first: pointers become the steps that were taken."""
    kind: list = []
    out, conv, state = _Out(_SPILL, kind), None, None
    for row in _values(batches, kind):
        if row[6] is not None:
            conv, state = row[0], row[6]
        assert row[0] == conv
        steps, state = _back(row[5], state)
        out.add((*row[:5], steps, *row[6:]), 200 + len(steps))
        yield from out.ready()
    yield from out.ready(1)


def _apply(batches: Iterator[pa.RecordBatch], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows of giant conversations with their blocks of steps, each block before the rows it is for."""
    kind: list = []
    out, conv, result, last = _Out(schema, kind), None, None, None
    steps: deque = deque()

    def finish() -> None:
        if last[0]:
            result.insert(_USER)
        _emit(out, conv, last[1:], result, schema)

    for conv_id, _, role, text, present, is_row, _, pointers, insert, *counts in _values(batches, kind):
        if result is None or conv_id != conv:
            if result is not None:
                finish()
            conv, result, last = conv_id, _Result(schema == TURNS), (False, *[0] * 6)
            steps.clear()
        if not is_row:
            steps.extend(np.frombuffer(pointers, np.uint8).tolist())
            if insert is not None:
                last = (insert, *counts)
        elif present:
            result.step(steps.popleft(), role, text)
            for done in result.rows:
                out.add((conv, *done), 60 + 2 * len(done[3]))
            result.rows = []
        yield from out.ready()
    if result is not None:
        finish()
        yield from out.ready(1)

