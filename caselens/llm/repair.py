"""Repair of the order of roles in conversations, by table lookups for blocks of rows.

A conversation is right if the initials of its roles read ``(s?(ua)+)?``.  A row can be kept, given the role user or
assistant, or deleted, and an empty turn can be inserted anywhere, each at a price; a blank or repeated row has to go.
The cheapest edits are found, and of equal ones those whose initials come first in ASCII order.

*Four-Russians tables.*  What the rows from some place on cost depends on the state reached before them, so it is a
vector over the four states of the pattern.  Less its least entry, only few vectors ever come up.  For every such
vector and every block of ``BLOCK`` row kinds, a table holds the vector before the block and what was taken off: rows
are passed a block at a time, from the last to the first, by lookup.

*Long conversations.*  Rows are numbered on all tasks and cut in chunks of ``CHUNK``.  A chunk maps every vector behind
it to the one before it; maps of ``FAN`` neighbours are composed, level by level, until one is left for the
conversation, and the vectors behind the chunks are then found on the way down.  No task holds more than a chunk or the
maps of ``FAN`` chunks, however many rows one conversation has.

*Tracing.*  With the vector behind it, a block is expanded backwards, row by row, and the edits are read forwards: the
first letter in ASCII order that still leads to the least cost.  This and the digest of the repaired text, which can
only be taken in order, pass over the sorted rows of a conversation once, with the state of one row in memory.

Nulls in texts, roles and keys of the damage are one space.  Rows are taken by turn, nulls first, then role, text and
copy, so repeated rows stand side by side and all but the first are duplicates.  A null ``conv_id`` is one
conversation.  Every ``conv_id`` of the table gets a row; one whose rows are all gone has zeros, no edits and the digest
of nothing, and an empty table gives no rows.  Texts of any length are read whole.  Columns other than ``conv_id``,
``turn``, ``role`` and ``text`` are not read and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselens.operators.prefix import global_rank
from caselens.storage import settle

#: Rows of a block of the table, rows of a chunk, and neighbours whose maps are composed.
BLOCK, CHUNK, FAN = 4, 4096, 256
#: Prices.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

# States of the pattern: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a kept row of an initial leads, and the turn that an insertion or a new role gives.
KEEP = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None), "-": (None,) * 4}
MADE = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Cost at the end, before insertions: the pattern may end with nothing and after a.
FINAL = (0, None, None, 0)
#: Kinds of rows: to be deleted, then each initial, whole and truncated.
KINDS = ["x", *(initial + cut for cut in ("", "!") for initial in "sua-")]

Vector = tuple[int, ...]
FAR = 1 << 20


def _inserted(costs: list[int]) -> list[int]:
    """Costs when turns may be inserted first; from any state two of them come back to one passed."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[MADE[q]]) for q, c in enumerate(costs)]
    return costs


def end_vector() -> Vector:
    return tuple(_inserted([FAR if c is None else c for c in FINAL]))


def row_options(kind: str, after: Vector) -> list[dict[str, tuple[int, int]]]:
    """For each state the edits of a row, by letter: cost up to the end, and the state they lead to."""
    out = []
    for q in range(4):
        options = {"D": (DELETE + after[q], q)}
        if kind != "x":
            extra = TRUNCATED if kind.endswith("!") else 0
            to = KEEP[kind[0]][q]
            if to is not None:
                options["K"] = (extra + after[to], to)
            options["R"] = (REROLE + extra + after[MADE[q]], MADE[q])
        out.append(options)
    return out


def before_row(kind: str, after: Vector) -> Vector:
    """Costs of the states before a row, from those after it."""
    return tuple(_inserted([min(c for c, _ in options.values()) for options in row_options(kind, after)]))


class Tables:
    """The vectors that come up, and the steps between them for a row and for a block of rows.

    ``vector[v]`` has least entry 0.  ``row[v, k]`` and ``block[v, b]`` name the vector before a row of kind k or a block
    b (its kinds as digits, the first row leading), ``row_off`` and ``block_off`` what was taken off.
    """

    def __init__(self):
        kinds = len(KINDS)
        first = self._normal(end_vector())[0]
        number, todo, steps = {first: 0}, [first], []
        for v in todo:
            made = []
            for kind in KINDS:
                to, off = self._normal(before_row(kind, v))
                if to not in number:
                    number[to] = len(todo)
                    todo.append(to)
                made.append((number[to], off))
            steps.append(made)
        self.vector = todo
        table = np.array(steps, np.int32)
        self.row, self.row_off = table[:, :, 0], table[:, :, 1]
        self.block, self.block_off = self.row, self.row_off
        for _ in range(BLOCK - 1):
            # A row before each block of one row less.
            then = self.row[self.block]
            self.block_off = (self.block_off[:, :, None] + self.row_off[self.block]).transpose(0, 2, 1).reshape(len(todo), -1)
            self.block = then.transpose(0, 2, 1).reshape(len(todo), -1)
        self.kinds = kinds

    @staticmethod
    def _normal(v: Vector) -> tuple[Vector, int]:
        off = min(v)
        return tuple(c - off for c in v), off

    def _blocks(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leading rows that fill no block, and the numbers of the blocks behind them."""
        head = len(kinds) % BLOCK
        digits = kinds[head:].reshape(-1, BLOCK).astype(np.int64)
        return kinds[:head], digits @ (self.kinds ** np.arange(BLOCK - 1, -1, -1))

    def chunk_map(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every vector behind the rows, the one before them and what was taken off."""
        head, blocks = self._blocks(kinds)
        at, off = np.arange(len(self.vector)), np.zeros(len(self.vector), np.int64)
        for b in blocks[::-1]:
            off += self.block_off[at, b]
            at = self.block[at, b]
        for k in head[::-1]:
            off += self.row_off[at, k]
            at = self.row[at, k]
        return at, off

    def behind(self, kinds: np.ndarray, last: int) -> np.ndarray:
        """The vector behind every row, given the one behind the last: blocks by lookup, then each block expanded."""
        head, blocks = self._blocks(kinds)
        ends = np.empty(len(blocks) + 1, np.int64)
        ends[-1] = last
        for i in range(len(blocks) - 1, -1, -1):
            ends[i] = self.block[ends[i + 1], blocks[i]]
        out = np.empty(len(kinds), np.int64)
        inner = kinds[len(head) :].reshape(-1, BLOCK)
        at = ends[1:]
        for j in range(BLOCK - 1, -1, -1):
            out[len(head) + j :: BLOCK] = at
            at = self.row[at, inner[:, j]]
        at = ends[0]
        for i in range(len(head) - 1, -1, -1):
            out[i] = at
            at = self.row[at, head[i]]
        return out


@cache
def tables() -> Tables:
    return Tables()


@cache
def _step(kind: int, behind: int, state: int) -> tuple[str, int, int]:
    """Insertions and the row's edit from a state (letters, cost without what follows, and the state after the row)."""
    after = tables().vector[behind]
    options = row_options(KINDS[kind], after)
    costs = before_row(KINDS[kind], after)
    letters, paid = "", 0
    while True:
        here = options[state]
        # In ASCII order: D, I, K, R.
        if "D" in here and here["D"][0] == costs[state]:
            return letters + "D", paid + DELETE, state
        if INSERT + costs[MADE[state]] == costs[state]:
            letters, paid, state = letters + "I", paid + INSERT, MADE[state]
            continue
        for letter in "KR":
            if letter in here and here[letter][0] == costs[state]:
                to = here[letter][1]
                return letters + letter, paid + here[letter][0] - after[to], to


def _ending(state: int) -> tuple[str, int]:
    """Insertions at the end, and their cost."""
    letters = ""
    while FINAL[state] is None:
        letters, state = letters + "I", MADE[state]
    return letters, INSERT * len(letters)


# Rows.


def damaged(conversations: DataFrame) -> DataFrame:
    """conv, turn, role, text, copy: what is left of the rows after the damage that a checksum of their key names."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    how, text = F.col("how"), F.coalesce("text", blank)
    rows = conversations.select("conv_id", "turn", "role", "text", (F.crc32(key.cast("binary")) % 20).alias("how")).where(how != 0)
    return rows.select(
        conversation().alias("conv"),
        "turn",
        F.when(how == 4, F.lit("user")).otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(how == 1, F.lit("")).when(how == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(how == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def conversation() -> Column:
    """A key that is never null."""
    return F.coalesce(F.col("conv_id").cast("string"), F.lit(""))


#: Faults of a row, and the kinds without one.
FINE, BLANK, DUPLICATE, CUT = range(4)
INITIALS = {"s": 0, "u": 1, "a": 2}


def _kind(role: str, fault: int) -> int:
    if fault in (BLANK, DUPLICATE):
        return 0
    return 1 + INITIALS.get(role[:1], 3) + (4 if fault == CUT else 0)


def _kinds(initial: np.ndarray, fault: np.ndarray) -> np.ndarray:
    """The same for arrays."""
    return np.where((fault == BLANK) | (fault == DUPLICATE), 0, 1 + initial + 4 * (fault == CUT))


def faulty(rows: DataFrame) -> DataFrame:
    """conv, rank, initial, fault of numbered rows (without texts), written."""
    worded = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    bare = settle(rows.select(
        "conv", "rank", initial.alias("initial"), F.when(~worded, BLANK).when(~ended, CUT).otherwise(FINE).alias("fault"), said.alias("said")
    ), "turns")
    earliest = bare.groupBy("conv", "said").agg(F.min("rank").alias("rank")).select("rank", F.lit(True).alias("earliest"))
    known = bare.join(earliest, "rank", "left")
    repeated = F.col("earliest").isNull() & (F.col("fault") != BLANK)
    return known.select("conv", "rank", "initial", F.when(repeated, DUPLICATE).otherwise(F.col("fault")).alias("fault"))


# Vectors behind chunks.


def _maps(chunks: DataFrame) -> DataFrame:
    """conv, node, map: the vector before a chunk for each behind it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = [
                tables().chunk_map(_kinds(*_bytes(i, f)))[0].astype("<i4").tobytes()
                for i, f in zip(batch.column("initials").to_pylist(), batch.column("faults").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("node"), pa.array(maps, pa.binary())],
                                             names=["conv", "node", "map"])

    return chunks.mapInArrow(run, "conv string, node long, map binary")


def _bytes(*columns: bytes) -> list[np.ndarray]:
    return [np.frombuffer(c, np.uint8).astype(np.int64) for c in columns]


def _composed(families: DataFrame) -> DataFrame:
    """conv, node, map of the children's maps in a row, the last one first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for children in batch.column("children").to_pylist():
                at = np.arange(len(tables().vector))
                for child in reversed(children):
                    at = np.frombuffer(child["map"], "<i4")[at]
                made.append(at.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("node"), pa.array(made, pa.binary())],
                                             names=["conv", "node", "map"])

    return families.select("conv", "node", "children").mapInArrow(run, "conv string, node long, map binary")


def _handed_down(families: DataFrame, behind: DataFrame) -> DataFrame:
    """conv, node, behind of the children, from those of their parents (0, the end of a conversation, if not named)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for conv, children, at in zip(*(batch.column(c).to_pylist() for c in ("conv", "children", "behind"))):
                for child in reversed(children):
                    out.append((conv, child["node"], at))
                    at = int(np.frombuffer(child["map"], "<i4")[at])
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32())],
                names=["conv", "node", "behind"])

    known = families.join(behind, ["conv", "node"], "left").select("conv", "children", F.coalesce("behind", F.lit(0)).alias("behind"))
    return known.mapInArrow(run, "conv string, node long, behind int")


def vectors_behind(chunks: DataFrame) -> DataFrame:
    """conv, node, behind: the vector behind each chunk of a conversation that has several."""
    spark = chunks.sparkSession
    level, families = settle(_maps(chunks), "chunk-maps"), []
    while True:
        several = level.groupBy("conv").agg(F.count("*").alias("nodes")).where("nodes > 1").select("conv")
        groups = level.join(several, "conv", "left_semi").groupBy("conv", F.expr(f"node div {FAN}").alias("node")).agg(
            F.array_sort(F.collect_list(F.struct("node", "map"))).alias("children"))
        groups = settle(groups, "families")
        if groups.isEmpty():
            break
        families.append(groups)
        level = settle(_composed(groups), "chunk-maps")
    behind = spark.createDataFrame([], "conv string, node long, behind int")
    for groups in reversed(families):
        behind = settle(_handed_down(groups, behind), "vectors")
    return behind


def traced(chunks: DataFrame) -> DataFrame:
    """conv, rank (of the chunk's first row), faults and behind: the fault of every row and the vector behind it."""
    behind = vectors_behind(chunks)
    known = chunks.join(behind, ["conv", "node"], "left").select(
        "conv", "rank", "initials", "faults", F.coalesce("behind", F.lit(0)).alias("behind"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                tables().behind(_kinds(*_bytes(i, f)), last).astype("<u2").tobytes()
                for i, f, last in zip(*(batch.column(c).to_pylist() for c in ("initials", "faults", "behind")))
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "rank", "faults")), pa.array(rows, pa.binary())],
                                             names=["conv", "rank", "faults", "behind"])

    return known.mapInArrow(run, "conv string, rank long, faults binary, behind binary")


# Repair.


class Talk:
    """One conversation, row after row."""

    def __init__(self, conv: str):
        self.conv, self.state, self.last, self.turn, self.first_turn, self.turns = conv, START, None, None, None, 0
        self.faults = [0] * 4
        self.illegal = self.cost = 0
        self.audit: list[str] = []
        self.digest, self.lines = hashlib.sha256(), 0

    def chunk(self, faults: bytes, behind: bytes) -> None:
        self.marks = zip(faults, np.frombuffer(behind, "<u2").tolist())

    def line(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def insert(self) -> None:
        self.state = MADE[self.state]
        self.line(NAMES[self.state], "")

    def row(self, turn: int | None, role: str, text: str) -> None:
        fault, behind = next(self.marks)
        self.faults[fault] += 1
        if turn is not None and turn != self.turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turn = turn
            self.turns += 1
        if self.last is not None and self.last + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = role[:1]
        letters, paid, state = _step(_kind(role, fault), behind, self.state)
        for _ in letters[:-1]:
            self.insert()
        if letters[-1] != "D":
            self.line(role if letters[-1] == "K" else NAMES[state], text)
        self.state = state
        self.audit.append(letters)
        self.cost += paid

    def result(self) -> tuple:
        letters, paid = _ending(self.state)
        for _ in letters:
            self.insert()
        gaps = 0 if self.turn is None else self.turn - self.first_turn + 1 - self.turns
        return (self.conv, gaps, *self.faults[1:], self.illegal, self.cost + paid, "".join(self.audit) + letters, self.digest.hexdigest())


REPAIRED = (
    "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def _read_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, each chunk led by its marks, to one row a conversation."""
    names = [part.split()[0] for part in REPAIRED.split(", ")]
    kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]
    pack = lambda out: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
    talk = None
    for batch in batches:
        out = []
        for conv, turn, role, text, faults, behind in zip(
            *(batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "faults", "behind"))
        ):
            if talk is None or conv != talk.conv:
                if talk is not None:
                    out.append(talk.result())
                talk = Talk(conv)
            if faults is not None:
                talk.chunk(faults, behind)
            else:
                talk.row(turn, role, text)
        if out:
            yield pack(out)
    if talk is not None:
        yield pack([talk.result()])


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("copy")]
    rows = global_rank(damaged(conversations), order, "rank")
    known = faulty(rows).groupBy("conv", F.expr(f"rank div {CHUNK}").alias("node")).agg(
        F.min("rank").alias("rank"), F.array_sort(F.collect_list(F.struct("rank", "initial", "fault"))).alias("rows"))
    packed = lambda name: F.unhex(F.array_join(F.transform("rows", lambda r: F.concat(F.lit("0"), r[name].cast("string"))), ""))
    chunks = settle(known.select("conv", "node", "rank", packed("initial").alias("initials"), packed("fault").alias("faults")), "chunks")
    none = lambda kind: F.lit(None).cast(kind)
    turn = rows.schema["turn"].dataType
    marks = traced(chunks).select(
        "conv", "rank", F.lit(0).alias("late"), none(turn).alias("turn"), none("string").alias("role"), none("string").alias("text"), "faults", "behind")
    turns = rows.select(
        "conv", "rank", F.lit(1).alias("late"), "turn", "role", "text", none("binary").alias("faults"), none("binary").alias("behind"))
    in_order = marks.unionByName(turns).repartition("conv").sortWithinPartitions("conv", "rank", "late")
    done = in_order.mapInArrow(_read_in_order, REPAIRED)
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return conversations.select("conv_id", conversation().alias("conv")).distinct().join(done, "conv", "left").select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
