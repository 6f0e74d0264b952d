"""Removal of long byte strings that repeat, by a logarithmic family of anchored suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else in the
corpus.  Sorting every suffix of a corpus is out of reach, so suffixes are sorted where
they can matter, and apart from each other:

1. Every window of ``LENGTH`` bytes has an *anchor*, the place of the least hash among its
   grams of ``GRAM`` bytes (the leftmost of equals).  Equal windows have equal anchors at
   equal offsets.  Consecutive windows share one, so anchors are few.  Anchors whose gram
   occurs once in all texts are dropped; counts are combined before they are shuffled.
2. Around the others, windows are gathered in blocks of ``BLOCK`` offsets.  The windows of a
   block share a core; its hash decides the task.  A row has the ``SIDE`` bytes on either
   side of the core, so a window is the core with a prefix and a suffix of known length.
3. In a task, arriving rows form batches.  A batch gets its suffix array (rows by core, then
   right side) and the mirrored array of its left sides, each with the lengths that
   neighbours share.  It is merge-scanned against every existing level for windows whose
   left and right parts both agree; then it becomes a level, and levels of equal size merge
   geometrically.
4. A core with more than ``HOT`` rows would fill a task: its windows are counted one by one,
   with partial counts before the shuffle.

Equal texts of ``LENGTH`` bytes and more are known by digest: all their bytes go, and one
of them stands for the group in the search.  Comparison is by bytes except for grams,
cores and texts, which are compared by hashes of 64, 128 and 128 bits.

A null text is empty.  Repeated rows are equal texts.  Ids may repeat or be null; rows are
told apart by id and text.  Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselens.llm.common import packed, pieces
from caselens.llm.hashing import Hasher, row_key
from caselens.storage import settle

LENGTH, GRAM, BLOCK = 400, 64, 32
SIDE = BLOCK - 1
CORE = LENGTH - SIDE
#: Bytes of a text that are searched together; longer texts are cut with an overlap.
SLAB = 4 << 20
#: Rows of one batch in a task, rows of a task on average, and rows of one core that are still compared in a task.
BATCH, TASK_ROWS, HOT = 1 << 15, 1 << 17, 1 << 14


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours: running minima of blocks from the left and from the right."""
    n = len(values)
    rows = -(-n // width)
    grid = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    grid[:n] = values
    grid = grid.reshape(rows, width)
    left = np.minimum.accumulate(grid, 1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def anchors(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts back to back: text, anchor, first and last window of every run of windows with one anchor, and the gram.

    A window or gram that crosses into the next text doesn't count.
    """
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    if len(raw) < LENGTH:
        return none
    grams = Hasher(raw).grams(GRAM)
    place = np.uint64((1 << 24) - 1)
    least = _sliding_min((grams & ~place) | np.arange(len(grams), dtype=np.uint64), LENGTH - GRAM + 1)
    inside = np.zeros(len(least), bool)
    owner = np.zeros(len(least), np.int64)
    for t in np.flatnonzero(np.diff(bounds) >= LENGTH):
        span = slice(bounds[t], bounds[t + 1] - LENGTH + 1)
        inside[span], owner[span] = True, t
    windows = np.flatnonzero(inside)
    if not len(windows):
        return none
    at = (least[windows] & place).astype(np.int64)
    new = np.flatnonzero(np.diff(at, prepend=-1) | np.diff(owner[windows], prepend=-1))
    last = np.append(new[1:], len(windows)) - 1
    return owner[windows[new]], at[new], windows[new], windows[last], grams[at[new]]


def _slabs(piece: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, bounds, the row of each text, and the text's offset, with a long text cut so that no window is lost."""
    raw, bounds = packed(piece.column("text"))
    if len(raw) <= SLAB:
        yield raw, bounds, np.arange(len(bounds) - 1), np.zeros(len(bounds) - 1, np.int64)
        return
    for row in range(len(bounds) - 1):
        for start in range(bounds[row], bounds[row + 1], SLAB):
            part = raw[start : min(start + SLAB + LENGTH - 1, bounds[row + 1])]
            yield part, np.array([0, len(part)]), np.array([row]), np.array([start - bounds[row]])


def anchor_grams(texts: DataFrame) -> DataFrame:
    """gram, text, doc_id, and whether the gram is the anchor of two places in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                rows, grams = [], []
                for raw, bounds, row, _ in _slabs(piece):
                    text, _, _, _, gram = anchors(raw, bounds)
                    rows.append(row[text])
                    grams.append(gram)
                row, gram = np.concatenate(rows), np.concatenate(grams)
                _, first, n = np.unique(row_key(row, gram), return_index=True, return_counts=True)
                take = pa.array(row[first])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram[first].view(np.int64)), piece.column("tid").take(take), piece.column("doc_id").take(take),
                     pa.array(n > 1)], names=["gram", "tid", "doc_id", "twice"])

    return texts.mapInArrow(run, f"gram long, tid long, doc_id {_type(texts, 'doc_id')}, twice boolean")


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


BLOCK_ROWS = "core long, core2 long, tid long, at long, low byte, high byte, sides binary, whole boolean"


def block_rows(candidates: DataFrame) -> DataFrame:
    """A row per block around the anchors listed in ``grams``; ``at`` is the core's place in its text.

    Of blocks of one piece that are equal in all bytes, one is kept in full; it and the others are marked
    ``whole``: all their windows repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                lists = piece.column("grams")
                wanted_row = np.repeat(np.arange(piece.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                wanted = row_key(wanted_row, lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64))
                for raw, bounds, row, offset in _slabs(piece):
                    made = _blocks(raw, bounds, row, wanted)
                    if made is None:
                        continue
                    text, at, low, high, core, core2, sides, whole, first = made
                    empty = pa.array([None if w and not f else s for w, f, s in zip(
                        whole.tolist(), first.tolist(), map(bytes, sides))], pa.binary())
                    take = pa.array(row[text])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(core.view(np.int64)), pa.array(core2.view(np.int64)), piece.column("tid").take(take),
                         pa.array(at - bounds[text] + offset[text]), pa.array(low.astype(np.int8)),
                         pa.array(high.astype(np.int8)), empty, pa.array(whole), piece.column("doc_id").take(take)],
                        names=["core", "core2", "tid", "at", "low", "high", "sides", "whole", "doc_id"])

    return candidates.mapInArrow(run, f"{BLOCK_ROWS}, doc_id {_type(candidates, 'doc_id')}")


def _blocks(raw: np.ndarray, bounds: np.ndarray, row: np.ndarray, wanted: np.ndarray):
    text, anchor, first, last, gram = anchors(raw, bounds)
    use = np.isin(row_key(row[text], gram), wanted)
    if not use.any():
        return None
    text, anchor, first, last = text[use], anchor[use], first[use], last[use]
    b0, b1 = (anchor - last) // BLOCK, (anchor - first) // BLOCK
    each = np.repeat(np.arange(len(anchor)), b1 - b0 + 1)
    block = np.arange(len(each)) - np.repeat(np.cumsum(b1 - b0 + 1) - (b1 - b0 + 1), b1 - b0 + 1) + b0[each]
    core_at = anchor[each] - BLOCK * block
    low = np.maximum(anchor[each] - last[each] - BLOCK * block, 0)
    high = np.minimum(anchor[each] - first[each] - BLOCK * block, SIDE)
    padded = np.concatenate([np.zeros(SIDE, np.uint8), raw, np.zeros(SIDE, np.uint8)])
    reach = np.arange(SIDE)
    sides = np.concatenate([padded[core_at[:, None] + reach], padded[core_at[:, None] + SIDE + CORE + reach]], 1)
    h, h2 = Hasher(raw), Hasher(raw, 1)
    core, core2 = h.between(core_at, core_at + CORE), h2.between(core_at, core_at + CORE)
    # Equal in every byte that any of their windows has: the extent from the highest window to the end of the lowest.
    extent = h2.between(core_at - high, core_at + CORE + SIDE - low)
    same = row_key(core, core2, extent, low, high)
    _, back, n = np.unique(same, return_inverse=True, return_counts=True)
    whole = n[back] > 1
    first_of = np.zeros(len(each), bool)
    first_of[np.unique(back, return_index=True)[1]] = True
    return text[each], core_at, low, high, core, core2, sides, whole, first_of


class Rows:
    """Rows of a batch or level in the order of their suffix array."""

    def __init__(self, core: np.ndarray, sides: np.ndarray, low: np.ndarray, high: np.ndarray, number: np.ndarray):
        self.core, self.sides, self.low, self.high, self.number = core, sides, low, high, number

    def __len__(self) -> int:
        return len(self.core)

    def take(self, which: np.ndarray) -> Rows:
        return Rows(self.core[which], self.sides[which], self.low[which], self.high[which], self.number[which])

    @staticmethod
    def merged(a: Rows, b: Rows) -> Rows:
        both = Rows(*(np.concatenate([x, y]) for x, y in (
            (a.core, b.core), (a.sides, b.sides), (a.low, b.low), (a.high, b.high), (a.number, b.number))))
        return both.take(_order(both.core, both.sides[:, SIDE:]))


def _order(core: np.ndarray, side: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(side), 32), np.uint8)
    wide[:, :SIDE] = side
    keys = wide.view(">u8").astype(np.uint64)
    return np.lexsort((*(keys[:, k] for k in (3, 2, 1, 0)), core))


def _shared(core: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Bytes that each row's side has in common with the row before; -1 under another core."""
    if len(core) < 2:
        return np.full(len(core), -1)
    differs = side[1:] != side[:-1]
    common = np.where(differs.any(1), differs.argmax(1), SIDE)
    return np.concatenate([[-1], np.where(core[1:] == core[:-1], common, -1)])


def scan(rows: Rows, flags: np.ndarray) -> None:
    """Mark in ``flags``, a bit per window, the windows that two of the rows (in suffix order) have."""
    n = len(rows)
    if n < 2:
        return
    right = _shared(rows.core, rows.sides[:, SIDE:])
    mirrored = rows.sides[:, SIDE - 1 :: -1]
    order = _order(rows.core, mirrored)
    left = _shared(rows.core[order], mirrored[order])
    left_class = np.empty(n, np.int64)
    for i in range(BLOCK):
        use = np.flatnonzero((rows.low <= i) & (i <= rows.high))
        if len(use) < 2:
            continue
        left_class[order] = np.cumsum(left < i)
        both = (np.cumsum(right < SIDE - i) * np.int64(n + 1) + left_class)[use]
        by = np.argsort(both, kind="stable")
        same = both[by[1:]] == both[by[:-1]]
        hit = np.unique(np.concatenate([by[1:][same], by[:-1][same]]))
        flags[rows.number[use[hit]]] |= np.uint32(1 << i)


class Family:
    """Levels of rows, each at least as large as all that came after it."""

    def __init__(self) -> None:
        self.levels: list[Rows] = []

    def add(self, batch: Rows, flags: np.ndarray) -> None:
        batch = batch.take(_order(batch.core, batch.sides[:, SIDE:]))
        scan(_of_repeated_cores(batch), flags)
        for level in self.levels:
            old, new = np.isin(level.core, batch.core), np.isin(batch.core, level.core)
            if old.any():
                scan(Rows.merged(level.take(old), batch.take(new)), flags)
        while self.levels and len(self.levels[-1]) <= len(batch):
            batch = Rows.merged(self.levels.pop(), batch)
        self.levels.append(batch)


def _of_repeated_cores(rows: Rows) -> Rows:
    same = rows.core[1:] == rows.core[:-1]
    return rows.take(np.append(same, False) | np.append(False, same)) if len(rows) else rows


def _core_ids(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers for the pairs of hashes of one task."""
    _, back = np.unique(row_key(a.view(np.uint64), b.view(np.uint64)), return_inverse=True)
    return back.astype(np.int64)


def repeats_in_tasks(blocks: DataFrame, tasks: int) -> DataFrame:
    """Rows of one core meet in a task, which walks a family over its batches; gives tid, doc_id, start, end."""
    kind = _type(blocks, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        column = lambda name: table.column(name).to_numpy()
        core, low, high = _core_ids(column("core"), column("core2")), column("low"), column("high")
        _, data = packed_binary(table.column("sides"))
        sides = data.reshape(-1, 2 * SIDE)
        flags, family = np.zeros(len(core), np.uint32), Family()
        for start in range(0, len(core), BATCH):
            part = np.arange(start, min(start + BATCH, len(core)))
            family.add(Rows(core[part], sides[part], low[part], high[part], part), flags)
        full = column("whole")
        flags[full] |= _between(low[full], high[full])
        row, start, end = runs_of(flags)
        at = column("at")[row]
        take = pa.array(row)
        yield from pa.table(
            [table.column("tid").take(take), table.column("doc_id").take(take), pa.array(at - end), pa.array(at - start + LENGTH)],
            names=["tid", "doc_id", "start", "end"]).to_batches()

    return blocks.repartition(tasks, "core", "core2").mapInArrow(run, f"tid long, doc_id {kind}, start long, end long")


def packed_binary(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    array = column.cast(pa.large_binary()).combine_chunks()
    array = array.chunk(0) if isinstance(array, pa.ChunkedArray) else array
    bounds = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    return bounds, np.frombuffer(array.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]


def _between(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    up = (np.uint64(2) << high.astype(np.uint64)) - np.uint64(1)
    return (up & ~((np.uint64(1) << low.astype(np.uint64)) - np.uint64(1))).astype(np.uint32)


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last bit of every run of set bits."""
    rows = np.flatnonzero(flags)
    bits = (flags[rows, None] >> np.arange(BLOCK, dtype=np.uint32)) & np.uint32(1)
    edge = np.diff(np.pad(bits.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, start = np.nonzero(edge == 1)
    _, stop = np.nonzero(edge == -1)
    return rows[row], start, stop - 1


def repeats_of_hot_cores(blocks: DataFrame) -> DataFrame:
    """The same for cores of very many rows: a row per window, counted with partial sums."""
    windows = (
        blocks.withColumn("i", F.explode(F.sequence(F.col("low").cast("int"), F.col("high").cast("int"))))
        .withColumn("bytes", F.expr(f"substring(sides, {SIDE + 1} - i, {SIDE})"))
        .withColumn("n", F.when(F.col("whole"), 2).otherwise(1))
        .select("core", "core2", "i", "bytes", "n", "tid", "doc_id", "at")
    )
    key = ["core", "core2", "i", "bytes"]
    twice = windows.groupBy(*key).agg(F.sum("n").alias("all")).where("all > 1").drop("all")
    found = windows.join(twice, key, "left_semi")
    start = F.col("at") - F.col("i")
    return found.select("tid", "doc_id", start.alias("start"), (start + LENGTH).alias("end"))


def cut_spans(candidates: DataFrame, spans: DataFrame) -> DataFrame:
    """tid, doc_id, n_removed, n_spans, kept_sha256 and the kept bytes' spans, of the texts that lose bytes."""
    lists = spans.groupBy("tid", "doc_id").agg(
        F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")
    )
    right = lists.select(F.col("tid").alias("t"), F.col("doc_id").alias("d"), "starts", "ends")
    both = candidates.select("tid", "doc_id", "text").join(
        right, (F.col("tid") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d"))
    ).select("tid", "doc_id", "text", "starts", "ends")
    kind = _type(candidates, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans_, kept, cuts = [], [], [], []
            for text, starts, ends in zip(*(batch.column(c) for c in ("text", "starts", "ends"))):
                raw = text.as_py().encode()
                joined = join_spans(np.array(starts.values), np.array(ends.values))
                at, left = 0, hashlib.sha256()
                for a, b in joined:
                    left.update(raw[at:a])
                    at = b
                left.update(raw[at:])
                removed.append(sum(b - a for a, b in joined))
                spans_.append(len(joined))
                kept.append(left.hexdigest())
                cuts.append([x for span in joined for x in span])
            yield pa.RecordBatch.from_arrays(
                [batch.column("tid"), batch.column("doc_id"), pa.array(removed, pa.int64()), pa.array(spans_, pa.int64()),
                 pa.array(kept, pa.string()), pa.array(cuts, pa.list_(pa.int64()))],
                names=["tid", "doc_id", "n_removed", "n_spans", "kept_sha256", "cuts"])

    return both.mapInArrow(
        run, f"tid long, doc_id {kind}, n_removed long, n_spans long, kept_sha256 string, cuts array<bigint>")


def join_spans(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Spans that overlap or touch, as one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.append(True, starts[1:] > ends[:-1]))
    return list(zip(starts[new].tolist(), ends[np.append(new[1:], len(starts)) - 1].tolist()))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, cuts (start and end of every removed run, in bytes)."""
    digest = F.md5(F.col("text").cast("binary"))
    tid = F.conv(F.substring("digest", 1, 15), 16, 10).cast("long")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", digest).withColumn("tid", tid)
    ids = settle(
        texts.select("doc_id", "tid", "digest", F.length(F.col("text").cast("binary")).cast("long").alias("n_bytes"),
                     F.sha2(F.col("text").cast("binary"), 256).alias("own_sha")), "repeat-texts")
    long_ = ids.where(F.col("n_bytes") >= LENGTH)
    groups = settle(
        long_.groupBy("digest").agg(F.count("*").alias("copies"), F.min("doc_id").alias("keeper")).where("copies > 1"),
        "repeat-groups")

    # 1. Anchors whose gram is in two texts, or twice in one; by text, for one text of each group.
    found = settle(anchor_grams(texts.select("doc_id", "tid", "text")), "repeat-anchors")
    repeated = (
        found.groupBy("gram").agg(F.min("tid").alias("a"), F.max("tid").alias("b"), F.max("twice").alias("twice"))
        .where("a < b or twice").select("gram")
    )
    spare = (
        long_.join(groups, "digest").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .select(F.col("tid").alias("t"), F.col("doc_id").alias("d")).distinct()
    )
    same_row = (F.col("tid") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d"))
    lists = (
        found.join(repeated, "gram").groupBy("tid", "doc_id").agg(F.collect_set("gram").alias("grams"))
        .join(spare, same_row, "left_anti")
        .select(F.col("tid").alias("t"), F.col("doc_id").alias("d"), "grams")
    )
    candidates = settle(
        texts.where(F.length("text") * 4 >= LENGTH).join(lists, same_row).select("tid", "doc_id", "text", "grams"),
        "repeat-candidates")

    # 2 to 4. Blocks, compared in tasks; those of hot cores window by window.
    blocks = settle(block_rows(candidates), "repeat-blocks")
    full, rest = blocks.where("sides is not null"), blocks.where("sides is null")
    tasks = max(1, -(-full.count() // TASK_ROWS))
    tasks = max(tasks, min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), tasks * 8))
    hot = settle(full.groupBy("core", "core2").count().where(F.col("count") > HOT).drop("count"), "repeat-hot")
    spans = repeats_in_tasks(full.join(hot, ["core", "core2"], "left_anti"), tasks)
    spans = spans.unionByName(repeats_of_hot_cores(full.join(hot, ["core", "core2"], "left_semi")))
    spans = spans.unionByName(rest.select(
        "tid", "doc_id", (F.col("at") - F.col("high")).alias("start"),
        (F.col("at") - F.col("low") + LENGTH).alias("end")))
    spans = settle(spans, "repeat-spans")
    part = cut_spans(candidates, spans).select(
        F.col("tid").alias("t"), F.col("doc_id").alias("d"), "n_removed", "n_spans", "kept_sha256", "cuts").dropDuplicates(["t", "d"])
    all_gone = F.col("copies").isNotNull() & (F.col("n_bytes") >= LENGTH)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    zero = F.lit(0).cast("long")
    return (
        ids.join(groups.drop("keeper"), "digest", "left")
        .join(settle(part, "repeat-parts"), same_row, "left")
        .select(
            "doc_id", "n_bytes",
            F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
            F.when(all_gone, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
            F.when(all_gone, nothing).otherwise(F.coalesce("kept_sha256", "own_sha")).alias("kept_sha256"),
            F.when(all_gone, F.array(zero, "n_bytes")).otherwise(
                F.coalesce("cuts", F.array().cast("array<bigint>"))).alias("cuts"),
        )
    )
