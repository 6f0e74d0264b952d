"""Boosted trees on all rows of a table that one task should not hold.

Rows are dealt to blocks; a block is one row of a written table, with the bins and labels of its records and their
log-odds by every draw.  All draws grow together, a job for each level of a tree: tasks add up the derivatives of their
blocks per node and bin, the sums of a node meet in one task, which finds its best split, and only splits reach the
driver.  A job for each tree writes the blocks anew with its values, into one of two folders in turn, and a job takes the
exact average precision of all validation rows, by ranges of the score if they are many.  So a task holds a few blocks,
the sums of a node or a range of scores, however many rows there are.

Trees and stopping are those of ``boosting``; only the rows of a tree's share are drawn per block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselens.operators import trees
from caselens.operators.boosting import BINS, NODES, Tree, best_splits, binned, leaf_value, node_rows
from caselens.operators.prefix import running_totals
from caselens.storage import settle, shared_path

#: Validation scores of a draw that are ranked by one task, and cells of the count by which ranges of scores are cut.
RANKED, CELLS = 1 << 20, 1024

#: Bins are a line per column, log-odds a line per draw; ``held`` is validation.
BLOCKS = "block long, bins binary, label binary, held_bins binary, held_label binary, margin binary, seen binary"
_SUMS = "draw int, node int, block long, sums binary"
_SPLITS = (
    "draw int, node int, place int, cut int, slope double, curve double, "
    "left_slope double, left_curve double, right_slope double, right_curve double")
_COUNTS = "draw int, block long, n binary, hits binary"
_POINTS = "draw int, part int, block long, score binary, n binary, hits binary"


def bin_edges(rows: DataFrame, bins: int = BINS) -> list[np.ndarray]:
    """``boosting.bin_edges`` of the array column ``features``, by counts of its values on all tasks."""
    pairs = rows.select(F.posexplode("features").alias("feature", "value"))
    points = settle(pairs.groupBy("feature", "value").agg(F.count("*").alias("n")), "values")
    totals = points.groupBy("feature").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).orderBy("feature").collect()
    of = lambda name: F.element_at(F.array(*[F.lit(r[name]) for r in totals]), F.col("feature") + 1)

    def quantiles_below(count):
        """How many of the places i (n - 1) / bins, i from 1, lie in the first ``count`` rows."""
        return F.greatest(F.least(F.floor((count * bins - 1) / F.greatest(of("n") - 1, F.lit(1))), F.lit(bins)), F.lit(0))

    ranked = running_totals(points, ["feature"], "value", ["n"], None)
    before = F.col("before_n")
    kept = ranked.where((of("kinds") <= bins) | (quantiles_below(before + F.col("n")) > quantiles_below(before)))
    ends = kept.select("feature", "value").orderBy("feature", "value").toPandas()
    return [ends["value"][ends["feature"] == r["feature"]].to_numpy(float)[:-1] for r in totals]


def _lines(cell: pa.Scalar, kind: type, lines: int) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), kind).reshape(lines, -1)


def blocks(rows: DataFrame, n: int, most: int, edges: list[np.ndarray], draws: int, base: float) -> DataFrame:
    """Blocks of about ``most`` of the ``n`` rows (_key, _is_val, breach, features), the same ones for the same rows."""
    parts = -(-n // most)
    dealt = rows.select("_is_val", "breach", "features", F.xxhash64("_key", "breach", "features").alias("_place")).repartition(parts, "_place")
    ordered = dealt.sortWithinPartitions("_place", "_is_val", "breach", "features").withColumn("_part", F.spark_partition_id())

    def packed(part: int, number: int, taken: list[tuple]) -> pa.RecordBatch:
        bins, label, held = (np.concatenate(x) for x in zip(*taken))
        cells = [np.ascontiguousarray(x).tobytes() for side in (~held, held) for x in (bins[side].T, label[side])]
        cells += [np.full(draws * np.count_nonzero(side), base).tobytes() for side in (~held, held)]
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 32) + number], pa.int64()), *[pa.array([c], pa.binary()) for c in cells]],
            names=["block", "bins", "label", "held_bins", "held_label", "margin", "seen"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, taken, size = 0, 0, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("_part")[0].as_py()
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            taken.append((
                binned(x, edges), batch.column("breach").to_numpy(zero_copy_only=False).astype(np.uint8),
                batch.column("_is_val").to_numpy(zero_copy_only=False).astype(bool)))
            size += batch.num_rows
            # Only rows that come very often make a part as large as this.
            if size >= 2 * most:
                yield packed(part, number, taken)
                number, taken, size = number + 1, [], 0
        if taken:
            yield packed(part, number, taken)

    return ordered.mapInArrow(pack, BLOCKS)


def _table(tree: Tree, value: np.ndarray) -> trees.Tabled | dict:
    """The tree over bins as tables, with a value for each node."""
    arrays = {c: np.array(getattr(tree, c), np.int64) for c in ("left", "right", "feature")}
    ends = {c: np.arange(BINS) for c in set(tree.feature) - {-1}}
    return trees.tabled({**arrays, "threshold": np.array(tree.bin), "value": value}, ends)


def _level_splits(
    table: DataFrame, held: Sequence[int], grown: dict[int, Tree], level: dict[int, list[int]], columns: dict[int, np.ndarray],
    draws: Sequence[dict[str, float]], n_columns: int, seeds: list[int],
) -> list:
    """The best split, if any, of every node of a level, as rows."""
    places = {}
    for draw, nodes in level.items():
        # Rows that are at no node of the level go past the last one.
        place = np.full(len(grown[draw].value), len(nodes))
        place[nodes] = np.arange(len(nodes))
        places[draw] = _table(grown[draw], place)
    shares = {draw: draws[draw]["subsamplingRate"] for draw in level}
    least = {draw: draws[draw]["minChildWeight"] for draw in level}

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.column("block")[i].as_py()
                bins = _lines(batch.column("bins")[i], np.uint8, n_columns)
                label = _lines(batch.column("label")[i], np.uint8, 1)[0]
                margin = _lines(batch.column("margin")[i], float, len(held))
                lot = np.random.default_rng([*seeds, block]).random(len(label))
                for draw, nodes in level.items():
                    used = np.flatnonzero(lot < shares[draw])
                    part = bins[:, used]
                    risk = 1 / (1 + np.exp(-margin[held.index(draw), used]))
                    weights = risk - label[used], risk * (1 - risk)
                    at = trees.value_of(part, places[draw]) * BINS
                    size = len(nodes) * BINS
                    sums = np.empty((len(nodes), 2, len(columns[draw]), BINS))
                    for j, column in enumerate(columns[draw]):
                        cell = at + part[column]
                        for k, weight in enumerate(weights):
                            sums[:, k, j] = np.bincount(cell, weight, size + BINS)[:size].reshape(-1, BINS)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([draw] * len(nodes), pa.int32()), pa.array(nodes, pa.int32()),
                         pa.array([block] * len(nodes), pa.int64()), pa.array([s.tobytes() for s in sums], pa.binary())],
                        names=["draw", "node", "block", "sums"])

    def best(parts: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(s) for s in parts.sort_values("block")["sums"]).reshape(2, 1, -1, BINS)
        draw, node = (int(parts[c].iloc[0]) for c in ("draw", "node"))
        split, place, cut, lower, upper = best_splits(total, least[draw])
        whole = [x[0, 0].sum() for x in total]
        sides = [x[0, place[0], cut[0]] for x in (*lower, *upper)]
        return pd.DataFrame([(draw, node, place[0] if split[0] else -1, cut[0], *whole, *sides)], columns=names)

    names = [c.split()[0] for c in _SPLITS.split(", ")]
    parts = table.select("block", "bins", "label", "margin").mapInArrow(add_up, _SUMS)
    return parts.groupBy("draw", "node").applyInPandas(best, _SPLITS).collect()


def grow_level_by_level(
    table: DataFrame, held: Sequence[int], live: Sequence[int], draws: Sequence[dict[str, float]], n_columns: int, seeds: list[int]
) -> dict[int, Tree]:
    """One more tree of each draw in ``live``; the log-odds of ``table`` are those of the draws ``held``."""
    mixed = np.random.default_rng(seeds).permutation(n_columns)
    columns = {d: np.sort(mixed[: max(1, round(draws[d]["featureShare"] * n_columns))]) for d in live}
    grown, level = {d: Tree() for d in live}, {d: [0] for d in live}
    for tree in grown.values():
        tree.add(0.0)
    depth = 0
    while level:
        found = _level_splits(table, held, grown, level, columns, draws, n_columns, seeds)
        depth, level = depth + 1, {}
        for r in sorted(found, key=lambda r: (r["draw"], r["node"])):
            draw, tree, rate = r["draw"], grown[r["draw"]], draws[r["draw"]]["stepSize"]
            if r["node"] == 0:
                tree.value[0] = leaf_value(r["slope"], r["curve"], rate)
            if r["place"] >= 0:
                sides = [(r[f"{side}_slope"], r[f"{side}_curve"]) for side in ("left", "right")]
                made = tree.split(r["node"], int(columns[draw][r["place"]]), r["cut"], sides, rate)
                if depth < int(draws[draw]["maxDepth"]):
                    level.setdefault(draw, []).extend(made)
    return grown


def with_trees(table: DataFrame, held: Sequence[int], grown: dict[int, Tree], n_columns: int) -> DataFrame:
    """The blocks with the values of the trees added; log-odds are then those of the draws in ``grown``."""
    tables = {draw: _table(tree, np.array(tree.value)) for draw, tree in grown.items()}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                made = {}
                for bins, margin in (("bins", "margin"), ("held_bins", "seen")):
                    codes, before = _lines(row[bins], np.uint8, n_columns), _lines(row[margin], float, len(held))
                    made[margin] = b"".join(
                        (before[held.index(draw)] + trees.value_of(codes, tree)).tobytes() for draw, tree in tables.items())
                kept = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([made[c]], pa.binary()) if c in made else kept.column(c) for c in row], names=list(row))

    return table.mapInArrow(add, BLOCKS)


def ranked_precision(score: np.ndarray, n: np.ndarray, hits: np.ndarray, n_above: int = 0, hits_above: int = 0) -> float:
    """The part of hits times average precision that comes from counted scores, below ``n_above`` rows of higher ones."""
    order = np.argsort(-score, kind="stable")
    last = np.flatnonzero(np.append(np.diff(score[order]) != 0, True))
    rows, found = (np.cumsum(x[order])[last] for x in (n, hits))
    return float(np.sum(np.diff(found, prepend=0) * (hits_above + found) / (n_above + rows)))


def average_precisions(
    table: DataFrame, held: Sequence[int], bounds: dict[int, tuple[float, float]], n: int, ranked: int = RANKED
) -> dict[int, float]:
    """Of all validation rows, by each draw; equal scores enter together.

    ``bounds``: what a draw's scores lie between.  Above ``ranked`` rows, cells of equal width are counted first and
    neighbouring ones make a range of about so many rows.
    """
    rows = table.select("block", "held_label", "seen")

    def scores(batch: pa.RecordBatch) -> Iterator[tuple]:
        for i in range(batch.num_rows):
            label = _lines(batch.column("held_label")[i], np.uint8, 1)[0].astype(np.int64)
            if len(label):
                for draw, score in zip(held, _lines(batch.column("seen")[i], float, len(held))):
                    low, high = bounds[draw]
                    cell = (score - low) * (CELLS / (high - low)) if high > low else np.zeros(len(score))
                    yield batch.column("block")[i].as_py(), draw, np.clip(cell, 0, CELLS - 1).astype(np.int64), score, label

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, draw, cell, _, label in scores(batch):
                counts = [np.bincount(x, minlength=CELLS).astype(np.int64).tobytes() for x in (cell, cell[label > 0])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([draw], pa.int32()), pa.array([block], pa.int64()), *[pa.array([c], pa.binary()) for c in counts]],
                    names=["draw", "block", "n", "hits"])

    def total(parts: pd.DataFrame) -> pd.DataFrame:
        sums = [sum(np.frombuffer(x, np.int64) for x in parts[c]).tobytes() for c in ("n", "hits")]
        return pd.DataFrame({"draw": parts["draw"].iloc[:1], "block": 0, "n": sums[:1], "hits": sums[1:]})

    # Per draw: the range of each cell, and the rows and hits above each range.
    part, above = {d: np.zeros(CELLS, np.int64) for d in held}, {d: [(0, 0)] for d in held}
    if n > ranked:
        for r in rows.mapInArrow(count, _COUNTS).groupBy("draw").applyInPandas(total, _COUNTS).collect():
            counts, found = (np.frombuffer(r[c], np.int64) for c in ("n", "hits"))
            since = 0
            for cell in range(CELLS - 1, -1, -1):
                if since and since + counts[cell] > ranked:
                    above[r["draw"]].append((int(counts[cell + 1 :].sum()), int(found[cell + 1 :].sum())))
                    since = 0
                since += counts[cell]
                part[r["draw"]][cell] = len(above[r["draw"]]) - 1

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, draw, cell, score, label in scores(batch):
                known, at = np.unique(score, return_inverse=True)
                counts, hits = np.bincount(at), np.bincount(at[label > 0], minlength=len(known))
                where = np.zeros(len(known), np.int64)
                where[at] = part[draw][cell]
                for number in np.unique(where):
                    here = where == number
                    cells = [x[here].tobytes() for x in (known, counts, hits)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([draw], pa.int32()), pa.array([number], pa.int32()), pa.array([block], pa.int64()),
                         *[pa.array([c], pa.binary()) for c in cells]],
                        names=["draw", "part", "block", "score", "n", "hits"])

    def rank(parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("block")
        score, counts, hits = (
            np.concatenate([np.frombuffer(x, kind) for x in parts[c]]) for c, kind in (("score", float), ("n", np.int64), ("hits", np.int64)))
        draw, number = (int(parts[c].iloc[0]) for c in ("draw", "part"))
        worth = ranked_precision(score, counts, hits, *above[draw][number])
        return pd.DataFrame({"draw": [draw], "part": [number], "worth": [worth], "hits": [int(hits.sum())]})

    found = rows.mapInArrow(points, _POINTS).groupBy("draw", "part").applyInPandas(rank, "draw int, part int, worth double, hits long")
    worth, hits = dict.fromkeys(held, 0.0), dict.fromkeys(held, 0)
    for r in sorted(found.collect(), key=lambda r: (r["draw"], r["part"])):
        worth[r["draw"]] += r["worth"]
        hits[r["draw"]] += r["hits"]
    return {d: worth[d] / max(hits[d], 1) for d in held}


def grow_draws(
    rows: DataFrame, n: int, n_held: int, most: int, edges: list[np.ndarray], draws: Sequence[dict[str, float]], base: float,
    rounds: int, patience: int, seed: int, ranked: int = RANKED,
) -> DataFrame:
    """The nodes of the kept trees of every draw, grown on all ``n`` rows, of which ``n_held`` are validation."""
    spark, n_columns = rows.sparkSession, len(edges)
    held = live = list(range(len(draws)))
    table = settle(blocks(rows, n, most, edges, len(draws), base), "blocks")
    folders = [shared_path(spark, f"grown-{i}") for i in range(2)]
    grown: list[list[Tree]] = [[] for _ in draws]
    scores: list[list[float]] = [[] for _ in draws]
    bounds = dict.fromkeys(live, (base, base))
    for turn in range(rounds):
        made = grow_level_by_level(table, held, live, draws, n_columns, [seed, turn])
        with_trees(table, held, made, n_columns).write.mode("overwrite").parquet(folders[turn % 2])
        table, held = spark.read.schema(table.schema).parquet(folders[turn % 2]), live
        for draw, tree in made.items():
            grown[draw].append(tree)
            bounds[draw] = (bounds[draw][0] + min(tree.value), bounds[draw][1] + max(tree.value))
        for draw, score in average_precisions(table, held, bounds, n_held, ranked).items():
            scores[draw].append(score)
        live = [d for d in held if len(scores[d]) - 1 - int(np.argmax(scores[d])) < patience]
        if not live:
            break
    kept = [part for d, trees_of in enumerate(grown) for part in node_rows(d, trees_of[: int(np.argmax(scores[d])) + 1], edges)]
    return spark.createDataFrame(pd.concat(kept, ignore_index=True), NODES)
