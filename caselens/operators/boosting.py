"""Boosted trees for many draws of parameters at once, one Spark task per draw.

Every draw is fitted on the same rows, so the rows are binned once and shipped, and Spark deals the draws.  This is for
tables that one task can hold; ``boosting_blocks`` grows the same trees on all rows of a larger one.  ``pyspark.ml`` runs
at least one job for every level of every tree of every draw; thousands of short jobs take minutes where the trees take
seconds.

Trees grow on the gradients of the log-loss, level by level, from histograms of bins.  After every tree the average
precision of the validation rows is taken, tied scores together; growing goes on from the trees there are and stops
once ``patience`` trees brought no better one.  A model is the first trees of its draw: cutting it is a filter.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: Bins of a feature, weight that pulls leaves to zero, and least gain of a split.
BINS, SHRINK, LEAST_GAIN = 64, 1.0, 1e-9

NODES = "draw int, tree int, node int, left int, right int, feature int, threshold double, value double"


@dataclass(frozen=True)
class Rows:
    """Binned rows: a byte for each value, and the label."""

    binned: np.ndarray
    label: np.ndarray


def bin_edges(values: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Upper ends of the bins of each column: all its values if they are few, else quantiles."""
    out = []
    for column in values.T:
        known = np.unique(column)
        if len(known) > bins:
            known = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:], method="lower"))
        out.append(known[:-1])
    return out


def binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, values.T)], axis=1).astype(np.uint8)


def average_precision(label: np.ndarray, score: np.ndarray) -> float:
    """Area under precision over recall in steps; equal scores enter together."""
    order = np.argsort(-score, kind="stable")
    last = np.flatnonzero(np.append(np.diff(score[order]) != 0, True))
    hits = np.cumsum(label[order])[last]
    return float(np.sum(np.diff(hits, prepend=0) * hits / (last + 1)) / max(hits[-1], 1)) if len(last) else 0.0


class Tree:
    """One tree over bins: per node its children, feature, last bin of the left side, and value."""

    def __init__(self):
        self.left, self.right, self.feature, self.bin, self.value = [], [], [], [], []

    def add(self, value: float) -> int:
        for column, start in ((self.left, -1), (self.right, -1), (self.feature, -1), (self.bin, 0), (self.value, value)):
            column.append(start)
        return len(self.value) - 1

    def split(self, node: int, column: int, cut: int, sides: Sequence[tuple[float, float]], rate: float) -> list[int]:
        """Split a node; ``sides`` are the sums of the left and the right side.  The new nodes."""
        self.feature[node], self.bin[node] = column, cut
        self.left[node], self.right[node] = made = [self.add(leaf_value(*sums, rate)) for sums in sides]
        return made

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        left, right, feature, cut = (np.array(c) for c in (self.left, self.right, self.feature, self.bin))
        at = np.zeros(len(rows), np.int64)
        while (inner := np.flatnonzero(left[at] >= 0)).size:
            node = at[inner]
            at[inner] = np.where(rows[inner, feature[node]] <= cut[node], left[node], right[node])
        return at


def leaf_value(slope: float, curve: float, rate: float) -> float:
    return -rate * slope / (curve + SHRINK)


def best_splits(total: Sequence[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, list, list]:
    """Whether each node has a split that gains, the place of its column, its cut, and the sums of both sides of all cuts.

    ``total``: the sums of slopes and of curves as (nodes, columns, BINS).
    """
    worth = lambda s, c: s * s / (c + SHRINK)
    lower = [np.cumsum(t, axis=2) for t in total]
    whole = [c[:, :, -1:] for c in lower]
    upper = [w - c for w, c in zip(whole, lower)]
    gain = worth(*lower) + worth(*upper) - worth(*whole)
    gain[(lower[1] < least) | (upper[1] < least)] = 0
    gain = gain.reshape(len(gain), -1)
    best = gain.argmax(axis=1)
    return gain[np.arange(len(gain)), best] > LEAST_GAIN, best // BINS, best % BINS, lower, upper


def grow_tree(rows: np.ndarray, slope: np.ndarray, curve: np.ndarray, columns: np.ndarray, depth: int, rate: float, least: float) -> Tree:
    """A tree of ``depth`` levels from first and second derivatives; sides weigh ``least`` at least.  ``columns`` may be split."""
    tree = Tree()
    width = BINS * len(columns)
    cell = rows[:, columns].astype(np.int64) + BINS * np.arange(len(columns))
    tree.add(leaf_value(slope.sum(), curve.sum(), rate))
    nodes, place = np.array([0]), np.zeros(len(rows), np.int64)
    for _ in range(depth):
        live = np.flatnonzero(place >= 0)
        at = (cell[live] + width * place[live, None]).ravel()
        shape = (len(nodes), len(columns), BINS)
        total = [np.bincount(at, np.repeat(w[live], len(columns)), len(nodes) * width).reshape(shape) for w in (slope, curve)]
        split, column, cut, lower, upper = best_splits(total, least)
        if not split.any():
            break
        child = np.full((len(nodes), 2), -1)
        grown = []
        for i in np.flatnonzero(split):
            sides = [tuple(x[i, column[i], cut[i]] for x in sums) for sums in (lower, upper)]
            child[i] = len(grown), len(grown) + 1
            grown += tree.split(nodes[i], int(columns[column[i]]), int(cut[i]), sides, rate)
        here = place[live]
        right = rows[live, columns[column[here]]] > cut[here]
        place[live] = child[here, right.astype(np.int64)]
        nodes = np.array(grown)
    return tree


def boost(train: Rows, validation: Rows, params: dict[str, float], base: float, rounds: int, patience: int, seed: int) -> tuple[list[Tree], list[float]]:
    """Trees up to the best round, and the average precision after each round grown."""
    draw = np.random.default_rng(seed)
    margin, seen = np.full(len(train.label), base), np.full(len(validation.label), base)
    trees, scores, best = [], [], 0
    n_columns = train.binned.shape[1]
    for _ in range(rounds):
        risk = 1 / (1 + np.exp(-margin))
        used = np.flatnonzero(draw.random(len(margin)) < params["subsamplingRate"])
        columns = np.sort(draw.permutation(n_columns)[: max(1, round(params["featureShare"] * n_columns))])
        tree = grow_tree(
            train.binned[used], (risk - train.label)[used], (risk * (1 - risk))[used], columns,
            int(params["maxDepth"]), params["stepSize"], params["minChildWeight"])
        trees.append(tree)
        value = np.array(tree.value)
        margin += value[tree.leaves(train.binned)]
        seen += value[tree.leaves(validation.binned)]
        scores.append(average_precision(validation.label, seen))
        if scores[-1] > scores[best]:
            best = len(scores) - 1
        elif len(scores) - 1 - best >= patience:
            break
    return trees[: best + 1], scores


def node_rows(draw: int, trees: Sequence[Tree], ends: Sequence[np.ndarray]) -> Iterator[pd.DataFrame]:
    """The nodes of each tree of a draw, with the bins' ends as thresholds."""
    for i, tree in enumerate(trees):
        threshold = [float(ends[f][b]) if f >= 0 else 0.0 for f, b in zip(tree.feature, tree.bin)]
        yield pd.DataFrame({
            "draw": draw, "tree": i, "node": range(len(tree.value)), "left": tree.left, "right": tree.right,
            "feature": tree.feature, "threshold": threshold, "value": tree.value})


def grow_draws(
    spark: SparkSession, train: Rows, validation: Rows, edges: list[np.ndarray], draws: Sequence[dict[str, float]], base: float,
    rounds: int, patience: int, seed: int,
) -> DataFrame:
    """The nodes of the kept trees of every draw; one task fits one draw."""
    shipped = spark.sparkContext.broadcast((train, validation, edges))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, held_back, ends = shipped.value
        for batch in batches:
            for number in batch["id"]:
                trees, _ = boost(rows, held_back, draws[number], base, rounds, patience, seed)
                yield from node_rows(number, trees, ends)

    return spark.range(len(draws), numPartitions=max(1, len(draws))).mapInPandas(run, NODES)
