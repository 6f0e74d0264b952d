"""Per-feature path contributions of a boosted-tree model.

Each split moves the prediction from its node's mean to the child's mean; the
change is credited to the split feature.  The credits of a row add up to its
log-odds minus a constant.  They are additive, like Shapley values, but are not
Shapley values.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselens import fixed


def node_table(nodes: DataFrame | pd.DataFrame) -> list[dict]:
    """The trees as arrays on the driver: bounded by trees x 2^(depth + 1) whatever the data."""
    table = (nodes if isinstance(nodes, pd.DataFrame) else nodes.toPandas()).sort_values(["tree", "node"])
    return [
        {
            "left": part["left"].to_numpy(np.int64),
            "right": part["right"].to_numpy(np.int64),
            "feature": part["feature"].to_numpy(np.int64),
            "threshold": part["threshold"].to_numpy(float),
            "value": part["value"].to_numpy(float),
        }
        for _, part in table.groupby("tree")
    ]


def _leaves(x: np.ndarray, tree: dict) -> np.ndarray:
    at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    while True:
        inner = tree["left"][at] >= 0
        if not inner.any():
            return at
        r, node = rows[inner], at[inner]
        at[inner] = np.where(x[r, tree["feature"][node]] <= tree["threshold"][node], tree["left"][node], tree["right"][node])


#: Leaves that fit the bits of a word, and rows that are taken through all trees at once.
WORD, BLOCK = 64, 4096


@dataclass(frozen=True)
class Tabled:
    """A tree as tables: per split column the leaves left by each code of it, as bits from left to right; the leaves' values.

    ``credits`` holds the leaves' contributions: the first step of a path at each column, then the second ones, and so on,
    so that they add up in the order of the path.
    """

    columns: list[int]
    masks: list[np.ndarray]
    values: np.ndarray
    credits: list[np.ndarray]


def thresholds(trees: Sequence[dict]) -> dict[int, np.ndarray]:
    """The distinct thresholds of each split column: a value's code is how many of them are below it."""
    column, end = (np.concatenate([t[c][t["left"] >= 0] for t in trees] or [np.zeros(0)]) for c in ("feature", "threshold"))
    return {int(c): np.unique(end[column == c]) for c in np.unique(column)}


def tabled(tree: dict, ends: dict[int, np.ndarray], width: int = 0) -> Tabled | dict:
    """The tree as tables, with credits if ``width`` columns are given; as it is, if its leaves don't fit a word."""
    if np.count_nonzero(tree["left"] < 0) > WORD:
        return tree
    paths, masks = [], {}

    def visit(node: int, path: list[tuple[int, float]]) -> None:
        if tree["left"][node] < 0:
            paths.append((node, path))
            return
        column, first = int(tree["feature"][node]), len(paths)
        for side in ("left", "right"):
            child = int(tree[side][node])
            visit(child, [*path, (column, tree["value"][child] - tree["value"][node])])
            if side == "left":
                # Rows above the threshold can't end on this side.
                mask = masks.setdefault(column, np.full(len(ends[column]) + 1, ~np.uint64(0)))
                gone = ((1 << len(paths)) - 1) ^ ((1 << first) - 1)
                mask[int(np.searchsorted(ends[column], tree["threshold"][node])) + 1 :] &= ~np.uint64(gone)

    visit(0, [])
    credits: list[np.ndarray] = []
    for leaf, (_, path) in enumerate(paths if width else []):
        seen: dict[int, int] = {}
        for column, step in path:
            turn = seen[column] = seen.get(column, -1) + 1
            if turn == len(credits):
                credits.append(np.zeros((len(paths), width)))
            credits[turn][leaf, column] = step
    return Tabled(list(masks), list(masks.values()), tree["value"][[node for node, _ in paths]], credits)


def _coded(x: np.ndarray, ends: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    return {c: np.searchsorted(e, x[:, c], side="left") for c, e in ends.items()}


def _reached(codes: dict[int, np.ndarray], tree: Tabled, rows: int) -> np.ndarray:
    """The leaf of each row, counted from the left: the first that no column rules out."""
    left = np.full(rows, ~np.uint64(0))
    for column, mask in zip(tree.columns, tree.masks):
        left &= mask.take(codes[column], mode="clip")
    return np.bitwise_count((left & (~left + np.uint64(1))) - np.uint64(1))


def value_of(codes: np.ndarray, tree: Tabled | dict) -> np.ndarray:
    """The value of the leaf of each row, from a line of codes for each column."""
    if isinstance(tree, Tabled):
        return tree.values.take(_reached(codes, tree, codes.shape[1]))
    return tree["value"][_leaves(codes.T, tree)]


def risk_of(x: np.ndarray, trees: Sequence[Tabled | dict], ends: dict[int, np.ndarray], base: float) -> np.ndarray:
    margin = np.full(len(x), base)
    for start in range(0, len(x), BLOCK):
        part, out = x[start : start + BLOCK], margin[start : start + BLOCK]
        codes = _coded(part, ends)
        for tree in trees:
            if isinstance(tree, Tabled):
                out += tree.values.take(_reached(codes, tree, len(part)))
            else:
                out += tree["value"][_leaves(part, tree)]
    return 1 / (1 + np.exp(-margin))


def scores(df: DataFrame, nodes: DataFrame, base: float, features: str = "features", out: str = "raw_score") -> DataFrame:
    """Add the score of the trees, from an array of the inputs; the trees are shipped to the tasks."""
    table = node_table(nodes)
    ends = thresholds(table)
    shipped = df.sparkSession.sparkContext.broadcast(([tabled(t, ends) for t in table], ends))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            x = np.vstack(values.to_numpy()) if len(values) else np.zeros((0, 1))
            yield pd.Series(risk_of(x, *shipped.value, base) if len(x) else np.zeros(0))

    return df.withColumn(out, score(features))


def draw_scores(rows: DataFrame, nodes: DataFrame, base: float) -> DataFrame:
    """draw, score, y: the scores of rows (x, y) by every draw, in one pass."""
    tables = {int(d): node_table(part) for d, part in nodes.toPandas().groupby("draw")}
    ends = thresholds([t for table in tables.values() for t in table])
    shipped = rows.sparkSession.sparkContext.broadcast(({d: [tabled(t, ends) for t in table] for d, table in tables.items()}, ends))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            draws, known = shipped.value
            for draw, trees in draws.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), draw, np.int32)), pa.array(risk_of(x, trees, known, base)), batch.column("y")],
                    names=["draw", "score", "y"])

    return rows.mapInArrow(run, "draw int, score double, y double")


def _walk(x: np.ndarray, tree: dict, credit: np.ndarray) -> None:
    at, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
    while True:
        inner = tree["left"][at] >= 0
        if not inner.any():
            return
        r, node = rows[inner], at[inner]
        feature = tree["feature"][node]
        child = np.where(x[r, feature] <= tree["threshold"][node], tree["left"][node], tree["right"][node])
        credit[r, feature] += tree["value"][child] - tree["value"][node]
        at[inner] = child


def credit_of(x: np.ndarray, trees: Sequence[Tabled | dict], ends: dict[int, np.ndarray], n_features: int) -> np.ndarray:
    credit = np.zeros((len(x), n_features))
    for start in range(0, len(x), BLOCK):
        part, out = x[start : start + BLOCK], credit[start : start + BLOCK]
        codes = _coded(part, ends)
        for tree in trees:
            if isinstance(tree, Tabled):
                leaf = _reached(codes, tree, len(part))
                for steps in tree.credits:
                    out += steps.take(leaf, axis=0)
            else:
                _walk(part, tree, out)
    return credit


def path_contributions(
    df: DataFrame, nodes: DataFrame, width: int, features: str = "features", out: str = "contributions"
) -> DataFrame:
    """Add an array of log-odds contributions, one per entry of ``features``; the trees are shipped to the tasks."""
    table = node_table(nodes)
    ends = thresholds(table)
    shipped = df.sparkSession.sparkContext.broadcast(([tabled(t, ends, width) for t in table], ends))

    @F.pandas_udf("array<double>")
    def contributions(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            x = np.vstack(values.to_numpy()) if len(values) else np.zeros((0, width))
            yield pd.Series(list(credit_of(x, *shipped.value, width)))

    return df.withColumn(out, contributions(features))


def top_reasons(
    contributions: str, features: Sequence[str], medians: dict[str, float], k: int = 3
) -> Column:
    """The k strongest risk-increasing contributions with label, value and reference."""
    entries = [
        F.struct(
            (-F.col(contributions)[i]).alias("_order"),
            F.lit(i).alias("_place"),
            F.lit(f).alias("feature"),
            F.lit(fixed.FEATURE_LABELS.get(f, f)).alias("label"),
            F.col(f).cast("string").alias("value"),
            F.lit(medians.get(f)).cast("double").alias("train_median"),
        )
        for i, f in enumerate(features)
    ]
    rising = F.array_sort(F.filter(F.array(*entries), lambda e: e["_order"] < 0))
    return F.transform(
        F.slice(rising, 1, k),
        lambda e: F.struct(
            e["feature"].alias("feature"),
            e["label"].alias("label"),
            e["value"].alias("value"),
            e["train_median"].alias("train_median"),
            F.lit("increases_risk").alias("direction"),
            (-e["_order"]).alias("contribution_log_odds"),
        ),
    )


def importance(
    df: DataFrame, features: Sequence[str], contributions: str = "contributions", k: int | None = None
) -> DataFrame:
    """Mean absolute contribution per feature, largest first; the first ``k`` of them if given."""
    means = df.agg(*[F.avg(F.abs(F.col(contributions)[i])).alias(f) for i, f in enumerate(features)])
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("mean_abs_contribution")) for f in features])
    ranked = means.select(F.inline(pairs)).orderBy(F.desc("mean_abs_contribution"), "feature")
    return ranked if k is None else ranked.limit(k)
