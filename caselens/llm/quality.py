"""Quality rules: counts per text, fixed limits, and an isolation forest over the counts.

The counts of a text are taken in one pass.  ``base_failed`` holds the fixed limits.  An
isolation forest is grown on a bounded sample of the rows that pass them (``TREES`` x
``PER_TREE``, taken by hash of the row), because a tree of the method only ever sees
``PER_TREE`` rows; every row is scored.  The trees see every statistic in logarithms, each
side of its median by itself, so that what is usual is one point and only the odd side counts.

Besides the forest over all sides, trees are grown over each side alone, and each of these
scores has a threshold of its own: what is odd in a way that good rows aren't is refused,
however odd good rows are in other ways.  A threshold comes from all labelled rows that pass
the limits: the lowest of ``BINS`` steps that refuses at most the score's part of
``MAX_CLEAN_LOST`` of the rows labelled good, or the middle of the empty steps above it.  It
is used only if what it refuses is bad more often than not, by ``SURE`` standard errors.

A null or empty text has zero words and fails the fixed limits.  Rows with equal ids and
texts get equal results.  With no labelled good row the forest refuses nothing.  Columns
other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselens.llm.common import carried, map_texts, sample_by_hash
from caselens.storage import settle

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
REPEAT_WINDOW = 8

TREES, PER_TREE = 100, 256
BINS = 1000
MAX_CLEAN_LOST = 0.001

COUNTS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_capitals long, n_marks long"
)
NAMES = tuple(c.split()[0] for c in COUNTS.split(", "))
#: Standard errors of (bad rows - good rows) above zero that a threshold needs.
SURE = 2.0
#: What the forest looks at: a column of ``statistics`` and the side of its median.
SIDES = ((0, -1), (0, 1), (1, -1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, 1))
_CAPITALS, _MARKS = bytes(range(65, 91)), b"!?"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words inside windows of ``window`` words that the text holds twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashed = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    grams = np.zeros(n, np.uint64)
    for k in range(window):
        grams = grams * _MIX + (hashed[k : k + n] ^ (hashed[k : k + n] >> np.uint64(29)))
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def duplicate_lines(raw: bytes) -> int:
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def _counted(piece: pa.RecordBatch) -> list[tuple[int, ...]]:
    out = []
    for text in piece.column("text").to_pylist():
        text = text or ""
        raw = text.encode()
        words = raw.split()
        chars = len(text) - sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))
        out.append((len(words), chars, sum(map(text.count, SYMBOLS)), duplicate_lines(raw), repeated_words(words),
                    len(raw) - len(raw.translate(None, _CAPITALS)), len(raw) - len(raw.translate(None, _MARKS))))
    return out


def counts(docs: DataFrame) -> DataFrame:
    """The rule counts of every text.  ``bytes.split`` and ``bytes.strip`` know exactly the six ASCII spaces."""

    def rows(piece: pa.RecordBatch) -> list:
        return [pa.array(c, pa.int64()) for c in zip(*_counted(piece))]

    return map_texts(docs, COUNTS, rows)


def base_failed() -> F.Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )


def statistics(c: np.ndarray) -> np.ndarray:
    """Logarithms of the words, their mean length, and the percents of symbols, repeated lines, repeated words,
    capitals and marks; ``c`` has the columns ``NAMES``."""
    words, chars = np.maximum(c[:, 0], 1), np.maximum(c[:, 1], 1)
    shares = np.stack([c[:, 2] / words, c[:, 3] / words, c[:, 4] / words, c[:, 5] / chars, c[:, 6] / words], 1)
    return np.concatenate([np.log(np.stack([words, chars / words], 1)), np.log1p(100 * shares)], 1)


def sided(stats: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.stack([np.maximum(sign * (stats[:, k] - centre[k]), 0) for k, sign in SIDES], 1)


@dataclass(frozen=True)
class Tree:
    feature: np.ndarray  # -1: a leaf
    cut: np.ndarray
    child: np.ndarray  # of the lower side; the upper side is the next
    length: np.ndarray  # of the path that ends at a leaf
    size: int  # rows that it was grown on


def _average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path of a failed search in a tree of n rows; what an undivided leaf still stands for."""
    n = np.asarray(n, float)
    m = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(m - 1) + np.euler_gamma) - 2 * (m - 1) / m, np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    centre: np.ndarray  # medians of the statistics
    trees: list[Tree]  # over all sides
    sides: list[tuple[np.ndarray, np.ndarray]]  # of the trees over each side alone

    def scores(self, counted: np.ndarray) -> np.ndarray:
        """The score over all sides, then the score of each side."""
        x = sided(statistics(counted), self.centre)
        alone = [score[np.searchsorted(starts, x[:, k], "right") - 1] for k, (starts, score) in enumerate(self.sides)]
        return np.stack([forest_scores(self.trees, x), *alone], 1)


def grow(rows: np.ndarray, rng: np.random.Generator) -> Tree:
    limit = int(np.ceil(np.log2(max(len(rows), 2))))
    feature, cut, child, length, todo = [], [], [], [], [(rows, 0)]
    for part, depth in todo:  # grows while it is walked
        low, high = (part.min(0), part.max(0)) if len(part) else (np.zeros(rows.shape[1]),) * 2
        wide = np.flatnonzero(high > low)
        if depth >= limit or not len(wide):
            feature.append(-1), cut.append(0.0), child.append(0), length.append(depth + float(_average_path(len(part))))
            continue
        f = int(rng.choice(wide))
        c = float(rng.uniform(low[f], high[f]))
        feature.append(f), cut.append(c), child.append(len(todo)), length.append(0.0)
        todo += [(part[part[:, f] < c], depth + 1), (part[part[:, f] >= c], depth + 1)]
    return Tree(np.array(feature), np.array(cut), np.array(child), np.array(length), len(rows))


def fit_forest(stats: DataFrame, trees: int = TREES, per_tree: int = PER_TREE, seed: int = 7) -> Forest | None:
    """Random trees over a sample of ``trees * per_tree`` rows, those of the smallest hashes."""
    hashed = stats.select(F.xxhash64(F.lit(seed), "doc_id", *NAMES).alias("h"), *NAMES)
    few = sample_by_hash(hashed, "h", stats.count(), trees * per_tree)
    found = _columns(few.select(*NAMES).toArrow())
    if not len(found):
        return None
    centre = np.median(statistics(found), 0)
    sample = sided(statistics(found), centre)
    rng = np.random.default_rng(seed)
    size = min(per_tree, len(sample))
    grown = lambda rows: [grow(rows[rng.choice(len(rows), size, replace=False)], rng) for _ in range(trees)]
    return Forest(centre, grown(sample), [_flat(grown(sample[:, [k]])) for k in range(len(SIDES))])


def _columns(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    return np.stack([table.column(n).to_numpy(zero_copy_only=False) for n in NAMES], 1).astype(np.int64)


def _flat(trees: list[Tree]) -> tuple[np.ndarray, np.ndarray]:
    """Trees over one column as one step function: where its steps begin, and the score on each."""
    starts = np.unique(np.concatenate([[0.0], *(t.cut[t.feature >= 0] for t in trees)]))
    return starts, forest_scores(trees, starts[:, None])


def forest_scores(trees: list[Tree], rows: np.ndarray) -> np.ndarray:
    """2^(-mean path / usual path): near 1 is an anomaly, below one half is ordinary."""
    if not trees or not len(rows):
        return np.zeros(len(rows))
    total = np.zeros(len(rows))
    each = np.arange(len(rows))
    for t in trees:
        node = np.zeros(len(rows), np.int64)
        while True:
            f = t.feature[node]
            inner = f >= 0
            if not inner.any():
                break
            upper = rows[each, np.maximum(f, 0)] >= t.cut[node]
            node = np.where(inner, t.child[node] + upper, node)
        total += t.length[node]
    return np.exp2(-total / len(trees) / max(float(_average_path(trees[0].size)), 1.0))


def score(stats: DataFrame, forest: Forest | None, limits: np.ndarray) -> DataFrame:
    """``score`` over all sides, ``steps`` of all scores, and ``refused``: a score is at its limit or above."""
    names = stats.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _scored(forest, _columns(batch))
            steps = pa.array(list(np.floor(found * BINS).astype(np.int32)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found[:, 0]), steps, pa.array((found >= limits).any(1))],
                names=[*names, "score", "steps", "refused"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema)
    return stats.mapInArrow(run, f"{fields}, score double, steps array<int>, refused boolean")


def _scored(forest: Forest | None, counted: np.ndarray) -> np.ndarray:
    return forest.scores(counted) if forest else np.zeros((len(counted), 1 + len(SIDES)))


NO_LIMITS = np.full(1 + len(SIDES), np.inf)


def calibrate(stats: DataFrame, forest: Forest | None, labels: DataFrame, most_lost: float = MAX_CLEAN_LOST) -> np.ndarray:
    """The threshold of each score; counts per score and step are all that the driver gets."""
    known = labels.where("quality in (0, 1)").select("doc_id", "quality").distinct()
    # Only what the scores need meets the labels, so no column clashes.
    scored = score(stats.select("doc_id", *NAMES).join(known, "doc_id"), forest, NO_LIMITS)
    steps = (
        scored.select("quality", F.posexplode("steps").alias("of", "step"))
        .groupBy("of", "step")
        .agg(F.sum("quality").alias("good"), F.count("*").alias("n"))
        .collect()
    )
    good, bad = np.zeros((len(NO_LIMITS), BINS + 2)), np.zeros((len(NO_LIMITS), BINS + 2))
    for r in steps:
        good[r["of"], r["step"]], bad[r["of"], r["step"]] = r["good"], r["n"] - r["good"]
    return np.array([_threshold(g, b, most_lost / len(NO_LIMITS)) for g, b in zip(good, bad)])


def _threshold(good: np.ndarray, bad: np.ndarray, most_lost: float) -> float:
    if not good.sum():
        return float("inf")
    good_above, bad_above = good[::-1].cumsum()[::-1], bad[::-1].cumsum()[::-1]
    sure = bad_above - good_above > SURE * np.sqrt(bad_above + good_above)
    fit = np.flatnonzero((good_above <= most_lost * good.sum()) & sure)
    if not len(fit):
        return float("inf")
    # Steps without any row: nothing says on which side they belong.
    free = np.flatnonzero((good_above == good_above[fit[0]]) & (bad_above == bad_above[fit[0]]))
    return (fit[0] + free[-1]) / 2 / BINS


def fitted(stats: DataFrame, labels: DataFrame) -> tuple[Forest | None, np.ndarray]:
    """The forest and the scores from which it refuses, for rows that pass the fixed limits."""
    rest = stats.where(~base_failed())
    forest = fit_forest(rest)
    return forest, calibrate(rest, forest, labels)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, score and verdict of every document."""
    stats = settle(counts(docs), "quality-counts")
    forest, limits = fitted(stats, labels)
    return score(stats, forest, limits).withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & ~F.col("refused")
    ).drop("steps", "refused")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged.  Texts are counted again, in one pass with the verdict, not shuffled."""
    forest, limits = fitted(settle(counts(docs), "quality-counts"), labels)
    shipped = docs.sparkSession.sparkContext.broadcast(forest)
    named, names, back = carried(docs)

    def rows(piece: pa.RecordBatch) -> list:
        c = np.array(_counted(piece), np.int64)
        failed = (c[:, 0] < LEAST_WORDS) | (100 * c[:, 4] > MOST_REPEATED_PERCENT * c[:, 0])
        return [pa.array(~failed & ~(_scored(shipped.value, c) >= limits).any(1))]

    return back(map_texts(named, "kept boolean", rows, names).where("kept"))
