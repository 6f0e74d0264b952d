"""What the text operators share: reading tables, and walking Arrow batches in bounded pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step inside a task looks at together.
PIECE_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where the machine that asks keeps a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def sample_by_hash(df: DataFrame, hashed: str, rows: int, most: int) -> DataFrame:
    """The ``most`` rows of the smallest ``hashed`` (a long), of a table of ``rows`` rows.

    Hashes that are surely too large are left out first, so tasks hand on about ``most`` rows in all.
    """
    if rows > 2 * most:
        df = df.where(F.col(hashed) < F.lit(int(-(1 << 63) + (1 << 64) * 1.5 * most / rows)))
    return df.orderBy(hashed).limit(most)


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold ``limit`` bytes, or one longer text alone."""
    if not batch.num_rows:
        return
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts back to back, and the offsets between them; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[bounds[0] : bounds[-1]], bounds - bounds[0]


def carried(docs: DataFrame) -> tuple[DataFrame, tuple[str, ...], Callable[[DataFrame], DataFrame]]:
    """The table with its columns renamed so that none clashes, their names, and the way back to the table's own."""
    own = docs.columns
    names = [c if c in ("doc_id", "text") else f"own_{i}" for i, c in enumerate(own)]
    back = lambda df: df.select(*(F.col(n).alias(c) for n, c in zip(names, own)))
    return docs.toDF(*names), tuple(names), back


def map_texts(
    docs: DataFrame,
    schema: str,
    rows: Callable[[pa.RecordBatch], list],
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Apply ``rows`` to bounded pieces of (keep..., text); it returns one list per column of ``schema``.

    The columns of ``keep`` come first in the result, unchanged.
    """
    head = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    spec = f"{head}, {schema}" if keep else schema
    names = [*keep, *docs.sparkSession.createDataFrame([], schema).columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                made = rows(piece)
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(k) for k in keep), *(pa.array(c) if not isinstance(c, pa.Array) else c for c in made)],
                    names=names,
                )

    return docs.select(*dict.fromkeys((*keep, "text"))).mapInArrow(run, spec)
