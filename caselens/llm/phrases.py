"""Phrases whose words come together more often than by chance, from an FM-index of each shard.

Texts are lowered (A-Z), split at ``. , ; : ! ?`` and line ends into pieces, and pieces at spaces and tabs into words.
Everything is counted per language.

*Shards.*  A task gathers pieces up to ``SHARD_WORDS`` words (a longer text alone is cut between pieces; one longer
piece is a shard by itself), numbers their (language, word) pairs and builds the Burrows-Wheeler transform of the
numbers, forwards and backwards.  Suffixes are sorted by ``DEPTH`` numbers, which is more than a phrase has words.
Shards are written, bucketed by their id, and never shuffled again.

*Levels.*  An interval is a phrase of a shard: its rows in both transforms.  The words that are frequent over all shards
go back to their shards as intervals, and those are extended to the left by the symbols of the forward transform and to
the right by those of the backward one; either step moves both intervals.  A longer phrase stays if both its parts,
without the first and without the last word, did: it is found from both sides.  No phrase that is frequent is left out.

*Buckets.*  Most phrases are rare.  Before any is made, each shard counts its phrases of frequent words by length and
hash bucket, and the counts of all shards are added up, bucket range by bucket range.  A phrase in a bucket with fewer
than the least number can't be frequent; neither can a longer one that holds it, so it is dropped at its level.  What is
shipped to the tasks is one bit a bucket and length, 2^28 buckets at most (32 MB a length); the more phrases share a
bucket, the fewer are spared, and nothing else changes.

*Sums.*  Phrases in full buckets leave their shards in blocks by language and part of the hashes, a line each, and a part
is added up at once, phrase by phrase, exactly.  A part's phrases are bounded by its share of all words; a shard has at
most one line for a phrase, so no phrase is large.

*Scores.*  ``1000 a n / (l r)`` is the least over the cuts of a phrase, by exact decimals.  A phrase is left out if a
frequent phrase that is longer by one word, on either side, comes as often; a still longer one can't come as often
without such a one.

A null text is empty; a null language is ``und``.  A text of any length is read whole.  Repeated rows count each.
Without rows, or without frequent phrases, the result is empty.  Only ``text`` and ``lang`` are read, so other columns
may have any name.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselens.llm.common import packed, pieces
from caselens.llm.hashing import ODD, Hasher, mixed
from caselens.storage import settle, shared_path

#: Words of a shard, words of a phrase, how often a phrase comes at least, and phrases returned of a language.
SHARD_WORDS, LONGEST, LEAST, TOP = 1 << 19, 5, 100, 2000
#: Numbers by which suffixes are sorted at least: above the words of a phrase.
DEPTH = 8
#: Phrases a bucket holds on average, at most 2 to that power of buckets, buckets added up at once, and at most that
#: many tasks that add them up.
PER_BUCKET, MOST_BITS, BUCKET_RANGE, MOST_ADDERS = 16, 28, 1 << 19, 1 << 11
#: Bytes of text whose shards share a bucket of files: a task takes a bucket's shards at once.
BUCKET_BYTES, MOST_BUCKETS = 1 << 22, 1 << 16
#: Words of all texts for each part of the hashes that is added up at once, and at most that many parts.
PART_WORDS, MOST_PARTS = 1 << 21, 1 << 12
UNKNOWN = "und"


# Shards.


def split_words(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of all texts, the number of the piece of each word, and the text of each piece."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(text, "")), pattern="[.,;:!?\n\x0b\x0c\r]")
    owner = pc.list_parent_indices(lists).to_numpy()
    words = pc.split_pattern_regex(pc.list_flatten(lists), pattern="[ \t]+")
    piece = pc.list_parent_indices(words).to_numpy()
    flat = pc.list_flatten(words)
    real = pc.not_equal(flat, "")
    return flat.filter(real), piece[real.to_numpy(zero_copy_only=False)], owner


def suffix_order(numbers: np.ndarray) -> np.ndarray:
    """Starts of the rotations of ``numbers``, sorted by their first ``DEPTH`` numbers."""
    rank, width = numbers.astype(np.int64), 1
    while True:
        base = int(rank.max()) + 1
        # As many neighbours as a word holds, two at least: a shard has fewer than 2^31 rows.
        take = min(max(2, 62 // base.bit_length()), -(-DEPTH // width))
        key = rank
        for i in range(1, take):
            key = key * base + np.roll(rank, -i * width)
        width *= take
        if width >= DEPTH:
            return np.argsort(key, kind="stable")
        _, rank = np.unique(key, return_inverse=True)


def transforms(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The Burrows-Wheeler transforms of the numbers and of the numbers backwards."""
    return tuple(np.roll(way, 1)[suffix_order(way)] for way in (numbers, numbers[::-1]))


def planes(numbers: np.ndarray) -> bytes:
    """How many numbers, and these byte by byte, the low bytes of all first, compressed: the high ones shrink to nothing.

    Compressed here and not by the shuffle or the files alone, as a batch on its way to a task has its rows as they are.
    """
    raw = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(numbers).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unplanes(data) -> np.ndarray:
    held = pa.py_buffer(data)
    raw = pa.decompress(held[8:], 4 * int.from_bytes(held[:8], "little"), codec="zstd")
    return np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int32)


#: Words are joined by spaces; ``sizes`` are the words of each language, ``counts`` how often each word comes.
SHARDS = "shard long, rows int, langs array<string>, sizes binary, words string, counts binary, forward binary, backward binary"


def _shard(shard: int, words: pa.Array, langs: pa.Array, piece: np.ndarray) -> pa.RecordBatch:
    """One shard; 0 stands between pieces, and (language, word) pairs count from 1, language by language."""
    word = words.dictionary_encode()
    lang = langs.dictionary_encode()
    pair = lang.indices.to_numpy().astype(np.int64) * len(word.dictionary) + word.indices.to_numpy()
    kinds, number, counts = np.unique(pair, return_inverse=True, return_counts=True)
    # A gap before every piece, and one at the end.
    gaps = np.cumsum(np.diff(piece, prepend=-1) != 0)
    numbers = np.zeros(len(number) + int(gaps[-1]) + 1, np.int64)
    numbers[np.arange(len(number)) + gaps] = number + 1
    forward, backward = transforms(numbers)
    sizes = np.bincount(kinds // len(word.dictionary), minlength=len(lang.dictionary))
    made = [
        pa.array([shard]),
        pa.array([len(numbers)], pa.int32()),
        pa.array([lang.dictionary.to_pylist()], pa.list_(pa.string())),
        pa.array([sizes.astype("<i4").tobytes()], pa.binary()),
        pa.array([" ".join(word.dictionary.take(pa.array(kinds % len(word.dictionary))).to_pylist())], pa.string()),
        pa.array([counts.astype("<i4").tobytes()], pa.binary()),
        pa.array([planes(forward)], pa.binary()),
        pa.array([planes(backward)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(made, names=["shard", "rows", "langs", "sizes", "words", "counts", "forward", "backward"])


class Vocabulary:
    """The words of a shard by number (from 1), their languages, counts, and first rows in both transforms."""

    def __init__(self, row: dict):
        self.words = pa.array(row["words"].as_py().split(" "), pa.string())
        self.names = row["langs"].as_py()
        sizes = np.frombuffer(row["sizes"].as_buffer(), "<i4")
        self.lang = np.repeat(np.arange(len(sizes)), sizes)
        self.counts = np.frombuffer(row["counts"].as_buffer(), "<i4")

    def langs(self, symbols: np.ndarray) -> pa.Array:
        return pa.array(self.names, pa.string()).take(pa.array(self.lang[symbols - 1]))

    def hashes(self, symbols: np.ndarray) -> np.ndarray:
        """A hash of each of the words in its language."""
        whole = pc.binary_join_element_wise(self.langs(symbols), self.words.take(pa.array(symbols - 1)), "\0")
        raw, bounds = packed(whole)
        return Hasher(raw).between(bounds[:-1], bounds[1:])

    def starts(self, rows: int) -> np.ndarray:
        """The rows of the gaps come first, then those of each word."""
        return rows - int(self.counts.sum()) + np.cumsum(self.counts) - self.counts


def shards(docs: DataFrame, size: int = SHARD_WORDS) -> DataFrame:
    """The shards of ``docs`` (text, lang).

    An id is made of the task's partition and a running number, so a task that runs again over the same rows gives the
    same shards; ``docs`` should be a table or be written.
    """

    def flush(held: list[tuple], number: int, last: bool) -> Iterator[pa.RecordBatch]:
        """Shards of what is held; unless it is the ``last``, what doesn't fill one stays held."""
        words = pa.concat_arrays([h[0] for h in held])
        langs = pa.concat_arrays([h[1] for h in held])
        shift = np.cumsum([0, *(int(h[2][-1]) + 1 for h in held)])
        piece = np.concatenate([h[2] + s for h, s in zip(held, shift)])
        new = np.flatnonzero(np.diff(piece, prepend=-1))
        held.clear()
        start = 0
        while start < len(piece):
            # As many whole pieces as fit, or one that is longer.
            after = np.searchsorted(new, start + size, side="right")
            end = len(piece) if start + size >= len(piece) else int(new[after - 1])
            if end <= start:
                end = int(new[after]) if after < len(new) else len(piece)
            if not last and end == len(piece) and end - start < size:
                # Copied, as a slice would keep all that was held.
                rest = pa.array(np.arange(start, end))
                held.append((words.take(rest), langs.take(rest), piece[start:] - piece[start]))
                return
            yield _shard(number, words[start:end], langs[start:end], piece[start:end])
            start, number = end, number + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total, number = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in pieces(batch):
                words, piece, owner = split_words(part.column("text"))
                if not len(words):
                    continue
                lang = pc.fill_null(part.column("lang"), UNKNOWN).take(pa.array(owner[piece]))
                held.append((words, lang, piece))
                total += len(words)
                if total >= size:
                    for made in flush(held, number, False):
                        yield made
                        number += 1
                    total = sum(len(h[0]) for h in held)
        if held:
            yield from flush(held, number, True)

    return docs.select("text", "lang").mapInArrow(run, SHARDS)


def written_shards(docs: DataFrame, size: int = SHARD_WORDS) -> tuple[str, DataFrame]:
    """Name and scan of the shards, bucketed by id in the shared folder."""
    spark = docs.sparkSession
    name = f"caselens_shards_{uuid.uuid4().hex}"
    size_of_all = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_BUCKETS, size_of_all // BUCKET_BYTES))
    shards(docs, size).repartition(buckets, "shard").write.bucketBy(buckets, "shard").option(
        "path", shared_path(spark, "shards")).saveAsTable(name)
    return name, spark.table(name)


# Extending intervals.


def stable_order(symbols: np.ndarray) -> np.ndarray:
    """The stable order of the symbols, by their low and then their high halves, which numpy sorts by counting."""
    order = np.argsort(symbols.astype(np.uint16), kind="stable")
    high = (symbols >> 16).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")] if high.any() else order


class Transform:
    """One transform: where the rows of a symbol start, and where each row's symbol leads."""

    def __init__(self, data):
        self.symbols = unplanes(data)
        self.back = stable_order(self.symbols)
        self.leads = np.empty(len(self.back), np.int64)
        self.leads[self.back] = np.arange(len(self.back))

    def extend(self, here: np.ndarray, there: np.ndarray, size: np.ndarray):
        """All extensions of intervals by one symbol: interval, symbol, and place here, place there, size.

        ``here`` are starts in this transform, ``there`` in the other one.  There, the extensions of an interval lie in
        it one after the other by symbol.
        """
        interval = np.repeat(np.arange(len(here)), size)
        row = np.arange(len(interval)) - np.repeat(np.cumsum(size) - size, size) + here[interval]
        symbol = self.symbols[row]
        # An interval keeps its place, so those of one row, which are most, need no sorting.
        several = np.flatnonzero(size[interval] > 1)
        moved = several[np.argsort(interval[several] * (int(self.symbols.max(initial=0)) + 1) + symbol[several], kind="stable")]
        symbol[several], row[several] = symbol[moved], row[moved]
        first = np.flatnonzero((np.diff(interval, prepend=-1) != 0) | (np.diff(symbol, prepend=-1) != 0))
        n = np.diff(first, append=len(interval))
        inside = first - (np.cumsum(size) - size)[interval[first]]
        of, by = interval[first], symbol[first]
        real = by > 0
        of, by = of[real], by[real]
        return of, by, self.leads[row[first]][real], there[of] + inside[real], n[real]

    def words(self, start: np.ndarray, length: int) -> list[np.ndarray]:
        """Symbols of the phrases of ``length`` whose intervals start at ``start``, from left to right."""
        edge = np.cumsum(np.bincount(self.symbols))
        out = []
        for _ in range(length):
            out.append(np.searchsorted(edge, start, side="right"))
            start = self.back[start]
        return out


def extensions(forward: Transform, backward: Transform, at: np.ndarray, mirrored: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Phrases one word longer whose two parts are both among the given ones: second part, first word, at, mirrored, size."""
    left = forward.extend(at, mirrored, size)
    right_at = backward.extend(mirrored, at, size)[3]
    found = np.zeros(len(forward.symbols), bool)
    found[right_at] = True
    both = found[left[2]]
    return tuple(x[both] for x in left)


def extend_both(forward: Transform, backward: Transform, at: np.ndarray, mirrored: np.ndarray, size: np.ndarray):
    """at, mirrored, size of the phrases one word longer whose two parts are both among the given ones."""
    return extensions(forward, backward, at, mirrored, size)[2:]


LEVEL = "shard long, at int, mirrored int, lang string, phrase string, n int"
BLOCKS = "lang string, part int, phrases string, n binary"


class Opened:
    """A shard with its frequent words: their intervals, and a hash of each that all shards agree on."""

    def __init__(self, row: dict):
        at, mirrored, n = (row[c].values.to_numpy().astype(np.int64) for c in ("at", "mirrored", "n"))
        order = np.argsort(at)
        self.at, self.mirrored, self.n = at[order], mirrored[order], n[order]
        self.known = Vocabulary(row)
        symbols = np.searchsorted(self.known.starts(row["rows"].as_py()), self.at) + 1
        self.word = np.zeros(len(self.known.words) + 1, np.uint64)
        self.word[symbols] = self.known.hashes(symbols)
        self.alive = np.zeros(len(self.word), bool)
        self.alive[symbols] = True
        self.hashed = self.word[symbols]
        self.forward = Transform(row["forward"].as_buffer())

    def longer(self, hashed: np.ndarray, of: np.ndarray, by: np.ndarray) -> np.ndarray:
        """Hashes of the phrases ``of`` with a word before each."""
        return mixed(hashed[of] * ODD[1] + self.word[by])


def opened(batch: pa.RecordBatch) -> Iterator[tuple[Opened, dict]]:
    for i in range(batch.num_rows):
        row = {c: batch.column(c)[i] for c in batch.schema.names}
        yield Opened(row), row


def _with_alive(table: DataFrame, alive: DataFrame) -> DataFrame:
    """The shards, which stay where they are, each with its frequent intervals.

    Merged, bucket by bucket: beside a broadcast the files would be read without regard to buckets, and a task would
    hold all shards of a file split at once.  The intervals are gathered once and written, as the shards are read twice.
    """
    listed = alive.groupBy("shard").agg(
        F.collect_list("at").alias("at"), F.collect_list("mirrored").alias("mirrored"), F.collect_list("n").alias("n")
    )
    return table.hint("merge").join(settle(listed, "intervals"), "shard")


def full_buckets(joined: DataFrame, longest: int, least: int, bits: int) -> np.ndarray:
    """One bit for each of 2^bits buckets of each length from 2: whether its phrases come ``least`` times in all shards.

    A phrase counts if all its words are frequent; its words are taken from right to left, by the forward transform.
    """
    ranges = max(1, (1 << bits) // BUCKET_RANGE)
    width = (1 << bits) // ranges
    lengths = longest - 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, _ in opened(batch):
                at, n, hashed = shard.at, shard.n, shard.hashed
                for step in range(lengths):
                    of, by, at, _, n = shard.forward.extend(at, at, n)
                    keep = shard.alive[by]
                    of, by, at, n = of[keep], by[keep], at[keep], n[keep]
                    hashed = shard.longer(hashed, of, by)
                    held, place = np.unique((hashed >> np.uint64(64 - bits)).astype(np.int64), return_inverse=True)
                    sums = np.minimum(np.bincount(place, n, len(held)), least).astype(np.int64)
                    edge = np.searchsorted(held, np.arange(ranges + 1) * width)
                    cut = [(step * ranges + r, r * width, slice(a, b)) for r, (a, b) in enumerate(zip(edge, edge[1:])) if b > a]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r for r, _, _ in cut], pa.int32()),
                         pa.array([planes(np.diff(held[c] - start, prepend=0)) for _, start, c in cut], pa.binary()),
                         pa.array([planes(sums[c]) for _, _, c in cut], pa.binary())],
                        names=["range", "steps", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for r, steps, n in zip(*(batch.column(c) for c in ("range", "steps", "n"))):
                total = sums.setdefault(r.as_py(), np.zeros(width, np.int32))
                place = np.cumsum(unplanes(steps.as_buffer()))
                total[place] = np.minimum(total[place] + unplanes(n.as_buffer()), least)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([np.packbits(t >= least).tobytes() for t in sums.values()], pa.binary())],
            names=["range", "full"])

    read = joined.select("shard", "rows", "langs", "sizes", "words", "counts", "forward", "at", "mirrored", "n")
    counted = read.mapInArrow(count, "range int, steps binary, n binary")
    told = settle(counted.repartition(min(lengths * ranges, MOST_ADDERS), "range").mapInArrow(add, "range int, full binary"), "buckets")
    full = np.zeros((lengths * ranges, width // 8), np.uint8)
    for row in told.toLocalIterator():
        full[row["range"]] = np.frombuffer(row["full"], np.uint8)
    return full.reshape(lengths, ranges * (width // 8))


def longer_phrases(joined: DataFrame, full: np.ndarray, bits: int, parts: int) -> DataFrame:
    """Blocks of the phrases of two words or more of every shard, but for those in buckets that are not full.

    A block holds what a shard has of a language and of one of ``parts`` parts of the hashes; a line is a phrase.
    """
    shipped = joined.sparkSession.sparkContext.broadcast(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, row in opened(batch):
                backward = Transform(row["backward"].as_buffer())
                at, mirrored, n, hashed = shard.at, shard.mirrored, shard.n, shard.hashed
                places, phrases, counts = [], [], []
                for length, bit in enumerate(shipped.value, 2):
                    of, by, at, mirrored, n = extensions(shard.forward, backward, at, mirrored, n)
                    hashed = shard.longer(hashed, of, by)
                    bucket = (hashed >> np.uint64(64 - bits)).astype(np.int64)
                    keep = (bit[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8)) & 1 > 0
                    at, mirrored, n, hashed = at[keep], mirrored[keep], n[keep], hashed[keep]
                    symbols = shard.forward.words(at, length)
                    phrases.append(pc.binary_join_element_wise(*(shard.known.words.take(pa.array(s - 1)) for s in symbols), " "))
                    # The low bits: the high ones are a bucket's, and full buckets are few.
                    places.append(shard.known.lang[symbols[0] - 1] * parts + (hashed & np.uint64(0xFFFFFFFF)).astype(np.int64) % parts)
                    counts.append(n)
                if not phrases:
                    continue
                place = np.concatenate(places)
                order = np.argsort(place, kind="stable")
                place, n = place[order], np.concatenate(counts)[order]
                edge = np.append(np.flatnonzero(np.diff(place, prepend=-1)), len(place))
                lines = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.concat_arrays(phrases).take(pa.array(order)))
                first = place[edge[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.known.names, pa.string()).take(pa.array(first // parts)), pa.array((first % parts).astype(np.int32)),
                     pc.binary_join(lines, "\n"), pa.array([planes(n[a:b]) for a, b in zip(edge, edge[1:])], pa.binary())],
                    names=["lang", "part", "phrases", "n"])

    return joined.mapInArrow(run, BLOCKS)


def frequent_of(blocks: DataFrame, least: int) -> DataFrame:
    """lang, length, phrase, a of the phrases that come ``least`` times in all blocks, added up part by part."""

    def add(held: pa.Table) -> pa.Table:
        phrase = pc.list_flatten(pc.split_pattern(held.column("phrases"), "\n"))
        n = np.concatenate([unplanes(x.as_buffer()) for x in held.column("n")]).astype(np.int64)
        total = pa.table({"phrase": phrase, "n": n}).group_by("phrase").aggregate([("n", "sum")])
        total = total.filter(pc.greater_equal(total.column("n_sum"), least))
        phrase = total.column("phrase")
        return pa.table({
            "lang": pa.repeat(held.column("lang")[0], len(total)),
            "length": pc.add(pc.count_substring(phrase, " "), 1).cast(pa.int32()),
            "phrase": phrase,
            "a": total.column("n_sum"),
        })

    return blocks.groupBy("lang", "part").applyInArrow(add, "lang string, length int, phrase string, a long")


def _level(shard: int, at: np.ndarray, mirrored: np.ndarray, lang: pa.Array, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    int32 = lambda a: pa.array(a.astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(at), shard, np.int64)), int32(at), int32(mirrored), lang, phrase, int32(n)],
        names=["shard", "at", "mirrored", "lang", "phrase", "n"])


def first_level(table: DataFrame) -> DataFrame:
    """Rows of the words of every shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                known = Vocabulary(row)
                at = known.starts(row["rows"].as_py())
                yield _level(row["shard"].as_py(), at, at, known.langs(np.arange(1, len(at) + 1)), known.words, known.counts)

    return table.select("shard", "rows", "langs", "sizes", "words", "counts").mapInArrow(run, LEVEL)


def spoken_words(table: DataFrame) -> DataFrame:
    """lang, n: the words of every language of every shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                sizes, counts = (np.frombuffer(batch.column(c)[i].as_buffer(), "<i4") for c in ("sizes", "counts"))
                n = np.bincount(np.repeat(np.arange(len(sizes)), sizes), counts, len(sizes)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("langs")[i].values, pa.array(n)], names=["lang", "n"])

    return table.select("langs", "sizes", "counts").mapInArrow(run, "lang string, n long")


def frequent(level: DataFrame, least: int) -> DataFrame:
    """Rows of the level whose phrase comes ``least`` times in all shards: a is that number, ``first`` marks one row of it.

    Written with the phrase on the marked row alone.
    """
    # The phrase first: rows are sorted by the first bytes of the first key, and languages are few.
    same = Window.partitionBy("phrase", "lang")
    summed = level.select("*", F.sum("n").over(same).alias("a"), F.min("shard").over(same).alias("lead")).where(F.col("a") >= least)
    first = F.col("shard") == F.col("lead")
    return settle(summed.select(
        "shard", "at", "mirrored", "n", "lang", F.when(first, F.col("phrase")).alias("phrase"), "a", first.alias("first")
    ), "frequent-phrases")


# Counts and scores.


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, size: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """lang, length, phrase, a of all phrases of up to ``longest`` words that come ``least`` times; and lang, n: its words."""
    spark = docs.sparkSession
    name, table = written_shards(docs, size)
    _release(spark)
    words = settle(spoken_words(table).groupBy("lang").agg(F.sum("n").alias("n")), "words")
    spoken = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = min(MOST_BITS, max(3, (spoken // PER_BUCKET).bit_length()))
    alive = frequent(first_level(table), least)
    _release(spark)
    joined = _with_alive(table, alive)
    full = full_buckets(joined, longest, least, bits)
    _release(spark)
    parts = min(MOST_PARTS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), spoken // PART_WORDS))
    longer = settle(frequent_of(longer_phrases(joined, full, bits, parts), least), "longer-phrases")
    spark.sql(f"DROP TABLE {name}")
    return alive.where("first").select("lang", F.lit(1).alias("length"), "phrase", "a").unionByName(longer), words


def _release(spark: SparkSession) -> None:
    """What was shuffled so far is no longer needed; Spark's cleaner removes it when the driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, size: int = SHARD_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, left_most, right_most.

    ``l`` and ``r`` are the counts of the parts of the lowest cut; ``left_most`` and ``right_most`` those of the most
    frequent phrase that is longer by a word on that side, null where none is frequent or counted.
    """
    found, words = frequent_phrases(docs, least, longest, size)
    found = settle(found.withColumn("parts", F.split("phrase", " ")), "phrases")
    part = lambda start, n: F.array_join(F.slice("parts", start, n), " ")
    side = F.explode(F.array(
        F.struct(part(F.lit(2), F.col("length") - 1).alias("phrase"), F.col("a").alias("left"), F.lit(None).cast("long").alias("right")),
        F.struct(part(F.lit(1), F.col("length") - 1).alias("phrase"), F.lit(None).cast("long").alias("left"), F.col("a").alias("right")),
    ))
    longer = found.where("length > 2").select("lang", side.alias("s")).groupBy("lang", "s.phrase").agg(
        F.max("s.left").alias("left_most"), F.max("s.right").alias("right_most"))
    kept = found.where("length > 1").join(longer, ["lang", "phrase"], "left").where(
        F.coalesce(F.greatest("left_most", "right_most"), F.lit(0)) < F.col("a"))
    counts = found.select("lang", "phrase", "a")
    cut = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k")).select(
        "lang", "phrase", "a", "left_most", "right_most", "k",
        part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.col("length") - F.col("k")).alias("tail"))
    scored = (
        cut.join(counts.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")), ["lang", "head"])
        .join(counts.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r")), ["lang", "tail"])
        .join(words, "lang")
        .withColumns({"above": F.lit(1000) * _exact("a") * _exact("n"), "below": _exact("l") * _exact("r")})
        .groupBy("lang", "phrase")
        .agg(
            F.first("a").alias("a"), F.first("n").alias("n"), F.first("left_most").alias("left_most"),
            F.first("right_most").alias("right_most"),
            F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r")).alias("lowest"),
        )
        .select("lang", "phrase", "a", "lowest.l", "lowest.r", "n", "lowest.score", "left_most", "right_most")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "left_most", "right_most")
