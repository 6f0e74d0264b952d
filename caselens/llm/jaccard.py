"""Exact Jaccard self-join of shingle sets, by the relations between sets.

A text's set is its distinct shingles of ``WIDTH`` words.  Equal sets are one set from the
start.  In any order of all shingles, two sets that link share one of their first
``prefix`` shingles.  The order here puts shingles that many texts have last (as far as a
table of ``FREQUENT`` of them goes; it is bounded, and only an order), and hashes decide
the rest.

* *Index.*  Prefix shingles meet in tasks, as lists.  A list is laid out in blocks of equal
  set size and equal position, and the bound ``1 + what follows both positions`` holds for a
  whole block: blocks are skipped against blocks, and only survivors are paired.
* *Answers from answers.*  Lists of frequent shingles, and lists longer than ``SHORT``, are
  not paired.  In rounds, one set of each list, the leader, is compared with the others, and
  sets that are known to be connected are not compared again.
* *Differences.*  Lists that are then still of several parts are gathered in teams.  A team's
  reference is the shingles that most of its sets have, and each set is known by its difference
  from the reference: what it has more and what it lacks.  Two sets differ by as much as their
  differences do, so those that link must share a certain number of differing shingles, or both
  link with the set nearest to the reference.  They meet again in lists of differing shingles,
  of which the first few will do, as with any prefix; short ones are paired, and long ones make
  teams of their own, until none is left.  What counts as short quadruples from level to level.
  A group of n near copies, or of n strangers with a passage in common, costs some n
  comparisons, not n squared.

Compared pairs are compared by their whole sets.  The answer is each text's component.

Shingles and sets are known by 64-bit hashes; words are compared with A-Z lowered.  A text
with fewer words than ``WIDTH`` has its whole sequence as its only shingle; a null, empty or
blank text has none and is alone.  Repeated rows are equal sets.  A component's id is the
least ``doc_id`` in it; a null id never is, unless it has no other.  Columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselens.llm.common import carried, map_texts, packed, pieces
from caselens.llm.components import components
from caselens.llm.hashing import ODD, Hasher, mixed, row_key
from caselens.storage import settle

WIDTH, PERCENT = 5, 75
#: Shingles in the table that decides the order, and the least number of texts to get there.
FREQUENT, LEAST_TEXTS = 1 << 20, 3
#: Entries of a list that is still paired in its task.
SHORT = 64
#: Rounds of leaders before the differences from references are looked at.
ROUNDS = 3
#: Shingles that a task of the map side packs together, and that a task of the reduce side takes.
PACKED, PER_TASK = 1 << 20, 1 << 20


# Sets of texts.


def shingles(raw: np.ndarray, bounds: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Text and shingle of every distinct pair, by text, then by shingle."""
    lowered = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    word = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    first = np.zeros(len(raw) + 1, bool)
    first[bounds[:-1]] = True
    starts = np.flatnonzero(word & (first[:-1] | ~np.append(False, word[:-1])))
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ends = np.flatnonzero(word & np.append((~word[1:]) | first[1:-1], True)) + 1
    words = Hasher(lowered).between(starts, ends)
    owner = np.searchsorted(bounds, starts, side="right") - 1
    n = np.bincount(owner, minlength=len(bounds) - 1)
    last = np.cumsum(n)[owner] - 1  # the text's last word
    total = np.zeros(len(words), np.uint64)
    place = np.arange(len(words))
    for k in range(width):
        # Past the end of a text nothing is added: its first shingle is then the whole sequence.
        total = total * ODD[0] + np.where(place + k <= last, words[np.minimum(place + k, len(words) - 1)], np.uint64(k))
    keep = (place + width - 1 <= last) | ((n[owner] < width) & (place == last - n[owner] + 1))
    owner, total = owner[keep], mixed(total[keep])
    order = np.lexsort((total, owner))
    owner, total = owner[order], total[order]
    new = np.append(True, (owner[1:] != owner[:-1]) | (total[1:] != total[:-1]))
    return owner[new], total[new]


def set_digests(docs: DataFrame) -> DataFrame:
    """doc_id, row, n_shingles, and ``sig``, a hash of the set (null for an empty one)."""

    def rows(piece: pa.RecordBatch) -> list:
        raw, bounds = packed(piece.column("text"))
        n, sig = _digests(*shingles(raw, bounds), piece.num_rows)
        return [pa.array(n, pa.int64()), pa.array(sig.view(np.int64), mask=n == 0)]

    return map_texts(docs, "n_shingles long, sig long", rows, ("doc_id", "row"))


def _digests(owner: np.ndarray, tokens: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    n = np.bincount(owner, minlength=texts)
    edge = np.concatenate([[0], np.cumsum(n)])
    total = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(mixed(tokens * ODD[1]), out=total[1:])
    return n, mixed((total[edge[1:]] - total[edge[:-1]]) * ODD[0] + n.astype(np.uint64))


# How many texts have a shingle.


def _planes(values: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as steps, byte plane by byte plane: the high planes compress away."""
    return np.diff(values, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint32)


def _short(tokens: np.ndarray) -> np.ndarray:
    """32 bits of a shingle, enough to count and to propose: what is proposed is compared by whole sets."""
    return (tokens >> np.uint64(32)).astype(np.uint32)


def frequent_shingles(docs: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles (their 32 bits, sorted) and how often they come; at most ``FREQUENT``."""
    tasks = max(1, -(-total // PER_TASK))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            edge = np.searchsorted(values, (np.arange(tasks + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(tasks))
            cut = [slice(a, b) for a, b in zip(edge, edge[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(tasks, dtype=np.int32)), pa.array([_planes(values[c]) for c in cut], pa.binary()),
                 pa.array([np.minimum(n[c], 65535).astype("<u2").tobytes() for c in cut], pa.binary())],
                names=["task", "values", "n"])

        for batch in batches:
            for piece in pieces(batch):
                _, tokens = shingles(*packed(piece.column("text")))
                held.append(_short(tokens))
                size += len(tokens)
                if size >= PACKED:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for task, values, n in zip(*(batch.column(c).to_pylist() for c in ("task", "values", "n"))):
                held = parts.setdefault(task, ([], []))
                held[0].append(_unplanes(values))
                held[1].append(np.frombuffer(n, "<u2"))
        for values, n in parts.values():
            values, n = np.concatenate(values), np.concatenate(n).astype(np.int64)
            order = np.argsort(values, kind="stable")
            values, n = values[order], n[order]
            new = np.flatnonzero(np.diff(values.astype(np.int64), prepend=-1))
            sums = np.add.reduceat(n, new) if len(new) else n
            often = sums >= LEAST_TEXTS
            yield pa.RecordBatch.from_arrays([pa.array(values[new][often].astype(np.int64)), pa.array(sums[often])],
                                             names=["value", "n"])

    packed_counts = docs.select("text").mapInArrow(count, "task int, values binary, n binary")
    often = settle(packed_counts.repartition(tasks, "task").mapInArrow(add, "value long, n long"), "frequent-shingles")
    steps = often.groupBy(F.least("n", F.lit(4096)).alias("n")).count().orderBy(F.desc("n")).collect()
    least, room = 1 << 62, FREQUENT
    for step in steps:
        room -= step["count"]
        if room < 0:
            break
        least = step["n"]
    top = often.where(F.col("n") >= least).select("value", "n").toArrow()
    values, n = top.column("value").to_numpy().astype(np.uint32), top.column("n").to_numpy()
    order = np.argsort(values)
    return values[order], n[order].astype(np.int32)


# Lists of prefix shingles.


def prefix_size(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """So many of a set's first shingles hold one of any set that links with it."""
    return n - -(-percent * n // 100) + 1


def needed(n, m, percent: int = PERCENT):
    """Least overlap of sets of n and m that link: 100 o >= percent (n + m - o)."""
    return -(-percent * (n + m) // (100 + percent))


POSTINGS = "task int, hot boolean, tokens binary, places binary, texts binary, sigs binary, sizes binary"


def postings(docs: DataFrame, frequent, tasks: int, percent: int = PERCENT) -> DataFrame:
    """Packed lists of prefix shingles: for each task of the other side, sorted shingles with set, size and position.

    Frequent shingles are dealt by set, all others by shingle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, often = frequent.value
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            token, hot, place, text, sig, n = (np.concatenate(c) for c in zip(*held))
            # Equal sets of this task are one.
            _, keep = np.unique(row_key(token, sig), return_index=True)
            token, hot, place, sig, n = token[keep], hot[keep], place[keep], sig[keep], n[keep]
            sigs, first, text = np.unique(sig, return_index=True, return_inverse=True)
            sizes = n[first]
            short = _short(token)
            task = np.where(hot, mixed(sig), mixed(token)) % np.uint64(tasks)
            order = np.lexsort((short, hot, task))
            group = (task * np.uint64(2) + hot)[order].astype(np.int64)
            edge = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
            cols: list[list] = [[] for _ in range(7)]
            for a, b in zip(edge, edge[1:]):
                part = order[a:b]
                used, local = np.unique(text[part], return_inverse=True)
                for col, made in zip(cols, (
                        int(group[a]) // 2, bool(group[a] % 2), _planes(short[part]), place[part].astype("<u4").tobytes(),
                        local.astype("<u4").tobytes(), sigs[used].tobytes(), sizes[used].astype("<i8").tobytes())):
                    col.append(made)
            kinds = (pa.int32(), pa.bool_(), *(pa.binary(),) * 5)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["task", "hot", "tokens", "places", "texts", "sigs", "sizes"])

        for batch in batches:
            for piece in pieces(batch):
                owner, tokens = shingles(*packed(piece.column("text")))
                if not len(owner):
                    continue
                n, sig = _digests(owner, tokens, piece.num_rows)
                found = np.minimum(np.searchsorted(values, _short(tokens)), max(len(values) - 1, 0))
                count = np.where(values[found] == _short(tokens), often[found], 0) if len(values) else np.zeros(len(tokens), int)
                order = np.lexsort((tokens, count, owner))
                edge = np.cumsum(n) - n
                place = np.arange(len(owner)) - edge[owner]
                use = order[place < prefix_size(n, percent)[owner]]
                place = place[place < prefix_size(n, percent)[owner]]
                held.append((tokens[use], count[use] > 0, place, owner[use], sig[owner[use]], n[owner[use]]))
                size += len(tokens)
                if size >= PACKED:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return docs.select("text").mapInArrow(run, POSTINGS)


def pair_lists(packed_lists: DataFrame, tasks: int, percent: int = PERCENT) -> DataFrame:
    """Proposed pairs (``token`` null), and the entries of the lists that are left to the rounds (``b`` null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for hot, tokens, places, texts, sigs, sizes in zip(*(batch.column(c).to_pylist() for c in (
                    "hot", "tokens", "places", "texts", "sigs", "sizes"))):
                text = np.frombuffer(texts, "<u4")
                entry = (_unplanes(tokens), np.frombuffer(places, "<u4").astype(np.int64),
                         np.frombuffer(sigs, np.uint64)[text], np.frombuffer(sizes, "<i8")[text])
                if hot:
                    yield _entries(*entry)
                else:
                    held.append(entry)
        if held:
            yield from _paired(*(np.concatenate(c) for c in zip(*held)), percent)

    schema = "token long, a long, b long, n long, place long"
    return packed_lists.repartition(tasks, "task").mapInArrow(run, schema)


def _entries(token: np.ndarray, place: np.ndarray, sig: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(token.astype(np.int64)), pa.array(sig.view(np.int64)), pa.nulls(len(token), pa.int64()), pa.array(n),
         pa.array(place)], names=["token", "a", "b", "n", "place"])


def _paired(token, place, sig, n, percent) -> Iterator[pa.RecordBatch]:
    """Pair the short lists of one task block by block; hand on the long ones."""
    order = np.lexsort((sig, place, n, token))
    token, place, sig, n = token[order], place[order], sig[order], n[order]
    new = np.append(True, (token[1:] != token[:-1]) | (sig[1:] != sig[:-1]) | (n[1:] != n[:-1]))
    token, place, sig, n = token[new], place[new], sig[new], n[new]
    start = np.flatnonzero(np.diff(token.astype(np.int64), prepend=-1))
    length = np.diff(start, append=len(token))
    each = np.repeat(length, length)
    long_ = each > SHORT
    if long_.any():
        yield _entries(token[long_], place[long_], sig[long_], n[long_])
    keep = (each > 1) & ~long_
    token, place, sig, n = token[keep], place[keep], sig[keep], n[keep]
    if not len(token):
        return
    new = np.append(True, (token[1:] != token[:-1]) | (n[1:] != n[:-1]) | (place[1:] != place[:-1]))
    at = np.flatnonzero(new)
    size = np.diff(at, append=len(token))
    b_token, b_n, b_place = token[at], n[at], place[at]
    a_out, b_out = [], []
    for step in range(SHORT):
        left = np.arange(len(at) - step)
        right = left + step
        same = b_token[left] == b_token[right]
        if not same.any():
            break
        left, right = left[same], right[same]
        # Sorted by size: the right block's sets are at least as large.
        fits = (100 * b_n[left] >= percent * b_n[right]) & (
            1 + np.minimum(b_n[left] - b_place[left], b_n[right] - b_place[right]) - 1 >= needed(b_n[left], b_n[right], percent))
        left, right = left[fits], right[fits]
        times = size[left] * size[right]
        block = np.repeat(np.arange(len(left)), times)
        number = np.arange(len(block)) - np.repeat(np.cumsum(times) - times, times)
        x, y = at[left[block]] + number // size[right[block]], at[right[block]] + number % size[right[block]]
        if step == 0:
            x, y = x[x < y], y[x < y]
        a_out.append(sig[x])
        b_out.append(sig[y])
    a, b = np.concatenate(a_out), np.concatenate(b_out)
    different = a != b
    a, b = a[different].view(np.int64), b[different].view(np.int64)
    a, b = np.minimum(a, b), np.maximum(a, b)
    _, first = np.unique(row_key(a.view(np.uint64), b.view(np.uint64)), return_index=True)
    none = pa.nulls(len(first), pa.int64())
    yield pa.RecordBatch.from_arrays([none, pa.array(a[first]), pa.array(b[first]), none, none],
                                     names=["token", "a", "b", "n", "place"])


# Comparing.


def overlaps(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, n_a, n_b, overlap: whole sets of both sides compared."""
    left = texts.select(F.col("sig").alias("a"), F.col("text"))
    right = texts.select(F.col("sig").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "text", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                (own_a, tok_a), (own_b, tok_b) = (shingles(*packed(piece.column(c))) for c in ("text", "text_b"))
                key = np.concatenate([row_key(own_a, tok_a), row_key(own_b, tok_b)])
                order = np.argsort(key, kind="stable")
                twice = order[:-1][key[order[1:]] == key[order[:-1]]]
                rows = piece.num_rows
                count = lambda o: pa.array(np.bincount(o, minlength=rows))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("a"), piece.column("b"), count(own_a), count(own_b), count(own_a[twice])],
                    names=["a", "b", "n_a", "n_b", "overlap"])

    return both.mapInArrow(run, "a long, b long, n_a long, n_b long, overlap long")


def _links(compared: DataFrame, percent: int) -> DataFrame:
    o = F.col("overlap")
    return compared.where(100 * o >= percent * (F.col("n_a") + F.col("n_b") - o)).select("a", "b")


def _needed(n: Column, m: Column, percent: int) -> Column:
    return F.ceil(percent * (n + m) / (100 + percent) - 1e-9)


def _bound(percent: int) -> Column:
    """Whether entries x and y of a list, by size and position, can belong to sets that link."""
    n, m = F.col("x.n"), F.col("y.n")
    small, large = F.least(n, m), F.greatest(n, m)
    reach = F.least(n - F.col("x.place"), m - F.col("y.place"))
    return (100 * small >= percent * large) & (reach >= _needed(n, m, percent))


def _ordered() -> list[Column]:
    return [F.least("x.a", "y.a").alias("a"), F.greatest("x.a", "y.a").alias("b")]


def rounds_of_leaders(lists: DataFrame, texts: DataFrame, links: DataFrame, percent: int = PERCENT) -> DataFrame:
    """node, label by all links, those given and those between entries of the long lists (token, a, n, place).

    Between rounds, a part that a leader links with takes over the leader's label.  That may leave connected
    parts with different labels, never the same label on parts that aren't connected; whole components are
    computed before what is open in the lists is settled by references, and at the end.
    """
    label = components(links)
    held = settle(_labelled(lists.select("a").distinct(), label), "list-labels")
    tested = None
    for round_ in range(ROUNDS):
        known = _unsettled(lists, held, round_)
        if known.isEmpty():
            return label if tested is None else components(links)
        pair = settle(
            known.select(F.struct("a", "n", "place", "label").alias("x"), F.col("lead").alias("y"))
            .where("x.label <> y.label").where(_bound(percent))
            .select(*_ordered(), F.col("x.label").alias("part"), F.col("y.label").alias("into")).distinct(),
            "leader-pairs")
        new = pair.select("a", "b").distinct()
        if tested is not None:
            new = new.join(tested.select("a", "b"), ["a", "b"], "left_anti")
        compared = settle(overlaps(new, texts), "compared")
        found = settle(_links(compared, percent), "set-links")
        moves = pair.join(found, ["a", "b"]).groupBy("part").agg(F.min("into").alias("into"))
        held = settle(held.join(moves, held["label"] == moves["part"], "left").select(
            "a", F.coalesce("into", "label").alias("label")), "list-labels")
        links = links.unionByName(found)
        tested = compared if tested is None else tested.unionByName(compared)
    tested = links.limit(0) if tested is None else tested
    return outside_references(lists, texts, links, tested.select("a", "b"), percent)


def _labelled(sets: DataFrame, label: DataFrame) -> DataFrame:
    return sets.join(label.withColumnRenamed("node", "a"), "a", "left").select("a", F.coalesce("label", "a").alias("label"))


def _unsettled(lists: DataFrame, held: DataFrame, round_: int) -> DataFrame:
    """The entries of lists whose sets are not all connected, with the list's largest part (``usual``) and a set of it."""
    known = lists.join(held, "a")
    parts = known.groupBy("token", "label").agg(
        F.min(F.struct(F.xxhash64("a", F.lit(round_)).alias("h"), "a", "n", "place", "label")).alias("lead"),
        F.count("*").alias("sets"),
    )
    per = parts.groupBy("token").agg(
        F.max(F.struct("sets", "label", "lead")).alias("top"), F.count("*").alias("parts")
    ).where("parts > 1").select("token", F.col("top.label").alias("usual"), F.col("top.lead").alias("lead"))
    return settle(known.join(per, "token"), "leader-lists")


# Differences from references.

#: Sets of a team that its reference is made of, about; the reference decides how lists fall apart, never a result.
DRAWN = 32


def whole_sets(sets: DataFrame, texts: DataFrame) -> DataFrame:
    """team (0), a, n, rest: the given sets as arrays, which are their differences from the empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                owner, tokens = shingles(*packed(piece.column("text")))
                edge = np.searchsorted(owner, np.arange(piece.num_rows + 1))
                rest = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(tokens.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(piece.num_rows, np.int64)), piece.column("sig"), pa.array(np.diff(edge)), rest],
                    names=["team", "a", "n", "rest"])

    wanted = texts.join(sets.select(F.col("a").alias("sig")).distinct(), "sig").select("sig", "text")
    return settle(wanted.mapInArrow(run, "team long, a long, n long, rest array<long>"), "members")


def _open_lists(lists: DataFrame, held: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Entries of lists of several parts, with their ``label``: of those with up to ``most``, and of longer ones."""
    known = lists.join(held, "a")
    per = known.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("sets"))
    known = settle(known.join(per.where("low <> high").select("token", "sets"), "token"), "open-lists")
    return known.where(F.col("sets") <= most), known.where(F.col("sets") > most)


def teams(long_: DataFrame) -> DataFrame:
    """team, a, into: the sets of long lists.  Lists go together if they share the set that is in the most of their team's lists."""
    often = long_.groupBy("team", "a").agg(F.count("*").alias("lists"))
    named = long_.join(often, ["team", "a"]).groupBy("team", "token").agg(F.max(F.struct("lists", "a")).alias("top")).select(
        "token", F.xxhash64("team", "top.a").alias("into"))
    return settle(long_.join(named, "token").select("team", "a", "into").distinct(), "teams")


def next_members(members: DataFrame, wanted: DataFrame) -> DataFrame:
    """Members of the new teams: what differs between the old difference and the shingles that most of the new team have."""
    sizes = wanted.groupBy("into").agg(F.count("*").alias("sets"))
    drawn = settle(wanted.join(sizes, "into").join(members, ["team", "a"]).select(F.col("into").alias("team"), "a", "n", "rest", "sets"), "drawn")
    share = F.pmod(F.xxhash64("a", "team"), F.lit(1 << 20)) * F.col("sets") < DRAWN * (1 << 20)
    some = drawn.where(share).select("team", F.explode("rest").alias("shingle"))
    taken = drawn.where(share).groupBy("team").agg(F.count("*").alias("taken"))
    most = some.groupBy("team", "shingle").agg(F.count("*").alias("have")).join(taken, "team").where("2 * have > taken")
    reference = settle(most.groupBy("team").agg(F.collect_list("shingle").alias("most")), "references")
    none = F.array().cast("array<long>")
    both = drawn.join(reference, "team", "left").withColumn("most", F.coalesce("most", none))
    return settle(both.select("team", "a", "n", F.concat(
        F.array_except("rest", "most"), F.array_except("most", "rest")).alias("rest")).withColumn("size", F.size("rest").cast("long")), "members")


def _excess(size: Column, n: Column, percent: int) -> Column:
    """Two sets link exactly if their differences share ``(excess + excess) / (2 (100 + percent))`` shingles."""
    return (100 + percent) * size - (100 - percent) * n


def nearest_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Each set with the one of its team that is nearest to the reference, if the sizes let them link.

    Sets whose excesses are together 0 or less link, and so they both do with the nearest one.
    """
    excess = _excess(F.col("size"), F.col("n"), percent)
    near = members.groupBy("team").agg(F.min(F.struct(excess.alias("excess"), "a", "size")).alias("near"))
    can = 2 * (100 + percent) * F.least("size", "near.size") >= excess + F.col("near.excess")
    return members.join(near, "team").where((F.col("a") != F.col("near.a")) & can).select(
        F.least("a", "near.a").alias("a"), F.greatest("a", "near.a").alias("b")).distinct()


def outer_lists(members: DataFrame, held: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Lists of the first shingles of the differences, so many that sets of a team that can link share one of them.

    Only shingles that several parts of a team have count; those of the fewest sets come first.
    """
    known = members.join(held, "a").withColumn("excess", _excess(F.col("size"), F.col("n"), percent))
    least = known.groupBy("team", "label").agg(F.min("excess").alias("excess"))
    low = least.groupBy("team").agg(F.min(F.struct("excess", "label")).alias("low"), F.count("*").alias("parts")).where("parts > 1")
    second = least.join(low, "team").where(F.col("label") != F.col("low.label")).groupBy("team", "low").agg(F.min("excess").alias("second"))
    other = F.when(F.col("label") == F.col("low.label"), F.col("second")).otherwise(F.col("low.excess"))
    known = known.join(second, "team").withColumn("share", F.greatest(F.lit(1).cast("long"), F.ceil((F.col("excess") + other) / (2 * (100 + percent)) - 1e-9)))
    each = settle(known.where(F.col("share") <= F.col("size")).select(
        "team", "a", "n", "label", "excess", "share", F.explode("rest").alias("shingle")), "differences")
    parted = each.groupBy("team", "shingle").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("sets")).where("low <> high")
    common = each.join(parted.select("team", "shingle", "sets"), ["team", "shingle"])
    own = Window.partitionBy("team", "a")
    placed = common.withColumns({"total": F.count("*").over(own), "place": F.row_number().over(own.orderBy("sets", "shingle"))})
    return settle(placed.where(F.col("place") <= F.col("total") - F.col("share") + 1).select(
        F.xxhash64("team", "shingle").alias("token"), "team", "a", "n", "excess", (F.col("total") - F.col("place") + 1).alias("reach")), "outer-lists")


def _short_pairs(short: DataFrame, percent: int) -> DataFrame:
    """Pairs of different parts in short lists that sizes and reaches allow."""
    x, y = short.alias("x"), short.alias("y")
    n, m = F.col("x.n"), F.col("y.n")
    fits = (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (
        2 * (100 + percent) * F.least("x.reach", "y.reach") >= F.col("x.excess") + F.col("y.excess"))
    return x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.a") < F.col("y.a")) & (F.col("x.label") != F.col("y.label")) & fits).select(
        *_ordered()).distinct()


def outside_references(lists: DataFrame, texts: DataFrame, links: DataFrame, tested: DataFrame, percent: int = PERCENT) -> DataFrame:
    """node, label: what is open in long lists is settled by how their sets differ from a reference, level by level."""

    def test(pairs: DataFrame) -> None:
        nonlocal links, tested
        new = settle(pairs.join(tested, ["a", "b"], "left_anti"), "set-pairs")
        compared = settle(overlaps(new, texts), "compared")
        links = links.unionByName(settle(_links(compared, percent), "set-links"))
        tested = tested.unionByName(new)

    def labels(sets: DataFrame) -> DataFrame:
        return settle(_labelled(sets.select("a").distinct(), components(links)), "list-labels")

    most, members = SHORT, None
    level = lists.withColumns({"team": F.lit(0).cast("long"), "reach": F.col("n") - F.col("place"), "excess": 2 * percent * F.col("n")})
    held = labels(level)
    while True:
        short, long_ = _open_lists(level, held, most)
        if not short.isEmpty():
            test(_short_pairs(short, percent))
        if long_.isEmpty():
            return components(links)
        wanted = teams(long_)
        members = next_members(whole_sets(wanted, texts) if members is None else members, wanted)
        test(nearest_pairs(members, percent))
        held = labels(members)
        level, most = outer_lists(members, held, percent), 4 * most


def placed_sets(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, row (a hash of id and text), n_shingles, sig, and label: the component (null for an empty set)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text").withColumn("row", row_hash())
    sets = settle(set_digests(docs), "shingle-sets")
    total = sets.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    tasks = max(1, -(-total // (2 * PER_TASK)))
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, total))
    proposed = settle(pair_lists(postings(docs, frequent, tasks, percent), tasks, percent), "set-pairs")
    pairs = proposed.where("token is null").select("a", "b").distinct()
    lists = proposed.where("token is not null").groupBy("token", "a").agg(
        F.min("n").alias("n"), F.min("place").alias("place"))
    lists = settle(lists, "long-lists")
    # A text for every set that is compared.
    members = pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig"))).unionByName(
        lists.select(F.col("a").alias("sig"))).distinct()
    first = sets.where("sig is not null").groupBy("sig").agg(F.min("row").alias("row"))
    wanted = first.join(members, "sig")
    texts = settle(docs.join(wanted, "row").select("sig", "text").dropDuplicates(["sig"]), "set-texts")
    links = settle(_links(overlaps(pairs, texts), percent), "set-links")
    label = rounds_of_leaders(lists, texts, links, percent)
    return sets.join(label, sets["sig"] == label["node"], "left").select(
        "doc_id", "row", "n_shingles", "sig", F.coalesce("label", "sig").alias("label"))


def row_hash() -> Column:
    """Tells rows apart where ids repeat or are null."""
    return F.xxhash64("doc_id", "text")


def link_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id."""
    placed = placed_sets(docs, percent)
    least = placed.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    least = least.withColumnRenamed("label", "l")
    return placed.join(least, F.col("label") == F.col("l"), "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, unchanged, that have the least id of their component (of equal ids, one); all without words."""
    placed = placed_sets(docs, percent).where("label is not null")
    keep = placed.groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row")).alias("least")
    ).select(F.col("least.row").alias("kept_row"))
    keep = settle(keep, "kept-rows")
    named, names, back = carried(docs)
    named = named.withColumn("row", row_hash())
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    one = named.where(~wordless).join(keep, F.col("row") == F.col("kept_row")).dropDuplicates(["row"])
    return back(one.select(*names).unionByName(named.where(wordless).select(*names)))
