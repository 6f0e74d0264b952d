"""Language of a text, by cross-parsing it with suffix automata of labelled text.

*Learning.*  Passages of ``PASSAGE`` characters of the labelled texts are drawn by hash, up to ``LEARN_CHARS``
characters a language: a bounded sample, and the bound is a parameter.  All passages of all learned texts can be
drawn.  Per language, a task builds the suffix automaton of the drawn passages: the least automaton that reads all of
their substrings.  Its edges are packed into three short arrays (rows laid over each other, each edge naming its owner).

*Predicting.*  A text is cut into phrases, each the longest one from there on that the automaton reads, or one letter
if it reads none.  All texts of a piece are walked together, in stretches of ``STRETCH`` letters: the phrases of a
stretch are exact from the first place on that the phrases from the text's start meet too, and those before it are
followed one by one.  A phrase costs the bits of a place in the learned passages, ``log2`` of their
length, which evens out languages learned from less text; the language with the fewest bits a letter wins, and of
equal ones the least name.

Letters are lowered; everything that is neither a letter nor a mark is one space.  ``lang``, ``source`` and ``doc_id``
are no inputs of a prediction.  The score is the share of the runner-up in the bits of both: 0.5 for a draw, near 1
for a clear winner, and 1 if one language was learned.

A null text, and a text without letters, is ``und`` with score 0, and so is every text where nothing was learned (an
empty table, no labels).  A text of any length is read whole.  Repeated rows get the
same answer each and are learned once.  A row without ``doc_id`` counts as held out.  Columns other than ``doc_id``,
``text`` and, for learning, ``lang`` are neither read nor returned, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselens.llm.common import map_texts
from caselens.storage import settle

#: Characters of a passage that can be drawn, and characters that a language is learned from.
PASSAGE, LEARN_CHARS = 512, 1 << 16
#: Characters of a stretch that is walked by itself.
STRETCH = 512
UNKNOWN = "und"
#: Places behind the last packed row that are tried again.
BEHIND = 32


# The automaton.


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Edges of the states of the suffix automaton of ``codes``; state 0 is the start."""
    edges: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in codes:
        new = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and c not in edges[at]:
            edges[at][c] = new
            at = link[at]
        if at >= 0:
            into = edges[at][c]
            if length[into] == length[at] + 1:
                link[new] = into
            else:
                twin = len(edges)
                edges.append(dict(edges[into]))
                length.append(length[at] + 1)
                link.append(link[into])
                while at >= 0 and edges[at].get(c) == into:
                    edges[at][c] = twin
                    at = link[at]
                link[into] = link[new] = twin
        last = new
    return edges


def packed_edges(edges: list[dict[int, int]], letters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, owner, into: state s has an edge by c iff owner[base[s] + c] == s, to into[base[s] + c].

    Rows with several edges go to the next place where all fit, rows with one edge into the holes they leave.
    """
    total = sum(map(len, edges))
    size = 4 * total + 2 * letters + BEHIND
    owner, into, base = [-1] * size, [0] * size, [0] * len(edges)
    taken = bytearray(size)
    front = free = 0
    for s in sorted(range(len(edges)), key=lambda s: -len(edges[s])):
        row = edges[s]
        if not row:
            break
        keys = sorted(row)
        if len(keys) > 1:
            at = max(front, keys[0])
            while any(taken[at - keys[0] + c] for c in keys):
                at += 1
            front = max(front, at - BEHIND)
        else:
            while taken[free]:
                free += 1
            at = max(free, keys[0])
            while taken[at]:
                at += 1
        first = at - keys[0]
        base[s] = first
        for c in keys:
            taken[first + c], owner[first + c], into[first + c] = 1, s, row[c]
    used = max(base) + letters + 1
    return tuple(np.array(a, np.int32) for a in (base, owner[:used], into[:used]))


@dataclass(frozen=True)
class Learned:
    """One language: its letters in order, its packed automaton, and the bits of a place in its passages."""

    lang: str
    letters: np.ndarray
    base: np.ndarray
    owner: np.ndarray
    into: np.ndarray
    bits: float

    def codes(self, text: np.ndarray) -> np.ndarray:
        """Places of the characters among the letters; -1 for others and for what stands between two texts."""
        last = int(self.letters[-1])
        place = np.full(last + 2, -1, np.int32)
        place[self.letters] = np.arange(len(self.letters))
        place[0] = -1
        return place[np.minimum(text, last + 1)]


# Learning.


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == 0


def _plain(text: Column) -> Column:
    """Lowered letters and marks, all else one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " "))


def drawn_passages(labelled: DataFrame, chars: int = LEARN_CHARS) -> DataFrame:
    """lang, passages: distinct passages by the least hashes, ``chars`` characters of a language."""
    known = labelled.where("lang is not null and text is not null").select(
        "lang", "text", F.xxhash64("text").alias("known_by"), F.ceil(F.length("text") / PASSAGE).alias("parts")
    ).where("parts > 0")
    sizes = settle(known.groupBy("lang").agg(F.sum("parts").alias("all")), "passage-counts")
    most = -(-chars // PASSAGE)
    # Hashes that are surely too large for their language are left out before any text is read further.
    share = 2.0 * most / F.col("all")
    place = lambda part: F.xxhash64("known_by", part)
    near = F.filter(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda p: (share >= 1) | (place(p) < share * 2.0**64 - 2.0**63))
    few = known.join(sizes, "lang").select("lang", "text", "known_by", near.alias("near")).where(F.size("near") > 0)
    cut = few.select("lang", "known_by", _plain(F.col("text")).alias("plain"), F.explode("near").alias("part")).select(
        "lang", place(F.col("part")).alias("place"), F.substring("plain", (F.col("part") * PASSAGE + 1).cast("int"), PASSAGE).alias("passage")
    )
    by_lang = cut.where("passage <> ''").distinct().groupBy("lang").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("place", "passage"))), 1, most).alias("p"))
    return by_lang.select("lang", F.transform("p", lambda p: p["passage"]).alias("passages"))


AUTOMATON = "lang string, letters array<int>, base binary, owner binary, into binary, bits double"


def _build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, passages in zip(batch["lang"], batch["passages"]):
            # Passages are kept apart by a letter that no text has, so no phrase runs over two of them.
            text = np.frombuffer("\0".join(passages).encode("utf-32-le"), "<u4")
            letters, codes = np.unique(text, return_inverse=True)
            base, owner, into = packed_edges(suffix_automaton(codes.tolist()), len(letters))
            yield pd.DataFrame({
                "lang": [lang], "letters": [letters.astype(np.int32).tolist()], "base": [base.tobytes()],
                "owner": [owner.tobytes()], "into": [into.tobytes()], "bits": [float(np.log2(len(codes) + 1))],
            })


def learn(labelled: DataFrame, chars: int = LEARN_CHARS) -> list[Learned]:
    """The languages of the rows (lang, text) given, by name; bounded by their number times ``chars``."""
    made = settle(drawn_passages(labelled, chars).repartition("lang").mapInPandas(_build, AUTOMATON), "automata").collect()
    arrays = lambda r: (np.frombuffer(r[c], np.int32) for c in ("base", "owner", "into"))
    return [
        Learned(r["lang"], np.array(r["letters"], np.uint32), *arrays(r), r["bits"])
        for r in sorted(made, key=lambda r: r["lang"].encode())
    ]


# Predicting.


def _phrase_end(codes: memoryview, start: int, base: memoryview, owner: memoryview, into: memoryview) -> int:
    """Where the longest phrase from ``start`` ends."""
    state, at = 0, start
    while (c := codes[at]) >= 0 and owner[base[state] + c] == state:
        state = into[base[state] + c]
        at += 1
    return max(at, start + 1)


def cut_stretches(codes: np.ndarray, start: np.ndarray, end: np.ndarray, language: Learned) -> tuple[np.ndarray, np.ndarray]:
    """Cut all stretches from their starts at once.

    Gives a mark at every place where a phrase starts, and the end of the last phrase of each stretch, which may lie
    in the next one.  ``codes`` hold -1 after every text.
    """
    base, owner, into = language.base, language.owner, language.into
    marks = np.zeros(len(codes), bool)
    marks[start] = True
    last = np.empty(len(start), np.int64)
    lane, at, state, stop = np.arange(len(start)), start.copy(), np.zeros(len(start), np.int32), end
    while len(lane):
        c = codes[at]
        place = base[state] + c
        goes = (owner[place] == state) & (c >= 0)
        cut = ~goes
        at = at + (goes | (state == 0))
        state = np.where(goes, into[place], 0)
        marks[at[cut & (at < stop)]] = True
        done = cut & (at >= stop)
        if done.any():
            last[lane[done]] = at[done]
            go_on = ~done
            lane, at, state, stop = lane[go_on], at[go_on], state[go_on], stop[go_on]
    return marks, last


def count_phrases(codes: np.ndarray, first: np.ndarray, sizes: np.ndarray, language: Learned) -> np.ndarray:
    """Phrases of each text, given where it starts and how long it is; none may be empty.

    Texts are cut in stretches that are walked at once, each as if a phrase started with it.  The real phrases are
    then followed from text start to text end: one after the other until one starts at a mark, and from there on they
    are the marked ones up to the next stretch.
    """
    parts = -(-sizes // STRETCH)
    text = np.repeat(np.arange(len(first)), parts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = first[text] + number * STRETCH
    end = np.minimum(start + STRETCH, first[text] + sizes[text])
    marks, last = cut_stretches(codes, start, end, language)
    before = memoryview(np.append(0, np.cumsum(marks)))
    walk = [memoryview(np.ascontiguousarray(a)) for a in (language.base, language.owner, language.into)]
    letters, marked = memoryview(codes), marks.tobytes()
    out = [0] * len(first)
    at, now = 0, -1
    for t, a, b, x in zip(text.tolist(), start.tolist(), end.tolist(), last.tolist()):
        if t != now:
            now, at = t, a
        while at < b and not marked[at]:
            at = _phrase_end(letters, at, *walk)
            out[t] += 1
        if at < b:
            out[t] += before[b] - before[at]
            at = x
    return np.array(out)


def _winners(languages: list[Learned], bits: np.ndarray, worded: np.ndarray) -> list:
    """The language of the fewest bits of each text, the least name of equal ones, and the score."""
    if not len(languages):
        return [[UNKNOWN] * len(worded), np.zeros(len(worded))]
    best = bits.argmin(axis=0)
    least = bits.min(axis=0)
    score = np.ones(len(worded))
    if len(languages) > 1:
        second = np.partition(bits, 1, axis=0)[1]
        score = np.divide(second, least + second, out=np.zeros(len(worded)), where=worded)
    names = [languages[i].lang if w else UNKNOWN for i, w in zip(best, worded)]
    return [names, np.where(worded, score, 0.0)]


def predict(docs: DataFrame, languages: list[Learned]) -> DataFrame:
    """doc_id, lang_pred, score."""
    shipped = docs.sparkSession.sparkContext.broadcast(languages)

    def rows(piece: pa.RecordBatch) -> list:
        known = shipped.value
        plain = pc.utf8_trim(pc.replace_substring_regex(
            pc.utf8_lower(pc.fill_null(piece.column("text"), "")), pattern=r"[^\p{L}\p{M}]+", replacement=" "), " ")
        worded = pc.match_substring_regex(plain, r"\p{L}").to_numpy(zero_copy_only=False).astype(bool)
        sizes = pc.utf8_length(plain).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.cumsum(sizes + 1) - sizes - 1
        text = np.frombuffer("\0".join([*plain.to_pylist(), ""]).encode("utf-32-le"), "<u4")
        bits = np.full((len(known), piece.num_rows), np.inf)
        if worded.any():
            for i, language in enumerate(known):
                n = count_phrases(language.codes(text), first[worded], sizes[worded], language)
                bits[i, worded] = language.bits * n / sizes[worded]
        return _winners(known, bits, worded)

    return map_texts(docs, "lang_pred string, score double", rows)


def predict_held_out(docs: DataFrame, chars: int = LEARN_CHARS) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the rows that are not held out."""
    languages = learn(docs.where(~held_out()).select("lang", "text"), chars)
    return predict(docs, languages).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
