"""Token counts by a compiled finite-state tokenizer.

Two deterministic transducers are compiled from the vocabulary file.

* The *splitter* reads character classes and says where the words of the byte-level
  pattern begin.  It has a dozen states, so a run of characters is a map from entry
  states to exit states.  Texts are laid in chunks, the maps of all chunks are built side
  by side, and a parallel prefix scan composes them: each chunk's entry state is then
  known without reading the text from its start.
* The *merger* reads the bytes of a word; every transition carries the change of the
  number of tokens.  It rests on a property of merge tables: tokens in a row are the
  encoding of their bytes exactly if each two neighbours are.  So the last token of every
  prefix is determined, and a state need hold only the open vocabulary prefixes, each
  with the token before it and the count there.  States are made when first reached.

Counts are those of the library for the same file, with its special strings handled as
its default does.  A null text counts as empty.  Repeated rows and equal ids are counted
one by one; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import json
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from caselens.llm.common import map_texts, tokenizer_path

CHUNK = 64
#: A worker remembers so many words and states; results don't depend on it.
WORDS, STATES = 600_000, 200_000

# Classes of characters.  The letters of the contractions 's 't 'm 'd 're 've 'll are told apart.
LETTER, ONE, TWO, E, L, NUMBER, SPACE, WHITE, OTHER, QUOTE, END = range(11)
# States: what the last characters were.  A white run of two or more differs from a single one.
(START, IN_LETTERS, IN_NUMBERS, IN_OTHER, SPACE_1, SPACE_N, WHITE_1, WHITE_N, QUOTED, QUOTED_TWO, QUOTED_L,
 CONTRACTED) = range(12)
N_STATES, N_CLASSES = 12, 11

# The white characters of the pattern beyond ASCII.
WHITE_BEYOND = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def _compile_splitter() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Next state, "a word starts here", "a word started one character ago"; by state and class."""
    step = np.zeros((N_STATES, N_CLASSES), np.uint8)
    here = np.zeros((N_STATES, N_CLASSES), bool)
    back = np.zeros((N_STATES, N_CLASSES), bool)
    letters = {LETTER, ONE, TWO, E, L}
    run = {**dict.fromkeys(letters, IN_LETTERS), NUMBER: IN_NUMBERS, OTHER: IN_OTHER, QUOTE: IN_OTHER}
    for s in range(N_STATES):
        for c in range(N_CLASSES):
            after_white = s in (SPACE_1, SPACE_N, WHITE_1, WHITE_N)
            if c == END:
                step[s, c], back[s, c] = START, s in (QUOTED_TWO, QUOTED_L)
            elif c in (SPACE, WHITE):
                step[s, c] = (SPACE_N if c == SPACE else WHITE_N) if after_white else (SPACE_1 if c == SPACE else WHITE_1)
                here[s, c], back[s, c] = not after_white, s in (QUOTED_TWO, QUOTED_L)
            elif after_white:
                # The last white character leaves its run; a space joins the word that follows.
                back[s, c] = s in (SPACE_N, WHITE_N)
                here[s, c] = s in (WHITE_1, WHITE_N)
                step[s, c] = QUOTED if c == QUOTE and here[s, c] else run[c]
            elif s == QUOTED and c in (ONE, TWO, L):
                step[s, c] = {ONE: CONTRACTED, TWO: QUOTED_TWO, L: QUOTED_L}[c]
            elif (s, c) in ((QUOTED_TWO, E), (QUOTED_L, L)):
                step[s, c] = CONTRACTED
            elif s in (QUOTED_TWO, QUOTED_L):
                # No contraction: the quote stood alone, and its letter began a word.
                back[s, c], here[s, c] = True, c not in letters
                step[s, c] = QUOTED if c == QUOTE else run[c]
            elif s in (IN_OTHER, QUOTED) and c in (OTHER, QUOTE):
                step[s, c] = IN_OTHER
            else:
                same = (s == IN_LETTERS and c in letters) or (s == IN_NUMBERS and c == NUMBER)
                here[s, c] = not same
                step[s, c] = QUOTED if c == QUOTE else run[c]
    return step, here, back


STEP, HERE, BACK = _compile_splitter()


def entry_states(classes: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """The state before every character: chunk maps, their prefix scan, then one pass inside the chunks."""
    n = len(classes)
    rows = -(-n // chunk) or 1
    grid = np.full(rows * chunk, END, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(rows, chunk).T)
    flat = STEP.ravel()
    maps = np.tile(np.arange(N_STATES, dtype=np.uint8), (rows, 1))
    for column in grid:
        maps = flat[maps.astype(np.intp) * N_CLASSES + column[:, None]]
    # Inclusive scan by doubling: after round k a row maps the entry of 2^k chunks before it to its exit.
    reach = 1
    while reach < rows:
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), 1)
        reach *= 2
    state = np.concatenate([[START], maps[:-1, START]]).astype(np.intp)
    out = np.empty_like(grid)
    for k, column in enumerate(grid):
        out[k] = state
        state = flat[state * N_CLASSES + column].astype(np.intp)
    return out.T.reshape(-1)[:n]


def word_starts(classes: np.ndarray) -> np.ndarray:
    """True where a word, or the END that closes a text, begins."""
    states = entry_states(classes)
    start = HERE[states, classes]
    start[:-1] |= BACK[states[1:], classes[1:]]
    return start | (classes == END)


class Tokenizer:
    """The compiled form of one vocabulary file; made once in each worker."""

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if (spec["normalizer"], pre["type"], pre["add_prefix_space"], pre["use_regex"], spec["model"]["type"],
                spec["model"]["ignore_merges"]) != (None, "ByteLevel", False, True, "BPE", False):
            raise ValueError("not a plain byte-level BPE file")
        self.specials = [t["content"] for t in spec["added_tokens"]]
        raw = _bytes_of_letters()
        ids = {bytes(raw[c] for c in t): i for t, i in spec["model"]["vocab"].items()}
        #: Rank of a pair, and by token: the rank at which it is made (-1: a byte), its left and its right part.
        self.rank: dict[tuple[int, int], int] = {}
        n = max(ids.values()) + 1
        self.made, self.left, self.right = [-1] * n, [-1] * n, [-1] * n
        for i, m in enumerate(spec["model"]["merges"]):
            x, y = (bytes(raw[c] for c in t) for t in (m if isinstance(m, list) else m.split(" ")))
            x, y, z = ids[x], ids[y], ids[x + y]
            self.rank[x, y] = i
            if self.made[z] < 0:
                self.made[z], self.left[z], self.right[z] = i, x, y
        # The vocabulary as a trie: nodes by (node, byte), and the token that ends at a node.
        self.node: dict[int, int] = {}
        self.token, self.inner = [-1], [True]
        for t, i in ids.items():
            at = 0
            for k, byte in enumerate(t):
                at = self.node.setdefault(at << 8 | byte, len(self.token))
                if at == len(self.token):
                    self.token.append(-1), self.inner.append(False)
                if k + 1 < len(t):
                    self.inner[at] = True
            self.token[at] = i
        self.probe = pre_tokenizers.ByteLevel(add_prefix_space=False)
        self.class_of = np.full(0x110000, 255, np.uint8)
        self.words: dict[bytes, int] = {}
        self._forget()

    # The splitter's alphabet.

    def classes(self, codes: np.ndarray) -> np.ndarray:
        found = self.class_of[codes]
        if (found == 255).any():
            for c in np.unique(codes[found == 255]):
                self.class_of[c] = self._class(int(c))
            found = self.class_of[codes]
        return found

    def _class(self, code: int) -> int:
        ch = chr(code)
        special = {"'": QUOTE, " ": SPACE, "e": E, "l": L, "r": TWO, "v": TWO, **dict.fromkeys("stmd", ONE)}
        if ch in special:
            return special[ch]
        if 9 <= code <= 13 or code in WHITE_BEYOND:
            return WHITE
        kind = unicodedata.category(ch)
        if kind == "Cn":  # newer than Python's tables: ask the library which run it joins
            for before, cls in (("a", LETTER), ("1", NUMBER)):
                if len(self.probe.pre_tokenize_str(before + ch)) == 1:
                    return cls
            return OTHER
        return {"L": LETTER, "N": NUMBER}.get(kind[0], OTHER)

    # The merger.

    def _forget(self) -> None:
        #: A state: the open vocabulary prefixes, each with the token before it and the count there.
        root = ((-1, 0, 0),)
        self.states, self.number = [root], {root: 0}
        self.moves: dict[int, tuple[int, int]] = {}

    def _neighbours(self, x: int, y: int) -> bool:
        """Whether x and y stay apart: their merges are undone, last first, and no earlier pair may join over the gap."""
        if x < 0:
            return True
        limit = len(self.rank)
        while True:
            # A pair of the rank of the merge that took its left part is later, of its right part earlier: leftmost first.
            if self.rank.get((x, y), limit) < limit:
                return False
            if self.made[x] > self.made[y]:
                limit, x = self.made[x], self.right[x]
            elif self.made[y] >= 0:
                limit, y = self.made[y] + 1, self.left[y]
            else:
                return True

    def _move(self, state: int, byte: int) -> tuple[int, int]:
        """The state after ``byte``, and by how much the number of tokens so far changes."""
        open_, last, count = [], -1, 0
        for before, prefix, n in self.states[state]:
            longer = self.node.get(prefix << 8 | byte)
            if longer is None:
                continue
            token = self.token[longer]
            if last < 0 and token >= 0 and self._neighbours(before, token):
                last, count = token, n + 1
            if self.inner[longer]:
                open_.append((before, longer, n))
        after = (*((b, p, n - count) for b, p, n in open_), (last, 0, 0))
        number = self.number.setdefault(after, len(self.states))
        if number == len(self.states):
            self.states.append(after)
        move = self.moves[state << 8 | byte] = (number, count)
        return move

    def word(self, raw: bytes) -> int:
        if len(self.states) > STATES:
            self._forget()
        state = total = 0
        for byte in raw:
            state, change = self.moves.get(state << 8 | byte) or self._move(state, byte)
            total += change
        return total

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        parts, owner, totals = [], [], [0] * len(texts)
        for i, text in enumerate(texts):
            split = [text]
            for s in self.specials:
                split = [x for t in split for x in (t.split(s) if s in t else (t,))]
            totals[i] = len(split) - 1
            parts += split
            owner += [i] * len(split)
        joined = "\0".join(parts) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        cls = self.classes(codes).copy()
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        cls[ends] = END
        at = np.flatnonzero(word_starts(cls))
        width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        edge = np.concatenate([[0], np.cumsum(width)])[at].tolist()
        raw = joined.encode("utf-8", "surrogatepass")
        words = [raw[a:b] for a, b in zip(edge, edge[1:])]
        closing = cls[at[:-1]] == END
        known = self.words
        found = list(map(known.get, words))
        for k, n in enumerate(found):
            if n is None:
                word = words[k]
                n = known.get(word)
                if n is None:
                    n = self.word(word)
                    if len(known) < WORDS:
                        known[word] = n
                found[k] = n
        counts = np.array([*found, 0], np.int64)
        counts[:-1][closing] = 0
        running = np.cumsum(counts)
        stop = running[np.searchsorted(at, ends)]
        for i, n in zip(owner, np.diff(stop, prepend=0).tolist()):
            totals[i] += n
        return totals


def _bytes_of_letters() -> dict[str, int]:
    """Byte-level files spell a printable Latin-1 byte as itself, and the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@cache
def tokenizer(name: str) -> Tokenizer:
    return Tokenizer(tokenizer_path(name))


def count_tokens(docs: DataFrame, name: str = "byte_bpe_50k.json", limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""

    def rows(piece: pa.RecordBatch) -> list:
        texts = [t or "" for t in piece.column("text").to_pylist()]
        counts = tokenizer(name).count(texts)
        return [
            pa.array([len(t.encode()) for t in texts], pa.int64()),
            pa.array(counts, pa.int64()),
            pa.array([c > limit for c in counts], pa.bool_()),
        ]

    return map_texts(docs, "n_bytes long, n_tokens long, over_limit boolean", rows)
