"""Secret scan: three fixed patterns, and windows of high Shannon entropy.

A text is searched for assignments, access keys and long hexadecimal strings.  Then
every candidate string (a maximal run of one character class) is read with a sliding
window.  The window's entropy is kept by counts: one character enters, one leaves, so
a step costs the same for a window of any width.  Windows at or above the class's
threshold are joined to spans.  A window that the allow-list covers (inside a UUID, a
well-known digest or a path of words, or around ``EXAMPLE`` or a run of the alphabet) is
left out, the other windows of its candidate are not; nor is a span given that lies inside
a span of a fixed pattern.

Null and empty texts have no span.  Offsets count code points, ends are exclusive.
Rows are looked at one by one: repeated rows give equal results, and no order, group
or source matters.  Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselens.llm.common import carried, map_texts

# The patterns and least lengths of the base kinds.
ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64", "entropy_base36")


@dataclass(frozen=True)
class CharClass:
    """A candidate's alphabet, the window read over it, and the bits per character that make it suspect."""

    kind: str
    candidate: re.Pattern
    window: int
    bits: float
    needs: tuple[re.Pattern, ...] = ()


CLASSES = (
    CharClass("entropy_hex", re.compile(r"(?<![0-9A-Za-z])[0-9a-fA-F]{20,}(?![0-9A-Za-z])"), 20, 3.0, (re.compile("[0-9]"),)),
    CharClass(
        "entropy_base64",
        re.compile(r"[A-Za-z0-9+/_=-]{24,}"),
        24,
        4.0,
        (re.compile("[0-9]"), re.compile("[A-Z]"), re.compile("[a-z]")),
    ),
    # Letters of one case with digits between them, beyond hexadecimal.
    CharClass(
        "entropy_base36",
        re.compile(r"(?<![0-9A-Za-z])(?:[a-z0-9]{24,}|[A-Z0-9]{24,})(?![0-9A-Za-z])"),
        24,
        3.5,
        (re.compile("[0-9][A-Za-z]+[0-9]"), re.compile("[g-zG-Z]")),
    ),
)

#: Random-looking but public strings; a window inside one is left out.
ALLOWED = (
    re.compile(r"(?<![0-9A-Za-z])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9A-Za-z])"),
    # Digests of the empty text: MD5, SHA-1, SHA-256.
    re.compile(
        "(?<![0-9A-Za-z])(?:d41d8cd98f00b204e9800998ecf8427e|da39a3ee5e6b4b0d3255bfef95601890afd80709"
        "|e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855)(?![0-9A-Za-z])"
    ),
    # The secret key of public manuals.
    re.compile("wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"),
)
#: A window around one of these, or around so many characters in their order, is left out.
PLACEHOLDER, ORDERED = "EXAMPLE", 10
_AFTER_NINE = "aA"
_PART = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9]")
_WORD = re.compile(r"[A-Z]{0,3}[a-z]+(?:[A-Z]{1,3}[a-z]{2,})*[A-Z]{0,3}|[A-Z]+")
_LAST = re.compile(r"[A-Za-z]*?[0-9]{1,8}")
LONGEST_WORD = 23


def paths(run: str) -> list[tuple[int, int]]:
    """Stretches of words with a slash, dash or underscore between them; the last may end in a number."""
    found, start, end = [], None, 0
    for m in _PART.finditer(run):
        part = m[0]
        if part in "/_-":
            start = m.start() if start is None else start
            end = m.end()
            continue
        letters = part.rstrip("0123456789")
        word = len(letters) <= LONGEST_WORD and (not letters or _WORD.fullmatch(letters))
        if word and letters == part:
            start = m.start() if start is None else start
            end = m.end()
            continue
        if start is not None:
            found.append((start, m.end() if part == "=" or word and _LAST.fullmatch(part) else end))
        start = None
    return found + ([(start, end)] if start is not None else [])


def in_sequence(run: str) -> list[tuple[int, int]]:
    """Every ``ORDERED`` characters that follow each other in the alphabet, the digits, or the hexadecimal digits."""
    found, begin = [], 0
    for i in range(1, len(run) + 1):
        if i - begin >= ORDERED:
            found.append((i - ORDERED, i))
        if i < len(run) and not (ord(run[i]) == ord(run[i - 1]) + 1 or run[i - 1] == "9" and run[i] in _AFTER_NINE):
            begin = i
    return found


def left_out(run: str) -> Callable[[int, int], bool] | None:
    """Whether a window of the run is inside an allowed stretch or holds a public one; None if no window is."""
    around = [m.span() for p in ALLOWED for m in p.finditer(run)] + paths(run)
    within = [m.span() for m in re.finditer(PLACEHOLDER, run)] + in_sequence(run)
    if not around and not within:
        return None
    far, near = [0] * (len(run) + 1), [len(run) + 1] * (len(run) + 1)
    for a, b in around:
        far[a] = max(far[a], b)
    for a, b in within:
        near[a] = min(near[a], b)
    # The farthest end of a stretch that begins at a place or before it, the nearest of one that begins there or after.
    far, near = list(accumulate(far, max)), list(accumulate(near[::-1], min))[::-1]
    return lambda a, b: b <= far[a] or near[a] <= b


def suspect_windows(
    text: str, window: int, bits: float, skip: Callable[[int, int], bool] | None = None
) -> list[tuple[int, int]]:
    """Joined spans of the windows whose entropy reaches ``bits``, without those to ``skip``; a window's sum of c*log2(c)
    is updated, not recounted."""
    plogp = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    most = window * (math.log2(window) - bits) + 1e-9
    for end, new in enumerate(text, 1):
        c = counts.get(new, 0)
        counts[new] = c + 1
        total += plogp[c + 1] - plogp[c] if c < window else 0.0
        if end > window:
            old = text[end - window - 1]
            c = counts[old]
            counts[old] = c - 1
            total += plogp[c - 1] - plogp[min(c, window)]
        if end >= window and total <= most and not (skip and skip(end - window, end)):
            if spans and spans[-1][1] >= end - window:
                spans[-1][1] = end
            else:
                spans.append([end - window, end])
    return [(a, b) for a, b in spans]


def base_spans(text: str) -> list[tuple[int, str, int]]:
    found = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # The whole runs of 24 and more: a shorter run holds none.
    found += [(m.start(), "hex", m.end()) for m in LONG_HEX.finditer(text)]
    return in_order(found)


LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % LEAST["hex"])
_RANK = {k: i for i, k in enumerate(KINDS)}


def in_order(spans: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    return sorted(spans, key=lambda s: (s[0], _RANK[s[1]], s[2]))


def entropy_spans(text: str, known: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    found = []
    for cls in CLASSES:
        for m in cls.candidate.finditer(text):
            run = m[0]
            if not all(p.search(run) for p in cls.needs):
                continue
            for a, b in suspect_windows(run, cls.window, cls.bits, left_out(run)):
                a, b = a + m.start(), b + m.start()
                if not any(s <= a and b <= e for s, _, e in known):
                    found.append((a, cls.kind, b))
    return found


def spelled(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans: list[tuple[int, str, int]], mask: str = "[secret]") -> str:
    """The text with every span, or run of overlapping spans, replaced by ``mask``."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]]) if spans else text


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per document: the number of spans of each base kind, the base spans, all spans, and the text without them
    (null where it has none)."""

    def rows(piece: pa.RecordBatch) -> list:
        counts: dict[str, list[int]] = {k: [] for k in ("assign", "access", "hex")}
        base_out, all_out, clean = [], [], []
        for text in piece.column("text").to_pylist():
            text = text or ""
            base = base_spans(text)
            every = in_order(base + entropy_spans(text, base))
            for k in counts:
                counts[k].append(sum(kind == k for _, kind, _ in base))
            base_out.append(spelled(base))
            all_out.append(spelled(every))
            clean.append(redact(text, every) if every else None)
        return [*(pa.array(c, pa.int64()) for c in counts.values()), pa.array(base_out, pa.string()),
                pa.array(all_out, pa.string()), pa.array(clean, pa.string())]

    return map_texts(
        docs, "n_assign long, n_access long, n_hex long, base_spans string, spans string, redacted string", rows, keep
    )


def masked(docs: DataFrame) -> DataFrame:
    """The table with every secret in ``text`` replaced, and ``n_chars``, if there is one, counted again."""
    named, names, back = carried(docs)
    found = scan(named, names).withColumn("text", F.coalesce("redacted", "text"))
    if "n_chars" in docs.columns:
        own = names[docs.columns.index("n_chars")]
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn(own, F.when(F.col("redacted").isNotNull(), F.length("text").cast(kind)).otherwise(F.col(own)))
    return back(found)
