"""Tables, scans over chunks and edits against a plain search, and odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import groupby

import numpy as np
import pytest

from caselens.llm import repair

WS = "\x20\t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if how == 0:
            continue
        row = (conv, turn, "user" if how == 4 else role, "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text)
        out += [row, row] if how == 3 else [row]
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2], r[3]))


def cheapest(rows):
    """All states after every row with the least (cost, letters), by relaxing one edit after the other."""
    nothing, after_s, after_u, after_a = range(4)
    keep = {(nothing, "s"): after_s, (nothing, "u"): after_u, (after_s, "u"): after_u, (after_u, "a"): after_a, (after_a, "u"): after_u}
    made = [after_u, after_u, after_a, after_u]
    name = {after_u: "user", after_a: "assistant"}

    def inserted(best):
        for _ in range(4):
            for q, (cost, letters, lines) in list(best.items()):
                to = made[q]
                way = (cost + 5, letters + "I", [*lines, f"{name[to]}:"])
                best[to] = min(best.get(to, way), way, key=lambda w: w[:2])
        return best

    best = inserted({nothing: (0, "", [])})
    for role, text, fault in rows:
        new = {}
        for q, (cost, letters, lines) in best.items():
            ways = [(q, (cost + 2, letters + "D", lines))]
            if fault in (None, "truncated"):
                extra = 5 if fault else 0
                if (to := keep.get((q, role[:1]))) is not None:
                    ways.append((to, (cost + extra, letters + "K", [*lines, f"{role}:{text}"])))
                ways.append((made[q], (cost + extra + 1, letters + "R", [*lines, f"{name[made[q]]}:{text}"])))
            for to, way in ways:
                new[to] = min(new.get(to, way), way, key=lambda w: w[:2])
        best = inserted(new)
    return min((best[q] for q in (nothing, after_a) if q in best), key=lambda w: w[:2])


def plain(rows):
    nothing = hashlib.sha256(b"").hexdigest()
    out = {conv: (0, 0, 0, 0, 0, 0, "", nothing) for conv, *_ in rows}
    for conv, part in groupby(damaged(rows), key=lambda r: r[0]):
        part, seen, told, illegal = list(part), set(), [], 0
        for i, (_, _, role, text) in enumerate(part):
            words = text.strip(WS)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else None if words[-1] in ".!?" else "truncated"
            seen.add((role, text))
            told.append((role, text, fault))
            illegal += i > 0 and part[i - 1][2][:1] + role[:1] not in ("su", "ua", "au")
        turns = [r[1] for r in part if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = [sum(f == kind for *_, f in told) for kind in ("blank", "duplicate", "truncated")]
        cost, letters, lines = cheapest(told)
        out[conv] = (gaps, *count, illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def talks(seed, convs, most):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(convs), None]:
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No", "é!", "  ", "", None, "a\nb?", "What? ", f"{turn}."])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    return rows + rng.sample(rows, len(rows) // 10)


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("chunk, fan", [(1, 2), (7, 3), (4096, 256)])
def test_equals_a_plain_search(spark, monkeypatch, chunk, fan):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    monkeypatch.setattr(repair, "FAN", fan)
    rows = talks(chunk, 60, 30)
    got = {r[0]: tuple(r)[1:] for r in repair.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == plain(rows)


def test_blocks_are_rows_one_after_the_other():
    tables, rng = repair.tables(), np.random.default_rng(1)
    assert len(tables.vector) < 200 and tables.block.shape[1] == len(repair.KINDS) ** repair.BLOCK
    for n in (0, 1, 3, 4, 9, 50):
        kinds = rng.integers(0, len(repair.KINDS), n)
        to, off = tables.chunk_map(kinds)
        for v in range(len(tables.vector)):
            costs, each = tables.vector[v], [0] * n
            for i in range(n - 1, -1, -1):
                low = min(costs)
                each[i] = tables.vector.index(tuple(c - low for c in costs))
                costs = repair.before_row(repair.KINDS[kinds[i]], costs)
            assert tuple(c + off[v] for c in tables.vector[to[v]]) == costs
            assert tables.behind(kinds, v).tolist() == each


def test_odd_rows(spark):
    rows = [(1, 0, "user", "x" * 2_000_000), (1, 1, "assistant", "y. " * 400_000), (2, None, None, None), (2, None, None, None),
            (3, 5, "user", "Hi."), (3, 5, "user", "Hi."), (3, 5, "user", "Hi."), (3, 1 << 60, "assistant", "\x00.")]
    # One conversation whose only row is dropped.
    gone = next(c for c in range(10, 1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "Hi."))
    docs = spark.createDataFrame([(*r, 1, "a", 2) for r in rows], SCHEMA + ", copy int, conv string, rank long")
    made = repair.repair(docs)
    assert {r[0]: tuple(r)[1:] for r in made.collect()} == plain(rows)
    assert plain(rows)[gone][6] == "" and repair.repair(docs.limit(0)).count() == 0


def test_a_long_conversation_is_cut_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK", 64)
    monkeypatch.setattr(repair, "FAN", 4)
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"{t}.") for t in range(4000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {r[0]: tuple(r)[1:] for r in repair.repair(docs).collect()} == plain(rows)
