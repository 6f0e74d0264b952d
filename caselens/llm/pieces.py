"""SentencePiece encoding that keeps where every piece came from, and decoding.

A text is normalised first.  The model's compiled character map (a double-array trie and
a pool of replacements) is read into a table; at each place the longest key that matches
is replaced, a character without a key stays, and every normalised byte notes the
original byte it came from.  Spaces become the space mark, and one mark is put in front.

The merges are the library's: it gets the normalised text, by a copy of the model whose own
normaliser is switched off.  The lengths of the pieces, laid along the alignment, give each
piece its span of original bytes.

A null text counts as empty: it has the end id alone, and decodes to nothing.  Repeated
rows are encoded one by one; an empty table gives no rows; a text of any length is encoded
whole.  Columns other than ``doc_id`` and ``text`` (and those asked to be kept) are not read
and may have any name.
"""

from __future__ import annotations

import hashlib
import struct
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from caselens.llm.common import map_texts, tokenizer_path

MARK = "▁"


def read_character_map(blob: bytes) -> dict[bytes, bytes]:
    """Key -> replacement, by walking the double array of a compiled map (empty: none)."""
    if not blob:
        return {}
    (size,) = struct.unpack_from("<I", blob)
    units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
    pool = blob[4 + size :]
    offset = lambda u: (u >> 10) << ((u & (1 << 9)) >> 6)
    out, todo = {}, [(0, b"")]
    while todo:
        at, key = todo.pop()
        base = at ^ offset(units[at])
        if key and units[at] >> 8 & 1:
            start = units[base] & 0x7FFFFFFF
            out[key] = pool[start : pool.index(b"\0", start)]
        todo += [(base ^ c, key + bytes((c,))) for c in range(1, 256)
                 if base ^ c < len(units) and units[base ^ c] & 0x800000FF == c]
    return out


class Normalizer:
    def __init__(self, table: dict[bytes, bytes], dummy_prefix: bool = True):
        self.table, self.prefix = table, dummy_prefix
        self.longest = max(map(len, table), default=0)
        self.first = {k[0] for k in table}

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and the original byte of each of its bytes (and of its end)."""
        if not text:
            return "", np.zeros(1, np.int64)
        if not self.table:
            return (MARK if self.prefix else "") + text.replace(" ", MARK), self.aligned(text)
        raw, at = text.encode(), 0
        out, origin = (bytearray(MARK.encode()), [0, 0, 0]) if self.prefix else (bytearray(), [])
        while at < len(raw):
            new, n = None, 0
            if raw[at] in self.first:
                for n in range(min(self.longest, len(raw) - at), 0, -1):
                    if (new := self.table.get(raw[at : at + n])) is not None:
                        break
            if new is None:
                n = 1 + (raw[at] >= 0xC0) + (raw[at] >= 0xE0) + (raw[at] >= 0xF0)
                new = raw[at : at + n]
                steps = range(at, at + n)
            else:
                steps = [at] * len(new)
            if b" " in new:
                steps = [o for b, o in zip(new, steps) for _ in range(3 if b == 32 else 1)]
                new = new.replace(b" ", MARK.encode())
            out += new
            origin += steps
            at += n
        return out.decode(), np.array([*origin, len(raw)], np.int64)

    def aligned(self, text: str) -> np.ndarray:
        """The alignment of a text of which every character stays: a space stands for three bytes of its mark."""
        raw = np.frombuffer(text.encode(), np.uint8)
        return np.concatenate([np.zeros(3 * (self.prefix and len(raw) > 0), np.int64),
                               np.repeat(np.arange(len(raw)), np.where(raw == 32, 3, 1)), [len(raw)]])


class Pieces:
    """One model, given by the bytes of its file; made once in each worker."""

    def __init__(self, blob: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        self.model = sentencepiece.SentencePieceProcessor(model_proto=blob)
        spec = proto.ModelProto.FromString(blob)
        norm = spec.normalizer_spec
        if norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("the normaliser of this model drops or keeps spaces; only the marked kind is read here")
        self.normalise = Normalizer(read_character_map(norm.precompiled_charsmap), norm.add_dummy_prefix)
        names = [p.piece for p in spec.pieces]
        # The same pieces and merges for a text that is normalised already.
        norm.name, norm.precompiled_charsmap = "identity", b""
        norm.add_dummy_prefix = norm.escape_whitespaces = False
        self.merger = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        byte = [p.type == proto.ModelProto.SentencePiece.BYTE for p in spec.pieces]
        self.names, self.end = names, self.model.eos_id()
        self.lengths = np.array([1 if b else len(n.encode()) for n, b in zip(names, byte)])
        self.spelled = [str(i) for i in range(len(names))]

    def encode(self, text: str) -> tuple[list[int], np.ndarray]:
        """Ids without a begin or end, and where their pieces end among the original bytes."""
        normal, origin = self.normalise(text)
        ids = self.merger.encode(normal)
        return ids, origin[np.cumsum(self.lengths[ids])] if ids else np.zeros(0, np.int64)

    def spans(self, text: str) -> list[tuple[int, str, int, int]]:
        """Every piece with its id and its span of original bytes."""
        ids, ends = self.encode(text)
        return [(i, self.names[i], a, b) for i, a, b in zip(ids, [0, *ends.tolist()], ends.tolist())]


@cache
def pieces_of(name: str) -> Pieces:
    with open(tokenizer_path(name), "rb") as file:
        return Pieces(file.read())


def encode(docs: DataFrame, name: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, ids (with the end id), spans of original bytes (one start and one end per id), decoded text."""

    def rows(piece: pa.RecordBatch) -> list:
        model = pieces_of(name)
        ids_out, starts_out, ends_out, decoded = [], [], [], []
        for text in piece.column("text").to_pylist():
            found = model.spans(text or "")
            size = len((text or "").encode())
            ids_out.append([*(f[0] for f in found), model.end])
            starts_out.append([*(f[2] for f in found), size])
            ends_out.append([*(f[3] for f in found), size])
            decoded.append(model.model.decode(ids_out[-1]))
        kind = pa.list_(pa.int32())
        return [pa.array(ids_out, kind), pa.array(starts_out, kind), pa.array(ends_out, kind), pa.array(decoded)]

    return map_texts(docs, "ids array<int>, starts array<int>, ends array<int>, decoded string", rows)


def digest(docs: DataFrame, name: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids as text, of the decoded text, and of the spans' ends."""

    def rows(piece: pa.RecordBatch) -> list:
        model = pieces_of(name)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        counts, ids_sha, text_sha, ends_sha = [], [], [], []
        for text in piece.column("text").to_pylist():
            text = text or ""
            ids, ends = model.encode(text)
            ids.append(model.end)
            counts.append(len(ids))
            ids_sha.append(sha(" ".join([model.spelled[i] for i in ids]).encode()))
            text_sha.append(sha(model.model.decode(ids).encode()))
            ends_sha.append(sha(ends.astype("<i8").tobytes()))
        return [pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha), pa.array(ends_sha)]

    return map_texts(
        docs, "n_tokens long, ids_sha256 string, decoded_sha256 string, span_ends_sha256 string", rows
    )


def token_ids(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), name: str = "piece_bpe_32k.model") -> DataFrame:
    """``keep``, n_tokens, ids (with the end id), where each piece ends in the original bytes, and the decoded text's SHA-256."""

    def rows(piece: pa.RecordBatch) -> list:
        model = pieces_of(name)
        counts, ids_out, ends_out, decoded = [], [], [], []
        for text in piece.column("text").to_pylist():
            ids, ends = model.encode(text or "")
            ids.append(model.end)
            counts.append(len(ids))
            ids_out.append(ids)
            ends_out.append([*ends.tolist(), len((text or "").encode())])
            decoded.append(hashlib.sha256(model.model.decode(ids).encode()).hexdigest())
        kind = pa.list_(pa.int32())
        return [pa.array(counts, pa.int64()), pa.array(ids_out, kind), pa.array(ends_out, kind), pa.array(decoded, pa.string())]

    return map_texts(docs, "n_tokens long, ids array<int>, ends array<int>, decoded_sha256 string", rows, keep)
