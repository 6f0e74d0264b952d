"""Token counts and pieces against the libraries."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from caselens.llm import pieces, token_counts
from caselens.llm.common import tokenizer_path

SF = "/root/testdata/sf0.001"
BITS = ["'s", "'re", "'", "l", "ll", " ", "  ", "\n", "\t", "a", "é", "1", "٣", "!", "<|endoftext|>", " ", "the", "'ve", "　",
        "漢", "𝕏", "\x00", "_", "▁", "'d", "r", "e", "🎉", " ", "\U0001c89a", "<s>", "</s>", "<0x0A>", "ß", "."]


@pytest.fixture(scope="module")
def texts():
    import pyarrow.parquet as pq

    rng = random.Random(4)
    fuzz = ["".join(rng.choice(BITS) for _ in range(rng.randrange(14))) for _ in range(3000)]
    fuzz += ["".join(rng.choice("aaabeinstr ") for _ in range(rng.randrange(40))) for _ in range(1000)]
    long_ = ["a" * 20_000, "ab " * 20_000, " " * 5000, "\x00" * 300, "x" * 70 + "漢" * 3000]
    return pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist() + fuzz + long_ + [None, ""]


def table(spark, texts):
    return spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")


def test_counts_are_the_librarys(spark, texts):
    lib = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    want = [len(e.ids) for e in lib.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for r in token_counts.count_tokens(table(spark, texts)).collect():
        n = want[r["doc_id"]]
        assert (r["n_tokens"], r["over_limit"], r["n_bytes"]) == (n, n > 512, len((texts[r["doc_id"]] or "").encode()))


def test_forgetting_changes_nothing(texts, monkeypatch):
    path = tokenizer_path("byte_bpe_50k.json")
    want = token_counts.Tokenizer(path).count([t or "" for t in texts[:400]])
    monkeypatch.setattr(token_counts, "STATES", 50)
    monkeypatch.setattr(token_counts, "WORDS", 3)
    assert token_counts.Tokenizer(path).count([t or "" for t in texts[:400]]) == want


def test_scan_of_chunks_is_a_walk():
    rng = np.random.default_rng(5)
    classes = rng.integers(0, token_counts.N_CLASSES, 5000).astype(np.uint8)
    state, walked = token_counts.START, []
    for c in classes:
        walked.append(state)
        state = token_counts.STEP[state, c]
    for chunk in (1, 7, 64, 9000):
        assert token_counts.entry_states(classes, chunk).tolist() == walked


def test_pieces_are_the_librarys(spark, texts):
    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    ids = [lib.encode(t or "", add_eos=True) for t in texts]
    want = {i: (len(x), sha(" ".join(map(str, x))), sha(lib.decode(x))) for i, x in enumerate(ids)}
    docs = table(spark, texts)
    assert {r["doc_id"]: tuple(r)[1:4] for r in pieces.digest(docs).collect()} == want
    told = pieces.token_ids(docs).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids"], r["decoded_sha256"]) for r in told} == {i: (w[0], ids[i], w[2]) for i, w in want.items()}
    assert all(len(r["ends"]) == r["n_tokens"] for r in told)
    assert pieces.digest(docs.limit(0)).count() == 0


def test_spans_follow_the_text(texts):
    model = pieces.pieces_of("piece_bpe_32k.model")
    for text in texts[:1500]:
        raw = (text or "").encode()
        spans = model.spans(text or "")
        assert [s[2] for s in spans[1:]] == [s[3] for s in spans[:-1]]
        for _, name, a, b in spans:
            if not name.startswith("<0x"):
                assert raw[a:b].decode().replace(" ", "▁") in (name, name[1:])
        assert not spans or (spans[0][2], spans[-1][3]) == (0, len(raw))


def test_longest_prefix_of_a_compiled_map():
    lib = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    from sentencepiece import sentencepiece_model_pb2 as proto

    spec = proto.ModelProto.FromString(lib.serialized_model_proto()).normalizer_spec
    normal = pieces.Normalizer(pieces.read_character_map(spec.precompiled_charsmap), dummy_prefix=False)
    for text in ("ﬁn ① ㌔", "ＡＢＣ é", "ｶﾞ x", "é Å", "漢字", "½"):
        made, origin = normal(text)
        assert made == lib.normalize(text).removeprefix("▁")
        assert len(origin) == len(made.encode()) + 1 and (np.diff(origin) >= 0).all() and origin[-1] == len(text.encode())


def test_whole_encoding_with_a_compiled_map():
    """A model that normalises by NFKC: ids equal the library's, and come from the text normalised here."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as file:
        spec = proto.ModelProto.FromString(file.read())
    rule = sentencepiece.SentencePieceNormalizer(rule_name="nfkc")
    spec.normalizer_spec.precompiled_charsmap = proto.ModelProto.FromString(rule.serialized_model_proto()).normalizer_spec.precompiled_charsmap
    blob = spec.SerializeToString()
    lib, mine = sentencepiece.SentencePieceProcessor(model_proto=blob), pieces.Pieces(blob)
    for text in ("The ﬁne print costs ½ of ① coin.", "ＡＢＣ  ｶﾞ é Å ㌔", "plain  text\n", "", "▁ ﬃ", "漢字 ﷺ"):
        ids, ends = mine.encode(text)
        assert ids == lib.encode(text) and len(ends) == len(ids)
        assert list(ends) == sorted(ends) and (not ids or ends[-1] == len(text.encode()))
    plain = pieces.Pieces(blob)
    plain.normalise = pieces.Normalizer({})
    assert plain.encode("ＡＢＣ")[0] != mine.encode("ＡＢＣ")[0]


def test_pieces_of_odd_rows(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    long_ = "word ▁ é\n" * 250_000
    rows = [(1, None, 1), (1, "", 2), (None, "a  b\x00c", 3), (2, long_, 4), (3, "same", 5), (3, "same", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = sorted((r["n_tokens"] for r in pieces.token_ids(docs, ("doc_id",)).collect()))
    assert got == sorted(len(lib.encode(t or "", add_eos=True)) for _, t, _ in rows)
    assert pieces.token_ids(docs.limit(0)).count() == 0
