"""Each stage on what its predecessor kept, against plain versions."""

from __future__ import annotations

from collections import Counter

import sentencepiece
from test_jaccard import brute
from test_mixing import draws
from test_secrets import plain_base

import corpus_pipeline
from caselens.llm import mixing, quality, secrets
from caselens.llm.common import tokenizer_path

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = STAGES["quality_rules"](spark, docs, SF)
    want = {r["doc_id"] for r in quality.judge(docs, labels).where("kept").collect()}
    assert good.columns == docs.columns and {r["doc_id"] for r in good.collect()} == want and len(want) > 100

    single = STAGES["near_duplicates"](spark, good, SF)
    rows = {r["doc_id"]: r for r in good.collect()}
    keep = {d for d, n, c in brute([(d, r["text"]) for d, r in rows.items()]) if c == d}
    assert sorted(single.collect()) == sorted(rows[d] for d in keep)

    clean = STAGES["secret_scan"](spark, single, SF)
    assert clean.columns == docs.columns
    for r in clean.collect():
        assert not plain_base(r["text"]) and r["n_chars"] == len(r["text"])
        if not secrets.scan(single.where(f"doc_id = {r['doc_id']}")).first()["spans"] if r["doc_id"] % 40 == 0 else False:
            assert r["text"] == rows[r["doc_id"]]["text"]

    mixed = STAGES["mixture"](spark, clean, SF)
    sizes = mixing.sizes_of(clean)
    assert mixed.columns == docs.columns
    rate = {r["source"]: r["rate"] for r in mixing.rates(sizes, mixing.tempered_shares(sizes)).collect()}
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    got = Counter(r["doc_id"] for r in mixed.collect())
    assert got == +Counter({r["doc_id"]: draws(rate[r["source"]], str(r["doc_id"])) for r in clean.collect()})

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    out = STAGES["encoding"](spark, mixed, SF).collect()
    assert Counter(r["doc_id"] for r in out) == got
    for r in out:
        assert r["ids"] == model.encode(texts[r["doc_id"]], add_eos=True) and r["n_tokens"] == len(r["ids"])


def test_near_duplicates_keep_odd_rows(spark):
    text = "one two three four five six seven eight"
    rows = [(3, text, "a"), (3, text, "a"), (1, text + " ", "b"), (None, text, "c"), (4, None, None), (4, None, None), (5, " ", "d"),
            (None, "alone here", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    got = sorted(map(tuple, STAGES["near_duplicates"](spark, docs, SF).collect()), key=str)
    assert got == sorted([(1, text + " ", "b"), (4, None, None), (4, None, None), (5, " ", "d"), (None, "alone here", "e")], key=str)


def test_empty_tables_go_through(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        docs = out if out.columns == docs.columns else docs
