"""Lattices that are kept from text to text give what fresh ones give."""

import random

import numpy as np
from pyspark.sql import functions as F

from quayside.llm import lattice, sentencepiece_topk
from quayside.llm.queries import TOKENIZERS

MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"


def texts(n):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcéö你\x01▁") for _ in range(rng.randrange(1, 9))) for _ in range(200)]
    return ["", *(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 30))) for _ in range(n))]


def same(a, b):
    return len(a) == len(b) and all(x[0].tolist() == y[0].tolist() and np.allclose(x[1:4], y[1:4]) for x, y in zip(a, b))


def test_kept_grown_and_shrunk_lattices():
    pieces = lattice.Pieces(MODEL, 1.0)
    many = texts(60)
    keys = np.arange(len(many), dtype=np.uint64) * np.uint64(104729)
    want = lattice.sample_texts(pieces, many, keys, 3, 11)
    kept = lattice.Lattice(pieces)
    for turn in range(3):
        got = []
        for at in range(0, len(many), 7):
            got += lattice.search_texts(kept, many[at : at + 7], keys[at : at + 7], 3, 11)
            if turn:
                kept.shrink(40)
                assert len(kept.number) == len(kept.first) <= 40
        assert all(map(same, got, want))
        assert all(row[4] for rows in got for row in rows)
        for text, rows in zip(many, got):
            assert all(pieces.decode(row[0]) == text.replace(lattice.BLANK, " ") for row in rows)


def test_small_batches_and_clashing_names(spark, monkeypatch):
    rows = [(i, t, "k", 7) for i, t in enumerate(texts(20))] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _text string, __key int").coalesce(1)
    once = sentencepiece_topk.sample_segmentations(df, MODEL, k=2, seed=4).collect()
    monkeypatch.setattr(sentencepiece_topk, "BATCH_CHARS", 50)
    monkeypatch.setattr(sentencepiece_topk, "KNOWN_UNITS", 10)
    out = sentencepiece_topk.sample_segmentations(df, MODEL, k=2, seed=4)
    assert out.columns == [*df.columns, "segmentations"] and out.collect() == once
    assert {r["__key"] for r in once} == {7, None}
    ids = out.select("doc_id", F.get("segmentations", F.lit(0))["ids"].alias("_ids"))
    back = {r["doc_id"]: r["decoded"] for r in sentencepiece_topk.decode_ids(ids, MODEL, "_ids").collect()}
    assert back == {i: None if t is None else t.replace(lattice.BLANK, " ") for i, t, *_ in rows}
