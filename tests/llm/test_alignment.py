"""Alignment of two tokenizers against whole encodings and plain loops."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quayside.llm import token_alignment
from quayside.llm.queries import QUERIES, TOKENIZERS

A, B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
FOLDER = "/root/testdata/sf0.001"


def aligned(text, a, b, points):
    """``n_a, n_b, groups text, links`` of one text, encoded whole."""
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    named = [bytes(points[c] for c in a.id_to_token(i)) for i in ids[0]], []
    for i in ids[1]:
        piece = b.id_to_piece(i)
        named[1].append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
    want = (" " + text).encode()
    if any(b"".join(side) != want for side in named):
        return 0, 0, "", []
    ends = [np.cumsum([len(x) for x in side]).tolist() for side in named]
    owner = [k for k, x in enumerate(named[1]) for _ in x]
    links, at = [], 0
    for i, x in zip(ids[0], named[0]):
        links += [(i, ids[1][k]) for k in sorted(set(owner[at : at + len(x)]))]
        at += len(x)
    told, lo = [], [0, 0]
    for cut in sorted(set(ends[0]) & set(ends[1])):
        hi = [e.index(cut) + 1 for e in ends]
        told.append("|".join(",".join(map(str, i[x:y])) for i, x, y in zip(ids, lo, hi)))
        lo = hi
    return len(ids[0]), len(ids[1]), ";".join(told), links


def expected(rows):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    points = token_alignment._byte_points()
    done = [aligned(t, a, b, points) if t else (0, 0, "", []) for _, t in rows]
    counts = Counter(link for *_, links in done for link in links)
    most = Counter()
    for (_, piece), n in counts.items():
        most[piece] = max(most[piece], n)
    out = []
    for (key, _), (n_a, n_b, groups, links) in zip(rows, done):
        best = sum(counts[link] == most[link[1]] for link in links)
        sha = hashlib.sha256(groups.encode()).hexdigest() if links else ""
        out.append((key, n_a, n_b, groups.count("|") if links else 0, len(links), best, sum(counts[x] for x in links), sha))
    return Counter(out)


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def got(frame):
    return Counter((r["doc_id"], *(r[c] for c in COLUMNS)) for r in frame.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    alphabet = " \n\t\r  ab'sé漢字▁<s>1 ;. 　\xa0\x00😀"
    made = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(50)))) for i in range(400)]
    words = ["the", "naïve", "token's", "x" * 40, "1234", "", "  ", "<|endoftext|>", "<unk>", "</s>", "▁"]
    made += [(1000 + i, " ".join(rng.choice(words[:8]) for _ in range(rng.randrange(30)))) for i in range(100)]
    made += [(None, None), (None, "no key"), (2000, ""), (2001, " "), (2002, "a "), (2003, "a  "), (2004, "\n"), (2005, "again"), (2005, "again"), (2006, " ".join(words))]
    return [*made, (2007, "=" * 5000 + " " + "字" * 3000), (2008, "word " * 20_000)]


@pytest.mark.parametrize("chunk, known, batch", [(4_000_000, 300_000, 500_000), (500, 50, 40)])
def test_against_whole_encodings(spark, rows, monkeypatch, chunk, known, batch):
    monkeypatch.setattr(token_alignment, "CHUNK_CHARS", chunk), monkeypatch.setattr(token_alignment, "KNOWN_UNITS", known)
    monkeypatch.setattr(token_alignment, "NEW_CHARS", batch)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(token_alignment.align_corpus(docs, A, B)) == expected(rows)


def test_units_that_come_and_go(rows):
    """A worker that forgets most of its units gives the same counts as one that keeps them."""
    tokenizers = token_alignment.load(A, B)
    keep, lose = token_alignment.Units(tokenizers), token_alignment.Units(tokenizers)
    told = lambda units, numbers: [(units.texts[n], tuple(units.counts.all()[n]), tuple(units.links.all()[units.begin[n] : units.begin[n + 1]])) for n in numbers]
    for _ in range(2):
        for at in range(0, len(rows), 16):
            texts = [t for _, t in rows[at : at + 16]]
            one, two = keep.of_texts(texts), lose.of_texts(texts)
            assert [told(keep, x) for x in one] == [told(lose, x) for x in two]
            np.add.at(lose.uses.all(), [n for x in two for n in x], 1)
            lose.forget()


def test_query_against_whole_encodings(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op13_token_alignment"](spark, FOLDER)) == expected(rows)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id string, text string, chunk int, pairs string, part long, k int")
    assert token_alignment.align_corpus(empty, A, B).count() == 0
    one = spark.createDataFrame([("x", "hello there", 1, "p", 2, 3)], empty.schema)
    assert got(token_alignment.align_corpus(one, A, B)) == expected([("x", "hello there")])


def test_links_and_groups_of_texts(spark, rows):
    docs = spark.createDataFrame(rows[:200], "doc_id long, text string")
    texts = dict(rows[:200])
    for r in token_alignment.align_texts(docs, A, B).collect():
        t = token_alignment.load(A, B)
        if not r["a_ids"]:
            continue
        assert sum(link["bytes"] for link in r["overlaps"]) == len((" " + texts[r["doc_id"]]).encode())
        for group in r["groups"][1:]:
            before = sum(t.long_a[r["a_ids"][: group["first_a"]]]), sum(t.long_b[r["b_ids"][: group["first_b"]]])
            assert before[0] == before[1] > 0


@pytest.mark.parametrize("products", [1, 7, 10**6])
def test_row_products(products):
    rng = np.random.default_rng(4)
    a, b = rng.random((9, 6)) < 0.4, rng.random((6, 7)) < 0.4
    csr = lambda m: token_alignment.Csr(np.append(0, np.cumsum(m.sum(axis=1))), np.nonzero(m)[1], m.shape[1])
    out = np.zeros((9, 7), int)
    for row, column, value in token_alignment.gustavson(csr(a), csr(b), products):
        out[row, column] += value
    assert (out == a.astype(int) @ b.astype(int)).all()
    turned = csr(a).transpose()
    assert [sorted(turned.indices[x:y]) for x, y in zip(turned.indptr, turned.indptr[1:])] == [np.nonzero(c)[0].tolist() for c in a.T]
