"""Ranked search against a plain one that scores every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from starload.llm import lexical as lx

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _plain(docs, items, top=10):
    """(item position, rank, doc, score) of a full scoring."""
    held = [(d, Counter(_terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    out = []
    for item, text in items:
        rows = []
        for d, c in held:
            m = 100 - 75 + (75 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
                        for w in _terms(text) if w in c)
            if score > 0:
                rows.append((-score, d is None, d or 0))
        out += [(item, k, None if no else d, -s) for k, (s, no, d) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out, key=str)


def _got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def _sample(seed, n=300):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)] + ["Größe", "élan", "AB", "ab", "x9", "日本"]
    docs = [(k, rng.choice([" ", ", ", "_"]).join(rng.choices(words, k=rng.choice([3, 10, 60])))) for k in range(n)]
    docs += [(1000 + k, docs[5][1]) for k in range(40)]  # ties by the dozen
    items = [(k, " ".join(rng.choices(words, k=rng.choice([1, 4, 30, 150])))) for k in range(25)]
    return docs, items


@pytest.mark.parametrize("block", [4096, 16])
def test_ranks_match_a_full_scoring(spark, written, monkeypatch, block):
    docs, items = _sample(3)
    docs += [(None, "w1 w2 AB"), (None, None), (2000, ""), (2001, " .,;"), (7, docs[7][1])]
    items += [(90, None), (91, "..."), (92, "nirgends"), (None, "w1 w3 ab"), (3, items[3][1]), (93, "AB ab aB Ab")]
    want = _plain(docs, items)
    a = spark.read.parquet(written([(d, t, 1, "x") for d, t in docs], "id BIGINT, text STRING, score INT, item STRING", 6))
    b = spark.createDataFrame(items, "id BIGINT, text STRING")
    monkeypatch.setattr(lx, "_Block", type("Small", (lx._Block,), {"full": lambda self: len(self.ids) >= block}))
    assert _got(lx.search(spark, a, b)) == want
    monkeypatch.setattr(lx, "TERMS", 40)  # several blocks of items
    assert _got(lx.search(spark, a, b)) == want


def test_no_documents_or_items(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b")], "id BIGINT, text STRING")
    empty = docs.limit(0)
    for a, b in ((empty, docs), (docs, empty), (docs.selectExpr("id", "'...' AS text"), docs)):
        out = lx.search(spark, a, b)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def test_long_texts_are_split_between_terms(monkeypatch):
    text = ("alpha beta, Gamma_delta " * 400 + "x" * 500 + " é").encode()
    whole = lx._counts(text, {b"alpha": 0, b"gamma": 1, "é".encode(): 2, b"x" * 500: 3})
    monkeypatch.setattr(lx, "PIECE", 64)
    assert lx._counts(text, {b"alpha": 0, b"gamma": 1, "é".encode(): 2, b"x" * 500: 3}) == whole
    assert whole == (1602, {0: 400, 1: 400, 2: 1, 3: 1})


@pytest.mark.parametrize("bits", [1 << 24, 1 << 8])
def test_groups_finish_early_and_lose_nothing(monkeypatch, bits):
    monkeypatch.setattr(lx, "BITS", bits)
    rng = np.random.default_rng(1)
    n, k = 2000, 12
    held = rng.random((k, n)) < rng.uniform(0.02, 0.6, (k, 1))
    gains = rng.integers(1, 50, (k, n)) + 200 // (1 + held.sum(axis=1, keepdims=True))
    postings = [(np.flatnonzero(h), g[h]) for h, g in zip(held, gains, strict=True)]
    ids = rng.permutation(n)
    best = lx.Best(10)
    seen = lx.rank_block(best, np.packbits(held, axis=1), postings, ids, np.zeros(n, bool))
    scores = (held * gains).sum(axis=0)
    want = sorted(zip(-scores, ids, strict=True))[:10]
    assert [(-s, i) for s, i in zip(best.scores, best.ids, strict=True)] == want
    assert seen < n / 2 or bits < 1 << 24
