"""Subword quality scores: features against a plain version, accuracy on rows kept back."""

import math
import re
import zlib

import numpy as np
import pytest

from starload.llm import subword as sw
from starload.llm.q_subword import fit_on, op12_subword
from starload.session import read_table

SF = "/root/testdata/sf0.01"
MASK = (1 << 64) - 1


def _mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def _plain(text):
    """All features of a text, one at a time."""
    base = int(sw._BASE)

    def bucket(h):
        return _mix(h & MASK) >> (64 - 17)

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    hashes = [sum((ord(c) + 1) * pow(base, i + 1, 1 << 64) for i, c in enumerate(w)) & MASK for w in words]
    found = [bucket(h + int(sw._WORD)) for h in hashes]
    found += [bucket(b - a + int(sw._PAIR)) for a, b in zip(hashes, hashes[1:], strict=False)]
    flat = " " + re.sub(r"[\x20\x09-\x0D]", " ", text or "") + " "
    for n in sw.N_GRAMS if words else ():
        for i in range(len(flat) - n + 1):
            gram = flat[i : i + n]
            if " " not in gram[1:-1]:
                found.append(bucket(sum(ord(c) * pow(base, n - 1 - k, 1 << 64) for k, c in enumerate(gram)) + n))
    return sorted(found)


@pytest.mark.parametrize("text", [None, "", " \t\n", "a", "ab ab", "Das Öl ist  teuer!\n### 😀 x", "wort " * 40])
def test_features_match_a_plain_version(text):
    assert sorted(sw.features(text).tolist()) == _plain(text)


def test_long_texts_are_hashed_in_pieces_without_a_seam(monkeypatch):
    text = "eins zwei  drei\tvier " * 50 + "x" * 70 + " ende"
    whole = sorted(sw.features(text).tolist())
    monkeypatch.setattr(sw, "PIECE", 80)
    assert sorted(sw.features(text).tolist()) == whole


def test_a_repeated_word_has_one_pair_vector_whichever_word_it_is():
    pair = sw._bucket(np.zeros(1, np.uint64) + sw._PAIR)[0]
    assert all(pair in sw.features(f"{w} {w}") for w in ("la", "ungesehen", "###"))
    assert pair not in sw.features("la le")


def test_scores_are_the_softmax_of_the_mean_vector():
    samples = []
    for k in range(40):
        at, n = np.unique(sw.features(f"gut text {k}" if k % 2 else f"$$$ müll {k}"), return_counts=True)
        samples.append((at, (n / n.sum()).astype(np.float32), k % 2))
    model = sw.train(samples, {0: 0.5, 1: 0.5}, epochs=20)
    at = sw.features("gut text 99")
    logits = model.bias + model.table[at].astype(float).sum(axis=0) / len(at)
    assert math.isclose(model.probabilities("gut text 99")[1], 1 / (1 + math.exp(logits[0] - logits[1])), rel_tol=1e-9)
    assert model.probabilities("gut text 99")[1] > 0.8 > 0.2 > model.probabilities("$$$ müll 98")[1]
    again = sw.train(samples, {0: 0.5, 1: 0.5}, epochs=20)
    assert (again.table == model.table).all()


def test_held_out_accuracy_and_no_leak(spark):
    got = {r.doc_id: r for r in op12_subword(spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    held = {d for d in labels if zlib.crc32(str(d).encode()) % 3 == 1}
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d in got)
    right = [got[d].predicted == labels[d] for d in held]
    assert sum(right) / len(right) > 0.97 and len(got) == 1000
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    # labels of held-out rows turned round change no score
    docs = read_table(spark, SF, "documents")
    table = read_table(spark, SF, "labels")
    turned = table.selectExpr("doc_id", "IF(crc32(binary(string(doc_id))) % 3 = 1, 1 - quality, quality) AS quality")
    a, b = fit_on(spark, docs, table, epochs=1), fit_on(spark, docs, turned, epochs=1)
    assert (a.table == b.table).all() and (a.bias == b.bias).all()


def test_odd_rows(spark, written):
    docs = spark.read.parquet(written(
        [(1, "gut und schön", "a", 0.0), (1, "gut und schön", "a", 0.0), (None, None, None, 0.0), (2, "", "b", 0.0),
         (3, "### $$$", "c", 0.0), (4, "ß " * 60000, "d", 0.0)], "id BIGINT, text STRING, label STRING, score DOUBLE"))
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (2, None), (9, 1)], "id BIGINT, label INT")
    model = sw.fit(spark, docs, labels)
    out = sw.score(spark, docs, model, 1)
    rows = out.collect()
    assert out.columns == docs.columns and len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.id == 1}) == 1
    empty = sw.score(spark, docs.limit(0), model, 1)
    assert empty.count() == 0 and empty.columns == docs.columns
    none = sw.fit(spark, docs, labels.limit(0))
    assert {r.score for r in sw.score(spark, docs, none, 1).collect()} == {0.5}
    assert {r.score for r in sw.score(spark, docs, model, 7).collect()} == {0.0}
    assert sw.fit(spark, docs.limit(0), labels).labels == ()


def test_the_sample_is_bounded_and_takes_whole_texts(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"wort{i} " * 30) for i in range(400)], "id BIGINT, text STRING").repartition(3)
    labels = docs.selectExpr("id", "id % 2 AS label")
    seen = []
    monkeypatch.setattr(sw, "train", lambda samples, shares, **_: seen.append((samples, shares)))
    sw.fit(spark, docs, labels, rows_per_label=20)
    sw.fit(spark, docs, labels, rows_per_label=20, bytes_per_label=1000)
    (rows, shares), (fewer, _) = seen
    assert [sum(y == k for *_, y in rows) for k in (0, 1)] == [20, 20] and shares == {0: 0.5, 1: 0.5}
    assert 0 < len(fewer) < 20
