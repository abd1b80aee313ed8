"""The audit of filter orders against one that applies each order row by row."""

import random
import re
from collections import defaultdict
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from starload.llm import filter_audit as fa

COLUMNS = ["part", "filter_order", "step", *fa.KINDS, "shapley"]


def _fails(rows):
    """Failing filters of each (doc_id, text)."""
    found = []
    for doc, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found.append(
            ("A" if len(words) < 100 else "") + ("B" if 100 * len(set(words)) < 80 * len(words) else "")
            + ("C" if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else "")
            + ("D" if re.search(r"[#$%&*|]", text) else "")
            + ("E" if doc is not None and any(o is not None and o < doc and (t or "") == text for o, t in rows) else ""))
    return found


def _applied(rows, marks):
    """Every order applied to (doc_id, text, part) rows, step by step."""
    fails = _fails([(d, t) for d, t, _ in rows])
    out, alone = {}, defaultdict(int)
    for part in {p or "" for *_, p in rows}:
        own = [(f, *marks.get(d, (0, 0))) for f, (d, _, p) in zip(fails, rows, strict=True) if (p or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = list(own)
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[0]]
                left = [r for r in left if x not in r[0]]
                failing = [r for r in own if x in r[0]]
                out[part, order, step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(r[0] == x for r in own),
                    sum(r[1] for r in gone), sum(r[2] for r in gone)]
                alone[part, x] += len(gone)
    return {(p, o, s, *v, alone[p, o[s - 1]]) for (p, o, s), v in out.items()}


def _rows(df):
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def _text(rng):
    kind = rng.random()
    if kind < 0.15:
        return rng.choice([None, "", " \n", "NUR GROSS", "kurz & gut", "a" * 3000])
    words = [f"wort{rng.randrange(60 if kind < 0.5 else 5000)}" for _ in range(rng.choice([20, 130]))]
    words = [w.upper() if kind > 0.8 else w for w in words]
    return " ".join(words) + (" #" if rng.random() < 0.2 else "")


def test_every_order_matches_its_application(spark, written):
    rng = random.Random(5)
    texts = [_text(rng) for _ in range(60)]
    ids = [*range(90), 7, 7, None, None]
    rng.shuffle(ids)
    # copies across parts, repeated and missing identifiers, missing parts
    rows = [(d, rng.choice(texts), rng.choice(["de", "en", "", None])) for d in ids]
    rows.append(rows[0])
    rows += [(1000 + k, "haeufig " * 3, "en") for k in range(60)]
    marks = {d: (rng.randrange(2), rng.randrange(2)) for d in range(0, 90, 2)}
    docs = spark.read.parquet(written([(d, t, p, "x", 1) for d, t, p in rows],
                                      "doc_id BIGINT, text STRING, lang STRING, part STRING, good INT", files=5))
    labels = spark.createDataFrame(
        [(d, q, t) for d, (q, t) in marks.items()] + [(4, 0, 0), (None, 1, 1), (5, None, None)],
        "doc_id BIGINT, quality INT, toxic INT")
    assert _rows(fa.documents_audit(spark, docs, labels)) == _applied(rows, marks)


def test_an_empty_table_has_no_parts(spark, written):
    docs = spark.read.parquet(written([], "doc_id BIGINT, text STRING, lang STRING"))
    labels = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    out = fa.documents_audit(spark, docs, labels)
    assert out.columns == [*COLUMNS[:3], "filter", *COLUMNS[3:]] and out.count() == 0


def test_counters_never_reach_each_other():
    table = fa.integers("ABCDE")
    n = (1 << 62) // 7
    counts = fa.unpacked("ABCDE", table[0b1100011] * n + table[0] * 3)
    assert set(np.unique(counts)) == {0, 3, n, n + 3} - ({n + 3} if not (counts == n + 3).any() else set())
    steps = fa.steps("ABCDE")
    for at, (order, step, x) in enumerate(steps):
        gone = min(order.index("A"), order.index("B")) + 1
        assert counts[:, at].tolist() == [
            3 + n * (gone > step), n * (gone == step), n * (x in "AB" and gone < step), 0, n * (gone == step),
            n * (gone == step)]


def test_many_parts_are_passed_on_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(fa, "HELD", 3)
    rows = spark.range(0, 400, 1, 5).select((F.col("id") % 37).cast("string").alias("p"), (F.col("id") % 3 == 0).alias("f"))
    out = fa.audit(spark, rows, "AB", F.col("p"), [F.col("f"), F.lit(None).cast("boolean")], F.col("f"), F.lit(False))
    got = {(r.part, r.filter_order, r.step): r for r in out.collect()}
    assert len(got) == 37 * 4
    for p in range(37):
        own = [i for i in range(400) if i % 37 == p]
        gone = sum(i % 3 == 0 for i in own)
        r = got[str(p), "BA", 2]
        assert (r.kept, r.removed, r.good_lost, r.unique_fails, r.shapley) == (len(own) - gone, gone, gone, gone, 2 * gone)
