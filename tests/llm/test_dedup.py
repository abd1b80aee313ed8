import hashlib
import os
import random
import re
import time
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from starload.llm import minhash, substrings
from starload.llm.common import mix
from starload.llm.components import components
from starload.llm.exactdedup import ExactDedup

WORD = r"[^\x20\x09-\x0D]+"


def _texts(seed, n=60, words=120):
    rng = random.Random(seed)
    make = lambda k: [f"{rng.choice('abcdefgh')}{rng.randrange(400)}" for _ in range(k)]
    rows = [make(rng.randrange(1, words)) for _ in range(n)]
    for i in range(0, n, 3):  # near copies with changes at random places
        copy = list(rows[i])
        for _ in range(rng.randrange(0, 8)):
            copy[rng.randrange(len(copy))] = "new"
        rows.append(copy)
    hot = make(100)
    for i in range(40):  # a large group, each a little different
        rows.append([*hot[: 3 * (i % 5)], f"v{i}", *hot[3 * (i % 5):]])
    return [" ".join(r) for r in rows]


def _components(rows, k):
    sets = []
    for _, text in rows:
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i in range(len(rows)):
        if rows[i][0] is not None:
            least[find(i)].append(rows[i][0])
    return sorted((rows[i][0] if rows[i][0] is not None else -1, len(sets[i]),
                   min(least[find(i)]) if least[find(i)] else -1) for i in range(len(rows)))


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_against_all_pairs(spark, k):
    rows = [(1000 - i, t) for i, t in enumerate(_texts(k))]
    rows += [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "One"), (5004, "oNE"), rows[0], rows[0],
             (rows[3][0], rows[9][1]), (None, rows[5][1]), (None, "no other text"), (5005, "word " * 30_000)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "id BIGINT, text STRING, component_id INT").repartition(4)
    got = minhash.near_duplicates(spark, docs, k).collect()
    assert sorted((r.id if r.id is not None else -1, r.n_shingles, r.component_id if r.component_id is not None else -1)
                  for r in got) == _components(rows, k)


def test_no_documents_have_no_duplicates(spark):
    assert minhash.near_duplicates(spark, spark.createDataFrame([], "id BIGINT, text STRING")).collect() == []


def test_signatures_within_the_distance_share_a_key(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(200):
        a = rng.integers(0, 1 << minhash.BITS, minhash.SYMBOLS).astype(np.uint64)
        b = a.copy()
        b[rng.permutation(minhash.SYMBOLS)[: minhash.MAX_DISTANCE if i % 2 else i // 8]] ^= np.uint64(1 << i % minhash.BITS)
        one, other = minhash.pack(a), minhash.pack(b)
        same = np.flatnonzero(minhash.index_keys(one) == minhash.index_keys(other))
        assert len(same)
        rows.append((one.tolist(), other.tolist(), int((a != b).sum()), int(same[0])))
    pairs = spark.createDataFrame(rows, "a array<long>, b array<long>, d int, first int")
    both = F.col("a"), F.col("b")
    got = pairs.select("d", minhash.distance(*both).alias("e"), "first", minhash.first_shared(*both).alias("s"))
    assert all(r.d == r.e and r.first == r.s for r in got.collect())


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(139, 7)] + [(200, 200)]
    got = dict(map(tuple, components(spark, spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()))
    assert got == {i: 0 for i in [*range(1, 61), *range(100, 140)]}


def _cut(rows):
    window = substrings.WINDOW
    words = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in words:
        for p in range(len(w) - window + 1):
            key = tuple(w[p:p + window])
            least[key] = min(least.get(key, 1 << 63), (1 << 63) - 1 if i is None else i)
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - window + 1):
            if least[tuple(w[p:p + window])] < ((1 << 63) - 1 if i is None else i):
                gone.update(range(p, p + window))
        left = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((-1 if i is None else i, len(w), len(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out)


def test_repeated_passages_against_all_windows(spark):
    rng = random.Random(8)
    make = lambda n: [f"W{rng.randrange(5000)}" for _ in range(n)]
    passages = [make(n) for n in (49, 50, 51, 80, 200)]
    rows = []
    for i in range(80):
        text = make(rng.randrange(0, 150))
        for p in rng.sample(passages, rng.randrange(0, 3)):
            at = rng.randrange(len(text) + 1)
            text[at:at] = p[rng.randrange(0, 2):]
        rows.append((500 - 3 * i, "  ".join(text) if i % 9 == 0 else " ".join(text)))
    rows += [rows[4], (7, rows[4][1]), (7, " ".join(passages[4])), (None, rows[2][1]), (None, rows[2][1]),
             (1, None), (2, ""), (3, "\t \n"), (4, "same " * 3000), (9, "same " * 120), (10, "same " * 49)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "id BIGINT, text STRING, n_words INT").repartition(4)
    got = substrings.remove_repeats(spark, docs).collect()
    assert sorted((-1 if r.id is None else r.id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == _cut(rows)
    assert all((r.kept is None) == (r.n_removed == 0) for r in got)


def test_no_documents_have_no_passages(spark):
    out = substrings.remove_repeats(spark, spark.createDataFrame([], "id BIGINT, text STRING"))
    assert out.columns == ["id", "n_words", "n_removed", "kept_sha256", "kept"] and out.count() == 0


def test_cover_has_every_difference():
    cover = substrings.COVER.tolist()
    differences = {(a - b) % substrings.PERIOD for a in cover for b in cover}
    assert differences == set(range(substrings.PERIOD))


def _exact(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append((-len(t or ""), i is None, i or 0))
    out = []
    for i, t in rows:
        group = groups[norm(t)]
        first = min(group)
        keep = None if first[1] else first[2]
        out.append((str(i), str(keep), len(group), hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out)


ROWS = [(5, "a b"), (3, "ab"), (9, "a  b"), (2, "a b"), (7, None), (6, ""), (8, " \n"), (4, "x" * 100_000),
        (1, "ba"), (None, "ba"), (None, "only"), (12, "twin"), (12, "twin"), (13, "é"), (14, "é "), (15, "É")]


@pytest.mark.parametrize("weak", [False, True])
def test_exact_duplicates(spark, written, weak):
    """With a digest of few values, equality rests on the full bytes alone."""
    path = written([(*r, "d", "f") for r in ROWS], "doc_id BIGINT, text STRING, digest STRING, file STRING")
    how = {"digest": lambda c: (F.length(c) % 2).cast("string")} if weak else {}
    dedup = ExactDedup(spark, path, **how)
    dedup.update()
    got = dedup.result().collect()
    want = _exact(ROWS)
    if weak:
        assert sorted((str(r.id), str(r.keep_id), r.group_size) for r in got) == sorted(w[:3] for w in want)
    else:
        assert sorted((str(r.id), str(r.keep_id), r.group_size, r.digest) for r in got) == want
    assert sum(r.kept for r in got) == len({w[3] for w in want})


def test_state_goes_on_with_new_files(spark, written):
    path = written(ROWS[:6], "doc_id BIGINT, text STRING")
    dedup = ExactDedup(spark, path, files_per_batch=1)
    dedup.update()
    spark.createDataFrame(ROWS[6:], "doc_id BIGINT, text STRING").write.mode("append").parquet(path)
    dedup.update()
    got = dedup.result().collect()
    assert sorted((str(r.id), str(r.keep_id), r.group_size, r.digest) for r in got) == _exact(ROWS)


def test_similarities_below_the_signatures_limit_are_refused(spark):
    docs = spark.createDataFrame([(1, "a b c")], "id BIGINT, text STRING")
    with pytest.raises(ValueError, match="80 percent"):
        minhash.near_duplicates(spark, docs, percent=60)


def test_old_files_are_taken_in_too(spark, written):
    path = written(ROWS[:6], "doc_id BIGINT, text STRING")
    dedup = ExactDedup(spark, path)
    dedup.update()
    known = set(Path(path).glob("*.parquet"))
    spark.createDataFrame(ROWS[6:], "doc_id BIGINT, text STRING").write.mode("append").parquet(path)
    for file in set(Path(path).glob("*.parquet")) - known:
        os.utime(file, (time.time() - 30 * 86_400,) * 2)
    with pytest.raises(ValueError, match="the state holds"):
        dedup.result()
    dedup.update()
    got = dedup.result().collect()
    assert sorted((str(r.id), str(r.keep_id), r.group_size, r.digest) for r in got) == _exact(ROWS)


def test_exact_dedup_of_an_empty_table(spark, written):
    dedup = ExactDedup(spark, written([], "doc_id BIGINT, text STRING"))
    dedup.update()
    assert dedup.result().collect() == []


def test_parity_sketches_reject_no_link_and_most_others(spark):
    rng = np.random.default_rng(4)
    rows = []
    for size in (1, 2, 7, 60, 200, 900, 5000):
        for similarity in (0.6, 0.7, 0.75, 0.8, 0.9, 1.0):
            for more in (1.0, 1.1, 1.25):  # sets of different size, as far as the similarity allows
                a_n, b_n = size, max(1, int(size * more))
                # the least overlap that reaches the similarity, or one below it
                both = int(np.ceil(similarity * (a_n + b_n) / (1 + similarity) - 1e-9))
                if both > min(a_n, b_n):
                    continue
                pool = rng.integers(0, 2**64, a_n + b_n - both, dtype=np.uint64, endpoint=False)
                a, b = pool[:a_n], np.concatenate((pool[:both], pool[a_n:]))
                true = 100 * both >= 80 * (a_n + b_n - both)
                rows.append((len(a), len(b), minhash.parity(a).tolist(), minhash.parity(b).tolist(), similarity, true))
    df = spark.createDataFrame(rows, "na long, nb long, pa array<long>, pb array<long>, similarity double, link boolean")
    got = df.withColumn("may", minhash.may_link(*map(F.col, ("na", "nb", "pa", "pb")), 80)).collect()
    assert all(r.may for r in got if r.link) and sum(r.link for r in got) > 30
    low = [r for r in got if r.similarity <= 0.75 and r.na >= 200]
    assert len(low) > 10 and not any(r.may for r in low)
    # half of the words are the halves of all, xor-ed
    some = rng.integers(0, 2**64, 900, dtype=np.uint64, endpoint=False)
    wide = minhash.parity(some)
    fold = wide[: len(wide) // 2] ^ wide[len(wide) // 2:]
    bits = np.bincount((mix(some) & np.uint64(64 * len(fold) - 1)).astype(int), minlength=64 * len(fold)) & 1
    assert (np.packbits(bits.astype(np.uint8), bitorder="little").view("<i8") == fold).all()


def test_long_varied_texts_link_at_the_limit(spark):
    words = [f"wort{i}" for i in range(9000)]
    near = words[:8900] + [f"neu{i}" for i in range(100)]
    far = [w if i % 9 else f"x{i}" for i, w in enumerate(words)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far)), (4, " ".join(words[:4000]))],
                                 "id BIGINT, text STRING")
    got = {r.id: r.component_id for r in minhash.near_duplicates(spark, docs, 2).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}
