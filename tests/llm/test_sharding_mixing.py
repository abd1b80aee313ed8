import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from starload.llm import mixing, sharding


def _python_place(row, rows, seed):
    a, b = sharding.halves(rows)

    def network(x):
        left, right = divmod(x, b)
        for k in range(len(sharding.ROUNDS)):
            if k % 2 == 0:
                left = (left + sharding.round_value(right, seed, k)) % a
            else:
                right = (right + sharding.round_value(left, seed, k)) % b
        return left * b + right

    x = network(row)
    while x >= rows:
        x = network(x)
    return x


@pytest.mark.parametrize("rows", [1, 2, 3, 17, 100, 1000, 1023])
def test_the_network_permutes_all_row_numbers(rows):
    a, b = sharding.halves(rows)
    assert rows <= a * b < rows + a
    assert sorted(_python_place(i, rows, 5) for i in range(rows)) == list(range(rows))


def test_place_of_a_row_can_be_computed(spark):
    got = spark.range(333).select("id", sharding.permute(F.col("id"), 333, 9).alias("p")).collect()
    assert [r.p for r in sorted(got)] == [_python_place(i, 333, 9) for i in range(333)]


def test_shards_are_even_gapless_and_reproducible(spark):
    rows = [(i % 90 if i % 7 else None, "a" if i % 3 else None, i) for i in range(200)] + [(5, "x", 1)] * 30
    df = spark.createDataFrame(rows, "id BIGINT, shard STRING, n INT")
    keys = [F.col("id"), F.col("shard"), F.col("n")]
    got = sharding.shard(spark, df.repartition(5), keys, 8).collect()
    again = sharding.shard(spark, df.repartition(3), keys, 8).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert Counter(tuple(r)[:3] for r in got) == Counter(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard_"]].append(r["slot"])  # the input has a column "shard"
    assert set(slots) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_numbering_follows_the_keys_and_splits_equal_ones(spark):
    df = spark.createDataFrame([(i // 50,) for i in range(500)], "k INT").repartition(6)
    numbered, n = sharding.number_rows(spark, df, [F.col("k")], "row")
    got = sorted((r.row, r.k) for r in numbered.collect())
    assert n == 500 and [r for r, _ in got] == list(range(500))
    assert [k for _, k in got] == sorted(k for _, k in got)


def test_empty_table(spark):
    df = spark.createDataFrame([], "id BIGINT")
    assert sharding.shard(spark, df, [F.col("id")], 4).collect() == []


def _plain_targets(sizes):
    """Resharing as it is told: cut what is above, share it out again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    budget, target, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        level = (budget - sum(target.values())) / sum(weight[s] for s in free)
        above = [s for s in free if weight[s] * level > 2 * sizes[s] + 1e-9]
        if not above:
            return target | {s: weight[s] * level for s in free}
        for s in above:
            target[s] = 2.0 * sizes[s]
            free.discard(s)
    return target


def test_mix_against_a_plain_version(spark):
    rows = [(i if i % 41 else None, [None, "b", "a", "c", "é", ""][i % 6] if i % 4 else "hot",
             (i * 37) % 50 if i % 13 else None, [None, 0.5, 2.0, -1.0][i % 4], "x") for i in range(300)]
    rows += [rows[7]] * 3
    df = spark.createDataFrame(rows, "id BIGINT, source STRING, size BIGINT, quality DOUBLE, taken STRING")
    got = mixing.mix(spark, df.repartition(4), seed=3).collect()
    u = {r.id: r.u for r in df.select("id", mixing.uniform(F.col("id"), 3).alias("u")).distinct().collect()}
    sizes = Counter()
    for r in rows:
        sizes[r[1]] += r[2] or 0
    target = _plain_targets(sizes)
    want = Counter()
    for source in sizes:
        mine = [(-math.log(u[r[0]]) / (r[3] if r[3] and r[3] > 0 else 1.0), r[0] is not None, r[0] or 0, r[2] or 0)
                for r in rows if r[1] == source]
        epochs = math.floor(target[source] / sizes[source] + 1e-12) if sizes[source] else 0
        rest = math.floor(target[source] + 0.5) - epochs * sizes[source]
        for _, known, ident, size in sorted(mine):
            part = min(size, max(0, rest))
            rest -= size
            want[ident if known else None, source, size, epochs * size + part] += 1
    assert Counter((r.id, r.source, r["size"], r.taken) for r in got) == want
    for source in sizes:
        total = sum(r.taken for r in got if r.source == source)
        assert abs(total - target[source]) <= 1
        assert all(abs(r.target - target[source]) < 1e-6 for r in got if r.source == source)
    assert all(r.taken <= 2 * r["size"] for r in got)


def test_better_documents_come_first_more_often(spark):
    rows = [(i, "s", 1, 4.0 if i % 2 else 0.25) for i in range(2000)] + [(-1, "t", 4000, None)]
    df = spark.createDataFrame(rows, "id BIGINT, source STRING, size BIGINT, quality DOUBLE")
    got = mixing.mix(spark, df, weights=(1, 5), ratio=(1, 1)).where("source = 's' AND taken > 0").collect()
    assert sum(r.id % 2 for r in got) > 0.8 * len(got) > 0


def test_empty_mix_and_sources_without_words(spark):
    schema = "id BIGINT, source STRING, size BIGINT, quality DOUBLE"
    assert mixing.mix(spark, spark.createDataFrame([], schema)).collect() == []
    got = mixing.mix(spark, spark.createDataFrame([(1, None, 0, None), (2, "a", None, 1.0)], schema)).collect()
    assert [(r.taken, r.target) for r in got] == [(0, 0.0)] * 2
