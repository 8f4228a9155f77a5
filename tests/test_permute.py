"""Keyed permutations and the walk back of the longest common subsequence."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.functions.lcs import lcs_table, lcs_tokens, union_lcs, union_lcs_carried
from quire.operators import permute as pm


def walk(x, n, seed):
    a, b = pm.sides(n)
    while True:
        x = int(pm._network(np.array([x], dtype=np.int64), a, b, pm.round_keys(seed))[0])
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 101, 997, 1000, 4097])
def test_index_is_a_permutation_and_equals_plain_walks(spark, n):
    df = spark.range(0, n, numPartitions=3)
    for seed in (0, 7):
        got = {r["id"]: r["p"] for r in df.select("id", pm.keyed_index("id", n, seed).alias("p")).collect()}
        assert sorted(got.values()) == list(range(n))
        if n > 1:
            assert all(got[x] == walk(x, n, seed) for x in range(0, n, 1 + n // 50))


def test_network_is_a_bijection_with_few_places_too_many():
    for n in [2, 10, 999, 123_457]:
        a, b = pm.sides(n)
        assert n <= a * b < n + a
        all_places = pm._network(np.arange(a * b), a, b, pm.round_keys(3))
        assert len(np.unique(all_places)) == a * b
    assert 1 <= pm.walks(10 ** 10 + 19, 5) <= 5
    with pytest.raises(ValueError):
        pm.keyed_index("id", 1 << 51, 0)


def test_seeds_differ_and_places_look_independent(spark):
    n = 20_000
    r = spark.range(n).select("id", pm.keyed_index("id", n, 1).alias("p"), pm.keyed_index("id", n, 2).alias("q"))
    s = r.agg(F.corr("id", "p").alias("a"), F.corr("p", "q").alias("b"),
              F.sum((F.col("p") == F.col("q")).cast("int")).alias("same")).first()
    assert abs(s["a"]) < 0.03 and abs(s["b"]) < 0.03 and s["same"] < 12


def test_null_index_and_plan_without_exchange(spark):
    df = spark.createDataFrame([(None,), (0,), (1,)], "i long")
    assert sorted((r["p"] for r in df.select(pm.keyed_index("i", 2, 1).alias("p")).collect()), key=str) == [0, 1, None]
    plan = pm.epoch_shards(spark.range(1000), "id", 1000, 7)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_epoch_shards_cover(spark):
    df = spark.range(101)
    rows = pm.epoch_shards(df, "id", 101, 4, seed=3, epoch=2).collect()
    assert len(rows) == 104 and {r["id"] for r in rows} == set(range(101)) and sorted(r["pos"] for r in rows) == list(range(104))
    assert all(r["shard"] == r["pos"] % 4 for r in rows)
    assert len(pm.epoch_shards(df, "id", 101, 4, drop_tail=True).collect()) == 100
    loops = pm.epoch_loop_shards(df, "id", 101, 3, 64).collect()
    assert len(loops) == 192 and {r["id"] for r in loops} == set(range(101))


def table_walk(a, b):
    t, i, j, out = lcs_table(a, b), len(a), len(b), []
    while i > 0 and j > 0:
        if a[i - 1] == b[j - 1]:
            out.insert(0, a[i - 1])
            i, j = i - 1, j - 1
        elif t[i - 1][j] > t[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return out


def test_lcs_walk_equals_the_table():
    rng = random.Random(1)
    for k in range(600):
        letters = "abcdefgh"[:rng.randrange(1, 9)]
        a, b = ([rng.choice(letters) for _ in range(rng.randrange(0, 30))] for _ in range(2))
        assert lcs_tokens(a, b) == table_walk(a, b), (a, b)


def test_lcs_of_long_sentences():
    rng = random.Random(2)
    a = [str(rng.randrange(300)) for _ in range(5_000)]
    b = [w for w in a if rng.random() < 0.7] + [str(rng.randrange(300)) for _ in range(1_500)]
    got = lcs_tokens(a, b)
    it_a, it_b = iter(a), iter(b)
    assert len(got) >= 3_300 and all(w in it_a for w in got) and all(w in it_b for w in got)


def test_carried_union_equals_plain_unions(spark):
    refs, hyps = [["a", "b", "c"], ["c", "d", "a"], ["x"]], [["c", "a"], ["b", "d", "c"]]
    df = spark.createDataFrame([(1, refs, hyps), (2, refs, []), (3, None, hyps)], "k int, r array<array<string>>, h array<array<string>>")
    got = {r["k"]: r["u"] for r in df.select("k", union_lcs_carried()("r", "h").alias("u")).collect()}
    union, counts = [], []
    for r in refs:
        n, union = union_lcs(r, hyps, prev_union=union)
        counts.append(n)
    assert got[1]["new_counts"] == counts and got[1]["union"] == union
    assert got[2]["union"] is None and got[3]["union"] is None
