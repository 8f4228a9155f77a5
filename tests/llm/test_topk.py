"""Exact top-k against brute force."""

import math
import random

import pytest

from quire.llm import topk

SCHEMA = "vec_id long, embedding array<float>, id int, v string"


def brute(data, k):
    vecs = {}
    for i, e, *_ in data:
        if i is None or e is None or any(x is None or math.isnan(x) or math.isinf(x) for x in e):
            continue
        v = [math.floor(256 * x) for x in e]
        vecs[i] = min(v, vecs.get(i, v))
    out = []
    for q in (i for i in vecs if i % 5 == 0):
        scores = sorted((-sum(a * b for a, b in zip(vecs[q], v)), i) for i, v in vecs.items() if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


def rows(seed, n=600, dim=8):
    rng = random.Random(seed)
    import struct

    def f32(x):
        return struct.unpack("f", struct.pack("f", x))[0]
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    out = [(i, [f32(c + rng.gauss(0, .2)) for c in rng.choice(centres)], 1, "v") for i in range(n)]
    hot = out[0][1]
    out += [(10_000 + i, hot, 1, "v") for i in range(300)]
    out += [(20_000, None, 1, ""), (20_005, [None] * dim, 1, ""), (20_010, [float("nan")] * dim, 1, ""),
            (20_015, [float("inf")] + [0.0] * (dim - 1), 1, ""), (None, hot, 1, ""), (3, [0.0] * dim, 1, ""), (3, hot, 1, ""),
            (20_020, [], 1, ""), (20_025, [1.0, 2.0], 1, ""), (-5, [-9.5] * dim, 1, ""), (20_030, [0.0] * dim, 1, "")]
    return out


@pytest.mark.parametrize("sample, pivots, annulus, queries", [(4096, 64, 512, 8192), (40, 4, 16, 60)])
def test_matches_brute_force(spark, monkeypatch, sample, pivots, annulus, queries):
    for name, value in (("SAMPLE_ROWS", sample), ("PIVOTS", pivots), ("ANNULUS", annulus), ("QUERY_ROWS", queries),
                        ("PARTITION_ROWS", 200)):
        monkeypatch.setattr(topk, name, value)
    data = rows(sample)
    got = topk.top_k(spark.createDataFrame(data, SCHEMA).repartition(3), lambda c: c % 5 == 0).collect()
    assert sorted(map(tuple, got)) == brute(data, 5)


def test_few_and_no_rows(spark):
    for data in ([], [(5, [1.0], 1, "")], [(5, [1.0], 1, ""), (6, [2.0], 1, ""), (7, [2.0], 1, "")]):
        got = topk.top_k(spark.createDataFrame(data, SCHEMA), lambda c: c % 5 == 0).collect()
        assert sorted(map(tuple, got)) == brute(data, 5)
