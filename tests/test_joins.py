"""Joins with hot keys where nothing may be broadcast."""

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import joins as jn
from quire.operators import rouge as rg
from quire.operators import vocab as vc
from quire.session import broadcast_if_small, fits_broadcast


@pytest.fixture()
def nothing_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_split_join_equals_join(spark, nothing_broadcast, how):
    rng = random.Random(1)
    big = [(None if rng.random() < 0.05 else 7 if rng.random() < 0.4 else rng.randrange(60), i) for i in range(3000)]
    side = [(k, k * 10) for k in range(0, 60, 2)] + [(7, 1), (7, 2), (None, 3)]
    a = spark.createDataFrame(big, "k int, x int").repartition(5)
    b = spark.createDataFrame(side, "k int, y int")
    got = jn.split_join(a, b, "k", how, rows=100, lookup_rows=0)
    want = a.join(b, "k", how)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    salts = jn.hot_keys(a, ["k"], 100)
    assert any(r["k"] == 7 and r["__salts"] > 1 for r in salts.collect())


def test_hot_gram_in_every_document(spark, nothing_broadcast):
    rng = random.Random(2)
    docs = [(i, "the same eight words stand in every text here " + " ".join(rng.choice("abcdefgh") for _ in range(20)))
            for i in range(300)] + [(999, None), (1000, "")]
    items = [(i, docs[i * 7][1][20:] if i % 2 else f"other words {i} " * 8) for i in range(20)]
    items.append((50, "the same eight words stand in every text here"))
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string")

    def grams(t):
        w = (t or "").split()
        return {tuple(w[k:k + 8]) for k in range(len(w) - 7)}
    want = {(x, y) for x, t in docs for y, u in items if grams(t) & grams(u)}
    split = [(r.doc_id, r.item_id) for r in rg.ngram_candidates(d, b, 8, "doc_id", "item_id", rows=50, lookup_rows=0).collect()]
    plain = [(r.doc_id, r.item_id) for r in rg.ngram_candidates(d, b, 8, "doc_id", "item_id").collect()]
    assert len(split) == len(set(split)) and set(split) == want == set(plain) and len(want) > 300


def test_vocabulary_of_any_size(spark, nothing_broadcast, monkeypatch):
    """A word with a third of all tokens; the lookup and the join agree."""
    monkeypatch.setattr(jn, "HOT_ROWS", 50)
    rng = random.Random(3)
    rows = [(i, " ".join(["hot"] * 10 + [f"w{rng.randrange(40)}" for _ in range(20)])) for i in range(60)] + [(60, ""), (61, None)]
    df = spark.createDataFrame(rows, "k int, t string").repartition(4)
    v = spark.createDataFrame([(0, "<unk>"), (1, "hot")] + [(2 + i, f"w{i}") for i in range(30)], "id long, piece string")
    a = {r.k: r.ids for r in vc.encode(df, ["k"], vc.ws_tokens("t"), v, 0).collect()}
    joined = vc.encode(df, ["k"], vc.ws_tokens("t"), v, 0, lookup_rows=0)
    b = {r.k: r.ids for r in joined.collect()}
    assert {k: x or [] for k, x in a.items()} == b
    back = vc.decode(joined, ["k"], "ids", v, out="back", lookup_rows=0).collect()
    assert all(len(r.back.split()) == len(r.ids) for r in back)


def test_bytes_are_measured_whatever_the_caller_knows(spark):
    wide = spark.range(3).select(F.repeat(F.lit("x"), 30 << 20).alias("s"))
    assert not fits_broadcast(wide, 10) and fits_broadcast(spark.range(3), 10)
    assert "broadcast" not in broadcast_if_small(wide, 10, bound=3)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" in broadcast_if_small(spark.range(3), 10, bound=3)._jdf.queryExecution().logical().toString().lower()
