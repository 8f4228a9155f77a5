"""Language sets against an exhaustive search over sets, held-out accuracy,
odd rows."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import langid
from quire.llm.common import hash_share
from quire.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, row int, found string"


def test_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op11_language_id"](spark, SF).collect()
    assert len(got) == len(truth)
    tested = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in tested) >= 0.99 * len(tested)
    assert all(0 <= r.score <= 1 and r.lang_pred in r.languages for r in got)


def model(seed=0, k=4):
    rng = np.random.default_rng(seed)
    p = rng.gamma(0.05, size=(langid.BUCKETS, k)) + 1e-9
    return np.log(p / p.sum(axis=0))


def mixture(logs, n, members):
    """Proportions and log-likelihood of one text for a set of languages."""
    p, pi = np.exp(logs[:, members]), np.full(len(members), 1 / len(members))
    w = n / langid.OVERLAP
    for _ in range(2000):
        part = p * pi
        pi = (part * (w / part.sum(axis=1))[:, None]).sum(axis=0) / w.sum()
    return pi, float((w * np.log(p @ pi)).sum())


@pytest.mark.parametrize("seed", range(4))
def test_sets_equal_exhaustive_search(seed):
    """Texts drawn from clear mixtures: the set of the best penalised
    likelihood among all sets, and its proportions."""
    logs, rng = model(seed), np.random.default_rng(seed)
    mixes = [(1, 0, 0, 0), (0, 0.5, 0.5, 0), (0.4, 0.3, 0, 0.3), (0.25, 0.25, 0.25, 0.25), (0, 0, 0.05, 0.95), (0, 0, 0, 1)]
    found = [np.unique(rng.choice(langid.BUCKETS, size=size, p=np.exp(logs) @ np.array(mix)), return_counts=True)
             for mix, size in zip(mixes, (300, 600, 900, 1500, 800, 3))]
    starts = np.cumsum([0, *[len(b) for b, _ in found]])[:-1]
    share = langid.proportions(starts, np.concatenate([b for b, _ in found]), np.concatenate([n for _, n in found]),
                               logs, np.exp(logs))
    for (bucket, n), pi in zip(found, share):
        best = None
        for size in range(1, 5):
            for members in itertools.combinations(range(4), size):
                mix, value = mixture(logs[bucket], n, list(members))
                value -= langid.PENALTY * math.log(n.sum() + 1) * size
                if best is None or value > best[0]:
                    best = value, members, mix
        assert tuple(np.flatnonzero(pi)) == best[1]
        assert np.allclose(pi[list(best[1])], best[2], atol=0.01)


def test_counting():
    texts = ["", "Ab c", "é", "x" * 50, "Ab c", "12 .,", "a b"]
    got = {}
    for first, starts, bucket, n in langid.counted([t for t in texts if any(map(str.isalpha, t))]):
        ends = [*starts[1:], len(bucket)]
        for i, (a, b) in enumerate(zip(starts, ends)):
            got[first + i] = dict(zip(bucket[a:b].tolist(), n[a:b].tolist()))
    for i, t in enumerate(t for t in texts if any(map(str.isalpha, t))):
        raw = langid._bytes(t)
        want: dict = {}
        for tri in zip(raw, raw[1:], raw[2:]):
            if b"  " not in bytes(tri):
                code = (tri[0] << 16 | tri[1] << 8 | tri[2]) * 2_654_435_761 % (1 << 32) >> 32 - langid.BUCKET_BITS
                want[code] = want.get(code, 0) + 1
        assert got[i] == want


def test_long_text_by_stretches(monkeypatch):
    text = "the quick brown Fuchs springt über den Zaun " * 400
    whole = langid._counts([langid._bytes(text)])
    monkeypatch.setattr(langid, "STRETCH", 1000)
    parts = langid._counts([langid._bytes(text)])
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts))


def test_odd_rows(spark):
    known = [(i, "the cat and the dog and the bird", "en", 1, "f") for i in range(40)]
    known += [(100 + i, "der hund und die katze und der vogel", "de", 1, "f") for i in range(40)]
    odd = [(500, None, "en", 1, "f"), (501, "", None, 1, "f"), (502, "123 !?", "de", 1, "f"), (None, "und die katze", None, 1, "f"),
           (503, "the dog", None, None, None), (503, "the dog", None, None, None), (504, "the bird and the cat " * 200_000, None, 1, ""),
           (505, "the cat and the dog and the bird der hund und die katze und der vogel " * 20, None, 1, "")]
    df = spark.createDataFrame(known + odd, SCHEMA).repartition(6)
    learned = langid.learn(df)
    assert learned.names == ["de", "en"]
    got = langid.annotate(df, learned)
    assert got.select("row.*").columns == df.columns
    rows = [(r.row.doc_id, r.found) for r in got.collect()]
    assert len(rows) == len(known) + len(odd)
    by = {i: f for i, f in rows}
    for i in (500, 501, 502):
        assert tuple(by[i]) == ("und", 0.0, [], [])
    assert by[None].lang == "de" and by[503].lang == "en" and by[504].lang == "en" and by[504].score > 0.99
    assert sorted(by[505].languages) == ["de", "en"] and by[505].shares[0] < 0.7
    assert [f for i, f in rows if i == 503][0] == [f for i, f in rows if i == 503][1]


def test_nothing_learned_and_empty_table(spark):
    df = spark.createDataFrame([(1, "some text", None, 0, ""), (2, None, None, 0, "")], SCHEMA)
    none = langid.learn(df)
    assert none.names == []
    assert {r.found.lang for r in langid.annotate(df, none).collect()} == {"und"}
    empty = df.where("false")
    assert langid.annotate(empty, langid.learn(empty)).collect() == []


def test_sample_share_never_vanishes(spark):
    rows = spark.range(200_000)
    assert 60 <= rows.where(hash_share(5e-4, "id")).count() <= 150
    bound = hash_share(1e-15, F.col("id"))._jc.toString()
    assert "9223372036854757" in bound  # a threshold above the least hash
    assert rows.where(hash_share(1.0, "id")).count() == 200_000
