"""Exact dedup and SimHash near-dedup against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F
import xxhash

from quire.llm import exact_dedup, simhash
from quire.llm.graph import components

DOC = "doc_id long, text string, row string, norm int"


def spoiled(rng, text):
    words = text.split()
    words[rng.randrange(len(words))] = "changed"
    return " ".join(words)


def rows():
    rng = random.Random(5)
    out = [(1, "a b\tc", "x", 1), (2, "abc ", "y", 2), (3, "ab\n c ", None, None), (4, "", "z", 0), (5, None, "z", 0),
           (6, " \x0b\x0c\r", "", 1), (7, "a b", "", 1), (7, "a b", "", 1), (None, "abc", None, None)]
    base = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(rng.randrange(50))
                     for _ in range(80)) for _ in range(6)]
    k = 10
    for b in base:
        for _ in range(6):
            out.append((k, b if rng.random() < .3 else spoiled(rng, b), "r", k))
            k += 1
    out += [(k + i, "same text over and over", "hot", i) for i in range(300)]
    out.append((k + 300, "word " * 60_000, "long", 1))
    return out


def brute_exact(data):
    groups = {}
    for d, t, *_ in data:
        groups.setdefault(re.sub("[ \t-\r]", "", t or ""), []).append((d, t or ""))
    out = []
    for g in groups.values():
        g.sort(key=lambda x: (-len(x[1]), x[0] is None, x[0] or 0))
        out += [(d, g[0][0], len(g), i == 0) for i, (d, _) in enumerate(g)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [1, 10**9])
def test_exact_dedup_matches_brute_force(spark, monkeypatch, hot):
    # hot = 1: every group is salted; else: only those of the share rule
    monkeypatch.setattr(exact_dedup, "hot_limit", lambda n: hot)
    data = rows()
    got = exact_dedup.annotate(spark.createDataFrame(data, DOC).repartition(7)).collect()
    assert sorted([(r.row.doc_id, r.keep_id, r.group_size, r.kept) for r in got], key=repr) == brute_exact(data)
    kept = exact_dedup.deduplicate(spark.createDataFrame(data, DOC))
    assert kept.columns == ["doc_id", "text", "row", "norm"]
    assert kept.count() == sum(r[3] for r in brute_exact(data))


@pytest.mark.parametrize("salt_rows", [3, 256])
def test_different_texts_under_one_hash(spark, monkeypatch, salt_rows):
    """With a digest of half a hex digit every hash is hot and holds many
    texts: sizes and winners come from comparing whole texts."""
    monkeypatch.setattr(exact_dedup, "hot_limit", lambda n: 2)
    monkeypatch.setattr(exact_dedup, "ROWS_PER_SALT", salt_rows)
    monkeypatch.setattr(exact_dedup, "digest", lambda norm: F.when(F.md5(norm) < "8", "0").otherwise("1"))
    data = rows()
    got = exact_dedup.annotate(spark.createDataFrame(data, DOC).repartition(7)).collect()
    assert sorted([(r.row.doc_id, r.keep_id, r.group_size, r.kept) for r in got], key=repr) == brute_exact(data)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOC)
    assert exact_dedup.deduplicate(empty).collect() == []
    assert simhash.annotate(empty).collect() == []
    assert simhash.one_per_group(empty).collect() == []


def brute_fingerprint(text):
    words = re.findall("[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    sh = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


def test_simhash_matches_brute_force(spark):
    data = rows()
    fps = [brute_fingerprint(t) for _, t, *_ in data]
    want = sorted(((d, f"{f:016x}", c) for (d, *_), f, c in
                   zip(data, fps, brute_components([d for d, *_ in data], fps))), key=repr)
    got = simhash.annotate(spark.createDataFrame(data, DOC).repartition(5)) \
        .select("id", simhash.fingerprint_hex(simhash.F.col("fp")), "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == want
    kept = simhash.one_per_group(spark.createDataFrame(data, DOC))
    assert kept.columns == ["doc_id", "text", "row", "norm"]
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(ids) == sorted({c for _, _, c in want if c is not None})


def test_one_id_on_unlike_texts(spark):
    """An id that is the smallest of two components stays once in each."""
    rng = random.Random(8)
    one, two = [" ".join(str(rng.randrange(10**6)) for _ in range(400)) for _ in range(2)]
    data = [(1, one, "a", 1), (1, two, "b", 1), (2, one, "c", 1), (3, two, "d", 1), (3, two, "d", 1)]
    kept = simhash.one_per_group(spark.createDataFrame(data, DOC).repartition(3)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(1, one), (1, two)])


@pytest.mark.parametrize("bucket", [24, 1024])
def test_links_of_crowded_buckets(spark, monkeypatch, bucket):
    """Clouds of close fingerprints: also when buckets must be split again."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(3)
    fps = {0, 2**64 - 1, 1 << 63}
    for _ in range(5):
        base = rng.getrandbits(64)
        for _ in range(40):
            f = base
            for _ in range(rng.randrange(7)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    fps = sorted(fps)
    ids = [simhash._signed(f) for f in fps]
    nodes = spark.createDataFrame([(f,) for f in ids], "fp long")
    got = {r.node: r.root for r in components(simhash.links(nodes)).collect()}
    assert [got.get(f, f) for f in ids] == brute_components(ids, fps)


def test_masks_cover_every_small_set():
    from itertools import combinations
    for free in (list(range(0, 64, 3)), list(range(8))):
        masks = simhash.covering_masks(free)
        for n in (1, 2, 3):
            for s in combinations(free, n):
                assert any(not any(m >> p & 1 for p in s) for m in masks)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
