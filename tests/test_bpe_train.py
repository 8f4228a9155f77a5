"""The incremental BPE trainer against one that recounts all pairs."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quire.operators import vocab as vc


def naive(words, num_merges):
    """words: {word: freq}."""
    state = {w: list(w) for w in words}
    out = []
    while len(out) < num_merges:
        counts = Counter()
        for w, syms in state.items():
            for pair in zip(syms, syms[1:]):
                counts[pair] += words[w]
        if not counts:
            break
        (left, right), n = min(counts.items(), key=lambda x: (-x[1], x[0]))
        out.append((left, right, n))
        for w, syms in state.items():
            new, i = [], 0
            while i < len(syms):
                if syms[i:i + 2] == [left, right]:
                    new.append(left + right)
                    i += 2
                else:
                    new.append(syms[i])
                    i += 1
            state[w] = new
    return out


def both(df, merges, **more):
    words = {r.word: r.freq for r in vc.bpe_words(df, "text", normalise=False).collect()}
    got = vc.train_bpe(df, merges, normalise=False, **more).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(len(got)))
    assert all(r.merged == r.left + r.right for r in got)
    return [(r.left, r.right, r["count"]) for r in got], naive(words, merges)


@pytest.mark.parametrize("head", [3, 10, 1_000_000])
def test_equals_recounting(spark, head, monkeypatch):
    monkeypatch.setattr(vc, "PENDING", 5)
    rng = random.Random(head)
    lines = ["".join(rng.choice("aab bcdé") for _ in range(rng.randrange(40))) for _ in range(120)]
    lines += ["aaaa aaa aaaaa", "aa", "", None, chr(0x40000) + "a" + chr(0x40000) + "a" + chr(0x40002)]
    df = spark.createDataFrame([(t,) for t in lines], "text string").repartition(4)
    got, want = both(df, 60, head_pairs=head)
    assert got == want and len(got) == 60


def test_until_no_pair_is_left(spark):
    df = spark.createDataFrame([("ab ab cd",), ("abcd",)], "text string")
    got, want = both(df, 500)
    assert got == want and got[-1][2] >= 1
    empty = spark.createDataFrame([], "text string")
    assert vc.train_bpe(empty, 5, normalise=False).collect() == []


def test_equals_recounting_on_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    got, want = both(df, 150)
    assert got == want


def zipf_lines(rng, n=400):
    words = ["".join(rng.choice("etaoinshrdlucmf") for _ in range(rng.randrange(2, 9))) for _ in range(600)]
    weights = [1 / (k + 1) for k in range(len(words))]
    return [" ".join(rng.choices(words, weights, k=30)) for _ in range(n)]


@pytest.mark.parametrize("sample, most", [(100_000, 16), (200, 40)])
def test_few_jobs(spark, monkeypatch, sample, most):
    """A job settles many merges, also where counts lie so close that the
    order of those that do not touch is not guessed. A small sample takes more
    jobs and changes no merge."""
    monkeypatch.setattr(vc, "SAMPLE_WORDS", sample)
    jobs, one = [], vc._changes
    monkeypatch.setattr(vc, "_changes", lambda *a: jobs.append(1) or one(*a))
    df = spark.createDataFrame([(t,) for t in zipf_lines(random.Random(5))], "text string")
    got, want = both(df, 400)
    assert got == want and len(got) == 400
    assert len(jobs) <= most, len(jobs)


def test_batched_equals_rounds(spark):
    """Batched mode: each round takes the best pairs that share no symbol."""
    df = spark.createDataFrame([(t,) for t in zipf_lines(random.Random(6), 60)], "text string")
    state = {r.word: [r.freq, *r.word] for r in vc.bpe_words(df, "text", normalise=False).collect()}
    want = []
    while len(want) < 90:
        counts = Counter()
        for freq, *syms in state.values():
            for pair in zip(syms, syms[1:]):
                counts[pair] += freq
        held, picked = set(), []
        for pair, n in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:8 * 4]:
            if held.isdisjoint(pair):
                held.update(pair)
                picked.append((pair, n))
        for (left, right), n in picked[:4][:90 - len(want)]:
            want.append((left, right, n))
            for word, (freq, *syms) in state.items():
                new = []
                for x in syms:
                    if new and new[-1] == left and x == right:
                        new[-1] = left + right
                    else:
                        new.append(x)
                state[word] = [freq, *new]
    got = vc.train_bpe(df, 90, normalise=False, merges_per_round=4).orderBy("rank").collect()
    assert [(r.left, r.right, r["count"]) for r in got] == want


def test_words_of_runs_between_markers(spark):
    lines = ["a  b ", " x", "é\t中文 a12", vc.SP_SPACE * 2 + "q" + vc.SP_SPACE, "a\u0301 \u0301b", "a b\n\nb  c!? ,", "", None]
    df = spark.createDataFrame([(t,) for t in lines], "text string")
    want = Counter(w for r in vc.text_lines(df).select(vc.pretokens(F.col("line")).alias("w")).collect() for w in r.w)
    assert {r.word: r.freq for r in vc.bpe_words(df).collect()} == want


def test_encoding_in_place_equals_the_join(spark):
    """The same pieces and ids as by joining distinct words, without a
    shuffle; also for keys that are null or come twice."""
    train = spark.createDataFrame([("the low lower lowest newer newest wide 12",)] * 3, "text string")
    vocab, merges = vc.train_vocab(train, 300)
    df = spark.createDataFrame([(1, "lowest newest é🙂 unseen\n\nthe 中"), (2, "the the"), (3, ""), (4, None), (5, "new\nlow"),
                                (5, "wide\nlow"), (None, "the low")], "id int, text string")
    rows = lambda d: sorted(map(str, d.collect()))
    for v in (vocab, None):
        want = vc._encode_by_join(df, ["id"], merges, v, "text", True)
        assert rows(vc.bpe_encode_texts(df, ["id"], merges, v)) == rows(want) and want.count() == 6
    once = vc.bpe_encode_texts(df.where("id < 5"), ["id"], merges, vocab)
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
