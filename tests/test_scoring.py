"""Golden values (FIXTURES section 3.1-3.3) and properties of the scorers."""

import random

import pytest
from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.functions.lcs import lcs_length, lcs_table, lcs_tokens, union_lcs
from quire.operators import bleu as bl
from quire.operators import rouge as rg

PAIRS = [
    ("the cat sat on the mat", "the cat is on the mat"),
    ("a a a b", "a b a"),
    ("x", "y"),
    ("one", "one two"),
]


def bleu4_scalar(hyp: str, ref: str) -> float:
    """Independent scalar version for tests."""
    import math
    from collections import Counter
    nums, dens = [], []
    for n in range(1, 4 + 1):
        ch = Counter(hyp[i:i + n] for i in range(len(hyp) - n + 1))
        cr = Counter(ref[i:i + n] for i in range(len(ref) - n + 1))
        nums.append(sum(min(c, cr[g]) for g, c in ch.items()))
        dens.append(max(1, sum(ch.values())))
    if nums[0] == 0:
        return 0.0
    k, s = 0, 0.0
    for num, den in zip(nums, dens):
        if num == 0:
            k += 1
            p = 1.0 / (2 ** k * den)
        else:
            p = num / den
        s += math.log(p) / 4
    h, r = len(hyp), len(ref)
    bp = 1.0 if h > r else (0.0 if h == 0 else math.exp(1 - r / h))
    return bp * math.exp(s)


def _scores(spark, exclusive=True, metrics=("rouge-1", "rouge-2", "rouge-l")):
    df = spark.createDataFrame([(i, h, r) for i, (h, r) in enumerate(PAIRS)], "id int, hyp string, ref string")
    out = rg.score(df, "hyp", "ref", metrics=list(metrics), exclusive=exclusive).orderBy("id").collect()
    return {r["id"]: r for r in out}


def close(a, b):
    return abs(a - b) < 5e-7


def test_rouge_set_golden(spark):
    s = _scores(spark)
    r = s[0]
    assert close(r["rouge_1_p"], 0.8) and close(r["rouge_1_r"], 0.8) and close(r["rouge_1_f"], 0.8)
    assert close(r["rouge_2_f"], 0.6) and close(r["rouge_l_f"], 0.833333)
    r = s[1]
    assert close(r["rouge_1_p"], 1) and close(r["rouge_1_r"], 1) and close(r["rouge_1_f"], 1)
    assert close(r["rouge_2_p"], 0.5) and close(r["rouge_2_r"], 0.5)
    assert close(r["rouge_l_p"], 0.5) and close(r["rouge_l_r"], 0.666667) and close(r["rouge_l_f"], 0.571429)
    assert all(s[2][f"rouge_{m}_{x}"] == 0 for m in ("1", "2", "l") for x in "rpf")
    r = s[3]
    assert close(r["rouge_1_p"], 1) and close(r["rouge_1_r"], 0.5) and close(r["rouge_1_f"], 0.666667)
    assert close(r["rouge_l_f"], 0.666667) and r["rouge_2_f"] == 0


def test_rouge_multiset_golden(spark):
    s = _scores(spark, exclusive=False, metrics=("rouge-1", "rouge-2"))
    assert close(s[0]["rouge_1_f"], 0.833333)
    assert close(s[1]["rouge_1_p"], 0.75) and close(s[1]["rouge_1_r"], 1) and close(s[1]["rouge_1_f"], 0.857143)
    assert close(s[1]["rouge_2_p"], 0.333333) and close(s[1]["rouge_2_r"], 0.5) and close(s[1]["rouge_2_f"], 0.4)


def test_unknown_metric_raises(spark):
    df = spark.createDataFrame([("a", "b")], "h string, r string")
    with pytest.raises(ValueError):
        rg.score(df, "h", "r", metrics=["rouge-9"])


def test_identity_and_symmetry(spark):
    texts = ["alpha beta gamma. delta", "un deux trois quatre cinq six", "a b a b a b"]
    df = spark.createDataFrame([(t, t) for t in texts], "h string, r string")
    for row in rg.score(df, "h", "r").collect():
        for m in ("rouge_1_f", "rouge_2_f", "rouge_l_f"):
            assert 1 - 1e-7 < row[m] < 1.0  # 1e-8 in the denominator
    df2 = spark.createDataFrame([("a b c d", "b c e")], "h string, r string")
    a = rg.score(df2, "h", "r").first()
    b = rg.score(df2, "r", "h").first()
    assert close(a["rouge_1_p"], b["rouge_1_r"]) and close(a["rouge_l_p"], b["rouge_l_r"])


def _bleu_rows(spark, pairs):
    df = spark.createDataFrame(pairs, "h string, r string")
    return [round(x[0] * 100, 4) for x in df.select(bl.bleu4(F.col("h"), F.col("r"))).collect()]


def test_bleu_golden(spark):
    pairs = [("the cat sat", "the cat sat"), ("the cat", "the cat sat"), ("abcd", "abxd"), ("ab", "ba"), ("x", "y")]
    got = _bleu_rows(spark, pairs)
    assert got == [100.0, 56.4718, 35.3553, 35.3553, 0.0]
    assert [round(bleu4_scalar(h, r) * 100, 4) for h, r in pairs] == got


def test_bleu_matches_python_random(spark):
    rnd = random.Random(5)
    alpha = "abcde "
    pairs = [("".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 30))),
              "".join(rnd.choice(alpha) for _ in range(rnd.randint(1, 30)))) for _ in range(60)]
    got = _bleu_rows(spark, pairs)
    want = [round(bleu4_scalar(h, r) * 100, 4) for h, r in pairs]
    assert all(abs(a - b) < 1e-3 for a, b in zip(got, want))


def test_sentence_split_golden(spark):
    cases = [
        ("你好。我很好！“是吗？”他说。好", ["你好。", "我很好！", "“是吗？”", "他说。", "好"]),
        ("a b? c d......e f", ["a b?", " c d......", "e f"]),
        ("Hi! Ok. Go? yes", ["Hi! Ok. Go?", " yes"]),
        ("??a。。b", ["?", "?a。", "。b"]),
        ("trailing \x1c\n ", ["trailing"]),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = {r["i"]: r["s"] for r in df.select("i", tx.split_sentences(F.col("t")).alias("s")).collect()}
    for i, (_, want) in enumerate(cases):
        assert got[i] == want


def test_whitespace_and_words(spark):
    df = spark.createDataFrame([("a  b　c \x1c d",), ("   ",)], "t string")
    rows = df.select(tx.collapse_ws(F.col("t")).alias("c"), tx.rouge_words(F.col("t")).alias("w"),
                     tx.word_count(F.col("t")).alias("n")).collect()
    assert rows[0]["c"] == "a b c d" and rows[0]["n"] == 4
    assert rows[1]["w"] is None and rows[1]["n"] == 0


def test_ngrams_short(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],)], "w array<string>")
    got = [r[0] for r in df.select(tx.ngrams(F.col("w"), 2)).collect()]
    assert got == [["a b", "b c"], []]


def test_lcs_against_dp():
    rnd = random.Random(1)
    for _ in range(300):
        a = [rnd.choice("abcd") for _ in range(rnd.randint(0, 40))]
        b = [rnd.choice("abcd") for _ in range(rnd.randint(0, 40))]
        want = lcs_table(a, b)[len(a)][len(b)]
        assert lcs_length(a, b) == want <= min(len(a), len(b))
        assert len(lcs_tokens(a, b)) == want


def test_union_lcs_example():
    ref = "w1 w2 w3 w4 w5".split()
    hyps = ["w1 w2 w6 w7 w8".split(), "w1 w3 w8 w9 w5".split()]
    n, union = union_lcs(ref, hyps)
    assert n == 4 and set(union) == {"w1", "w2", "w3", "w5"}
    with pytest.raises(ValueError):
        union_lcs(ref, [])


def test_segment_han(spark):
    df = spark.createDataFrame([("中文abc 好",)], "t string")
    assert df.select(tx.segment(F.col("t"))).first()[0] == "中 文 abc 好"


def test_is_cjk(spark):
    words = ["", "中文", "中a", "龥", "龦"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(tx.is_cjk_word(F.col("w"))).collect()]
    assert got == [True, True, False, True, False]
