"""Golden values of FIXTURES section 3.4-3.6 and ordering/sharding properties."""

import math
import os

import pytest
from pyspark.sql import functions as F

from quire.functions import arrays as ar
from quire.functions import text as tx
from quire.operators import infer as inf
from quire.operators import order as od
from quire.operators import prep as pp
from quire.operators import reward as rw
from quire.operators import runs as rn
from quire.operators import vocab as vc
from quire.sources import files as fs
from quire.sources import sinks as sk


def test_example_layout(spark):
    df = spark.createDataFrame([(list(range(1, 8)), list(range(11, 16)))], "a array<int>, b array<int>")
    e = df.select(pp.build_example(F.col("a"), F.col("b"), 6, 5, 90, 91, 92, 0).alias("e")).first()["e"]
    assert e["input_ids"] == [1, 2, 3, 4, 5, 90, 91, 11, 12, 13, 92]
    assert e["labels"] == [-100] * 6 + [91, 11, 12, 13, 92]
    short = spark.createDataFrame([([1], [11])], "a array<int>, b array<int>")
    e2 = short.select(pp.build_example(F.col("a"), F.col("b"), 6, 5, 90, 91, 92, 0).alias("e")).first()["e"]
    assert len(e2["input_ids"]) == 11 and e2["labels"][-1] == -100


def test_render_history_and_modes(spark):
    df = spark.createDataFrame([([("q0", "a0")], "q1"), ([], "q")], "h array<struct<q:string,a:string>>, q string")
    rows = df.select(pp.build_prompt(F.col("q"), F.col("h"), "train").alias("t"),
                     pp.build_prompt(F.col("q"), F.col("h"), "eval").alias("e")).collect()
    assert rows[0]["t"] == "[Round 0]\n问：q0\n答：a0\n[Round 1]\n问：q1\n答："
    assert rows[1]["e"] == "q" and rows[1]["t"] == "[Round 0]\n问：q\n答："


def test_alpaca_and_complete(spark):
    df = spark.createDataFrame([("ins", " x ", "out"), ("ins", " xy ", "out")], "i string, n string, o string")
    got = [r[0][0]["value"] for r in df.select(pp.alpaca_to_sharegpt(F.col("i"), F.col("n"), F.col("o"))).collect()]
    assert got == ["ins", "ins\n\n xy "]
    p = spark.createDataFrame([(None, "a"), ("", "a"), ("a", ""), ("a", "b")], "content string, summary string")
    assert [tuple(r) for r in pp.filter_complete(p).collect()] == [("a", "b")]


def test_keep_last(spark):
    df = spark.createDataFrame([(list(range(3000)),)], "ids array<int>")
    r = df.select(F.size(pp.keep_last(F.col("ids"), 2048 - 512 - 8)).alias("n"),
                  F.size(pp.keep_last(F.col("ids"), 0)).alias("z")).first()
    assert r["n"] == 1528 and r["z"] == 0


def test_merge_vocab_golden(spark):
    base = spark.createDataFrame([(0, "a", -1.0), (1, "b", -2.0)], "id long, piece string, score double")
    dom = spark.createDataFrame([(0, "b"), (1, "c")], "id long, piece string")
    cjk = spark.createDataFrame([("中",), ("c",)], "word string")
    top = spark.createDataFrame([("d", 0), ("中", 1)], "word string, rank int")
    m = vc.merge_vocab(base, dom, cjk, top).orderBy("id").collect()
    assert [r["piece"] for r in m] == ["a", "b", "c", "中", "d"]
    assert [r["id"] for r in m] == [0, 1, 2, 3, 4]
    assert [r["score"] for r in m][2:] == [0.0, 0.0, 0.0]


def test_chunks(spark):
    c = spark.createDataFrame([(1, 0, "he"), (1, 1, "llo</s>x"), (1, 2, "y"), (2, 0, "he</"), (2, 1, "s>y")],
                              "k int, s int, t string")
    got = {r["k"]: r["text"] for r in inf.assemble_chunks(c, "k", "s", "t", "</s>").collect()}
    assert got == {1: "hello", 2: "he</s>y"}
    got2 = {r["k"]: r["text"] for r in inf.assemble_chunks(c, "k", "s", "t", "</s>", across=True).collect()}
    assert got2[2] == "he"


def test_html_transcript(spark):
    text = "a <b>\n\n```py\nx = (1)\n```\nend."
    df = spark.createDataFrame([(text,), ("",)], "t string")
    got = [r[0] for r in df.select(tx.render_transcript_html(F.col("t"))).collect()]
    assert got[0] == 'a <b><pre><code class="language-py"><br>x&nbsp;=&nbsp;&#40;1&#41;<br></code></pre><br>end.'
    assert got[1] == ""


def test_reward_losses(spark):
    df = spark.createDataFrame([(2.0, 0.5), (0.5, 1.0), (1.5, 1.0)], "chosen double, rejected double")
    m = rw.reward_metrics(df).first()
    assert abs(m["margin_loss"] - 0.666667) < 1e-6 and abs(m["contrastive"] - 0.916667) < 1e-6
    assert abs(m["mse"] - 0.916667) < 1e-6 and abs(m["mae"] - 0.833333) < 1e-6
    assert abs(m["loss"] - 0.841667) < 1e-6 and abs(m["perplexity"] - 2.320231) < 1e-6
    big = spark.createDataFrame([(1000.0,)], "x double").select(F.exp("x")).first()[0]
    assert big == math.inf


def test_softmax(spark):
    df = spark.createDataFrame([([1.0, 2.0, 0.0],)], "l array<double>")
    r = df.select(ar.softmax_at(F.col("l"), 1).alias("q"), ar.log_softmax(F.col("l")).alias("ls")).first()
    assert abs(r["q"] - 0.665241) < 1e-6
    assert all(abs(a - b) < 1e-6 for a, b in zip(r["ls"], [-1.407606, -0.407606, -2.407606]))


def test_runs_golden(spark):
    b = spark.createDataFrame([(0.5, 4), (0.2, 4), (0.9, 2)], "loss double, rows int")
    assert abs(rn.row_weighted_mean(b, "loss", "rows").first()[0] - 0.46) < 1e-9
    steps = spark.createDataFrame([("r", 1, 1.0), ("r", 2, float("nan")), ("r", 3, 3.0)], "run string, step int, loss double")
    w = rn.nan_filtered_interval(steps, "run", "step", "loss", 10).first()
    assert abs(w["running_sum"] - 4.5) < 1e-9 and abs(w["loss"] - 1.5) < 1e-9
    m = spark.createDataFrame([("r", 1, 0.2), ("r", 2, 0.5), ("r", 3, 0.5), ("r", 4, 0.3)], "run string, step int, m double")
    last = rn.best_so_far(m, "run", "step", "m").orderBy("step").collect()[-1]
    assert last["best_step"] == 2 and last["best_metric"] == 0.5
    nan_first = spark.createDataFrame([("r", 1, float("nan")), ("r", 2, 0.5)], "run string, step int, m double")
    assert rn.best_so_far(nan_first, "run", "step", "m").orderBy("step").collect()[-1]["best_step"] == 1


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_row_index_partition_invariant(spark, parts):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(parts)
    got = {r["k"]: r["row_idx"] for r in od.with_row_index(df, ["k"]).collect()}
    assert got == {k: k for k in range(1000)}
    perm = {r["k"]: r["perm_idx"] for r in od.shuffled_index(df, "k", 3).collect()}
    assert sorted(perm.values()) == list(range(1000))
    assert perm == {r["k"]: r["perm_idx"] for r in od.shuffled_index(df.repartition(5), "k", 3).collect()}


def test_shards_cover(spark):
    df = spark.range(0, 101).withColumnRenamed("id", "rid")
    s = od.shard_round_robin(df, "rid", 4, seed=1).collect()
    sizes = {}
    for r in s:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + 1
    assert set(sizes.values()) == {26} and {r["rid"] for r in s} == set(range(101))
    blocks = od.shard_blocks(od.with_row_index(df, ["rid"], name="idx"), "idx", 3, 8).collect()
    assert len(blocks) == 120 and {r["rid"] for r in blocks} == set(range(101))


def test_bpe_matches_naive(spark):
    texts = ["low lower lowest", "newer newest new", "low new lower"]
    corpus = spark.createDataFrame([(t,) for t in texts], "text string")
    merges = [(r["left"], r["right"]) for r in vc.train_bpe(corpus, 6, normalise=False).orderBy("rank").collect()]
    # naive reference: same pre-tokens, same tie rule
    from collections import Counter
    sp = vc.SP_SPACE
    words = Counter()
    for t in texts:
        for w in (sp + t.replace(" ", sp)).split(sp)[1:]:
            words[tuple(sp + w)] += 1
    want = []
    for _ in range(6):
        pairs = Counter()
        for w, f in words.items():
            for a, b in zip(w, w[1:]):
                pairs[(a, b)] += f
        best = sorted(pairs.items(), key=lambda kv: (-kv[1], kv[0][0], kv[0][1]))[0][0]
        want.append(best)
        nw = Counter()
        for w, f in words.items():
            out, i = [], 0
            while i < len(w):
                if i + 1 < len(w) and (w[i], w[i + 1]) == best:
                    out.append(w[i] + w[i + 1])
                    i += 2
                else:
                    out.append(w[i])
                    i += 1
            nw[tuple(out)] += f
        words = nw
    assert merges == want


def test_json_dir_mixed(spark, scratch):
    os.makedirs(f"{scratch}/sub")
    open(f"{scratch}/a.json", "w").write('[{"q":"x"},{"q":"y"}]')
    open(f"{scratch}/sub/b.jsonl", "w").write('{"q":"z"}\n{"q":"w"}\n')
    open(f"{scratch}/c.txt", "w").write("ignored\n")
    open(f"{scratch}/d.json", "w").write('{"q":"u"}\n{"q":"v"}\n')
    df = fs.read_json_dir(spark, scratch, "q string")
    got = sorted(r["q"] for r in df.collect())
    assert got == ["u", "v", "w", "x", "y", "z"]


def test_aligned_files(spark, scratch):
    open(f"{scratch}/h.txt", "w").write("a b\nc d")
    open(f"{scratch}/r.txt", "w").write("a b\nc e\n")
    al = fs.read_aligned(spark, f"{scratch}/h.txt", f"{scratch}/r.txt").orderBy("line").collect()
    assert [(r["hyp"], r["ref"]) for r in al] == [("a b", "a b"), ("c d", "c e")]
    open(f"{scratch}/r3.txt", "w").write("a\nb\nc\n")
    with pytest.raises(ValueError):
        fs.read_aligned(spark, f"{scratch}/h.txt", f"{scratch}/r3.txt")


def test_require_columns_and_splits(spark):
    df = spark.createDataFrame([("a",)], "content string")
    with pytest.raises(fs.MissingColumns):
        fs.require_columns(df, ["content", "summary"])
    with pytest.raises(ValueError):
        fs.require_splits({"train": "x"}, ["validation"])


def test_identical_splits_warn(spark):
    df = spark.createDataFrame([("train", "a"), ("train", "b"), ("validation", "b"), ("validation", "a")],
                               "split string, text string")
    assert sk.warn_identical_splits(df) == [("train", "validation")]


def test_word_freq_files(spark, scratch):
    open(f"{scratch}/wf.txt", "w").write("the 10\nof 7\nbad\nand x\n")
    good, bad = fs.read_word_freq(spark, f"{scratch}/wf.txt")
    assert sorted((r["word"], r["freq"]) for r in good.collect()) == [("of", 7), ("the", 10)]
    assert sorted(r["raw"] for r in bad.collect()) == ["and x", "bad"]
    open(f"{scratch}/v.txt", "w").write("w1 3\n\nw2\nw1 x\n")
    assert sorted(r["word"] for r in fs.read_vocab_words(spark, f"{scratch}/v.txt").collect()) == ["w1", "w2"]


def test_word_freq_beyond_an_int(spark, scratch):
    open(f"{scratch}/wf.txt", "w").write("the 3000000000\n")
    good, bad = fs.read_word_freq(spark, f"{scratch}/wf.txt")
    assert [(r["word"], r["freq"]) for r in good.collect()] == [("the", 3000000000)] and bad.count() == 0


def test_vocabulary_without_room_for_merges(spark):
    df = spark.createDataFrame([("".join(map(chr, range(0x4E00, 0x4E00 + 300))),)], "text string")
    with pytest.raises(ValueError, match="more are needed"):
        vc.train_vocab(df, 500)


def test_running_sum_hot_group(spark):
    # one group holds most rows; the prefix sum must equal the sequential one
    rows = [("hot", i, i % 3) for i in range(900)] + [("cold", i, 1) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, o int, v int").repartition(7)
    got = {(r["g"], r["o"]): r["running"] for r in od.running_sum(df, F.col("v"), ["o"], ["g"]).collect()}
    acc = {}
    for g, o, v in rows:
        acc[g] = acc.get(g, 0) + v
        assert got[(g, o)] == acc[g]


def test_bpe_batched_and_encode_paths(spark):
    texts = ["low lower lowest", "newer newest new", "low new lower"]
    corpus = spark.createDataFrame([(t,) for t in texts], "text string")
    batched = vc.train_bpe(corpus, 6, normalise=False, merges_per_round=3).orderBy("rank").collect()
    assert len(batched) == 6
    exact = vc.train_bpe(corpus, 1, normalise=False).collect()[0]
    assert (batched[0]["left"], batched[0]["right"]) == (exact["left"], exact["right"])
    # the lookup and the join encode paths agree
    v = spark.createDataFrame([(0, "<unk>"), (1, "low"), (2, "new")], "id long, piece string")
    df = spark.createDataFrame([(1, "low new x"), (2, "")], "k int, t string")
    a = {r["k"]: r["ids"] for r in vc.encode(df, ["k"], vc.ws_tokens("t"), v, 0).collect()}
    b = {r["k"]: r["ids"] for r in vc.encode(df, ["k"], vc.ws_tokens("t"), v, 0, lookup_rows=0).collect()}
    assert a == b == {1: [1, 2, 0], 2: []}


def test_row_index_hot_value(spark):
    # one value of the first key holds most rows: it is split by the second key
    rows = [(5, i) for i in range(600)] + [(k, 0) for k in range(10) if k != 5]
    df = spark.createDataFrame(rows, "a int, b int").repartition(4)
    got = sorted((r["a"], r["b"], r["row_idx"]) for r in od.with_row_index(df, ["a", "b"], buckets=8).collect())
    want = sorted(rows)
    assert [(a, b) for a, b, _ in sorted(got, key=lambda x: x[2])] == want
    assert od._ranged(df, [], ["a", "b"], 8).where("a = 5").select("__pid").distinct().count() > 1


def test_row_index_nulls_and_text_keys(spark):
    rows = [(g, k, i) for i, (g, k) in enumerate(
        [(None, "b"), (None, None), ("x", "a"), ("x", None), (None, "a"), ("y", "c"), ("x", "b")] * 40)]
    df = spark.createDataFrame(rows, "g string, k string, i int").repartition(5)
    first = lambda r: (r[1] is not None, r[1] or "", r[2])  # noqa: E731  NULL keys first
    want = {r[2]: n for n, r in enumerate(sorted(rows, key=first))}
    assert {r["i"]: r["row_idx"] for r in od.with_row_index(df, ["k", "i"]).collect()} == want
    grouped = {r["i"]: r["row_idx"] for r in od.with_row_index(df, ["k", "i"], ["g"]).collect()}
    assert len(grouped) == len(rows)
    for g in (None, "x", "y"):
        own = sorted((r for r in rows if r[0] == g), key=first)
        assert [grouped[r[2]] for r in own] == list(range(len(own)))
    total = {r["i"]: r["running"] for r in od.running_sum(df, F.col("i"), ["k", "i"], ["g"]).collect()}
    acc = 0
    for r in sorted((r for r in rows if r[0] is None), key=first):
        acc += r[2]
        assert total[r[2]] == acc
    text = spark.range(400).select(F.md5(F.col("id").cast("string")).alias("h"))
    assert od._ranged(text, [], ["h"], 8).select("__pid").distinct().count() > 4


def test_take_first_and_split_agree_for_all_sizes(spark, monkeypatch):
    rows = [(None if i % 4 == 0 else i % 7, i) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, i int").repartition(3)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    few = [(r["k"], r["i"]) for r in od.take_first(df, 70, ["k", "i"]).collect()]
    all_ = od.take_first(df, 100_001, ["k", "i"]).collect()
    assert few == want[:70] and sorted((r["k"] is not None, r["k"] or 0, r["i"]) for r in all_) == \
        sorted((r[0] is not None, r[0] or 0, r[1]) for r in rows)
    cut = od.head_percent_split(df, 30, ["k", "i"])
    assert {r["i"] for r in cut.where("split = 'validation'").collect()} == {r[1] for r in want[:60]}
    assert cut.count() == 200 and "rangepartitioning" not in cut._jdf.queryExecution().executedPlan().toString()
    assert od.head_percent_split(df, 30, ["k", "i"], has_validation=True).where("split = 'train'").count() == 200
    assert od.head_percent_split(df, 100, ["k", "i"]).where("split = 'validation'").count() == 200


def test_default_objective_and_epoch(spark):
    from quire.operators import runs as rn
    df = spark.createDataFrame([(1, {"eval_loss": 1.0, "eval_bleu": 2.0, "epoch": 3.0, "eval_runtime": 9.0}),
                                (2, {"eval_loss": 1.5, "epoch": 1.0, "eval_samples_per_second": 4.0}), (3, {})],
                               "t int, m map<string,double>")
    got = {r["t"]: r["o"] for r in df.select("t", rn.default_objective(F.col("m")).alias("o")).collect()}
    assert got == {1: 2.0, 2: 1.5, 3: None}
    log = spark.createDataFrame([(1, i, 1.0, i / 7) for i in range(1, 11)], "run int, step int, loss double, epoch double")
    assert [r["epoch"] for r in rn.interval_loss(log, "run", "step", "loss", 5, "epoch").orderBy("interval").collect()] == [0.71, 1.43]


def test_inference_surface(spark, tmp_path):
    import pandas as pd

    from quire.operators import infer as inf
    log = str(tmp_path / "loads")

    def model():
        import os
        with open(log, "a") as f:
            f.write(f"{os.getpid()}\n")
        return lambda texts: texts.str.len()
    df = spark.range(200).select("id", F.concat(F.lit("x"), F.col("id")).alias("t")).repartition(32)
    assert inf.score_texts(df, ["id"], "t", model).where("score = length(concat('x', id))").count() == 200
    with open(log) as f:
        pids = f.read().split()
    assert len(pids) == len(set(pids))  # one load per worker process, not per task
    df = spark.createDataFrame([(1, "a b c d e"), (2, None), (3, "STOP")], "k int, p string")
    got = {r["k"]: (r["Input"], r["Output"]) for r in inf.generate(
        df, "k", "p", lambda: lambda s: s.map(lambda t: None if t == "STOP" else t + " !END tail"), stop="END",
        context=13, max_new=2).collect()}
    assert got == {1: ("a b c d e", "c d e !"), 2: (None, "!"), 3: ("STOP", None)}
    double = lambda pdf: pd.DataFrame({"n": pdf["k"] * 2})
    assert inf.transform_batches(df, double, "n long").columns == ["n"]
    both = inf.transform_batches(df, double, "n long", remove_columns=False)
    assert both.columns == ["k", "p", "n"] and both.where("n = 2 * k").count() == 3


def test_segmenter_plug_in(spark):
    from quire.functions import text as tx
    df = spark.createDataFrame([("ab cd",), ("",)], "t string")
    by_char = df.select(tx.segment(F.col("t"), lambda c: F.split(c, "")).alias("s")).collect()
    assert [r["s"] for r in by_char] == ["a b   c d", ""] and df.select(tx.segment("t").alias("s")).first()["s"] == "ab cd"


def test_pretokens_lines_and_scripts(spark):
    from quire.operators import vocab as vc
    df = spark.createDataFrame([(1, "中文abc дом1a\n\nx  y", "z")], "k int, text string, line string")
    got = vc.text_lines(df, keep=["k"]).select(vc.pretokens(F.col("line")).alias("w")).collect()
    assert [r["w"] for r in got] == [["▁中文", "abc", "▁дом", "1", "a"], ["▁x", "▁", "▁y"]]
    assert vc.bpe_words(df, "text").count() == 8 and vc.bpe_words(df, "text", max_bytes=5).count() == 3
    skipped = vc.skipped_lines(df, 5).first()
    assert (skipped["lines"], skipped["bytes"]) == (1, len("中文abc дом1a".encode()))


def test_corpus_tokenizer_round_trip(spark):
    from quire.operators import vocab as vc
    texts = ["the low lower lowest newer newest wide", "low 中文 wider", "the newest\nthe widest 12"] * 5
    train = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    vocab, merges = vc.train_vocab(train, 320, merges_per_round=1)
    rows = vocab.orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(len(rows))) and 280 < len(rows) <= 320
    ranks = {(r["left"], r["right"]): r["rank"] for r in merges.collect()}
    other = spark.createDataFrame([(1, "lowest newest é🙂 unseen\n\nthe 中"), (2, "the"), (3, "")], "id int, text string")
    got = vc.bpe_encode_texts(other, ["id"], merges, vocab) \
        .withColumn("back", vc.decode_byte_pieces(F.col("pieces"))).orderBy("id", "line_no").collect()
    assert [(r["id"], r["line_no"], r["back"]) for r in got] == [
        (1, 0, "lowest newest é🙂 unseen"), (1, 2, "the 中"), (2, 0, "the")]
    ids = {r["piece"]: r["id"] for r in rows}
    for r in got:
        assert [ids[p] for p in r["pieces"]] == r["ids"]
    words = train.select(F.explode(vc.pretokens(F.col("text"))).alias("word")).distinct()
    whole = {r["word"]: r["pieces"] for r in vc.bpe_encode_words(words, merges).collect()}
    blocks = {r["word"]: r["pieces"] for r in vc.bpe_encode_words(words, merges, block=3).collect()}
    assert whole == blocks == {w: vc._ranked(list(w), ranks) for w in whole}


def test_arrow_metric_and_preprocess(spark):
    from pyspark.sql import types as T

    from quire.operators import infer as inf
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", 3.0, None), ("a", 8.0, "y"), ("b", 2.0, "z")], "g string, v double, i string")

    @F.pandas_udf(T.DoubleType())
    def median(v: __import__("pandas").Series) -> float:
        return float(v.median())
    got = inf.metric_columns(df, {"m": median("v")}, ["g"], preprocess=lambda d: d.withColumn("v", F.col("v") * 2)).collect()
    assert {r["g"]: r["m"] for r in got} == {"a": 6.0, "b": 4.0}
    counted = inf.metric_columns(df, {"n": F.count(F.lit(1))}, ["g"], include_inputs=("i",)).collect()
    assert {r["g"]: (r["n"], r["n_i"]) for r in counted} == {"a": (3, 2), "b": (1, 1)}
