"""The pattern grammar, its learning, and held-out accuracy."""

import pytest
from pyspark.sql import functions as F

from quire.llm import toxicity as tx


def weight(g, text):
    return sum(c[3] for c in g.clauses(text))


def test_clauses_are_scored_in_context():
    g = tx.Grammar()
    plain = weight(g, "what an idiot")
    assert weight(g, "you are an idiot") > plain > weight(g, "he said idiot") > 0
    assert weight(g, "not an idiot") < plain
    assert weight(g, "not the one who is here but an idiot") == plain     # out of the negation's reach
    assert weight(g, "never. an idiot") == plain                            # another clause
    assert weight(g, "I will kill the lights") == 0                         # a threat needs a target
    assert weight(g, "I will kill you") > 0
    assert weight(g, "you are kind; kill the lights") == 0
    start, end, pattern, _ = g.clauses("Fine. You are an idiot!")[0]
    assert (start, end, pattern) == (6, 22, "TI")


def test_machine_is_complete():
    table = tx.machine()
    states = {s for s, _ in table}
    assert len(states) == 4 * 2 * 2 * 3 * 2 and all(after in states for after, _, _ in table.values())


def test_learns_stems_and_treats_odd_rows(spark):
    docs, labels = [], []

    def name(k):
        return "".join("abcdefghij"[int(d)] for d in str(k))
    for i in range(400):
        bad = i % 4 == 0
        docs.append((i, f"alpha{name(i % 37)} zorg{'abcdefgh'[i % 8] if bad else ''}{'x' if bad else ''} beta{name(i % 11)} gamma"
                     if bad else f"alpha{name(i % 37)} beta{name(i % 11)} gamma delta", "row", 0.5))
        labels.append((i, 1, int(bad)))
    docs += [(1000, None, "r", None), (1001, "", "r", 1.0), (1002, "word " * 50_000 + "zorgfx", "r", 1.0),
             (None, "you idiot", "r", 0.0), (3, docs[3][1], "r", 0.0)]
    labels += [(None, None, 1), (1000, 1, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, row string, score double")
    g = tx.learn(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert g.weight("zorgunseen") > 0 and g.weight("gamma") == 0
    got = tx.annotate(df, g).select("row.doc_id", "toxicity.score").collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[1002] > 0.5 and by[1000] == by[1001] < 0.5 and all((by[i] >= 0.5) == (i % 4 == 0) for i in range(400))
    kept = tx.clean(df, g)
    assert kept.columns == ["doc_id", "text", "row", "score"] and kept.where("doc_id = 3").count() == 2


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    g = tx.learn(empty, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert tx.clean(empty, g).collect() == []
    assert g.score(g.clauses("you pathetic idiot")) > 0.5 > g.score([])


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.1"])
def test_held_out_accuracy(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    g = tx.learn(docs, labels)
    kept = tx.annotate(docs.join(labels, "doc_id").where(tx.held_out(F.col("doc_id"))), g) \
        .groupBy("row.toxic", (F.col("toxicity.score") >= 0.5).alias("hit")).count().collect()
    n = {(r.toxic, r.hit): r["count"] for r in kept}
    assert n.get((1, True), 0) >= 0.85 * (n.get((1, True), 0) + n.get((1, False), 0))
    assert n.get((0, True), 0) <= 0.02 * (n.get((0, True), 0) + n.get((0, False), 0))
