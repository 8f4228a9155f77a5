"""Stand-ins: the reference's inputs derived by Spark from the test tables.

* instruction pairs (+ history) <- ``conversations``: a user turn and the
  next non-system turn when it is the assistant's; history = all earlier
  answered pairs of the conversation (W1).
* preference pairs <- ``documents`` join ``labels``: the k-th quality-1 and
  the k-th quality-0 document (by doc_id) of the same language.
* run logs / trials / chat commands <- ``events``.
* logits <- ``embeddings.embedding``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.operators.order import with_row_index


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instruction_pairs(conv: DataFrame) -> DataFrame:
    """(conv_id, turn, query, answer, pair_idx, history array<struct<q,a>>).

    One shuffle by conv_id; both windows share it. A conversation is the
    unit of a chat context, so its turns are one window partition."""
    turns = conv.where(F.col("role") != "system").select("conv_id", "turn", "role", "text")
    w = Window.partitionBy("conv_id").orderBy("turn")
    nxt = turns.select("conv_id", "turn", "role", F.col("text").alias("query"),
                       F.lead("role").over(w).alias("next_role"),
                       F.lead("text").over(w).alias("answer"))
    pairs = nxt.where((F.col("role") == "user") & (F.col("next_role") == "assistant")) \
        .select("conv_id", "turn", "query", "answer")
    hist = F.collect_list(F.struct(F.col("query").alias("q"), F.col("answer").alias("a"))).over(
        w.rowsBetween(Window.unboundedPreceding, -1))
    return pairs.select("conv_id", "turn", "query", "answer",
                        (F.row_number().over(w) - 1).alias("pair_idx"), hist.alias("history"))


def preference_pairs(docs: DataFrame, labels: DataFrame, question_words: int = 8) -> DataFrame:
    """(pair_id, lang, question, response_chosen, response_rejected,
    chosen_id, rejected_id, score_chosen, score_rejected).

    The rank inside (lang, quality) is the dense index (Q2), not a window
    over a whole language; the pairing is an equi-join on (lang, rank).
    Question = first words of the chosen text; the score is a fixed
    arithmetic function of n_chars standing in for a reward model."""
    narrow = docs.select("doc_id", "lang").join(labels.select("doc_id", "quality"), "doc_id")
    ranked = with_row_index(narrow, ["doc_id"], ["lang", "quality"], name="rk")  # ids only: no text is sorted
    good = ranked.where(F.col("quality") == 1).select("lang", "rk", F.col("doc_id").alias("chosen_id"))
    bad = ranked.where(F.col("quality") == 0).select("lang", "rk", F.col("doc_id").alias("rejected_id"))
    score = (F.col("n_chars") % 97) / F.lit(10.0) - F.lit(4.0)

    def side(name):
        return docs.select(F.col("doc_id").alias(f"{name}_id"), F.col("text").alias(f"response_{name}"),
                           score.alias(f"score_{name}"))
    pairs = good.join(bad, ["lang", "rk"]).join(side("chosen"), "chosen_id").join(side("rejected"), "rejected_id")
    question = F.array_join(F.slice(F.split(F.col("response_chosen"), " "), 1, question_words), " ")
    return pairs.select(F.col("chosen_id").alias("pair_id"), "lang", question.alias("question"),
                        "response_chosen", "response_rejected", "chosen_id", "rejected_id",
                        "score_chosen", "score_rejected")
