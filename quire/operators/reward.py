"""Pairwise reward metrics and losses.

All metrics are one aggregate pass over a table of (chosen, rejected)
scores: partial aggregates per partition, one tiny final merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Margin of the ranking loss and the loss mixing factor.
MARGIN = 1.0
ALPHA = 0.3


def pair_scores(long_scores: DataFrame, pair_col: str = "pair_id", side_col: str = "side",
                score_col: str = "score") -> DataFrame:
    """Long (pair, side, score) -> one row per pair with chosen and
    rejected scores (conditional aggregation; a single shuffle by pair)."""
    return long_scores.groupBy(pair_col).agg(
        F.max(F.when(F.col(side_col) == "chosen", F.col(score_col))).alias("chosen"),
        F.max(F.when(F.col(side_col) == "rejected", F.col(score_col))).alias("rejected"))


def reward_metrics(df: DataFrame, chosen: str = "chosen", rejected: str = "rejected",
                   margin: float = MARGIN, alpha: float = ALPHA) -> DataFrame:
    """A3-A7 in one pass: mse, mae (labels = rejected, preds = chosen),
    margin ranking loss mean(max(0, -(c - r) + margin)), contrastive term
    mean((c - r)^2) (scalar form of D3), loss = a*rank + (1-a)*contrastive,
    perplexity = exp(loss) (D14: exp of a ranking loss; +inf on overflow)."""
    d = F.col(chosen) - F.col(rejected)
    agg = df.agg(F.avg(d * d).alias("mse"), F.avg(F.abs(d)).alias("mae"),
                 F.avg(F.greatest(F.lit(0.0), -d + F.lit(margin))).alias("margin_loss"),
                 F.avg(d * d).alias("contrastive"), F.count(F.lit(1)).alias("n_pairs"))
    loss = F.lit(alpha) * F.col("margin_loss") + F.lit(1.0 - alpha) * F.col("contrastive")
    return agg.select("mse", "mae", "margin_loss", "contrastive", loss.alias("loss"),
                      F.exp(loss).alias("perplexity"), "n_pairs")


def vector_contrastive(c: Column, r: Column) -> Column:
    """A5 vector form: squared L2 distance of two score vectors."""
    return F.aggregate(F.zip_with(c, r, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x)


def preference_from_predictions(preds: DataFrame, key: str = "row_id", question: str = "question",
                                gold: str = "label", model: str = "predict",
                                prompts: DataFrame | None = None) -> DataFrame:
    """(question, chosen = gold answer, rejected = model answer). With
    ``prompts`` (key, question, gold) the predictions (key, model) are joined
    on the row id; without, the table already holds all columns."""
    rows = preds if prompts is None else prompts.select(key, question, gold).join(preds.select(key, model), key)
    return rows.select(key, F.col(question).alias("question"), F.col(gold).alias("response_chosen"),
                       F.col(model).alias("response_rejected"))
