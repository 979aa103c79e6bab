"""Weighted soft vote over long-form class probabilities (model, id, class, p)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def vote_weights(scores: DataFrame, f1: str = "f1") -> DataFrame:
    """(model, weight): F1 over the sum of F1; a model without a result counts as 1."""
    filled = scores.select("model", F.coalesce(F.col(f1).cast("double"), F.lit(1.0)).alias("f"))
    total = filled.agg(F.sum("f").alias("t"))
    return filled.select("model", (F.col("f") / total.scalar()).alias("weight"))


def soft_vote(probabilities: DataFrame, weights: DataFrame) -> DataFrame:
    """(id, prediction, confidence): class with the largest weighted probability.

    Weights enter as one map (one entry per model). One shuffle by id serves both
    the sums per class and the choice per id.
    """
    table = weights.agg(F.map_from_entries(F.collect_list(F.struct("model", "weight"))).alias("m"))
    weighed = probabilities.repartition("id").withColumn("_w", table.scalar()[F.col("model")] * F.col("p"))
    votes = weighed.groupBy("id", "class").agg(F.sum("_w").alias("v"))
    # Rounding makes ties exact across summation orders; the lowest class wins them.
    first = F.struct((-F.round("v", 12)).alias("k"), F.col("class"))
    return votes.groupBy("id").agg(
        F.min_by("class", first).alias("prediction"), F.max("v").alias("confidence")
    )


def improvement(metrics: DataFrame, ensemble: str = "ensemble") -> DataFrame:
    """Ensemble F1, best single F1, and the difference."""
    mine = F.max(F.when(F.col("model") == ensemble, F.col("f1")))
    best = F.max(F.when(F.col("model") != ensemble, F.col("f1")))
    return metrics.agg(mine.alias("ensemble_f1"), best.alias("best_single_f1")).withColumn(
        "improvement", F.col("ensemble_f1") - F.col("best_single_f1")
    )
