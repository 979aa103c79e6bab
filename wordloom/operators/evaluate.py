"""Classifier evaluation as aggregates over (label, prediction) counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F

from wordloom.staging import stage


def confusion(preds: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., label, prediction, n). All metrics below derive from this small table."""
    return preds.groupBy(*by, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(preds: DataFrame, classes: list[str]) -> DataFrame:
    """One row per label, one column per class of the fixed class list, and ``other`` for any other prediction."""
    known = F.when(F.col("prediction").isin(classes), F.col("prediction")).otherwise("other")
    columns = [*classes, "other"]
    return (
        preds.select("label", known.alias("_prediction")).groupBy("label").pivot("_prediction", columns)
        .agg(F.count(F.lit(1))).na.fill(0, columns)
    )


def confusion_shares(preds: DataFrame) -> DataFrame:
    """Confusion counts divided by their row sums."""
    cells = confusion(preds)
    rows = cells.groupBy("label").agg(F.sum("n").alias("row_total"))
    return cells.join(rows, "label").select(
        "label", "prediction", (F.col("n") / F.col("row_total")).alias("share")
    )


def accuracy(preds: DataFrame) -> DataFrame:
    return preds.agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"))


def per_class(preds: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., class, precision, recall, f1, support); 0 where undefined."""
    return class_metrics(confusion(preds, by), by)


def class_metrics(cells: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    sides = cells.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).alias("predicted"), F.lit(0).alias("hit")),
                F.struct(
                    F.col("prediction").alias("class"), F.lit(0).alias("support"), F.col("n").alias("predicted"),
                    F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit"),
                ),
            )
        ).alias("s"),
    ).select(*by, "s.*")
    sums = sides.groupBy(*by, "class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit")
    )

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    hit, predicted, support = F.col("hit"), F.col("predicted"), F.col("support")
    return sums.select(
        *by, "class",
        ratio(hit, predicted).alias("precision"),
        ratio(hit, support).alias("recall"),
        ratio(2.0 * hit, predicted + support).alias("f1"),
        "support",
    )


def averages(preds: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., average, precision, recall, f1) for macro and support-weighted averages."""
    return average_metrics(per_class(preds, by), by)


def average_metrics(classes: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    weight = F.sum("support")
    wide = classes.groupBy(*by).agg(
        *[F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")],
        *[(F.sum(F.col(m) * F.col("support")) / weight).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")],
    )
    rows = F.array(*[
        F.struct(F.lit(a).alias("average"), *[F.col(f"{a}_{m}").alias(m) for m in ("precision", "recall", "f1")])
        for a in ("macro", "weighted")
    ])
    return wide.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")


def metrics(preds: DataFrame, by: tuple[str, ...] = ("model",)) -> DataFrame:
    """(by..., accuracy, precision, recall, f1): the weighted headline numbers."""
    return headline(confusion(preds, by), by)


def headline(cells: DataFrame, by: tuple[str, ...] = ("model",)) -> DataFrame:
    hits = cells.groupBy(*by).agg(
        (F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy")
    )
    weighted = average_metrics(class_metrics(cells, by), by).where(F.col("average") == "weighted").drop("average")
    return hits.join(weighted, list(by))


def gap_band(gap):
    return F.when(gap > 0.15, "severe").when(gap > 0.10, "moderate").otherwise("good")


def train_val_gap(preds: DataFrame) -> DataFrame:
    """(model, train_accuracy, val_accuracy, gap, band) from predictions with a split column."""
    hit = (F.col("label") == F.col("prediction")).cast("double")
    acc = preds.groupBy("model").agg(
        F.avg(F.when(F.col("split") == "train", hit)).alias("train_accuracy"),
        F.avg(F.when(F.col("split") == "val", hit)).alias("val_accuracy"),
    )
    gap = F.col("train_accuracy") - F.col("val_accuracy")
    return acc.withColumn("gap", gap).withColumn("band", gap_band(F.col("gap")))


def compare(preds: DataFrame) -> DataFrame:
    """(model, val_accuracy, val_f1, gap, score) by F1, descending; score = F1 - gap / 2."""
    val = metrics(preds.where(F.col("split") == "val")).select(
        "model", F.col("accuracy").alias("val_accuracy"), F.col("f1").alias("val_f1")
    )
    gaps = train_val_gap(preds).select("model", "gap")
    return (
        val.join(gaps, "model", "left")
        .withColumn("score", F.col("val_f1") - F.col("gap") * 0.5)
        .orderBy(F.desc("val_f1"), "model")
    )


def by_f1() -> WindowSpec:
    """The order of a comparison; it has one row per model."""
    return Window.orderBy(F.desc("val_f1"), "model")


def best_model(comparison: DataFrame, by: str = "score") -> DataFrame:
    """The model with the largest ``by``; ties go to the first name."""
    best = F.min_by("model", F.struct((-F.col(by)).alias("k"), "model"))
    return comparison.agg(best.alias("model"), F.max(by).alias("value"))


def final_report(preds: DataFrame) -> DataFrame:
    """(section, key, value): best test model, its headline numbers and per-class block.

    The counts per model, label and prediction are written once; the rest of
    the report reads that small table.
    """
    cells = stage(confusion(preds.where(F.col("split") == "test"), ("model",)), "cells")
    table = stage(headline(cells), "headline")
    best = best_model(table, "f1").select("model")
    chosen = table.where(F.col("model") == best.scalar())
    numbers = chosen.unpivot(["model"], ["accuracy", "precision", "recall", "f1"], "key", "value").select(
        F.lit("headline").alias("section"), "key", "value"
    )
    name = best.select(F.lit("best").alias("section"), F.col("model").alias("key"), F.lit(1.0).alias("value"))
    classes = class_metrics(cells, ("model",)).where(F.col("model") == best.scalar())
    block = (
        classes.withColumn("support", F.col("support").cast("double"))
        .unpivot(["class"], ["precision", "recall", "f1", "support"], "metric", "value")
        .select(F.lit("class").alias("section"), F.concat_ws(".", "class", "metric").alias("key"), "value")
    )
    return reduce(DataFrame.unionByName, [name, numbers, block])
