"""Result files of a training run: metrics per model, comparison, feature importances, training times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom.operators import evaluate as ev, models

METRICS_SCHEMA = "model STRING, accuracy DOUBLE, precision DOUBLE, recall DOUBLE, f1 DOUBLE"
COMPARISON_SCHEMA = "place INT, model STRING, val_accuracy DOUBLE, val_f1 DOUBLE, gap DOUBLE, score DOUBLE"
IMPORTANCE_SCHEMA = "model STRING, feature STRING, importance DOUBLE"
SECONDS_SCHEMA = "model STRING, seconds DOUBLE"


def write_results(path: str, preds: DataFrame, trained: dict[str, tuple[object, float]] | None = None) -> None:
    """Write the files of a run: ``preds`` (model, id, split, label, prediction); ``trained`` has model and seconds by name.

    ``metrics`` is JSON, one object per model, over all splits; the others are headered CSV. The comparison is in the order of the
    validation F1, its place written beside it.
    """
    spark = preds.sparkSession
    ev.metrics(preds).coalesce(1).write.json(f"{path}/metrics")
    ranked = ev.compare(preds)
    order = F.row_number().over(ev.by_f1())
    ranked.select(order.alias("place"), *ranked.columns).coalesce(1).write.option("header", True).csv(f"{path}/comparison")
    importances, seconds = spark.createDataFrame([], IMPORTANCE_SCHEMA), []
    for name, (model, took) in (trained or {}).items():
        seconds.append((name, took))
        importances = importances.unionByName(models.importance(model, spark).select(F.lit(name).alias("model"), "feature", "importance"))
    importances.coalesce(1).write.option("header", True).csv(f"{path}/importance")
    spark.createDataFrame(seconds, SECONDS_SCHEMA).coalesce(1).write.option("header", True).csv(f"{path}/seconds")


def read_results(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(metrics, comparison, importance, seconds) of a run."""
    csv = [
        spark.read.schema(schema).option("header", True).csv(f"{path}/{name}")
        for name, schema in (("comparison", COMPARISON_SCHEMA), ("importance", IMPORTANCE_SCHEMA), ("seconds", SECONDS_SCHEMA))
    ]
    return spark.read.schema(METRICS_SCHEMA).json(f"{path}/metrics"), *csv
