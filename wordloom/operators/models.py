"""Error-type classifiers on Spark ML, with the published grids as presets."""

from __future__ import annotations

import json
import random
import time
from functools import reduce

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom import constants as K, storage
from wordloom.operators import evaluate as ev
from wordloom.operators.boosting import SoftmaxBoost, SoftmaxBoostModel
from wordloom.operators.search import Found, halving_search
from wordloom.staging import fresh_path

# --- fixed values: search grids and fixed settings ----
# "wide" and "regularized" are the published ones; "short" has fewer trees or rounds with a higher rate. Depth 35 is
# written as 30, the deepest tree Spark ML grows.
FOREST_GRIDS = {
    "wide": {
        "numTrees": [300, 500, 700], "maxDepth": [25, 30, 30], "minInstancesPerNode": [1, 2, 3],
        "featureSubsetStrategy": ["sqrt", "log2"], "minInfoGain": [0.0, 0.0001, 0.001],
    },
    "regularized": {
        "numTrees": [100, 200, 300], "maxDepth": [10, 15, 20], "minInstancesPerNode": [5, 10, 15],
        "featureSubsetStrategy": ["sqrt", "0.5"], "minInfoGain": [0.001, 0.005, 0.01],
    },
    "short": {
        "numTrees": [45], "maxDepth": [10, 12], "minInstancesPerNode": [5, 10, 15],
        "featureSubsetStrategy": ["sqrt", "0.5"], "minInfoGain": [0.0, 0.0001, 0.001],
    },
    "smoke": {"numTrees": [5, 8], "maxDepth": [4, 6], "featureSubsetStrategy": ["sqrt"]},
}
BOOST_GRIDS = {
    "wide": {
        "rounds": [500, 700, 1000], "depth": [8, 10, 12], "rate": [0.05, 0.07, 0.1], "rows": [0.8, 0.9], "columns": [0.8, 0.9],
        "child_weight": [1, 3, 5], "gamma": [0.0, 0.1, 0.2], "l1": [0.0, 0.01, 0.1], "l2": [1.0, 1.5, 2.0],
    },
    "regularized": {
        "rounds": [300, 500], "depth": [4, 6, 8], "rate": [0.01, 0.03, 0.05], "rows": [0.6, 0.7, 0.8], "columns": [0.6, 0.7, 0.8],
        "child_weight": [5, 10, 15], "gamma": [0.1, 0.3, 0.5], "l1": [0.1, 0.5, 1.0], "l2": [2.0, 3.0, 5.0],
    },
    "short": {
        "rounds": [9], "depth": [4, 5], "rate": [0.5, 0.6, 0.7], "rows": [0.8, 0.9], "columns": [0.8, 0.9],
        "child_weight": [1, 3, 5], "gamma": [0.0, 0.1, 0.2], "l1": [0.0, 0.01, 0.1], "l2": [1.0, 1.5, 2.0],
    },
    "smoke": {"rounds": [2, 3], "depth": [3], "rate": [0.3]},
}
# Trees of 63 leaves are trees of depth 6 here.
BOOST_FIXED = {
    "wide": {"rounds": 1000, "depth": 6, "leaves": 63, "rate": 0.05, "rows": 0.8, "columns": 0.8, "child_weight": 20, "l1": 0.1, "l2": 0.1, "patience": 100},
    "regularized": {"rounds": 500, "depth": 5, "leaves": 31, "rate": 0.03, "rows": 0.7, "columns": 0.7, "child_weight": 30, "l1": 0.3, "l2": 0.3, "patience": 100},
    "short": {"rounds": 20, "depth": 5, "rate": 0.5, "rows": 0.8, "columns": 0.8, "child_weight": 20, "l1": 0.1, "l2": 0.1, "patience": 5},
    "smoke": {"rounds": 4, "depth": 4, "rate": 0.3},
}
SEARCH_SETTINGS = {"forest": 15, "boost": 20}
EARLY_STOP_TOLERANCE = 0.01


def load_xy(df: DataFrame, label: str = "error_type_encoded") -> DataFrame:
    """(id, split, label, features) from prepared rows."""
    present = [f for f in K.FEATURES if f in df.columns]
    assembler = VectorAssembler(inputCols=present, outputCol="features")
    return assembler.transform(df).select(
        "id", "split", F.col(label).cast("double").alias("label"), "features"
    )


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, weight): n / (classes * n of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).alias("t"))
    return (
        counts.withColumn("t", totals.scalar())
        .select(label, (F.col("t.n") / (F.col("t.k") * F.col("n"))).alias("weight"))
    )


def with_weights(df: DataFrame) -> DataFrame:
    """Rows with their class weight; one weight per class, looked up in one map."""
    table = class_weights(df).agg(F.map_from_entries(F.collect_list(F.struct("label", "weight"))).alias("m"))
    return df.withColumn("weight", table.scalar()[F.col("label")])


def sampled_settings(grid: dict[str, list], count: int, seed: int = K.SEED) -> list[dict]:
    """``count`` distinct settings drawn from a grid, or the whole grid if it is smaller."""
    options = [{}]
    for name, values in grid.items():
        options = [o | {name: v} for o in options for v in dict.fromkeys(values)]
    return random.Random(seed).sample(options, min(count, len(options)))


def forest(**params) -> RandomForestClassifier:
    base = dict(labelCol="label", featuresCol="features", seed=K.SEED, weightCol="weight")
    return RandomForestClassifier(**(base | params))


class PerClassBoost(Estimator):
    """One boosted binary model per class, probabilities normalized.

    Spark ML's boosted trees are binary. Classes are a short fixed list; a
    class that a training fold lacks gets probability 0. With
    ``validation`` set, boosting stops once validation rows stop gaining.
    """

    def __init__(self, classes: int, validation: str | None = None, **settings):
        super().__init__()
        self.classes, self.validation, self.settings = classes, validation, settings

    def copy(self, extra=None):
        # Settings are fixed at construction; a search makes one estimator per setting.
        return PerClassBoost(self.classes, self.validation, **self.settings)

    def _fit(self, df: DataFrame) -> "PerClassBoostModel":
        rows = df.withColumn("_y", F.lit(0.0)).persist()
        try:
            present = {int(r.label) for r in rows.select("label").distinct().collect()}
            models: list[GBTClassificationModel | None] = []
            for k in range(self.classes):
                if k not in present:
                    models.append(None)
                    continue
                params = dict(labelCol="_y", featuresCol="features", seed=K.SEED) | self.settings
                if self.validation:
                    params |= {"validationIndicatorCol": self.validation, "validationTol": EARLY_STOP_TOLERANCE}
                binary = rows.withColumn("_y", (F.col("label") == k).cast("double"))
                models.append(GBTClassifier(**params).fit(binary))
        finally:
            rows.unpersist()
        return PerClassBoostModel(models)


class PerClassBoostModel(Model):
    def __init__(self, models: list[GBTClassificationModel | None]):
        super().__init__()
        self.models = models

    def copy(self, extra=None):
        return PerClassBoostModel(self.models)

    def _transform(self, df: DataFrame) -> DataFrame:
        out, parts = df, []
        for k, model in enumerate(self.models):
            if model is None:
                parts.append(F.lit(0.0))
                continue
            named = model.copy()
            named.setRawPredictionCol(f"_r{k}").setProbabilityCol(f"_p{k}").setPredictionCol(f"_c{k}")
            out = named.transform(out)
            parts.append(F.get(vector_to_array(f"_p{k}"), F.lit(1)))
        raw = out.withColumn("_raw", F.array(*parts))
        total = F.aggregate("_raw", F.lit(0.0), lambda s, v: s + v)
        share = F.transform("_raw", lambda v: v / F.col("_t"))
        return (
            raw.withColumn("_t", total).withColumn("_share", share)
            .withColumn("probability", array_to_vector("_share"))
            .withColumn("prediction", (F.array_position("_share", F.array_max("_share")) - 1).cast("double"))
            .select(*df.columns, "probability", "prediction")
        )

    @property
    def importances(self) -> list[float]:
        """Mean importance over the class models."""
        vectors = [m.featureImportances.toArray() for m in self.models if m is not None]
        return list(sum(vectors) / len(vectors))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        present = [k for k, m in enumerate(self.models) if m is not None]
        for k in present:
            self.models[k].write().overwrite().save(f"{path}/class={k}")
        meta = spark.createDataFrame([(json.dumps({"classes": len(self.models), "present": present}),)], "value string")
        meta.coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @staticmethod
    def load(path: str) -> "PerClassBoostModel":
        meta = json.loads(SparkSession.active().read.text(f"{path}/meta").first().value)
        models = [None] * meta["classes"]
        for k in meta["present"]:
            models[k] = GBTClassificationModel.load(f"{path}/class={k}")
        return PerClassBoostModel(models)


def save_model(model, path: str) -> None:
    if isinstance(model, (PerClassBoostModel, SoftmaxBoostModel)):
        model.save(path)
    else:
        PipelineModel(stages=[model]).write().overwrite().save(path)


def load_model(path: str):
    """A saved model of any kind."""
    spark = SparkSession.active()
    if storage.exists(spark, f"{path}/softmax.json"):
        return SoftmaxBoostModel.load(path)
    return PerClassBoostModel.load(path) if storage.exists(spark, f"{path}/meta") else PipelineModel.load(path)


def load_models(root: str, names: list[str]) -> dict:
    """Those of the named models that exist under ``root``."""
    spark = SparkSession.active()
    return {name: load_model(f"{root}/{name}") for name in names if storage.exists(spark, f"{root}/{name}")}


def random_search(
    make, grid: dict[str, list], count: int, train: DataFrame, budget: str, path: str | None = None, seed: int = K.SEED
) -> Found:
    """Search ``count`` settings of a grid on all rows; with ``path`` an earlier search there goes on."""
    settings = sampled_settings(grid, count, seed)
    return halving_search(make, settings, budget, train, path or fresh_path(train.sparkSession, "search"), seed=seed)


def search_forest(train: DataFrame, preset: str = "wide", settings: int | None = None, path: str | None = None) -> Found:
    """Searched random forest on balanced class weights."""
    count = settings or SEARCH_SETTINGS["forest"]
    return random_search(forest, FOREST_GRIDS[preset], count, with_weights(train), "numTrees", path)


def train_forest(train: DataFrame, preset: str = "wide", settings: int | None = None, path: str | None = None):
    return search_forest(train, preset, settings, path).model


def search_boost(train: DataFrame, classes: int, preset: str = "wide", settings: int | None = None, path: str | None = None) -> Found:
    """Searched softmax boosting."""
    count = settings or SEARCH_SETTINGS["boost"]
    make = lambda **s: SoftmaxBoost(classes, **s)
    return random_search(make, BOOST_GRIDS[preset], count, train, "rounds", path)


def train_boost_searched(train: DataFrame, classes: int, preset: str = "wide", settings: int | None = None, path: str | None = None):
    return search_boost(train, classes, preset, settings, path).model


def train_boost_fixed(rows: DataFrame, classes: int, preset: str = "wide") -> SoftmaxBoostModel:
    """Softmax boosting with fixed settings on all rows but those of the test split; those of the validation split decide when to stop
    and which rounds are kept.
    """
    flagged = rows.where(F.col("split") != "test").withColumn("is_val", F.col("split") == "val")
    return SoftmaxBoost(classes, "is_val", **BOOST_FIXED[preset]).fit(flagged)


def predictions(model, rows: DataFrame, name: str) -> DataFrame:
    """(model, id, split, label, prediction, probabilities)."""
    return model.transform(rows).select(
        F.lit(name).alias("model"), "id", "split", F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability").alias("probabilities"),
    )


def probability_rows(preds: DataFrame) -> DataFrame:
    """(model, id, class, p) in long form."""
    return preds.select("model", "id", F.posexplode("probabilities").alias("class", "p"))


def importance(model, spark: SparkSession, features: tuple[str, ...] = K.FEATURES) -> DataFrame:
    """(feature, importance), descending. One value per feature, so it is built from the model."""
    if isinstance(model, PipelineModel):
        model = model.stages[-1]
    own = isinstance(model, (PerClassBoostModel, SoftmaxBoostModel))
    values = model.importances if own else model.featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def train_all(rows: DataFrame, classes: int, preset: str = "wide", settings: int | None = None) -> dict:
    """Train the three models; returns name -> (model, seconds)."""
    train = rows.where(F.col("split") == "train")
    jobs = {
        "random_forest": lambda: train_forest(train, preset, settings),
        "boost_searched": lambda: train_boost_searched(train, classes, preset, settings),
        "boost_fixed": lambda: train_boost_fixed(rows, classes, preset),
    }
    out = {}
    for name, job in jobs.items():
        start = time.perf_counter()
        out[name] = (job(), time.perf_counter() - start)
    return out


def all_predictions(models: dict, rows: DataFrame) -> DataFrame:
    """Predictions of every model plus the weighted soft vote as model ``ensemble``."""
    from wordloom.operators.ensemble import soft_vote, vote_weights
    from wordloom.staging import stage

    single = stage(
        reduce(DataFrame.unionByName, [predictions(m, rows, n) for n, m in models.items()]), "predictions"
    )
    weights = stage(vote_weights(ev.metrics(single.where(F.col("split") == "val"))), "weights")
    votes = soft_vote(probability_rows(single), weights)
    truth = rows.select("id", "split", F.col("label").cast("int").alias("label"))
    ensemble = truth.join(votes, "id").select(
        F.lit("ensemble").alias("model"), "id", "split", "label", "prediction"
    )
    return single.select("model", "id", "split", "label", "prediction").unionByName(ensemble)


class ErrorTyper:
    """What serving needs: a model, the code tables and the scaler it was trained with."""

    def __init__(self, model, encoders: DataFrame, scaler: DataFrame):
        self.model, self.encoders, self.scaler = model, encoders, scaler

    def save(self, path: str) -> None:
        """Everything under one folder; an older bundle there is replaced."""
        save_model(self.model, f"{path}/model")
        self.encoders.write.mode("overwrite").parquet(f"{path}/encoders")
        self.scaler.write.mode("overwrite").parquet(f"{path}/scaler")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ErrorTyper:
        return cls(load_model(f"{path}/model"), spark.read.parquet(f"{path}/encoders"), spark.read.parquet(f"{path}/scaler"))


def train_error_typer(prepared: DataFrame, encoders: DataFrame, scaler: DataFrame, classes: int, preset: str = "wide") -> ErrorTyper:
    """An error typer on the boosted trees of fixed settings; ``bundle.Bundle.typer`` makes one of any saved model."""
    return ErrorTyper(train_boost_fixed(load_xy(prepared), classes, preset), encoders, scaler)


def error_types(pairs: DataFrame, typer: ErrorTyper) -> DataFrame:
    """(correct_word, incorrect_word, error_type, confidence, probabilities) per distinct pair.

    Featurized exactly as in training; letter groups never seen in training get code -1.
    """
    from wordloom.functions.features import with_features
    from wordloom.operators.prepare import encode, scale

    distinct = pairs.select("correct_word", "incorrect_word").distinct()
    featured = with_features(distinct.withColumn("word_length", F.length("correct_word")))
    coded = encode(featured, typer.encoders, K.CATEGORICAL)
    ready = VectorAssembler(inputCols=list(K.FEATURES), outputCol="features").transform(scale(coded, typer.scaler))
    scored = typer.model.transform(ready)
    # One label per class code: a map of at most five entries.
    labels = typer.encoders.where(F.col("column") == "error_type").agg(
        F.map_from_entries(F.collect_list(F.struct("code", "label"))).alias("m")
    )
    p = vector_to_array("probability")
    named = F.transform(p, lambda v, i: F.struct(F.col("_m")[i].alias("key"), v.alias("value")))
    return scored.withColumn("_m", labels.scalar()).select(
        "correct_word", "incorrect_word",
        F.col("_m")[F.col("prediction").cast("int")].alias("error_type"),
        F.array_max(p).alias("confidence"),
        F.map_from_entries(named).alias("probabilities"),
    )
