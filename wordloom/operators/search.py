"""Random search over settings, with a ledger: what has been measured is written down, and a search that was cut off goes on.

All settings start with a share of their budget (trees or rounds). At the end of each rung the better ones go on with a larger
share; the last rung has the whole budget. Every (rung, setting, fold) is one line of the ledger.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom import constants as K, storage

FOLDS = 3
PARALLEL_FITS = 2
# Shares of the budget of the rungs, and the share of settings that a rung passes on.
RUNGS = (1 / 9, 1 / 3, 1.0)
KEPT = 1 / 3
LEDGER_SCHEMA = "rung INT, setting INT, fold INT, f1 DOUBLE, seconds DOUBLE, told STRING"


@dataclass
class Found:
    """The best setting, its mean F1 in the last rung, and the model refitted on all rows."""

    setting: dict
    f1: float
    model: object
    path: str


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(rung, setting, fold, f1, seconds, told): every measurement; ``told`` is the setting as JSON."""
    if not storage.children(spark, f"{path}/ledger"):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).json(f"{path}/ledger/*.json")


def halving_search(
    make: Callable[..., object], settings: Sequence[dict], budget: str, train: DataFrame, path: str,
    rungs: Sequence[float] = RUNGS, folds: int = FOLDS, seed: int = K.SEED,
) -> Found:
    """Search among ``settings``; ``budget`` names the entry that the rungs take a share of.

    ``train`` has ``id``, ``label`` and ``features``; folds come from a hash of the id. Measurements under ``path`` of the same
    setting, rung and fold are taken over.
    """
    spark = train.sparkSession
    folded = train.withColumn("_fold", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(folds)).cast("int"))
    evaluator = MulticlassClassificationEvaluator(metricName="f1")
    known = {(r.rung, r.setting, r.fold, r.told): r.f1 for r in read_ledger(spark, path).collect()}

    def told(setting: dict) -> str:
        return json.dumps(setting, sort_keys=True)

    def measured(rung: int, i: int, fold: int, setting: dict) -> float:
        key = rung, i, fold, told(setting)
        if key not in known:
            start = time.perf_counter()
            model = make(**setting).fit(folded.where(F.col("_fold") != fold).drop("_fold"))
            f1 = evaluator.evaluate(model.transform(folded.where(F.col("_fold") == fold)))
            line = dict(rung=rung, setting=i, fold=fold, f1=f1, seconds=time.perf_counter() - start, told=told(setting))
            storage.write_line(spark, f"{path}/ledger/{rung}-{i}-{fold}.json", json.dumps(line))
            known[key] = f1
        return known[key]

    left = list(range(len(settings)))
    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        for rung, share in enumerate(rungs):
            now = {i: settings[i] | {budget: max(1, math.ceil(settings[i][budget] * share))} for i in left}
            jobs = {(i, fold): pool.submit(measured, rung, i, fold, now[i]) for i in left for fold in range(folds)}
            means = {i: sum(jobs[i, fold].result() for fold in range(folds)) / folds for i in left}
            ranked = sorted(left, key=lambda i: (-means[i], i))
            if rung < len(rungs) - 1:
                left = ranked[: max(1, math.ceil(len(ranked) * KEPT))]
    best = ranked[0]
    return Found(now[best], means[best], make(**now[best]).fit(train), path)
