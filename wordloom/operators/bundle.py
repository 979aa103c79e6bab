"""Versioned bundles of trained models with all that serving and evaluation need.

A bundle holds the models, the ensemble's members, the F1 of each, the code tables and the scaler. It is written beside the
versions and then renamed, so a reader finds whole versions only, and writers that meet get numbers of their own.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from wordloom import storage
from wordloom.operators import ensemble, models

MANIFEST = "manifest.json"


@dataclass
class Bundle:
    models: dict[str, object]
    encoders: DataFrame
    scaler: DataFrame
    #: F1 on validation rows; a model without one counts 1.
    f1: dict[str, float] = field(default_factory=dict)
    #: Names of the models that vote.
    members: tuple[str, ...] = ()
    version: int | None = None

    def weights(self, spark: SparkSession) -> DataFrame:
        """(model, weight) of the ensemble's members."""
        scores = [(m, float(self.f1.get(m, 1.0))) for m in self.members]
        return ensemble.vote_weights(spark.createDataFrame(scores, "model STRING, f1 DOUBLE"))

    def typer(self, name: str) -> models.ErrorTyper:
        """What typing corrections with one of the models needs."""
        return models.ErrorTyper(self.models[name], self.encoders, self.scaler)

    def votes(self, rows: DataFrame) -> DataFrame:
        """The ensemble's weighted soft vote on rows (id, features, ...)."""
        from functools import reduce

        said = [models.probability_rows(models.predictions(self.models[m], rows, m)) for m in self.members]
        return ensemble.soft_vote(reduce(DataFrame.unionByName, said), self.weights(rows.sparkSession))


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions, ascending."""
    names = [n for n in storage.children(spark, root) if n.startswith("version=")]
    return sorted(int(n.partition("=")[2]) for n in names)


def publish(spark: SparkSession, root: str, bundle: Bundle) -> int:
    """Write a bundle and publish it as the next version; returns its number."""
    missing = sorted(set(bundle.members) - set(bundle.models))
    if missing:
        raise ValueError(f"the ensemble names models that the bundle lacks: {missing}")
    draft = f"{root}/draft-{uuid.uuid4().hex}"
    for name, model in bundle.models.items():
        models.save_model(model, f"{draft}/models/{name}")
    bundle.encoders.write.parquet(f"{draft}/encoders")
    bundle.scaler.write.parquet(f"{draft}/scaler")
    told = {"models": sorted(bundle.models), "members": list(bundle.members), "f1": bundle.f1}
    storage.write_line(spark, f"{draft}/{MANIFEST}", json.dumps(told))
    while True:
        number = (versions(spark, root) or [0])[-1] + 1
        if storage.move(spark, draft, f"{root}/version={number}"):
            return number


def load(spark: SparkSession, root: str, version: int | None = None) -> Bundle:
    """A published bundle, the newest by default.

    A model whose folder is gone is left out, unless it is a member of the ensemble: then this raises.
    """
    known = versions(spark, root)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"no version {version or ''} of a bundle under {root}")
    number = version or known[-1]
    at = f"{root}/version={number}"
    told = json.loads(storage.read_line(spark, f"{at}/{MANIFEST}"))
    found = models.load_models(f"{at}/models", told["models"])
    missing = sorted(set(told["members"]) - set(found))
    if missing:
        raise FileNotFoundError(f"models of the ensemble are missing in {at}: {missing}")
    encoders, scaler = (spark.read.parquet(f"{at}/{name}") for name in ("encoders", "scaler"))
    return Bundle(found, encoders, scaler, told["f1"], tuple(told["members"]), number)
