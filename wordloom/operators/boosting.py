"""Softmax boosting: in each round one tree per class, all grown on the gradients of the same class probabilities.

Rows are binned once and written as blocks of whole columns. A level of a round is one job: every block adds up the gradients of its
rows per (class, node, feature, bin), Spark brings the histograms of a node together, and each node's best split is found
where they meet. Only splits, one row per node, come to the driver, which holds the trees.

Split gain and leaf values have L1 and L2 terms, a minimum gain and a minimum weight of a child. With validation rows, boosting stops
after ``patience`` rounds without gain, and the best prefix of rounds is kept.
"""

from __future__ import annotations

import json
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom import constants as K, storage
from wordloom.staging import stage

BLOCK_ROWS = 4_096
# Margins that a worker remembers, in blocks. They are made again from the trees where they are missing.
KEPT_MARGINS = 32
_margins: OrderedDict[tuple[str, int], tuple[int, np.ndarray]] = OrderedDict()


@dataclass(frozen=True)
class Settings:
    """``rows`` and ``columns`` are the shares that a tree sees; ``leaves`` 0 is no bound beyond the depth."""

    rounds: int = 100
    depth: int = 6
    rate: float = 0.3
    rows: float = 1.0
    columns: float = 1.0
    child_weight: float = 1.0
    gamma: float = 0.0
    l1: float = 0.0
    l2: float = 1.0
    leaves: int = 0
    bins: int = 64
    patience: int = 100
    seed: int = K.SEED


@dataclass
class Tree:
    """Node i has the children 2i + 1 and 2i + 2; a leaf has feature -1. Values up to the cut (a bin edge) go left."""

    feature: np.ndarray
    cut: np.ndarray  # number of the bin edge
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n), np.zeros(n))

    def nodes(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node that each row has reached after at most ``depth`` steps."""
        at = np.zeros(len(bins), np.int64)
        for _ in range(depth):
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                break
            right = bins[np.arange(len(bins)), np.maximum(feature, 0)] > self.cut[at]
            at = np.where(inner, 2 * at + 1 + right, at)
        return at


def best_round(losses: list[float], patience: int) -> tuple[int, bool]:
    """(number of rounds with the smallest loss, whether ``patience`` rounds have passed since); losses[i] is that after i rounds."""
    best = min(range(len(losses)), key=lambda i: (losses[i], i))
    return best, len(losses) - 1 - best >= patience


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _soft(total, l1: float):
    return np.sign(total) * np.maximum(np.abs(total) - l1, 0)


def leaf_value(g, h, s: Settings):
    return -_soft(g, s.l1) / (h + s.l2)


def best_split(histogram: np.ndarray, allowed: np.ndarray, s: Settings) -> tuple[int, int, float, float, float, float, float]:
    """(feature or -1, cut, gain, left value, right value, own value, weight) from sums (feature, bin, [g, h])."""
    left = histogram.cumsum(axis=1)[:, :-1]
    whole = histogram[0].sum(axis=0)
    right = whole - left

    def score(x):
        return _soft(x[..., 0], s.l1) ** 2 / (x[..., 1] + s.l2 + 1e-12)

    gain = (score(left) + score(right) - score(whole)) / 2 - s.gamma
    fits = (left[..., 1] >= s.child_weight) & (right[..., 1] >= s.child_weight) & allowed[:, None]
    gain = np.where(fits, gain, -np.inf)
    own = float(leaf_value(whole[0], whole[1], s))
    feature, cut = np.unravel_index(int(gain.argmax()), gain.shape) if gain.size else (0, 0)
    if not gain.size or not gain[feature, cut] > 1e-9:
        return -1, 0, 0.0, 0.0, 0.0, own, float(whole[1])
    sides = [float(leaf_value(x[feature, cut, 0], x[feature, cut, 1], s)) for x in (left, right)]
    return int(feature), int(cut), float(gain[feature, cut]), *sides, own, float(whole[1])


def bin_edges(rows: DataFrame, bins: int) -> list[np.ndarray]:
    """Cuts between bins for every feature: distinct quantiles."""
    values = rows.select(F.posexplode(vector_to_array("features")).alias("feature", "v"))
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    cuts = values.groupBy("feature").agg(F.percentile_approx("v", shares, 10_000).alias("cuts"))
    found = {r.feature: np.unique(np.array(r.cuts)) for r in cuts.collect()}
    return [found[f] for f in range(len(found))]


def binned(features: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin numbers; a value equal to an edge lies in the bin that ends there."""
    return np.stack([np.searchsorted(e, features[:, f], side="left") for f, e in enumerate(edges)], axis=1).astype(np.uint8)


def _blocks(rows: DataFrame, edges: list[np.ndarray], validation: str | None) -> DataFrame:
    """Staged blocks of binned rows: (block, bins, labels, held_out)."""
    held = F.col(validation) if validation else F.lit(False)
    slim = rows.select(vector_to_array("features").alias("f"), F.col("label").cast("int").alias("y"), held.alias("held"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(at, BLOCK_ROWS)
                values = piece.column("f").flatten().to_numpy(zero_copy_only=False).reshape(piece.num_rows, -1)
                parts = [
                    binned(values, edges), piece.column("y").to_numpy(zero_copy_only=False).astype(np.int8),
                    piece.column("held").to_numpy(zero_copy_only=False).astype(np.int8),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 32 | count], pa.int64()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]],
                    names=["block", "bins", "labels", "held_out"],
                )
                count += 1

    return stage(slim.mapInArrow(pack, "block BIGINT, bins BINARY, labels BINARY, held_out BINARY"), "boost-blocks")


def _block_margins(fit: str, block: int, bins: np.ndarray, trees: list[list[Tree]], start: np.ndarray, s: Settings) -> np.ndarray:
    """Margins of a block's rows under all finished rounds."""
    done, margins = _margins.get((fit, block), (0, None))
    if margins is None:
        margins = np.repeat(start[None, :], len(bins), axis=0)
    if done < len(trees):
        margins = margins.copy()
        for grown in trees[done:]:
            for k, tree in enumerate(grown):
                margins[:, k] += s.rate * tree.value[tree.nodes(bins, s.depth)]
    _margins[fit, block] = len(trees), margins
    _margins.move_to_end((fit, block))
    while len(_margins) > KEPT_MARGINS:
        _margins.popitem(last=False)
    return margins


def _draw(s: Settings, round_no: int, k: int, block: int | None = None) -> np.random.Generator:
    return np.random.default_rng([s.seed, round_no, k] + ([block & 0xFFFFFFFF, block >> 32] if block is not None else []))


class SoftmaxBoost(Estimator):
    """Boosted trees over all classes at once; ``validation`` names a flag of the rows that decide when to stop."""

    def __init__(self, classes: int, validation: str | None = None, **settings):
        super().__init__()
        self.classes, self.validation, self.settings = classes, validation, Settings(**settings)

    def copy(self, extra=None):
        return SoftmaxBoost(self.classes, self.validation, **vars(self.settings))

    def _fit(self, df: DataFrame) -> SoftmaxBoostModel:
        s, fit = self.settings, uuid.uuid4().hex
        train = df.where(~F.col(self.validation)) if self.validation else df
        edges = bin_edges(train, s.bins)
        counts = {int(r.label): r["count"] for r in train.groupBy("label").count().collect()}
        total = sum(counts.values())
        # A class without rows starts, and stays, at no probability.
        start = np.array([np.log(counts[k] / total) if counts.get(k) else -np.inf for k in range(self.classes)])
        blocks = _blocks(df, edges, self.validation)
        trees: list[list[Tree]] = []
        curve: list[tuple[float, float]] = []
        while True:
            grown, scores = self._round(blocks, fit, trees, start, len(edges))
            curve.append(scores)
            best, stop = best_round([x[0] for x in curve], s.patience) if self.validation else (len(curve) - 1, False)
            if stop or len(trees) == s.rounds or not any(t.feature[0] >= 0 for t in grown):
                break
            trees.append(grown)
        return SoftmaxBoostModel(s, start, edges, trees[:best], curve)

    def _round(self, blocks: DataFrame, fit: str, trees: list[list[Tree]], start: np.ndarray, features: int):
        """(trees of one more round, (loss, accuracy) of the validation rows, or else of all, before it)."""
        s, classes, round_no, n_bins = self.settings, self.classes, len(trees), self.settings.bins
        sent = blocks.sparkSession.sparkContext.broadcast(trees)
        present = [k for k in range(classes) if np.isfinite(start[k])]
        grown = [Tree.empty(s.depth) for _ in range(classes)]
        allowed = []
        for k in range(classes):
            draws = _draw(s, round_no, k).random(features)
            allowed.append(draws <= np.sort(draws)[max(1, round(s.columns * features)) - 1])
        scores = (0.0, 0.0)
        room = [(s.leaves or 2**s.depth) - 1 for _ in range(classes)]
        width = features * n_bins

        def histograms(level: int, now: list[Tree]):
            first = 2**level - 1

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for row in batch.to_pylist():
                        labels = np.frombuffer(row["labels"], np.int8).astype(np.int64)
                        held = np.frombuffer(row["held_out"], np.int8).astype(bool)
                        bins = np.frombuffer(row["bins"], np.uint8).reshape(len(labels), features).astype(np.int64)
                        p = softmax(_block_margins(fit, row["block"], bins, sent.value, start, s))
                        out: list[tuple[int, int, bytes]] = []
                        if level == 0:
                            seen = held if held.any() else ~held
                            own = np.maximum(p[np.arange(len(labels)), labels][seen], 1e-15)
                            # Blocks without validation rows count only where there are none at all.
                            hits = (p[seen].argmax(axis=1) == labels[seen]).sum()
                            out.append((-1, int(held.any()), np.array([seen.sum(), -np.log(own).sum(), hits]).tobytes()))
                        for k in present:
                            at = now[k].nodes(bins, level) - first
                            used = ~held & (at >= 0)
                            if s.rows < 1:
                                used &= _draw(s, round_no, k, row["block"]).random(len(labels)) < s.rows
                            if not used.any():
                                continue
                            g = p[used, k] - (labels[used] == k)
                            h = np.maximum(2 * p[used, k] * (1 - p[used, k]), 1e-16)
                            cell = (at[used, None] * width + np.arange(features) * n_bins + bins[used]).ravel()
                            size = 2**level * width
                            sums = np.stack([np.bincount(cell, np.repeat(x, features), size) for x in (g, h)], axis=-1).reshape(2**level, -1)
                            out += [(k, node, sums[node].tobytes()) for node in np.unique(at[used]).tolist()]
                        columns = [pa.array([o[i] for o in out], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.binary()))]
                        yield pa.RecordBatch.from_arrays(columns, names=["cls", "node", "sums"])

            return run

        def reduce(key: tuple, table: pa.Table) -> pa.Table:
            k, node = key[0].as_py(), key[1].as_py()
            total = np.sum([np.frombuffer(b, np.float64) for b in table["sums"].to_pylist()], axis=0)
            found = total.tolist() if k < 0 else list(best_split(total.reshape(features, n_bins, 2), allowed[k], s))
            return pa.table({"cls": pa.array([k], pa.int32()), "node": pa.array([node], pa.int32()), "found": pa.array([[float(x) for x in found]], pa.list_(pa.float64()))})

        for level in range(s.depth + 1):
            if level == s.depth:
                break
            found = (
                blocks.mapInArrow(histograms(level, grown), "cls INT, node INT, sums BINARY")
                .groupBy("cls", "node").applyInArrow(reduce, "cls INT, node INT, found ARRAY<DOUBLE>").collect()
            )
            tested = sorted((r for r in found if r.cls < 0), key=lambda r: -r.node)[:1]
            for n, loss, hits in (r.found for r in tested):
                scores = (loss / max(n, 1), hits / max(n, 1))
            splits = sorted((r for r in found if r.cls >= 0), key=lambda r: (r.cls, -r.found[2], r.node))
            for r in splits:
                tree, at = grown[r.cls], 2**level - 1 + r.node
                feature, cut, gain, low, high, own, _ = r.found
                if level == 0:
                    tree.value[0] = own
                if feature < 0 or room[r.cls] <= 0:
                    continue
                room[r.cls] -= 1
                tree.feature[at], tree.cut[at], tree.gain[at] = int(feature), int(cut), gain
                tree.value[2 * at + 1], tree.value[2 * at + 2] = low, high
            if not any(t.feature[2**level - 1 : 2 ** (level + 1) - 1].max() >= 0 for t in grown):
                break
        sent.unpersist()
        return grown, scores


@dataclass
class _Parts:
    settings: Settings
    start: np.ndarray
    edges: list[np.ndarray]
    trees: list[list[Tree]]
    curve: list[tuple[float, float]] = field(default_factory=list)


class SoftmaxBoostModel(Model):
    """``curve`` has (loss, accuracy) after each number of rounds, from none on; ``trees`` are the rounds that were kept."""

    def __init__(self, settings: Settings, start: np.ndarray, edges: list[np.ndarray], trees: list[list[Tree]], curve: list[tuple[float, float]]):
        super().__init__()
        self.parts = _Parts(settings, start, edges, trees, curve)

    def copy(self, extra=None):
        return SoftmaxBoostModel(**vars(self.parts))

    @property
    def rounds(self) -> int:
        return len(self.parts.trees)

    def curve(self, spark: SparkSession) -> DataFrame:
        """(round, loss, accuracy, kept): the validation curve; ``kept`` marks the last round that was kept."""
        rows = [(i, float(x), float(a), i == self.rounds) for i, (x, a) in enumerate(self.parts.curve)]
        return spark.createDataFrame(rows, "round INT, loss DOUBLE, accuracy DOUBLE, kept BOOLEAN")

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        p = self.parts
        bins = binned(features, p.edges).astype(np.int64)
        margins = np.repeat(p.start[None, :], len(bins), axis=0)
        for grown in p.trees:
            for k, tree in enumerate(grown):
                margins[:, k] += p.settings.rate * tree.value[tree.nodes(bins, p.settings.depth)]
        return softmax(margins)

    def _transform(self, df: DataFrame) -> DataFrame:
        sent = df.sparkSession.sparkContext.broadcast(self.parts)

        @F.pandas_udf("array<double>")
        def score(features: pd.Series) -> pd.Series:
            if not len(features):
                return pd.Series([], dtype=object)
            return pd.Series(list(SoftmaxBoostModel(**vars(sent.value)).probabilities(np.stack(features.to_list()))))

        scored = df.withColumn("_p", score(vector_to_array("features")))
        best = (F.array_position("_p", F.array_max("_p")) - 1).cast("double")
        return scored.withColumn("probability", array_to_vector("_p")).withColumn("prediction", best).drop("_p")

    @property
    def importances(self) -> list[float]:
        """Share of each feature in the gain of all splits."""
        gains = np.zeros(len(self.parts.edges))
        for grown in self.parts.trees:
            for tree in grown:
                inner = tree.feature >= 0
                np.add.at(gains, tree.feature[inner], tree.gain[inner])
        return list(gains / gains.sum() if gains.sum() else gains)

    def save(self, path: str) -> None:
        """One small JSON document; its size is bounded by rounds, classes and depth."""
        p = self.parts
        trees = [[{c: x.tolist() for c, x in vars(t).items()} for t in grown] for grown in p.trees]
        start = [x if np.isfinite(x) else None for x in p.start.tolist()]
        told = {"settings": vars(p.settings), "start": start, "edges": [e.tolist() for e in p.edges], "trees": trees, "curve": p.curve}
        storage.write_line(SparkSession.active(), f"{path}/softmax.json", json.dumps(told))

    @staticmethod
    def load(path: str) -> SoftmaxBoostModel:
        told = json.loads(storage.read_line(SparkSession.active(), f"{path}/softmax.json"))
        kinds = {"feature": np.int32, "cut": np.int32, "value": np.float64, "gain": np.float64}
        trees = [[Tree(**{c: np.array(x, kinds[c]) for c, x in t.items()}) for t in grown] for grown in told["trees"]]
        start = np.array([-np.inf if x is None else x for x in told["start"]])
        return SoftmaxBoostModel(Settings(**told["settings"]), start, [np.array(e) for e in told["edges"]], trees, [tuple(c) for c in told["curve"]])
