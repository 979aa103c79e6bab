"""Boosting, search and bundles."""

import json

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from wordloom import storage
from wordloom.operators import boosting, bundle, models, search
from wordloom.plans import inputs
from wordloom.staging import fresh_path, stage


@pytest.fixture(scope="module")
def rows(spark):
    """Three classes of two features with a diagonal border, and one feature of noise; classes beyond the third are absent."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3_000, 3))
    y = np.where(x[:, 0] + x[:, 1] > 0.7, 2, np.where(x[:, 0] * x[:, 1] > 0, 1, 0))
    split = rng.choice(["train", "val", "test"], p=[0.7, 0.2, 0.1], size=len(y))
    data = [(i, str(s), float(c), [float(v) for v in f]) for i, (s, c, f) in enumerate(zip(split, y, x))]
    df = spark.createDataFrame(data, "id BIGINT, split STRING, label DOUBLE, f ARRAY<DOUBLE>")
    return stage(df.repartition(3).select("id", "split", "label", array_to_vector("f").alias("features")), "rows")


def test_patience_and_plateau():
    assert boosting.best_round([5, 4, 3, 3, 3, 3], 3) == (2, True)
    assert boosting.best_round([5, 4, 3, 3, 3], 3) == (2, False)
    assert boosting.best_round([1, 2, 3], 2) == (0, True)
    assert boosting.best_round([3, 3.5, 2, 2.5, 1.9], 2) == (4, False)


def plain_split(x, g, h, edges, s):
    """The best split of one node, tried value by value."""
    best = (1e-9, -1, 0)
    score = lambda G, H: max(abs(G) - s.l1, 0) ** 2 / (H + s.l2 + 1e-12)
    for f, cuts in enumerate(edges):
        for c, edge in enumerate(cuts):
            left = x[:, f] <= edge
            if h[left].sum() < s.child_weight or h[~left].sum() < s.child_weight:
                continue
            gain = (score(g[left].sum(), h[left].sum()) + score(g[~left].sum(), h[~left].sum()) - score(g.sum(), h.sum())) / 2 - s.gamma
            if gain > best[0] + 1e-12:
                best = (gain, f, c)
    return best


def test_splits_equal_a_plain_search():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3))
    g, h = rng.normal(size=400) + x[:, 1], rng.random(400)
    edges = [np.quantile(x[:, f], [i / 16 for i in range(1, 16)]) for f in range(3)]
    for s in (boosting.Settings(bins=16), boosting.Settings(bins=16, l1=3.0, l2=2.0, gamma=0.5, child_weight=60)):
        bins = boosting.binned(x, edges).astype(int)
        sums = np.zeros((3, 16, 2))
        for f in range(3):
            np.add.at(sums[f], bins[:, f], np.stack([g, h], axis=1))
        feature, cut, gain, low, high, own, weight = boosting.best_split(sums, np.ones(3, bool), s)
        want = plain_split(x, g, h, edges, s)
        assert (feature, cut) == want[1:] and abs(gain - want[0]) < 1e-9
        left = x[:, feature] <= edges[feature][cut]
        assert abs(low - boosting.leaf_value(g[left].sum(), h[left].sum(), s)) < 1e-9 and abs(weight - h.sum()) < 1e-9
        assert boosting.best_split(sums, np.array([True, False, False]), s)[0] in (0, -1)


def test_boosting_learns_stops_and_reads_back(spark, rows):
    flagged = rows.where("split <> 'test'").withColumn("is_val", F.col("split") == "val")
    model = boosting.SoftmaxBoost(4, "is_val", rounds=25, depth=4, rate=0.5, patience=4, l2=1.0).fit(flagged)
    losses = [x for x, _ in model.parts.curve]
    assert model.rounds == boosting.best_round(losses, 4)[0] == int(np.argmin(losses)) and losses[model.rounds] < 0.3
    assert len(losses) <= 26 and [r["round"] for r in model.curve(spark).where("kept").collect()] == [model.rounds]
    preds = models.predictions(model, rows, "m")
    # The curve is what the kept model scores.
    val = preds.where("split = 'val'")
    loss = val.agg(F.avg(-F.log(F.get("probabilities", F.col("label"))))).first()[0]
    assert abs(loss - losses[model.rounds]) < 1e-9
    test = preds.where("split = 'test'").agg(F.avg((F.col("label") == F.col("prediction")).cast("int"))).first()[0]
    assert test > 0.88
    assert preds.where(F.get("probabilities", F.lit(3)) > 0).count() == 0  # an absent class
    shares = model.importances
    assert abs(sum(shares) - 1) < 1e-9 and shares[2] < min(shares[:2])
    path = fresh_path(spark, "boost")
    models.save_model(model, path)
    back = models.predictions(models.load_model(path), rows, "m")
    assert back.exceptAll(preds).count() == 0


def test_shares_and_leaves(spark, rows):
    train = rows.where("split = 'train'")
    settings = dict(rounds=3, depth=5, leaves=4, rows=0.5, columns=0.67, seed=3)
    one, two = (boosting.SoftmaxBoost(3, **settings).fit(train) for _ in range(2))
    for a, b in zip(one.parts.trees, two.parts.trees):
        for s, t in zip(a, b):
            assert (s.feature == t.feature).all() and np.allclose(s.value, t.value)
            assert (s.feature >= 0).sum() <= 3 and len(set(s.feature[s.feature >= 0])) <= 2


def test_joint_boosting_keeps_up_with_a_model_per_class(spark, rows):
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")

    def accuracy(model):
        return models.predictions(model, test, "m").agg(F.avg((F.col("label") == F.col("prediction")).cast("int"))).first()[0]

    # Spark ML gives its first tree full weight, so the rates are not the same thing.
    joint = boosting.SoftmaxBoost(3, rounds=8, depth=3, rate=0.6).fit(train)
    apart = models.PerClassBoost(3, maxIter=8, maxDepth=3, stepSize=0.3).fit(train)
    assert accuracy(joint) >= accuracy(apart) - 0.02


def test_search_goes_on_where_it_was_cut_off(spark, rows):
    path, fits = fresh_path(spark, "search"), []
    settings = [{"rounds": 9, "depth": d, "rate": 0.4} for d in (1, 2, 3)]

    def make(stop_after=None):
        def build(**s):
            if stop_after is not None and len(fits) >= stop_after:
                raise RuntimeError("cut off")
            fits.append(s)
            return boosting.SoftmaxBoost(3, **s)

        return build

    train = rows.where("split = 'train' AND id % 3 = 0")
    with pytest.raises(RuntimeError):
        search.halving_search(make(4), settings, "rounds", train, path, rungs=(1 / 3, 1.0))
    done = search.read_ledger(spark, path).count()
    assert 0 < done <= 4
    first = len(fits)
    found = search.halving_search(make(), settings, "rounds", train, path, rungs=(1 / 3, 1.0))
    ledger = search.read_ledger(spark, path).collect()
    assert len(ledger) == 9 + 3 == done + (len(fits) - first - 1)  # one more is the refit
    best = {r.setting for r in ledger if r.rung == 1}
    assert len(best) == 1 and json.loads(next(r.told for r in ledger if r.rung == 1)) == found.setting and found.setting["rounds"] == 9
    by_setting = {}
    for r in ledger:
        if r.rung == 0:
            by_setting.setdefault(r.setting, []).append(r.f1)
    assert best == {max(by_setting, key=lambda i: (sum(by_setting[i]), -i))}
    again = search.halving_search(make(), settings, "rounds", train, path, rungs=(1 / 3, 1.0))
    assert again.setting == found.setting and again.f1 == found.f1 and search.read_ledger(spark, path).count() == 12


def test_bundles(spark, rows):
    train = models.with_weights(rows.where("split = 'train'"))
    forest = models.forest(numTrees=3, maxDepth=3).fit(train)
    boost = boosting.SoftmaxBoost(3, rounds=2, depth=3).fit(train)
    table = spark.createDataFrame([("a", "b", 0)], "column STRING, label STRING, code INT")
    made = bundle.Bundle({"forest": forest, "boost": boost}, table, table, {"boost": 0.5}, ("forest", "boost"))
    root = fresh_path(spark, "bundles")
    with pytest.raises(FileNotFoundError):
        bundle.load(spark, root)
    assert bundle.publish(spark, root, made) == 1
    assert bundle.publish(spark, root, bundle.Bundle({"boost": boost}, table, table, members=("boost",))) == 2
    assert bundle.versions(spark, root) == [1, 2] and not [n for n in storage.children(spark, root) if n.startswith("draft")]
    assert bundle.load(spark, root).members == ("boost",) and bundle.load(spark, root).version == 2
    one = bundle.load(spark, root, 1)
    # A model without a score counts 1.
    assert {r.model: round(r.weight, 6) for r in one.weights(spark).collect()} == {"forest": round(2 / 3, 6), "boost": round(1 / 3, 6)}
    assert one.votes(rows).exceptAll(made.votes(rows)).count() == 0
    with pytest.raises(ValueError):
        bundle.publish(spark, root, bundle.Bundle({"boost": boost}, table, table, members=("forest",)))
    with pytest.raises(FileNotFoundError):
        bundle.load(spark, root, 7)
    storage.delete(spark, f"{root}/version=1/models/forest")
    with pytest.raises(FileNotFoundError):
        bundle.load(spark, root, 1)


def test_any_model_of_a_bundle_types_errors(spark, sf):
    made, xy = inputs.trained_bundle(spark, sf)
    pairs = spark.createDataFrame([("would", "woould"), ("would", "wuld")], "correct_word string, incorrect_word string")
    for name in made.models:
        typed = {r.incorrect_word: r for r in models.error_types(pairs, made.typer(name)).collect()}
        assert typed["woould"].error_type == "insertion" and typed["wuld"].error_type == "deletion"
    assert set(made.f1) == set(made.models) and xy.count() > 0


def test_models_are_fitted_on_all_rows(spark, monkeypatch):
    """Boosting with fixed settings and the search get every row of their splits, however many there are."""
    n, fitted = 25_000, {}
    features = array_to_vector(F.array(F.rand(1), F.rand(2)))
    split = F.when(F.col("id") % 10 == 0, "test").when(F.col("id") % 10 < 3, "val").otherwise("train")
    many = spark.range(n).select("id", split.alias("split"), (F.col("id") % 3).cast("double").alias("label"), features.alias("features"))

    class Fitting:
        def __init__(self, classes, validation=None, **settings):
            pass

        def fit(self, df):
            fitted["fixed"] = df.groupBy("is_val").count().collect()

    monkeypatch.setattr(models, "SoftmaxBoost", Fitting)
    monkeypatch.setattr(models, "halving_search", lambda make, settings, budget, train, *args, **more: fitted.update(searched=train.count()))
    models.train_boost_fixed(many, 3, "smoke")
    models.random_search(None, models.FOREST_GRIDS["smoke"], 1, many, "numTrees", "unused")
    assert {r.is_val: r["count"] for r in fitted["fixed"]} == {False: n * 7 // 10, True: n * 2 // 10}
    assert fitted["searched"] == n
