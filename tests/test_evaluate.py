import pytest
from pyspark.sql import functions as F

from wordloom.operators import ensemble, evaluate as ev, models
from wordloom.operators.lookup import left_lookup

CELLS = {("a", "a"): 6, ("a", "b"): 2, ("b", "a"): 1, ("b", "b"): 5, ("c", "a"): 2}


@pytest.fixture
def preds(spark):
    rows = [("m", x, y) for (x, y), n in CELLS.items() for _ in range(n)]
    return spark.createDataFrame(rows, "model string, label string, prediction string")


def test_metrics_by_hand(preds):
    rows = {r["class"]: r for r in ev.per_class(preds).collect()}
    assert (rows["a"].precision, rows["a"].recall, rows["a"].support) == (6 / 9, 6 / 8, 8)
    assert (rows["c"].precision, rows["c"].recall, rows["c"].f1, rows["c"].support) == (0, 0, 0, 2)
    assert ev.accuracy(preds).first().accuracy == 11 / 16
    assert ev.confusion(preds).agg(F.sum("n")).first()[0] == 16
    assert ev.metrics(preds).first().recall == pytest.approx(11 / 16)


def test_vote_weights_default_and_sum(spark):
    scores = spark.createDataFrame([("a", 0.5), ("b", None)], "model string, f1 double")
    weights = {r.model: r.weight for r in ensemble.vote_weights(scores).collect()}
    assert weights == {"a": pytest.approx(1 / 3), "b": pytest.approx(2 / 3)}


def test_soft_vote_ties_go_to_the_first_class(spark):
    rows = [("m", 1, "b", 0.5), ("m", 1, "a", 0.5), ("n", 1, "b", 0.5), ("n", 1, "a", 0.5)]
    p = spark.createDataFrame(rows, "model string, id int, class string, p double")
    w = spark.createDataFrame([("m", 0.7), ("n", 0.3)], "model string, weight double")
    assert ensemble.soft_vote(p, w).first().prediction == "a"


def test_lookup_with_a_hot_key(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"))
    rows = rows.unionByName(spark.createDataFrame([(9999, None)], "id long, k string"))
    table = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, v int")
    mine = {(r.id, r.k, r.v) for r in left_lookup(rows, table, "k", 0.05).collect()}
    assert mine == {(r.id, r.k, r.v) for r in rows.join(table, "k", "left").select("id", "k", "v").collect()}
    assert len(mine) == 3001


def test_settings_are_distinct_and_seeded():
    a = models.sampled_settings(models.FOREST_GRIDS["wide"], 15)
    assert a == models.sampled_settings(models.FOREST_GRIDS["wide"], 15)
    assert len({tuple(sorted(s.items())) for s in a}) == 15
    assert max(s["maxDepth"] for s in a) <= 30


def test_deviation_of_large_values(spark):
    from wordloom.operators import profiles

    df = spark.createDataFrame([(1e9,), (1e9 + 1,), (1e9 + 2,)], "x double")
    stats = {r.stat: r.value for r in profiles.describe(df, ["x"]).collect()}
    assert stats["std"] == 1.0 and stats["mean"] == 1e9 + 1
    lengths = profiles.length_stats(spark.createDataFrame([("a",), ("abc",)], "word string")).first()
    assert abs(lengths.std_length - 2**0.5) < 1e-12


def test_confusion_matrix_loses_no_prediction(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "z")], "label string, prediction string")
    assert ev.confusion_matrix(df, ["a", "b"]).first().asDict() == {"label": "a", "a": 1, "b": 0, "other": 1}
