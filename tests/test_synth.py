from pyspark.sql import functions as F

from wordloom import constants as K
from wordloom.operators import prepare, ranking, synth
from wordloom.plans import inputs
from wordloom.staging import stage


def test_dataset_invariants(spark, sf):
    chosen, n, words = inputs.candidates(spark, sf)
    errors, right = K.ERROR_SAMPLES, min(K.CORRECT_SAMPLES, n)
    df = synth.build_dataset(chosen, n, words).toPandas()
    assert list(df.columns) == list(synth.SAMPLE_COLUMNS)
    assert sorted(df.id) == list(range(1, errors + right + 1))
    wrong = df[df.error_type != "correct"]
    assert len(wrong) == errors and (wrong.edit_distance == 1).all()
    assert not set(wrong.incorrect_word) & {r.word for r in words.collect()}
    assert "transposition" not in set(df.error_type)
    delta = wrong.incorrect_word.str.len() - wrong.correct_word.str.len()
    assert (delta == wrong.error_type.map({"insertion": 1, "deletion": -1, "substitution": 0})).all()
    assert (df.word_length == df.correct_word.str.len()).all()


def test_osa_gate_keeps_swaps(spark, sf):
    chosen, n, words = inputs.candidates(spark, sf)
    df = synth.error_samples(chosen, n, words, 400, gate="osa")
    assert df.where(F.col("error_type") == "transposition").count() > 0


def test_dense_index_orders_and_counts(spark):
    df = stage(spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")), "t")
    rows = ranking.dense_index(df, [F.col("k")], "n").collect()
    assert all(r.n == r.k + 1 for r in rows) and len(rows) == 1000
    shared = ranking.dense_index(df, [F.col("k")], "n", F.floor(F.col("k") / 100)).collect()
    assert all(r.n == r.k + 1 for r in shared)


def test_top_words_cut_through_ties(spark):
    rows = [("a", 9), ("b", 5), ("c", 5), ("d", 5), ("e", 1)]
    vocab = stage(spark.createDataFrame(rows, "word string, freq long"), "v")
    assert [tuple(r) for r in ranking.rank_words(vocab, 3).orderBy("rank").collect()] == [("a", 9, 1), ("b", 5, 2), ("c", 5, 3)]
    assert {r.word for r in ranking.most_frequent(vocab, 3).collect()} == {"a", "b", "c"}
    assert ranking.most_frequent(vocab, 9).count() == ranking.rank_words(vocab, 9).count() == 5


def test_group_split(spark, sf):
    df = inputs.dataset(spark, sf)
    split = prepare.split_by_group(df).toPandas()
    groups = split.drop_duplicates("correct_word")
    g = len(groups)
    held = -(-g * 25 // 100)
    sizes = groups.split.value_counts()
    assert len(split) == df.count() and sizes["train"] == g - held
    assert sizes["test"] == -(-held * 6 // 10)
    assert split.groupby("correct_word").split.nunique().max() == 1
    rough = prepare.split_by_group(df, mode="approx")
    assert all(r.leaking == 0 for r in prepare.leak_check(rough).collect())
    mixed = spark.createDataFrame([("a", "train"), ("a", "test"), ("b", "val")], "correct_word string, split string")
    assert {tuple(r) for r in prepare.leak_check(mixed).collect()} == {("train", 1, 1), ("test", 1, 1), ("val", 1, 0)}


def test_scaling(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 3.0)], "id int, a double, b double")
    scaler = prepare.scaler_table(df, ("a", "b"))
    rows = prepare.scale(df, scaler, ("a", "b")).orderBy("id").collect()
    assert [(r.a, r.b) for r in rows] == [(0.0, -1.0), (0.0, 1.0)]


def test_null_words(spark):
    df = spark.createDataFrame([("null", 1), ("nan", 2), (None, 3), ("x", 4)], "w string, n int")
    assert prepare.drop_nulls(df).count() == 3
    assert prepare.drop_nulls(df, ("null", "nan")).count() == 1


def test_unseen_label_gets_minus_one(spark):
    seen = spark.createDataFrame([("a",), ("b",)], "first_char string")
    codes = prepare.encoder_table(seen, ("first_char",))
    out = prepare.encode(spark.createDataFrame([("b",), ("z",)], "first_char string"), codes, ("first_char",))
    assert {r.first_char: r.first_char_encoded for r in out.collect()} == {"b": 1, "z": -1}


def test_dictionary_has_no_floor_and_a_known_size(spark, sf):
    """Rare words are in the dictionary with frequency 0; a small cut still joins by broadcast."""
    words = inputs.staged_vocab(spark, sf)
    full = inputs.dictionary_of(words)
    assert full.count() == words.count() and full.where("freq > 0").count() == words.where(F.col("freq") >= K.TABLE_MIN_FREQ).count()
    cut = stage(ranking.most_frequent(words, 100), "cut-dictionary")
    assert cut.count() == 100
    plan = spark.range(10).select(F.col("id").cast("string").alias("word")).join(cut.select("word"), "word", "left_anti")
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()


def test_dataset_is_built_the_same_twice(spark, sf):
    chosen, n, words = inputs.candidates(spark, sf)
    first, second = (synth.build_dataset(chosen, n, words, 500, 100) for _ in range(2))
    assert first.exceptAll(second).count() == 0 and first.count() == second.count() == 600
