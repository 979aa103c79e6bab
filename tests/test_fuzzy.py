import random

import duckdb
from pyspark.sql import functions as F

from wordloom.operators import correct, fuzzy


def words(spark, items):
    return spark.createDataFrame([(w, i + 1) for i, w in enumerate(sorted(set(items)))], "word string, freq long")


def brute(queries, items):
    q, d = [(x,) for x in queries], [(x,) for x in items]
    con = duckdb.connect()
    con.execute("CREATE TABLE q(a VARCHAR)"), con.executemany("INSERT INTO q VALUES (?)", q)
    con.execute("CREATE TABLE d(b VARCHAR)"), con.executemany("INSERT INTO d VALUES (?)", d)
    return {(a, b, n) for a, b, n in con.execute("SELECT a, b, levenshtein(a, b) AS n FROM q, d WHERE n <= 2").fetchall()}


def mutate(rng, w):
    for _ in range(rng.randint(0, 3)):
        i = rng.randint(0, len(w))
        w = rng.choice([w[:i] + rng.choice("abc") + w[i:], w[:i] + w[i + 1:], w[:i] + rng.choice("abc") + w[i + 1:]])
    return w


def found(spark, queries, items, **options):
    q = spark.createDataFrame([(x,) for x in queries], "query string")
    return {(r.query, r.word, r.distance) for r in fuzzy.fuzzy_join(q, words(spark, items), **options).collect()}


def test_equals_all_pairs_around_the_scheme_boundary(spark):
    rng = random.Random(1)
    items = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 11))) for _ in range(250)}
    queries = {mutate(rng, w) for w in items} - {""}
    want = brute(queries, items)
    assert found(spark, queries, items) == want
    # A low boundary sends most pairs through the segment scheme.
    for longest in (4, 6):
        assert found(spark, queries, items, longest=longest) == want


def test_long_words(spark):
    rng = random.Random(2)
    items = {"".join(rng.choice("ab") for _ in range(rng.randint(14, 40))) for _ in range(80)}
    queries = {mutate(rng, w) for w in items for _ in range(3)}
    assert found(spark, queries, items) == brute(queries, items)


def test_smaller_distance(spark):
    assert found(spark, ["cat"], ["cat", "cart", "carts"], max_distance=1) == {("cat", "cat", 0), ("cat", "cart", 1)}


def test_pruning_before_similarity_loses_nothing(spark):
    rng = random.Random(3)
    items = {"".join(rng.choice("abc") for _ in range(rng.randint(3, 7))) for _ in range(400)}
    queries = {mutate(rng, w) for w in sorted(items)[:80]} - items - {""}
    q = spark.createDataFrame([(x,) for x in queries], "query string")
    pairs = fuzzy.fuzzy_join(q, words(spark, items)).cache()
    full = pairs.withColumn("score", correct.score(F.col("query"), F.col("word"), F.col("distance"), F.col("freq"))).toPandas()
    full = full.sort_values(["query", "score", "word"], ascending=[True, False, True])
    want = full.groupby("query").head(3)[["query", "word"]]
    got = correct.top_corrections(pairs, 3).toPandas().sort_values(["query", "rank"])[["query", "word"]]
    assert got.values.tolist() == want.values.tolist()


def test_word_check(spark):
    d = spark.createDataFrame([("the", 100), ("then", 50), ("cat", 9)], "word string, freq long")
    rows = spark.createDataFrame([(" The ",), ("teh",), ("zzzzzzzz",), ("  ",), (None,)], "word string")
    out = {r.word: r for r in correct.check_words(rows, d).collect()}
    assert out["The"].is_correct and out["The"].corrections == []
    assert [c.word for c in out["teh"].corrections] == ["the", "then"]
    assert out["zzzzzzzz"].corrections == [] and not out["zzzzzzzz"].is_correct
    assert out[""].status == "empty" and out[None].status == "empty"


def test_sentence_check(spark):
    d = spark.createDataFrame([("the", 100), ("cat", 50), ("sat", 9)], "word string, freq long")
    rows = [(1, " Thf caat sat, a CAT sat. thf 42 "), (2, "the cat"), (3, " "), (4, None), (5, "Qqqqqqq")]
    out = {r.id: r for r in correct.check_sentences(spark.createDataFrame(rows, "id int, sentence string"), ["id"], d).collect()}
    assert out[1].corrected_sentence == "The cat sat, a CAT sat. the 42"
    assert [(e.original, e.correction, e.position, e.token_index) for e in out[1].errors] == [
        ("Thf", "The", 0, 0), ("caat", "cat", 4, 1), ("thf", "the", 0, 8)]
    assert out[1].num_errors == 3 and out[1].has_errors
    assert out[2].corrected_sentence == "the cat" and out[2].errors == [] and not out[2].has_errors
    assert out[3].status == out[4].status == "empty" and out[3].corrected_sentence is None
    assert out[5].corrected_sentence == "Qqqqqqq"


def test_shuffled_and_broadcast_plans_agree(spark, monkeypatch):
    rng = random.Random(4)
    items = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 20))) for _ in range(150)}
    queries = {mutate(rng, w) for w in items} - {""}
    want = found(spark, queries, items)
    monkeypatch.setattr(fuzzy, "BROADCAST_KEYS", 0)
    q = spark.createDataFrame([(x,) for x in queries], "query string")
    plan = fuzzy.fuzzy_join(q, words(spark, items))._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan
    assert found(spark, queries, items) == want == brute(queries, items)


def test_heavy_keys_are_dealt_out(spark, monkeypatch):
    """One-letter queries of one key spread over tasks, and no pair is lost or doubled."""
    letters = [chr(i) for i in range(35, 126)]
    items = {a + b for a in letters[:40] for b in letters[:20]} | set(letters[::7]) | {"ab", "abc", "abcd"}
    queries = set(letters) | {"a", "abx"}
    want = brute(queries, items)
    assert found(spark, queries, items) == want
    monkeypatch.setattr(fuzzy, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(fuzzy, "KEY_PAIRS", 2_000)
    assert found(spark, queries, items) == want
    q = spark.createDataFrame([(x,) for x in queries], "query string")
    index = fuzzy.stage(fuzzy.dictionary_keys(words(spark, items)), "keys")
    met = fuzzy._candidates(fuzzy.query_keys(q), index).groupBy("_key").agg(F.count("*").alias("n"))
    heaviest = met.orderBy(F.desc("n")).first()
    pairs = fuzzy._dealt(fuzzy.stage(fuzzy.query_keys(q), "q"), index)
    slices = pairs[0].where(F.col("_key") == heaviest._key).select("_slice").distinct().count()
    assert heaviest.n > 50_000 and slices >= heaviest.n // 2_000
