import itertools

import duckdb
import pytest
from pyspark.sql import functions as F

from wordloom.functions import features as ft
from wordloom.functions.strings import jaro_winkler


def value(spark, make, *words):
    df = spark.createDataFrame([words], ", ".join(f"c{i} string" for i in range(len(words))))
    return df.select(make(*[F.col(c) for c in df.columns]).alias("v")).first().v


@pytest.mark.parametrize("make,word,expected", [
    (ft.num_double_letters, "aaa", 2), (ft.num_double_letters, "aAb", 0), (ft.has_double_letters, "abba", 1),
    (ft.syllable_count, "bee", 1), (ft.syllable_count, "rhythm", 1), (ft.syllable_count, "queue", 1),
    (ft.syllable_count, "banana", 3), (ft.is_alternating, "banana", 1), (ft.is_alternating, "ab", 0),
    (ft.is_alternating, "abbey", 0), (ft.has_repeated_vowels, "banana", 1), (ft.has_repeated_vowels, "beauty", 0),
    (ft.max_consonant_cluster, "strength", 4), (ft.max_vowel_cluster, "queue", 4), (ft.max_vowel_cluster, "xyz", 0),
    (ft.unique_vowels, "Banana", 1), (ft.unique_consonants, "aeiou", 0), (ft.unique_consonants, "banana", 2),
    (ft.char_diversity, "aab", 2 / 3), (ft.char_diversity, "", 0.0), (ft.middle_char, "abcd", "c"),
    (ft.middle_char, "", "x"), (ft.num_consonants, "a1b", 2),
])
def test_hand_computed(spark, make, word, expected):
    assert value(spark, make, word) == pytest.approx(expected) if isinstance(expected, float) else value(spark, make, word) == expected


def test_long_word_does_not_overflow(spark):
    assert value(spark, ft.is_alternating, "ab" * 50_000) == 1


@pytest.mark.parametrize("a,b,expected", [
    ("martha", "marhta", 0.9611), ("abcd", "abxy", 0.6667), ("", "", 1.0), ("a", "", 0.0), ("dixon", "dicksonx", 0.8133),
])
def test_jaro_winkler_known(spark, a, b, expected):
    assert value(spark, jaro_winkler, a, b) == pytest.approx(expected, abs=1e-4)


def test_jaro_winkler_short_words_exhaustively(spark):
    words = ["".join(p) for n in range(1, 6) for p in itertools.product("ab", repeat=n)]
    words += ["".join(p) for n in range(2, 5) for p in itertools.product("abc", repeat=n)]
    words = sorted(set(words))
    df = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    mine = df.select("a", "b", jaro_winkler(F.col("a"), F.col("b")).alias("v")).toPandas()
    theirs = duckdb.sql("SELECT a, b, jaro_winkler_similarity(a, b) AS v FROM mine").df()
    both = mine.merge(theirs, on=["a", "b"])
    bad = both[(both.v_x - both.v_y).abs() > 1e-9]
    assert bad.empty, bad.head()


def test_length_basis(spark):
    df = spark.createDataFrame([("cat", "cart", 3)], "correct_word string, incorrect_word string, word_length int")
    assert ft.with_features(df).first().vowel_ratio == pytest.approx(1 / 3)
    assert ft.with_features(df, length_basis="incorrect").first().vowel_ratio == pytest.approx(1 / 4)
