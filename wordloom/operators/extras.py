"""Further word statistics: entropy, vowel places, letter rarity, n-gram weights, relevance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wordloom import constants as K
from wordloom.functions.strings import char_at


def char_entropy(word: Column) -> Column:
    """Shannon entropy, base 2, of the characters of a word."""
    n = F.length(word).cast("double")
    letters = F.array_distinct(F.split(word, ""))

    def term(total: Column, c: Column) -> Column:
        p = (F.length(word) - F.length(F.replace(word, c, F.lit("")))) / n
        return total - p * F.log2(p)

    return F.when(n > 0, F.aggregate(letters, F.lit(0.0), term)).otherwise(F.lit(0.0))


def gram_count(word: Column, k: int) -> Column:
    return F.greatest(F.length(word) - (k - 1), F.lit(0))


def vowel_positions(word: Column) -> Column:
    low = F.lower(word)
    return F.filter(
        F.sequence(F.lit(0), F.length(word) - 1), lambda i: char_at(low, i + 1).isin(*K.VOWELS)
    )


def vowel_position_mean(word: Column) -> Column:
    """Mean 0-based vowel position over the word length; 0 without vowels."""
    places = vowel_positions(word)
    total = F.aggregate(places, F.lit(0), lambda s, i: s + i)
    return F.when(F.size(places) > 0, total / F.size(places) / F.length(word)).otherwise(F.lit(0.0))


def vowel_position_variance(word: Column) -> Column:
    """Population variance of (vowel position / word length); 0 without vowels."""
    places, n = vowel_positions(word), F.length(word)
    total = F.aggregate(places, F.lit(0), lambda s, i: s + i)
    squares = F.aggregate(places, F.lit(0), lambda s, i: s + i * i)
    k = F.size(places)
    spread = (squares / k - (total / k) * (total / k)) / (n * n)
    return F.when(k > 0, spread).otherwise(F.lit(0.0))


def letter_shares(vocab: DataFrame) -> DataFrame:
    """(letter, share) over all letter occurrences of the corpus."""
    counts = (
        vocab.select(F.explode(F.split("word", "")).alias("letter"), "freq")
        .groupBy("letter").agg(F.sum("freq").alias("n"))
    )
    total = counts.agg(F.sum("n").alias("t"))
    return counts.select("letter", (F.col("n") / total.scalar()).alias("share"))


def char_frequency(vocab: DataFrame) -> DataFrame:
    """(word, char_freq_mad, char_freq_var) of the corpus shares of a word's letters.

    The share table has one row per letter of the alphabet; it enters as one
    map, so words never leave their partition.
    """
    shares = letter_shares(vocab).agg(
        F.map_from_entries(F.collect_list(F.struct("letter", "share"))).alias("m")
    )
    held = vocab.select("word", shares.scalar().alias("m"))
    x = F.transform(F.split("word", ""), lambda c: F.col("m")[c])

    def mean(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda s, v: s + v) / F.size(values)

    deviations = held.select("word", x.alias("x")).select("word", "x", mean(F.col("x")).alias("mu"))
    return deviations.select(
        "word",
        mean(F.transform("x", lambda v: F.abs(v - F.col("mu")))).alias("char_freq_mad"),
        mean(F.transform("x", lambda v: (v - F.col("mu")) * (v - F.col("mu")))).alias("char_freq_var"),
    )


def _grams_of_size(word: Column, k: int) -> Column:
    n = F.length(word)
    slices = F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substr(word, i, F.lit(k)))
    return F.when(n >= k, slices).otherwise(F.array().cast("array<string>"))


def char_grams(word: Column, sizes: tuple[int, ...] = (2, 3, 4)) -> Column:
    return F.concat(*[_grams_of_size(word, k) for k in sizes])


def gram_documents(words: DataFrame, sizes: tuple[int, ...] = (2, 3, 4)) -> DataFrame:
    """(gram, df): in how many words a character n-gram occurs."""
    grams = words.select(F.explode(F.array_distinct(char_grams(F.col("word"), sizes))).alias("gram"))
    return grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))


def gram_vocabulary(words: DataFrame, size: int = 100, sizes: tuple[int, ...] = (2, 3, 4)) -> DataFrame:
    """The ``size`` most widespread n-grams with smoothed idf ln((N+1)/(df+1)) + 1."""
    top = gram_documents(words, sizes).orderBy(F.desc("df"), "gram").limit(size)
    total = words.agg(F.count(F.lit(1)).alias("n"))
    return top.withColumn("idf", F.log((total.scalar() + 1) / (F.col("df") + 1)) + 1)


def tfidf(words: DataFrame, vocabulary: DataFrame, sizes: tuple[int, ...] = (2, 3, 4)) -> DataFrame:
    """(word, gram, tf, weight) for the n-grams of a bounded vocabulary."""
    tf = (
        words.select("word", F.explode(char_grams(F.col("word"), sizes)).alias("gram"))
        .join(F.broadcast(vocabulary.select("gram", "idf")), "gram")
        .groupBy("word", "gram", "idf").agg(F.count(F.lit(1)).alias("tf"))
    )
    return tf.select("word", "gram", "tf", (F.col("tf") * F.col("idf")).alias("weight"))


def feature_scores(
    df: DataFrame, features: tuple[str, ...], label: str = "error_type", bins: int = 10
) -> DataFrame:
    """(feature, score): mutual information with the label, in nats, on quantile bins.

    Values are grouped with their counts before binning, so the ranking window
    runs over distinct values per feature and equal values share a bin.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features
    ])
    counts = (
        df.select(F.col(label).alias("label"), F.explode(pairs).alias("p"))
        .groupBy(F.col("p.feature").alias("feature"), F.col("p.value").alias("value"), "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    values = counts.groupBy("feature", "value").agg(F.sum("n").alias("n"))
    before = W.partitionBy("feature").orderBy("value").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("feature")
    binned = values.select(
        "feature", "value",
        F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) * bins / F.sum("n").over(whole)).alias("bin"),
    )
    joint = (
        counts.join(binned, ["feature", "value"]).groupBy("feature", "bin", "label")
        .agg(F.sum("n").alias("n"))
    )
    n = F.col("n").cast("double")
    total = F.sum("n").over(W.partitionBy("feature"))
    in_bin = F.sum("n").over(W.partitionBy("feature", "bin"))
    in_label = F.sum("n").over(W.partitionBy("feature", "label"))
    part = n / total * F.log(n * total / (in_bin.cast("double") * in_label))
    return (
        joint.select("feature", part.alias("part")).groupBy("feature")
        .agg(F.greatest(F.sum("part"), F.lit(0.0)).alias("score"))
    )
