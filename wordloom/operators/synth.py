"""Labelled misspellings by seeded rejection sampling.

Attempts are independent, so "keep trying until N pass" equals "the first N
attempts, by number, that pass".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wordloom import constants as K
from wordloom.functions import typos
from wordloom.functions.draws import draw
from wordloom.functions.plan import pinned
from wordloom.operators.ranking import MOST_SHARES, dense_index, hash_share
from wordloom.staging import stage

SAMPLE_COLUMNS = (
    "id", "correct_word", "incorrect_word", "error_type", "edit_distance", "word_length",
    "word_frequency",
)


def sample_row(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("id").cast("bigint").alias("id"), "correct_word", "incorrect_word", "error_type",
        F.col("edit_distance").cast("int").alias("edit_distance"),
        F.length("correct_word").alias("word_length"),
        F.col("word_frequency").cast("bigint").alias("word_frequency"),
    )


def typo_pairs(words: DataFrame, seed: int = K.SEED) -> DataFrame:
    """One seeded misspelling per word: (correct_word, incorrect_word, error_type, freq)."""
    return misspelt(words.select(F.col("word").alias("correct_word"), "freq"), "correct_word", seed)


def misspelt(rows: DataFrame, key: str, seed: int = K.SEED) -> DataFrame:
    """Add ``error_type`` and ``incorrect_word``, drawn by ``key``."""
    word = F.col("correct_word")
    edited = (
        typos.with_draws(rows, "correct_word", key, seed)
        .withColumn("error_type", typos.drawn_type())
        .withColumn("_edit", typos.edit_for(word, F.col("error_type")))
    )
    made = pinned(edited, "incorrect_word", typos.apply_edit(word, F.col("_edit")))
    return made.drop("_edit", *typos.HELPERS)


def candidate_draws(candidates: DataFrame, n_candidates: int, attempts: int, seed: int = K.SEED) -> DataFrame:
    """(attempt, word, freq): a uniform candidate per attempt, with replacement.

    ``candidates`` holds at most the candidate limit of short words; staged,
    its file size decides whether it is broadcast.
    """
    spark = candidates.sparkSession
    numbered = spark.range(attempts).withColumnRenamed("id", "attempt")
    pick = (draw(F.col("attempt"), seed, typos.CANDIDATE) % max(n_candidates, 1)).alias("idx")
    return numbered.select("attempt", pick).join(candidates, "idx").select("attempt", "word", "freq")


def attempts_with_errors(draws: DataFrame, seed: int = K.SEED) -> DataFrame:
    rows = draws.select("attempt", F.col("word").alias("correct_word"), F.col("freq").alias("word_frequency"))
    return misspelt(rows, "attempt", seed)


def pass_gate(attempts: DataFrame, dictionary: DataFrame, gate: str = "levenshtein") -> DataFrame:
    """Non-null, changed, exactly one edit away, and not a dictionary word.

    ``gate='osa'`` also lets a swap of neighbours pass as one edit; the default
    rejects swaps, since they are two edits.
    """
    right, wrong = F.col("correct_word"), F.col("incorrect_word")
    plain = F.levenshtein(right, wrong)
    distance = plain
    if gate == "osa":
        distance = F.when((F.col("error_type") == "transposition") & (right != wrong), F.lit(1)).otherwise(plain)
    elif gate != "levenshtein":
        raise ValueError(f"unknown gate {gate!r}")
    real_words = dictionary.select(F.col("word").alias("incorrect_word"))
    return (
        attempts.where(wrong.isNotNull() & (wrong != right))
        .withColumn("edit_distance", distance)
        .where(F.col("edit_distance") == 1)
        .join(real_words, "incorrect_word", "left_anti")
    )


def error_samples(
    candidates: DataFrame, n_candidates: int, dictionary: DataFrame, samples: int,
    seed: int = K.SEED, gate: str = "levenshtein",
) -> DataFrame:
    attempts = samples * K.ATTEMPTS_PER_SAMPLE
    draws = candidate_draws(candidates, n_candidates, attempts, seed)
    passed = pass_gate(attempts_with_errors(draws, seed), dictionary, gate)
    # Attempt numbers are even by construction: equal runs of them are equal shares.
    run = F.floor(F.col("attempt") / (attempts // MOST_SHARES + 1))
    return sample_row(
        dense_index(passed, [F.col("attempt")], "id", run).where(F.col("id") <= samples)
    )


def sample_without_replacement(words: DataFrame, n: int, seed: int = K.SEED) -> DataFrame:
    """min(n, available) distinct words in hash order, with their place ``pick`` from 1."""
    order = F.md5(F.concat_ws(":", F.lit("sample"), F.lit(str(seed)), "word"))
    keyed = words.withColumn("_h", order)
    drawn = dense_index(keyed, [F.col("_h"), F.col("word")], "pick", hash_share(F.col("_h")))
    return drawn.where(F.col("pick") <= n).drop("_h")


def correct_samples(candidates: DataFrame, samples: int, seed: int = K.SEED) -> DataFrame:
    chosen = sample_without_replacement(candidates.select("word", "freq"), samples, seed)
    return sample_row(
        chosen.select(
            F.lit(0).alias("id"), F.col("word").alias("correct_word"),
            F.col("word").alias("incorrect_word"), F.lit(K.CORRECT_LABEL).alias("error_type"),
            F.lit(0).alias("edit_distance"), F.col("freq").alias("word_frequency"),
        )
    )


def shuffle_renumber(samples: DataFrame, seed: int = K.SEED) -> DataFrame:
    """Seeded permutation, then ids 1..N."""
    order = F.md5(
        F.concat_ws(":", F.lit("order"), F.lit(str(seed)), F.col("id").cast("string"),
                    "correct_word", "incorrect_word")
    )
    keyed = samples.withColumn("_h", order)
    # Rows equal in all these columns are interchangeable.
    total_order = [F.col(c) for c in ("_h", "id", "correct_word", "incorrect_word")]
    return dense_index(keyed, total_order, "_id", hash_share(F.col("_h"))).select(
        F.col("_id").cast("bigint").alias("id"), *SAMPLE_COLUMNS[1:]
    )


def union_samples(errors: DataFrame, correct: DataFrame) -> DataFrame:
    return errors.unionByName(correct)


def build_dataset(
    candidates: DataFrame, n_candidates: int, dictionary: DataFrame,
    errors: int = K.ERROR_SAMPLES, correct: int = K.CORRECT_SAMPLES,
    seed: int = K.SEED, gate: str = "levenshtein",
) -> DataFrame:
    """The labelled dataset, staged: the first cut point of the training flow."""
    wrong = error_samples(candidates, n_candidates, dictionary, errors, seed, gate)
    right = correct_samples(candidates, correct, seed)
    return stage(shuffle_renumber(union_samples(wrong, right), seed), "dataset")
