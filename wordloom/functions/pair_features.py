"""Serving-time features of a (correct, incorrect) pair."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from wordloom import constants as K
from wordloom.functions import features as ft
from wordloom.functions.strings import char_at, jaro_winkler


def _share(amount: Column, size: Column) -> Column:
    return F.when(size > 0, amount.cast("double") / size).otherwise(F.lit(0.0))


def edit_distance(right: Column, wrong: Column) -> Column:
    return F.levenshtein(right, wrong)


def log_frequency(freq: Column) -> Column:
    return F.log1p(F.coalesce(freq, F.lit(0)).cast("double"))


def error_position(right: Column, wrong: Column) -> Column:
    """First differing 0-based index, else the shorter length."""
    shorter = F.least(F.length(right), F.length(wrong))
    differing = F.filter(
        F.sequence(F.lit(0), shorter - 1),
        lambda i: char_at(right, i + 1) != char_at(wrong, i + 1),
    )
    return F.when(shorter == 0, F.lit(0)).otherwise(F.coalesce(F.get(differing, F.lit(0)), shorter))


def error_position_ratio(right: Column, wrong: Column) -> Column:
    return _share(error_position(right, wrong), F.length(right))


def error_on_vowel(right: Column, wrong: Column) -> Column:
    """Case-sensitive on purpose: only lowercase vowels of the correct word count."""
    return char_at(right, error_position(right, wrong) + 1).isin(*K.VOWELS).cast("int")


def error_at_beginning(right: Column, wrong: Column) -> Column:
    return (error_position(right, wrong) < F.length(right) * 0.3).cast("int")


def freq_bin(freq: Column) -> Column:
    f = F.coalesce(freq, F.lit(0))
    return (
        F.when(f == 0, 5).when(f < 50, 0).when(f < 200, 1).when(f < 1000, 2).when(f < 5000, 3)
        .otherwise(4)
    )


def levenshtein_ratio(right: Column, wrong: Column) -> Column:
    longest = F.greatest(F.length(right), F.length(wrong))
    return 1 - F.levenshtein(right, wrong).cast("double") / longest


def letter_code(letter: Column) -> Column:
    return F.ascii(F.lower(letter)) - F.ascii(F.lit("a"))


def gram_code(gram: Column, size: int, modulus: int) -> Column:
    """Sum of the character codes, modulo; a short word uses a run of ``a``."""
    low = F.lower(F.when(F.length(gram) >= size, gram).otherwise(F.lit("a" * size)))
    return sum((F.ascii(char_at(low, F.lit(k + 1))) for k in range(size)), F.lit(0)) % modulus


def ord_codes(word: Column) -> dict[str, Column]:
    return {
        "first_char_encoded": letter_code(ft.leading(word, 1)),
        "last_char_encoded": letter_code(ft.trailing(word, 1)),
        "first_bigram_encoded": gram_code(ft.leading(word, 2), 2, 676),
        "last_bigram_encoded": gram_code(ft.trailing(word, 2), 2, 676),
        "first_trigram_encoded": gram_code(ft.leading(word, 3), 3, 17576),
        "last_trigram_encoded": gram_code(ft.trailing(word, 3), 3, 17576),
        "middle_char_encoded": letter_code(ft.middle_char(word)),
    }


def serve_row(word: Column) -> dict[str, Column]:
    """The 28 model inputs as computed at serving time, all from the correct word."""
    size = F.length(word)
    values: dict[str, Column] = {"word_length": size}
    values |= {name: make(word, size) for name, make in ft.DERIVED.items()}
    values |= ord_codes(word)
    low = F.lower(word)
    values["first_bigram_common"] = ft.leading(low, 2).isin(*K.SERVE_FIRST_BIGRAMS).cast("int")
    values["last_bigram_common"] = ft.trailing(low, 2).isin(*K.SERVE_LAST_BIGRAMS).cast("int")
    return {name: values[name] for name in K.FEATURES}


# name -> f(correct word, incorrect word, frequency of the correct word)
PAIR: dict[str, Callable[[Column, Column, Column], Column]] = {
    "edit_distance": lambda c, i, f: edit_distance(c, i),
    "log_frequency": lambda c, i, f: log_frequency(f),
    "error_position": lambda c, i, f: error_position(c, i),
    "error_position_ratio": lambda c, i, f: error_position_ratio(c, i),
    "error_on_vowel": lambda c, i, f: error_on_vowel(c, i),
    "error_at_beginning": lambda c, i, f: error_at_beginning(c, i),
    "freq_bin": lambda c, i, f: freq_bin(f),
    "levenshtein_ratio": lambda c, i, f: levenshtein_ratio(c, i),
    "jaro_similarity": lambda c, i, f: jaro_winkler(c, i),
}
