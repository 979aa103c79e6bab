"""Word-shape features as column expressions (no Python UDF).

``word`` is the string under study; ``size`` is the word length used as the
denominator, which for a misspelling is the length of the correct word.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wordloom import constants as K
from wordloom.functions.strings import char_at

_NOT_VOWEL = f"[^{K.VOWELS}]"
_VOWEL = f"[{K.VOWELS}]"


def _flag(condition: Column) -> Column:
    return condition.cast("int")


def _longest_piece(word: Column, separator: str) -> Column:
    return F.array_max(F.transform(F.split(F.lower(word), separator), F.length))


def num_vowels(word: Column) -> Column:
    low = F.lower(word)
    return F.length(low) - F.length(F.translate(low, K.VOWELS, ""))


def num_consonants(word: Column) -> Column:
    return F.length(word) - num_vowels(word)


def per_letter(amount: Column, size: Column) -> Column:
    return amount.cast("double") / size


def leading(word: Column, k: int) -> Column:
    return F.substr(word, F.lit(1), F.lit(k))


def trailing(word: Column, k: int) -> Column:
    return F.right(word, F.lit(k))


def num_double_letters(word: Column) -> Column:
    """Equal neighbours, overlapping: the look-ahead does not consume the second letter."""
    return F.regexp_count(word, F.lit(r"(?s)(.)(?=\1)"))


def has_double_letters(word: Column) -> Column:
    return _flag(num_double_letters(word) > 0)


def has_repeated_vowels(word: Column) -> Column:
    only_vowels = F.regexp_replace(F.lower(word), _NOT_VOWEL, "")
    return _flag(reduce(lambda a, b: a | b, [only_vowels.contains(v + v) for v in K.VOWELS]))


def is_alternating(word: Column) -> Column:
    same_kind = F.lower(word).rlike(f"{_VOWEL}{{2}}|{_NOT_VOWEL}{{2}}")
    return _flag((F.length(word) >= 3) & ~same_kind)


def syllable_count(word: Column) -> Column:
    low = F.lower(word)
    runs = F.regexp_count(low, F.lit(f"{_VOWEL}+"))
    return F.greatest(runs - _flag(low.endswith("e")), F.lit(1))


def max_consonant_cluster(word: Column) -> Column:
    return _longest_piece(word, _VOWEL)


def max_vowel_cluster(word: Column) -> Column:
    return _longest_piece(word, _NOT_VOWEL)


def distinct_chars(word: Column) -> Column:
    count = F.size(F.array_distinct(F.split(word, "")))
    return F.when(F.length(word) == 0, F.lit(0)).otherwise(count)


def char_diversity(word: Column) -> Column:
    return F.when(F.length(word) == 0, F.lit(0.0)).otherwise(
        per_letter(distinct_chars(word), F.length(word))
    )


def unique_vowels(word: Column) -> Column:
    low = F.lower(word)
    return sum((_flag(F.instr(low, v) > 0) for v in K.VOWELS), F.lit(0))


def unique_consonants(word: Column) -> Column:
    return distinct_chars(F.translate(F.lower(word), K.VOWELS, ""))


def is_vowel(letter: Column) -> Column:
    return _flag(F.lower(letter).isin(*K.VOWELS))


def middle_char(word: Column) -> Column:
    middle = char_at(word, F.floor(F.length(word) / 2).cast("int") + 1)
    return F.when(F.length(word) == 0, F.lit("x")).otherwise(middle)


# Derived columns in their order; each takes (word, word length of the correct word).
DERIVED: dict[str, Callable[[Column, Column], Column]] = {
    "num_vowels": lambda w, n: num_vowels(w),
    "num_consonants": lambda w, n: num_consonants(w),
    "vowel_ratio": lambda w, n: per_letter(num_vowels(w), n),
    "consonant_ratio": lambda w, n: per_letter(num_consonants(w), n),
    "first_char": lambda w, n: leading(w, 1),
    "last_char": lambda w, n: trailing(w, 1),
    "first_bigram": lambda w, n: leading(w, 2),
    "last_bigram": lambda w, n: trailing(w, 2),
    "first_trigram": lambda w, n: leading(w, 3),
    "last_trigram": lambda w, n: trailing(w, 3),
    "first_bigram_common": lambda w, n: _flag(leading(w, 2).isin(*K.FIRST_BIGRAMS)),
    "last_bigram_common": lambda w, n: _flag(trailing(w, 2).isin(*K.LAST_BIGRAMS)),
    "has_double_letters": lambda w, n: has_double_letters(w),
    "num_double_letters": lambda w, n: num_double_letters(w),
    "has_repeated_vowels": lambda w, n: has_repeated_vowels(w),
    "is_alternating": lambda w, n: is_alternating(w),
    "syllable_count": lambda w, n: syllable_count(w),
    "syllable_ratio": lambda w, n: per_letter(syllable_count(w), n),
    "max_consonant_cluster": lambda w, n: max_consonant_cluster(w),
    "max_vowel_cluster": lambda w, n: max_vowel_cluster(w),
    "char_diversity": lambda w, n: char_diversity(w),
    "unique_vowels": lambda w, n: unique_vowels(w),
    "unique_consonants": lambda w, n: unique_consonants(w),
    "starts_with_vowel": lambda w, n: is_vowel(leading(w, 1)),
    "ends_with_vowel": lambda w, n: is_vowel(trailing(w, 1)),
    "middle_char": lambda w, n: middle_char(w),
    "middle_is_vowel": lambda w, n: is_vowel(middle_char(w)),
}


def with_features(
    df: DataFrame, source: str = "incorrect_word", length_basis: str = "correct"
) -> DataFrame:
    """Add the 27 derived columns.

    ``length_basis='correct'`` divides by the stored ``word_length`` (the
    correct word's), which lets a model read insertions and deletions off the
    length difference; ``'incorrect'`` divides by the misspelling's own length
    and stores that as ``word_length``.
    """
    word = F.col(source)
    if length_basis == "incorrect":
        df = df.withColumn("word_length", F.length(word))
    size = F.col("word_length")
    return df.select("*", *[make(word, size).alias(name) for name, make in DERIVED.items()])
