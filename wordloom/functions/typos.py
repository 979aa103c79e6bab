"""Seeded misspelling generators: a word column -> an edit of the word, or null.

Generators read helper columns that ``with_draws`` adds: the row's draws and the
letter that a substitution would replace, with its neighbours. Each is computed
once per row, and each projection stays small enough to be compiled to machine
code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wordloom import constants as K
from wordloom.functions.draws import below, chance, draw
from wordloom.functions.strings import char_at

# Draw numbers; each decision has its own, or the choices would correlate.
TYPE, POSITION, BRANCH, CHOICE, SECOND_BRANCH, LETTER, CANDIDATE = range(7)

_MARK = "*"


HELPERS = [f"_u{i}" for i in range(LETTER + 1)] + ["_old", "_near", "_mixed"]


def u(index: int) -> Column:
    return F.col(f"_u{index}")


def with_draws(df: DataFrame, word: str, key: str, seed: int = K.SEED) -> DataFrame:
    draws = {f"_u{i}": draw(F.col(key), seed, i) for i in range(LETTER + 1)}
    return (
        df.withColumns(draws)
        .withColumn("_old", F.lower(char_at(F.col(word), _substituted(F.col(word)))))
        .withColumn("_near", F.try_element_at(_letters(K.KEYBOARD_NEIGHBOURS), F.col("_old")))
        .withColumn("_mixed", F.try_element_at(_letters(K.LETTER_CONFUSIONS), F.col("_old")))
    )


def _substituted(word: Column) -> Column:
    """1-based place of the letter to replace: any but the first."""
    return below(u(POSITION), F.greatest(F.length(word) - 1, F.lit(1))) + 2


def _letters(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def _edit(keep: Column, middle: Column, resume: Column) -> Column:
    """Keep the first ``keep`` letters, put ``middle``, go on at 1-based ``resume``."""
    return F.struct(keep.alias("keep"), middle.alias("middle"), resume.alias("resume"))


def insertion(word: Column) -> Column:
    n = F.length(word)
    pos = below(u(POSITION), n) + 1
    doubled = chance(u(BRANCH), K.P_DOUBLE_LETTER) & (pos < n)
    letter = char_at(F.lit(K.ALPHABET), below(u(LETTER), 26) + 1)
    added = F.when(doubled, char_at(word, pos + 1)).otherwise(letter)
    return F.when(n >= 3, _edit(pos, added, pos + 1))


def deletion(word: Column) -> Column:
    n = F.length(word)
    marked = F.translate(word, K.VOWELS, _MARK * len(K.VOWELS))
    vowels = n - F.length(F.translate(word, K.VOWELS, ""))
    on_vowel = (vowels > 0) & chance(u(BRANCH), K.P_DROP_VOWEL)
    # What stands before the k-th vowel tells where it is.
    before = F.call_function("substring_index", marked, F.lit(_MARK), below(u(CHOICE), vowels) + 1)
    inner = below(u(POSITION), n - 2) + 2
    pos = F.when(on_vowel, F.length(before) + 1).otherwise(inner)
    return F.when(n >= 4, _edit(pos - 1, F.lit(""), pos + 1))


def substitution(word: Column) -> Column:
    near, mixed = F.col("_near"), F.col("_mixed")
    others = F.replace(F.lit(K.ALPHABET), F.col("_old"), F.lit(""))
    new = (
        F.when(
            chance(u(BRANCH), K.P_KEYBOARD) & near.isNotNull(),
            char_at(near, below(u(CHOICE), F.length(near)) + 1),
        )
        .when(chance(u(SECOND_BRANCH), K.P_CONFUSION) & mixed.isNotNull(), mixed)
        .otherwise(char_at(others, below(u(LETTER), F.length(others)) + 1))
    )
    pos = _substituted(word)
    return F.when(F.length(word) >= 3, _edit(pos - 1, new, pos + 1))


def transposition(word: Column) -> Column:
    n = F.length(word)
    pos = below(u(POSITION), n - 1) + 1
    return F.when(n >= 3, _edit(pos - 1, F.reverse(F.substr(word, pos, F.lit(2))), pos + 2))


GENERATORS = {
    "insertion": insertion,
    "deletion": deletion,
    "substitution": substitution,
    "transposition": transposition,
}


def drawn_type() -> Column:
    return F.get(F.array(*[F.lit(t) for t in K.ERROR_TYPES]), below(u(TYPE), len(K.ERROR_TYPES)))


def edit_for(word: Column, error_type: Column) -> Column:
    """The edit of the generator that ``error_type`` names."""
    out = F.lit(None).cast("struct<keep:int,middle:string,resume:int>")
    for name, generate in GENERATORS.items():
        out = F.when(error_type == name, generate(word)).otherwise(out)
    return out


def apply_edit(word: Column, edit: Column) -> Column:
    return F.concat(
        F.substr(word, F.lit(1), edit["keep"]), edit["middle"],
        F.substr(word, edit["resume"], F.length(word)),
    )
