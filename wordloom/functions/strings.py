"""String similarity and blocking keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_TAKEN = "\u0000"


def char_at(word: Column, position: Column) -> Column:
    """Character at a 1-based position."""
    return F.substr(word, position, F.lit(1))


def _common_prefix(a: Column, b: Column) -> Column:
    """Length of the common prefix, at most 4."""
    out = F.lit(0)
    for k in (1, 2, 3, 4):
        head = F.substr(a, F.lit(1), F.lit(k))
        same = (head == F.substr(b, F.lit(1), F.lit(k))) & (F.length(head) == k)
        out = F.when(same, F.lit(k)).otherwise(out)
    return out


def _jaro(a: Column, b: Column, prefix: Column) -> Column:
    """Jaro similarity of two non-empty words.

    The fold walks the first word from the end of the common prefix, whose
    letters always match each other. Its state is the second word with used
    letters blanked out, the matched letters so far, the last matched place,
    and whether places only grew. If they did, no letters are transposed and
    the second word's matches need not be listed.
    """
    n, m = F.length(a), F.length(b)
    reach = F.greatest(F.floor(F.greatest(n, m) / 2).cast("int") - 1, F.lit(0))
    start = F.struct(
        F.concat(F.repeat(F.lit(_TAKEN), prefix), F.substr(b, prefix + 1, m)).alias("left"),
        F.substr(a, F.lit(1), prefix).alias("hits"),
        prefix.alias("last"),
        F.lit(True).alias("ordered"),
    )

    def step(state: Column, i: Column) -> Column:
        visible = F.substr(state["left"], F.lit(1), i + reach)
        at = F.call_function("locate", char_at(a, i), visible, F.greatest(i - reach, F.lit(1)))
        return bind(
            at,
            lambda p: F.when(
                p > 0,
                F.struct(
                    F.overlay(state["left"], F.lit(_TAKEN), p, F.lit(1)).alias("left"),
                    F.concat(state["hits"], char_at(a, i)).alias("hits"),
                    p.alias("last"),
                    (state["ordered"] & (p > state["last"])).alias("ordered"),
                ),
            ).otherwise(state),
        )

    def swapped(state: Column) -> Column:
        used = F.filter(F.sequence(F.lit(1), m), lambda j: char_at(state["left"], j) == _TAKEN)
        return bind(
            F.array_join(F.transform(used, lambda j: char_at(b, j)), ""),
            lambda other: F.size(
                F.filter(
                    F.sequence(F.lit(1), F.length(other)),
                    lambda k: char_at(state["hits"], k) != char_at(other, k),
                )
            ),
        )

    def finish(state: Column) -> Column:
        common = F.length(state["hits"]).cast("double")
        half = F.when(state["ordered"], F.lit(0)).otherwise(F.floor(swapped(state) / 2)).cast("double")
        jaro = (common / n + common / m + (common - half) / common) / 3.0
        return F.when(common > 0, jaro).otherwise(F.lit(0.0))

    walk = F.when(n > prefix, F.sequence(prefix + 1, n)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(walk, start, step, finish)


def jaro_winkler(a: Column, b: Column) -> Column:
    """Jaro similarity with the common-prefix boost above 0.7."""
    prefix = _common_prefix(a, b)

    def boosted(j: Column) -> Column:
        return F.when(j > 0.7, j + prefix * 0.1 * (1.0 - j)).otherwise(j)

    empty_a, empty_b = F.length(a) == 0, F.length(b) == 0
    return (
        F.when(empty_a & empty_b, F.lit(1.0))
        .when(empty_a | empty_b, F.lit(0.0))
        .otherwise(bind(bind(prefix, lambda p: _jaro(a, b, p)), boosted))
    )


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def without_two(word: Column, i: Column, j: Column) -> Column:
    """The word without positions i and j (1-based, i <= j); i = 0 deletes nothing."""
    return F.when(i == 0, word).otherwise(
        F.concat(
            F.substr(word, F.lit(1), i - 1),
            F.substr(word, i + 1, j - i - 1),
            F.substr(word, j + 1, F.length(word)),
        )
    )
