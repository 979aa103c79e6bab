"""All (query, dictionary word) pairs within two edits, without comparing all pairs.

Two words within two edits share a key once up to two letters are deleted from
each. Keys are joined by equality, candidates are verified with a bounded edit
distance in the join itself, and survivors are deduplicated. Long words would
have quadratically many keys; they are cut into three segments instead, one of
which must occur unchanged in a word within two edits (pigeonhole), shifted by
at most two places. The dictionary word's length decides which scheme a pair
uses, so every pair is found by exactly one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wordloom import constants as K
from wordloom.functions.plan import widen
from wordloom.functions.strings import char_at, without_two
from wordloom.staging import stage

LONGEST_BY_DELETION = 16
# Largest key table to broadcast, in rows of one word, one count and one hash.
BROADCAST_KEYS = 1_000_000
# Pairs of one key that one task compares; keys with more are dealt out. At most so many keys are: those with most pairs.
KEY_PAIRS = 1_000_000
DEALT_KEYS = 10_000
_EDITS = 2


def _deletion_keys(df: DataFrame, word: str) -> DataFrame:
    """One row per way to delete at most two letters.

    Deleting any letter of a run gives the same key, so only the last letters
    of a run are deleted; no shuffle is needed to drop the repeats.
    """
    w, i, j = F.col(word), F.col("_i"), F.col("_j")
    i_ends_run = char_at(w, i) != char_at(w, i + 1)
    j_ends_run = char_at(w, j) != char_at(w, j + 1)
    first = df.withColumn("_i", F.explode(F.sequence(F.lit(0), F.length(w))))
    both = first.withColumn(
        "_j",
        F.explode(
            F.when(F.col("_i") == 0, F.array(F.lit(0))).otherwise(F.sequence(F.col("_i"), F.length(w)))
        ),
    )
    needed = (i == 0) | (j_ends_run & ((j - i <= 1) | i_ends_run))
    return both.where(needed).withColumn("_key", F.xxhash64(without_two(w, i, j))).drop("_i", "_j")


def _segment_bounds(length: Column, index: Column) -> tuple[Column, Column]:
    """Start (0-based) and size of the index-th of three segments."""
    third = F.floor(length / 3).cast("int")
    size = F.when(index < 2, third).otherwise(length - third * 2)
    return third * index, size


def _segment_keys(df: DataFrame, word: str) -> DataFrame:
    w = F.col(word)
    cut = df.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(2))))
    start, size = _segment_bounds(F.length(w), F.col("_s"))
    key = F.xxhash64(F.length(w), F.col("_s"), F.substr(w, start + 1, size))
    return cut.withColumn("_key", key).drop("_s")


def _segment_probes(df: DataFrame, word: str, longest: int) -> DataFrame:
    w, n = F.col(word), F.length(F.col(word))
    lengths = F.sequence(F.greatest(F.lit(longest + 1), n - _EDITS), n + _EDITS)
    probes = (
        df.withColumn("_l", F.explode(lengths))
        .withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(2))))
        .withColumn("_d", F.explode(F.sequence(F.lit(-_EDITS), F.lit(_EDITS))))
    )
    start, size = _segment_bounds(F.col("_l"), F.col("_s"))
    at = start + F.col("_d")
    key = F.xxhash64(F.col("_l"), F.col("_s"), F.substr(w, at + 1, size))
    return probes.where((at >= 0) & (at + size <= n)).withColumn("_key", key).drop("_l", "_s", "_d")


def dictionary_keys(dictionary: DataFrame, longest: int = LONGEST_BY_DELETION) -> DataFrame:
    """(word, freq, _key): the index side. Stage it, once for all query batches."""
    d = widen(dictionary.select("word", "freq"), "word")
    short = _deletion_keys(d.where(F.length("word") <= longest), "word")
    return short.unionByName(_segment_keys(d.where(F.length("word") > longest), "word"))


def query_keys(queries: DataFrame, longest: int = LONGEST_BY_DELETION) -> DataFrame:
    q = widen(queries.select("query"), "query")
    n = F.length("query")
    short = _deletion_keys(q.where(n <= longest + _EDITS), "query")
    return short.unionByName(_segment_probes(q.where(n > longest - _EDITS), "query", longest))


def _dealt(queries: DataFrame, index: DataFrame) -> list[DataFrame]:
    """Both key tables with ``_slice``, so that no task compares many more than ``KEY_PAIRS`` pairs of one key.

    Very short words share few keys. The pairs of a key are known before the join: queries times dictionary words with it. The larger
    side of a heavy key is cut into slices by hash and the smaller one is repeated for each slice, so every pair meets once. All
    other keys have one slice.
    """
    counts = [side.groupBy("_key").agg(F.count(F.lit(1)).alias(n)) for side, n in ((queries, "_queries"), (index, "_words"))]
    pairs = F.col("_queries") * F.col("_words")
    heavy = counts[0].join(counts[1], "_key").where(pairs > KEY_PAIRS).orderBy(pairs.desc(), "_key").limit(DEALT_KEYS)
    cut_words = F.col("_words") >= F.col("_queries")
    slices = F.least(F.ceil(pairs / KEY_PAIRS).cast("int"), F.greatest("_queries", "_words").cast("int"))
    heavy = stage(heavy.select("_key", slices.alias("_slices"), cut_words.alias("_cut_words")), "heavy-keys")
    if heavy.isEmpty():
        return [side.withColumn("_slice", F.lit(0)) for side in (queries, index)]

    def sliced(side: DataFrame, word: str, is_cut: Column) -> DataFrame:
        marked = side.join(F.broadcast(heavy), "_key", "left")
        own = F.array(F.pmod(F.xxhash64(word), F.col("_slices")).cast("int"))
        every = F.sequence(F.lit(0), F.col("_slices") - 1)
        which = F.when(F.col("_slices").isNull(), F.array(F.lit(0))).when(is_cut, own).otherwise(every)
        return marked.withColumn("_slice", F.explode(which)).drop("_slices", "_cut_words")

    return [sliced(queries, "query", ~F.col("_cut_words")), sliced(index, "word", F.col("_cut_words"))]


def _candidates(queries: DataFrame, index: DataFrame) -> DataFrame:
    """The two key tables joined by the strategy that the real size of the index allows.

    The planner does not know that a table grows when keys are made from it,
    and would broadcast it by the size it had before. A staged table is counted
    from its footers. Beyond the bound both sides are shuffled, heavy keys in slices, and the index
    side, a bounded number of keys per dictionary word, is the hashed one.
    """
    if index.count() <= BROADCAST_KEYS:
        return queries.join(F.broadcast(index), "_key")
    queries, index = _dealt(stage(queries, "query-keys"), index)
    return queries.join(index.hint("shuffle_hash"), ["_key", "_slice"]).drop("_slice")


def fuzzy_join(
    queries: DataFrame,
    dictionary: DataFrame,
    max_distance: int = K.MAX_DISTANCE,
    keys: DataFrame | None = None,
    longest: int = LONGEST_BY_DELETION,
) -> DataFrame:
    """(query, word, freq, distance) for all pairs within ``max_distance`` edits.

    ``queries(query)`` holds distinct strings; ``keys`` is a staged
    ``dictionary_keys`` table. Output is hash-partitioned by query, so grouping
    or ranking per query needs no further shuffle.
    """
    if not 0 <= max_distance <= _EDITS:
        raise ValueError(f"max_distance must lie in 0..{_EDITS}")
    if keys is None:
        keys = stage(dictionary_keys(dictionary, longest), "dictionary-keys")
    distance = F.levenshtein("query", "word", max_distance)
    close = (
        _candidates(query_keys(queries, longest), keys)
        .where(F.abs(F.length("query") - F.length("word")) <= max_distance)
        .where(distance >= 0)
        .select("query", "word", "freq")
    )
    return (
        close.repartition("query")
        .dropDuplicates(["query", "word"])
        .withColumn("distance", F.levenshtein("query", "word"))
    )
