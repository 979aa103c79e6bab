"""Order by, top-k and row numbers without funnelling rows through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wordloom import constants as K
from wordloom.staging import stage


# Most shares that a table is cut into for numbering; one offset row per share.
MOST_SHARES = 65_536


def hash_share(digest: Column) -> Column:
    """The first four hex digits of a digest: even shares in digest order."""
    return F.substring(digest, 1, 4)


def dense_index(df: DataFrame, order: list[Column], name: str, share: Column | None = None) -> DataFrame:
    """Row numbers 1..N in the given total order.

    Rows fall into shares that follow the order; numbers start at each share's
    offset. ``share`` names an expression that grows with the order and cuts
    the rows evenly, with at most ``MOST_SHARES`` values. Without one, rows are
    range-partitioned by sampled bounds and written once, so that the partition
    number of a row stays fixed. The only unpartitioned window runs over one
    row per share.
    """
    if share is None:
        cut = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    else:
        cut = df.withColumn("_part", share)
    cut = stage(cut, "shares")
    sizes = cut.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    within = W.partitionBy("_part").orderBy(*order)
    return (
        cut.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.row_number().over(within) + F.col("_offset"))
        .drop("_part", "_offset")
    )


def cut_frequency(vocab: DataFrame, n: int) -> DataFrame:
    """One row: the frequency that the n-th most frequent word has (0 if there are fewer).

    Works on the histogram of frequencies. k distinct frequencies need at least
    k(k+1)/2 occurrences, so the histogram has at most sqrt(2 * occurrences) rows.
    """
    histogram = vocab.groupBy("freq").agg(F.count(F.lit(1)).alias("words"))
    reached = histogram.select(
        "freq", F.sum("words").over(W.orderBy(F.desc("freq"))).alias("reached")
    )
    return reached.where(F.col("reached") >= n).agg(F.coalesce(F.max("freq"), F.lit(0)).alias("f"))


def rank_words(vocab: DataFrame, n: int = K.DICTIONARY_SIZE) -> DataFrame:
    """(word, freq, rank) of the n most frequent words, ties by word.

    ``vocab`` should be a staged table: it is read for the cut and for the rows.
    """
    head = vocab.where(F.col("freq") >= cut_frequency(vocab, n).scalar())
    ranked = dense_index(head.select("word", "freq"), [F.desc("freq"), F.asc("word")], "rank")
    return ranked.where(F.col("rank") <= n)


def most_frequent(vocab: DataFrame, n: int = K.DICTIONARY_SIZE) -> DataFrame:
    """The n most frequent words, unordered; only ties at the cut are sorted.

    ``vocab`` is staged, so its row count comes from the file footers.
    """
    if vocab.count() <= n:
        return vocab
    cut = stage(cut_frequency(vocab, n), "cut")
    above = vocab.where(F.col("freq") > cut.scalar())
    ties = dense_index(vocab.where(F.col("freq") == cut.scalar()), [F.asc("word")], "_place")
    room = n - F.coalesce(above.agg(F.count(F.lit(1)).alias("n")).scalar(), F.lit(0))
    return above.unionByName(ties.where(F.col("_place") <= room).select(*vocab.columns))


def top_dictionary(vocab: DataFrame, n: int = K.DICTIONARY_SIZE) -> DataFrame:
    return rank_words(vocab, n)


def usable_length(
    vocab: DataFrame, low: int = K.MIN_WORD_LENGTH, high: int = K.MAX_WORD_LENGTH
) -> DataFrame:
    return vocab.where(F.length("word").between(low, high))


def top_candidates(vocab: DataFrame, n: int = K.CANDIDATE_WORDS) -> DataFrame:
    """(idx, word, freq): frequent words of usable length, dense index from 0."""
    return rank_words(usable_length(vocab), n).select(
        (F.col("rank") - 1).alias("idx"), "word", "freq"
    )


def top_words(vocab: DataFrame, n: int = 20) -> DataFrame:
    return vocab.orderBy(F.desc("freq"), "word").limit(n)


def bottom_words(vocab: DataFrame, n: int = 20) -> DataFrame:
    return vocab.where(F.col("freq") > 0).orderBy("freq", "word").limit(n)
