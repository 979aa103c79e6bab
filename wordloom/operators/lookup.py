"""Joins against word tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def known(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    return words.join(dictionary.select("word"), "word", "left_semi")


def unknown(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    return words.join(dictionary.select("word"), "word", "left_anti")


def with_frequency(words: DataFrame, vocab: DataFrame) -> DataFrame:
    """Add ``freq``, 0 for words the vocabulary lacks. Both sides have one row per word."""
    return words.join(vocab.select("word", "freq"), "word", "left").withColumn(
        "freq", F.coalesce("freq", F.lit(0).cast("bigint"))
    )


def left_lookup(rows: DataFrame, table: DataFrame, key: str, hot_share: float = 0.001) -> DataFrame:
    """Left join of many rows to a table with one row per key, safe against hot keys.

    Keys that hold at least ``hot_share`` of the rows number at most
    1 / hot_share, so their entries are broadcast. All other rows go through
    the shuffle join; rows already served travel under a spread-out key that
    matches nothing.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("t"))
    hot = counts.where(F.col("_n") >= total.scalar() * hot_share).select(key)
    value = F.struct(*[F.col(c) for c in table.columns if c != key])
    payload = table.select(F.col(key).alias("_k"), value.alias("_v"))
    hot_rows = hot.join(payload, F.col(key) == F.col("_k")).select(
        F.col("_k").alias("_hk"), F.col("_v").alias("_hv")
    )
    served = rows.join(F.broadcast(hot_rows), F.col(key) == F.col("_hk"), "left")
    others = [c for c in rows.columns]
    spread = F.concat(F.lit("\u0000"), (F.abs(F.xxhash64(*others)) % 4096).cast("string"))
    served = served.withColumn("_jk", F.when(F.col("_hk").isNull(), F.col(key)).otherwise(spread))
    joined = served.join(payload, F.col("_jk") == F.col("_k"), "left")
    out = F.coalesce("_hv", "_v")
    return joined.select(*others, out.alias("_o")).select(
        *others, *[F.col("_o")[c].alias(c) for c in table.columns if c != key]
    )
