"""Quality filters, encoding, scaling and leak-free splitting."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from wordloom import constants as K
from wordloom.operators.ranking import dense_index, hash_share
from wordloom.staging import stage

ENCODED = ("error_type",) + K.CATEGORICAL


def drop_nulls(df: DataFrame, na_words: tuple[str, ...] = ()) -> DataFrame:
    """Drop rows with any null. ``na_words`` lists texts to treat as missing, such as
    ``("null", "nan")``; by default they are ordinary words."""
    for name, kind in df.dtypes:
        if na_words and kind == "string":
            df = df.withColumn(name, F.when(~F.col(name).isin(*na_words), F.col(name)))
    return df.dropna("any")


def drop_duplicates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.dropDuplicates(columns) if columns else df.dropDuplicates()


def encoder_table(df: DataFrame, columns: tuple[str, ...] = ENCODED) -> DataFrame:
    """(column, label, code): codes 0..k-1 in label order, per column.

    Values are deduplicated before ranking, so a window holds distinct labels
    and not rows; at most three letters each for the word columns.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("label")) for c in columns
    ])
    labels = (
        df.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("label").isNotNull()).distinct()
    )
    order = W.partitionBy("column").orderBy("label")
    return labels.withColumn("code", F.row_number().over(order) - 1)


def encode(df: DataFrame, encoders: DataFrame, columns: tuple[str, ...] = ENCODED) -> DataFrame:
    """Add ``<column>_encoded``; a label the encoders lack gets -1.

    ``encoders`` should be staged: its file size decides whether the lookups
    are broadcast.
    """
    for c in columns:
        codes = encoders.where(F.col("column") == c).select(
            F.col("label").alias(c), F.col("code").alias(f"{c}_encoded")
        )
        df = df.join(codes, c, "left").withColumn(
            f"{c}_encoded", F.coalesce(f"{c}_encoded", F.lit(-1))
        )
    return df


def decode_labels(encoders: DataFrame) -> DataFrame:
    """(code, label) of the class column."""
    return encoders.where(F.col("column") == "error_type").select("code", "label").orderBy("code")


def scaler_table(df: DataFrame, columns: tuple[str, ...] = K.FEATURES) -> DataFrame:
    """(feature, mean, std) with population deviation; one pass over the rows."""
    stats = df.agg(
        *[
            F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c)
            for c in columns
        ]
    )
    rows = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c)["mean"].alias("mean"), F.col(c)["std"].alias("std"))
        for c in columns
    ])
    return stats.select(F.explode(rows).alias("r")).select("r.*")


def scale(df: DataFrame, scaler: DataFrame, columns: tuple[str, ...] = K.FEATURES) -> DataFrame:
    """z-scores; a constant column is divided by 1. The scaler is one struct in one subquery."""
    def pick(c: str, value: str):
        return F.max(F.when(F.col("feature") == c, F.col(value)))

    stats = scaler.agg(
        F.struct(*[
            F.struct(
                pick(c, "mean").alias("mean"),
                F.when(pick(c, "std") == 0, F.lit(1.0)).otherwise(pick(c, "std")).alias("std"),
            ).alias(c)
            for c in columns
        ]).alias("s")
    )
    held = df.withColumn("_s", stats.scalar())
    z = {c: (F.col(c).cast("double") - F.col("_s")[c]["mean"]) / F.col("_s")[c]["std"] for c in columns}
    return held.withColumns(z).drop("_s")


def group_order(group: str, seed: int = K.SEED):
    return F.md5(F.concat_ws(":", F.lit("split"), F.lit(str(seed)), F.col(group)))


def split_by_group(
    df: DataFrame, group: str = "correct_word", seed: int = K.SEED, mode: str = "exact"
) -> DataFrame:
    """Add ``split``; all rows of a group share it. Shares are shares of groups.

    ``exact``: of G groups in hash order, the first ceil(0.25 G) are held out,
    and ceil(0.6 of those) are the test set. ``approx``: hash thresholds, no
    sort and no join.
    """
    share, test = K.HELD_OUT_SHARE, K.TEST_SHARE_OF_HELD_OUT
    if mode == "approx":
        u = F.conv(F.substring(group_order(group, seed), 1, 8), 16, 10).cast("bigint") / float(1 << 32)
        return df.withColumn(
            "split", F.when(u < share * test, "test").when(u < share, "val").otherwise("train")
        )
    if mode != "exact":
        raise ValueError(f"unknown mode {mode!r}")
    groups = df.select(group).distinct().withColumn("_h", group_order(group, seed))
    ranked = stage(dense_index(groups, [F.col("_h"), F.col(group)], "_r", hash_share(F.col("_h"))), "groups")
    total = ranked.agg(F.count(F.lit(1)).alias("g"))
    held = F.ceil(total.scalar() * share)
    place = ranked.withColumn("_held", held).withColumn("_test", F.ceil(F.col("_held") * test))
    split = (
        F.when(F.col("_r") <= F.col("_test"), "test").when(F.col("_r") <= F.col("_held"), "val")
        .otherwise("train")
    )
    return df.join(place.select(group, split.alias("split")), group)


def leak_check(df: DataFrame, group: str = "correct_word") -> DataFrame:
    """(split, groups, leaking): groups of each split, and those among them that are also in another one."""
    pairs = df.select(group, "split").distinct()
    spread = pairs.groupBy(group).agg(F.collect_list("split").alias("splits"))
    return spread.select(F.explode("splits").alias("split"), (F.size("splits") > 1).alias("_leaks")).groupBy("split").agg(
        F.count(F.lit(1)).alias("groups"), F.count_if("_leaks").alias("leaking")
    )


def split_rows(df: DataFrame, splits: DataFrame) -> DataFrame:
    """Full rows of each split, joined back by id."""
    return df.join(splits.select("id", "split"), "id")


def training_columns(df: DataFrame) -> DataFrame:
    """id, label and the ordered training features that are present."""
    present = [f for f in K.FEATURES if f in df.columns]
    keep = [c for c in ("id", "split", "error_type_encoded") if c in df.columns]
    return df.select(*keep, *present)
