"""Profiles of the vocabulary and of labelled datasets.

Shares divide by a scalar subquery over the already grouped counts, so the
grouped exchange is shared between the rows and their total.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wordloom import constants as K


def with_share(counts: DataFrame, count: str = "n", share: str = "pct") -> DataFrame:
    total = counts.agg(F.sum(count).alias("t"))
    return counts.withColumn(share, F.col(count) * 100.0 / total.scalar())


def grouped_share(df: DataFrame, key: Column, name: str) -> DataFrame:
    return with_share(df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n")))


def weighted_percentile(values: DataFrame, value: str, shares: list[float]) -> list[Column]:
    """Exact interpolated percentiles over (value, n) counts instead of raw rows."""
    return [F.expr(f"percentile({value}, {p}, n)") for p in shares]


def basic(vocab: DataFrame, min_freq: int = 10) -> DataFrame:
    return vocab.agg(
        F.count(F.lit(1)).alias("unique_words"),
        F.sum("freq").alias("occurrences"),
        F.count_if(F.col("freq") >= min_freq).alias("frequent_words"),
    )


def length_stats(words: DataFrame) -> DataFrame:
    """Mean, median, min, max and sample deviation of word length, from the length histogram."""
    hist = words.groupBy(F.length("word").alias("len")).agg(F.count(F.lit(1)).alias("n"))
    (median,) = weighted_percentile(hist, "len", [0.5])
    n, total = F.sum("n"), F.sum(F.col("len") * F.col("n"))
    mean = hist.agg(F.sum(F.col("len") * F.col("n")) / F.sum("n"))
    away = F.col("len") - mean.scalar()
    return hist.agg(
        (total / n).alias("mean_length"),
        median.alias("median_length"),
        F.min("len").alias("min_length"),
        F.max("len").alias("max_length"),
        F.sqrt(F.sum(F.col("n") * away * away) / F.when(n > 1, n - 1)).alias("std_length"),
    )


def length_distribution(words: DataFrame, first: int = 15) -> DataFrame:
    return grouped_share(words, F.length("word"), "len").orderBy("len").limit(first)


def frequency_stats(vocab: DataFrame) -> DataFrame:
    """Mean, median, max and min frequency from the frequency histogram."""
    hist = (
        vocab.where(F.col("freq") > 0).groupBy("freq").agg(F.count(F.lit(1)).alias("n"))
    )
    (median,) = weighted_percentile(hist, "freq", [0.5])
    return hist.agg(
        (F.sum(F.col("freq") * F.col("n")) / F.sum("n")).alias("mean_freq"),
        median.alias("median_freq"),
        F.max("freq").alias("max_freq"),
        F.min("freq").alias("min_freq"),
    )


def frequency_bins(vocab: DataFrame) -> DataFrame:
    """(bin, label, n) for every bin, empty ones included; values on no bin are left out."""
    f = F.col("freq")
    inside = [
        (f > low) & ((f <= high) if high is not None else F.lit(True)) for low, high, _ in K.FREQ_BINS
    ]
    counts = vocab.agg(*[F.count_if(c).alias(f"b{i}") for i, c in enumerate(inside)])
    rows = F.array(*[
        F.struct(F.lit(i).alias("bin"), F.lit(label).alias("label"), F.col(f"b{i}").alias("n"))
        for i, (_, _, label) in enumerate(K.FREQ_BINS)
    ])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def first_letters(words: DataFrame) -> DataFrame:
    return grouped_share(words, F.substring("word", 1, 1), "letter")


def label_shares(df: DataFrame, label: str = "error_type") -> DataFrame:
    return grouped_share(df, F.col(label), label)


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """(column, type, distinct): distinct non-null values per column."""
    long = _long_strings(df)
    if approximate:
        counts = long.groupBy("column").agg(F.approx_count_distinct("value").alias("distinct"))
    else:
        # Two plain aggregations: deduplicate, then count. No expand of all columns per row.
        counts = (
            long.distinct().groupBy("column").agg(F.count("value").alias("distinct"))
        )
    types = F.create_map(*[F.lit(x) for name, kind in df.dtypes for x in (name, kind)])
    return counts.select("column", types[F.col("column")].alias("type"), "distinct")


def _long_strings(df: DataFrame) -> DataFrame:
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in df.columns
    ])
    return df.select(F.explode(pairs).alias("p")).select("p.*")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, stat, value) with count, mean, std, min, quartiles and max.

    Rows become (column, value, n) first, so percentiles hold distinct values
    with counts and not one entry per row.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ])
    hist = (
        df.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    q25, q50, q75 = weighted_percentile(hist, "value", [0.25, 0.5, 0.75])
    n, total = F.sum("n"), F.sum(F.col("value") * F.col("n"))
    # Deviations from the mean, not a difference of squares, which loses all digits when the mean is large.
    means = hist.groupBy("column").agg((total / n).alias("_mean"))
    away = F.col("value") - F.col("_mean")
    wide = hist.join(means, "column").groupBy("column").agg(
        n.cast("double").alias("count"),
        F.first("_mean").alias("mean"),
        F.sqrt(F.sum(F.col("n") * away * away) / F.when(n > 1, n - 1)).alias("std"),
        F.min("value").alias("min"),
        q25.alias("25%"), q50.alias("50%"), q75.alias("75%"),
        F.max("value").alias("max"),
    )
    stats = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
    return wide.unpivot(["column"], stats, "stat", "value")


def missing(df: DataFrame) -> DataFrame:
    """(column, nulls, pct) per column plus a ``TOTAL`` row."""
    rows = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls"), F.lit(1).alias("w")) for c in df.columns]
    everything = reduce(lambda a, b: a + b, [F.col(c) for c in df.columns])
    cells.append(
        F.struct(F.lit("TOTAL").alias("column"), everything.alias("nulls"), F.lit(len(df.columns)).alias("w"))
    )
    return rows.select("_rows", F.explode(F.array(*cells)).alias("c")).select(
        "c.column", "c.nulls",
        F.when(F.col("_rows") > 0, F.col("c.nulls") * 100.0 / (F.col("_rows") * F.col("c.w")))
        .otherwise(F.lit(0.0)).alias("pct"),
    )


def duplicates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row on ``columns``: group sizes minus one, summed."""
    groups = df.groupBy(*(columns or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    ).withColumn(
        "pct", F.when(F.col("total") > 0, F.col("duplicates") * 100.0 / F.col("total")).otherwise(F.lit(0.0))
    )


def split_shares(df: DataFrame) -> DataFrame:
    """(split, n, pct) with a ``total`` row from a rollup."""
    counts = (
        df.rollup("split").agg(F.count(F.lit(1)).alias("n"), F.grouping("split").alias("g"))
        .select(F.when(F.col("g") == 1, "total").otherwise(F.col("split")).alias("split"), "n")
    )
    total = df.agg(F.count(F.lit(1)).alias("t"))
    return counts.withColumn("pct", F.col("n") * 100.0 / total.scalar())


def shape(df: DataFrame, name: str) -> DataFrame:
    """One row: dataset name, rows, columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).alias("columns")
    )


def summary(datasets: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [shape(df, name) for name, df in datasets.items()])


def compare_labels(before: DataFrame, after: DataFrame, label: str = "error_type") -> DataFrame:
    """(label, before, after) over the union of labels, missing counted as 0."""
    left = before.groupBy(label).agg(F.count(F.lit(1)).alias("before"))
    right = after.groupBy(label).agg(F.count(F.lit(1)).alias("after"))
    zero = F.lit(0).cast("bigint")
    return (
        left.join(right, label, "full_outer")
        .select(
            F.col(label).alias("label"),
            F.coalesce("before", zero).alias("before"),
            F.coalesce("after", zero).alias("after"),
        )
        .orderBy("label")
    )


def label_union(a: DataFrame, b: DataFrame, label: str = "error_type") -> DataFrame:
    return a.select(label).union(b.select(label)).distinct()


def report(sections: dict[str, DataFrame]) -> DataFrame:
    """(section, ord, key, value): every section in one long, text-valued frame; ``ord`` numbers the sections.

    The first column of a section names its rows. Numbers with a fraction are written with four digits.
    """
    parts = []
    for ord, (name, df) in enumerate(sections.items(), 1):
        keyed, *rest = df.columns
        kinds = dict(df.dtypes)

        def written(c: str) -> Column:
            return F.format_string("%.4f", F.col(c)) if kinds[c] == "double" else F.col(c).cast("string")

        cells = [
            F.struct(F.concat_ws(".", F.col(keyed).cast("string"), F.lit(c)).alias("key"), written(c).alias("value")) for c in rest
        ] or [F.struct(F.lit(keyed).alias("key"), written(keyed).alias("value"))]
        long = df.select(F.explode(F.array(*cells)).alias("p"))
        parts.append(long.select(F.lit(name).alias("section"), F.lit(ord).alias("ord"), "p.key", "p.value"))
    return reduce(DataFrame.unionByName, parts)


def one_row_long(df: DataFrame) -> DataFrame:
    """(k, v) of a table of one row of numbers."""
    return df.select([F.col(c).cast("double").alias(c) for c in df.columns]).unpivot([], df.columns, "k", "v")
