"""Plan shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def pinned(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters on it will not compute again.

    A filter on a projected column is pushed below the projection together
    with a copy of its expression. It is not pushed through a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def widen(df: DataFrame, *columns: str) -> DataFrame:
    """Spread a small table before a step that multiplies its rows or its work.

    The explicit number keeps adaptive execution from merging the partitions
    again because their input is small.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *columns)
