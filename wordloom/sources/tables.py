"""Parquet inputs with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMAS = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread rows when the scan has fewer splits than there are cores.

    A scan with enough splits is returned unchanged, so large inputs never pay
    this shuffle; a small single-row-group file no longer pins the regex work
    to one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, title, text) of the corpus."""
    docs = table(spark, folder, "documents")
    titled = docs.select(
        "doc_id", F.concat_ws(" ", "source", F.col("doc_id").cast("string")).alias("title"), "text"
    )
    return spread(titled, "doc_id")


# Fixture rule: which source stands for which kind of page.
_NAMESPACE_OF_SOURCE = {
    "src0": "File:", "src1": "Category:", "src2": "Template:",
    "src3": "Wikipedia:", "src4": "Help:", "src5": "MediaWiki:",
}


def wiki_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus dressed as wiki pages: markup, namespaces, redirects, missing parts."""
    source, lang, text = F.col("source"), F.col("lang"), F.col("text")
    number = F.col("doc_id").cast("string")
    title = F.concat(source, F.lit(" "), number)
    for name, prefix in _NAMESPACE_OF_SOURCE.items():
        title = F.when(source == name, F.concat(F.lit(prefix), number)).otherwise(title)
    title = F.when(source == "src6", F.lit("")).otherwise(title)
    body = F.concat(
        F.lit("{{box|x\ny}} == Head == [[a]] and [[src|"), lang, F.lit("]] <b>"), text,
        F.lit("</b> http://x.y/"), number,
    )
    body = (
        F.when(source == "src7", F.concat(F.lit("#REDIRECT [["), lang, F.lit("]]")))
        .when(source == "src8", F.lit(None).cast("string"))
        .otherwise(body)
    )
    docs = table(spark, folder, "documents")
    return spread(docs.select("doc_id", title.alias("title"), body.alias("text")), "doc_id")
