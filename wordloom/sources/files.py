"""Readers and writers for the file formats of the flow: XML, text, JSON, CSV, Parquet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from wordloom import constants as K
from wordloom.functions.plan import pinned
from wordloom.operators import corpus, ranking
from wordloom.staging import fresh_path, stage

PAGE_SCHEMA = (
    "id BIGINT, title STRING, text STRUCT<_VALUE: STRING>, "
    "revision ARRAY<STRUCT<text: STRUCT<_VALUE: STRING>>>, _bad STRING"
)
PAGE_OPTIONS = {
    "rowTag": "page", "ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad",
    "ignoreSurroundingSpaces": "false",
}
# How a page came out of a dump.
INTACT, SALVAGED, LOST = "intact", "salvaged", "lost"
DATASET_SCHEMA = (
    "id BIGINT, correct_word STRING, incorrect_word STRING, error_type STRING, "
    "edit_distance INT, word_length INT, word_frequency BIGINT"
)


def _element(page: Column, name: str) -> Column:
    """Raw content of the first element of this name; null without one. It ends at its end tag, or else at the next tag."""
    start = rf"<(?:[\w.-]+:)?{name}(?:\s[^<>]*)?(?<!/)>"
    empty = rf"<(?:[\w.-]+:)?{name}(?:\s[^<>]*)?/>"
    found = F.regexp_extract(page, rf"{start}([^<]*)", 1)
    return F.when(page.rlike(start), found).when(page.rlike(empty), F.lit(""))


def _unescaped(content: Column) -> Column:
    """Entities of markup replaced by what they stand for, ``&amp;`` last; others stay."""
    for entity, mark in K.XML_ENTITIES.items():
        content = F.replace(content, F.lit(f"&{entity};"), F.lit(mark))
    return content


def page_records(spark: SparkSession, path: str, tag: str = "page") -> DataFrame:
    """(page, closed): one row per page start in the files, with what stands between it and its end or the next start.

    Files are cut at end tags by the text source, so a large file is read by as many tasks as it has blocks. A page without
    its end tag shares a record with the pages behind it up to the next end tag; it is cut off at their start tags.
    """
    records = spark.read.option("lineSep", f"</{tag}>").text(path)
    # What stands before the first start tag belongs to no page; the blank makes sure that something does.
    parts = F.split(F.concat(F.lit(" "), "value"), rf"(?=<{tag}[\s>])")
    pages = records.select(F.posexplode(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))).alias("i", "page"), F.size(parts).alias("n"))
    return pages.select("page", (F.col("i") == F.col("n") - 2).alias("closed"))


def read_wiki_pages(spark: SparkSession, path: str, tag: str = "page") -> DataFrame:
    """(doc_id, title, text, state) of all pages that start in the files, any namespace; ``tag`` is written as in the files.

    Every page is parsed on its own, so a damaged one costs no other. ``state`` is ``intact``; ``salvaged`` if the page is no
    well-formed XML but its title and text were found by their tags; or ``lost`` if there is no title. The text may sit in the page or in its first
    revision; an unclosed title or text ends at the next tag.
    """
    # A record that ends with its file lacks the end tag as well; the parser tells it from a closed one.
    records = page_records(spark, path, tag)
    closed = F.when(F.col("closed"), F.concat("page", F.lit(f"</{tag}>"))).otherwise(F.col("page"))
    parsed = pinned(records, "p", F.from_xml(closed, PAGE_SCHEMA, PAGE_OPTIONS | {"rowTag": tag}))
    good = F.col("p").isNotNull() & F.col("p._bad").isNull()
    body = F.coalesce(F.get(F.col("p.revision.text._VALUE"), 0), F.col("p.text._VALUE"))
    found = {name: _unescaped(_element(F.col("page"), name)) for name in ("id", "title", "text")}
    state = F.when(good, INTACT).when(found["title"].isNotNull(), SALVAGED).otherwise(LOST)
    return parsed.select(
        F.when(good, F.col("p.id")).otherwise(F.try_to_number(found["id"], F.lit("9999999999999999999")).cast("bigint")).alias("doc_id"),
        F.when(good, F.col("p.title")).otherwise(found["title"]).alias("title"),
        F.when(good, body).otherwise(found["text"]).alias("text"),
        state.alias("state"),
    )


def read_wiki_xml(spark: SparkSession, path: str, tag: str = "page", damage: Observation | None = None) -> DataFrame:
    """(doc_id, title, text) of the pages of ``read_wiki_pages`` less the lost ones.

    ``damage`` gets the numbers of pages, salvaged ones and lost ones once the result has been computed.
    """
    pages = read_wiki_pages(spark, path, tag)
    if damage is not None:
        counts = [F.count_if(F.col("state") == s).alias(s) for s in (SALVAGED, LOST)]
        pages = pages.observe(damage, F.count(F.lit(1)).alias("pages"), *counts)
    return pages.where(F.col("state") != LOST).select("doc_id", "title", "text")


def write_wiki_xml(pages: DataFrame, path: str) -> None:
    shaped = pages.select(
        F.col("doc_id").alias("id"), "title", F.struct(F.struct(F.col("text").alias("_VALUE"), F.lit("preserve").alias("_space")).alias("text")).alias("revision")
    )
    shaped.write.format("xml").option("rowTag", "page").option("rootTag", "mediawiki").save(path)


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """(word), one per line."""
    return spark.read.text(path).select(F.col("value").alias("word"))


def read_freq_map(spark: SparkSession, path: str) -> DataFrame:
    """(word, freq) from JSON objects of word -> count.

    Pretty-printed objects hold one pair per line, so lines are parsed where
    they stand and the file is never gathered into one value. A one-line
    object is taken apart by the same rule.
    """
    pair = r'"((?:[^"\\]|\\.)*)"\s*:\s*(-?\d+)'
    lines = spark.read.text(path)
    found = F.explode(F.regexp_extract_all("value", F.lit(pair), F.lit(0))).alias("p")
    pairs = lines.select(found)
    key = F.from_json(F.concat(F.lit('{"k":"'), F.regexp_extract("p", pair, 1), F.lit('"}')), "k STRING")["k"]
    return pairs.select(key.alias("word"), F.regexp_extract("p", pair, 2).cast("bigint").alias("freq"))


def write_freq_map(vocab: DataFrame, path: str) -> None:
    """One small JSON object per line, each word -> count; the union is the map."""
    vocab.select(F.to_json(F.create_map("word", "freq")).alias("value")).write.text(path)


def read_dataset_csv(spark: SparkSession, path: str, na_words: tuple[str, ...] = ()) -> DataFrame:
    """Misspelling samples from headered CSV. ``null`` and ``nan`` stay words unless named."""
    from wordloom.operators.prepare import drop_nulls

    df = spark.read.schema(DATASET_SCHEMA).option("header", True).option("nullValue", "").csv(path)
    return drop_nulls(df, na_words) if na_words else df


def read_dataset_csv_checked(spark: SparkSession, path: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(samples, rejected lines) of CSV; every line is in one of the two.

    Rejected are (line, reason): ``columns`` if it has too few or too many of them, ``number`` if a number cannot be read, ``missing`` if
    a column is empty. The lines are parsed once and written, so that both tables and their counts come from the same pass.
    """
    columns = [c.split()[0] for c in DATASET_SCHEMA.split(", ")]
    reader = spark.read.schema(f"{DATASET_SCHEMA}, _line STRING").option("header", header).option("nullValue", "")
    parsed = stage(reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").csv(path), "dataset-lines")
    # A line that is whole but has an empty column is put together again.
    line = F.coalesce("_line", F.array_join(F.array(*[F.col(c).cast("string") for c in columns]), ",", ""))
    texts = F.from_csv("_line", ", ".join(f"{c} STRING" for c in columns) + ", _more STRING", {"mode": "PERMISSIVE"})
    # The parser fills what a short line lacks with nulls, so the last column is null as if it were empty.
    wrong_width = texts["_more"].isNotNull() | (F.size(F.split("_line", ",")) < len(columns))
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    reason = F.when(F.col("_line").isNotNull(), F.when(wrong_width, "columns").otherwise("number")).when(missing, "missing")
    marked = parsed.select("*", reason.alias("_reason"), line.alias("_text"))
    good = marked.where("_reason IS NULL").select(*columns)
    return good, marked.where("_reason IS NOT NULL").select(F.col("_text").alias("line"), F.col("_reason").alias("reason"))


def rejected_counts(rejected: DataFrame) -> DataFrame:
    """(reason, lines) of rejected lines."""
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


def write_dataset_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def dataset_sample(df: DataFrame, n: int = 100) -> DataFrame:
    """First rows by id: the sample file that goes with a dataset."""
    return df.orderBy("id").limit(n)


def write_thresholds(vocab: DataFrame, path: str) -> None:
    """One Parquet dataset, one partition folder per minimum frequency."""
    corpus.by_threshold(vocab).write.partitionBy("min_freq").parquet(path)


def write_dictionary(vocab: DataFrame, path: str, n: int = K.DICTIONARY_SIZE) -> None:
    """Top words as text, one per line: files in name order, lines in rank order."""
    ranked = ranking.rank_words(vocab, n).select("rank", "word")
    ranked.repartitionByRange("rank").sortWithinPartitions("rank").select("word").write.text(path)


def write_splits(df: DataFrame, path: str) -> None:
    """Full rows, one partition folder per split, and the ordered list of training features beside them."""
    df.write.partitionBy("split").parquet(f"{path}/rows")
    write_feature_list(df.sparkSession, f"{path}/feature_list")


def read_splits(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(f"{path}/rows").select(*like.columns)


def write_feature_list(spark: SparkSession, path: str) -> None:
    row = spark.range(1).select(F.array(*[F.lit(f) for f in K.FEATURES]).alias("features"))
    row.write.json(path)


def write_encoders(encoders: DataFrame, path: str) -> None:
    encoders.write.json(path)


def read_encoders(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("column STRING, label STRING, code INT").json(path)


def round_trip(df: DataFrame, name: str, write, read) -> DataFrame:
    """Write to a fresh folder of the workspace and read it back."""
    path = fresh_path(df.sparkSession, name)
    write(df, path)
    return read(df.sparkSession, path)
