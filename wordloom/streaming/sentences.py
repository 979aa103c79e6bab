"""Arriving sentences corrected against a static dictionary, with a memory of the words solved so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom.operators.correct import best_fixes, check_sentences, unknown_words
from wordloom.operators.fuzzy import dictionary_keys
from wordloom.sources.tables import SCHEMAS
from wordloom.staging import fresh_path, scratch, stage
from wordloom.streaming.words import drain, numbered, read_batches

_ERROR = "original: STRING, correction: STRING, distance: INT, position: INT, token_index: INT"
CHECKED = (
    "status STRING, original_sentence STRING, corrected_sentence STRING, has_errors BOOLEAN, "
    "num_errors INT, errors ARRAY<STRUCT<{error}>>"
)
_TYPES = {"error_type": "STRING", "confidence": "DOUBLE"}
# A word without a candidate is solved too: its best is null.
SOLVED = "lower STRING, best STRING, distance INT"


def sentence_stream(spark: SparkSession, folder: str, table: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(SCHEMAS[table]).option("pathGlobFilter", f"{table}*.parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def solved_words(spark: SparkSession, path: str, before: int | None = None, typed: bool = False) -> DataFrame:
    """(lower, best, distance, batch_id) of the words that a stream has searched, in batches before ``before``.

    ``typed`` memories also have ``error_type`` and ``confidence``. Every word is in one batch only.
    """
    schema = SOLVED + "".join(f", {c} {kind}" for c, kind in _TYPES.items() if typed) + ", batch_id INT"
    done = [b for b in numbered(spark, f"{path}/solved") if before is None or b < before]
    folders = [f"{path}/solved/batch_id={b}" for b in done]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/solved").parquet(*folders)


def run_corrections(
    sentences: DataFrame, ids: list[str], dictionary: DataFrame, typer=None, path: str | None = None
) -> DataFrame:
    """Drain a stream of (ids, sentence) and return all sentences checked under ``path`` so far.

    A word is searched in the dictionary, and typed if there is a ``typer``, in the first batch that holds it; later batches look it
    up. The dictionary's keys are written once. Tables that a batch stages are deleted at its end.
    """
    spark = sentences.sparkSession
    path = path or fresh_path(spark, "sentence-stream")
    keys = stage(dictionary_keys(dictionary), "dictionary-keys")
    typed = typer is not None

    def handle(batch: DataFrame, batch_id: int) -> None:
        with scratch(spark):
            known = solved_words(spark, path, batch_id, typed).drop("batch_id")
            words = stage(unknown_words(batch, dictionary), "unknown-words")
            fresh = words.join(known.select("lower"), "lower", "left_anti")
            found = best_fixes(fresh, dictionary, keys, typer)
            solved = fresh.join(found, "lower", "left").select(*known.columns)
            solved.write.mode("overwrite").parquet(f"{path}/solved/batch_id={batch_id}")
            memory = solved_words(spark, path, batch_id + 1, typed).drop("batch_id")
            fixes = memory.join(words, "lower", "left_semi").where("best IS NOT NULL")
            checked = check_sentences(batch, ids, dictionary, fixes=stage(fixes, "fixes"))
            checked.write.mode("overwrite").parquet(f"{path}/checked/batch_id={batch_id}")

    drain(sentences, "append", path, handle)
    id_schema = ", ".join(f"{name} {kind}" for name, kind in sentences.dtypes if name in ids)
    error = _ERROR + "".join(f", {c}: {kind}" for c, kind in _TYPES.items() if typed)
    return read_batches(spark, f"{path}/checked", f"{id_schema}, {CHECKED.format(error=error)}").drop("batch_id")
