"""Running word counts over arriving articles, in a folder that outlives the stream.

A stream writes under one ``path``: the checkpoint of the query, what its batches found, and what later batches need of
earlier ones. A batch that is retried writes the same files again. Started again on the same path, a stream goes on where it ended.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom import constants as K, storage
from wordloom.operators import corpus
from wordloom.operators.ranking import dense_index
from wordloom.sources.tables import SCHEMAS
from wordloom.staging import fresh_path, scratch, stage

# Counters live in RocksDB on the executors; a commit uploads what changed, not the whole store.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# Batches of changed counters that are merged into one table.
MERGED_BATCHES = 10
COUNTER_SCHEMA = "word STRING, freq BIGINT"


def article_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Document files of a folder as a stream of (doc_id, title, text)."""
    reader = spark.readStream.schema(SCHEMAS["documents"]).option("pathGlobFilter", "documents*.parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder).select(
        "doc_id", F.concat_ws(" ", "source", F.col("doc_id").cast("string")).alias("title"), "text"
    )


@contextlib.contextmanager
def _configured(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings that a query takes over when it starts."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def drain(stream: DataFrame, mode: str, path: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Process all that has arrived, batch by batch, under the checkpoint of ``path``."""
    with _configured(stream.sparkSession, STATE_CONF):
        query = (
            stream.writeStream.outputMode(mode)
            .option("checkpointLocation", f"{path}/checkpoint")
            .trigger(availableNow=True)
            .foreachBatch(handle)
            .start()
        )
        query.awaitTermination()


def numbered(spark: SparkSession, path: str) -> list[int]:
    """The numbers behind ``=`` of the finished tables in a folder, ascending."""
    names = [n for n in storage.children(spark, path) if "=" in n and storage.written(spark, f"{path}/{n}")]
    return sorted(int(n.partition("=")[2]) for n in names)


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows under ``path`` with their ``batch_id``."""
    full = f"{schema}, batch_id INT"
    return spark.read.schema(full).parquet(path) if numbered(spark, path) else spark.createDataFrame([], full)


# --- counters ---------------------------------------------------------------------------

def count_stream(articles: DataFrame) -> DataFrame:
    """Stateful (word, freq); the state holds one counter per word."""
    return corpus.article_words(articles).groupBy("word").agg(F.count(F.lit(1)).alias("freq"))


def _counter_parts(spark: SparkSession, path: str) -> tuple[int, list[int], list[str]]:
    """(last merged batch or -1, later batches, folders that hold all current counters)."""
    merged = (numbered(spark, f"{path}/merged") or [-1])[-1]
    later = [b for b in numbered(spark, f"{path}/changes") if b > merged]
    folders = [f"{path}/merged/upto={merged}"] * (merged >= 0) + [f"{path}/changes/batch_id={b}" for b in later]
    return merged, later, folders


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """(word, freq) of a counting stream: the last merged table and at most ``MERGED_BATCHES`` batches behind it.

    Counters only grow, so the largest value of a word is the current one.
    """
    folders = _counter_parts(spark, path)[2]
    if not folders:
        return spark.createDataFrame([], COUNTER_SCHEMA)
    return spark.read.schema(COUNTER_SCHEMA).parquet(*folders).groupBy("word").agg(F.max("freq").alias("freq"))


def _merge(spark: SparkSession, path: str) -> None:
    """Put the current counters into one table and delete what it replaces, once it is finished."""
    merged, later, _ = _counter_parts(spark, path)
    if len(later) < MERGED_BATCHES:
        return
    read_counts(spark, path).write.mode("overwrite").parquet(f"{path}/merged/upto={later[-1]}")
    for batch in later:
        storage.delete(spark, f"{path}/changes/batch_id={batch}")
    if merged >= 0:
        storage.delete(spark, f"{path}/merged/upto={merged}")


def run_word_count(articles: DataFrame, path: str | None = None) -> DataFrame:
    """Count what has arrived and return the counters (word, freq) so far.

    Each batch writes the counters it changed; they are merged every ``MERGED_BATCHES`` batches.
    """
    spark = articles.sparkSession
    path = path or fresh_path(spark, "word-count-stream")

    def handle(batch: DataFrame, batch_id: int) -> None:
        # A retry of a batch that is merged already changes nothing: its counters are in the merged table.
        if batch_id > _counter_parts(spark, path)[0]:
            batch.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")
            _merge(spark, path)

    drain(count_stream(articles), "update", path, handle)
    return read_counts(spark, path)


# --- snapshots ----------------------------------------------------------------------------

class SnapshotWriter:
    """Versions of the vocabulary after every ``every`` accepted articles, whatever the size of the batches.

    Folders under ``path``: ``progress`` (articles before and in each batch), ``blocks`` (counts of each block of ``every``
    articles, as far as each batch saw it), ``totals`` (all counters at the last finished block), ``versions`` (the result).
    Articles are numbered in the order of their ids within a batch, batches in the order of arrival.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = K.SNAPSHOT_ARTICLES, min_freq: int = K.SNAPSHOT_MIN_FREQ):
        self.spark, self.path, self.every, self.min_freq = spark, path, every, min_freq

    def before(self, batch_id: int) -> int:
        """Accepted articles of all earlier batches."""
        earlier = [b for b in numbered(self.spark, f"{self.path}/progress") if b < batch_id]
        if not earlier:
            return 0
        row = self.spark.read.parquet(f"{self.path}/progress/batch_id={earlier[-1]}").first()
        return row["before"] + row["accepted"]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with scratch(self.spark):
            before = self.before(batch_id)
            self._clean(before // self.every)
            kept = stage(corpus.accepted_articles(batch), "accepted")
            accepted = kept.count()
            place = dense_index(kept.select("doc_id"), [F.col("doc_id")], "n")
            block = F.ceil((F.col("n") + F.lit(before)) / self.every).cast("bigint")
            counts = corpus.block_counts(kept, place.select("doc_id", block.alias("block")))
            counts.write.mode("overwrite").partitionBy("block").parquet(f"{self.path}/blocks/batch_id={batch_id}")
            self._finish(before // self.every, (before + accepted) // self.every, batch_id)
            progress = self.spark.createDataFrame([(before, accepted)], "before BIGINT, accepted BIGINT")
            progress.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/progress/batch_id={batch_id}")

    def _finish(self, done: int, last: int, batch_id: int) -> None:
        """Write the versions of the blocks behind ``done`` up to ``last``, which this batch has finished."""
        if last <= done:
            return
        blocks = self.spark.read.schema("word STRING, c BIGINT, batch_id INT, block BIGINT").parquet(f"{self.path}/blocks")
        blocks = blocks.where((F.col("batch_id") <= batch_id) & F.col("block").between(done + 1, last))
        blocks = blocks.groupBy("word", "block").agg(F.sum("c").alias("c"))
        if done:
            totals = self.spark.read.parquet(f"{self.path}/totals/block={done}")
            blocks = blocks.unionByName(totals.select("word", F.lit(done).cast("bigint").alias("block"), F.col("freq").alias("c")))
        blocks = stage(blocks, "blocks")
        shots = corpus.running_snapshots(blocks, F.lit(last), self.min_freq).where(F.col("block") > done)
        shots = shots.select((F.col("block") * self.every).alias("articles"), "word", "freq")
        shots.write.mode("overwrite").parquet(f"{self.path}/versions/batch_id={batch_id}")
        totals = blocks.groupBy("word").agg(F.sum("c").alias("freq"))
        totals.write.mode("overwrite").parquet(f"{self.path}/totals/block={last}")

    def _clean(self, done: int) -> None:
        """Delete counts of blocks that earlier, finished batches have turned into versions, and older totals."""
        for block in numbered(self.spark, f"{self.path}/totals"):
            if block < done:
                storage.delete(self.spark, f"{self.path}/totals/block={block}")
        for batch in numbered(self.spark, f"{self.path}/blocks"):
            at = f"{self.path}/blocks/batch_id={batch}"
            for name in storage.children(self.spark, at):
                if name.startswith("block=") and int(name.partition("=")[2]) <= done:
                    storage.delete(self.spark, f"{at}/{name}")


def run_snapshots(
    articles: DataFrame, every: int = K.SNAPSHOT_ARTICLES, min_freq: int = K.SNAPSHOT_MIN_FREQ, path: str | None = None
) -> DataFrame:
    """(articles, word, freq): the frequent words after every ``every`` accepted articles that have arrived."""
    spark = articles.sparkSession
    path = path or fresh_path(spark, "snapshot-stream")
    drain(articles, "append", path, SnapshotWriter(spark, path, every, min_freq))
    return read_batches(spark, f"{path}/versions", "articles BIGINT, word STRING, freq BIGINT").drop("batch_id")
