"""Streams against batch jobs, over restarts and batches of any size."""

import os
import shutil
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from wordloom import storage
from wordloom.operators import correct, corpus
from wordloom.plans import inputs
from wordloom.sources import tables
from wordloom.staging import fresh_path
from wordloom.streaming import sentences, words


@pytest.fixture(scope="module")
def parts(spark, sf, tmp_path_factory):
    """The documents in four files that follow the ids."""
    folder = fresh_path(spark, "incoming")
    tables.table(spark, sf, "documents").repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id").write.parquet(folder)
    return sorted(urlparse(f).path for f in spark.read.parquet(folder).inputFiles())


def arrive(parts, folder, numbers):
    """Files arrive in the order of their times."""
    for i in numbers:
        os.utime(shutil.copy(parts[i], folder / f"documents-{i}.parquet"), (1_000_000 + 10 * i,) * 2)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_counts_go_on_after_a_restart(spark, sf, parts, tmp_path, monkeypatch):
    monkeypatch.setattr(words, "MERGED_BATCHES", 2)
    path = fresh_path(spark, "counts")
    arrive(parts, tmp_path, [0, 1, 2])
    first = words.run_word_count(words.article_stream(spark, str(tmp_path), 1), path)
    assert first.count() > 0
    merged = words.numbered(spark, f"{path}/merged")
    assert len(merged) == 1 and len(words.numbered(spark, f"{path}/changes")) < 2
    arrive(parts, tmp_path, [3])
    assert same(words.run_word_count(words.article_stream(spark, str(tmp_path), 1), path), inputs.vocab(spark, sf))
    # Nothing new: nothing changes, and the folders hold no more than one table and a few batches.
    before = words.numbered(spark, f"{path}/merged"), words.numbered(spark, f"{path}/changes")
    assert same(words.run_word_count(words.article_stream(spark, str(tmp_path), 1), path), inputs.vocab(spark, sf))
    assert (words.numbered(spark, f"{path}/merged"), words.numbered(spark, f"{path}/changes")) == before
    state = f"{path}/checkpoint/state/0/0"
    assert any(n.endswith((".changelog", ".zip")) for n in storage.children(spark, state))


@pytest.mark.parametrize("per_batch", [None, 1])
def test_snapshots_do_not_depend_on_batches(spark, sf, parts, tmp_path, per_batch):
    arrive(parts, tmp_path, range(4))
    shots = words.run_snapshots(words.article_stream(spark, str(tmp_path), per_batch), every=30)
    assert same(shots, corpus.snapshots(tables.articles(spark, sf), every=30).select("articles", "word", "freq"))


def test_retried_snapshot_batches_change_nothing(spark, sf, parts):
    path, want = fresh_path(spark, "snapshots"), corpus.snapshots(tables.articles(spark, sf), every=25)
    writer = words.SnapshotWriter(spark, path, 25, 5)
    docs = tables.table(spark, sf, "documents").select("doc_id", F.concat_ws(" ", "source", F.col("doc_id").cast("string")).alias("title"), "text")
    low = docs.agg(F.percentile_approx("doc_id", [0.3, 0.31, 0.8])).first()[0]
    bounds = [None, *low, None]
    for i in range(4):
        batch = docs.where((F.col("doc_id") > bounds[i]) if i else F.lit(True)).where((F.col("doc_id") <= bounds[i + 1]) if i < 3 else F.lit(True))
        for _ in range(2):
            writer(batch, i)
    got = words.read_batches(spark, f"{path}/versions", "articles BIGINT, word STRING, freq BIGINT").drop("batch_id")
    assert same(got, want.select("articles", "word", "freq"))
    assert len(words.numbered(spark, f"{path}/totals")) <= 2


SAID = [[(1, 0, "teh cat sat."), (1, 1, "Teh dgo!")], [(2, 0, "teh end"), (None, 0, "helo teh"), (None, 0, "a dgo"), (3, 0, ""), (4, 0, "qqqqqqqq")], [(5, 0, "Teh helo qqqqqqqq")]]
DICTIONARY = [("the", 900), ("cat", 50), ("dog", 60), ("end", 40), ("hello", 30), ("sat", 20), ("a", 999)]


def test_words_are_searched_once(spark, tmp_path, monkeypatch):
    known = spark.createDataFrame(DICTIONARY, "word string, freq bigint")
    path, schema = fresh_path(spark, "corrections"), "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
    for i, rows in enumerate(SAID):
        at = fresh_path(spark, "said")
        spark.createDataFrame([(c, t, "u", s) for c, t, s in rows], schema).coalesce(1).write.parquet(at)
        shutil.copy(urlparse(spark.read.parquet(at).inputFiles()[0]).path, tmp_path / f"conversations-{i}.parquet")
        stream = sentences.sentence_stream(spark, str(tmp_path), "conversations", 1).select("conv_id", "turn", F.col("text").alias("sentence"))
        checked = sentences.run_corrections(stream, ["conv_id", "turn"], known, path=path)
    solved = {}
    for r in sentences.solved_words(spark, path).collect():
        assert r.lower not in solved
        solved[r.lower] = (r.best, r.batch_id)
    assert solved == {"teh": ("the", 0), "dgo": ("dog", 0), "helo": ("hello", 1), "qqqqqqqq": (None, 1)}
    batch = spark.createDataFrame([row for rows in SAID for row in rows], "conv_id BIGINT, turn BIGINT, sentence STRING")
    assert same(checked, correct.check_sentences(batch, ["conv_id", "turn"], known))
    texts = {(r.conv_id, r.original_sentence): r.corrected_sentence for r in checked.collect()}
    assert texts[None, "helo teh"] == "hello the" and texts[None, "a dgo"] == "a dog" and texts[5, "Teh helo qqqqqqqq"] == "The hello qqqqqqqq"


def test_scratch_tables_are_deleted(spark):
    from wordloom.staging import scratch, stage, workspace

    before = set(storage.children(spark, workspace(spark)))
    with scratch(spark):
        assert stage(spark.range(3).toDF("n"), "kept-for-now").count() == 3
    assert set(storage.children(spark, workspace(spark))) == before


def test_empty_streams(spark, tmp_path):
    assert words.run_word_count(words.article_stream(spark, str(tmp_path))).count() == 0
    assert words.run_snapshots(words.article_stream(spark, str(tmp_path))).count() == 0
