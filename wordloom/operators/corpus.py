"""Corpus to vocabulary: article gates, word counts, thresholds, totals."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wordloom import constants as K
from wordloom.functions import text as tx
from wordloom.functions.plan import pinned
from wordloom.operators.ranking import dense_index
from wordloom.staging import stage


def candidate_articles(pages: DataFrame) -> DataFrame:
    """Cheap gates on the raw columns, before any cleaning."""
    title, text = F.col("title"), F.col("text")
    return pages.where(
        tx.is_article(title, text) & ~tx.is_redirect(text) & ~tx.in_skipped_namespace(title)
    )


def accepted_articles(pages: DataFrame, max_articles: int | None = None) -> DataFrame:
    """(doc_id, words) of the articles that count, with ``max_articles`` those of ``first_articles``.

    Cleaned text and words are pinned, so each is computed once although a
    length gate follows it.
    """
    if max_articles is not None:
        return first_articles(pages, max_articles)
    raw = candidate_articles(pages).select("doc_id", "text")
    cleaned = pinned(raw, "_clean", tx.clean_text(F.col("text"))).where(
        F.length("_clean") > K.MIN_CLEAN_CHARS
    )
    kept = pinned(cleaned, "words", tx.english_words(F.col("_clean"))).where(
        F.size("words") > K.MIN_ARTICLE_WORDS
    ).select("doc_id", "words")
    return kept


def first_articles(pages: DataFrame, max_articles: int) -> DataFrame:
    """(doc_id, words) of the articles that count, up to ``max_articles`` ids in source order.

    Pages are read in ranges of ids, each twice as wide as the one before, until enough articles are accepted. The bound on the id
    reaches the scan, which skips row groups and files beyond it, so what is read grows with ``max_articles`` and not with the corpus
    where files follow the ids. Only ids of the last range are numbered. A range starts at twice the share that would do if all pages counted.
    """
    bounds = pages.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("doc_id").alias("n")).first()
    parts, accepted, start = [], 0, bounds["low"]
    width = math.ceil((bounds["high"] - start + 1) * min(1.0, 2 * max_articles / bounds["n"])) if bounds["n"] else 0
    while start is not None and start <= bounds["high"] and accepted < max_articles:
        inside = pages.where(F.col("doc_id").between(start, start + width - 1))
        part = stage(accepted_articles(inside), "first-articles")
        ids = part.select("doc_id").distinct()
        n = ids.count()
        if accepted + n > max_articles:
            numbered = dense_index(ids, [F.col("doc_id")], "n")
            last = numbered.where(F.col("n") == max_articles - accepted).agg(F.max("doc_id")).first()[0]
            part = part.where(F.col("doc_id") <= last) if last is not None else part.limit(0)
        parts.append(part)
        accepted, start, width = accepted + n, start + width, width * 2
    return reduce(DataFrame.unionByName, parts) if parts else accepted_articles(pages).limit(0)


def article_words(pages: DataFrame, max_articles: int | None = None) -> DataFrame:
    """One row per word occurrence."""
    return accepted_articles(pages, max_articles).select("doc_id", F.explode("words").alias("word"))


def word_count(pages: DataFrame, max_articles: int | None = None) -> DataFrame:
    """(word, freq); counts are combined per task before the shuffle on the word."""
    return (
        article_words(pages, max_articles).groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
    )


def count_accepted(pages: DataFrame) -> DataFrame:
    return accepted_articles(pages).agg(F.count(F.lit(1)).alias("articles"))


def at_least(vocab: DataFrame, min_freq: int) -> DataFrame:
    return vocab.where(F.col("freq") >= min_freq)


def by_threshold(vocab: DataFrame, thresholds: tuple[int, ...] = K.FREQ_THRESHOLDS) -> DataFrame:
    """(min_freq, word, freq): every word once per threshold that it reaches."""
    reached = F.filter(F.array(*[F.lit(t) for t in thresholds]), lambda t: t <= F.col("freq"))
    return vocab.select(F.explode(reached).alias("min_freq"), "word", "freq")


def threshold_sizes(vocab: DataFrame, thresholds: tuple[int, ...] = K.FREQ_THRESHOLDS) -> DataFrame:
    """(min_freq, words): one pass of conditional counts, then unpivoted."""
    counts = vocab.agg(
        *[F.count_if(F.col("freq") >= t).alias(str(t)) for t in thresholds]
    )
    return counts.select(
        F.explode(
            F.array(*[
                F.struct(F.lit(t).alias("min_freq"), F.col(str(t)).alias("words"))
                for t in thresholds
            ])
        ).alias("s")
    ).select("s.*")


def corpus_totals(vocab: DataFrame, top: int = 10) -> DataFrame:
    """Distinct words, occurrences, and the most common words as (word, freq) structs."""
    head = vocab.orderBy(F.desc("freq"), "word").limit(top)
    ranked = head.agg(
        F.sort_array(F.collect_list(F.struct((-F.col("freq")).alias("k"), "word", "freq"))).alias("a")
    ).select(
        F.transform("a", lambda s: F.struct(s["word"].alias("word"), s["freq"].alias("freq"))).alias("a")
    )
    return vocab.agg(
        F.count(F.lit(1)).alias("total_unique_words"),
        F.coalesce(F.sum("freq"), F.lit(0)).alias("total_word_occurrences"),
    ).withColumn("most_common_10", ranked.scalar())


def snapshots(
    pages: DataFrame, every: int = K.SNAPSHOT_ARTICLES, min_freq: int = K.SNAPSHOT_MIN_FREQ
) -> DataFrame:
    """(articles, word, freq): running counts after every ``every`` accepted articles.

    Articles are numbered without a global window; each word's per-block counts
    become running sums, and a word stays in later snapshots it is absent from.
    """
    # Number ids only; the words stay out of the sort.
    kept = stage(accepted_articles(pages), "accepted")
    numbered = dense_index(kept.select("doc_id"), [F.col("doc_id")], "n")
    blocks = numbered.select("doc_id", F.ceil(F.col("n") / every).cast("bigint").alias("block"))
    total = kept.agg(F.floor(F.count(F.lit(1)) / every).alias("n"))
    shots = running_snapshots(block_counts(kept, blocks), total.scalar(), min_freq)
    return shots.select((F.col("block") * every).alias("articles"), "word", "freq")


def block_counts(kept: DataFrame, blocks: DataFrame) -> DataFrame:
    """(word, block, c): occurrences of the words of ``kept`` (doc_id, words) per block of articles (doc_id, block)."""
    words = kept.join(blocks, "doc_id").select("block", F.explode("words").alias("word"))
    return words.groupBy("word", "block").agg(F.count(F.lit(1)).alias("c"))


def running_snapshots(per_block: DataFrame, last_block: Column, min_freq: int) -> DataFrame:
    """(block, word, freq): counts up to each block to ``last_block``, from the counts ``c`` of the single blocks."""
    by_word = W.partitionBy("word").orderBy("block")
    running = per_block.select(
        "word", "block",
        F.sum("c").over(by_word).alias("freq"),
        F.lead("block").over(by_word).alias("next_block"),
    ).withColumn("last", F.least(F.coalesce(F.col("next_block") - 1, last_block), last_block))
    frequent = running.where((F.col("freq") >= min_freq) & (F.col("last") >= F.col("block")))
    return frequent.select(F.explode(F.sequence("block", "last")).alias("block"), "word", "freq")
