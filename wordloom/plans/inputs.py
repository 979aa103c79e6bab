"""The flow's hand-offs, built from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom import constants as K
from wordloom.functions import features as ft
from wordloom.functions import text as tx
from wordloom.functions.draws import below, chance, draw
from wordloom.operators import bundle, corpus, evaluate as ev, models, prepare, ranking, synth
from wordloom.sources import tables
from wordloom.staging import fresh_path, stage


def vocab(spark: SparkSession, sf: str) -> DataFrame:
    """(word, freq) over the accepted articles of ``documents``."""
    return corpus.word_count(tables.articles(spark, sf))


def staged_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return stage(vocab(spark, sf), "vocab")


def dictionary_of(words: DataFrame) -> DataFrame:
    """Staged (word, freq): the most common words of a staged vocabulary, at most the dictionary's size.

    There is no floor. Frequencies are those of the frequency table, so rare words have 0. Written after
    the cut, so that the planner knows its size and may broadcast it.
    """
    freq = F.when(F.col("freq") >= K.TABLE_MIN_FREQ, F.col("freq")).otherwise(F.lit(0).cast("bigint"))
    return stage(ranking.most_frequent(words).select("word", freq.alias("freq")), "dictionary")


def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return dictionary_of(staged_vocab(spark, sf))


def typo_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """One misspelling per usable vocabulary word, with its length columns."""
    pairs = synth.typo_pairs(ranking.usable_length(vocab(spark, sf)))
    return pairs.where(F.col("incorrect_word").isNotNull()).withColumn(
        "word_length", F.length("correct_word")
    )


def candidates(spark: SparkSession, sf: str, words: DataFrame | None = None) -> tuple[DataFrame, int, DataFrame]:
    """(candidates, their number, dictionary).

    The number comes from the footer of the staged file. ``words``, a staged vocabulary, saves counting the corpus again;
    the same holds wherever it is passed on.
    """
    words = staged_vocab(spark, sf) if words is None else words
    chosen = stage(ranking.top_candidates(corpus.at_least(words, K.TABLE_MIN_FREQ)), "candidates")
    return chosen, chosen.count(), dictionary_of(words)


def dataset(spark: SparkSession, sf: str, words: DataFrame | None = None) -> DataFrame:
    return synth.build_dataset(*candidates(spark, sf, words))


def encoded(spark: SparkSession, sf: str, words: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(featured and encoded dataset, staged encoders)."""
    rows = ft.with_features(dataset(spark, sf, words))
    encoders = stage(prepare.encoder_table(rows), "encoders")
    return prepare.encode(rows, encoders), encoders


def prepared(
    spark: SparkSession, sf: str, fit_on: str = "all", words: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scaled rows with split, encoders, scaler), rows staged: the second cut point."""
    rows, encoders = encoded(spark, sf, words)
    split = stage(prepare.split_by_group(rows), "encoded")
    basis = split.where(F.col("split") == "train") if fit_on == "train" else split
    scaler = stage(prepare.scaler_table(basis), "scaler")
    return stage(prepare.scale(split, scaler), "prepared"), encoders, scaler


def damaged_dump(spark: SparkSession, sf: str) -> str:
    """Folder of an XML dump of the wiki pages in which four of ten pages are damaged, by the last digit of their id.

    3: cut off behind the text. 5: text and revision not closed. 7: revision not closed. 9: no title, an unknown tag not closed.
    """
    pages, last = tables.wiki_pages(spark, sf), F.col("doc_id") % 10
    body = F.col("text")
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        body = F.replace(body, F.lit(mark), F.lit(entity))
    no_end = last.isin(3, 5, 7)
    text = F.concat(F.lit('<text xml:space="preserve">'), body, F.when(last == 5, "").otherwise("</text>"))
    title = F.when(last == 9, F.lit("<titel>")).otherwise(F.concat(F.lit("<title>"), "title", F.lit("</title>")))
    page = F.concat(
        F.lit("<page>\n<id>"), F.col("doc_id").cast("string"), F.lit("</id>"), title, F.lit("<revision>"), F.coalesce(text, F.lit("")),
        F.when(no_end, "").otherwise("</revision>"), F.when(last == 3, "").otherwise("</page>"),
    )
    path = fresh_path(spark, "damaged-xml")
    pages.select(page.alias("value")).write.text(path)
    return path


def damaged_csv(spark: SparkSession, sf: str) -> str:
    """Folder of the dataset as CSV without headers in which four of ten lines are damaged, by the last digit of their id.

    1: a letter in a number. 2: two columns missing. 3: a column too many. 4: an empty word.
    """
    rows, last = dataset(spark, sf), F.col("id") % 10
    columns = ["id", "correct_word", "incorrect_word", "error_type", "edit_distance", "word_length", "word_frequency"]
    text = {c: F.col(c).cast("string") for c in columns}
    text["edit_distance"] = F.when(last == 1, F.concat(F.lit("x"), text["edit_distance"])).otherwise(text["edit_distance"])
    text["correct_word"] = F.when(last == 4, "").otherwise(text["correct_word"])
    line = F.concat_ws(",", *text.values())
    line = F.when(last == 2, F.concat_ws(",", *list(text.values())[:-2])).when(last == 3, F.concat(line, F.lit(",more"))).otherwise(line)
    path = fresh_path(spark, "damaged-csv")
    rows.select(line.alias("line")).write.text(path)
    return path


# --- models ------------------------------------------------------------------

def trained_bundle(
    spark: SparkSession, sf: str, preset: str = "smoke", words: DataFrame | None = None
) -> tuple[bundle.Bundle, DataFrame]:
    """(a forest and boosted trees on the prepared rows with the scores of both, not published yet; rows for them)."""
    rows, encoders, scaler = prepared(spark, sf, words=words)
    xy = stage(models.load_xy(rows), "model-rows")
    found = {
        "random_forest": models.train_forest(xy.where(F.col("split") == "train"), "smoke", 1),
        "boost_fixed": models.train_boost_fixed(xy, len(CLASSES), preset),
    }
    preds = [models.predictions(m, xy.where(F.col("split") == "val"), name) for name, m in found.items()]
    scores = {r.model: r.f1 for r in ev.metrics(preds[0].unionByName(preds[1])).collect()}
    return bundle.Bundle(found, encoders, scaler, scores, tuple(found)), xy


# --- evaluation inputs -----------------------------------------------------------

CLASSES = ("correct", "deletion", "insertion", "substitution")
RULES = ("length_rule", "noisy_rule", "double_rule")
_RULE_SEED = 7


def _length_rule(tie):
    right, wrong = F.length("correct_word"), F.length("incorrect_word")
    return F.when(wrong > right, "insertion").when(wrong < right, "deletion").otherwise(tie)


def rule_label(rule: str):
    """Deterministic stand-in classifiers."""
    word = F.col("incorrect_word")
    by_hash = F.when(draw(word, _RULE_SEED, 0) % 2 == 0, "substitution").otherwise("correct")
    plain = _length_rule(by_hash)
    if rule == "length_rule":
        return plain
    if rule == "noisy_rule":
        other = F.get(F.array(*[F.lit(c) for c in CLASSES]), below(draw(word, _RULE_SEED, 2), 4))
        return F.when(chance(draw(word, _RULE_SEED, 1), 0.2), other).otherwise(plain)
    doubled = F.when(ft.has_double_letters(word) == 1, "correct").otherwise("substitution")
    return _length_rule(doubled)


def rule_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Staged (model, id, split, label, prediction) of three rules on the dataset."""
    rows = prepare.split_by_group(dataset(spark, sf))
    answers = F.array(*[
        F.struct(F.lit(r).alias("model"), rule_label(r).alias("prediction")) for r in RULES
    ])
    return stage(
        rows.select("id", "split", F.col("error_type").alias("label"), F.explode(answers).alias("a"))
        .select(F.col("a.model").alias("model"), "id", "split", "label", F.col("a.prediction").alias("prediction")),
        "rule-predictions",
    )


def rule_probabilities(preds: DataFrame) -> DataFrame:
    """(model, id, class, p): integer weights from a hash, the predicted class favoured, normalized."""
    key = F.concat_ws("|", "model", F.col("id").cast("string"))
    weights = [
        (draw(key, _RULE_SEED, k) % 100 + F.when(F.col("prediction") == c, 60).otherwise(1)).cast("double")
        for k, c in enumerate(CLASSES)
    ]
    held = preds.select("model", "id", F.array(*weights).alias("w"))
    total = sum((F.get("w", F.lit(k)) for k in range(1, len(CLASSES))), F.get("w", F.lit(0)))
    return held.select(
        "model", "id", total.alias("t"),
        F.posexplode("w").alias("k", "v"),
    ).select(
        "model", "id", F.get(F.array(*[F.lit(c) for c in CLASSES]), F.col("k")).alias("class"),
        (F.col("v") / F.col("t")).alias("p"),
    )


# --- correction inputs -----------------------------------------------------------

def sentences(spark: SparkSession, sf: str) -> DataFrame:
    """(conv_id, turn, sentence): every turn of every conversation."""
    turns = tables.table(spark, sf, "conversations")
    return tables.spread(turns.select("conv_id", "turn", F.col("text").alias("sentence")), "conv_id")


def query_words(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct letter tokens of all conversations, as written."""
    token = F.explode(tx.sentence_tokens(F.col("sentence"))).alias("query")
    return sentences(spark, sf).select(token).where(tx.is_checkable(F.col("query"))).distinct()
