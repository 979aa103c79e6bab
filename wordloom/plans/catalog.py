"""Every registered query: name -> f(spark, folder) -> DataFrame.

Queries read whole tables. Doubles are rounded to six digits for comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wordloom import constants as K
from wordloom.functions import features as ft
from wordloom.functions import pair_features as fp
from wordloom.functions import text as tx
from wordloom.functions import typos
from wordloom.functions.plan import pinned
from wordloom.operators import (
    bundle, corpus, correct, ensemble, evaluate as ev, extras, fuzzy, lookup, models, prepare, profiles,
    ranking, search, synth,
)
from wordloom.plans import inputs
from wordloom.sources import files, results, tables
from wordloom.staging import fresh_path, stage
from wordloom.streaming import sentences as sentence_stream
from wordloom.streaming import words as word_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.round(c, 6).alias(c) if kind in ("double", "float") else F.col(c) for c, kind in df.dtypes
    ])


def query(name: str):
    def add(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf: rounded(f(spark, sf))
        return f

    return add


def simple(name: str, f: Query) -> None:
    query(name)(f)


# --- sources and sinks -------------------------------------------------------------

@query("src_wiki_xml")
def _(spark, sf):
    return files.round_trip(tables.wiki_pages(spark, sf), "pages-xml", files.write_wiki_xml, files.read_wiki_xml)


simple("src_wiki_xml_damaged", lambda spark, sf: files.read_wiki_pages(spark, inputs.damaged_dump(spark, sf)))


@query("src_word_list")
def _(spark, sf):
    return files.round_trip(
        inputs.vocab(spark, sf), "words", lambda df, p: df.select("word").write.text(p), files.read_word_list
    )


@query("src_freq_map")
def _(spark, sf):
    return files.round_trip(inputs.vocab(spark, sf), "freq-map", files.write_freq_map, files.read_freq_map)


@query("src_dataset_csv")
def _(spark, sf):
    return files.round_trip(inputs.dataset(spark, sf), "dataset-csv", files.write_dataset_csv, files.read_dataset_csv)


@query("src_dataset_csv_checked")
def _(spark, sf):
    """Every line of a damaged dataset: as a sample, or with what is wrong with it."""
    good, rejected = files.read_dataset_csv_checked(spark, inputs.damaged_csv(spark, sf), header=False)
    nothing = F.lit(None).cast("string")
    return good.select("id", "incorrect_word", nothing.alias("reason"), nothing.alias("line")).unionByName(rejected, allowMissingColumns=True)


def _differing(made: DataFrame, read: DataFrame, name: str) -> DataFrame:
    """(model, split, rows, differing): rows whose prediction is another one after reading a model back."""
    both = made.select("id", "split", F.col("prediction").alias("one")).join(read.select("id", F.col("prediction").alias("two")), "id")
    return both.groupBy(F.lit(name).alias("model"), "split").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("one") != F.col("two")).alias("differing")
    )


@query("src_model")
def _(spark, sf):
    """Models and ensemble in memory next to the newest published version of their bundle."""
    made, xy = inputs.trained_bundle(spark, sf)
    root = fresh_path(spark, "bundles")
    bundle.publish(spark, root, made)
    read = bundle.load(spark, root)
    parts = [_differing(models.predictions(made.models[m], xy, m), models.predictions(read.models[m], xy, m), m) for m in made.models]
    splits = xy.select("id", "split")
    votes = [splits.join(b.votes(xy), "id") for b in (made, read)]
    return parts[0].unionByName(parts[1]).unionByName(_differing(*votes, "ensemble"))


@query("sink_vocab_thresholds")
def _(spark, sf):
    return files.round_trip(
        inputs.vocab(spark, sf), "thresholds", files.write_thresholds,
        lambda s, p: s.read.schema("word STRING, freq BIGINT, min_freq INT").parquet(p),
    )


@query("sink_dictionary")
def _(spark, sf):
    return files.round_trip(
        inputs.staged_vocab(spark, sf), "dictionary-text", files.write_dictionary, files.read_word_list
    )


@query("sink_dataset")
def _(spark, sf):
    back = files.round_trip(inputs.dataset(spark, sf), "dataset-csv", files.write_dataset_csv, files.read_dataset_csv)
    return files.dataset_sample(back)


@query("sink_splits")
def _(spark, sf):
    rows = prepare.split_by_group(inputs.encoded(spark, sf)[0])
    return files.round_trip(rows, "splits", files.write_splits, lambda s, p: files.read_splits(s, p, rows))


@query("sink_encoders")
def _(spark, sf):
    rows = ft.with_features(inputs.dataset(spark, sf))
    return files.round_trip(prepare.encoder_table(rows), "encoders-json", files.write_encoders, files.read_encoders)


@query("sink_model")
def _(spark, sf):
    """What two published versions hold: the second lacks a model that does not vote, and its score."""
    made, xy = inputs.trained_bundle(spark, sf)
    root = fresh_path(spark, "bundles")
    bundle.publish(spark, root, made)
    voter = {"random_forest": made.models["random_forest"]}
    bundle.publish(spark, root, bundle.Bundle(voter, made.encoders, made.scaler, members=("random_forest",)))
    rows = []
    for number in bundle.versions(spark, root):
        read = bundle.load(spark, root, number)
        weights = {r.model: r.weight for r in read.weights(spark).collect()}
        rows += [(number, m, m in read.f1, abs(sum(weights.values()) - 1) < 1e-9) for m in sorted(read.models)]
    told = spark.createDataFrame(rows, "version INT, model STRING, scored BOOLEAN, weights_sum_to_one BOOLEAN")
    return told.withColumn("encoders", made.encoders.agg(F.count(F.lit(1))).scalar())


@query("sink_results")
def _(spark, sf):
    """The result files of a run, read back: metrics of each model and the comparison, in long form."""
    preds = inputs.rule_predictions(spark, sf)
    path = fresh_path(spark, "results")
    results.write_results(path, preds)
    metrics, comparison, _, _ = results.read_results(spark, path)
    long = [df.unpivot(["model"], [c for c in df.columns if c not in ("model", "place")], "metric", "value") for df in (metrics, comparison)]
    return long[0].withColumn("file", F.lit("metrics")).unionByName(long[1].withColumn("file", F.lit("comparison")))


@query("sink_report")
def _(spark, sf):
    words = inputs.staged_vocab(spark, sf)
    return stage(
        profiles.report({
            "overview": profiles.basic(words).unpivot([], ["unique_words", "occurrences", "frequent_words"], "k", "v"),
            "length_stats": profiles.one_row_long(profiles.length_stats(words)),
            "lengths": profiles.length_distribution(words),
            "frequency_stats": profiles.one_row_long(profiles.frequency_stats(words)),
            "top": ranking.top_words(words),
            "bottom": ranking.bottom_words(words),
            "bins": profiles.frequency_bins(words).select("label", "n"),
            "letters": profiles.first_letters(words),
        }),
        "report",
    )


# --- cleaning and tokenizing ---------------------------------------------------------

def _step(name: str, step, source=tables.wiki_pages, key="doc_id"):
    simple(name, lambda spark, sf: source(spark, sf).select(key, step(tx.present(F.col("text"))).alias("out")))


simple("cl_empty", lambda spark, sf: tables.wiki_pages(spark, sf).select("doc_id", tx.present(F.col("text")).alias("out")))
_step("cl_template", tx.drop_templates)
_step("cl_link_piped", tx.unwrap_piped_links)
_step("cl_link_plain", tx.unwrap_plain_links)
_step("cl_heading", tx.drop_headings)
_step("cl_url", tx.drop_urls)
_step("cl_charset", tx.keep_charset)
_step("cl_space", tx.collapse_space)
_step("clean_text", tx.clean_text)
_step(
    "cl_tag", tx.drop_tags,
    lambda spark, sf: tables.spread(tables.table(spark, sf, "pages"), "page_id").withColumnRenamed("html", "text"),
    "page_id",
)


@query("tok_words")
def _(spark, sf):
    words = F.posexplode(tx.english_words(F.col("text"))).alias("pos", "word")
    return tables.articles(spark, sf).select("doc_id", words)


@query("tok_sentence")
def _(spark, sf):
    tokens = F.posexplode(tx.sentence_tokens(F.col("sentence"))).alias("pos", "token")
    return inputs.sentences(spark, sf).select("conv_id", "turn", tokens)


# --- filters ---------------------------------------------------------------------------

@query("flt_nonempty")
def _(spark, sf):
    return tables.wiki_pages(spark, sf).where(tx.is_article(F.col("title"), F.col("text"))).select("doc_id", "title")


@query("flt_redirect")
def _(spark, sf):
    return tables.wiki_pages(spark, sf).where(~tx.is_redirect(F.col("text"))).select("doc_id", "title")


@query("flt_namespace")
def _(spark, sf):
    return tables.wiki_pages(spark, sf).where(~tx.in_skipped_namespace(F.col("title"))).select("doc_id", "title")


@query("flt_min_clean")
def _(spark, sf):
    pages = pinned(tables.wiki_pages(spark, sf), "chars", F.length(tx.clean_text(F.col("text"))))
    return pages.select("doc_id", "chars").where(F.col("chars") > K.MIN_CLEAN_CHARS)


@query("flt_min_words")
def _(spark, sf):
    words = F.size(tx.english_words(tx.clean_text(F.col("text"))))
    return pinned(tables.wiki_pages(spark, sf), "words", words).select("doc_id", "words").where(F.col("words") > K.MIN_ARTICLE_WORDS)


@query("flt_article_cap")
def _(spark, sf):
    return corpus.first_articles(tables.wiki_pages(spark, sf), 100).select("doc_id", F.size("words").alias("words"))


simple("flt_min_freq", lambda spark, sf: corpus.at_least(inputs.vocab(spark, sf), 10))
simple("flt_word_length", lambda spark, sf: ranking.usable_length(inputs.vocab(spark, sf)))


@query("flt_positive_freq")
def _(spark, sf):
    words = _distinct_query_words(spark, sf)
    return lookup.with_frequency(words, inputs.vocab(spark, sf)).where(F.col("freq") > 0)


@query("flt_sample_gate")
def _(spark, sf):
    pairs = inputs.typo_pairs(spark, sf)
    return synth.pass_gate(pairs, inputs.dictionary(spark, sf)).select("correct_word", "incorrect_word", "error_type")


@query("flt_alpha_token")
def _(spark, sf):
    tokens = F.posexplode(tx.sentence_tokens(F.col("sentence"))).alias("pos", "token")
    return inputs.sentences(spark, sf).select("conv_id", "turn", tokens).where(tx.is_checkable(F.col("token")))


def _nullable_pages(spark, sf):
    return tables.wiki_pages(spark, sf).select("doc_id", F.nullif("title", F.lit("")).alias("title"), "text")


@query("dq_dropna")
def _(spark, sf):
    return prepare.drop_nulls(_nullable_pages(spark, sf)).select("doc_id", "title")


@query("dq_dropdup")
def _(spark, sf):
    return prepare.drop_duplicates(tables.table(spark, sf, "documents").select("lang", "text"))


# --- joins -------------------------------------------------------------------------------

def _distinct_query_words(spark, sf):
    return inputs.query_words(spark, sf).select(F.lower("query").alias("word")).distinct()


@query("join_dict_anti")
def _(spark, sf):
    return lookup.unknown(_distinct_query_words(spark, sf), inputs.dictionary(spark, sf))


@query("join_dict_semi")
def _(spark, sf):
    return lookup.known(_distinct_query_words(spark, sf), inputs.dictionary(spark, sf))


@query("join_freq")
def _(spark, sf):
    return lookup.with_frequency(_distinct_query_words(spark, sf), inputs.vocab(spark, sf))


@query("join_candidate_draw")
def _(spark, sf):
    chosen, n, _ = inputs.candidates(spark, sf)
    return synth.candidate_draws(chosen, n, K.ERROR_SAMPLES * K.ATTEMPTS_PER_SAMPLE)


def _unknown_lowers(spark, sf, words):
    return lookup.unknown(_distinct_query_words(spark, sf), words).select(F.col("word").alias("query"))


@query("join_fuzzy")
def _(spark, sf):
    words = inputs.dictionary(spark, sf)
    pairs = fuzzy.fuzzy_join(_unknown_lowers(spark, sf, words), words)
    return pairs.select("query", "word", "freq", "distance")


@query("join_encode")
def _(spark, sf):
    rows, _ = inputs.encoded(spark, sf)
    return rows.select("id", *[f"{c}_encoded" for c in prepare.ENCODED])


@query("join_label_compare")
def _(spark, sf):
    data = inputs.dataset(spark, sf)
    kept = prepare.split_by_group(data).where(F.col("split") == "train")
    return profiles.compare_labels(data, kept)


@query("join_split_back")
def _(spark, sf):
    data = inputs.dataset(spark, sf)
    return prepare.split_rows(data, prepare.split_by_group(data))


# --- aggregations and profiles --------------------------------------------------------------

simple("agg_word_count", inputs.vocab)
simple("agg_accepted_articles", lambda spark, sf: corpus.count_accepted(tables.wiki_pages(spark, sf)))


@query("agg_corpus_totals")
def _(spark, sf):
    totals = corpus.corpus_totals(inputs.staged_vocab(spark, sf))
    listed = F.transform("most_common_10", lambda s: F.concat_ws("=", s["word"], s["freq"].cast("string")))
    return totals.withColumn("most_common_10", F.array_join(listed, ","))


simple("vt_thresholds", lambda spark, sf: corpus.threshold_sizes(inputs.vocab(spark, sf)))
simple("prof_basic", lambda spark, sf: profiles.basic(inputs.vocab(spark, sf)))
simple("prof_length_stats", lambda spark, sf: profiles.length_stats(inputs.vocab(spark, sf)))
simple("prof_length_dist", lambda spark, sf: profiles.length_distribution(inputs.vocab(spark, sf)))
simple("prof_freq_stats", lambda spark, sf: profiles.frequency_stats(inputs.vocab(spark, sf)))
simple("prof_freq_bins", lambda spark, sf: profiles.frequency_bins(inputs.vocab(spark, sf)))
simple("prof_first_letter", lambda spark, sf: profiles.first_letters(inputs.vocab(spark, sf)))
simple("prof_labels", lambda spark, sf: profiles.label_shares(inputs.dataset(spark, sf)))
simple("prof_columns", lambda spark, sf: profiles.column_profile(inputs.dataset(spark, sf)))
simple("prof_describe", lambda spark, sf: profiles.describe(
    inputs.dataset(spark, sf), ["edit_distance", "word_length", "word_frequency"]))
simple("prof_missing", lambda spark, sf: profiles.missing(_nullable_pages(spark, sf)))
simple("prof_duplicates", lambda spark, sf: profiles.duplicates(
    tables.table(spark, sf, "documents").select("lang", "text")))
simple("prof_split_share", lambda spark, sf: profiles.split_shares(
    prepare.split_by_group(inputs.dataset(spark, sf))))


@query("prof_before_after")
def _(spark, sf):
    data = inputs.dataset(spark, sf)
    train = prepare.split_by_group(data).where(F.col("split") == "train")
    return profiles.summary({"before": data, "after": ft.with_features(train)})


@query("prof_summary")
def _(spark, sf):
    data = inputs.dataset(spark, sf)
    parts = stage(prepare.split_by_group(data), "split")
    named = {s: parts.where(F.col("split") == s) for s in ("train", "val", "test")}
    return profiles.summary({"dataset": data} | named)


@query("prof_encoded_counts")
def _(spark, sf):
    rows, _ = inputs.encoded(spark, sf)
    return rows.groupBy(F.col("error_type_encoded").alias("code"), F.col("error_type").alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )


# --- sorts, top-k, sampling --------------------------------------------------------------------

simple("top_dictionary", lambda spark, sf: ranking.top_dictionary(inputs.staged_vocab(spark, sf)))
simple("top_candidates", lambda spark, sf: ranking.top_candidates(inputs.staged_vocab(spark, sf)))
simple("top_words", lambda spark, sf: ranking.top_words(inputs.vocab(spark, sf), 30))
simple("bottom_words", lambda spark, sf: ranking.bottom_words(inputs.vocab(spark, sf)))


@query("sample_without_replacement")
def _(spark, sf):
    chosen, n, _ = inputs.candidates(spark, sf)
    return synth.sample_without_replacement(chosen.select("word", "freq"), K.CORRECT_SAMPLES)


@query("shuffle_renumber")
def _(spark, sf):
    pairs = inputs.typo_pairs(spark, sf).select(
        F.lit(0).cast("bigint").alias("id"), "correct_word", "incorrect_word", "error_type",
        F.levenshtein("correct_word", "incorrect_word").alias("edit_distance"), "word_length",
        F.col("freq").alias("word_frequency"),
    )
    return synth.shuffle_renumber(pairs).select("id", "correct_word", "incorrect_word")


# --- set operations --------------------------------------------------------------------------------

@query("set_union_samples")
def _(spark, sf):
    chosen, n, words = inputs.candidates(spark, sf)
    return synth.union_samples(
        synth.error_samples(chosen, n, words, K.ERROR_SAMPLES), synth.correct_samples(chosen, K.CORRECT_SAMPLES)
    )


@query("set_label_union")
def _(spark, sf):
    data = inputs.dataset(spark, sf)
    label = F.col("error_type")
    return profiles.label_union(data.where(label != "insertion"), data.where(label.isin("insertion", "correct")))


@query("set_word_unique")
def _(spark, sf):
    return corpus.article_words(tables.articles(spark, sf)).select("word").distinct()


# --- synthetic errors ----------------------------------------------------------------------------------

def _generator(name: str, make):
    @query(name)
    def _(spark, sf):
        drawn = typos.with_draws(inputs.vocab(spark, sf), "word", "word")
        edited = drawn.withColumn("_edit", make(F.col("word")))
        return edited.select("word", typos.apply_edit(F.col("word"), F.col("_edit")).alias("out"))


for _kind, _make in typos.GENERATORS.items():
    _generator(f"gen_{_kind}", _make)
simple("gen_type_draw", lambda spark, sf: typos.with_draws(inputs.vocab(spark, sf), "word", "word").select(
    "word", typos.drawn_type().alias("error_type")))


@query("gen_errors")
def _(spark, sf):
    chosen, n, words = inputs.candidates(spark, sf)
    return synth.error_samples(chosen, n, words, K.ERROR_SAMPLES)


@query("gen_correct")
def _(spark, sf):
    chosen, n, _ = inputs.candidates(spark, sf)
    return synth.correct_samples(chosen, K.CORRECT_SAMPLES)


simple("gen_dataset", inputs.dataset)


# --- features ----------------------------------------------------------------------------------------------

FEATURE_QUERIES = {
    "ft_num_vowels": "num_vowels", "ft_num_consonants": "num_consonants", "ft_vowel_ratio": "vowel_ratio",
    "ft_consonant_ratio": "consonant_ratio", "ft_first_char": "first_char", "ft_last_char": "last_char",
    "ft_first_bigram": "first_bigram", "ft_last_bigram": "last_bigram", "ft_first_trigram": "first_trigram",
    "ft_last_trigram": "last_trigram", "ft_first_bigram_common": "first_bigram_common",
    "ft_last_bigram_common": "last_bigram_common", "ft_has_double": "has_double_letters",
    "ft_num_double": "num_double_letters", "ft_repeated_vowels": "has_repeated_vowels",
    "ft_is_alternating": "is_alternating", "ft_syllables": "syllable_count",
    "ft_syllable_ratio": "syllable_ratio", "ft_max_consonant_cluster": "max_consonant_cluster",
    "ft_max_vowel_cluster": "max_vowel_cluster", "ft_char_diversity": "char_diversity",
    "ft_unique_vowels": "unique_vowels", "ft_unique_consonants": "unique_consonants",
    "ft_starts_vowel": "starts_with_vowel", "ft_ends_vowel": "ends_with_vowel",
    "ft_middle_char": "middle_char", "ft_middle_is_vowel": "middle_is_vowel",
}


def _feature(name: str, feature: str):
    @query(name)
    def _(spark, sf):
        value = ft.DERIVED[feature](F.col("incorrect_word"), F.col("word_length"))
        return inputs.typo_pairs(spark, sf).select("correct_word", "incorrect_word", value.alias(feature))


for _name, _f in FEATURE_QUERIES.items():
    _feature(_name, _f)

simple("ft_all", lambda spark, sf: ft.with_features(inputs.dataset(spark, sf)))


@query("ft_select")
def _(spark, sf):
    rows, _ = inputs.encoded(spark, sf)
    return prepare.training_columns(rows)


PAIR_QUERIES = {
    "fp_edit_distance": "edit_distance", "fp_log_frequency": "log_frequency",
    "fp_error_position": "error_position", "fp_error_position_ratio": "error_position_ratio",
    "fp_error_on_vowel": "error_on_vowel", "fp_error_at_beginning": "error_at_beginning",
    "fp_freq_bin": "freq_bin", "fp_levenshtein_ratio": "levenshtein_ratio",
    "fp_jaro_winkler": "jaro_similarity",
}


def _pair_feature(name: str, feature: str):
    @query(name)
    def _(spark, sf):
        value = fp.PAIR[feature](F.col("correct_word"), F.col("incorrect_word"), F.col("freq"))
        return inputs.typo_pairs(spark, sf).select("correct_word", "incorrect_word", value.alias(feature))


for _name, _f in PAIR_QUERIES.items():
    _pair_feature(_name, _f)


@query("fp_ord_codes")
def _(spark, sf):
    codes = fp.ord_codes(F.col("word"))
    return inputs.vocab(spark, sf).select("word", *[v.alias(k) for k, v in codes.items()])


@query("fp_serve_row")
def _(spark, sf):
    row = fp.serve_row(F.col("word"))
    return inputs.vocab(spark, sf).select("word", *[v.alias(k) for k, v in row.items()])


simple("fx_char_entropy", lambda spark, sf: inputs.vocab(spark, sf).select(
    "word", extras.char_entropy(F.col("word")).alias("char_entropy")))
simple("fx_bigram_trigram_count", lambda spark, sf: inputs.vocab(spark, sf).select(
    "word", extras.gram_count(F.col("word"), 2).alias("bigrams"), extras.gram_count(F.col("word"), 3).alias("trigrams")))
simple("fx_vowel_position", lambda spark, sf: inputs.vocab(spark, sf).select(
    "word", extras.vowel_position_mean(F.col("word")).alias("vowel_pos_mean"),
    extras.vowel_position_variance(F.col("word")).alias("vowel_pos_var")))
simple("fx_char_freq", lambda spark, sf: extras.char_frequency(inputs.staged_vocab(spark, sf)))


@query("fx_tfidf_chars")
def _(spark, sf):
    words = inputs.staged_vocab(spark, sf)
    return extras.tfidf(words, stage(extras.gram_vocabulary(words), "grams"))


@query("fx_feature_score")
def _(spark, sf):
    rows, _ = inputs.encoded(spark, sf)
    return extras.feature_scores(rows, K.FEATURES)


# --- encoding, scaling, splitting ------------------------------------------------------------------------------

@query("enc_label")
def _(spark, sf):
    return prepare.encoder_table(inputs.dataset(spark, sf), ("error_type",))


@query("enc_categorical")
def _(spark, sf):
    rows, _ = inputs.encoded(spark, sf)
    return rows.select("id", *K.CATEGORICAL, *[f"{c}_encoded" for c in K.CATEGORICAL])


@query("enc_export")
def _(spark, sf):
    return prepare.encoder_table(ft.with_features(inputs.dataset(spark, sf)))


@query("scale_standard")
def _(spark, sf):
    rows, _ = inputs.encoded(spark, sf)
    rows = stage(rows, "encoded")
    return prepare.scale(rows, prepare.scaler_table(rows)).select("id", *K.FEATURES)


simple("split_group", lambda spark, sf: prepare.split_by_group(inputs.dataset(spark, sf)).select(
    "id", "correct_word", "split"))
simple("split_no_leak_check", lambda spark, sf: prepare.leak_check(
    prepare.split_by_group(inputs.dataset(spark, sf))))


# --- models -------------------------------------------------------------------------------------------------------

def _xy(spark, sf):
    return models.load_xy(inputs.prepared(spark, sf)[0])


@query("ml_load_xy")
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    return _xy(spark, sf).select("id", "split", "label", F.array_size(vector_to_array("features")).alias("features"))


simple("ml_class_weight", lambda spark, sf: models.class_weights(inputs.dataset(spark, sf), "error_type"))


def _checked(preds: DataFrame) -> DataFrame:
    """(model, split, label, rows, valid, better): predictions per label; ``valid`` ones name a class and have probabilities that
    sum to one, ``better`` is whether more rows of the split are right than lie in its largest class.
    """
    valid = F.col("prediction").between(0, len(inputs.CLASSES) - 1) & (F.abs(F.aggregate("probabilities", F.lit(0.0), lambda s, v: s + v) - 1) < 1e-9)
    counted = preds.groupBy("model", "split", "label").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(valid).alias("valid"), F.count_if(F.col("label") == F.col("prediction")).alias("hits")
    )
    whole = Window.partitionBy("model", "split")
    return counted.withColumn("better", F.sum("hits").over(whole) > F.max("rows").over(whole)).drop("hits")


def _train_rows(spark, sf):
    xy = stage(_xy(spark, sf), "model-rows")
    return xy, xy.where(F.col("split") == "train")


@query("ml_random_search")
def _(spark, sf):
    """The ledger of a search by rung, after the search has been run again on it."""
    _, train = _train_rows(spark, sf)
    path = fresh_path(spark, "search")
    settings = models.SEARCH_SETTINGS["forest"]
    first = models.search_forest(train, "smoke", settings, path)
    again = models.search_forest(train, "smoke", settings, path)
    ledger = search.read_ledger(spark, path)
    return ledger.groupBy("rung").agg(
        F.countDistinct("setting").alias("settings"), F.count(F.lit(1)).alias("measurements"),
        F.count_if(F.col("f1").between(0, 1) & (F.col("seconds") > 0)).alias("valid"),
        F.lit(first.setting == again.setting and first.f1 == again.f1).alias("taken_over"),
    )


def _trained(name, train):
    @query(name)
    def _(spark, sf):
        xy, rows = _train_rows(spark, sf)
        return _checked(models.predictions(train(xy, rows), xy, name))


_trained("ml_rf", lambda xy, train: models.train_forest(train, "short", 3))
_trained("ml_gbt_level", lambda xy, train: models.train_boost_searched(train, len(inputs.CLASSES), "short", 3))


@query("ml_gbt_fixed")
def _(spark, sf):
    """As the others, and whether the kept round is the first one of the smallest validation loss."""
    xy, _ = _train_rows(spark, sf)
    model = models.train_boost_fixed(xy, len(inputs.CLASSES), "short")
    curve = model.curve(spark)
    first = curve.agg(F.min_by("round", F.struct("loss", "round"))).scalar()
    kept = curve.where("kept").agg(F.max("round")).scalar()
    return _checked(models.predictions(model, xy, "ml_gbt_fixed")).withColumn("best_round_kept", kept == first)


@query("ml_importance")
def _(spark, sf):
    """Every feature, whether its importance is a share, and whether all shares sum to one."""
    _, train = _train_rows(spark, sf)
    shares = stage(models.importance(models.train_forest(train, "smoke", 1), spark), "importance")
    total = shares.agg(F.sum("importance")).scalar()
    return shares.select("feature", F.col("importance").between(0, 1).alias("is_share"), (F.abs(total - 1) < 1e-9).alias("sums_to_one"))


@query("ml_predict")
def _(spark, sf):
    """Probabilities in long form, summed up: rows per class, and ids whose classes sum to one."""
    xy, _ = _train_rows(spark, sf)
    model = models.train_boost_fixed(xy, len(inputs.CLASSES), "smoke")
    long = models.probability_rows(models.predictions(model, xy, "boost_fixed"))
    of_id = long.groupBy("model", "id").agg(F.sum("p").alias("total"), F.count(F.lit(1)).alias("classes"))
    return of_id.groupBy("model").agg(
        F.count(F.lit(1)).alias("ids"), F.sum("classes").alias("probabilities"), F.count_if(F.abs(F.col("total") - 1) < 1e-9).alias("whole")
    )


def _val_metrics(spark, sf):
    preds = inputs.rule_predictions(spark, sf)
    return preds, ev.metrics(preds.where(F.col("split") == "val"))


@query("ens_weights")
def _(spark, sf):
    return ensemble.vote_weights(_val_metrics(spark, sf)[1])


def _vote(spark, sf):
    preds, scores = _val_metrics(spark, sf)
    weights = stage(ensemble.vote_weights(scores), "weights")
    return preds, ensemble.soft_vote(inputs.rule_probabilities(preds), weights)


@query("ens_soft_vote")
def _(spark, sf):
    return _vote(spark, sf)[1]


@query("ens_improvement")
def _(spark, sf):
    preds, votes = _vote(spark, sf)
    truth = preds.where(F.col("model") == inputs.RULES[0]).select("id", "split", "label")
    voted = truth.join(votes.select("id", "prediction"), "id").select(
        F.lit("ensemble").alias("model"), "id", "split", "label", "prediction"
    )
    both = preds.unionByName(voted).where(F.col("split") == "val")
    return ensemble.improvement(ev.metrics(both))


# --- evaluation ----------------------------------------------------------------------------------------------------

def _one_rule(spark, sf):
    return inputs.rule_predictions(spark, sf).where(F.col("model") == "noisy_rule")


simple("ev_accuracy", lambda spark, sf: ev.accuracy(_one_rule(spark, sf)))
simple("ev_confusion", lambda spark, sf: ev.confusion_matrix(_one_rule(spark, sf), list(inputs.CLASSES)))
simple("ev_confusion_norm", lambda spark, sf: ev.confusion_shares(_one_rule(spark, sf)))
simple("ev_per_class", lambda spark, sf: ev.per_class(_one_rule(spark, sf)))
simple("ev_macro_weighted", lambda spark, sf: ev.averages(_one_rule(spark, sf)))
simple("ev_gap", lambda spark, sf: ev.train_val_gap(inputs.rule_predictions(spark, sf)))
simple("ev_compare", lambda spark, sf: ev.compare(inputs.rule_predictions(spark, sf)))
simple("ev_best_model", lambda spark, sf: ev.best_model(ev.compare(inputs.rule_predictions(spark, sf))))
simple("ev_final_report", lambda spark, sf: ev.final_report(inputs.rule_predictions(spark, sf)))


# --- correction -------------------------------------------------------------------------------------------------------

@query("cor_exact")
def _(spark, sf):
    marked = correct.mark_exact(inputs.query_words(spark, sf), inputs.dictionary(spark, sf))
    return correct.exact_rows(marked)


@query("cor_score")
def _(spark, sf):
    pairs = inputs.typo_pairs(spark, sf)
    wrong, right = F.col("incorrect_word"), F.col("correct_word")
    value = correct.score(wrong, right, F.levenshtein(wrong, right), F.col("freq"))
    return pairs.select("correct_word", "incorrect_word", value.alias("score"))


@query("cor_candidates")
def _(spark, sf):
    return correct.find_corrections(inputs.query_words(spark, sf), inputs.dictionary(spark, sf))


@query("cor_none")
def _(spark, sf):
    rows = correct.find_corrections(inputs.query_words(spark, sf), inputs.dictionary(spark, sf), top_n=1)
    return rows.where(F.col("distance") == -1).select("query", "word", "distance", "frequency", "score")


@query("topn_corrections")
def _(spark, sf):
    words = inputs.dictionary(spark, sf)
    pairs = fuzzy.fuzzy_join(_unknown_lowers(spark, sf, words), words)
    return correct.top_corrections(pairs)


def _listed(checked: DataFrame) -> DataFrame:
    listed = F.transform("corrections", lambda c: F.concat_ws(":", c["word"], c["distance"].cast("string"), c["frequency"].cast("string")))
    return checked.withColumn("corrections", F.array_join(listed, ","))


@query("cor_word")
def _(spark, sf):
    requests = inputs.query_words(spark, sf).select(F.col("query").alias("word"))
    return _listed(correct.check_words(requests, inputs.dictionary(spark, sf)))


@query("cor_case")
def _(spark, sf):
    words = inputs.query_words(spark, sf)
    return words.select("query", correct.in_case_of(F.col("query"), F.lower("query")).alias("out"))


@query("cor_position")
def _(spark, sf):
    s = inputs.sentences(spark, sf).select("conv_id", "turn", tx.strip(F.col("sentence")).alias("sentence"))
    tokens = s.select("*", F.posexplode(tx.sentence_tokens(F.col("sentence"))).alias("pos", "token"))
    return tokens.select(
        "conv_id", "turn", "pos", correct.first_position(F.col("sentence"), F.col("token")).alias("position")
    )


@query("cor_rejoin")
def _(spark, sf):
    s = inputs.sentences(spark, sf)
    return s.select("conv_id", "turn", tx.rejoin(tx.sentence_tokens(tx.strip(F.col("sentence")))).alias("out"))


def _flat_errors(checked: DataFrame) -> DataFrame:
    listed = F.transform(
        "errors",
        lambda e: F.concat_ws(
            ":", e["original"], e["correction"], *[e[c].cast("string") for c in ("distance", "position", "token_index")]
        ),
    )
    return checked.withColumn("errors", F.array_join(listed, ","))


@query("cor_sentence")
def _(spark, sf):
    checked = correct.check_sentences(
        inputs.sentences(spark, sf), ["conv_id", "turn"], inputs.dictionary(spark, sf)
    )
    return _flat_errors(checked)


def _dictionary_and_typer(spark, sf):
    """Both from one staged vocabulary, so the corpus is counted once."""
    words = inputs.staged_vocab(spark, sf)
    return inputs.dictionary_of(words), inputs.trained_bundle(spark, sf, words=words)[0].typer("boost_fixed")


def _is_type(kind: Column, confidence: Column) -> Column:
    return kind.isin(*inputs.CLASSES) & confidence.between(1 / len(inputs.CLASSES), 1)


@query("cor_error_type")
def _(spark, sf):
    """The best correction of every unknown word, and whether it has a type, a confidence and whole probabilities."""
    words, typer = _dictionary_and_typer(spark, sf)
    pairs = fuzzy.fuzzy_join(_unknown_lowers(spark, sf, words), words)
    best = stage(correct.top_corrections(pairs, 1).select(
        F.col("word").alias("correct_word"), F.col("query").alias("incorrect_word"), "distance"
    ), "best")
    typed = models.error_types(best, typer)
    total = F.aggregate(F.map_values("probabilities"), F.lit(0.0), lambda s, v: s + v)
    is_typed = _is_type(F.col("error_type"), F.col("confidence")) & (F.abs(total - 1) < 1e-9)
    return best.join(typed.withColumn("typed", is_typed), ["correct_word", "incorrect_word"]).select("correct_word", "incorrect_word", "distance", "typed")


@query("cor_word_typed")
def _(spark, sf):
    """``cor_word`` with error types: each word that has a correction has a type."""
    requests = inputs.query_words(spark, sf).select(F.col("query").alias("word"))
    words, typer = _dictionary_and_typer(spark, sf)
    checked = correct.check_words(requests, words, typer=typer)
    typed = F.coalesce(_is_type(F.col("error_type"), F.col("confidence")), F.lit(False))
    return _listed(checked.withColumn("typed", typed)).select("word", "status", "is_correct", "corrections", "typed")


def _typed_errors(checked: DataFrame) -> DataFrame:
    typed = F.size(F.filter("errors", lambda e: _is_type(e["error_type"], e["confidence"])))
    return _flat_errors(checked.withColumn("typed", typed))


@query("cor_sentence_typed")
def _(spark, sf):
    """``cor_sentence`` with the number of errors that have a type."""
    words, typer = _dictionary_and_typer(spark, sf)
    return _typed_errors(correct.check_sentences(inputs.sentences(spark, sf), ["conv_id", "turn"], words, typer=typer))


# --- streaming -----------------------------------------------------------------------------------------------------------

simple("st_word_count", lambda spark, sf: word_stream.run_word_count(word_stream.article_stream(spark, sf)))
simple("st_snapshot", lambda spark, sf: word_stream.run_snapshots(word_stream.article_stream(spark, sf), every=200))
simple("st_snapshot_blocks", lambda spark, sf: corpus.snapshots(tables.articles(spark, sf), every=200))


@query("st_correct")
def _(spark, sf):
    turns = sentence_stream.sentence_stream(spark, sf, "conversations").select(
        "conv_id", "turn", F.col("text").alias("sentence")
    )
    return _flat_errors(
        sentence_stream.run_corrections(turns, ["conv_id", "turn"], inputs.dictionary(spark, sf))
    )


@query("st_correct_typed")
def _(spark, sf):
    turns = sentence_stream.sentence_stream(spark, sf, "conversations").select("conv_id", "turn", F.col("text").alias("sentence"))
    words, typer = _dictionary_and_typer(spark, sf)
    return _typed_errors(sentence_stream.run_corrections(turns, ["conv_id", "turn"], words, typer))
