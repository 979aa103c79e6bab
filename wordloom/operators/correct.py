"""Correction of words and sentences against a dictionary (word, freq)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wordloom import constants as K
from wordloom.functions import text as tx
from wordloom.functions.strings import bind, jaro_winkler
from wordloom.operators.fuzzy import fuzzy_join
from wordloom.operators.lookup import left_lookup
from wordloom.staging import stage

_JARO_WEIGHT = 2000


def base_score(query: Column, word: Column, distance: Column, freq: Column, max_distance: int) -> Column:
    """All parts of the score except the similarity term."""
    n, m = F.length(query), F.length(word)
    length = F.when(n == m, 5000).when(F.abs(n - m) == 1, 2000).otherwise(0)
    first = F.when(F.substring(query, 1, 1) == F.substring(word, 1, 1), 3000).otherwise(0)
    last = F.when(F.right(query, F.lit(1)) == F.right(word, F.lit(1)), 1500).otherwise(0)
    return (
        (max_distance - distance + 1) * 10000
        + F.least(freq, F.lit(50000)) / 10
        + length + first + last
    )


def score(query: Column, word: Column, distance: Column, freq: Column, max_distance: int = K.MAX_DISTANCE) -> Column:
    return base_score(query, word, distance, freq, max_distance) + jaro_winkler(query, word) * _JARO_WEIGHT


def top_corrections(pairs: DataFrame, top_n: int = K.TOP_CORRECTIONS, max_distance: int = K.MAX_DISTANCE) -> DataFrame:
    """Best ``top_n`` per query by score, ties by word.

    The similarity term adds between 0 and 2000. A candidate whose base score
    is more than 2000 below the top_n-th base score can never enter the list,
    so the similarity is computed for the others only. This loses nothing.
    """
    base = base_score(F.col("query"), F.col("word"), F.col("distance"), F.col("freq"), max_distance)
    per_query = W.partitionBy("query")
    placed = pairs.withColumn("_base", base).withColumn(
        "_place", F.row_number().over(per_query.orderBy(F.desc("_base")))
    )
    bar = F.max(F.when(F.col("_place") == top_n, F.col("_base"))).over(per_query)
    in_reach = placed.withColumn("_bar", bar).where(
        F.col("_bar").isNull() | (F.col("_base") + _JARO_WEIGHT >= F.col("_bar"))
    )
    scored = in_reach.withColumn(
        "score", F.col("_base") + jaro_winkler(F.col("query"), F.col("word")) * _JARO_WEIGHT
    )
    best = per_query.orderBy(F.desc("score"), "word")
    return (
        scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_n)
        .select("query", "rank", "word", "distance", "freq", "score")
    )


def mark_exact(queries: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(query, lower, dict_freq): ``dict_freq`` is null for unknown words."""
    words = dictionary.select(F.col("word").alias("lower"), F.col("freq").alias("dict_freq"))
    return queries.select("query", F.lower("query").alias("lower")).join(words, "lower", "left")


def exact_rows(marked: DataFrame) -> DataFrame:
    return marked.where(F.col("dict_freq").isNotNull()).select(
        "query", F.lit(1).alias("rank"), F.col("query").alias("word"), F.lit(0).alias("distance"),
        F.col("dict_freq").alias("frequency"), F.lit(True).alias("is_correct"),
        F.lit(K.EXACT_SCORE).alias("score"),
    )


def find_corrections(
    queries: DataFrame, dictionary: DataFrame, top_n: int = K.TOP_CORRECTIONS,
    max_distance: int = K.MAX_DISTANCE, keys: DataFrame | None = None,
) -> DataFrame:
    """(query, rank, word, distance, frequency, is_correct, score) for distinct queries.

    Known words return themselves; unknown words without a candidate return
    themselves at distance -1.
    """
    marked = stage(mark_exact(queries, dictionary), "marked")
    unknown = marked.where(F.col("dict_freq").isNull())
    lowers = unknown.select(F.col("lower").alias("query")).distinct()
    best = top_corrections(fuzzy_join(lowers, dictionary, max_distance, keys), top_n, max_distance)
    best = best.withColumnRenamed("query", "lower")
    found = unknown.join(best, "lower", "left").select(
        "query",
        F.coalesce("rank", F.lit(1)).alias("rank"),
        F.coalesce("word", "query").alias("word"),
        F.coalesce("distance", F.lit(-1)).alias("distance"),
        F.coalesce("freq", F.lit(0).cast("bigint")).alias("frequency"),
        F.lit(False).alias("is_correct"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
    return exact_rows(marked).unionByName(found)


def with_error_types(rows: DataFrame, typer, right: str, wrong: str) -> DataFrame:
    """Add ``error_type``, ``confidence`` and ``probabilities`` of each (right, wrong) pair; null without a pair."""
    from wordloom.operators.models import error_types

    pairs = rows.select(F.col(right).alias("correct_word"), F.col(wrong).alias("incorrect_word"))
    typed = error_types(pairs.where("correct_word IS NOT NULL AND incorrect_word IS NOT NULL"), typer)
    typed = stage(typed.withColumnsRenamed({"correct_word": "_right", "incorrect_word": "_wrong"}), "types")
    return rows.join(typed, (F.col(right) == F.col("_right")) & (F.col(wrong) == F.col("_wrong")), "left").drop("_right", "_wrong")


def check_words(
    requests: DataFrame, dictionary: DataFrame, top_n: int = K.TOP_CORRECTIONS, keys: DataFrame | None = None, typer=None
) -> DataFrame:
    """(word, status, is_correct, corrections) per distinct requested word.

    With ``typer``, an ``ErrorTyper``, also ``error_type``, ``confidence`` and ``probabilities`` of the best correction.

    ``corrections`` is empty for known words and for words without candidates;
    blank requests yield ``status='empty'`` and nulls.
    """
    words = requests.select(tx.strip(F.col("word")).alias("query")).distinct()
    filled = words.where(F.col("query") != "")
    rows = find_corrections(filled, dictionary, top_n, keys=keys)
    entry = F.struct("rank", "word", "distance", "frequency", "score")
    kept = F.when(~F.col("is_correct") & (F.col("distance") >= 0), entry)
    listed = F.transform(
        F.sort_array(F.collect_list(kept)),
        lambda s: F.struct(*[s[c].alias(c) for c in ("word", "distance", "frequency", "score")]),
    )
    answered = rows.groupBy("query").agg(
        F.bool_or("is_correct").alias("is_correct"), listed.alias("corrections")
    )
    # A null request is as blank as an empty one.
    blank = words.where(F.coalesce("query", F.lit("")) == "").select(
        F.col("query").alias("word"), F.lit("empty").alias("status"),
        F.lit(None).cast("boolean").alias("is_correct"),
        F.lit(None).cast(answered.schema["corrections"].dataType).alias("corrections"),
    )
    checked = answered.select(
        F.col("query").alias("word"), F.lit("ok").alias("status"), "is_correct", "corrections"
    ).unionByName(blank)
    if typer is None:
        return checked
    sides = checked.withColumn("_best", F.get("corrections", F.lit(0))["word"]).withColumn("_lower", F.lower("word"))
    return with_error_types(sides, typer, "_best", "_lower").drop("_best", "_lower")


def in_case_of(token: Column, correction: Column) -> Column:
    return F.when(token.rlike(r"^\p{Lu}"), F.initcap(correction)).otherwise(correction)


def first_position(sentence: Column, token: Column) -> Column:
    """0-based place of the first occurrence, case-insensitive; repeats share it."""
    return F.call_function("instr", F.lower(sentence), F.lower(token)) - 1


def unknown_tokens(
    sentences: DataFrame, ids: list[str], dictionary: DataFrame, preserve_apostrophe: bool = False
) -> DataFrame:
    """(ids, token_index, token, lower) of letter tokens that the dictionary lacks."""
    tokens = tx.sentence_tokens(F.col("sentence"), preserve_apostrophe)
    exploded = sentences.select(*ids, F.posexplode(tokens).alias("token_index", "token"))
    letters = exploded.where(tx.is_checkable(F.col("token"))).withColumn("lower", F.lower("token"))
    return letters.join(dictionary.select(F.col("word").alias("lower")), "lower", "left_anti")


def unknown_words(sentences: DataFrame, dictionary: DataFrame, preserve_apostrophe: bool = False) -> DataFrame:
    """(lower): the distinct words of (sentence) that the dictionary lacks."""
    stripped = sentences.select(tx.strip(F.col("sentence")).alias("sentence"))
    return unknown_tokens(stripped, [], dictionary, preserve_apostrophe).select("lower").distinct()


def best_fixes(words: DataFrame, dictionary: DataFrame, keys: DataFrame | None = None, typer=None) -> DataFrame:
    """(lower, best, distance) of the words (lower) that have a correction; with ``typer`` also ``error_type`` and ``confidence``."""
    best = top_corrections(fuzzy_join(words.select(F.col("lower").alias("query")), dictionary, keys=keys), 1)
    fixes = best.select(F.col("query").alias("lower"), F.col("word").alias("best"), "distance")
    if typer is None:
        return fixes
    return with_error_types(stage(fixes, "untyped"), typer, "best", "lower").drop("probabilities")


def sentence_errors(
    sentences: DataFrame, ids: list[str], dictionary: DataFrame,
    keys: DataFrame | None = None, preserve_apostrophe: bool = False, typer=None, fixes: DataFrame | None = None,
) -> DataFrame:
    """(ids, token_index, original, lower, best, correction, distance), one row per corrected token.

    Only unknown tokens leave their sentence; each distinct one is searched once. ``fixes``, a staged table of
    ``best_fixes``, takes the place of the search.
    """
    tokens = stage(unknown_tokens(sentences, ids, dictionary, preserve_apostrophe), "unknown")
    if fixes is None:
        fixes = stage(best_fixes(tokens.select("lower").distinct(), dictionary, keys, typer), "fixes")
    return (
        left_lookup(tokens, fixes, "lower").where(F.col("best").isNotNull())
        .withColumnRenamed("token", "original")
        .withColumn("correction", in_case_of(F.col("original"), F.col("best")))
    )


def _patched(tokens: Column, errors: Column) -> Column:
    """Tokens with the corrections put in: the stretches between errors, joined back."""

    def stretch(e: Column, k: Column) -> Column:
        begin = F.when(k == 0, F.lit(0)).otherwise(F.get(errors, k - 1)["token_index"] + 1)
        return F.concat(F.slice(tokens, begin + 1, e["token_index"] - begin), F.array(e["correction"]))

    done = F.get(errors, F.size(errors) - 1)["token_index"] + 1
    rest = F.slice(tokens, done + 1, F.greatest(F.size(tokens) - done, F.lit(0)))
    return F.concat(F.flatten(F.transform(errors, stretch)), rest)


def check_sentences(
    sentences: DataFrame, ids: list[str], dictionary: DataFrame,
    keys: DataFrame | None = None, preserve_apostrophe: bool = False, typer=None, fixes: DataFrame | None = None,
) -> DataFrame:
    """(ids, status, original_sentence, corrected_sentence, has_errors, num_errors, errors).

    With ``typer``, an ``ErrorTyper``, each error also has its ``error_type`` and ``confidence``; with ``fixes`` see
    ``sentence_errors``. Null ids are ids like any other, and sentences that share their ids are checked apart.
    """
    text = tx.strip(F.col("sentence"))
    stripped = sentences.select(*ids, text.alias("sentence"), F.xxhash64(text).alias("_row"))
    errors = sentence_errors(stripped, [*ids, "_row"], dictionary, keys, preserve_apostrophe, typer, fixes)
    more = [c for c in ("error_type", "confidence") if c in errors.columns]
    # Repeated rows have equal errors, each token index once.
    per_sentence = errors.groupBy(*ids, "_row").agg(
        F.sort_array(
            F.collect_set(F.struct("token_index", "original", "correction", "distance", *more))
        ).alias("_errors")
    )
    keyed = per_sentence.withColumnsRenamed({c: f"_key_{c}" for c in ids} | {"_row": "_key_row"})
    same = F.col("_row") == F.col("_key_row")
    for c in ids:
        same = same & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
    joined = stripped.join(keyed, same, "left")
    sentence, found = F.col("sentence"), F.col("_errors")
    tokens = tx.sentence_tokens(sentence, preserve_apostrophe)
    patched = bind(tokens, lambda t: F.when(found.isNull(), t).otherwise(_patched(t, found)))
    located = bind(
        F.lower(sentence),
        lambda low: F.transform(
            found,
            lambda e: F.struct(
                e["original"].alias("original"), e["correction"].alias("correction"),
                e["distance"].alias("distance"),
                (F.call_function("instr", low, F.lower(e["original"])) - 1).alias("position"),
                e["token_index"].alias("token_index"),
                *[e[c].alias(c) for c in more],
            ),
        ),
    )
    filled = F.coalesce(sentence, F.lit("")) != ""
    count = F.when(filled, F.coalesce(F.size(found), F.lit(0)))
    return joined.select(
        *ids,
        F.when(filled, "ok").otherwise("empty").alias("status"),
        sentence.alias("original_sentence"),
        F.when(filled, tx.rejoin(patched)).alias("corrected_sentence"),
        (count > 0).alias("has_errors"),
        count.alias("num_errors"),
        F.when(filled, F.coalesce(located, F.array().cast(
            "array<struct<original:string,correction:string,distance:int,position:int,token_index:int"
            + (",error_type:string,confidence:double" if more else "") + ">>"
        ))).alias("errors"),
    )
