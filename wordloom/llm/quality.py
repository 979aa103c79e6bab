"""Quality rules: plain counts, and the fertility of a public tokenizer within bands.

Fertility is measured per text with a public vocabulary, word by word through a bounded cache:
tokens per word, characters per token, share of byte-fallback tokens, and token entropy in bits. Each
language (for a null language, the commonest script of the text's letters) has bands per measure, by
length of text, since entropy grows with it: median plus or minus
``WIDTH`` standard deviations, estimated from the median absolute deviation, and at least
``LEAST`` of slack. Medians are exact, from counts of measures rounded to
hundredths, over all texts that pass the plain rules. With fewer than ``FEW`` such texts of a
length the band of the language is used, with fewer of the language that of all texts.

Defined results: a null text has no words, lines or symbols and fails the plain rules; texts without a token
have no measures; repeated rows each give their own result; columns named as those that are added are replaced, all others stay.

The width is a trade: on labelled rows of the test tables that pass the plain rules, bands of 6, 4 and 3 deviations keep 24, 6 and
2 % of the texts labelled bad and lose 0.1, 1 and 1.5 % of the good ones.
"""

from __future__ import annotations

import functools
import unicodedata
from collections import Counter

import numpy as np
import sentencepiece
from public_tokenizers import path as public_path
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wordloom.llm.common import BoundedCache, add_columns, documents, nested, without, worker_cache, words_of
from wordloom.staging import stage

SYMBOLS = "#*$%&|<>"
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
#: Half width of a band in standard deviations, least slack by measure, texts of a language that make its own band.
WIDTH, FEW = 4.0, 50
LEAST = {"tokens_per_word": 0.4, "chars_per_token": 0.25, "byte_share": 0.02, "entropy": 0.4}
_CACHE_WORDS = 120_000


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words within windows that occur more than once in the text, first occurrence included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    sums = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(window):
            sums = sums * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n]
    _, back, counts = np.unique(sums, return_inverse=True, return_counts=True)
    maybe = np.flatnonzero(counts[back] > 1)
    if len(maybe) == 0:
        return 0
    found = Counter(tuple(words[i : i + window]) for i in maybe.tolist())
    steps = np.zeros(len(words) + 1, np.int64)
    for i in maybe.tolist():
        if found[tuple(words[i : i + window])] > 1:
            steps[i] += 1
            steps[i + window] -= 1
    return int((np.cumsum(steps) > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def _script(text: str) -> str:
    """Commonest script of the letters, by the first word of their Unicode names."""
    letters = Counter(c for c in text if c.isalpha())
    scripts: Counter = Counter()
    for c, n in letters.items():
        scripts[unicodedata.name(c, "UNKNOWN").split(" ")[0]] += n
    return "script " + (min(scripts, key=lambda s: (-scripts[s], s)) if scripts else "none")


@functools.cache
def _word_cache(path: str) -> BoundedCache:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return BoundedCache(lambda w: np.array(model.encode(w), dtype=np.uint16).tobytes(), _CACHE_WORDS)


@functools.cache
def _byte_ids(path: str) -> np.ndarray:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return np.array([model.is_byte(i) for i in range(model.get_piece_size())])


def measures(df: DataFrame, path: str, text: str = "text", lang: str = "lang") -> DataFrame:
    """Add the plain counts, ``group`` (language or script) and the measures; ``text`` is left out."""

    def start():
        worker_cache("quality", _word_cache.cache_clear)
        known, is_byte = _word_cache(path).__getitem__, _byte_ids(path)

        def one(t: str | None, group: str | None) -> tuple:
            t = t or ""
            words = words_of(t)
            ids = np.frombuffer(b"".join(map(known, words)), np.uint16)
            chars = sum(map(len, words))
            per_word = per_token = share = entropy = None
            if len(ids):
                counts = np.unique(ids, return_counts=True)[1] / len(ids)
                per_word, per_token, share = len(ids) / len(words), chars / len(ids), float(is_byte[ids].mean())
                entropy = float(-(counts * np.log2(counts)).sum())
            return (
                len(words), chars, sum(map(t.count, SYMBOLS)), duplicate_lines(t), repeated_words(words),
                group or _script(t), len(ids), per_word, per_token, share, entropy,
            )

        return lambda texts, groups: list(zip(*map(one, texts, groups))) or [[]] * 11

    fields = (
        "n_words BIGINT, word_chars BIGINT, n_symbols BIGINT, n_dup_lines BIGINT, n_repeat_words BIGINT, "
        "group STRING, n_tokens BIGINT, tokens_per_word DOUBLE, chars_per_token DOUBLE, byte_share DOUBLE, entropy DOUBLE"
    )
    return add_columns(df, [text, lang], fields, start, drop=[text])


def _median(counts: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Lower median of ``value`` weighted by n, per ``keys``: values are rounded, so a window holds few rows."""
    inside = Window.partitionBy(*keys)
    so_far = F.sum("n").over(inside.orderBy(value))
    total = F.sum("n").over(inside)
    return (
        counts.select(*keys, value, so_far.alias("below"), total.alias("total")).where(F.col("below") * 2 >= F.col("total"))
        .groupBy(*keys).agg(F.min(value).alias(out), F.first("total").alias("texts"))
    )


def _band_keys() -> list[Column]:
    """Names of a text's bands, narrowest first: language and length, language, all."""
    lang = F.concat(F.lit("="), F.col("group"))
    return [F.concat(lang, F.lit(" "), F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))).cast("string")), lang, F.lit("")]


def bands(measured: DataFrame) -> DataFrame:
    """(band, low and high of each measure)."""
    value = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.round(F.col(m) * 100).cast("long").alias("bin")) for m in LEAST]))
    good = measured.where(~F.col("base_failed") & (F.col("n_tokens") > 0)).select(F.array(*_band_keys()).alias("bands"), value.alias("v"))
    each = good.groupBy("bands", "v").agg(F.count("*").alias("n")).select(F.explode("bands").alias("band"), "v.*", "n")
    counts = stage(each.groupBy("band", "measure", "bin").agg(F.sum("n").alias("n")), "quality-counts")
    keys = ["band", "measure"]
    middle = _median(counts, keys, "bin", "middle")
    away = counts.join(middle, keys).withColumn("away", F.abs(F.col("bin") - F.col("middle")))
    spread = _median(away.groupBy(*keys, "away").agg(F.sum("n").alias("n")), keys, "away", "spread").drop("texts")
    least = F.element_at(F.create_map(*[F.lit(x) for m in LEAST.items() for x in m]), F.col("measure"))
    slack = F.greatest(F.col("spread") * (1.4826 * WIDTH / 100), least)
    limits = middle.join(spread, keys).where((F.col("texts") >= FEW) | (F.col("band") == "")).select(
        "band", "measure", (F.col("middle") / 100 - slack).alias("low"), (F.col("middle") / 100 + slack).alias("high")
    )
    sides = [F.max(F.when(F.col("measure") == m, F.col(s))).alias(f"{m}_{s}") for m in LEAST for s in ("low", "high")]
    return limits.groupBy("band").agg(*sides)


#: Columns that judging adds.
ADDED = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "tokens_per_word", "chars_per_token", "byte_share", "entropy",
    "base_failed", "kept",
)


def judge(df: DataFrame, path: str | None = None, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows, without ``text``, with all counts and measures, ``base_failed`` and ``kept``."""
    few, repeats = F.col("n_words") < MIN_WORDS, 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    own = without(df, [text, *ADDED])
    given = df.select(nested(df, [text, *ADDED]).alias("row"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    measured = stage(
        measures(given, path or public_path("piece_bpe_32k.model")).drop("lang").withColumn("base_failed", few | repeats), "quality-measures"
    )
    limits = stage(bands(measured), "quality-bands")
    joined = measured
    for i, key in enumerate(_band_keys()):
        side = limits.select(F.col("band").alias(f"_band{i}"), F.struct(*[c for c in limits.columns if c != "band"]).alias(f"_limits{i}"))
        if i == 2:  # one row
            joined = joined.join(F.broadcast(side.where("_band2 = ''")), F.lit(True), "left")
        else:
            joined = joined.join(side, key == F.col(f"_band{i}"), "left")
    joined = joined.withColumn("_limits", F.coalesce("_limits0", "_limits1", "_limits2"))
    inside = F.lit(True)
    for m in LEAST:
        inside = inside & F.coalesce(F.col(m).between(F.col(f"_limits.{m}_low"), F.col(f"_limits.{m}_high")), F.lit(True))
    return joined.withColumn("kept", ~F.col("base_failed") & inside).select(*[F.col(f"row.`{c}`") for c in own], *ADDED)


def op5_fertility(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, tokenizer measures and verdict of every document."""
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_tokens", "tokens_per_word", "chars_per_token", "byte_share", "entropy",
    )
