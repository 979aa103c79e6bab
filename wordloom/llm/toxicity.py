"""Toxic passages: maximum-scoring segments of token log-odds, calibrated by extreme values.

Model, learned from labelled documents only:

- A token is a run of letters, lower-cased. Its log-odds compare the toxic
  with the clean documents that hold it. Counts get a Dirichlet prior whose
  mean is the share of the next wider class: a word's prefixes of eight to
  three letters, then all words. A prefix counts only the words that are
  not significant themselves, so that one bad word does not taint its prefix, and so
  that unseen forms of a bad stem are still met.
- All other tokens score a small negative constant: those without significant log-odds, and those that are
  significantly clean. A text is toxic by what it holds; clean words beside it are no excuse.

Scoring, one row at a time: a linear scan finds all maximal scoring segments
(Ruzzo and Tompa). A segment with score S in a text of n tokens has the
normalized score lambda S - ln(K n), whose exponential is one over the number of
such segments that clean text yields by chance. lambda solves
sum p exp(lambda s) = 1 over the clean tokens; K follows from the mean of a Gumbel
distribution over clean training documents. The positive normalized scores of
a document add up to its evidence; one logistic curve maps evidence to the
probability of the label.

Bounds: at most ``LABELLED_ROWS`` labels, ``MODEL_TOKENS`` words and as many prefixes of each of the six lengths make the
model, so both may be broadcast. All documents are scored whole.

Defined results: a null text is the empty text, which has no passage; without
labels of both classes every document gets the share of toxic labels (0.1 if there
are none); repeated rows each give their own result; a null id is never held out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wordloom.llm.common import BoundedCache, add_columns, documents, least_of_most
from wordloom.operators.ranking import dense_index
from wordloom.sources import tables
from wordloom.staging import stage

#: Most labels used for fitting; beyond it a hash of the id chooses.
LABELLED_ROWS = 200_000
#: Most words, and most prefixes of each length, with the clearest log-odds, that enter the model.
MODEL_TOKENS = 20_000
#: Weight of the Dirichlet prior in documents; least documents of a significant token; its log-odds
#: must exceed ``MIN_ODDS`` by ``MIN_Z`` standard deviations.
PRIOR, MIN_DOCS, MIN_ODDS, MIN_Z = 4.0, 3, 0.5, 3.0
PREFIXES = (8, 7, 6, 5, 4, 3)
#: Score of a token without significant log-odds.
DRIFT = -0.1
_LETTERS = regex.compile(r"\p{L}+")
_CACHE_WORDS = 150_000


@dataclass(frozen=True)
class Model:
    log_odds: dict[str, float]  # words, and prefixes followed by "*"
    scale: float  # lambda
    ln_k: float
    slope: float
    offset: float

    def token_score(self, token: str) -> float:
        found = self.log_odds.get(token)
        if found is None:
            for k in PREFIXES:
                if len(token) > k and (found := self.log_odds.get(token[:k] + "*")) is not None:
                    return found
            return DRIFT
        return found

    def normalized(self, score: float, n_tokens: int) -> float:
        return self.scale * score - self.ln_k - math.log(max(n_tokens, 1))

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * evidence + self.offset))))


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score), left to right, in linear time."""
    found: list[list] = []  # [sum before, sum after, first, last, nearest earlier candidate with a smaller sum before]
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        new = [before, total, i, i, -1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= new[0]:
                j = found[j][4]
            if j < 0 or found[j][1] >= new[1]:
                new[4] = j
                found.append(new)
                break
            new = [found[j][0], new[1], found[j][2], new[3], -1]
            del found[j:]
    return [(f[2], f[3], f[1] - f[0]) for f in found]


def text_segments(score_of, tokens: list[str]) -> list[tuple[int, int, float]]:
    """Maximal segments of a text as (first token, last token, score).

    Runs of tokens with the constant negative score are scanned as one item.
    """
    hits = [(i, s) for i, s in enumerate(map(score_of, tokens)) if s > 0]
    if not hits:
        return []
    items, places, last = [], [], -1
    for i, s in hits:
        if last >= 0 and i - last > 1:
            items.append(DRIFT * (i - last - 1))
            places.append(-1)
        items.append(s)
        places.append(i)
        last = i
    return [(places[a], places[b], s) for a, b, s in maximal_segments(items)]


def evidence(model: Model, segments: list[tuple[int, int, float]], n_tokens: int) -> float:
    """Sum of the positive normalized scores, or the largest one if none is positive."""
    scores = [model.normalized(s, n_tokens) for _, _, s in segments]
    above = [x for x in scores if x > 0]
    return sum(above) if above else max(scores, default=model.normalized(0.0, n_tokens))


# --- fitting ------------------------------------------------------------------


def _words(docs: DataFrame) -> DataFrame:
    """(word, toxic, clean): labelled documents that hold the word."""
    word = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))))
    return (
        docs.select(word.alias("word"), "toxic")
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
    )


def _z(toxic: Column, clean: Column, share: float) -> Column:
    """How far a token's log-odds under the prior of all words exceed the least, in standard deviations."""
    a, b = toxic + PRIOR * share, clean + PRIOR * (1 - share)
    return (F.log(a / b) - math.log(share / (1 - share)) - MIN_ODDS) / F.sqrt(1 / a + 1 / b)


def _significant(counts: DataFrame, share: float) -> list:
    """The at most ``MODEL_TOKENS`` clearest significant tokens; of equally clear ones the first by name."""
    z = _z(F.col("toxic"), F.col("clean"), share)
    rows = counts.where(F.col("toxic") >= MIN_DOCS).withColumn("z", F.floor(z * 100)).where(F.col("z") >= MIN_Z * 100)
    rows = stage(rows.select("word", "toxic", "clean", "z"), "toxicity-significant")
    least = least_of_most(rows, "z", MODEL_TOKENS)
    above = [] if least is None else rows.where(F.col("z") >= least).collect()
    ties = rows if least is None else rows.where(F.col("z") < least)
    if len(above) == MODEL_TOKENS or (cut := ties.agg(F.max("z")).first()[0]) is None:
        return above
    named = dense_index(ties.where(F.col("z") == cut), [F.col("word")], "place")
    return above + named.where(F.col("place") <= MODEL_TOKENS - len(above)).collect()


def _fit_log_odds(words: DataFrame, share: float) -> tuple[dict[str, float], list[tuple[float, int]]]:
    """(log-odds by word or prefix, [(log-odds, clean documents)])."""
    spark = words.sparkSession
    found = {r.word: (r.toxic, r.clean) for r in _significant(words, share)}
    rest = words
    for k in PREFIXES:
        if found:
            names = [w.rstrip("*") for w in found if not w.endswith("*")]
            stems = [w[:-1] for w in found if w.endswith("*")]
            if k == PREFIXES[0] and names:
                known = spark.createDataFrame([(w,) for w in names], "word STRING")
                rest = rest.join(F.broadcast(known), "word", "left_anti")
            elif stems:
                known = spark.createDataFrame([(w,) for w in stems if len(w) == k + 1], "stem STRING")
                rest = rest.withColumn("stem", F.substring("word", 1, k + 1)).join(F.broadcast(known), "stem", "left_anti").drop("stem")
            rest = stage(rest, "toxicity-rest")  # so that no level repeats the joins of the ones before
        wider = (
            rest.where(F.length("word") > k)
            .groupBy(F.concat(F.substring("word", 1, k), F.lit("*")).alias("word"))
            .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        )
        found |= {r.word: (r.toxic, r.clean) for r in _significant(wider, share)}

    shares: dict[str, float] = {}

    def share_of(key: str) -> float:
        """Posterior mean of the toxic share, shrunk towards the next wider class."""
        if key not in shares:
            toxic, clean = found[key]
            stem = key.rstrip("*")
            wider = next((stem[:k] + "*" for k in PREFIXES if k < len(stem) and stem[:k] + "*" in found), None)
            prior = share_of(wider) if wider else share
            shares[key] = (toxic + PRIOR * prior) / (toxic + clean + PRIOR)
        return shares[key]

    base = math.log(share / (1 - share))
    odds = {k: math.log(share_of(k) / (1 - share_of(k))) - base for k in found}
    return odds, [(odds[k], found[k][1]) for k in found]


def _scale(positive: list[tuple[float, int]], clean_total: int) -> float:
    """lambda: the positive root of sum p exp(lambda s) = 1 over clean tokens, at most 2."""
    weights = [(s, max(n, 0.5) / max(clean_total, 1)) for s, n in positive if s > 0]
    default = max(1e-9, 1 - sum(p for _, p in weights))

    def excess(x: float) -> float:
        return default * math.exp(x * DRIFT) + sum(p * math.exp(min(700.0, x * s)) for s, p in weights) - 1

    low, high = 0.0, 2.0
    if excess(high) <= 0:
        return high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return max(low, 0.05)


def _logistic(rows: list[tuple[float, int, int]]) -> tuple[float, float]:
    """(slope, offset) by Newton steps on (evidence, toxic, clean) counts, with softened targets."""
    pos, neg = sum(r[1] for r in rows), sum(r[2] for r in rows)
    high, low = (pos + 1) / (pos + 2), 1 / (neg + 2)
    a, b = 0.0, math.log((pos + 1) / (neg + 1))
    for _ in range(50):
        ga = gb = 0.0
        haa, hab, hbb = 1e-6, 0.0, 1e-6
        for x, n1, n0 in rows:
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, a * x + b))))
            n, target = n1 + n0, n1 * high + n0 * low
            g, h = target - n * p, n * p * (1 - p)
            ga, gb, haa, hab, hbb = ga + g * x, gb + g, haa + h * x * x, hab + h * x, hbb + h
        ga, haa = ga - 1e-3 * a, haa + 1e-3
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 2.0 / max(abs(da), abs(db), 1e-9))
        a, b = a + step * da, b + step * db
        if abs(da) + abs(db) < 1e-8:
            break
    return max(a, 1e-3), b


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> Model:
    """Model from ``labels`` (``id``, ``toxic`` 0/1) of ``docs``; rows without a label are ignored."""
    kept = labels.where(F.col(id).isNotNull() & F.col("toxic").isin(0, 1)).groupBy(id).agg(F.max("toxic").cast("long").alias("toxic"))
    n = kept.count()
    if n > LABELLED_ROWS:
        kept = kept.where(F.pmod(F.xxhash64(id), F.lit(1_000_000)) < int(950_000 * LABELLED_ROWS / n))
    train = docs.select(id, F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(kept), id).select("text", "toxic")
    words = stage(_words(train), "toxicity-words")
    sums = train.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).first()
    toxic, total = sums.toxic or 0, sums.n
    if not 0 < toxic < total:
        share = (toxic + 0.5) / (total + 1) if total else 0.1
        return Model({}, 1.0, 0.0, 1e-3, math.log(share / (1 - share)))
    share = toxic / total
    odds, positive = _fit_log_odds(words, share)
    clean_total = words.agg(F.sum("clean")).first()[0] or 0
    draft = Model(odds, _scale(positive, clean_total), 0.0, 1.0, 0.0)
    scored = stage(_segments(train, "text", draft).select("toxic", "n_tokens", "scores"), "toxicity-training")
    best = F.coalesce(F.array_max("scores"), F.lit(0.0)) * draft.scale
    mean = scored.where("toxic = 0").agg(F.avg(best - F.log(F.greatest(F.col("n_tokens"), F.lit(1))))).first()[0]
    model = Model(odds, draft.scale, max(-8.0, min(0.0, mean - 0.5772156649)), 1.0, 0.0)
    above = F.transform("scores", lambda s: s * model.scale - model.ln_k - F.log(F.greatest(F.col("n_tokens"), F.lit(1))))
    total_above = F.aggregate(F.filter(above, lambda x: x > 0), F.lit(0.0), lambda a, x: a + x)
    value = F.when(F.exists(above, lambda x: x > 0), total_above).otherwise(
        F.coalesce(F.array_max(above), -F.lit(model.ln_k) - F.log(F.greatest(F.col("n_tokens"), F.lit(1))))
    )
    bins = scored.select(F.round(F.greatest(F.lit(-40.0), F.least(F.lit(60.0), value)) * 4).alias("bin"), "toxic")
    counts = bins.groupBy("bin").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).collect()
    slope, offset = _logistic([(r.bin / 4, r.t, r.c) for r in sorted(counts)])
    return Model(odds, model.scale, model.ln_k, slope, offset)


# --- scoring ------------------------------------------------------------------


def _segments(df: DataFrame, text: str, model: Model) -> DataFrame:
    """Add ``n_tokens`` and ``scores`` (of all maximal segments)."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        score_of = BoundedCache(shared.value.token_score, _CACHE_WORDS).__getitem__

        def work(texts):
            counts, scores = [], []
            for t in texts:
                tokens = _LETTERS.findall((t or "").lower())
                counts.append(len(tokens))
                scores.append([s for _, _, s in text_segments(score_of, tokens)])
            return counts, scores

        return work

    return add_columns(df, [text], "n_tokens BIGINT, scores ARRAY<DOUBLE>", start, drop=[text])


PASSAGE = "ARRAY<STRUCT<first_char: INT, end_char: INT, score: DOUBLE, chance: DOUBLE>>"


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``score`` (probability of the label), ``predicted`` and ``passages`` to the rows.

    ``passages`` are the significant segments in text order: half-open
    character ranges of the lower-cased text, segment score, and the chance that clean text of
    this length holds one as high.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        known = shared.value
        score_of = BoundedCache(known.token_score, _CACHE_WORDS).__getitem__

        def work(texts):
            values, passages = [], []
            for t in texts:
                lowered = (t or "").lower()
                tokens = _LETTERS.findall(lowered)
                segments = text_segments(score_of, tokens)
                values.append(known.probability(evidence(known, segments, len(tokens))))
                found = [(a, b, s, x) for a, b, s in segments if (x := known.normalized(s, len(tokens))) > 0]
                if found:
                    spans = [m.span() for m in _LETTERS.finditer(lowered)]
                    found = [
                        {"first_char": spans[a][0], "end_char": spans[b][1], "score": s, "chance": -math.expm1(-math.exp(-x))}
                        for a, b, s, x in found
                    ]
                passages.append(found)
            return values, [int(v >= 0.5) for v in values], passages

        return work

    return add_columns(df, [text], f"score DOUBLE, predicted INT, passages {PASSAGE}", start)


def held_out(id: str = "doc_id") -> Column:
    """Every fifth document by hash; these labels are never learned."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 5 == 0, F.lit(False))


def fit_on_training_rows(spark: SparkSession, docs: DataFrame, folder: str) -> Model:
    labels = tables.table(spark, folder, "labels").select("doc_id", "toxic")
    return fit(docs, labels.where(~held_out()))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, from the labels of the rows that are not held out."""
    docs = documents(spark, folder).select("doc_id", "text")
    model = fit_on_training_rows(spark, docs, folder)
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted", F.size("passages").cast("long").alias("n_passages")
    )
