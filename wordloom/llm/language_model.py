"""Document probabilities from a subword lattice.

A word's lattice holds every way to cut it into pieces of a public vocabulary, with single characters as
bytes where need be. A forward recursion in log space sums all of them,
so the word gets its marginal probability L(w): the first piece is drawn from pieces that begin a word, further
ones, and a stop, from the others. Piece weights start from the vocabulary's own scores
and take up how often the pieces occur in the distinct training words.

The lattice also has one arc over the whole word if training saw it:

    P(w) = max(c - d, 0) / N + d V / N * L(w)            absolute discounting, d = n1 / (n1 + 2 n2)

and the same once more per text class, with a mixture of L and P in place of L. Classes are the languages of the training documents; a text's class is never read when it is scored, its probability is the sum
over classes of prior times product over words. The end of a text is a word of its own.

Passes: (1) words are counted per task, then summed by word; (2) pieces of the distinct words are counted,
a table bounded by the vocabulary; (3) every distinct word gets its log probabilities; (4) documents are
scored. In (4) the ``HOT_WORDS`` most frequent words are broadcast; all other words
go by hash to their row of the word table and come back as sums per document, so the table itself may grow without
bound and no frequent word is shuffled.

Defined results: a null text is the empty text, one end token; a null id is never held out; a null or rare language
belongs to the class "other"; every row is scored, also repeated ones; without training
documents the lattice alone, with the vocabulary's scores, is the model, and the end of a text costs nothing.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from public_tokenizers import path as public_path
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wordloom.llm.common import documents, fold_text, least_of_most, words_of
from wordloom.staging import stage

#: Bounds: broadcast words, distinct words that a task counts before it hands them on.
HOT_WORDS, COUNTED_WORDS = 200_000, 250_000
#: Least share of the training documents with a language that makes a class of its own; so there are at most 100.
CLASS_SHARE = 0.01
#: Share of a class's unseen words that is taken to be known from other classes.
OTHER_CLASSES = 0.15
#: Weight of the vocabulary's own scores, in piece occurrences.
PRIOR_PIECES = 1000.0
_BEGIN = "▁"


@functools.cache
def _pieces(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


class Lattice:
    """Log weights of pieces that begin a word, of others, of bytes and of the stop."""

    def __init__(self, path: str, first: np.ndarray, later: np.ndarray, words: int):
        model = _pieces(path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        # The vocabulary's scores are minus the rank of a piece: a weight that falls with rank.
        scores = np.array([model.get_score(i) for i in range(size)])
        prior = np.where(scores > -1e8, 1 / (10 - np.minimum(scores, 0)), 0)
        is_byte = np.array([model.is_byte(i) for i in range(size)])
        control = np.array([model.is_control(i) or model.is_unknown(i) for i in range(size)])
        begins = np.array([n.startswith(_BEGIN) for n in names]) & ~control
        within = ~begins & ~control
        # The bare mark leads every word that no longer piece begins; without a weight such words would be impossible.
        bare = np.array([n == _BEGIN for n in names])
        prior[bare] = np.maximum(prior[bare], prior[begins & (prior > 0)].min(initial=1.0))
        stop = words + PRIOR_PIECES / 4
        self.first, self.later, self.bytes = {}, {}, {}
        for chosen, counts, extra in ((begins, first, 0.0), (within, later, stop)):
            weight = np.where(chosen, counts + PRIOR_PIECES * prior / max(prior[chosen].sum(), 1e-9), 0)
            total = weight.sum() + extra
            if extra:
                self.stop = math.log(extra / total)
            for i in np.flatnonzero(weight > 0):
                value = math.log(weight[i] / total)
                if is_byte[i]:
                    self.bytes[int(names[i][3:5], 16)] = value
                elif extra:
                    self.later[names[i]] = value
                else:
                    self.first[names[i][1:]] = value
        self.longest = max([len(p) for p in self.later] + [len(p) for p in self.first], default=1)

    def log_likelihood(self, word: str) -> float:
        """log of the sum over all segmentations: forward recursion over the word's positions."""
        n, longest = len(word), self.longest
        minus = -math.inf
        alpha = [minus] * (n + 1)
        get = self.first.get
        for j in range(0, min(n, longest) + 1):  # pieces that begin the word, also the bare mark
            if (s := get(word[:j])) is not None:
                alpha[j] = s
        get, exp, log1p = self.later.get, math.exp, math.log1p
        for i in range(n):
            a = alpha[i]
            if a == minus:
                continue
            arcs = [(i + 1, sum([self.bytes[b] for b in word[i].encode("utf-8", "replace")]))]
            for j in range(i + 1, min(n, i + longest) + 1):
                if (s := get(word[i:j])) is not None:
                    arcs.append((j, s))
            for j, s in arcs:
                x, y = a + s, alpha[j]
                if x > y:
                    x, y = y, x
                alpha[j] = y if x == minus else y + log1p(exp(x - y))
        return alpha[n] + self.stop


def held_out(id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 7 == 2, F.lit(False))


def _word_counts(df: DataFrame, classes: list[str]) -> DataFrame:
    """(word, n, c0 ...): occurrences in all rows, and in training rows by class; df has text, lang, trains."""
    k = len(classes) + 1
    number = {c: i for i, c in enumerate(classes)}

    def emit(counters: list[Counter]) -> Iterator[pa.RecordBatch]:
        for kind, counter in enumerate(counters):
            if counter:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(counter.keys(), pa.string()), pa.array([kind] * len(counter), pa.int32()), pa.array(counter.values(), pa.int64())],
                    names=["word", "kind", "n"],
                )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = [Counter() for _ in range(k + 1)]
        for b in batches:
            for text, lang, trains in zip(*(b.column(i).to_pylist() for i in range(3))):
                if text:
                    counter = counters[number.get(lang, k - 1) if trains else k]
                    counter.update(words_of(fold_text(text)))
                    if len(counter) > COUNTED_WORDS:
                        yield from emit([Counter()] * counters.index(counter) + [counter])
                        counter.clear()
        yield from emit(counters)

    rows = df.select("text", "lang", "trains").mapInArrow(count, "word STRING, kind INT, n BIGINT")
    sums = [F.sum(F.when(F.col("kind") == i, F.col("n")).otherwise(0)).alias(f"c{i}") for i in range(k)]
    return rows.groupBy("word").agg(F.sum("n").alias("n"), *sums)


def _piece_counts(words: DataFrame, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of each piece at the start of, and within, the distinct training words."""
    size = _pieces(path).get_piece_size()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, sums = _pieces(path), np.zeros((2, size), np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 5_000):
                coded = [x for x in model.encode(b.column(0).slice(at, 5_000).to_pylist(), num_threads=1) if x]
                sums[0] += np.bincount([x[0] for x in coded], minlength=size)
                sums[1] += np.bincount([i for x in coded for i in x[1:]] or [0], minlength=size)
        kind, piece = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(sums[kind, piece])], names=["kind", "piece", "n"]
        )

    sums = np.zeros((2, size))
    rows = words.select("word").mapInArrow(count, "kind INT, piece INT, n BIGINT").groupBy("kind", "piece").agg(F.sum("n").alias("n"))
    for r in rows.collect():  # at most two rows per piece of the vocabulary
        sums[r.kind, r.piece] = r.n
    return sums[0], sums[1]


def _log(x: np.ndarray | float) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(x)


def _discounted(counts: np.ndarray, total: float, types: float, d: float, wider: np.ndarray) -> np.ndarray:
    """Log of the discounted counts' share plus what they leave to ``wider``, also a log."""
    if not total:
        return wider
    return np.logaddexp(_log(np.maximum(counts - d, 0) / total), _log(d * types / total) + wider)


def _discount(n1: float, n2: float) -> float:
    return min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5


class Model:
    """Training totals and the lattice; log10 probabilities of words by class."""

    def __init__(self, lattice: Lattice, classes: int, totals: dict, ends: list[int]):
        self.lattice, self.classes, self.ends = lattice, classes, np.array(ends, float)
        end_types = (self.ends > 0).astype(float)
        self.n = np.array([totals[f"n{i}"] or 0 for i in range(classes)], float) + self.ends
        self.v = np.array([totals[f"v{i}"] for i in range(classes)], float) + end_types
        self.d = np.array([_discount(totals[f"o{i}"], totals[f"t{i}"]) for i in range(classes)])
        self.all_n, self.all_v = self.n.sum(), totals["v"] + float(self.ends.sum() > 0)
        self.all_d = _discount(totals["o"], totals["t"])

    def log10(self, likelihood: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Rows of log10 P(word | class) from L(word) and counts by class."""
        return self.log10_of_log(_log(likelihood), counts)

    def log10_of_log(self, likelihood: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The same from log L(word); nothing leaves log space, so no word is too long."""
        wide = _discounted(counts.sum(axis=1), self.all_n, self.all_v, self.all_d, likelihood)
        wide = np.logaddexp(math.log(OTHER_CLASSES) + wide, math.log(1 - OTHER_CLASSES) + likelihood)
        by_class = [_discounted(counts[:, i], self.n[i], self.v[i], self.d[i], wide) for i in range(self.classes)]
        return np.stack(by_class, axis=1) / math.log(10)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.all_n + 1 * (self.all_v + 1)))


def _lexicon(words: DataFrame, model: Model) -> DataFrame:
    """(word, n, c, base, p0 ...): log10 probabilities of every distinct word."""
    k = model.classes
    shared = words.sparkSession.sparkContext.broadcast(model)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        of = model.lattice.log_likelihood
        for whole in batches:
            for at in range(0, whole.num_rows, 5_000):
                b = whole.slice(at, 5_000)
                counts = np.stack([b.column(2 + i).to_numpy() for i in range(k)], axis=1).astype(float)
                likelihood = np.array([of(w) for w in b.column(0).to_pylist()])
                p = model.log10_of_log(likelihood, counts)
                c = counts.sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(c.astype(np.int64)), pa.array(model.base(c)), *(pa.array(p[:, i]) for i in range(k))],
                    names=["word", "n", "c", "base", *(f"p{i}" for i in range(k))],
                )

    return words.mapInArrow(weigh, "word STRING, n BIGINT, c BIGINT, base DOUBLE, " + ", ".join(f"p{i} DOUBLE" for i in range(k)))


def score_documents(
    df: DataFrame, path: str | None = None, id: str = "doc_id", text: str = "text", lang: str = "lang", held: Column | None = None
) -> DataFrame:
    """(``id``, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``df``.

    Rows for which ``held`` is true are scored but not learned.
    """
    path = path or public_path("piece_bpe_32k.model")
    spark = df.sparkSession
    trains = ~(held_out(id) if held is None else held)
    docs = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"), trains.alias("trains"))
    by_lang = docs.where("trains").groupBy("lang").agg(F.count("*").alias("n"))
    named = by_lang.where("lang IS NOT NULL")
    whole = named.agg(F.sum("n")).first()[0] or 0
    top = named.where(F.col("n") >= CLASS_SHARE * whole).orderBy(F.desc("n"), "lang").collect()
    classes = [r.lang for r in top]
    trained = by_lang.agg(F.sum("n")).first()[0] or 0
    ends = [r.n for r in top] + [trained - sum(r.n for r in top)]
    k = len(ends)

    words = stage(_word_counts(docs, classes), "lm-words")
    c = sum((F.col(f"c{i}") for i in range(1, k)), F.col("c0"))
    kinds = [("", c), *((str(i), F.col(f"c{i}")) for i in range(k))]
    totals = words.agg(
        F.count_if(c > 0).alias("types"),
        *[F.coalesce(F.sum(x), F.lit(0)).alias(f"n{i}") for i, x in kinds],
        *[F.count_if(x > 0).alias(f"v{i}") for i, x in kinds],
        *[F.count_if(x == 1).alias(f"o{i}") for i, x in kinds],
        *[F.count_if(x == 2).alias(f"t{i}") for i, x in kinds],
    ).first().asDict()
    model = Model(Lattice(path, *_piece_counts(words.where(c > 0), path), totals["types"]), k, totals, ends)
    lexicon = stage(_lexicon(words, model), "lm-lexicon")
    least = least_of_most(lexicon, "n", HOT_WORDS)
    is_hot = F.lit(False) if least is None else F.col("n") >= least
    hot_rows = lexicon.where(is_hot).toArrow()
    columns = [hot_rows["base"].to_numpy(), (hot_rows["c"].to_numpy() > 0).astype(float), *(hot_rows[f"p{i}"].to_numpy() for i in range(k))]
    table = np.stack(columns, axis=1)
    hot_words = hot_rows["word"].to_pylist()
    shared = spark.sparkContext.broadcast(("\n".join(hot_words), table))
    names = ["base", "known", *(f"p{i}" for i in range(k))]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined, table = shared.value
        number = {w: i for i, w in enumerate(joined.split("\n"))} if len(table) else {}
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                sums, counts, colds = np.zeros((b.num_rows, 2 + k)), [], []
                for i, t in enumerate(b.column(1).to_pylist()):
                    tokens = words_of(fold_text(t)) if t else []
                    counts.append(len(tokens) + 1)
                    places = [number.get(w, -1) for w in tokens]
                    at_hot = np.array(places, np.int64)
                    sums[i] = table[at_hot[at_hot >= 0]].sum(axis=0)
                    colds.append([w for w, p in zip(tokens, places) if p < 0])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), pa.array(counts, pa.int64()), *(pa.array(sums[:, j]) for j in range(2 + k)), pa.array(colds, pa.list_(pa.string()))],
                    names=["id", "trains", "n_tokens", *names, "cold"],
                )

    fields = "id BIGINT, trains BOOLEAN, n_tokens BIGINT, " + ", ".join(f"{x} DOUBLE" for x in names) + ", cold ARRAY<STRING>"
    first = stage(
        docs.select("id", "text", "trains").mapInArrow(score, fields)
        .withColumn("row", F.monotonically_increasing_id()), "lm-documents",
    )
    rest = (
        first.select("row", F.explode("cold").alias("word"))
        .join(lexicon.where(~is_hot).select("word", "base", (F.col("c") > 0).cast("double").alias("known"), *names[2:]), "word")
        .groupBy("row").agg(*[F.sum(x).alias(f"more_{x}") for x in names])
    )
    end = model.log10(np.zeros(1), model.ends[None, :])[0] if trained else np.zeros(k)
    prior = np.log10((model.ends + 1) / (model.ends.sum() + k))
    both = first.drop("cold").join(rest, "row", "left")
    total = {x: F.col(x) + F.coalesce(F.col(f"more_{x}"), F.lit(0.0)) for x in names}
    logs = F.array(*[total[f"p{i}"] + float(end[i] + prior[i]) for i in range(k)])
    best = F.array_max("logs")
    known_end = float(model.ends.sum() > 0)
    return (
        both.withColumn("logs", logs)
        .select(
            F.col("id").alias(id),
            (~F.col("trains")).alias("held_out"),
            "n_tokens",
            (total["known"] + known_end).cast("long").alias("n_known"),
            F.lit(int(model.all_n)).cast("long").alias("train_tokens"),
            (total["base"] + float(model.base(np.array([model.ends.sum()]))[0])).alias("base_score"),
            (best + F.log10(F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.pow(F.lit(10.0), x - best)))).alias("score"),
        )
    )


def op3_lattice_score(spark: SparkSession, folder: str) -> DataFrame:
    """Log probability of every document, learned from the documents that are not held out."""
    return score_documents(documents(spark, folder))
