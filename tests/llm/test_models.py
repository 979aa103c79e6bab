"""Language model and toxicity: exact figures, properness, held-out quality, odd rows."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from public_tokenizers import path

from wordloom.llm import language_model as lm, toxicity

PIECES = path("piece_bpe_32k.model")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def check_base(rows, docs):
    counts = Counter()
    for i, t in docs:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(tokens(t))
            counts["\n"] += 1
    n, v = sum(counts.values()), len(counts)
    texts = {i: t for i, t in docs}
    for r in rows:
        words = tokens(texts[r.doc_id]) + ["\n"]
        assert r.n_tokens == len(words) and r.n_known == sum(counts[w] > 0 for w in words) and r.train_tokens == n
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), rel=1e-9)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert math.isfinite(r.score) and r.score < 0


def test_scores(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = lm.score_documents(docs).collect()
    check_base(rows, [(r.doc_id, r.text) for r in docs.collect()])
    monkeypatch.setattr(lm, "HOT_WORDS", 40)  # nearly all words go by the table
    again = lm.score_documents(docs).collect()
    assert {r.doc_id: r.score for r in again} == pytest.approx({r.doc_id: r.score for r in rows}, rel=1e-6)


def test_odd_rows_and_empty_table(odd, empty):
    rows = lm.score_documents(odd.withColumn("word", odd.source)).collect()
    assert len(rows) == odd.count()
    check_base(rows, [(r.doc_id, r.text) for r in odd.collect()])
    assert lm.score_documents(empty).count() == 0


def test_without_training_rows(odd):
    from pyspark.sql import functions as F

    assert all(math.isfinite(r.score) and r.train_tokens == 0 for r in lm.score_documents(odd, held=F.lit(True)).collect())


def lattice():
    size = lm._pieces(PIECES).get_piece_size()
    return lm.Lattice(PIECES, np.zeros(size), np.zeros(size), 0)


def brute_likelihood(model, word):
    """Sum over all ways to cut the word, spelled out."""
    total = 0.0
    for head in range(len(word) + 1):
        if word[:head] not in model.first:
            continue
        rest = word[head:]
        for cuts in itertools.product([False, True], repeat=max(len(rest) - 1, 0)):
            parts, at = [], 0
            for i, cut in enumerate(cuts, 1):
                if cut:
                    parts.append(rest[at:i])
                    at = i
            parts += [rest[at:]] if rest else []
            weight = math.exp(model.first[word[:head]])
            for p in parts:
                byte = math.exp(sum(model.bytes[b] for b in p.encode())) if len(p) == 1 else 0.0
                weight *= (math.exp(model.later[p]) if p in model.later else 0.0) + byte
            total += weight
    return total * math.exp(model.stop)


def test_forward_recursion_equals_enumeration():
    model = lattice()
    for word in ("a", "the", "thing", "ñandú", "日本", "x1y2", "▁"):
        assert math.exp(model.log_likelihood(word)) == pytest.approx(brute_likelihood(model, word), rel=1e-9)


def test_lattice_is_a_distribution():
    model = lattice()
    assert sum(map(math.exp, model.first.values())) == pytest.approx(1)
    assert sum(map(math.exp, [*model.later.values(), *model.bytes.values()])) + math.exp(model.stop) == pytest.approx(1)


def test_known_words_and_rest_sum_to_one():
    totals = {"types": 3, "v": 3, "o": 1, "t": 1, "n0": 7, "v0": 3, "o0": 1, "t0": 1, "n1": 2, "v1": 1, "o1": 0, "t1": 1}
    model = lm.Model(lattice(), 2, totals, [2, 0])
    counts = np.array([[1, 0], [2, 0], [4, 2], [2, 0]], float)  # three words and the end
    known = 10 ** model.log10(np.zeros(4), counts)
    unseen = 10 ** model.log10(np.ones(1), np.zeros((1, 2)))
    assert (known.sum(axis=0) + unseen[0]).tolist() == pytest.approx([1, 1], abs=1e-9)


def test_long_words_stay_in_log_space(spark):
    from fractions import Fraction

    draw = random.Random(2)
    known, long = "known words", "".join(draw.choice("abcxyz0189+/") for _ in range(10_000))
    model = lattice()
    # Sums over all cuts by position as exact fractions.
    at = [Fraction(0)] * 301
    for j in range(0, 301):
        if long[:j] in model.first and j <= model.longest:
            at[j] += Fraction(math.exp(model.first[long[:j]]))
    for i in range(300):
        at[i + 1] += at[i] * Fraction(math.exp(model.bytes[ord(long[i])]))
        for j in range(i + 1, min(300, i + model.longest) + 1):
            if long[i:j] in model.later:
                at[j] += at[i] * Fraction(math.exp(model.later[long[i:j]]))
    exact = math.log(at[300].numerator) - math.log(at[300].denominator) + model.stop
    assert exact < -690 and model.log_likelihood(long[:300]) == pytest.approx(exact, rel=1e-9)
    totals = {"types": 3, "v": 3, "o": 1, "t": 1, "n0": 7, "v0": 3, "o0": 1, "t0": 1}
    whole, log = lm.Model(model, 1, totals, [2]), model.log_likelihood(long)
    d, n, v = whole.d[0], whole.n[0], whole.v[0]
    left = d * v / n * (lm.OTHER_CLASSES * whole.all_d * whole.all_v / whole.all_n + 1 - lm.OTHER_CLASSES)
    got = whole.log10_of_log(np.array([log]), np.zeros((1, 1)))[0, 0]
    assert got == pytest.approx((log + math.log(left)) / math.log(10), rel=1e-12) and got < -5_000
    docs = spark.createDataFrame([(1, known, "en"), (2, long, "en"), (3, long * 2, "en")], "doc_id BIGINT, text STRING, lang STRING")
    scores = {r.doc_id: r.score for r in lm.score_documents(docs, held=docs.doc_id > 1).collect()}
    assert scores[3] < 1.9 * scores[2] < -10_000


# --- toxicity -------------------------------------------------------------------------


def brute_segments(scores):
    """Maximal segments by their definition: recursively the best one, then what is left and right of it."""
    if not scores or max(scores) <= 0:
        return []
    sums = np.r_[0.0, np.cumsum(scores)]
    best = max(((sums[j] - sums[i], i - j, -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)))
    s, _, _, i, j = best
    left, right = brute_segments(scores[:i]), brute_segments(scores[j:])
    return left + [(i, j - 1, s)] + [(a + j, b + j, v) for a, b, v in right]


def test_segments_equal_definition():
    draw = random.Random(8)
    for _ in range(300):
        scores = [draw.choice([-3.0, -1.7, -0.9, 0.61, 1.13, 2.57, 4.01]) + draw.random() / 97 for _ in range(draw.randint(0, 18))]
        got = toxicity.maximal_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in brute_segments(scores)]
        assert all(s == pytest.approx(sum(scores[a : b + 1])) for a, b, s in got)


@pytest.fixture(scope="module")
def labelled(spark):
    """Six hundred texts, a tenth toxic by words of three stems that take many endings."""
    draw = random.Random(9)
    syllables = "ka lo mi ne ra su ti vo pe du".split()
    word = lambda: "".join(draw.choice(syllables) for _ in range(draw.randint(1, 4)))
    rows, labels = [], []
    for i in range(600):
        words = [word() for _ in range(draw.randint(30, 120))]
        toxic = i % 10 == 0
        if toxic:
            for _ in range(draw.randint(3, 6)):
                words[draw.randrange(len(words))] = draw.choice(["zorg", "blorx", "fnurd"]) + word()
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), spark.createDataFrame(labels, "doc_id BIGINT, toxic INT")


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    rows = toxicity.score(docs, model).join(labels, "doc_id").where(toxicity.held_out()).collect()
    assert len(rows) > 90
    assert sum(r.predicted == r.toxic for r in rows) >= 0.97 * len(rows)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        for p in r.passages:
            assert re.search("zorg|blorx|fnurd", r.text.lower()[p.first_char : p.end_char]) or not r.toxic
            assert 0 <= p.chance <= 1 - math.exp(-1)


def test_labels_of_held_out_rows_are_not_read(spark, sf):
    docs = toxicity.documents(spark, sf).select("doc_id", "text")
    rows = toxicity.op10_toxicity(spark, sf).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_odd_toxicity(odd, empty, labelled, spark):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(odd.withColumnRenamed("lang", "score").withColumnRenamed("source", "PASSAGES"), model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.fit(docs, labels.where("toxic = 0"))
    assert all(r.predicted == 0 for r in toxicity.score(odd, none).collect())
    nothing = spark.createDataFrame([], "doc_id BIGINT, toxic INT")
    assert toxicity.fit(empty, nothing).probability(0.0) == pytest.approx(0.1)


def test_label_bound(labelled, monkeypatch):
    docs, labels = labelled
    monkeypatch.setattr(toxicity, "LABELLED_ROWS", 300)
    assert toxicity.fit(docs, labels).log_odds
