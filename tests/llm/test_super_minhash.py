"""SuperMinHash against the algorithm element by element, and its groups against all pairs."""

import random

import numpy as np
import pytest

from wordloom.llm import super_minhash as sm

SCHEMA = "doc_id BIGINT, text STRING"


def plain_signature(elements, registers):
    """One element after the other, with its whole permutation."""
    least = [2**64 - 1] * registers
    for e in elements.tolist():
        places = list(range(registers))
        for j in range(registers):
            draw = int(sm._mix(np.array([(e + sm._STEP * (j + 1)) % 2**64], np.uint64))[0])
            k = j + ((draw >> 32) * (registers - j) >> 32)
            places[j], places[k] = places[k], places[j]
            least[places[j]] = min(least[places[j]], j << 32 | draw & 0xFFFFFFFF)
    return least


def test_signature_equals_plain_algorithm(monkeypatch):
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 60, 400):
        elements = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert sm.signature(elements, 32).tolist() == plain_signature(elements, 32)
        monkeypatch.setattr(sm, "BLOCK", 50)
        assert sm.signature(elements, 32).tolist() == plain_signature(elements, 32)
        monkeypatch.undo()


def test_estimate_is_right_and_varies_less_than_independent_minima():
    rng, m, errors = np.random.default_rng(5), 64, []
    for _ in range(400):
        x = np.unique(rng.integers(0, 2**64, 60, dtype=np.uint64))
        a, b = x[:45], x[15:]
        errors.append((sm.signature(a, m) == sm.signature(b, m)).mean() - 0.5)
    errors = np.array(errors)
    # Independent minima would have the variance j (1 - j) / m.
    assert abs(errors.mean()) < 0.02 and errors.var() < 0.9 * 0.25 / m


def words(text):
    fold = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return fold.translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ")


def shingles(text):
    w = [x for x in words(text) if x]
    return {tuple(w[i : i + 2]) for i in range(len(w) - 1)} if len(w) > 1 else {tuple(w)} if w else set()


def brute(rows):
    """(doc_id, n_shingles, component_id) of rows in order."""
    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                label[root(i)] = root(j)
    least = {}
    for i, (id, _) in enumerate(rows):
        known = least.get(root(i))
        least[root(i)] = id if known is None else known if id is None else min(id, known)
    return [(id, len(sets[i]), least[root(i)]) for i, (id, _) in enumerate(rows)]


def found(df, **more):
    return sorted(map(tuple, sm.near_duplicates(df, **more).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def clusters(groups, size, seed):
    """Texts and edited copies at similarities on both sides of the bound."""
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(4_000)]
    for _ in range(groups):
        text = rng.choices(vocabulary, k=rng.randrange(20, 120))
        for _ in range(rng.randrange(1, size)):
            copy = list(text)
            for _ in range(rng.randrange(0, max(1, len(copy) // 9))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows) * 7 % 100_003, " ".join(copy)))
    rng.shuffle(rows)
    return rows


def test_equals_all_pairs(spark):
    rows = clusters(60, 8, 1)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("seed", [2, 3])
def test_large_group_with_edits_around_the_bound(spark, seed):
    """Links that no center has part in are found: chains of edits, each within the bound of the next."""
    rng, vocabulary = random.Random(seed), [f"w{i}" for i in range(9_000)]
    text, rows = rng.choices(vocabulary, k=90), []
    for i in range(250):
        text = list(text)
        text[rng.randrange(len(text))] = rng.choice(vocabulary)
        rows.append((i, " ".join(text if i % 3 else rng.choices(vocabulary, k=3) + text)))
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4)) == sorted(brute(rows), key=str)


def test_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [(50, "Two words"), (51, "two\twords"), (52, "one"), (53, "ONE"), (None, "one")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df) == sorted(brute(rows), key=str)
    clash = df.selectExpr("*", "1 AS id", "2 AS fp", "3 AS n", "4 AS row_key", "5 AS component_id", "6 AS `a.b`")
    assert found(clash) == found(df)
    assert sm.near_duplicates(empty).count() == 0


def test_union_find_in_batches(spark, monkeypatch):
    monkeypatch.setattr(sm, "FOREST", 3)
    links = [(bytes([i]), bytes([i + 1])) for i in range(0, 40) if i % 10 != 9]
    got = {r.node: r.label for r in sm.grouped(spark.createDataFrame(links, "a BINARY, b BINARY").repartition(3)).collect()}
    assert {bytes(k): bytes(v) for k, v in got.items()} == {bytes([i]): bytes([i // 10 * 10]) for i in range(40)}


def test_long_texts_are_cut_between_words():
    text = "alpha Beta\tgamma\n" * 120_000
    assert len(list(sm.pieces(text.encode()))) > 1
    assert len(sm.shingle_set(text.encode())) == len(shingles(text)) == 3
