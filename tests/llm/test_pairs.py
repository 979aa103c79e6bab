"""SimHash, line dedup and nearest neighbours against brute force."""

import hashlib
import random
import re

import corpus_pipeline
import numpy as np
import xxhash

from wordloom.llm import lines, neighbours, simhash
from wordloom.llm.components import components


class Groups:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, a):
        while self.up[a] != a:
            a = self.up[a]
        return a

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    grams = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fingerprints, budget=3):
    ids = sorted(fingerprints)
    groups = Groups(ids)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if bin(fingerprints[a] ^ fingerprints[b]).count("1") <= budget:
                groups.join(a, b)
    return {i: groups.find(i) for i in ids}


def near_copies(n=40, seed=5):
    draw = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(300)]
    base = [[draw.choice(vocabulary) for _ in range(250)] for _ in range(n // 4)]
    rows = []
    for i in range(n):
        words = list(base[i % len(base)])
        for _ in range(draw.choice([0, 0, 1, 2])):
            words[draw.randrange(250)] = "changed%d" % draw.randrange(9)
        rows.append((i, " ".join(words)))
    return rows + [(n, "one"), (n + 1, "One"), (n + 2, ""), (n + 3, None), (n + 4, "two words")]


def test_components_of_texts(spark):
    rows = near_copies()
    want = brute_components({i: brute_fingerprint(t) for i, t in rows})
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = simhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.fp & (2**64 - 1) for r in got} == {i: brute_fingerprint(t) for i, t in rows}
    kept = simhash.keep_one(docs).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(want.values())) and kept[0].__fields__ == ["doc_id", "text"]


def test_trie_links_equal_brute_force(monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 40)
    draw = np.random.default_rng(1)
    for bits in (1, 16):
        base = draw.integers(0, 2**63, 25, dtype=np.uint64)
        flips = [np.uint64(1) << draw.integers(0, 64, 25, dtype=np.uint64) for _ in range(8)]
        keys = np.unique(np.concatenate([base, *[base ^ flips[i] ^ flips[i + 1] for i in range(7)]]))
        head = keys >> np.uint64(64 - bits)
        groups = Groups(range(len(keys)))
        for a in range(len(keys)):
            for b in range(a + 1, len(keys)):
                if head[a] == head[b] and int(keys[a] ^ keys[b]).bit_count() <= 3:
                    groups.join(a, b)
        assert simhash.trie_links(keys, bits, 3).tolist() == [groups.find(i) for i in range(len(keys))]


def test_blocks_lose_no_link(spark):
    draw = random.Random(2)
    fps = {draw.getrandbits(64) for _ in range(60)}
    fps |= {f ^ sum(1 << b for b in draw.sample(range(64), 3)) for f in list(fps)[:40]} | {0, 7, 2**64 - 1}
    signed = {f - 2**64 if f >= 2**63 else f: f for f in fps}
    found = components(simhash.links(spark.createDataFrame([(f,) for f in signed], "fp BIGINT")))
    label = {r.node: r.label for r in found.collect()}
    want = brute_components(signed)
    for f in signed:
        same = {g for g in signed if want[g] == want[f]}
        assert {label.get(g, g) for g in same} == {min(same)}


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_odd_rows_and_empty_table(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {r.component_id for r in rows if r.fp == 0} == {4}
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
    assert simhash.keep_one(odd.withColumnRenamed("lang", "label")).where("doc_id = 8").count() == 1


def test_least_of_most(spark):
    from wordloom.llm.common import least_of_most

    df = spark.createDataFrame([(9,), (7,), (7,), (3,), (1,)], "n BIGINT")
    assert [least_of_most(df, "n", k) for k in (0, 1, 2, 3, 4, 5, 9)] == [None, 9, 9, 7, 3, 1, 1]


# --- lines --------------------------------------------------------------------------


def brute_lines(rows, min_docs=3):
    def key(line):
        return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))

    holders = {}
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= 20:
                    holders.setdefault(key(line), set()).add(i)
    gone = {k: max(h) for k, h in holders.items() if len(h) >= min_docs}
    out = []
    for i, t in rows:
        kept = [x for x in (t or "").split("\n") if gone.get(key(x), i) == i]
        out.append((i, len((t or "").split("\n")), len((t or "").split("\n")) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got_lines(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in lines.dedup_lines(df).collect()), key=str)


def test_lines_of_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    clash = odd.withColumnRenamed("lang", "n_lines").withColumnRenamed("source", "place")
    assert got_lines(clash) == brute_lines(rows)
    assert lines.dedup_lines(clash).columns == ["doc_id", "text", "place", "n_lines", "n_dropped"]


def test_lines_hot_and_cold(spark, monkeypatch):
    monkeypatch.setattr(lines, "HOT_DOCS", 20)
    monkeypatch.setattr(lines, "SHARD_KEYS", 10)
    draw = random.Random(3)
    pool = ["shared line number %d of the collection" % i for i in range(60)]
    rows = [(i, "\n".join(["a very common line of the whole collection"] * (i % 3) + draw.sample(pool, 4) + ["own line %d" % i * 3])) for i in range(120)]
    assert got_lines(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")) == brute_lines(rows)


def test_perfect_hash_numbers_every_key():
    draw = np.random.default_rng(4)
    keys = np.unique(draw.integers(0, 2**63, 5000, dtype=np.uint64))
    index = lines.PerfectHash.build(keys, keys).opened()
    assert sorted(index.numbers(keys, keys).tolist()) == list(range(len(keys)))
    twice = np.array([5, 5, 9], np.uint64)
    shard = lines.Shard.build(twice, np.array([1 << 40, 2 << 40, 3 << 40], np.uint64), np.array([1, 2, 300]), np.array([10, 20, 30]))
    known, n, last = lines.Shard.unpacked(shard.packed()).probe(twice, np.array([1 << 40, 2 << 40, 3 << 40], np.uint64))
    assert known.all() and n.tolist() == [1, 2, 255] and last.tolist() == [10, 20, 30]


def test_lines_of_an_empty_table(empty):
    assert lines.dedup_lines(empty).count() == 0


def test_line_digest(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute_lines(rows)}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in lines.op9_line_dedup(spark, sf).collect()} == want


# --- neighbours -----------------------------------------------------------------------


def brute_neighbours(vectors, k, every):
    ids = np.array(sorted(vectors))
    matrix = np.array([vectors[i] for i in ids], np.float64)
    out = []
    for q in ids[ids % every == 0]:
        score = (matrix * np.array(vectors[q], np.float64)).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
        out += [(int(q), r + 1, int(ids[j])) for r, j in enumerate(order)]
    return out


def test_neighbours_in_tiles(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(neighbours, "QUERY_TILE", 7)
    monkeypatch.setattr(neighbours, "CANDIDATE_TILE", 50)
    draw = np.random.default_rng(6)
    vectors = {i: draw.normal(size=12).astype(np.float32).tolist() for i in range(150)}
    vectors |= {i: vectors[3] for i in range(150, 200)} | {i: [x * 1000 for x in vectors[4]] for i in range(200, 205)}
    bad = [(300, None), (301, [0.0] * 12), (302, [None] + [1.0] * 11), (303, [float("nan")] * 12), (304, [float("inf")] + [1.0] * 11), (305, []), (None, [1.0] * 12)]
    rows = list(vectors.items()) + bad + [(0, vectors[0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id BIGINT, embedding ARRAY<FLOAT>, score STRING")
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=20).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == sorted(brute_neighbours(vectors, 20, 20))


def test_few_or_no_vectors(spark):
    from pyspark.sql import functions as F

    schema = "vec_id BIGINT, embedding ARRAY<FLOAT>"
    two = spark.createDataFrame([(20, [1.0, 2.0]), (3, [0.5, 0.5]), (40, [1.0])], schema)
    got = neighbours.nearest(two, F.col("vec_id") % 20 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(20, 1, 3, 1.5)]
    assert neighbours.nearest(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).count() == 0


# --- near-duplicates by shingles ------------------------------------------------------


def test_pipeline_keeps_the_smallest_id_of_each_group(spark, odd, empty):
    """The stage on nulls, empty texts, repeated rows, an empty table, and a group of edited copies."""
    rows = near_copies(60, seed=9)
    rows += [(100 + i, t) for i, t in rows[:20]]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    kept = [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, None).collect()]
    groups = brute_components({i: brute_fingerprint(t) for i, t in rows})
    assert sorted(kept) == sorted(set(groups.values()))
    kept = corpus_pipeline.drop_near_duplicates(spark, odd, None).collect()
    want = {1, 2, 3, 4, 7, 8, 9, 10, 11, None}  # 4 stays for the texts without a word
    assert {r.doc_id for r in kept} == want and len(kept) == len(want)
    assert corpus_pipeline.drop_near_duplicates(spark, empty, None).count() == 0
