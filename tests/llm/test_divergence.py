"""Source divergence audit against a plain recount with whole numbers of any size."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, min_docs, top):
    """(lang, source, part, item, value, rank) of rows (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = TERM.findall(fold(text))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang in {r[0] for r in rows}:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        sources = sorted({s for x, s, _ in rows if x == lang})

        def shares(found):
            total = sum(found[t] for t in kept)
            return {t: 1 + 10**9 * (found[t] + 5) // (total + 5 * len(kept)) for t in kept}

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - whole[t], t) for t in kept if counts[lang, s][t] and p[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [w + x for w in ("Foo", "bar", "Éa", "ñandú", "日本", "zebra", "AA") for x in ("", "s", "x", "ß")]
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.4 else f"s{rng.randrange(6)}"
        text = " ".join(rng.choice(words[: 10 + rng.randrange(18)]) for _ in range(rng.randrange(12))) + rng.choice(["", "\x00", " 12 a_b"])
        rows.append((rng.choice(["en", "de", None, ""]), rng.choice([source, source, source, None]), rng.choice([text] * 9 + [None])))
    return rows


SCHEMA = "lang STRING, source STRING, text STRING"


def test_equals_plain_recount(spark):
    rows = corpus(400) + [("fr", "alone", "one two"), ("fr", "other", None), ("it", "only", "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert rows_of(divergence.audit(df, min_docs=8, top=4)) == brute(rows, 8, 4)


def test_rounds_shards_blocks_and_flushes(spark, monkeypatch):
    """Bounds that are met many times over give the same rows."""
    rows = corpus(300, seed=2)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name, value in (("SHARD_KEYS", 5), ("ROUND_KEYS", 12), ("HELD_TERMS", 30), ("SLOTS", 20), ("BLOCK", 2), ("CHUNK", 7)):
        monkeypatch.setattr(divergence, name, value)
    assert rows_of(divergence.audit(df, min_docs=3, top=3)) == brute(rows, 3, 3)


def test_odd_rows(spark, odd, empty):
    assert divergence.audit(empty).count() == 0
    rows = [(r.lang, r.source, r.text) for r in odd.collect()]
    assert rows_of(divergence.audit(odd, min_docs=1, top=50)) == brute(rows, 1, 50)
    clash = odd.selectExpr("*", "1 AS slot", "2 AS rank", "3 AS raw", "4 AS term", "5 AS `a.b`")
    assert rows_of(divergence.audit(clash, min_docs=1, top=50)) == brute(rows, 1, 50)
    named = odd.withColumnsRenamed({"lang": "l.x", "source": "s.x", "text": "t.x"})
    assert rows_of(divergence.audit(named, "l.x", "s.x", "t.x", min_docs=1, top=50)) == brute(rows, 1, 50)


def test_long_texts_are_cut_between_terms():
    raw = ("ab" * 40 + " cd,é9").encode() * 40_000
    parts = list(divergence.term_lists(raw))
    assert len(parts) > 1 and Counter(t for p in parts for t in p) == Counter(re.findall(TERM, raw.decode()) and [t.encode() for t in re.findall(TERM, raw.decode())])


def test_perfect_hash_is_minimal_and_verified():
    keys = [f"en\0{i}".encode() for i in range(20_000)]
    index = divergence.KeyIndex.unpacked(divergence.KeyIndex.build(keys).packed())
    found = index.numbers(keys, divergence.hashes(keys))
    assert sorted(found.tolist()) == list(range(len(keys)))
    assert all(index.key(n) == k for k, n in zip(keys[:100], found.tolist()))
    others = [f"de\0{i}".encode() for i in range(5_000)]
    assert (index.numbers(others, divergence.hashes(others)) == -1).all()
    assert (divergence.KeyIndex.build([]).numbers(others, divergence.hashes(others)) == -1).all()
    # Two keys of one hash are both found.
    same = np.full(2, 7, np.uint64)
    pair = divergence.KeyIndex.__new__(divergence.KeyIndex)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(divergence, "hashes", lambda keys: same[: len(keys)])
        pair = divergence.KeyIndex.build([b"a\0x", b"a\0y"])
    assert sorted(pair.numbers([b"a\0x", b"a\0y"], same).tolist()) == [0, 1]


def test_shares_are_exact_beyond_64_bits(spark):
    counts = [0, 1, 10**10, 3 * 10**12, 8 * 10**14]
    total, kinds = 9 * 10**14, 1_234_567
    want = [1 + 10**9 * (c + 5) // (total + 5 * kinds) for c in counts]
    assert divergence.shares(np.array(counts), total, kinds).tolist() == want
    df = spark.createDataFrame([(c, total, kinds) for c in counts], "n BIGINT, total BIGINT, kinds BIGINT")
    assert sorted(r.p for r in df.select(divergence.share("n", "total", "kinds").alias("p")).collect()) == sorted(want)
    assert df.select(divergence.share("n", "total", "0").alias("p")).where(F.col("p").isNotNull()).count() == 0
