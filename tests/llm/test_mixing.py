"""Budgets and prefixes against a plain Python version."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wordloom.llm import mixing


def brute(rows, percent, weights, max_epochs, seed):
    """(id, epoch, taken) from (id, domain, lang, source, tokens)."""
    size, docs = defaultdict(int), defaultdict(list)
    for i, d, lang, s, n in rows:
        size[d, lang, s] += n
        docs[d, lang, s].append((i, n))

    def fill(budget, kids):
        limit = {}
        for k in kids:
            weight = weights.get("/".join(k), 1)
            limit[k] = weight, sum(t for leaf, t in size.items() if leaf[: len(k)] == k) * max_epochs if weight else 0
        got, open_ = dict.fromkeys(kids, 0), [k for k in kids if limit[k][0]]
        budget = min(budget, sum(c for _, c in limit.values()))
        while open_:
            total = sum(limit[k][0] for k in open_)
            full = [k for k in open_ if limit[k][1] * total <= limit[k][0] * budget]
            if not full:
                break
            for k in full:
                got[k] = limit[k][1]
            budget -= sum(limit[k][1] for k in full)
            open_ = [k for k in open_ if k not in full]
        if open_:
            total, used = sum(limit[k][0] for k in open_), 0
            for k in open_:
                got[k] = budget * limit[k][0] // total
                used += got[k]
            for k in sorted(open_)[: budget - used]:
                got[k] += 1
        return got

    budgets = {(): sum(size.values()) * percent // 100}
    for level in (1, 2, 3):
        budgets = {
            k: v for p, b in budgets.items() for k, v in fill(b, sorted({x[:level] for x in size if x[: level - 1] == p})).items()
        }
    out = []
    for leaf, budget in budgets.items():
        if size[leaf]:
            epochs, rest = divmod(budget, size[leaf])
            out += [(i, e, n) for i, n in docs[leaf] for e in range(epochs)]
            for i, n in sorted(docs[leaf], key=lambda x: hashlib.md5(f"{seed}/{epochs}/{x[0]}".encode()).hexdigest()):
                if rest <= 0:
                    break
                out.append((i, epochs, min(n, rest)))
                rest -= n
    return sorted(out)


@pytest.mark.parametrize("percent", [5, 60, 130, 300])
@pytest.mark.parametrize("weights", [{}, {"a": 5, "a/en/s1": 7, "b/de": 3, "b/en": 0}])
def test_equals_plain_version(spark, percent, weights):
    draw = random.Random(percent)
    rows = []
    for i in range(400):
        source = draw.choice(["s1"] * 5 + ["s2", "s3", "s4"])
        rows.append((i, draw.choice("aab"), draw.choice(["en", "en", "de", "fr"]), source, draw.randint(1, 60)))
    docs = spark.createDataFrame([(i, "w " * n, lang, s, d) for i, d, lang, s, n in rows], "doc_id BIGINT, text STRING, lang STRING, source STRING, dom STRING")
    got = mixing.mix(docs, F.col("dom"), percent, weights, max_epochs=2)
    assert got.columns == [*docs.columns, "epoch", "taken_tokens"]
    assert sorted((r.doc_id, r.epoch, r.taken_tokens) for r in got.collect()) == brute(rows, percent, weights, 2, mixing.SEED)


def test_odd_rows(odd, empty):
    domain = F.lit(None).cast("string")
    every = mixing.mix(odd.withColumn("rest", F.lit(1)).withColumn("tokens", F.lit("a")).withColumn("epoch", F.lit(9)), domain, 100, max_epochs=1).collect()
    assert sum(r.taken_tokens for r in every) == sum(r.n for r in odd.select(F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).alias("n")).collect())
    assert all(r.epoch == 0 for r in every)
    half = mixing.mix(odd, domain, 50).collect()
    assert sum(r.taken_tokens for r in half) == sum(r.taken_tokens for r in every) // 2
    assert mixing.mix(empty, domain).count() == 0


def test_query_keeps_its_budget(spark, sf):
    rows = mixing.op1_mixing(spark, sf).collect()
    words = spark.read.parquet(f"{sf}/documents.parquet").agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert sum(r.taken_tokens for r in rows) == words * mixing.BUDGET_PERCENT // 100
