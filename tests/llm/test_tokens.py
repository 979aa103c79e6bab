"""BPE, token counts and quality rules against the libraries and brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wordloom.llm import bpe, quality, token_counts
from wordloom.llm.common import BoundedCache, fold_text, words_of

WORD_BPE, BYTE_BPE = path("word_bpe_49k.json"), path("byte_bpe_50k.json")
ALPHABET = list("abcABC'12 \t\n\r\x0b\x0c\x1c\x1f\x85\xa0é́ß.,!$İſǅ ３　日本Ωςاव😀 ") + [
    "<|endoftext|>", "<|startoftext|>", "'s", "'ll", "  ", "the", "ing",
]


def fuzz(n, seed=3):
    draw = random.Random(seed)
    return ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 40))) for _ in range(n)]


def test_encode_equals_library():
    library, cache = Tokenizer.from_file(WORD_BPE), bpe.chunk_cache(WORD_BPE)
    for text in fuzz(3000):
        assert np.frombuffer(bpe.text_ids(cache, text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_count_equals_library():
    library, coder = Tokenizer.from_file(BYTE_BPE), bpe.load(BYTE_BPE)
    for text in fuzz(3000, 4):
        pieces, special = token_counts._all_pieces(coder, text)
        n = sum(len(coder.merge(p.encode("utf-8", "surrogateescape"))) for p in pieces) + special
        assert n == len(library.encode(text, add_special_tokens=False).ids)


def test_encode_decode_rows(odd, spark):
    library = Tokenizer.from_file(WORD_BPE)
    clash = odd.withColumnRenamed("lang", "TOKEN_IDS").withColumnRenamed("source", "decoded")
    rows = bpe.decode(bpe.encode(clash, WORD_BPE), WORD_BPE).collect()
    assert len(rows) == odd.count()
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.token_ids), "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_bpe_query(spark, sf):
    library = Tokenizer.from_file(WORD_BPE)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in bpe.op2_bpe(spark, sf).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_counts_of_rows(odd):
    library = Tokenizer.from_file(BYTE_BPE)
    for r in token_counts.count_tokens(odd, BYTE_BPE).collect():
        text = r.text or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(library.encode(text, add_special_tokens=False).ids))
        assert r.over_limit == (r.n_tokens > 512)


def test_frequent_table_is_bounded(odd, monkeypatch):
    assert token_counts.frequent_pre_tokens(odd, BYTE_BPE).num_rows > 5
    monkeypatch.setattr(token_counts, "HOT_TOKENS", 5)
    assert 0 < token_counts.frequent_pre_tokens(odd, BYTE_BPE).num_rows <= 5
    monkeypatch.setattr(token_counts, "HOT_TOKENS", 0)
    assert token_counts.frequent_pre_tokens(odd, BYTE_BPE).num_rows == 0


def test_bounded_cache_forgets_but_answers():
    cache = BoundedCache(lambda k: k * 2, 3)
    assert [cache[k] for k in (1, 2, 3, 4, 1, 9, 1)] == [2, 4, 6, 8, 2, 18, 2]
    assert len(cache) <= 3 and len(cache.old) <= 3


def test_words_and_folding():
    for text in fuzz(2000, 5):
        assert words_of(text) == re.findall(r"[^\x20\x09-\x0D]+", text)
        assert fold_text(text) == "".join(c.lower() if c.isascii() else c for c in text)


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@pytest.mark.parametrize("which", ["odd", "sf"])
def test_quality_counts(which, request, spark, sf):
    docs = request.getfixturevalue("odd") if which == "odd" else spark.read.parquet(f"{sf}/documents.parquet")
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, r.text)
    rows = quality.judge(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        n = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert n == brute_quality(texts[r.doc_id])
        assert r.base_failed == (n[0] < 20 or 100 * n[4] > 30 * n[0])
        assert not (r.base_failed and r.kept)


def test_bands_reject_symbols_and_keep_prose(spark):
    draw = random.Random(1)
    syllables = "the and ing ion er th on re at en".split()
    prose = [" ".join("".join(draw.choice(syllables) for _ in range(draw.randint(1, 3))) for _ in range(100)) for _ in range(120)]
    junk = [" ".join(w + "###$$$" for w in p.split()) for p in prose[:3]]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(prose + junk)], "doc_id BIGINT, text STRING, lang STRING")
    kept = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
    assert sum(kept[i] for i in range(120)) >= 119 and not any(kept[i] for i in range(120, 123))


def test_empty_tables(empty):
    assert bpe.encode(empty, WORD_BPE).count() == 0
    assert token_counts.count_tokens(empty, BYTE_BPE).count() == 0
    assert quality.judge(empty).count() == 0


def test_table_of_few_rows_changes_no_count(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, BYTE_BPE).collect()}
    monkeypatch.setattr(token_counts, "SAMPLE_ROWS", 10)
    assert token_counts.frequent_pre_tokens(docs, BYTE_BPE).num_rows > 0
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, BYTE_BPE).collect()} == want


def test_frequent_table_is_fitted_on_all_rows(spark, monkeypatch):
    n, staged, stage = 150_000, [], token_counts.stage
    texts = spark.range(n).select(F.concat(F.lit("one two"), F.when(F.col("id") % 2 == 0, " three").otherwise("")).alias("text"))
    monkeypatch.setattr(token_counts, "stage", lambda df, name: staged.append(stage(df, name)) or staged[-1])
    token_counts.frequent_pre_tokens(texts, BYTE_BPE)
    assert {r.piece: r.n for r in staged[0].collect()} == {"one": n, " two": n, " three": n // 2}


def test_table_decides_no_count(spark, sf, monkeypatch):
    """Neither a table of few rows nor an empty one; nor a cache that forgets."""
    docs, fitted = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), token_counts.frequent_pre_tokens
    want = sorted((r.doc_id, r.n_tokens) for r in token_counts.count_tokens(docs, BYTE_BPE).collect())
    for rows in (10, 0):
        monkeypatch.setattr(token_counts, "frequent_pre_tokens", lambda df, path, text: fitted(df.limit(rows), path, text))
        assert sorted((r.doc_id, r.n_tokens) for r in token_counts.count_tokens(docs, BYTE_BPE).collect()) == want


def test_tiers_keep_the_frequent_ones():
    made = []
    tiers = token_counts._Tiers({"a": 1, "b": 2}, lambda p: made.append(p) or len(p), 2)
    assert [tiers[p] for p in ("a", "xxx", "yyyy", "xxx", "zzzzz", "b", "a", "xxx")] == [1, 3, 4, 3, 5, 2, 1, 3]
    assert made == ["xxx", "yyyy", "zzzzz"] and len(tiers) <= 4


def test_plain_texts_are_cut_as_by_the_pattern():
    coder = bpe.load(BYTE_BPE)
    plain = [c for c in map(chr, range(0x250)) if not bpe._PLAIN.search(c)]
    for c in plain:
        text = f"a{c}1{c}{c} {c}.{c}\n{c} '{c}'s"
        assert token_counts._pieces(coder, text) == coder.pattern.findall(text)
    draw = random.Random(6)
    some = plain[:0x60] + ["'s", "'ve", "'ll", "  ", " \n", "\xa0", "\x85", "\xb2", "\xbd", "\xe9"] * 5
    for _ in range(3000):
        text = "".join(draw.choice(some) for _ in range(40))
        assert token_counts._pieces(coder, text) == coder.pattern.findall(text)


@pytest.mark.parametrize("vocabulary", [WORD_BPE, BYTE_BPE])
def test_length_is_that_of_the_merged_ids(vocabulary, monkeypatch):
    coder, draw = bpe.load(vocabulary), random.Random(7)
    pieces = [x.encode() for t in fuzz(2000, 8) for x in t.split()] + [bytes(draw.choices(b"abeinst", k=k)) for k in range(120)] + [b"", b"a" * 47, b"a" * 48, b"a" * 49]
    assert [coder.length(p) for p in pieces] == [len(coder.merge(p)) for p in pieces]
    monkeypatch.setattr(bpe, "SHORT_BYTES", 1_000)
    assert [coder.length(p) for p in pieces] == [len(coder.merge(p)) for p in pieces]
