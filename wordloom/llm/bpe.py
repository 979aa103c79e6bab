"""Byte-pair encoding with public vocabularies, and decoding.

Merging: the symbols of a pre-token form a doubly linked list; a priority
queue holds the merge ranks of adjacent pairs, lowest rank first, then
leftmost. An entry is stale, and skipped, when its symbol is gone or its pair
no longer has the rank it was queued with.

Every distinct chunk between white space is encoded once per worker and kept
in a cache of bounded size, so no shuffle takes place and each row is
independent: a lost task repeats alone.

Defined results: a null text is encoded as the empty text, which gives no
token; texts are never cut; repeated rows each give their own result.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata

import numpy as np
import regex
from public_tokenizers import path as public_path
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from wordloom.llm.common import BoundedCache, add_columns, documents, worker_cache

#: Characters whose classes and case have not changed between Unicode versions, less the separators
#: that are white space to Python alone. Texts of other characters go through the library's own rules.
_PLAIN = re.compile("[^\x00-\x1b\x20-ɏ]")
#: Chunks, and pre-tokens, that one generation of a worker's caches holds.
CACHE_CHUNKS, CACHE_PRE_TOKENS = 120_000, 80_000
#: Longest pre-token whose ids are counted without a queue.
SHORT_BYTES = 48


def _byte_characters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


class ByteLevelBPE:
    """Ids of texts under a byte-level BPE vocabulary file of the tokenizers library.

    Handles the optional normalizer (composition, white space, lower case), a
    splitting pattern, an end-of-word suffix, and special strings in the text.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.special_split = re.compile("(" + "|".join(map(re.escape, special)) + ")")
        self.normalized = spec["normalizer"] is not None
        chars = _byte_characters()
        self.first = [vocab[c] for c in chars]
        self.last = [vocab[c + suffix] for c in chars] if suffix else self.first
        self.byte_of = {c: b for b, c in enumerate(chars)}
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for left, right in model["merges"]:
            self.ranks.setdefault(vocab[left] << 20 | vocab[right], len(self.merged))
            self.merged.append(vocab[left + right])
        self.pattern = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
            if self.normalized
            else r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        )

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token, given as bytes."""
        n = len(data)
        if n == 0:
            return []
        ids = [self.first[b] for b in data]
        ids[-1] = self.last[data[-1]]
        if n == 1:
            return ids
        rank_of, merged = self.ranks.get, self.merged
        queue = [r << 40 | i for i in range(n - 1) if (r := rank_of(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            entry = heapq.heappop(queue)
            i, rank = entry & 0xFFFFFFFFFF, entry >> 40
            j = after[i]
            if ids[i] < 0 or j == n or rank_of(ids[i] << 20 | ids[j]) != rank:
                continue  # stale
            ids[i], ids[j] = merged[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of(ids[i] << 20 | ids[k])) is not None:
                    heapq.heappush(queue, r << 40 | i)
            if (p := before[i]) >= 0 and (r := rank_of(ids[p] << 20 | ids[i])) is not None:
                heapq.heappush(queue, r << 40 | p)
        return [i for i in ids if i >= 0]

    def length(self, data: bytes) -> int:
        """Number of ids of one pre-token. In a short one the lowest rank is searched anew for each merge, which needs no queue."""
        n = len(data)
        if n > SHORT_BYTES or n == 0:
            return len(self.merge(data))
        first, rank_of, merged = self.first, self.ranks.get, self.merged
        ids = [first[b] for b in data]
        ids[-1] = self.last[data[-1]]
        none = len(merged)
        ranks = [rank_of(a << 20 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (rank := min(ranks)) < none:
            i = ranks.index(rank)  # the leftmost one
            ids[i] = new = merged[rank]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of(ids[i - 1] << 20 | new, none)
            if i < len(ranks):
                ranks[i] = rank_of(new << 20 | ids[i + 1], none)
        return len(ids)

    def pre_tokens(self, text: str) -> list[bytes]:
        """Pre-tokens of a normalized text."""
        if _PLAIN.search(text):
            byte_of = self.byte_of
            return [bytes([byte_of[c] for c in piece]) for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return [piece.encode() for piece in self.pattern.findall(text)]

    def parts(self, text: str) -> list[tuple[str, int | None]]:
        """The text cut at special strings: (text between, None) or (special string, its id)."""
        if not any(s in text for s in self.special):
            return [(text, None)]
        return [(p, self.special.get(p)) for p in self.special_split.split(text) if p]

    def chunks(self, text: str) -> list[str]:
        """Chunks of a text between which no pre-token reaches, for vocabularies that drop white space."""
        if _PLAIN.search(text):
            return self.library.normalizer.normalize_str(text).split(" ")
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
            return self.chunks(text)
        return text.lower().split()


class ChunkCache(BoundedCache):
    """chunk → ids as little-endian unsigned 32-bit integers; encodes what it lacks."""

    def __init__(self, bpe: ByteLevelBPE):
        self.bpe = bpe
        self.of_pre_token = BoundedCache(lambda p: np.array(bpe.merge(p), dtype="<u4").tobytes(), CACHE_PRE_TOKENS)
        super().__init__(self.encode, CACHE_CHUNKS)

    def encode(self, chunk: str) -> bytes:
        return b"".join([self.of_pre_token[p] for p in self.bpe.pre_tokens(chunk)])


@functools.cache
def vocabulary_strings(path: str) -> list[str]:
    """The string of each id."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    ids = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    strings = [""] * (1 + max(ids.values()))
    for token, i in ids.items():
        strings[i] = token
    return strings


@functools.cache
def load(path: str) -> ByteLevelBPE:
    return ByteLevelBPE(path)


@functools.cache
def chunk_cache(path: str) -> ChunkCache:
    return ChunkCache(load(path))


def text_ids(cache: ChunkCache, text: str) -> bytes:
    """Ids of a whole text, four bytes each."""
    bpe, known = cache.bpe, cache.__getitem__
    return b"".join(
        b"".join(map(known, bpe.chunks(part))) if i is None else np.array([i], "<u4").tobytes()
        for part, i in bpe.parts(text)
    )


def _cache(path: str) -> ChunkCache:
    worker_cache("bpe", chunk_cache.cache_clear)
    return chunk_cache(path)


def _joined(strings: list[str], ids: bytes | None) -> str | None:
    return None if ids is None else " ".join([strings[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``token_ids`` (binary: little-endian unsigned 32-bit integers) and ``n_tokens`` to the rows.

    ``path`` names a vocabulary whose pre-tokens do not hold white space and that
    has an end-of-word suffix. Special strings in a text become their ids; none are added.
    """

    def start():
        cache = _cache(path)

        def work(texts):
            ids = [text_ids(cache, t or "") for t in texts]
            return ids, [len(x) // 4 for x in ids]

        return work

    return add_columns(df, [text], "token_ids BINARY, n_tokens BIGINT", start)


def decode(df: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Add the text of encoded ids: their vocabulary strings, joined by spaces as the vocabulary has no decoder.

    Null ids give a null text.
    """

    def start():
        strings = vocabulary_strings(path)
        return lambda rows: [[_joined(strings, x) for x in rows]]

    return add_columns(df, [ids], f"`{out}` STRING", start)


def encode_and_decode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``encode``, then ``decode`` of its ids, in one pass over the rows; the column ``text`` is left out."""

    def start():
        cache, strings = _cache(path), vocabulary_strings(path)

        def work(texts):
            ids = [text_ids(cache, t or "") for t in texts]
            return ids, [len(x) // 4 for x in ids], [_joined(strings, x) for x in ids]

        return work

    return add_columns(df, [text], "token_ids BINARY, n_tokens BIGINT, decoded STRING", start, drop=[text])


def word_vocabulary() -> str:
    return public_path("word_bpe_49k.json")


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return encode_and_decode(documents(spark, folder).select("doc_id", "text"), word_vocabulary()).select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
