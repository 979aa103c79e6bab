"""Token counts without encoding whole texts.

Two tiers, both on the map side:

1. A compact table of frequent pre-tokens and their numbers of tokens is
   broadcast. It is fitted on all rows: every task counts the pre-tokens
   of its texts and hands on its most frequent ones, at most ``PER_TASK``; their
   summed counts rank the candidates, of which the first ``HOT_TOKENS`` make
   the table. These short lists are all that is shuffled. The table decides
   speed, never results: what it lacks is encoded.
2. Any other pre-token is encoded by the worker that meets it and remembered
   in a bounded cache. The texts' own pre-tokens are never shuffled.

Defined results: a null text counts as the empty text (0 bytes, 0 tokens);
texts are counted whole; repeated rows each give their own count.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter
from operator import itemgetter

import pyarrow as pa
from public_tokenizers import path as public_path
from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom.llm import bpe
from wordloom.llm.common import BoundedCache, add_columns, documents, least_of_most, worker_cache
from wordloom.staging import stage

#: Bounds of the broadcast table: entries, candidates of one task, bytes of one pre-token.
HOT_TOKENS, PER_TASK, HOT_BYTES = 65_536, 4_096, 64
#: Read by nothing, as the table is fitted on all rows; a test sets it.
SAMPLE_ROWS = None
COUNTED_TOKENS, CACHE_TOKENS = 300_000, 300_000
TOKEN_LIMIT = 512


def _plain_pattern() -> re.Pattern:
    """The splitting pattern for texts of characters that ``bpe._PLAIN`` lets pass, with letters and numbers written out."""
    plain = [c for c in map(chr, range(0x250)) if not bpe._PLAIN.match(c)]
    letters, numbers = ("".join(re.escape(c) for c in plain if unicodedata.category(c)[0] == kind) for kind in "LN")
    return re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{letters}]+| ?[{numbers}]+| ?[^\s{letters}{numbers}]+|\s+(?!\S)|\s+")


_PLAIN_PIECES = _plain_pattern()


def _pieces(coder: bpe.ByteLevelBPE, text: str) -> list[str]:
    """Pre-tokens of a text without special strings, as text."""
    if bpe._PLAIN.search(text):
        byte_of = coder.byte_of
        return [
            bytes([byte_of[c] for c in piece]).decode("utf-8", "surrogateescape")
            for piece, _ in coder.library.pre_tokenizer.pre_tokenize_str(text)
        ]
    return _PLAIN_PIECES.findall(text)


def _all_pieces(coder: bpe.ByteLevelBPE, text: str) -> tuple[list[str], int]:
    """(pre-tokens, number of special strings)."""
    if not any(s in text for s in coder.special):
        return _pieces(coder, text), 0
    parts = coder.parts(text)
    return [x for p, i in parts if i is None for x in _pieces(coder, p)], sum(i is not None for _, i in parts)


def frequent_pre_tokens(df: DataFrame, path: str, text: str = "text") -> pa.Table:
    """(piece, n_tokens) of the most frequent pre-tokens: at most ``HOT_TOKENS`` rows."""

    def most_common(seen: Counter, most: int) -> list[tuple[str, int]]:
        # As ``Counter.most_common``, whose heap takes longer than sorting.
        return sorted(seen.items(), key=itemgetter(1), reverse=True)[:most]

    def count(batches):
        coder, seen = bpe.load(path), Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    seen.update(_all_pieces(coder, t)[0])
                if len(seen) > COUNTED_TOKENS:  # bounds the task's memory
                    seen = Counter(dict(most_common(seen, COUNTED_TOKENS // 4)))
        top = [(p, n) for p, n in most_common(seen, PER_TASK) if n > 1 and len(p.encode("utf-8", "surrogateescape")) <= HOT_BYTES]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"]
        )

    ranked = df.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "piece STRING, n BIGINT")
    sums = stage(ranked.groupBy("piece").agg(F.sum("n").alias("n")), "pre-tokens")
    least = least_of_most(sums, "n", HOT_TOKENS)
    top = sums.where(F.lit(False) if least is None else F.col("n") >= least)

    def lengths():
        coder = bpe.load(path)
        return lambda pieces: [[coder.length(p.encode()) for p in pieces]]

    return add_columns(top, ["piece"], "n_tokens INT", lengths).select("piece", "n_tokens").toArrow()


def _packed(table: pa.Table) -> tuple[bytes, bytes, bytes]:
    """(all pieces in one string, end of each piece, tokens of each piece)."""
    import numpy as np

    pieces = [p.encode() for p in table.column("piece").to_pylist()]
    ends = np.cumsum([len(p) for p in pieces], dtype=np.uint32).tobytes()
    return b"".join(pieces), ends, np.array(table.column("n_tokens").to_pylist(), np.uint8).tobytes()


class _Tiers(BoundedCache):
    """The frequent pre-tokens, which stay, and two generations of others."""

    def __init__(self, hot: dict[str, int], compute, size: int):
        super().__init__(compute, size + len(hot))
        self.hot = hot
        self.update(hot)

    def clear(self):
        super().clear()
        self.update(self.hot)


@functools.lru_cache(maxsize=1)
def _opened(packed: tuple[bytes, bytes, bytes], path: str) -> BoundedCache:
    """The broadcast table with the worker's cache of misses behind it."""
    import numpy as np

    joined, ends, lengths = packed[0], np.frombuffer(packed[1], np.uint32).tolist(), np.frombuffer(packed[2], np.uint8).tolist()
    coder = bpe.load(path)
    hot = {joined[a:b].decode(): n for a, b, n in zip([0, *ends], ends, lengths)}
    return _Tiers(hot, lambda p: coder.length(p.encode("utf-8", "surrogateescape")), CACHE_TOKENS)


def count_tokens(df: DataFrame, path: str, text: str = "text", limit: int = TOKEN_LIMIT, drop: tuple[str, ...] = ()) -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) to the rows, without the columns of ``drop``."""
    packed = df.sparkSession.sparkContext.broadcast(_packed(frequent_pre_tokens(df, path, text)))

    def start():
        worker_cache("token_counts", _opened.cache_clear)
        tiers, coder = _opened(packed.value, path), bpe.load(path)
        known = tiers.__getitem__

        def work(texts):
            bytes_, counts = [], []
            for t in texts:
                t = t or ""
                pieces, specials = _all_pieces(coder, t)
                bytes_.append(len(t.encode()))
                counts.append(sum(map(known, pieces)) + specials)
            return bytes_, counts, [n > limit for n in counts]

        return work

    return add_columns(df, [text], "n_bytes BIGINT, n_tokens BIGINT, over_limit BOOLEAN", start, drop=drop)


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document under the 50k byte-level vocabulary."""
    docs = documents(spark, folder).select("doc_id", "text")
    return count_tokens(docs, public_path("byte_bpe_50k.json"), drop=("text",))
