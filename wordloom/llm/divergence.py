"""Source divergence audit: term shares of every source against its language and its other sources.

1. Exact frequency filter: documents that hold a term are counted per language; tasks combine their counts in
   bounded tables before the shuffle. Terms in at least ``MIN_DOCS`` documents of a language are kept.
2. The kept (language, term) keys are cut into shards by hash. A task builds each shard's minimal perfect hash: levels of bits in
   which a key takes a place that no other key wants; its number is the count of taken places before it. The
   keys themselves stand beside it in that order.
3. The shards are broadcast, at most ``ROUND_KEYS`` keys or ``ROUND_BYTES`` at a time, and the texts are counted again in one pass for
   each such round. A task probes the distinct terms of a group, compares each with the stored key, and increments the slot of
   its number in the group's dense array. Arrays hold at most ``SLOTS`` slots, then their counts leave the task.
4. Counts are summed per group and slot. Every group meets the others of its language in tiles of at most about
   ``BLOCK`` x ``BLOCK`` sources and ``CHUNK`` slots, which add up to the distances; terms are ranked by Spark's window.

Shares are whole numbers: 1 + floor(10^9 (count + 5) / (N + 5 V)), by long division in three steps, so 64 bits are exact up
to 9 * 10^15 occurrences. Slots without an occurrence in either of two sources have the same difference everywhere and are
added by number.

Defined results: null texts, languages and sources are empty strings; a document is a row, so repeated rows count
each; a language without kept terms has distances 0; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wordloom.llm.common import LOWER, UPPER, documents, pieces
from wordloom.staging import stage

MIN_DOCS, TOP, SMOOTHING, SCALE = 30, 50, 5, 1_000_000_000
#: Bounds of a shard, and of the shards that are broadcast together.
SHARD_KEYS, SHARD_BYTES = 50_000, 4 << 20
ROUND_KEYS, ROUND_BYTES = 4_000_000, 64 << 20
#: Distinct terms and bytes of text that a task counts before it passes them on; dense slots that it holds.
HELD_TERMS, HELD_BYTES, SLOTS = 200_000, 64 << 20, 4_000_000
#: Sources and slots of a tile.
BLOCK, CHUNK = 256, 8_192
#: Letters and all other characters beyond ASCII make terms, A-Z in lower case; the rest separates them.
_TERMS = bytes(b if b > 127 or chr(b) in LOWER else ord(chr(b).lower()) if chr(b) in UPPER else 32 for b in range(256))
#: Spark's xxhash64 has this seed, so both sides put a key into the same shard.
_SEED, _GAMMA, _LEVELS = 42, 2, 32


def term_lists(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in parts."""
    for part in pieces(raw.translate(_TERMS)):
        yield part.split()


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def hashes(keys: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(k, _SEED) for k in keys), np.uint64, len(keys))


@dataclass
class KeyIndex:
    """A minimal perfect hash with its keys: n distinct keys are numbered 0 to n-1, every other one -1."""

    sizes: np.ndarray  # bits of each level
    words: np.ndarray  # all levels, 64 bits a word
    ends: np.ndarray  # where the key of each number ends in ``text``
    text: bytes

    @classmethod
    def build(cls, keys: list[bytes]) -> KeyIndex:
        hashed = hashes(keys)
        sizes, levels, left = [], [], np.arange(len(keys))
        order: list[np.ndarray] = []
        for level in range(_LEVELS):
            if len(left) == 0:
                break
            size = (_GAMMA * len(left) + 63) // 64 * 64
            place = (_mix(hashed[left], level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            mine = alone[place]
            order.append(left[mine][np.argsort(place[mine])])
            left = left[~mine]
        order.append(left)  # none, unless two keys have one hash
        ordered = [keys[i] for i in np.concatenate(order)]
        ends = np.cumsum([len(k) for k in ordered], dtype=np.int64)
        words = np.concatenate(levels) if levels else np.zeros(0, np.uint64)
        return cls(np.array(sizes, np.int64), words, ends, b"".join(ordered))

    def __post_init__(self):
        self.before = np.cumsum(np.bitwise_count(self.words), dtype=np.int64) - np.bitwise_count(self.words)
        self.placed = int(np.bitwise_count(self.words).sum())

    def key(self, number: int) -> bytes:
        return self.text[self.ends[number - 1] if number else 0 : self.ends[number]]

    def numbers(self, keys: list[bytes], hashed: np.ndarray) -> np.ndarray:
        """The number of each key; the stored key decides whether it is one."""
        found, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if len(left) == 0:
                break
            place = base + (_mix(hashed[left], level) % np.uint64(size)).astype(np.int64)
            word, bit = self.words[place >> 6], (place & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            under = word & ((np.uint64(1) << bit) - np.uint64(1))
            found[left[hit]] = (self.before[place >> 6] + np.bitwise_count(under))[hit]
            left, base = left[~hit], base + size
        for i, number in enumerate(found.tolist()):
            if number >= 0 and self.key(number) != keys[i]:
                found[i] = -1
        if self.placed < len(self.ends):
            late = {self.key(k): k for k in range(self.placed, len(self.ends))}
            for i, key in enumerate(keys):
                found[i] = late.get(key, found[i])
        return found

    def packed(self) -> list[bytes]:
        return [self.sizes.tobytes(), self.words.tobytes(), self.ends.tobytes(), self.text]

    @classmethod
    def unpacked(cls, parts: list[bytes]) -> KeyIndex:
        return cls(np.frombuffer(parts[0], np.int64), np.frombuffer(parts[1], np.uint64), np.frombuffer(parts[2], np.int64), parts[3])


_PARTS = ("sizes", "words", "ends", "keys")


def _texts(df: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    columns = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (lang, source, text)]
    return df.select(columns[0].alias("lang"), columns[1].alias("source"), columns[2].cast("binary").alias("raw"))


def document_counts(texts: DataFrame) -> DataFrame:
    """(lang, term, docs): documents of the language that hold the term; ``term`` in UTF-8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        held = read = 0

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, found in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(lang, pa.string()), len(found)), pa.array(list(found), pa.binary()), pa.array(found.values(), pa.int64())],
                    names=["lang", "term", "docs"],
                )

        for batch in batches:
            for lang, raw in zip(batch.column("lang").to_pylist(), batch.column("raw")):
                raw, seen = raw.as_py(), set()
                for terms in term_lists(raw):
                    seen.update(terms)
                found = counts[lang]
                held -= len(found)
                found.update(seen)
                held += len(found)
                read += len(raw)
                if held > HELD_TERMS or read > HELD_BYTES:
                    yield from rows()
                    counts, held, read = defaultdict(Counter), 0, 0
        yield from rows()

    found = texts.select("lang", "raw").mapInArrow(run, "lang STRING, term BINARY, docs BIGINT")
    return found.groupBy("lang", "term").agg(F.sum("docs").alias("docs"))


def shards_of(kept: DataFrame) -> DataFrame:
    """(shard, n, bytes, and the parts of its index): the kept (lang, term), cut by hash."""
    keyed = kept.select(F.concat(F.col("lang").cast("binary"), F.lit(b"\0"), "term").alias("key"))
    n, size = keyed.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("key")), F.lit(0))).first()
    shards = max(1, -(-n // SHARD_KEYS), -(-size // SHARD_BYTES))

    def build(key: tuple, table: pa.Table) -> pa.Table:
        index = KeyIndex.build(table["key"].to_pylist())
        parts = index.packed()
        head = {"shard": [key[0].as_py()], "shards": [shards], "n": [len(index.ends)], "bytes": [sum(map(len, parts))]}
        arrays = {c: pa.array(x, pa.int64()) for c, x in head.items()}
        return pa.table(arrays | {p: pa.array([x], pa.binary()) for p, x in zip(_PARTS, parts)})

    schema = "shard BIGINT, shards BIGINT, n BIGINT, bytes BIGINT, " + ", ".join(f"{p} BINARY" for p in _PARTS)
    return keyed.groupBy(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")).applyInArrow(build, schema)


def rounds_of(shards: DataFrame) -> list[dict[int, int]]:
    """Shards that are broadcast together, each with the slot of its first key. One row per shard comes to the driver."""
    rounds: list[dict[int, int]] = []
    first = keys = size = 0
    for shard, n, weight in sorted(shards.select("shard", "n", "bytes").collect()):
        if not rounds or keys + n > ROUND_KEYS or size + weight > ROUND_BYTES:
            rounds.append({})
            keys = size = 0
        rounds[-1][shard] = first
        first, keys, size = first + n, keys + n, size + weight
    return rounds


def _recount(texts: DataFrame, shards: DataFrame, firsts: dict[int, int]) -> DataFrame:
    """(lang, source, slot, n): occurrences of the keys of one round, partly summed."""
    rows = shards.where(F.col("shard").isin(list(firsts))).select("shard", "shards", *_PARTS).toArrow()
    parts = {s: [rows[p][i].as_py() for p in _PARTS] for i, s in enumerate(rows["shard"].to_pylist())}
    n_shards = rows["shards"][0].as_py()
    sent = texts.sparkSession.sparkContext.broadcast(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {s: KeyIndex.unpacked(p) for s, p in sent.value.items()}
        counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
        dense: dict[tuple[str, str, int], np.ndarray] = {}
        held = read = slots = 0

        def increment() -> Iterator[pa.RecordBatch]:
            """Move the counts of terms to the dense slots of their groups."""
            nonlocal slots
            for (lang, source), found in counts.items():
                mark = lang.encode() + b"\0"
                keys, times = [mark + t for t in found], np.fromiter(found.values(), np.int64, len(found))
                hashed = hashes(keys)
                shard = hashed.view(np.int64) % n_shards
                for s in np.unique(shard).tolist():
                    if s not in index:
                        continue
                    mine = np.flatnonzero(shard == s)
                    number = index[s].numbers([keys[i] for i in mine], hashed[mine])
                    known = number >= 0
                    if not known.any():
                        continue
                    at = (lang, source, s)
                    if at not in dense:
                        if slots + len(index[s].ends) > SLOTS:
                            yield from rows()
                        dense[at] = np.zeros(len(index[s].ends), np.int64)
                        slots += len(dense[at])
                    dense[at][number[known]] += times[mine][known]  # the keys of a group are distinct

        def rows() -> Iterator[pa.RecordBatch]:
            nonlocal slots
            for (lang, source, s), array in dense.items():
                used = np.flatnonzero(array)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(pa.scalar(lang, pa.string()), len(used)), pa.repeat(pa.scalar(source, pa.string()), len(used)),
                        pa.array(used + firsts[s]), pa.array(array[used]),
                    ],
                    names=["lang", "source", "slot", "n"],
                )
            dense.clear()
            slots = 0

        for batch in batches:
            for lang, source, raw in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("raw")):
                found = counts[lang, source]
                held -= len(found)
                for terms in term_lists(raw := raw.as_py()):
                    found.update(terms)
                held += len(found)
                read += len(raw)
                if held > HELD_TERMS or read > HELD_BYTES:
                    yield from increment()
                    counts, held, read = defaultdict(Counter), 0, 0
        yield from increment()
        yield from rows()

    return texts.mapInArrow(run, "lang STRING, source STRING, slot BIGINT, n BIGINT")


def recount(texts: DataFrame, shards: DataFrame) -> DataFrame:
    """(lang, source, slot, n): occurrences of every kept term in every group that holds it."""
    parts = []
    for firsts in rounds_of(shards):
        partly = _recount(texts, shards, firsts)
        parts.append(stage(partly.groupBy("lang", "source", "slot").agg(F.sum("n").alias("n")), "divergence-counts"))
    if not parts:
        return texts.sparkSession.createDataFrame([], "lang STRING, source STRING, slot BIGINT, n BIGINT")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def numbered_terms(shards: DataFrame) -> DataFrame:
    """(slot, lang, term) of all kept terms."""
    firsts = {s: first for r in rounds_of(shards) for s, first in r.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                index = KeyIndex.unpacked([row[p] for p in _PARTS])
                cut = [index.key(i).rpartition(b"\0") for i in range(len(index.ends))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(firsts[row["shard"]] + np.arange(len(cut))),
                        pa.array([c[0].decode() for c in cut], pa.string()), pa.array([c[2].decode() for c in cut], pa.string()),
                    ],
                    names=["slot", "lang", "term"],
                )

    return shards.select("shard", *_PARTS).mapInArrow(run, "slot BIGINT, lang STRING, term STRING")


def share(count: str, total: str, kinds: str) -> Column:
    """1 + floor(SCALE (count + SMOOTHING) / (total + SMOOTHING kinds)), of columns; null without kinds."""
    base = f"({total} + {SMOOTHING} * {kinds})"
    rest, digits = f"({count} + {SMOOTHING})", []
    for _ in range(3):
        digits.append(f"({rest} * 1000 div {base})")
        rest = f"({rest} * 1000 % {base})"
    return F.expr(f"CASE WHEN {kinds} > 0 THEN 1 + ({digits[0]} * 1000 + {digits[1]}) * 1000 + {digits[2]} END")


def shares(count: np.ndarray, total: int, kinds: int) -> np.ndarray:
    """The same of arrays."""
    base, rest, out = total + SMOOTHING * kinds, count + SMOOTHING, 0
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, base)
        out = out * 1000 + digit
    return out + 1


def _tile(key: tuple, table: pa.Table) -> pa.Table:
    """Summed differences of the sources of two blocks, beyond those of slots without an occurrence."""
    lang, low, high = key[0].as_py(), key[2].as_py(), key[3].as_py()
    # Spark hands rows over in any order.
    rows = sorted(table.select(["source", "block", "total", "kinds", "cells"]).to_pylist(), key=lambda r: (r["block"] != low, r["source"]))
    cells = [np.array([(c["slot"], c["n"]) for c in r["cells"] or ()], np.int64).reshape(-1, 2) for r in rows]
    used = np.unique(np.concatenate([c[:, 0] for c in cells])) if cells else np.zeros(0, np.int64)
    base = np.array([shares(np.zeros(1, np.int64), r["total"], r["kinds"])[0] for r in rows], np.int64)
    matrix = np.repeat(base[:, None], len(used), axis=1)
    for row, cell, into in zip(rows, cells, matrix):
        into[np.searchsorted(used, cell[:, 0])] = shares(cell[:, 1], row["total"], row["kinds"])
    left = sum(r["block"] == low for r in rows)
    out: tuple[list, list, list] = ([], [], [])
    for i in range(left):
        after = i + 1 if low == high else left
        delta = np.abs(matrix[after:] - matrix[i]).sum(axis=1) - len(used) * np.abs(base[after:] - base[i])
        for j, d in enumerate(delta.tolist(), after):
            pair = sorted((rows[i]["source"], rows[j]["source"]), key=str.encode)
            for column, value in zip(out, (*pair, d)):
                column.append(value)
    return pa.table(
        {"lang": pa.array([lang] * len(out[0]), pa.string()), "one": pa.array(out[0], pa.string()), "two": pa.array(out[1], pa.string()), "delta": pa.array(out[2], pa.int64())}
    )


def pair_distances(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, item, value): distance of every source to the others of its language."""
    chunk = F.expr(f"slot div {CHUNK}").alias("chunk")
    cells = counts.groupBy("lang", "source", chunk).agg(F.collect_list(F.struct("slot", "n")).alias("cells"))
    cells = stage(cells, "divergence-cells")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("sources") / BLOCK)).cast("long")
    tiled = groups.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("source"), "blocks"))
    rows = tiled.join(cells.select("lang", "chunk").distinct(), "lang").join(cells, ["lang", "source", "chunk"], "left")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    deltas = rows.groupBy("lang", "chunk", "low", "high").applyInArrow(_tile, "lang STRING, one STRING, two STRING, delta BIGINT")
    summed = deltas.groupBy("lang", "one", "two").agg(F.sum("delta").alias("delta"))

    ends = groups.withColumn("nothing", F.lit(0)).withColumn("base", share("nothing", "total", "kinds"))
    one, two = (ends.select("lang", F.col("source").alias(s), F.col("base").alias(f"base_{s}"), "kinds") for s in ("one", "two"))
    pairs = one.join(two.drop("kinds"), "lang").where("one < two").join(summed, ["lang", "one", "two"], "left")
    value = F.coalesce(F.col("kinds") * F.abs(F.col("base_one") - F.col("base_two")) + F.coalesce("delta", F.lit(0)), F.lit(0))
    pairs = stage(pairs.select("lang", "one", "two", value.alias("value")), "divergence-pairs")
    return pairs.selectExpr("lang", "one AS source", "two AS item", "value").union(pairs.selectExpr("lang", "two", "one", "value"))


def audit(
    df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS, top: int = TOP
) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair``, the distance of a source to every other one of its
    language; ``term``, the ``top`` terms that it overuses most against its language.
    """
    texts = _texts(df, lang, source, text)
    kept = stage(document_counts(texts).where(F.col("docs") >= min_docs).select("lang", "term"), "divergence-kept")
    shards = stage(shards_of(kept), "divergence-shards")
    counts = recount(texts, shards)

    kinds = kept.groupBy("lang").agg(F.count("*").alias("kinds"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = texts.select("lang", "source").distinct()
    groups = every.join(totals, ["lang", "source"], "left").join(kinds, "lang", "left").na.fill(0, ["total", "kinds"])
    groups = stage(groups, "divergence-groups")
    sizes = groups.groupBy("lang").agg(F.count("*").alias("sources"), F.sum("total").alias("lang_total"))
    groups = stage(groups.join(sizes, "lang"), "divergence-sources")

    of_slot = counts.groupBy("slot").agg(F.sum("n").alias("lang_n"))
    named = stage(numbered_terms(shards).select("slot", "term").join(of_slot, "slot"), "divergence-terms")
    cells = counts.join(named, "slot").join(groups, ["lang", "source"])
    over = cells.select("lang", "source", F.col("term").alias("item"),
                        (share("n", "total", "kinds") - share("lang_n", "lang_total", "kinds")).alias("value")).where("value > 0")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    pairs = pair_distances(groups, counts).withColumn("rank", F.row_number().over(order))
    columns = ("lang", "source", "part", "item", "value", "rank")
    return pairs.withColumn("part", F.lit("pair")).select(*columns).union(terms.withColumn("part", F.lit("term")).select(*columns))


def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Distances between the sources of each language and the terms that they overuse."""
    return audit(documents(spark, folder))


OP11_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (
    SELECT row_no, lang, source, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM docs
), kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT row_no) >= {MIN_DOCS}),
groups AS (SELECT DISTINCT lang, source FROM docs),
counted AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
cells AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
    FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), kinds AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY lang, source),
of_lang AS (SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total FROM cells GROUP BY lang, term),
shares AS (
    SELECT c.lang, c.source, c.term, c.n, 1 + ({SCALE}::HUGEINT * (c.n + 5)) // (t.total + 5 * k.v)::HUGEINT AS p,
           1 + ({SCALE}::HUGEINT * (l.n + 5)) // (l.total + 5 * k.v)::HUGEINT AS q
    FROM cells c JOIN totals t ON c.lang = t.lang AND c.source = t.source JOIN kinds k ON c.lang = k.lang
    JOIN of_lang l ON c.lang = l.lang AND c.term = l.term
), sums AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
