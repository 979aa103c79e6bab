"""Line deduplication over sharded minimal perfect hashes.

1. Every text is cut into lines once; the keys of its lines, long enough to count, become two 64-bit
   hashes each. Only hashes travel from here on.
2. Hashes are counted by document with map-side combination: documents, largest id.
3. Distinct hashes are cut into shards of about ``SHARD_KEYS``. A shard is a
   minimal perfect hash (levels of bit arrays in which a key takes a place
   that no other key wants) that numbers its keys, and three arrays by that number:
   32-bit fingerprint (in the broadcast shard, which settles lines on the spot, the whole second hash), document count up to 255, largest id.
4. Documents probe the arrays. The at most ``HOT_KEYS`` most frequent keys form
   one shard that is broadcast and probed where the documents are; no other key has more than
   1/HOT_KEYS of all lines, so the probes sent to the other shards are even.
5. Only texts that may lose a line are shuffled to meet their line numbers; the others pass through the scan.

Defined results: a null or empty text is one empty line; a document is an id, so rows that repeat an id count
once for a line; a row with a null id counts for nothing and is never the holder; lines without
a counted key stay; within the holder all its lines stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom.llm.common import add_columns, documents, least_of_most, may_hold, nested, without
from wordloom.staging import stage

#: Least code points of a counted key, least documents that make its lines go.
MIN_CHARS, MIN_DOCS = 20, 3
SHARD_KEYS = 50_000
#: Bound of the broadcast shard, and the fewest documents of a key in it.
HOT_KEYS, HOT_DOCS = 50_000, 64
_SPACE = b" \t\n\x0b\x0c\r"
_SEEDS = 42, 0x9E3779B97F4A7C15
_GAMMA, _LEVELS = 2, 24


def line_hashes(text: str, min_chars: int = MIN_CHARS) -> tuple[int, list[int], list[int], list[int]]:
    """(number of lines, positions of counted lines, first hashes, second hashes)."""
    lines = text.encode("utf-8", "surrogatepass").lower().split(b"\n")
    digest = xxhash.xxh64_intdigest
    where, one, two = [], [], []
    for i, line in enumerate(lines):
        key = line.strip(_SPACE)
        if len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars):
            where.append(i)
            one.append(digest(key, _SEEDS[0]))
            two.append(digest(key, _SEEDS[1]))
    return len(lines), where, one, two


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class PerfectHash:
    """Numbers n distinct 64-bit keys 0 to n-1; a few keys that found no place are numbered last, by a dictionary."""

    sizes: list[int]
    bits: np.ndarray  # packed, all levels in one
    late: dict[tuple[int, int], int]

    @classmethod
    def build(cls, keys: np.ndarray, checks: np.ndarray) -> PerfectHash:
        sizes, levels, left = [], [], np.arange(len(keys))
        for level in range(_LEVELS):
            if len(left) == 0:
                break
            m = (max(64, _GAMMA * len(left)) + 63) // 64 * 64
            place = (_mix(keys[left], level) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(place, minlength=m) == 1
            sizes.append(m)
            levels.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[place]]
        bits = np.concatenate(levels) if levels else np.zeros(0, np.uint8)
        placed = int(np.bitwise_count(bits).sum())
        late = {(int(keys[i]), int(checks[i])): placed + k for k, i in enumerate(left)}
        return cls(sizes, bits, late)

    def opened(self) -> PerfectHash:
        self.flat = np.unpackbits(self.bits, bitorder="little").astype(bool)
        self.rank = np.cumsum(self.flat, dtype=np.int64) - 1
        return self

    def numbers(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The number of each key; -1 if it surely is none of them."""
        found, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, m in enumerate(self.sizes):
            if len(left) == 0:
                break
            place = base + (_mix(keys[left], level) % np.uint64(m)).astype(np.int64)
            hit = self.flat[place]
            found[left[hit]] = self.rank[place[hit]]
            left, base = left[~hit], base + m
        for i in left:
            found[i] = self.late.get((int(keys[i]), int(checks[i])), -1)
        return found


@dataclass
class Shard:
    """A perfect hash with its arrays."""

    index: PerfectHash
    prints: np.ndarray  # of 32 bits, or the whole second hash
    counts: np.ndarray
    last: np.ndarray

    @classmethod
    def build(cls, one: np.ndarray, two: np.ndarray, n: np.ndarray, last: np.ndarray, whole: bool = False) -> Shard:
        """``whole`` keeps all bits of the second hash, so that only a line of the same 64 bits there, and the same place by the first hash, is taken for a key."""
        index = PerfectHash.build(one, two).opened()
        order = index.numbers(one, two)
        prints = two if whole else (two >> np.uint64(32)).astype(np.uint32)
        arrays = [np.zeros(len(one), t) for t in (prints.dtype, np.uint8, np.int64)]
        for array, values in zip(arrays, (prints, np.minimum(n, 255).astype(np.uint8), last)):
            array[order] = values
        return cls(index, *arrays)

    def probe(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(is a key, documents up to 255, largest id) of each probe."""
        if len(self.prints) == 0:
            zero = np.zeros(len(one), np.int64)
            return zero.astype(bool), zero, zero
        at = self.index.numbers(one, two)
        safe = np.maximum(at, 0)
        prints = two if self.prints.dtype == np.uint64 else (two >> np.uint64(32)).astype(np.uint32)
        known = (at >= 0) & (self.prints[safe] == prints)
        return known, np.where(known, self.counts[safe], 0), self.last[safe]

    def packed(self) -> list[bytes]:
        late = [x for (a, b), k in self.index.late.items() for x in (a, b, k)]
        return [
            np.array(self.index.sizes, np.int64).tobytes(), self.index.bits.tobytes(), np.array(late, np.uint64).tobytes(),
            self.prints.tobytes(), self.counts.tobytes(), self.last.tobytes(),
        ]

    @classmethod
    def unpacked(cls, parts: list[bytes]) -> Shard:
        late = np.frombuffer(parts[2], np.uint64).reshape(-1, 3).tolist()
        index = PerfectHash(
            np.frombuffer(parts[0], np.int64).tolist(), np.frombuffer(parts[1], np.uint8), {(a, b): k for a, b, k in late}
        ).opened()
        width = np.uint64 if len(parts[3]) == 8 * len(parts[4]) else np.uint32
        return cls(index, *(np.frombuffer(p, t) for p, t in zip(parts[3:], (width, np.uint8, np.int64))))


_PARTS = ("sizes", "bits", "late", "prints", "counts", "last")


def _unsigned(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


def _build(key: tuple, table: pa.Table) -> pa.Table:
    shard = Shard.build(_unsigned(table["one"]), _unsigned(table["two"]), table["n"].to_numpy(), table["last"].to_numpy())
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64())} | {p: pa.array([x], pa.binary()) for p, x in zip(_PARTS, shard.packed())})


def hash_lines(df: DataFrame, id: str, text: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, row_key, n_lines, places, one, two): one row per row of ``df``; ``row_key`` is a hash of the text."""

    def start():
        def work(texts):
            found = [line_hashes(t or "", min_chars) for t in texts]
            signed = [np.array(x, np.uint64).view(np.int64) for k in (2, 3) for f in found for x in [f[k]]]
            return [f[0] for f in found], [f[1] for f in found], signed[: len(found)], signed[len(found) :]

        return work

    whole = F.coalesce(F.col(text), F.lit(""))
    slim = df.select(F.col(id).alias("id"), F.xxhash64(whole).alias("row_key"), whole.alias("text"))
    return add_columns(slim, ["text"], "n_lines INT, places ARRAY<INT>, one ARRAY<BIGINT>, two ARRAY<BIGINT>", start).drop("text")


def line_counts(hashed: DataFrame) -> DataFrame:
    """(one, two, n, last): documents and largest id of every distinct key."""
    each = hashed.where("id IS NOT NULL").select("id", F.explode(F.arrays_zip("one", "two")).alias("h"))
    return (
        each.select("id", "h.one", "h.two").distinct()
        .groupBy("one", "two").agg(F.count("*").alias("n"), F.max("id").alias("last"))
    )


def surplus_lines(hashed: DataFrame, counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, row_key, place): lines that go."""
    spark = hashed.sparkSession
    n_keys = counts.count()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_keys // SHARD_KEYS))
    often = counts.where(F.col("n") >= HOT_DOCS)
    least = least_of_most(often, "n", HOT_KEYS)
    hot_rows = often.where(F.lit(False) if least is None else F.col("n") >= least).toArrow()
    hot = spark.sparkContext.broadcast(
        Shard.build(
            _unsigned(hot_rows["one"]), _unsigned(hot_rows["two"]), hot_rows["n"].to_numpy(), hot_rows["last"].to_numpy(), whole=True
        ).packed()
    )
    arrays = counts.withColumn("shard", F.pmod("one", F.lit(shards))).groupBy("shard").applyInArrow(
        _build, "shard BIGINT, " + ", ".join(f"{p} BINARY" for p in _PARTS)
    )

    def probe_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hot keys are settled here; what is left goes to its shard, lines known to go anywhere."""
        shard = Shard.unpacked(hot.value)
        for b in batches:
            lists = b.column("places")
            rows = np.repeat(np.arange(b.num_rows), pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            place = lists.flatten().to_numpy()
            one, two = (_unsigned(b.column(c).flatten()) for c in ("one", "two"))
            ids, keys = b.column("id").take(pa.array(rows)), b.column("row_key").to_numpy()[rows]
            known, n, last = shard.probe(one, two)
            own = pa.compute.fill_null(pa.compute.equal(ids, pa.array(last, pa.int64())), False).to_numpy(zero_copy_only=False)
            goes = known & (n >= min(min_docs, 255)) & ~own
            send = goes | ~known
            anywhere = _mix(pa.compute.fill_null(ids, 0).to_numpy().view(np.uint64), 0).view(np.int64)
            to = np.where(goes, anywhere, one.view(np.int64)) % shards
            yield pa.RecordBatch.from_arrays(
                [
                    ids.filter(pa.array(send)), pa.array(keys[send]), pa.array(place[send], pa.int32()),
                    pa.array(one[send].view(np.int64)), pa.array(two[send].view(np.int64)), pa.array(goes[send]), pa.array(to[send]),
                ],
                names=["id", "row_key", "place", "one", "two", "goes", "shard"],
            )

    probes = hashed.select("id", "row_key", "places", "one", "two").mapInArrow(
        probe_hot, "id BIGINT, row_key BIGINT, place INT, one BIGINT, two BIGINT, goes BOOLEAN, shard BIGINT"
    )

    def probe(key: tuple, lines: pa.Table, arrays: pa.Table) -> pa.Table:
        goes = lines["goes"].to_numpy()
        if arrays.num_rows and lines.num_rows:
            shard = Shard.unpacked([arrays[p][0].as_py() for p in _PARTS])
            known, n, last = shard.probe(_unsigned(lines["one"]), _unsigned(lines["two"]))
            own = pa.compute.fill_null(pa.compute.equal(lines["id"], pa.array(last, pa.int64())), False).to_numpy()
            goes = goes | (known & (n >= min(min_docs, 255)) & ~own)
        return lines.select(["id", "row_key", "place"]).filter(pa.array(goes, pa.bool_()))

    return probes.groupBy("shard").cogroup(arrays.groupBy("shard")).applyInArrow(probe, "id BIGINT, row_key BIGINT, place INT")


def dedup_lines(
    df: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """The rows with ``text`` less its surplus lines, and ``n_lines`` (before) and ``n_dropped``.

    A line goes if its key is found in at least ``min_docs`` documents and this is not the one of the largest id.
    ``min_docs`` is at most 255.
    """
    hashed = stage(hash_lines(df, id, text, min_chars), "line-hashes")
    counts = stage(line_counts(hashed), "line-counts")
    gone = surplus_lines(hashed, counts, min_docs).groupBy("id", "row_key").agg(F.collect_list("place").alias("gone"))
    gone = stage(gone.select(F.col("id").alias("gone_id"), "row_key", "gone"), "surplus-lines")
    slim = df.select(nested(df, [text, "n_lines", "n_dropped"]).alias("row"), F.col(id).alias("id"), F.col(text).alias("text"))
    marked = may_hold(slim.withColumn("key", F.xxhash64(F.coalesce("text", F.lit("")))), F.col("key"), gone.select(F.col("row_key").alias("key")))
    found = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("key") == F.col("row_key"))
    joined = marked.where("maybe").join(gone, found, "left").select("row", "text", "gone")
    joined = joined.unionByName(marked.where("NOT maybe").select("row", "text", F.lit(None).cast("array<int>").alias("gone")))

    def start():
        def work(texts, drops):
            kept, before, dropped = [], [], []
            for t, gone in zip(texts, drops):
                lines = (t or "").split("\n")
                before.append(len(lines))
                dropped.append(len(gone or ()))
                if gone:
                    gone = set(gone)
                    t = "\n".join([x for i, x in enumerate(lines) if i not in gone])
                kept.append(t)
            return kept, before, dropped

        return work

    out = add_columns(joined, ["text", "gone"], "text STRING, n_lines BIGINT, n_dropped BIGINT", start)
    others = [F.col("text").alias(text) if c == text else F.col(f"row.`{c}`") for c in without(df, ["n_lines", "n_dropped"])]
    return out.select(*others, "n_lines", "n_dropped")


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines and digest of what is left of every document."""
    kept = dedup_lines(documents(spark, folder).select("doc_id", "text"))
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


#: Letters of A-Z and white space are mapped one by one, as the key's definition says.
_KEY = (
    "translate(regexp_replace(regexp_replace(line, '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+$', ''), "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
OP9_SQL = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
    FROM documents
), keyed AS (SELECT doc_id, place, line, {_KEY} AS key FROM lines),
surplus AS (
    SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE s.last <> k.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.place) FILTER (WHERE s.last IS NULL OR s.last = k.doc_id), '')) AS kept_sha256
FROM keyed k LEFT JOIN surplus s ON k.key = s.key
GROUP BY k.doc_id
"""
