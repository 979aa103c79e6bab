"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are computed row by row. Distinct fingerprints, each with its smallest
document, are the keys of a binary trie. The self-join walks pairs of trie nodes
together from the root: a pair of nodes stands for all pairs of keys below
them, its differing bits so far are known, and it is dropped as soon as they
exceed the budget. All pairs of one depth are advanced at once with numpy.

To spread the walk, the 64 bits are cut into budget + 1 blocks. Keys within the budget agree on one
whole block at least, so for every block the trie is built with that block's
bits first, and node pairs must agree on them; subtrees under different block
values are then independent and are dealt to tasks by (block, value). A key
travels budget + 1 times, 9 bytes each. Pairs found in a task are merged by label at
once, and only (key, smallest connected key) leaves it, so a cluster of copies
never becomes all its pairs. Exact copies share one key from the start.

Defined results: a null text is the empty text; texts without a word have
fingerprint 0, linked like any other; texts with fewer words than a shingle are
one shingle; repeated rows belong to one component; null ids are never a
component's id unless it has no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom.llm.common import add_columns, documents, fold_text, may_hold, nested, words_of
from wordloom.llm.components import components
from wordloom.staging import stage

SHINGLE, BUDGET, SEED = 3, 3, 42
#: Most node pairs held at once; more are walked in parts.
FRONTIER = 2_000_000
#: Keys that a task of the walk holds on average.
TASK_KEYS = 1_000_000


def fingerprint(words: list[str], shingle: int = SHINGLE) -> int:
    """Bit k is set if it is set in over half of the shingles' hashes; repeats count."""
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return digest(" ".join(words), SEED)
    grams = zip(*[words[i:] for i in range(shingle)])
    hashes = np.array([digest(" ".join(g), SEED) for g in grams], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Add ``fp``: the fingerprint's 64 bits as a BIGINT."""

    def start():
        def work(texts):
            values = [fingerprint(words_of(fold_text(t or "")), shingle) for t in texts]
            return [np.array(values, dtype=np.uint64).view(np.int64).tolist()]

        return work

    return add_columns(df, [text], "fp BIGINT", start)


def _joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking a[i] with b[i]: the smallest index of each group."""
    while True:
        x, y = labels[a], labels[b]
        if np.array_equal(x, y):
            return labels
        low = np.minimum(x, y)
        np.minimum.at(labels, x, low)
        np.minimum.at(labels, y, low)
        while not np.array_equal(jumped := labels[labels], labels):
            labels = jumped


def trie_links(keys: np.ndarray, prefix_bits: int, budget: int) -> np.ndarray:
    """Smallest index linked with each of the sorted distinct 64-bit ``keys``.

    Linked: equal in the first ``prefix_bits`` bits and at most ``budget`` different bits, directly or through others.
    """
    n = len(keys)
    labels = np.arange(n)
    if n < 2:
        return labels
    heads = keys >> np.uint64(64 - prefix_bits)
    starts = np.flatnonzero(np.r_[True, heads[1:] != heads[:-1]])
    ends = np.r_[starts[1:], n]
    many = ends - starts > 1
    starts, ends = starts[many], ends[many]
    # A stack of (depth, nodes a, nodes b, differing bits); a node is a range of the sorted keys.
    stack = [(prefix_bits, starts, ends, starts, ends, np.zeros(len(starts), np.int8))]
    while stack:
        depth, a0, a1, b0, b1, diff = stack.pop()
        if len(a0) == 0:
            continue
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            stack.append((depth, a0[half:], a1[half:], b0[half:], b1[half:], diff[half:]))
            stack.append((depth, a0[:half], a1[:half], b0[:half], b1[:half], diff[:half]))
            continue
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():  # two leaves: what is left of both paths differs in these bits
            i, j = a0[single], b0[single]
            near = np.bitwise_count(keys[i] ^ keys[j]) <= budget
            labels = _joined(labels, i[near], j[near])
            rest = ~single
            a0, a1, b0, b1, diff = a0[rest], a1[rest], b0[rest], b1[rest], diff[rest]
        if depth == 64 or len(a0) == 0:
            continue
        one = (keys >> np.uint64(63 - depth)) & np.uint64(1)
        zeros = np.r_[0, np.cumsum(one == 0)]
        am, bm = a0 + (zeros[a1] - zeros[a0]), b0 + (zeros[b1] - zeros[b0])
        same = a0 == b0
        parts = [
            (a0, am, b0, bm, diff, None),  # both zero
            (am, a1, bm, b1, diff, None),  # both one
            (a0, am, bm, b1, diff + 1, None),
            (am, a1, b0, bm, diff + 1, ~same),  # for a node with itself the same as the line above
        ]
        kept = []
        for p0, p1, q0, q1, d, also in parts:
            keep = (p1 > p0) & (q1 > q0) & (d <= budget) & ~((p0 == q0) & (p1 - p0 == 1))
            kept.append([x[keep if also is None else keep & also] for x in (p0, p1, q0, q1, d)])
        stack.append((depth + 1, *[np.concatenate(x) for x in zip(*kept)]))
    return labels


def links(fingerprints: DataFrame, budget: int = BUDGET, column: str = "fp") -> DataFrame:
    """(a, b): edges that connect all distinct fingerprints within ``budget`` bits, directly or through others."""
    spark = fingerprints.sparkSession
    blocks = budget + 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    fp = F.col(column)
    turned = [
        F.struct(
            F.lit(i).cast("tinyint").alias("block"),
            (F.shiftleft(fp, edges[i]).bitwiseOR(F.shiftrightunsigned(fp, 64 - edges[i])) if edges[i] else fp).alias("bits"),
            F.shiftrightunsigned(fp, 64 - edges[i + 1]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1)).alias("value"),
        )
        for i in range(blocks)
    ]
    dealt = fingerprints.select(F.explode(F.array(*turned)).alias("t")).select("t.*")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), blocks * fingerprints.count() // TASK_KEYS)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, bits = [], []
        for b in batches:
            block.append(b.column(0).to_numpy())
            bits.append(b.column(1).to_numpy().view(np.uint64))
        if not block:
            return
        block, bits = np.concatenate(block), np.concatenate(bits)
        for i in range(blocks):
            keys = np.unique(bits[block == i])
            labels = trie_links(keys, edges[i + 1] - edges[i], budget)
            linked = np.flatnonzero(labels != np.arange(len(keys)))
            back = [
                (k << np.uint64(64 - edges[i])) | (k >> np.uint64(edges[i])) if edges[i] else k
                for k in (keys[linked], keys[labels[linked]])
            ]
            for at in range(0, len(linked), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k[at : at + 100_000].view(np.int64)) for k in back], names=["a", "b"]
                )

    return dealt.repartition(parts, "block", "value").select("block", "bits").mapInArrow(walk, "a BIGINT, b BIGINT")


def _components(marked: DataFrame, budget: int) -> DataFrame:
    """(fp, component_id) of the fingerprints in ``marked`` (_id, fp); component_id is the smallest id connected."""
    keys = stage(marked.groupBy("fp").agg(F.min("_id").alias("first")), "fingerprint-keys")
    labels = components(links(keys, budget)).withColumnRenamed("node", "fp")
    grouped = keys.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    smallest = grouped.groupBy("label").agg(F.min("first").alias("component_id"))
    return stage(grouped.join(smallest, "label").select("fp", "label", "component_id"), "fingerprint-components")


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """(``id``, fp, component_id): one row per row of ``df``; component_id is the smallest id of the connected texts."""
    marked = stage(fingerprints(df.select(id, text), text, shingle).select(F.col(id).alias("_id"), "fp"), "fingerprints")
    of_key = _components(marked, budget).select("fp", "component_id")
    return marked.join(of_key, "fp").select(F.col("_id").alias(id), "fp", "component_id")


def keep_one(df: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """The rows of ``df`` less near-duplicates: of each component one row of the smallest id stays.

    Only texts that may have a duplicate are shuffled; all others pass through the scan.
    """
    packed = packed_rows(df, id, text)
    slim = stage(fingerprints(packed.select("id", "text", "key"), "text", shingle).select(F.col("id").alias("_id"), "key", "fp"), "fingerprints")
    return one_of_each(packed, slim, _components(slim, budget).select("fp", "label"))


def packed_rows(df: DataFrame, id: str, text: str) -> DataFrame:
    """(row, id, text, key): whole rows, nulls as empty texts, and the hash of the text."""
    return df.select(
        nested(df).alias("row"), F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("key", F.xxhash64("text"))


def one_of_each(packed: DataFrame, slim: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``packed`` less all but one of each label; ``slim`` has (_id, key, fp) of every row, ``labels`` (fp, label)."""
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("key"))).alias("first")
    # Exact copies meet their label as one row, so that no label gathers them.
    of_print = stage(slim.groupBy("fp").agg(first, F.count("*").alias("n")).join(labels, "fp"), "fingerprint-firsts")
    of_label = of_print.groupBy("label").agg(F.min("first").alias("first"), F.sum("n").alias("n")).where("n > 1")
    groups = stage(of_label.select("label", F.col("first.id").alias("id"), F.col("first.key").alias("key")), "duplicate-groups")
    in_groups = of_print.select("fp", "label").join(groups.select("label"), "label", "left_semi").select("fp")
    members = slim.join(in_groups, "fp", "left_semi").groupBy("_id", "key").agg(F.count("*").alias("copies"))
    firsts = groups.select(F.col("id").alias("first_id"), F.col("key").alias("first_key"))
    is_first = F.col("_id").eqNullSafe(F.col("first_id")) & (F.col("key") == F.col("first_key"))
    several = members.join(firsts, is_first, "left").select(
        F.col("_id").alias("member_id"), F.col("key").alias("member_key"), F.col("first_key").isNotNull().alias("stays"), "copies"
    )
    several = stage(several, "duplicate-keys")
    marked = may_hold(packed.drop("text"), F.col("key"), several.select(F.col("member_key").alias("key")))
    member = F.col("id").eqNullSafe(F.col("member_id")) & (F.col("key") == F.col("member_key"))
    rest = marked.where("maybe").join(several, member, "left").where("member_key IS NULL OR stays")
    once = rest.where("member_key IS NULL OR copies = 1").select("row")
    # Rows that repeat an id and a text are one after partial aggregation.
    again = rest.where("copies > 1").groupBy("id", "key").agg(F.first("row").alias("row")).select("row")
    return marked.where("NOT maybe").select("row").unionByName(once).unionByName(again).select("row.*")


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(documents(spark, folder))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
