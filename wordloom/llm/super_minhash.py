"""Near-duplicates by SuperMinHash signatures, banding, verification and union-find.

A document's set holds the 64-bit hashes of its distinct ``SHINGLE``-word shingles. Every element draws a
random permutation of the ``REGISTERS`` registers, step by step (Fisher-Yates): at step j it offers the value
j + r, with r uniform in [0, 1), to the register that its permutation has at place j. A register keeps the least
value. So one element reaches every register, at ranks that differ, which lowers the variance of the estimate below
that of independent minima. Steps beyond the largest rank in any register change nothing, so they are not made: a
set of n elements costs about max(n, REGISTERS * ln REGISTERS) draws. All elements of a set take a step together.

Sets that are equal are one node. ``BANDS`` keys of ``ROWS`` registers propose nodes; a pair of similarity 0.8 shares
no key with probability (1 - 0.8^ROWS)^BANDS = 1.3e-7. The nodes of a key are resolved exactly, without all their pairs:

1. Each is compared with the key's center, its node that shares keys with most nodes. Linked ones are grouped by union-find.
2. What is left are pairs of different groups around one center, one of which is not linked to it. A node is then described by
   its differences: the shingles that it lacks of the center's, and those that it has besides. Two nodes that are linked share more
   differences than the second node's own cost, (100 lacking + percent * besides) / (100 + percent), which is about half of its
   differences, and at least as many as the first node's cost exceeds what a link to the center allows. So they share one of the
   second node's rarest differences and one of the first's (prefix filter), and are joined by those: edits that two copies have made
   alike. Copies edited apart never meet, however many there are.

Every comparison uses both whole sets. Tasks merge their links by union-find, so that at most one link per node leaves
a task; the forests are then merged over all tasks by ``components``.

Defined results: a null text is the empty text; a text without words has an empty set and is linked with nothing; with fewer
words than a shingle the whole sequence is the one shingle; rows that repeat a text are one group, also if they repeat an
id; a null id is a component's id only if it has no other; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wordloom.llm.common import LOWER, SLICE_ROWS, UPPER, documents, may_hold, pieces
from wordloom.llm.components import components
from wordloom.staging import stage

SHINGLE, PERCENT = 2, 80
BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
#: Elements that take a step together.
BLOCK = 4_096
#: Nodes that a task's union-find holds before it passes its forest on.
FOREST = 500_000
#: A-Z to lower case, white space to blanks.
_PLAIN = bytes.maketrans(UPPER.encode() + b"\t\n\x0b\x0c\r", LOWER.encode() + b"     ")
_STEP, _ONE, _TWO = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOW = np.uint64(0xFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ONE
    x = (x ^ (x >> np.uint64(27))) * _TWO
    return x ^ (x >> np.uint64(31))


def shingle_set(raw: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text in UTF-8."""
    digest = xxhash.xxh64_intdigest
    parts = [np.fromiter(map(digest, p.split()), np.uint64) for p in pieces(raw.translate(_PLAIN))]
    words = parts[0] if len(parts) == 1 else np.concatenate(parts)
    if len(words) == 0:
        return words
    width = min(shingle, len(words))
    # Sequences of different length start differently.
    hashes = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        hashes = _mix(hashes * _TWO + words[i : len(words) - width + 1 + i] + np.uint64(_STEP))
    return np.unique(hashes)


def signature(elements: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """Registers of a set of distinct 64-bit hashes: rank in the upper 32 bits, draw in the lower."""
    least = np.full(registers, 2**64 - 1, np.uint64)
    for at in range(0, len(elements), BLOCK):
        block = elements[at : at + BLOCK]
        rows, places, first = np.arange(len(block)), None, None
        for j in range(registers):
            if int(least.max()) >> 32 < j:
                break  # early stopping: no register can fall any more
            draw = _mix(block + np.uint64(_STEP * (j + 1) & 0xFFFFFFFFFFFFFFFF))
            k = (np.uint64(j) + ((draw >> np.uint64(32)) * np.uint64(registers - j) >> np.uint64(32))).astype(np.int64)
            if j == 0:
                register = first = k
            else:
                if places is None:
                    places = np.tile(np.arange(registers, dtype=np.int32), (len(block), 1))
                    places[rows, first] = 0
                register = places[rows, k]
                places[rows, k] = places[:, j]
            np.minimum.at(least, register, np.uint64(j << 32) | (draw & _LOW))
    return least


def band_keys(registers: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key for each band of registers."""
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for column in registers.reshape(bands, -1).T:
        keys = _mix(keys * _TWO + column + np.uint64(_STEP))
    return keys


def _signed(arrays: list[np.ndarray]) -> pa.Array:
    """Lists of 64-bit values."""
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _rows(df: DataFrame, id: str, text: str) -> DataFrame:
    """(id, row_key, raw): ids, hashes of id and text, texts in UTF-8."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.select(F.col(f"`{id}`").alias("id"), F.xxhash64(F.col(f"`{id}`"), whole).alias("row_key"), whole.cast("binary").alias("raw"))


def signed_rows(df: DataFrame, id: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """(id, row_key, n, fp, bands): size, 128-bit hash and band keys of every row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                sizes, prints, keys = [], [], []
                for raw in batch.column("raw"):
                    found = shingle_set(raw.as_py(), shingle)
                    sizes.append(len(found))
                    prints.append(xxhash.xxh3_128_digest(found.tobytes()))
                    keys.append(band_keys(signature(found)) if len(found) else found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("row_key"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), _signed(keys)],
                    names=["id", "row_key", "n", "fp", "bands"],
                )

    given = _rows(df, id, text)
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(run, f"id {kind}, row_key BIGINT, n BIGINT, fp BINARY, bands ARRAY<BIGINT>")


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(fp, grams) of the rows (fp, raw)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                found = [(fp, shingle_set(raw.as_py(), shingle)) for fp, raw in zip(batch.column("fp").to_pylist(), batch.column("raw"))]
                # Rows are found by a hash; one that is not the node's is left out.
                found = [(fp, grams) for fp, grams in found if xxhash.xxh3_128_digest(grams.tobytes()) == fp]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.binary()), _signed([x[1] for x in found])], names=["fp", "grams"])

    return texts.select("fp", "raw").mapInArrow(run, "fp BINARY, grams ARRAY<BIGINT>")


def forest(edges: Iterator[tuple[bytes, bytes]]) -> dict[bytes, bytes]:
    """Union-find over edges: every node with the smallest node of its tree."""
    parent: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in edges:
        a, b = root(a), root(b)
        if a < b:
            parent[b] = a
        elif b < a:
            parent[a] = b
    return {x: root(x) for x in list(parent)}


def grouped(links: DataFrame) -> DataFrame:
    """(node, label) of the links (a, b): union-find within tasks, then over all tasks."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, bytes] = {}

        def rows() -> pa.RecordBatch:
            linked = [(x, top) for x, top in held.items() if x != top]
            arrays = [pa.array([pair[i] for pair in linked], pa.binary()) for i in (0, 1)]
            return pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

        for batch in batches:
            fresh = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())
            held = forest([*held.items(), *fresh])
            if len(held) > FOREST:
                yield rows()
                held = {}
        yield rows()

    return components(stage(links.select("a", "b").mapInArrow(merge, "a BINARY, b BINARY"), "minhash-forests"))


def _linked(percent: int) -> Column:
    return 100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common"))


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with n_a, n_b and the size ``common`` of the intersection of both whole sets.

    The set of ``b`` travels with each pair, that of ``a`` once, so ``a`` should be the node in many pairs.
    """
    left, right = (sets.select(F.col("fp").alias(x), F.col("grams").alias(f"grams_{x}")) for x in ("a", "b"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")
    return both.select("a", "b", *[F.size(f"grams_{x}").cast("long").alias(f"n_{x}") for x in ("a", "b")],
                       F.size(F.array_intersect("grams_a", "grams_b")).cast("long").alias("common"))


def _compared(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Comparisons of centers (a) with the other members (b) of their keys (band, fp, nodes of the key).

    The center of a key is the node that shares keys with most nodes: the one closest to what a group of copies has in common.
    """
    degree = stage(members.groupBy("fp").agg(F.sum("nodes").alias("degree")), "minhash-degrees")
    known = members.select("band", "fp").join(degree, "fp")
    center = F.max(F.struct("degree", "fp"))["fp"].alias("center")
    centers = stage(known.groupBy("band").agg(center), "minhash-centers")
    centered = members.select("band", "fp").join(centers, "band").where("fp <> center")
    pairs = stage(centered.select(F.col("center").alias("a"), F.col("fp").alias("b")).distinct(), "minhash-pairs")
    return stage(compare(pairs, sets), "minhash-compared")


def _open_pairs(seen: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs with a common center, of different groups so far, that share enough rare differences to it to be linked."""
    label = labels.select(F.col("node").alias("fp"), "label")
    near = seen.select(F.col("a").alias("center"), F.col("b").alias("fp"), (F.col("n_a") - F.col("common")).alias("lacking"),
                       (F.col("n_b") - F.col("common")).alias("besides"), F.col("n_a").alias("size"))
    near = near.join(label, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    center_label = label.select(F.col("fp").alias("center"), F.col("label").alias("center_label"))
    near = near.join(center_label, "center", "left").withColumn("inner", F.col("label") == F.coalesce("center_label", "center"))
    near = stage(near.drop("center_label"), "minhash-near")
    # Settled centers have one group around them, or one node.
    open_centers = near.groupBy("center").agg(F.count("*").alias("nodes"), F.count_if(~F.col("inner")).alias("outside"))
    rest = near.join(open_centers.where("nodes > 1 AND outside > 0").select("center"), "center", "left_semi")

    cost = (100 * F.col("lacking") + percent * F.col("besides")) / (100 + percent)
    allowed = F.col("size") * (100 - percent) / (100 + percent)
    rest = rest.select("center", "fp", "label", "inner", (F.col("lacking") + F.col("besides")).alias("all"), cost.alias("cost"), allowed.alias("allowed"))
    left, right = (sets.select(F.col("fp").alias(x), F.col("grams").alias(f"grams_{x}")) for x in ("center", "fp"))
    both = rest.join(right, "fp").join(left, "center")
    apart = F.concat(F.array_except("grams_center", "grams_fp"), F.array_except("grams_fp", "grams_center"))
    each = stage(both.select(*rest.columns, F.explode(apart).alias("difference")), "minhash-differences")

    nodes = each.groupBy("center", "difference").agg(F.count("*").alias("nodes"))
    rare = Window.partitionBy("center", "fp").orderBy("nodes", "difference")
    ranked = each.join(stage(nodes, "minhash-rarity"), ["center", "difference"]).withColumn("left", F.col("all") - F.row_number().over(rare) + 1)
    # ``left`` is the number of differences from this one on. Rounding errors may only keep more of them.
    first = ~F.col("inner") & (F.col("left") >= F.col("cost") - F.col("allowed") - 1e-6)
    second = F.col("left") > F.col("cost") - 1e-6
    shared = stage(ranked.where((F.col("nodes") > 1) & (first | second)), "minhash-prefixes")
    x, y = shared.where(first).alias("x"), shared.where(second).alias("y")
    # The first difference that two nodes share is followed by all others that they share.
    may = (
        (F.col("x.center") == F.col("y.center")) & (F.col("x.difference") == F.col("y.difference")) & (F.col("x.label") != F.col("y.label"))
        & (F.col("y.inner") | (F.col("x.fp") < F.col("y.fp")))
        & (F.least("x.left", "y.left") >= F.col("x.cost") + F.col("y.cost") - F.col("x.allowed") - 1e-6)
    )
    return x.join(y, may).select(F.least("x.fp", "y.fp").alias("a"), F.greatest("x.fp", "y.fp").alias("b")).distinct()


def _asked_sets(df: DataFrame, id: str, text: str, nodes: DataFrame, asked: DataFrame, shingle: int) -> DataFrame:
    """(fp, grams) of the nodes in ``asked`` (fp), made again from one text of each."""
    wanted = stage(nodes.join(asked, "fp", "left_semi").select("fp", "first.row_key"), "minhash-asked")
    rows = may_hold(_rows(df, id, text), F.col("row_key"), wanted.select(F.col("row_key").alias("key"))).where("maybe")
    found = rows.select("row_key", "raw").join(wanted, "row_key").dropDuplicates(["row_key", "fp"])
    return stage(_sets(found, shingle), "minhash-sets")


def near_duplicates(
    df: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """(``id``, n_shingles, component_id): one row per row of ``df``; component_id is the smallest id of the linked rows."""
    known = stage(signed_rows(df, id, text, shingle), "minhash-rows")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row_key"))).alias("first")
    some = known.where("n > 0")
    nodes = stage(some.groupBy("fp").agg(first, F.first("bands").alias("bands")), "minhash-nodes")

    keyed = nodes.select(F.explode("bands").alias("band"), "fp")
    shared = stage(keyed.groupBy("band").agg(F.count("*").alias("nodes")).where("nodes > 1"), "minhash-shared")
    maybe = may_hold(keyed, F.col("band"), shared.select(F.col("band").alias("key"))).where("maybe").drop("maybe")
    members = stage(maybe.join(shared, "band"), "minhash-members")
    sets = _asked_sets(df, id, text, nodes, members.select("fp").distinct(), shingle)

    seen = _compared(members, sets)
    links = seen.where(_linked(percent)).select("a", "b")
    labels = grouped(links)
    pairs = stage(_open_pairs(seen, labels, sets, percent), "minhash-open-pairs")
    late = stage(compare(pairs, sets).where(_linked(percent)).select("a", "b"), "minhash-late")
    if not late.isEmpty():
        labels = grouped(links.union(late))

    labelled = nodes.select("fp", "first.id").join(labels.select(F.col("node").alias("fp"), "label"), "fp", "left")
    labelled = stage(labelled.withColumn("label", F.coalesce("label", "fp")), "minhash-labels")
    smallest = labelled.groupBy("label").agg(F.min("id").alias("component_id"))
    of_node = stage(labelled.join(smallest, "label").select(F.col("fp").alias("node"), "component_id"), "minhash-components")
    out = known.select("id", "n", "fp").join(of_node, F.col("fp") == F.col("node"), "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), component.alias("component_id"))


def op13_super_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Size of the set and component of every document."""
    found = near_duplicates(documents(spark, folder).select("doc_id", "text"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


OP13_SQL = """
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), shingled AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
    FROM worded
), sized AS (SELECT doc_id, len(s)::BIGINT AS n_shingles, s FROM shingled),
each AS (SELECT doc_id, n_shingles AS n, unnest(s) AS shingle FROM sized),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM each a JOIN each b ON a.shingle = b.shingle AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), grouped AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT s.doc_id, s.n_shingles, g.component_id, s.doc_id = g.component_id AS kept
FROM sized s JOIN grouped g ON s.doc_id = g.doc_id
"""
