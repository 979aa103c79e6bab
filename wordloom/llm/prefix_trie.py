"""Prefix trie of conversations by van Emde Boas recursion.

A conversation is a sequence of turns. A node is a distinct sequence of first turns and is named by its smallest
member at its depth. The trie of depths lo to lo + 2s is cut at lo + s: the upper trie has the depths below the cut, and a
lower forest hangs at every cut prefix. Names come from the top, all tries of one size in one job:

1. A cut prefix is named by its members' name at lo and a 128-bit digest of the s turns between: the smallest member.
   Digests combine by exclusive or over (place, turn), so turns of one long conversation are digested by many tasks.
2. Upper tries and lower forests, now of half the size, are cut next, side by side. So log2 of the longest conversation rounds name all depths:
   depth d is named when tries are cut at its lowest bit, below the name at d less this bit.
   Prefixes with one member leave the recursion: below them, the conversation is a path with its own name.
3. Totals are grafted from the smallest tries to the largest. Each cut prefix has the total of its lower trie by then, and adds
   it to its ancestors in the upper trie.

Every round is a written table. No task holds a conversation, the members of a prefix, or the children of a node: places
are numbered over range partitions, members are counted by partial aggregation, and the digest of a node's members streams
over sorted pieces of their list.

Defined results: rows with a null ``conv_id`` belong to no conversation; null turns come first; turns of equal number are
ordered by the SHA-256 of length of role, colon, role and text, and repeated rows are turns of their own; null roles and texts are empty;
extra columns are not read; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wordloom.llm.common import WORD
from wordloom.sources import tables
from wordloom.staging import stage

#: A conversation takes its first turns, fewer than MAX_HEAD + 1, from the first one of its family.
FAMILY, MAX_HEAD = 20, 3
#: Ids that are joined to one piece of a list; numbers that one array of a sequence holds.
PIECE_IDS, SPAN = 4_096, 4_096
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def head_size(conv: Column) -> Column:
    """How many turns come from the family's first conversation."""
    return (F.crc32(conv.cast("string").cast("binary")) % (MAX_HEAD + 1)).cast("long")


def numbered_turns(df: DataFrame) -> DataFrame:
    """(conv, place, own, turn_hash, words): the turns of each conversation, numbered from 0; ``own`` is their number."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    slim = df.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")
    )
    order = ["conv", "turn", "digest"]
    cut = slim.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at"),
        F.unhex("digest").alias("turn_hash"), "words",
    )
    cut = stage(cut, "trie-turns")
    # A conversation reaches over as many rows here as it reaches over range partitions.
    runs = cut.groupBy("conv", "part").agg(F.min("at").alias("start"), F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "conv", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("start")).alias("shift"),
        F.sum("n").over(Window.partitionBy("conv")).alias("own"),
    )
    placed = cut.join(stage(runs, "trie-runs"), ["conv", "part"])
    return placed.select("conv", (F.col("at") + F.col("shift")).alias("place"), "own", "turn_hash", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, len) of all rebuilt conversations, and their turns (conv, place, a, b, words, len); a, b are two 64-bit hashes of place and turn."""
    turns = stage(turns, "trie-placed")
    convs = turns.where("place = 0").select("conv", "own")
    convs = convs.withColumns({"first": F.col("conv") - F.col("conv") % FAMILY, "head": head_size(F.col("conv"))})
    firsts = convs.select(F.col("conv").alias("first"), F.col("own").alias("first_own"))
    taken = F.least(F.coalesce("first_own", F.lit(0)), F.col("head"))
    convs = convs.join(firsts, "first", "left").withColumn("taken", taken)
    convs = convs.withColumn("len", F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0)))
    convs = stage(convs.select("conv", "first", "head", "taken", "len"), "trie-conversations")

    rest = turns.where(F.col("place") >= head_size(F.col("conv"))).join(convs.select("conv", "head", "taken", "len"), "conv")
    rest = rest.select("conv", (F.col("place") - F.col("head") + F.col("taken")).alias("place"), "turn_hash", "words", "len")
    heads = turns.where((F.col("place") < MAX_HEAD) & (F.col("conv") % FAMILY == 0)).select(F.col("conv").alias("first"), "place", "turn_hash", "words")
    heads = heads.join(convs.select("conv", "first", "taken", "len"), "first").where("place < taken")
    every = rest.unionByName(heads.select("conv", "place", "turn_hash", "words", "len"))
    a, b = F.xxhash64("place", "turn_hash").alias("a"), F.xxhash64("turn_hash", "place", F.lit(1)).alias("b")
    return convs.select("conv", "len"), stage(every.select("conv", "place", a, b, "words", "len"), "trie-rebuilt")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _bits(longest: int) -> list[int]:
    """Sizes of lower tries, 1, 2, 4 and so on, that depths up to ``longest`` need."""
    return [1 << j for j in range(longest.bit_length())]


def name_prefixes(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with several members, and the root: (depth, name, n), and their members (conv, depth, name)."""
    root = convs.agg(F.min("conv").alias("name"), F.count("*").alias("n"), F.max("len").alias("longest")).first()
    members = [convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(root["name"]).cast("long").alias("name"))]
    head = convs.sparkSession.range(1).select(F.lit(0).cast("long").alias("depth"), F.lit(root["name"]).cast("long").alias("name"), F.lit(root["n"]).cast("long").alias("n"))
    nodes = [head.where(F.col("name").isNotNull())]
    for size in reversed(_bits(root["longest"] or 0)) if root["n"] > 1 else ():
        from_depth = F.col("place") - F.col("place") % size
        between = turns.where((F.col("place").bitwiseAND(F.lit(size)) == 0) & (from_depth + size <= F.col("len")))
        digests = between.groupBy("conv", from_depth.alias("depth")).agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
        above = _union([m.where(F.col("depth") % (2 * size) == 0) for m in members])
        keyed = digests.join(above, ["conv", "depth"]).select("conv", (F.col("depth") + size).alias("depth"), F.col("name").alias("above"), "a", "b")
        keyed = stage(keyed, "trie-cuts")
        names = keyed.groupBy("depth", "above", "a", "b").agg(F.min("conv").alias("name"), F.count("*").alias("n")).where("n > 1")
        names = stage(names, "trie-names")
        nodes.append(names.select("depth", "name", "n"))
        members.append(stage(keyed.join(names, ["depth", "above", "a", "b"]).select("conv", "depth", "name"), "trie-members"))
    return stage(_union(nodes), "trie-nodes"), stage(_union(members), "trie-all-members")


def _span(first: Column, last: Column, name: str, df: DataFrame) -> DataFrame:
    """``df`` with ``name`` from ``first`` to ``last``, a row each; no array has more than SPAN numbers or SPAN-th of them."""
    df = df.withColumns({"_first": first.cast("long"), "_last": last.cast("long")}).where("_first <= _last")
    df = df.withColumn("_from", F.explode(F.expr(f"sequence(_first, _last, {SPAN}L)")))
    return df.withColumn(name, F.explode(F.expr(f"sequence(_from, least(_last, _from + {SPAN - 1}L))"))).drop("_first", "_last", "_from")


def graft_totals(weights: DataFrame, members: DataFrame, longest: int) -> DataFrame:
    """(depth, name, leaves, saved): weights summed over the subtree of each node, its own included."""
    parts = [weights]
    sums = [F.sum(c).alias(c) for c in ("leaves", "saved")]
    for size in _bits(longest):
        # Totals of the lower tries at the cuts of this size are whole: all smaller cuts have been grafted.
        cuts = _union([p.where(F.col("depth") % (2 * size) == size) for p in parts]).groupBy("depth", "name").agg(*sums)
        paths = _span(F.col("depth") - size, F.col("depth") - 1, "to", cuts).select(F.col("name").alias("conv"), F.col("to").alias("depth"), "leaves", "saved")
        parts.append(stage(paths.join(members, ["conv", "depth"]).groupBy("depth", "name").agg(*sums), "trie-grafts"))
    return _union(parts).groupBy("depth", "name").agg(*sums)


def list_digests(ends: DataFrame) -> DataFrame:
    """(depth, name, ends_sha256): SHA-256 of the ascending ids of each node, joined by commas.

    The ids of one node are sorted and joined by as many tasks as they fill; the pieces alone meet in one task, one after the other.
    """
    order = ["depth", "name", "conv"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, out = None, [], []

        def piece() -> None:
            if ids:
                out.append((*key, ids[0], ",".join(map(str, ids))))
                ids.clear()

        def rows() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["depth", "name", "first", "ids"])
            out.clear()
            return batch

        for batch in batches:
            for depth, name, conv in zip(*(batch.column(c).to_pylist() for c in order)):
                if key != (depth, name) or len(ids) == PIECE_IDS:
                    piece()
                    key = depth, name
                ids.append(conv)
            if len(out) > 1_000:
                yield rows()
        piece()
        yield rows()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def rows(found: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], k) for i, k in enumerate(kinds)], names=["depth", "name", "ends_sha256"])

        for batch in batches:
            done = []
            for depth, name, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "name", "ids"))):
                if key == (depth, name):
                    state.update(b"," + ids.encode())
                    continue
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = (depth, name), hashlib.sha256(ids.encode())
            yield rows(done)
        if key:
            yield rows([(*key, state.hexdigest())])

    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "depth BIGINT, name BIGINT, first BIGINT, ids STRING")
    sorted_pieces = pieces.repartition("depth", "name").sortWithinPartitions("depth", "name", "first")
    return sorted_pieces.mapInArrow(digest, "depth BIGINT, name BIGINT, ends_sha256 STRING")


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie of ``convs`` (conv, len) with ``turns`` (conv, place, a, b, words, len)."""
    nodes, members = name_prefixes(convs, turns)
    deepest = members.groupBy("conv").agg(F.max(F.struct("depth", "name")).alias("deepest"))
    paths = convs.join(deepest, "conv").select("conv", "len", F.col("deepest.depth").alias("depth"), F.col("deepest.name").alias("name"))
    paths = stage(paths, "trie-paths")

    last = turns.select(F.col("conv").alias("name"), (F.col("place") + 1).alias("depth"), "words")
    above = members.select(F.col("conv").alias("name"), (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    shared = nodes.join(last, ["depth", "name"], "left").join(above, ["depth", "name"], "left")
    shared = stage(shared.select("depth", "name", "n", "parent", F.coalesce("words", F.lit(0)).alias("words")), "trie-shared")
    inner = shared.where("parent IS NOT NULL").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name")).agg(F.count("*").alias("inner_children"))
    outer = paths.where("len > depth").groupBy("depth", "name").agg(F.count("*").alias("path_children"))
    known = shared.join(inner, ["depth", "name"], "left").join(outer, ["depth", "name"], "left").na.fill(0, ["inner_children", "path_children"])
    known = known.withColumn("n_children", F.col("inner_children") + F.col("path_children"))
    known = stage(known, "trie-children")
    # A path is one leaf and saves nothing.
    leaves = F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("path_children")).alias("leaves")
    weights = known.select("depth", "name", leaves, ((F.col("n") - 1) * F.col("words")).alias("saved"))
    totals = graft_totals(weights, members, known.agg(F.max("depth")).first()[0] or 0)

    digests = list_digests(paths.where("len = depth"))
    inside = known.join(totals, ["depth", "name"]).join(digests, ["depth", "name"], "left").select(
        F.col("name").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
    lone = _span(F.col("depth") + 1, F.col("len"), "at", paths.withColumnRenamed("name", "top"))
    ends = F.col("at") == F.col("len")
    outside = lone.select(
        F.col("conv").alias("conv_id"), F.col("at").alias("depth"),
        F.when(F.col("at") == F.col("depth") + 1, F.col("top")).otherwise(F.col("conv")).alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        F.when(ends, F.lit(0)).otherwise(F.lit(1)).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(ends, F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
    return inside.unionByName(outside)


def prefix_trie(df: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of ``df`` (conv_id, turn, role, text), one row per node."""
    convs, turns = rebuilt(numbered_turns(df))
    return trie(convs, turns)


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return prefix_trie(tables.table(spark, folder, "conversations"))


#: CRC-32 bit by bit; DuckDB has no function for it.
_CRC_BIT = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
OP12_SQL = f"""
WITH RECURSIVE ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
crc AS (
    SELECT c AS conv, c::VARCHAR AS s, 1 AS place, 0 AS bit, xor(4294967295::BIGINT, ascii((c::VARCHAR)[1:1])::BIGINT) AS c FROM ids
    UNION ALL
    SELECT conv, s, CASE WHEN bit = 7 THEN place + 1 ELSE place END, (bit + 1) % 8,
           CASE WHEN bit = 7 AND place < length(s) THEN xor({_CRC_BIT}, ascii(s[place + 1:place + 1])::BIGINT) ELSE {_CRC_BIT} END
    FROM crc WHERE place <= length(s)
), heads AS (SELECT conv, xor(c, 4294967295::BIGINT) % 4 AS h FROM crc WHERE place > length(s)),
turns AS (
    SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS place
    FROM conversations WHERE conv_id IS NOT NULL
), mixed AS (
    SELECT h.conv, 0 AS side, t.place, t.role, t.text FROM heads h JOIN turns t ON t.conv = h.conv - h.conv % 20 AND t.place < h.h
    UNION ALL
    SELECT h.conv, 1, t.place, t.role, t.text FROM heads h JOIN turns t ON t.conv = h.conv AND t.place >= h.h
), numbered AS (
    SELECT conv, row_number() OVER (PARTITION BY conv ORDER BY side, place) AS depth, role, text,
           sha256(length(role)::VARCHAR || ':' || role || text) AS digest
    FROM mixed
), prefixed AS (
    SELECT conv, depth, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
           sha256(string_agg(digest, '') OVER (PARTITION BY conv ORDER BY depth)) AS prefix FROM numbered
    UNION ALL
    SELECT conv, 0, 0, '' FROM heads
), lens AS (SELECT conv, max(depth) AS len FROM prefixed GROUP BY conv),
named AS (
    SELECT p.conv, p.depth, p.prefix, p.words, min(p.conv) OVER (PARTITION BY p.depth, p.prefix) AS node, l.len FROM prefixed p JOIN lens l ON p.conv = l.conv
), nodes AS (
    SELECT node, depth, count(*) AS n_convs, any_value(words) AS words, max(len) > depth AS inner_node,
           sha256(coalesce(string_agg(conv::VARCHAR, ',' ORDER BY conv) FILTER (WHERE len = depth), '')) AS ends_sha256
    FROM named GROUP BY node, depth
), parents AS (SELECT n.node, n.depth, a.node AS parent FROM nodes n LEFT JOIN named a ON a.conv = n.node AND a.depth = n.depth - 1),
children AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY ALL),
subtree AS (
    SELECT a.node, a.depth, count(*) FILTER (WHERE NOT n.inner_node) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
    FROM nodes n JOIN named a ON a.conv = n.node AND a.depth <= n.depth GROUP BY a.node, a.depth
)
SELECT n.node AS conv_id, n.depth::BIGINT AS depth, p.parent AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN parents p ON n.node = p.node AND n.depth = p.depth
LEFT JOIN children c ON n.node = c.node AND n.depth = c.depth JOIN subtree s ON n.node = s.node AND n.depth = s.depth
"""
