"""Nearest neighbours by largest inner product: a block matrix join of int8 tiles.

Queries and candidates are dealt to tiles by hash; a task gets one tile of each.
Vectors are rounded to int8 with one scale each, and a tile's products are one matrix
multiplication of whole numbers, exact in float32. With x = x^ + r the true product differs from
the rounded one by at most |x^||s| + |r|(|y^| + |s|). A pair survives if its upper
bound reaches the k-th largest lower bound of its query; survivors are computed
again in double precision from the original vectors, so no neighbour is lost.
Each tile returns k pairs per query; heaps of k merge the tiles.

A candidate travels once per query tile and a query once per candidate tile.
Memory of a task: two tiles and a strip of products.

Defined results: rows with a null id, and vectors that are null, empty, zero, or hold a null or a value that is not
finite take no part; of rows that repeat an id the smallest vector counts; vectors are
compared with those of the same length only; ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wordloom.staging import stage

K, QUERY_EVERY = 20, 20
#: Most vectors, on average, of a tile.
QUERY_TILE, CANDIDATE_TILE = 4_096, 8_192
_STRIP = 128


def _rounded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 values as floats, scale, length of the rounded vector, length of what rounding took)."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None])
    back = q * scale[:, None]
    kind = np.float32 if x.shape[1] * 127 * 127 < 2**24 else np.float64
    up = 1 + 1e-9  # covers the rounding of the bounds themselves
    return q.astype(kind), scale, np.linalg.norm(back, axis=1) * up, np.linalg.norm(x - back, axis=1) * up + 1e-300


def tile_neighbours(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, candidate id, product) of the k best candidates of each query in this tile, best first."""
    qi, qs, qn, qr = _rounded(q)
    ci, cs, cn, cr = _rounded(c)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(q), _STRIP):
        part = slice(at, at + _STRIP)
        near = (qi[part] @ ci.T).astype(np.float64) * qs[part, None] * cs[None, :]
        slack = qn[part, None] * cr[None, :] + qr[part, None] * (cn + cr)[None, :]
        other = qid[part, None] != cid[None, :]
        low = np.where(other, near - slack, -np.inf)
        if low.shape[1] > k:
            least = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
        else:
            least = np.full(len(low), -np.inf)
        row, col = np.nonzero(other & (near + slack >= least[:, None]))
        score = np.empty(len(row))
        for s in range(0, len(row), 65_536):
            e = s + 65_536
            score[s:e] = (q[part][row[s:e]] * c[col[s:e]]).sum(axis=1)
        order = np.lexsort((cid[col], -score, row))
        row, col, score = row[order], col[order], score[order]
        first = np.searchsorted(row, row)
        best = np.arange(len(row)) - first < k
        out.append((qid[part][row[best]], cid[col[best]], score[best]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def nearest(df: DataFrame, is_query: Column, k: int = K, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows of every row that ``is_query`` chooses."""
    spark = df.sparkSession
    slim = df.where(F.col(id).isNotNull()).select(
        F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("asks")
    )
    once = slim.where(_usable(F.col("v"))).groupBy("id").agg(F.min("v").alias("v"), F.max("asks").alias("asks"))
    vectors = stage(once.withColumn("dim", F.size("v")), "vectors")
    sizes = vectors.agg(F.count("*").alias("n"), F.count_if("asks").alias("m")).first()
    q_tiles, c_tiles = max(1, -(-sizes.m // QUERY_TILE)), max(1, -(-sizes.n // CANDIDATE_TILE))
    here = F.xxhash64("id", F.lit("tile"))
    queries = vectors.where("asks").select(
        "id", "v", "dim", F.pmod(here, F.lit(q_tiles)).alias("q"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(c_tiles - 1).cast("long"))).alias("c")
    )
    candidates = vectors.select(
        "id", "v", "dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_tiles - 1).cast("long"))).alias("q"), F.pmod(here, F.lit(c_tiles)).alias("c")
    )

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        values = table["v"].combine_chunks()
        flat = (values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values).flatten()
        return table["id"].to_numpy(), flat.to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)

    def tile(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        else:
            found = tile_neighbours(*matrix(left), *matrix(right), k)
        return pa.table({"query_id": found[0], "vec_id": found[1], "score": found[2]})

    pairs = (
        queries.groupBy("dim", "q", "c").cogroup(candidates.groupBy("dim", "q", "c"))
        .applyInArrow(tile, "query_id BIGINT, vec_id BIGINT, score DOUBLE")
    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list[tuple[float, int]]] = {}
        for b in batches:
            for query, vec, score in zip(*(b.column(i).to_pylist() for i in range(3))):
                heap = heaps.setdefault(query, [])
                if len(heap) < k:
                    heapq.heappush(heap, (score, -vec))
                else:
                    heapq.heappushpop(heap, (score, -vec))
        rows = [(query, i + 1, -v, s) for query, heap in heaps.items() for i, (s, v) in enumerate(sorted(heap, reverse=True))]
        for at in range(0, len(rows), 20_000):
            columns = zip(*rows[at : at + 20_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.float64()))],
                names=["query_id", "rank", "vec_id", "score"],
            )

    return pairs.repartition("query_id").mapInArrow(merge, "query_id BIGINT, rank INT, vec_id BIGINT, score DOUBLE")


def op8_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one."""
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % QUERY_EVERY == 0)


OP8_SQL = """
WITH usable AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in embedding if x <> 0]) > 0
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v) AS score
    FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
