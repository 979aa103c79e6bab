"""Helpers that several operators of the subpackage share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from wordloom.sources import tables

#: Rows that a worker turns into Python objects at a time.
SLICE_ROWS = 500
#: A word: a longest run of characters other than the six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: White space to ``str.split`` but not to ``WORD``.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return tables.table(spark, folder, "documents")


def fold(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def fold_text(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def words_of(text: str) -> list[str]:
    """The words of a text, as ``WORD`` finds them."""
    return re.findall(WORD, text) if _OTHER_SPACE.search(text) else text.split()


#: Longest part of a text whose words are held as objects at once.
PIECE = 1 << 20


def pieces(data: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``data`` cut at blanks into parts of about ``size`` bytes, so that no word is cut."""
    at = 0
    while len(data) - at > size and (end := data.find(b" ", at + size)) >= 0:
        yield data[at:end]
        at = end
    yield data[at:]


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns of ``df`` apart from ``names``; names are compared as Spark does, without case."""
    gone = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in gone]


def nested(df: DataFrame, gone: Iterable[str] = ()) -> Column:
    """The columns of ``df``, less ``gone``, as one struct, so that no working column clashes with them."""
    return F.struct(*([F.col(f"`{c}`") for c in without(df, gone)] or [F.lit(0).alias("none")]))


def least_of_most(df: DataFrame, value: str, most: int) -> int | None:
    """The smallest ``value`` (whole numbers) that at most ``most`` rows reach; null if there is none.

    Rows are counted by value first, so one task orders the distinct values only. Counts of things that
    total N have at most sqrt(2 N) distinct values. Rows equal to the first value beyond are left out together.
    """
    counts = df.groupBy(value).agg(F.count("*").alias("rows"))
    reached = counts.select(value, F.sum("rows").over(Window.orderBy(F.desc(value))).alias("reached"))
    return reached.where(F.col("reached") <= most).agg(F.min(value)).first()[0]


#: Buckets of a broadcast key filter; its size does not grow with the data.
FILTER_BUCKETS = 1 << 20


def may_hold(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """Add ``maybe``: false for rows whose ``key`` (BIGINT) is surely not in ``keys`` (key).

    Keys are hashed to a fixed number of buckets and the buckets are broadcast, at most ``FILTER_BUCKETS`` rows,
    so that rows that need no join are not shuffled for it. More keys mean more rows that may match.
    """
    buckets = keys.select(F.pmod("key", F.lit(FILTER_BUCKETS)).alias("bucket")).distinct().withColumn("maybe", F.lit(True))
    marked = df.withColumn("bucket", F.pmod(key, F.lit(FILTER_BUCKETS))).join(F.broadcast(buckets), "bucket", "left")
    return marked.withColumn("maybe", F.coalesce("maybe", F.lit(False))).drop("bucket")


#: Most rows of an Arrow batch; both sides hold whole batches.
BATCH_ROWS = 1_000
_cleaners: dict[str, Callable[[], None]] = {}
_owner = ""


def worker_cache(owner: str, clear: Callable[[], None]) -> None:
    """Tell that an operator keeps something in its Python worker, and how to drop it. Called where it is used.

    A worker serves one operator after the other. What one has kept is dropped when another one starts.
    """
    global _owner
    if _owner != owner:
        for name in [n for n in _cleaners if n != owner]:
            _cleaners.pop(name)()
        _owner = owner
    _cleaners[owner] = clear


def add_columns(
    df: DataFrame, inputs: Sequence[str], fields: str, start: Callable[[], Callable[..., Sequence[Sequence]]], drop: Iterable[str] = ()
) -> DataFrame:
    """Append columns computed in Arrow batches; columns of the same names are replaced and those of ``drop`` left out.

    ``start()`` runs once per task and returns a function from lists (one per
    input column) to sequences (one per field of ``fields``). The other
    columns pass through as they are. No column is sent twice.
    """
    spark = df.sparkSession
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    new: list[StructField] = _parse_datatype_string(fields).fields
    kept = without(df, [*[f.name for f in new], *drop])
    lowered = [c.lower() for c in kept]
    more = [c for c in dict.fromkeys(c.lower() for c in inputs) if c not in lowered]
    # On the way columns have plain names, since any name may be in use, also one with a dot.
    sources = df.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate([*kept, *more])])
    at = [lowered.index(c.lower()) if c.lower() in lowered else len(kept) + more.index(c.lower()) for c in inputs]
    width = len(kept)
    names = [f"_{i}" for i in range(width + len(new))]
    schema = StructType([*sources.schema.fields[:width], *[StructField(n, f.dataType) for n, f in zip(names[width:], new)]])
    types = [to_arrow_type(f.dataType) for f in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for whole in batches:
            for first in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(first, SLICE_ROWS)
                results = work(*[batch.column(i).to_pylist() for i in at])
                arrays = [
                    r if isinstance(r, pa.Array) else pa.array(r, type=t) for r, t in zip(results, types, strict=True)
                ]
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(width)), *arrays], names=names)

    return sources.mapInArrow(run, schema).toDF(*kept, *[f.name for f in new])


class BoundedCache(dict):
    """key → ``compute(key)``, remembered in two generations of at most ``size`` keys each.

    When the young generation is full it becomes the old one; keys that are
    still in use move back. Results never depend on what is remembered.
    """

    def __init__(self, compute: Callable, size: int):
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
