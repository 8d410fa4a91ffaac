"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from feedlake.session import scratch_path, small_batches

#: Bytes that separate words in `[^\x20\x09-\x0D]+`: exactly those that bytes.split() splits at.
WORD = r"[^\x20\x09-\x0D]+"
#: Lower-cases A-Z alone, byte by byte; UTF-8 continuation bytes are untouched.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame, columns: list[str], *more) -> DataFrame:
    """`columns` of docs in one struct, row__, beside the columns `more`: an operator's own names cannot clash
    with the names inside."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row__"), *more)


def unpacked(df: DataFrame, columns: list[str], *more) -> DataFrame:
    """The packed columns and the columns `more`; of two of one name, the one of `more` stays."""
    return df.select(*(F.col(f"row__.`{c}`") for c in columns if c not in more), *more)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder (spark.checkpoint.dir) and read again: cuts the lineage, and any
    executor can be lost afterwards. Compressed with zstd: some of these tables hold whole texts."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_KEPT: dict[str, object] = {}


def kept(name: str, make):
    """A worker's own cache, kept from task to task until another one is asked for."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def pieces(batches: Iterable[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes of text (one row at least), so that the memory
    that a batch needs does not follow the row count per Arrow batch."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        n, at = batch.num_rows, 0
        while at < n:
            size, end = 0, at
            if col.nbytes <= most:
                end = n
            else:
                step = max(1, int(n * most / max(col.nbytes, 1)))
                end = min(n, at + step)
                while end - at > 1 and (size := col.slice(at, end - at).nbytes) > 2 * most:
                    end = at + max(1, (end - at) // 2)
            yield batch.slice(at, end - at)
            at = end


def numbered(df: DataFrame, name: str, *order, at: str = "at") -> DataFrame:
    """The rows with their place `at` (long, from 0) in the given order, written out. They are sorted over range
    partitions; of the counts of the partitions, one row each, the running sum is broadcast."""
    ordered = stored(df.orderBy(*order).withColumn("in__", F.monotonically_increasing_id()), name)
    part = F.shiftright("in__", 33)
    before = Window.orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)
    counts = ordered.groupBy(part.alias("part__")).agg(F.count(F.lit(1)).alias("n__"))
    first = counts.select("part__", F.coalesce(F.sum("n__").over(before), F.lit(0)).alias("first__"))
    rows = ordered.withColumn("part__", part).join(F.broadcast(first), "part__")
    return rows.withColumn(at, F.col("first__") + F.col("in__").bitwiseAND((1 << 33) - 1)).drop("in__", "part__", "first__")
