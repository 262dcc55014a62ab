"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch that a task turns into Python objects at a time.
SLICE_ROWS, SLICE_BYTES = 512, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Return what this process has freed to the system: workers are reused, and their
    heaps, as the driver's, would keep the peak of each step."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def small_batches(spark: SparkSession, size: int = 16 << 20) -> None:
    """Lower the session's bound on the bytes of an Arrow batch to ``size``: several copies
    of a batch are in a task's memory at once, and rows here can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    give_back()


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) of a document table; a null text is empty.
    Other columns are left behind, so none can clash with an operator's own. Arrow
    batches of the session are kept small."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in short zero-copy slices, so that a task holds few rows as Python
    objects; a slice has one row at least, however long."""
    give_back()
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, rows)
            while part.num_rows > 1 and part.nbytes > size:
                part = part.slice(0, part.num_rows // 2)
            at += part.num_rows
            yield part


def numbered(df: DataFrame, keys: list[str], salt: list[Column], order: list[Column], out: str,
             rows_per_block: int = 65_536) -> DataFrame:
    """Add ``out``: gapless numbers from 0 within each value of ``keys``.

    One window over a key would sort that key's rows in one task. Instead each
    key is cut into blocks by a hash of ``salt``, as many as its row count asks
    for; rows are numbered within (key, block), and a block starts where the
    one before ends. ``keys`` must have a bounded number of values (shards,
    piece lengths): their row counts are broadcast. Rows of one block are
    ordered by ``order``, so the numbering is deterministic up to equal rows.
    """
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    blocked = (df.join(F.broadcast(n), keys)
               .withColumn("_block", F.pmod(F.xxhash64(*salt), F.ceil(F.col("_n") / F.lit(rows_per_block))))
               .drop("_n"))
    by_block = blocked.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_block.select(*keys, "_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    return (blocked.join(starts, [*keys, "_block"])
            .withColumn(out, (F.col("_start") + F.row_number().over(inside) - 1).cast("long"))
            .drop("_start", "_block"))


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of a string's UTF-8 bytes, bit by bit (polynomial of zlib)."""
    bits = "list_reduce(range(8), lambda y, i: if(y % 2 = 1, xor(y // 2, 3988292384), y // 2), {0})"
    start = bits.format("xor(x, CAST(('0x' || substr(hex(encode(" + text + ")), CAST(2 * b + 1 AS INT), 2)) AS BIGINT))")
    return f"xor(list_reduce(range(octet_length(encode({text}))), lambda x, b: {start}, CAST(4294967295 AS BIGINT)), 4294967295)"
