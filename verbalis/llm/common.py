"""Shared helpers: whitespace rules, tables kept for one run, batches of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verbalis.session import Workspace

#: White space is U+0020 and U+0009 to U+000D.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD_RUN = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def whole_text(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def folded(text: Column) -> Column:
    """A key for comparing texts without the case of A-Z: equal for two texts only if they differ in nothing else.

    ``translate`` takes many times as long. Texts beyond ASCII are lower-cased as the characters of their single bytes.
    That turns A-Z to a-z, and lead bytes of two-byte characters to those of longer ones; since the bytes that follow
    still tell how long a character was, different texts stay different.
    """
    one_byte_each = F.octet_length(text) == F.length(text)
    return F.when(one_byte_each, F.lower(text)).otherwise(F.lower(F.decode(text.cast("binary"), "ISO-8859-1")))


def whole_row(df: DataFrame) -> Column:
    """All columns of a row as one value, so that no name of theirs can clash; ``columns_of`` gives them back."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")


def columns_of(df: DataFrame, leave_out: set[str] = frozenset()) -> list[Column]:
    """The columns of ``df`` from a ``_row`` made of it."""
    return [F.col("_row").getField(c).alias(c) for c in df.columns if c not in leave_out]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def space_of(spark: SparkSession) -> Workspace:
    """Tables of one run in the shared folder; they outlive lost executors."""
    return Workspace(spark)


def lean() -> None:
    """For Python workers, which live on from task to task: what earlier work freed goes back to the system."""
    pa.set_memory_pool(pa.system_memory_pool())
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


@contextmanager
def short_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """While tables of whole texts are kept, they reach Python workers in batches of at most so many rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``; a longer text makes a batch of its own."""
    for batch in batches:
        at = 0
        sizes = batch.column(column)
        lengths = pa.compute.fill_null(pa.compute.binary_length(sizes), 0).to_pylist()
        total = 0
        for i, size in enumerate(lengths):
            if total and total + size > limit:
                yield batch.slice(at, i - at)
                at, total = i, 0
            total += size
        if at < batch.num_rows:
            yield batch.slice(at)
