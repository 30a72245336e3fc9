"""What the corpus operators share: staging tables, table access, ASCII lower-casing."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.functions.ship import ship_package
from episodica.functions.staging import discard, materialize, materialize_bucketed, staging_path

__all__ = ["ascii_lower", "discard", "hand_back", "lean", "materialize", "materialize_bucketed", "prepare", "read_table", "staging_path", "text_or_empty"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Arrow batches handed to Python workers hold at most this many bytes.
ARROW_BATCH_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches by bytes, so that very long texts don't pile up in a worker, and ship this package to the executors."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    ship_package(spark)


def lean(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """rows, which hands what it freed back to the system when a task ends: executors keep their Python workers for other stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(batches)
        finally:
            hand_back()

    return run


def hand_back() -> None:
    """Return freed memory to the system."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # another C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` agrees with that on pure ASCII and is cheaper there."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
