"""Helpers of the operators: Arrow batches in and out, white space."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import SparkSession

from quarry.session import ship_package
from quarry.session import small_batches as _small_batches
from quarry.shared import stored

__all__ = ["ASCII_SPACE", "chunks", "rows_of", "small_batches", "stored", "to_batch"]

#: The bytes that the contracts call white space, as str.strip() characters.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound the Arrow batches handed to Python, unless the session's owner chose a size; ship the package."""
    _small_batches(spark, rows)
    ship_package(spark)


def rows_of(batches, *names):
    """Tuples of Python values of the named columns, one Arrow batch in memory at a time."""
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def chunks(rows, schema: pa.Schema, size: int = 4096, weight=None, most: int = 8 << 20):
    """Record batches of at most ``size`` rows, or once ``weight(row)`` sums to ``most``."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += weight(row) if weight else 0
        if len(held) >= size or total >= most:
            yield to_batch(held, schema)
            held, total = [], 0
    if held:
        yield to_batch(held, schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
