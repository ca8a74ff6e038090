"""Rows of blocks: helpers for operators that work on one block of documents
at a time.

A first pass writes, for each block of documents that a task reads, one packed
row of arrays and any number of plain rows that Spark groups and joins. A later
pass brings the packed row and what was found out about the block together
again, sorted, so that a task holds one block at a time.
"""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

PLAIN_ROWS = 1 << 14  # of a batch
_TASK_BITS, _BLOCK_BITS = 21, 11  # block = task << 11 | number within the task
CODE_BITS = 31                    # a block's codes: block << 31 | code is a long


def pack_arrays(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return zstandard.ZstdCompressor(level=6).compress(out.getvalue())


def narrow(values: np.ndarray) -> np.ndarray:
    """Non-negative numbers in the smallest type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def unpack_arrays(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(data)), allow_pickle=False) as found:
        return {name: found[name] for name in found.files}


class Numbers:
    """Block numbers of a task (at most 2,048; tasks below 2 million). They are
    the same in every attempt at a task."""

    def __init__(self):
        self.task, self.next = TaskContext.get().partitionId(), 0
        if self.task >> _TASK_BITS:
            raise ValueError("too many tasks: read larger splits (spark.sql.files.maxPartitionBytes)")

    def __call__(self) -> int:
        if self.next >> _BLOCK_BITS:
            raise ValueError("a task has too much text: read smaller splits (spark.sql.files.maxPartitionBytes)")
        self.next += 1
        return self.task << _BLOCK_BITS | (self.next - 1)


def rows_of(block: int, schema: pa.Schema, data: bytes | None = None, **columns: Sequence) -> Iterator[pa.RecordBatch]:
    """Batches of ``schema`` (block, data, then plain columns): a packed row
    if there is ``data``, then a row for each entry of the plain columns."""
    plain = schema.names[2:]
    if data is not None:
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([data], pa.binary()),
                                          *[pa.nulls(1, schema.field(c).type) for c in plain]], schema=schema)
    n = len(columns[plain[0]]) if columns else 0
    for at in range(0, n, PLAIN_ROWS):
        m = min(PLAIN_ROWS, n - at)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(m, block), pa.int64()), pa.nulls(m, pa.binary()),
                                          *[_part(columns[c], at, m, schema.field(c).type) for c in plain]], schema=schema)


def _part(values: Sequence | pa.Array, at: int, n: int, kind: pa.DataType) -> pa.Array:
    return values.slice(at, n) if isinstance(values, pa.Array) else pa.array(values[at:at + n], kind)


def by_block(df: DataFrame) -> DataFrame:
    """Rows (block, data, ...) so that a task holds whole blocks, one after
    another, the packed row first."""
    return df.repartition("block").sortWithinPartitions("block", df["data"].isNull())


def each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes | None, pa.Table]]:
    """(block, packed row, plain rows) of the batches of :func:`by_block`."""
    held: list[pa.RecordBatch] = []
    block = data = schema = None
    for batch in batches:
        schema = batch.schema
        blocks = batch.column(0).to_numpy()
        borders = np.flatnonzero(np.diff(blocks)) + 1
        for a, b in zip([0, *borders], [*borders, len(blocks)], strict=True):
            if a == b:
                continue
            if block is not None and blocks[a] != block:
                yield block, data, pa.Table.from_batches(held, schema)
                held, data = [], None
            block = int(blocks[a])
            part = batch.slice(a, b - a)
            if part.column(1)[0].is_valid:
                data = part.column(1)[0].as_py()
                part = part.slice(1)
            if part.num_rows:
                held.append(part)
    if block is not None:
        yield block, data, pa.Table.from_batches(held, schema)
