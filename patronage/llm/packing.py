"""Packing: fixed-length training sequences by the harmonic method.

Lengths fall into reciprocal-capacity classes: class k holds the pieces longer
than capacity/(k+1) and at most capacity/k, and a bin of class k is closed
once it holds exactly k pieces. A bin needs no knowledge of other bins, so each
task fills its own bins while it streams over its documents; nothing is
shuffled and at most one open bin per class is held.

Documents may be cut anywhere, which removes the method's usual waste: a
document gives whole sequences (class 1) and its rest is cut into powers of
two, whose classes k = capacity/length fill a bin without a gap. Bins still
open when a task ends are split into power-of-two runs of pieces, so their
sequences are as long as a power of two and need no padding either.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.byte_bpe import byte_bpe, vocabulary
from patronage.llm.common import prepare

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
BATCH_ROWS = 1024
_TASK_BITS = 33  # sequence_id = task << 33 | number within the task


def cut(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole sequences, then the rest
    as descending powers of two."""
    pieces = [(at, capacity) for at in range(0, tokens - capacity + 1, capacity)]
    at = tokens - tokens % capacity
    for bit in range(capacity.bit_length() - 1, -1, -1):
        if tokens % capacity >> bit & 1:
            pieces.append((at, 1 << bit))
            at += 1 << bit
    return pieces


class HarmonicBins:
    """Open bins, one per class. ``add`` returns the pieces of the bin that it
    closes (else nothing), ``rest`` the runs left at the end."""

    def __init__(self, capacity: int):
        self.capacity, self.open = capacity, {}

    def add(self, piece: tuple, length: int) -> list[tuple] | None:
        k = self.capacity // length
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) == k:
            return self.open.pop(k)
        return None

    def rest(self) -> Iterator[list[tuple]]:
        for _, held in sorted(self.open.items()):
            at = 0
            for bit in range(len(held).bit_length() - 1, -1, -1):
                if len(held) >> bit & 1:
                    yield held[at:at + (1 << bit)]
                    at += 1 << bit
        self.open = {}


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary_path: str | None = None,
         capacity: int = 1024, end_id: int = 0) -> DataFrame:
    """Pack every document into sequences of at most ``capacity`` tokens.

    Returns one row per piece: doc_id, start (ids of the document before it),
    length, ids (little-endian unsigned 32-bit integers), doc_tokens (with the
    end id), sequence_id, offset (gapless from 0 within a sequence). Every id
    lies in exactly one piece. A sequence is full or as long as a power of two.

    Null and empty texts give one piece with the end id alone. A null id stays
    null. Repeated rows are packed each on its own. Further columns, whatever
    their names, aren't read. An empty table gives no rows. ``sequence_id`` is
    unique in the result; its value depends on how the input is split.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    prepare(docs.sparkSession)
    path = vocabulary_path or vocabulary("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, bins, end = byte_bpe(path), HarmonicBins(capacity), int(end_id).to_bytes(4, "little")
        number = TaskContext.get().partitionId() << _TASK_BITS
        rows: list[tuple] = []

        def close(pieces):
            nonlocal number
            offset = 0
            for doc, start, length, ids, total in pieces:
                rows.append((doc, start, length, ids, total, number, offset))
                offset += length
            number += 1

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = bpe.encode(text.as_py()) + end
                total = len(ids) // 4
                for start, length in cut(total, capacity):
                    if full := bins.add((doc, start, length, ids[4 * start:4 * (start + length)], total), length):
                        close(full)
                        if len(rows) >= BATCH_ROWS:
                            yield _batch(rows)
                            rows = []
        for run_ in bins.rest():
            close(run_)
        if rows:
            yield _batch(rows)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)],
                                      schema=_ARROW)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids instead of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
