"""Token files: documents' ids as independent zstandard frames that can be
read one by one.

A file is a row of ordinary zstandard frames, so ``zstd -d`` gives all ids one
after another, followed by two skippable frames that decoders pass over:

* document index (magic 0x184D2A50): a zstandard frame with one record per
  document: id, 1 if the id is null, number of its ids;
* seek table (magic 0x184D2A5E): per frame the compressed size, decompressed
  size and checksum (low 32 bits of the content's XXH64), 32 bits each, then
  the number of frames, a flag byte (0x80: checksums) and the magic
  0x8F92EAB1. It is the public seekable layout of zstandard.

Ids are little-endian unsigned integers of 16 or 32 bits, by the vocabulary's
size; the index's first record says which. A document's place follows from the
counts before it, the frames that hold it from the seek table; only those are
read and decompressed, and each is held against its checksum.

Files are written by the tasks that hold the documents in order. A file gets
a name of its own for each attempt and counts only if the finished task
reports it, so a retried or lost task leaves at most a file nobody lists.
"""

from __future__ import annotations

import io
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patronage.llm.byte_bpe import byte_bpe, vocabulary
from patronage.llm.common import checkpointed, prepare

# Fixed values of the file format.
INDEX_MAGIC, TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUM_FLAG = 0x80
ENTRY = np.dtype([("compressed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
RECORD = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("tokens", "<u8")])
FOOTER = struct.Struct("<IBI")

FRAME_BYTES = 256 << 10
FILE_BYTES = 16 << 20
MANIFEST = "task int, file string, number int, documents bigint, tokens bigint, bytes bigint"
DOCUMENTS = "file string, number_in_file bigint, doc_id bigint, first bigint, ids binary"


class TokenFileWriter:
    """Builds one file in memory (bounded by ``FILE_BYTES`` and one document)."""

    def __init__(self, width: int, frame_bytes: int = FRAME_BYTES, level: int = 1):
        self.type, self.frame_bytes = np.dtype(f"<u{width}"), frame_bytes
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.out, self.table, self.records, self.open = io.BytesIO(), [], [], bytearray()
        self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.records.append((doc_id or 0, doc_id is None, len(ids)))
        self.tokens += len(ids)
        if len(ids) and int(ids.max()) > np.iinfo(self.type).max:
            raise ValueError(f"id {ids.max()} doesn't fit {8 * self.type.itemsize} bits")
        self.open += ids.astype(self.type).tobytes()
        while len(self.open) >= self.frame_bytes:
            self._frame(bytes(self.open[:self.frame_bytes]))
            del self.open[:self.frame_bytes]

    def _frame(self, content: bytes) -> None:
        packed = self.zstd.compress(content)
        self.table.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.out.write(packed)

    def finish(self) -> memoryview:
        if self.open:
            self._frame(bytes(self.open))
            self.open.clear()
        records = np.array([(self.type.itemsize, False, self.frame_bytes), *self.records], RECORD)
        index = self.zstd.compress(records.tobytes())
        entries = np.array(self.table, ENTRY).tobytes()
        footer = FOOTER.pack(len(self.table), CHECKSUM_FLAG, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        return self.out.getbuffer()


class TokenFileReader:
    """Reads documents from a seekable file object; only the frames asked for
    are read. Raises ValueError on a frame that doesn't match its checksum."""

    def __init__(self, file):
        self.file = file
        end = file.seek(0, io.SEEK_END)
        frames, flag, magic = FOOTER.unpack(self._at(end - FOOTER.size, FOOTER.size))
        if magic != FOOTER_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums")
        table = end - FOOTER.size - frames * ENTRY.itemsize
        self.table = np.frombuffer(self._at(table, frames * ENTRY.itemsize), ENTRY)
        self.place = np.concatenate([[0], np.cumsum(self.table["compressed"], dtype=np.int64)])
        head = int(self.place[-1])
        magic, size = struct.unpack("<II", self._at(head, 8))
        if magic != INDEX_MAGIC:
            raise ValueError("no document index")
        self.zstd = zstandard.ZstdDecompressor()
        records = np.frombuffer(self.zstd.decompress(self._at(head + 8, size)), RECORD)
        self.type, self.frame_bytes = np.dtype(f"<u{records['doc_id'][0]}"), int(records["tokens"][0])
        self.records = records[1:]
        self.first = np.concatenate([[0], np.cumsum(self.records["tokens"], dtype=np.int64)])
        self.frames_read = 0
        self._held: tuple[int, bytes] = (-1, b"")

    def _at(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def _frame(self, k: int) -> bytes:
        if self._held[0] != k:
            content = self.zstd.decompress(self._at(int(self.place[k]), int(self.table["compressed"][k])))
            if len(content) != self.table["size"][k] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.table["checksum"][k]:
                raise ValueError(f"frame {k} doesn't match its checksum")
            self._held = (k, content)
            self.frames_read += 1
        return self._held[1]

    def __len__(self) -> int:
        return len(self.records)

    def doc_id(self, i: int) -> int | None:
        return None if self.records["null"][i] else int(self.records["doc_id"][i])

    def ids(self, i: int) -> np.ndarray:
        """The ids of the file's document number ``i``."""
        at, end = (int(self.first[j]) * self.type.itemsize for j in (i, i + 1))
        parts = []
        while at < end:
            k = at // self.frame_bytes
            frame = self._frame(k)
            parts.append(frame[at - k * self.frame_bytes:end - k * self.frame_bytes])
            at = (k + 1) * self.frame_bytes
        return np.frombuffer(b"".join(parts), self.type)


def _filesystem(uri: str):
    from pyarrow import fs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def write(docs: DataFrame, folder: str, *, id_col: str = "doc_id", text_col: str = "text",
          vocabulary_path: str | None = None, end_id: int = 2, width: int | None = None, file_bytes: int = FILE_BYTES,
          frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Encode documents and write them in ascending id order.

    ``folder`` is a URI that all executors reach (local path, HDFS or S3, as
    pyarrow opens it). ``width``: bytes of an id; 2 or 4, by the largest id of the
    vocabulary and ``end_id``, if not given; an id that doesn't fit raises. Returns the manifest, one row per file in order: task,
    file, number (of the task's files), documents, tokens, bytes; and first,
    the ids in all files before it. It is materialised: files are written once.

    Null and empty texts give the end id alone. Null ids come first; rows of
    equal id are in order of their text. Further columns aren't read. An empty
    table gives an empty manifest.
    """
    spark = docs.sparkSession
    prepare(spark)
    path = vocabulary_path or vocabulary("byte_bpe_50k.json")
    width = width or (2 if max(byte_bpe(path).largest_id, end_id) < 1 << 16 else 4)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, task = byte_bpe(path), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        writer, number, made = None, 0, []

        def close():
            nonlocal number, writer
            name = f"part-{task:06d}-{number:05d}-{uuid.uuid4().hex}.tok.zst"
            store, place = _filesystem(f"{folder.rstrip('/')}/{name}")
            content = writer.finish()
            store.create_dir(place.rpartition("/")[0], recursive=True)
            with store.open_output_stream(place, compression=None) as out:
                out.write(content)
            made.append((task, name, number, len(writer.records), writer.tokens, len(content)))
            writer, number = None, number + 1

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                writer = writer or TokenFileWriter(width, frame_bytes)
                writer.add(doc, np.frombuffer(bpe.encode(text.as_py()) + end, "<u4"))
                if writer.out.tell() >= file_bytes:
                    close()
        if writer:
            close()
        if made:
            yield pa.RecordBatch.from_pandas(pd.DataFrame(made, columns=["task", "file", "number", "documents", "tokens", "bytes"])
                                             .astype({"task": "int32", "number": "int32"}), preserve_index=False)

    # by id alone: the ranges come from a sample of the keys, which must not hold texts
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return _with_first(checkpointed(ordered.mapInArrow(run, MANIFEST)))


def _with_first(manifest: DataFrame) -> DataFrame:
    """Add the ids before each file: within its task, then of earlier tasks
    (one row per task)."""
    tasks = manifest.groupBy("task").agg(F.sum("tokens").alias("n"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("task").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return (manifest.withColumn("before", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(tasks, "task")
            .select("task", "number", "file", "documents", "tokens", "bytes", (F.col("base") + F.col("before")).alias("first")))


def _any_file(spark: SparkSession, folder: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/*.tok.zst")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return found is not None and len(found) > 0


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All documents of the files in ``folder``: file, number_in_file, doc_id,
    first (ids before it in its file), ids (little-endian unsigned 32-bit
    integers). Every frame is held against its checksum. Files that the
    manifest doesn't list are to be left out by a join on ``file``."""
    prepare(spark)
    if not _any_file(spark, folder):
        return spark.createDataFrame([], DOCUMENTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                reader = TokenFileReader(pa.BufferReader(content.as_buffer()))
                for at in range(0, len(reader), 256):
                    rows = [(name, i, reader.doc_id(i), int(reader.first[i]), reader.ids(i).astype("<u4").tobytes())
                            for i in range(at, min(at + 256, len(reader)))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                        names=["file", "number_in_file", "doc_id", "first", "ids"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok.zst").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return named.mapInArrow(run, DOCUMENTS)


def placed(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows of listed files, their ``first`` replaced by start: the ids of all
    documents before. What is needed of the ids is best taken before, so that
    the ids themselves aren't shuffled."""
    listed = manifest.select("file", F.col("first").alias("base"))
    return rows.join(listed, "file").withColumn("start", F.col("base") + F.col("first")).drop("file", "base", "first")


def digest(rows: DataFrame) -> DataFrame:
    """Rows of :func:`read` with the number and crc32 of the ids for the ids."""
    return rows.select("file", "doc_id", "first", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))
