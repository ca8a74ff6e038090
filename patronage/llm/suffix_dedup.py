"""Exact removal of repeated passages by a sparse, distributed suffix array.

A byte goes if it lies in a string of ``min_length`` bytes (a window) that also
starts anywhere else. Sorting all suffixes would move every text many times
over, so only suffixes at anchors are sorted, and only where it matters:

1. Anchors. A window's anchor is the place in it whose short gram has the
   least hash (the last such place). Equal windows have their anchor at the same
   place, so only windows of anchors with equal grams can be equal. A few
   windows in a row share an anchor; what they cover is the anchor's context.
2. Contexts that occur twice, counted by hash: all their windows repeat. That
   settles the inside of copies; nothing but hashes and places is shuffled. A
   task sends a context on twice at most; what it meets more often is known to
   repeat, so a context that is everywhere is no hot key.
3. For the other contexts of a gram that has several (around the ends of
   copied passages), the suffixes and the reversed prefixes at their anchors
   are put in order by deep-shallow sorting. With the common prefixes of both
   orders, the window that starts l bytes before an anchor repeats exactly if
   another anchor is in its class in both: at least l bytes equal to the left,
   min_length - l to the right.
4. A gram with more contexts than one task should hold is dealt into chunks;
   windows that are single in their chunk are then counted by hash over all
   chunks, which makes step 3 exact at any size.
5. Each document's repeated windows are merged and cut out.

Hashes of contexts, chunk windows and texts have 64 bits beside a gram or
document they belong to. Texts are compressed before they are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.common import checkpointed, prepare, release, remove_path, scratch_path
from patronage.llm.deep_shallow import deep_shallow

MIN_LENGTH = 400
CHUNK = 16_384         # contexts of one gram that one task sorts together
PIECE = 1 << 20        # bytes that are hashed at once
REFINE_ROWS = 4_096    # contexts that are sorted at once, if groups end there
MEASURED_BYTES = 8 << 20  # of texts in a batch of results
_BASE = 0x9E3779B97F4A7C15  # odd, so powers have inverses
_PLACE_BITS = 24

SEEN = 1 << 20         # contexts that a task remembers

#: known: the context is known to repeat; gram and context are then arbitrary, so that such rows spread.
ANCHORS = "gram bigint, context bigint, before int, after int, doc bigint, hash bigint, start bigint, known boolean"
_ANCHOR_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
_ANCHOR_NAMES = [c.split()[0] for c in ANCHORS.split(", ")]
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _grams(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes at each place."""
    up, down = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    h = (sums[width:] - sums[:-width]) * down[:len(data) - width + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def _window_least(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value of each ``width`` values in a row; of equal
    ones the last."""
    n = len(h)
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    packed = (h & ~mask) | (mask - np.arange(n, dtype=np.uint64))
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = packed
    rows = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n - width + 1], ahead[width - 1:n])
    return (mask - (least & mask)).astype(np.int64)


def anchors(texts: list[bytes], min_length: int) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each text with windows: (number, first window, last window, anchor,
    gram hash) of each run of windows that share an anchor. All texts together
    should be about ``PIECE`` bytes; longer ones come in pieces."""
    width = max(8, min_length // 8)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < min_length:
        return []
    h = _grams(data, width)
    place = _window_least(h, min_length - width + 1)
    out, at = [], 0
    for number, text in enumerate(texts):
        windows = len(text) - min_length + 1
        if windows > 0:
            of = place[at:at + windows]
            first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            last = np.r_[first[1:], windows] - 1
            out.append((number, first, last, of[first] - at, h[of[first]].view(np.int64)))
        at += len(text)
    return out


def _pieces(batches: Iterator[pa.RecordBatch], min_length: int) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Lists of (doc, hash, place in the text, bytes) of about ``PIECE`` bytes.
    A long text comes in pieces that overlap so that each window is in one."""
    held, size = [], 0
    for batch in batches:
        for doc, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            raw = text.as_py().encode()
            for at in range(0, max(1, len(raw) - min_length + 1), PIECE):
                part = raw if len(raw) <= PIECE else raw[at:at + PIECE + min_length - 1]
                if len(part) < min_length:
                    continue
                held.append((doc, h, at, part))
                size += len(part)
                if size >= PIECE:
                    yield held
                    held, size = [], 0
                if part is raw:
                    break
    if held:
        yield held


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, hash (together they name a text), text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("doc"), F.xxhash64(text).alias("hash"), text.alias("text"))


def _find_anchors(keyed: DataFrame, min_length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, seen = xxhash.xxh3_64_intdigest, {}
        for piece in _pieces(batches, min_length):
            columns = [[] for _ in _ANCHOR_NAMES]
            for number, first, last, place, gram in anchors([p[3] for p in piece], min_length):
                doc, h, at, raw = piece[number]
                contexts = np.array([digest(raw[a:b]) for a, b in zip(first.tolist(), (last + min_length).tolist(), strict=True)], np.uint64)
                n, before = len(first), place - first
                known = np.zeros(n, bool)
                for i, key in enumerate(zip(contexts.tolist(), gram.tolist(), before.tolist(), strict=True)):
                    times = seen[key] = seen.get(key, 0) + 1
                    known[i] = times > 2
                if len(seen) > SEEN:
                    seen.clear()
                spread = np.array([digest(f"{doc},{h},{at + p}") for p in first[known].tolist()], np.uint64).view(np.int64)
                gram, contexts = gram.copy(), contexts.view(np.int64)
                gram[known], contexts[known] = spread, spread
                for column, values in zip(columns, (gram, contexts, before, place - last,
                                                    np.full(n, doc), np.full(n, h), first + at, known), strict=True):
                    column.append(values)
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(columns, _ANCHOR_TYPES, strict=True)], names=_ANCHOR_NAMES)

    return keyed.mapInArrow(run, ANCHORS)


def _compressed(keyed: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3, write_content_size=True).compress
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([pack(t.as_py().encode()) for t in part.column(2)], pa.binary())],
                                                 names=["doc", "hash", "packed"])

    return keyed.mapInArrow(run, "doc bigint, hash bigint, packed binary")


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


# -- step 3 -------------------------------------------------------------------
CONTEXTS = "gram bigint, chunk bigint, chunks bigint, context bigint, before int, after int, n bigint, doc bigint, hash bigint, start bigint, bytes binary"


def _cut_contexts(keyed: DataFrame, wanted: DataFrame, min_length: int) -> DataFrame:
    """The bytes of the wanted contexts (rows of ``CONTEXTS`` without them)."""
    names = [c.split()[0] for c in CONTEXTS.split(", ")]
    per_doc = wanted.groupBy("doc", "hash").agg(F.collect_list(F.struct(*[n for n in names[:7]], "start")).alias("cuts"))
    rows = _compressed(keyed).join(per_doc, ["doc", "hash"])
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for batch in batches:
            for doc, h, packed, cuts in zip(*[batch.column(i) for i in range(4)], strict=True):
                doc, h, raw = doc.as_py(), h.as_py(), _unpack(packed.as_py())
                for c in cuts.as_py():
                    start, size = c["start"], c["before"] - c["after"] + min_length
                    out.append((c["gram"], c["chunk"], c["chunks"], c["context"], c["before"], c["after"], c["n"], doc, h, start, raw[start:start + size]))
                    if len(out) >= 2048:
                        yield _rows(out, names, types)
                        out = []
        if out:
            yield _rows(out, names, types)

    return rows.select("doc", "hash", "packed", "cuts").mapInArrow(run, CONTEXTS)


def _rows(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


class _Group:
    """The contexts of one gram and chunk, as slices of the two orders."""

    def __init__(self, right_order, right_lcp, left_order, left_lcp, before, after, n, length):
        # members are numbered 0..g-1; *_rank: place of a member in the order
        self.g, self.length = len(n), length
        self.before, self.after, self.n = before, after, n
        self.right_rank, self.left_rank = np.empty(self.g, np.int64), np.empty(self.g, np.int64)
        self.right_rank[right_order] = np.arange(self.g)
        self.left_rank[left_order] = np.arange(self.g)
        self.right_lcp, self.left_lcp = right_lcp, left_lcp

    def spans(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(l from, l to, class of each member): between two borders no class
        changes. Windows start l bytes before the anchor."""
        low, high = int(self.after.min()), int(self.before.max())
        borders = np.unique(np.r_[low, high + 1, self.left_lcp[1:] + 1, self.length - self.right_lcp[1:]])
        borders = borders[(borders >= low) & (borders <= high + 1)]
        for a, b in zip(borders[:-1].tolist(), (borders[1:] - 1).tolist(), strict=True):
            left = np.cumsum(np.r_[False, self.left_lcp[1:] < a])[self.left_rank]
            right = np.cumsum(np.r_[False, self.right_lcp[1:] < self.length - a])[self.right_rank]
            yield a, b, left * self.g + right


def _repeats(group: _Group) -> Iterator[tuple[int, int, int]]:
    """(member, l from, l to) of windows with another member in their class,
    for members whose context is single."""
    if group.g == 2:  # the common case, in plain numbers
        a, b = max(int(group.after.max()), group.length - int(group.right_lcp[1])), min(int(group.before.min()), int(group.left_lcp[1]))
        if a <= b:
            yield from ((m, a, b) for m in (0, 1) if group.n[m] == 1)
        return
    open_: dict[int, list[int]] = {}
    for a, b, classes in group.spans():
        _, where, count = np.unique(classes, return_inverse=True, return_counts=True)
        for m in np.flatnonzero((count[where] > 1) & (group.n == 1)).tolist():
            held = open_.get(m)
            if held and held[1] == a - 1:
                held[1] = b
            else:
                if held:
                    yield m, *held
                open_[m] = [a, b]
    for m, held in open_.items():
        yield m, *held


def _single_windows(group: _Group, contexts: list[bytes], anchor: np.ndarray) -> Iterator[tuple[int, int, int, bool]]:
    """(member, l, hash, single) for one member of each class of equal windows."""
    for a, b, classes in group.spans():
        _, first, where, count = np.unique(classes, return_index=True, return_inverse=True, return_counts=True)
        alone = count == 1
        for k, m in enumerate(first.tolist()):
            for l in range(max(a, int(group.after[m])), min(b, int(group.before[m])) + 1):
                at = int(anchor[m]) - l
                yield m, l, xxhash.xxh3_64_intdigest(contexts[m][at:at + group.length]), bool(alone[k] and group.n[m] == 1)


REFINED = "kind int, gram bigint, l int, window bigint, single boolean, doc bigint, hash bigint, start bigint, stop bigint"
_REFINED_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
_REFINED_NAMES = [c.split()[0] for c in REFINED.split(", ")]


def _refine(rows: list[dict], min_length: int) -> list[tuple]:
    """Step 3 for whole groups (rows in order of gram and chunk)."""
    out = []
    group_of = np.cumsum([0] + [(a["gram"], a["chunk"]) != (b["gram"], b["chunk"]) for a, b in zip(rows, rows[1:], strict=False)])
    before = np.array([r["before"] for r in rows], np.int64)
    after = np.array([r["after"] for r in rows], np.int64)
    n = np.array([r["n"] for r in rows], np.int64)
    contexts = [r["bytes"] for r in rows]
    right_order, right_lcp = deep_shallow([c[k:] for c, k in zip(contexts, before.tolist(), strict=True)], group_of)
    left_order, left_lcp = deep_shallow([c[:k][::-1] for c, k in zip(contexts, before.tolist(), strict=True)], group_of)
    cuts = np.flatnonzero(np.r_[True, group_of[1:] != group_of[:-1]])
    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(rows)], strict=True):
        if hi - lo < 2 and rows[lo]["chunks"] == 1:
            continue
        group = _Group(right_order[lo:hi] - lo, right_lcp[lo:hi], left_order[lo:hi] - lo, left_lcp[lo:hi],
                       before[lo:hi], after[lo:hi], n[lo:hi], min_length)
        if group.g > 1:
            for m, a, b in _repeats(group):
                r = rows[lo + m]
                anchor = r["start"] + r["before"]
                out.append((0, r["gram"], 0, 0, True, r["doc"], r["hash"], anchor - b, anchor - a + min_length))
        if rows[lo]["chunks"] > 1:
            for m, l, window, single in _single_windows(group, contexts[lo:hi], before[lo:hi]):
                r = rows[lo + m]
                start = r["start"] + r["before"] - l
                window -= (window >> 63) << 64
                out.append((1, r["gram"], l, window, single, r["doc"], r["hash"], start, start + min_length))
    return out


def _refined(contexts: DataFrame, min_length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows):
            found = _refine(rows, min_length)
            for at in range(0, len(found), 8192):
                yield _rows(found[at:at + 8192], _REFINED_NAMES, _REFINED_TYPES)

        held: list[dict] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                for row in batch.slice(at, 1024).to_pylist():
                    if held:
                        last = held[-1]
                        same = last["gram"] == row["gram"] and last["chunk"] == row["chunk"]
                        if same and last["context"] == row["context"] and last["before"] == row["before"] and last["after"] == row["after"]:
                            continue  # the same context again, from a repeated row
                        if not same and len(held) >= REFINE_ROWS:
                            yield from done(held)
                            held = []
                    held.append(row)
        if held:
            yield from done(held)

    order = ["gram", "chunk", "context", "before", "after"]
    return contexts.repartition("gram", "chunk").sortWithinPartitions(*order).mapInArrow(run, REFINED)


# -- the whole ----------------------------------------------------------------
def repeated_windows(docs: DataFrame, min_length: int = MIN_LENGTH, *, id_col: str = "doc_id", text_col: str = "text",
                     chunk: int = CHUNK) -> DataFrame:
    """Runs of repeated windows: doc, hash, spans (array of start, stop in
    bytes, in no order, possibly overlapping). doc is the id (0 if null), hash
    the xxhash64 of the text. Documents without repeats have no row."""
    spark = docs.sparkSession
    prepare(spark)
    keyed = _keyed(docs, id_col, text_col)
    kind = ["known", "gram", "context", "before", "after"]
    alike = Window.partitionBy(*kind)  # two rows of each task at most
    counted = (_find_anchors(keyed, min_length)
               .withColumn("n", F.when(F.col("known"), 2).otherwise(F.count(F.lit(1)).over(alike)))
               .withColumn("one", F.row_number().over(alike.orderBy("doc", "hash", "start")) == 1))
    folder = scratch_path(spark, "anchors")
    counted.write.parquet(folder)
    counted = spark.read.parquet(folder)
    release(spark)  # the shuffle by context
    classes = counted.where("one and not known").drop("one", "known")
    grams = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("g"), F.min("n").alias("least")).where("g > 1 and least = 1")
    grams = checkpointed(grams)  # apart, so that the join with it can split a hot gram
    chunks = F.ceil(F.col("g") / chunk)
    wanted = (classes.join(grams, "gram").withColumn("chunks", chunks)
              .withColumn("chunk", F.pmod(F.xxhash64("context", "before", "after"), F.col("chunks"))))
    refined = checkpointed(_refined(_cut_contexts(keyed, wanted, min_length), min_length))
    del wanted
    release(spark)  # the shuffles of classes, texts and contexts
    inside = refined.where("kind = 0").select("doc", "hash", "start", "stop")
    across = (refined.where("kind = 1").groupBy("gram", "l", "window")
              .agg(F.count(F.lit(1)).alias("n"), F.collect_list(F.when(F.col("single"), F.struct("doc", "hash", "start", "stop"))).alias("single"))
              .where("n > 1").select(F.inline("single")))  # a chunk gives one row per window, so the list is as long as the chunks are many
    settled = counted.where("n > 1").select(
        "doc", "hash", "start", (F.col("start") + F.col("before") - F.col("after") + min_length).alias("stop"))
    spans = settled.unionAll(inside).unionAll(across).groupBy("doc", "hash").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    out = checkpointed(spans)
    remove_path(spark, folder)
    del refined, inside, across, settled, spans, counted, classes
    release(spark)
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes in any of the spans."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def cut(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for start, stop in runs:
        parts.append(raw[at:start])
        at = stop
    return b"".join([*parts, raw[at:]])


def whole_characters(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs without characters that they cover in part."""
    out = []
    for start, stop in runs:
        while start < stop and raw[start] & 0xC0 == 0x80:
            start += 1
        while stop > start and stop < len(raw) and raw[stop] & 0xC0 == 0x80:
            stop -= 1
        if start < stop:
            out.append((start, stop))
    return out


def _spans(value: pa.Scalar) -> list[tuple[int, int]]:
    return merged([(s["start"], s["stop"]) for s in value.as_py() or ()])


def measure(docs: DataFrame, min_length: int = MIN_LENGTH, *, id_col: str = "doc_id", text_col: str = "text",
            chunk: int = CHUNK) -> DataFrame:
    """What goes and what stays of every row: doc_id, n_bytes, n_removed,
    n_spans (maximal removed runs), kept_sha256 (of the bytes that stay), text (what
    :func:`remove` leaves: characters that go in part stay), removed (the
    runs as start, stop in bytes). Null and empty
    texts have no bytes; of repeated rows each repeats the other; further
    columns aren't read. An empty table gives no rows."""
    spans = repeated_windows(docs, min_length, id_col=id_col, text_col=text_col, chunk=chunk)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3, write_content_size=True).compress
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([squeeze(t.as_py().encode()) for t in part.column(2)], pa.binary())],
                                                 names=["doc_id", "hash", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "removed"]
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))]
        for batch in batches:
            out, held = [], 0
            for doc, packed, value in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                raw, runs = _unpack(packed.as_py()), _spans(value)
                out.append((doc, len(raw), sum(b - a for a, b in runs), len(runs), hashlib.sha256(cut(raw, runs)).hexdigest(),
                            cut(raw, whole_characters(raw, runs)).decode(), [{"start": a, "stop": b} for a, b in runs]))
                held += len(raw)
                if held >= MEASURED_BYTES:
                    yield _rows(out, names, types)
                    out, held = [], 0
            if out:
                yield _rows(out, names, types)

    packed = rows.select("doc_id", F.xxhash64("text").alias("hash"), "text").mapInArrow(pack, "doc_id bigint, hash bigint, packed binary")
    joined = packed.withColumn("doc", F.coalesce("doc_id", F.lit(0))).join(spans, ["doc", "hash"], "left").select("doc_id", "packed", "spans")
    return joined.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, text string, "
                                  "removed array<struct<start bigint, stop bigint>>")


def remove(docs: DataFrame, min_length: int = MIN_LENGTH, *, id_col: str = "doc_id", text_col: str = "text",
           chars_col: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with repeated passages cut from the text; all rows stay, all
    other columns too (``chars_col``, if named, is set to the new length). A
    character that is repeated in part stays. Null texts stay null."""
    spans = repeated_windows(docs, min_length, id_col=id_col, text_col=text_col, chunk=chunk)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("doc"),
                        F.xxhash64(text).alias("hash"))
    joined = keyed.join(spans, ["doc", "hash"], "left").select("row", "spans")
    cleaned = joined.withColumn("cut", _cut_column(F.col(f"row.`{text_col}`"), F.col("spans")))
    out = []
    for f in docs.schema.fields:
        value = F.col(f"row.`{f.name}`")
        if f.name == text_col:
            value = F.col("cut")
        elif f.name == chars_col:
            value = F.coalesce(F.length("cut"), F.lit(0)).cast(f.dataType)
        out.append(value.alias(f.name))
    return cleaned.select(*out)


def _cut_column(text, spans):
    """Texts without the spans, for those that have any."""
    @F.pandas_udf("string")
    def cut_text(texts: pd.Series, all_spans: pd.Series) -> pd.Series:
        out = []
        for t, s in zip(texts, all_spans, strict=True):
            if t is None or s is None or not len(s):
                out.append(t)
                continue
            raw = t.encode()
            runs = whole_characters(raw, merged([(x["start"], x["stop"]) for x in s]))
            out.append(cut(raw, runs).decode())
        return pd.Series(out, dtype=object)

    return cut_text(text, spans)
