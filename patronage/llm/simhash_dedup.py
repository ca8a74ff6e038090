"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has a bit for each bit position that is set in more
than half of its shingles' 64-bit hashes. Documents link if their fingerprints
differ in few bits, and a component is what links reach.

A fingerprint is cut into segments. If two of them differ in at most r bits,
one of the m segments differs in at most floor(r/m). So each segment has a
table by value; around each value present, the small Hamming ball is
enumerated and looked up in that table, and the members of matching values are
compared by their whole distance.

Equal fingerprints are one node from the start. Neither the ball nor the
lookup depends on how many members a value has. Members of a value that many
fingerprints share are indexed once more by their other bits, so work follows near
pairs and not the square of such a value. Members are dealt into blocks of bounded size, and
pairs of blocks are compared in tasks that return a spanning forest of the links
they find, never all pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.common import checkpointed, prepare, unsigned
from patronage.llm.components import components

BITS = 64
SHINGLE_WORDS = 3
MAX_BITS = 3
SEGMENTS = 2
BLOCK = 1024  # members of one value that one task holds on each side
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_VOTE_ROWS = 1 << 14


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint of a text; 0 if it has no word."""
    parts = (text or "").encode().translate(_LOWER).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) < words:
        return xxhash.xxh64_intdigest(joined, 42)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:len(parts) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends[words - 1:].tolist(), strict=True)], "<u8")
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _VOTE_ROWS):
        part = hashes[at:at + _VOTE_ROWS].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, hash (xxhash64 of the text), fp (the fingerprint as a signed
    bigint) of each row. Null texts count as empty; null ids stay; further
    columns aren't read."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], names=["doc_id", "hash", "fp"])

    return (docs.select(F.col(id_col).cast("long"), _hash(text_col), F.col(text_col).cast("string"))
            .mapInArrow(run, "doc_id bigint, hash bigint, fp bigint"))


def _hash(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def _forest(left: np.ndarray, right: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) of a spanning forest of the links between two blocks."""
    i, j = np.nonzero(np.bitwise_count(left[:, None] ^ right[None, :]) <= max_bits)
    if not len(i):
        return left[:0], left[:0]
    nodes, where = np.unique(np.concatenate([left[i], right[j]]), return_inverse=True)
    a, b = where[:len(i)], where[len(i):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == label[b]).all():
            break
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
    off = label != np.arange(len(nodes))
    return nodes[off], nodes[label[off]]


def _balls(width: int, radius: int) -> list[int]:
    """Bit masks of the ball, as signed 64-bit numbers."""
    return [sum(1 << b if b < 63 else -1 << 63 for b in bits) for n in range(radius + 1) for bits in itertools.combinations(range(width), n)]


def _tables(width: int, max_bits: int) -> list[list[tuple[int, int]]]:
    """Keys for members that share one segment: the other ``width`` bits are cut into
    max_bits + 2 parts, and a table's key leaves out max_bits of them, so whoever
    differs in at most max_bits of these bits agrees on the key of some table.
    Each table is a list of parts (shift, bits)."""
    parts = max_bits + 2
    edges = [width * i // parts for i in range(parts + 1)]
    cuts = [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
    return [list(kept) for kept in itertools.combinations(cuts, parts - max_bits)]


def _members_of_tables(members: DataFrame, values: DataFrame, segments: int, max_bits: int) -> DataFrame:
    """seg, value, part (table), key, fp: the members of ``values``, once in each table."""
    width = BITS // segments
    rotated = F.col("fp")  # the segment that they share goes to the lowest bits, the others above it
    for s in range(1, segments):
        turned = F.shiftrightunsigned("fp", s * width).bitwiseOR(F.shiftleft("fp", BITS - s * width))
        rotated = F.when(F.col("seg") == s, turned).otherwise(rotated)
    keys = []
    for i, table in enumerate(_tables(BITS - width, max_bits)):
        key = F.lit(0).cast("long")
        for shift, bits in table:
            part = F.shiftrightunsigned("rest", width + shift).bitwiseAND(F.lit((1 << bits) - 1))
            key = F.shiftleft(key, bits).bitwiseOR(part)
        keys.append(F.struct(F.lit(i).alias("part"), key.alias("key")))
    return (members.join(values, ["seg", "value"]).withColumn("rest", rotated)
            .select("seg", "value", "fp", F.explode(F.array(*keys)).alias("t")).select("seg", "value", "t.part", "t.key", "fp"))


def _blocks(keyed: DataFrame, pairs: DataFrame, block: int) -> DataFrame:
    """left, right: the blocks of fingerprints to be compared. ``keyed``: seg,
    value, part, key, fp; ``pairs``: seg, value, other (values whose members may be near)."""
    where = ["seg", "value", "part", "key"]
    sizes = checkpointed(keyed.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"), F.count(F.lit(1)).alias("n")))
    others = sizes.select("seg", F.col("value").alias("other"), "part", "key", F.col("blocks").alias("blocks_b"))
    met = checkpointed(pairs.join(sizes, ["seg", "value"]).join(others, ["seg", "other", "part", "key"])
                       .where("other <> value or n > 1").select(*where, "other", "blocks", "blocks_b"))
    tasks = (met.withColumn("a", F.explode(F.expr("sequence(0, blocks - 1)")))
             .withColumn("b", F.explode(F.expr("sequence(if(value = other, a, 0L), blocks_b - 1)")))
             .select(*where, "a", "other", "b"))
    wanted = (met.select(*where, "blocks").unionAll(met.select("seg", F.col("other").alias("value"), "part", "key", F.col("blocks_b").alias("blocks")))
              .distinct())
    held = checkpointed(keyed.join(wanted, where).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")))
                        .groupBy(*where, "block").agg(F.collect_list("fp").alias("fps")))
    left = held.select(*where, F.col("block").alias("a"), F.col("fps").alias("left"))
    right = held.select("seg", F.col("value").alias("other"), "part", "key", F.col("block").alias("b"), F.col("fps").alias("right"))
    return tasks.join(left, [*where, "a"]).join(right, ["seg", "other", "part", "key", "b"]).select("left", "right")


def links(nodes: DataFrame, *, max_bits: int = MAX_BITS, segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """Links u, v between distinct fingerprints (column fp, bigint) that
    connect exactly what pairs within ``max_bits`` connect.

    Values of more than ``block`` members are indexed once more: members of two such
    values may still differ in max_bits of their other bits, and are only
    compared where they agree on the key of a table of these bits."""
    if BITS % segments:
        raise ValueError("segments must divide 64")
    width, radius = BITS // segments, max_bits // segments
    mask = (1 << width) - 1
    cut = [F.struct(F.lit(s).alias("seg"), F.shiftrightunsigned("fp", s * width).bitwiseAND(F.lit(mask)).alias("value"))
           if width < 64 else F.struct(F.lit(0).alias("seg"), F.col("fp").alias("value")) for s in range(segments)]
    members = nodes.select("fp", F.explode(F.array(*cut)).alias("t")).select("t.seg", "t.value", "fp")
    sizes = checkpointed(members.groupBy("seg", "value").agg(F.count(F.lit(1)).alias("n")))
    ball = F.array(*[F.lit(m) for m in _balls(width, radius)])
    near = F.filter(F.transform(ball, lambda m: F.col("value").bitwiseXOR(m)), lambda w: w >= F.col("value"))
    probes = sizes.select("seg", "value", "n", F.explode(near).alias("other"))
    found = checkpointed(probes.join(sizes.select("seg", F.col("value").alias("other"), F.col("n").alias("n_b")), ["seg", "other"])
                         .where("other <> value or n > 1").select("seg", "value", "other", (F.greatest("n", "n_b") > block).alias("large")))
    small, large = (found.where(c).select("seg", "value", "other") for c in ("not large", "large"))

    def values(pairs: DataFrame) -> DataFrame:
        return pairs.select("seg", "value").unionAll(pairs.select("seg", F.col("other").alias("value"))).distinct()

    whole = members.join(values(small), ["seg", "value"])
    lists = whole.groupBy("seg", "value").agg(F.collect_list("fp").alias("fps"))  # at most a block each
    lists = checkpointed(lists)
    sides = (small.join(lists.select("seg", "value", F.col("fps").alias("left")), ["seg", "value"])
             .join(lists.select("seg", F.col("value").alias("other"), F.col("fps").alias("right")), ["seg", "other"]).select("left", "right"))
    if width < 64 and not large.isEmpty():
        sides = sides.unionAll(_blocks(_members_of_tables(members, values(large), segments, max_bits), large, block))
    elif width == 64:
        keyed = members.join(values(large), ["seg", "value"]).withColumn("part", F.lit(0)).withColumn("key", F.lit(0).cast("long"))
        sides = sides.unionAll(_blocks(keyed, large, block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = [], []
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                a, b = _forest(*(np.asarray(s.values).view(np.uint64) for s in (x, y)), max_bits)
                u.append(a.view(np.int64))
                v.append(b.view(np.int64))
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])

    return sides.mapInArrow(run, "u bigint, v bigint").distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS, segments: int = SEGMENTS, block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, hash, fp, root (the component's smallest
    fingerprint), component_id (the smallest doc_id that links reach, itself
    included; null if there is none but null ids).

    Null and empty texts and texts of white space have fingerprint 0 and link
    like any other. Rows of equal id or text are rows of their own. An empty
    table gives no rows.
    """
    found = checkpointed(fingerprints(docs, id_col=id_col, text_col=text_col, words=words))
    nodes = checkpointed(found.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes.select("fp"), max_bits=max_bits, segments=segments, block=block))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.join(least, "root").select("fp", "root", "component_id")
    return found.join(of, "fp").select("doc_id", "hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component, all columns: that of the
    smallest id (null ids last; of rows that share it the one of least text hash)."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    row = F.struct(F.col("doc_id").isNull().alias("null_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "hash")
    kept = found.groupBy("root").agg(F.min(row).alias("row")).select(F.col("row.null_id").alias("_null_id"), F.col("row.id").alias("_id"),
                                                                     F.col("row.hash").alias("_hash"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(whole.alias("_row"), F.col(id_col).isNull().alias("_null_id"),
                        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("_id"), _hash(text_col).alias("_hash"))
    same = Window.partitionBy("_null_id", "_id", "_hash").orderBy(F.xxhash64("_row"))
    one = keyed.join(kept, ["_null_id", "_id", "_hash"]).withColumn("_nth", F.row_number().over(same)).where("_nth = 1")
    return one.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", unsigned(F.col("fp")).alias("fingerprint"), "component_id")
