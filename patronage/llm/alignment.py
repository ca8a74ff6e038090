"""Cross-tokenizer alignment by merge-path partitioning.

Two tokenizers cut the same bytes at different places. Merging the ends of
their tokens shows which tokens overlap: between two neighbouring ends lies a
stretch of one A token and one B token. Where both end at once, a group of
tokens is complete.

The merge is cut into pieces of equal work. On diagonal d of the merge matrix
(d ends taken in all) a binary search finds how many of them are A's, so each
piece knows its part of both lists without the others. A piece emits its
overlaps and the places where both end; a pair of equal ends that lies across
the border of two pieces is seen by the later one, and groups are stitched from
the places in order. Documents of a block follow each other in one stream of
ends; their borders are ends of both.

How many documents hold a pair of linked ids is counted in Spark: a block gives
each of its pairs once with the number of its documents, the counts are joined
back to the blocks, and each document's links are valued by them.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.blocks import Numbers, by_block, each_block, narrow, pack_arrays, rows_of, unpack_arrays
from patronage.llm.byte_bpe import LONG_CHUNK, PLAIN, byte_bpe, byte_symbols, vocabulary
from patronage.llm.common import checkpointed, prepare, remove_path, scratch_path

PIECE = 1 << 15         # ends that a piece merges
BLOCK_BYTES = 1 << 20   # of text
BLOCK_DOCS = 20_000
ENCODED = pa.schema([("block", pa.int64()), ("data", pa.binary()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])
ALIGNED = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
           "groups_sha256 string, a_ids array<int>, b_ids array<int>, a_groups array<int>, b_groups array<int>")
_ARROW = pa.schema([("doc_id", pa.int64())] + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
                   + [("groups_sha256", pa.string())] + [(c, pa.list_(pa.int32())) for c in ("a_ids", "b_ids", "a_groups", "b_groups")])


# -- the merge ------------------------------------------------------------------
def diagonal(a: np.ndarray, b: np.ndarray, d: int) -> tuple[int, int]:
    """How many of the first ``d`` merged ends are of ``a`` and of ``b`` (of
    two equal ones, a's comes first)."""
    low, high = max(0, d - len(b)), min(d, len(a))
    while low < high:
        mid = (low + high) // 2
        if a[mid] <= b[d - mid - 1]:
            low = mid + 1
        else:
            high = mid
    return low, d - low


def merge_piece(a: np.ndarray, b: np.ndarray, start: tuple[int, int], stop: tuple[int, int]):
    """Merge a[i0:i1] and b[j0:j1]. Returns the links (place in a, place in b)
    whose stretch ends in the piece, and the places where both lists end."""
    (i0, j0), (i1, j1) = start, stop
    x, y = a[i0:i1], b[j0:j1]
    over_b = np.searchsorted(y, x, side="left") + j0  # the b token that an a end lies in
    under = np.searchsorted(x, y, side="left")        # the a token that a b end lies in
    both = np.zeros(len(y), bool)
    inside = under < len(x)
    both[inside] = x[under[inside]] == y[inside]
    common_a, common_b = under[both] + i0, np.flatnonzero(both) + j0
    if len(y) and i0 and a[i0 - 1] == y[0]:  # the piece before ended between two equal ends
        both[0] = True
        common_a, common_b = np.concatenate([[i0 - 1], common_a]), np.concatenate([[j0], common_b])
    alone = np.flatnonzero(~both)
    links = np.concatenate([np.arange(i0, i1), under[alone] + i0]), np.concatenate([over_b, alone + j0])
    return links, (common_a, common_b)


def merge_path(a: np.ndarray, b: np.ndarray, piece: int = PIECE):
    """Links and common ends of two ascending lists with equal last values, by
    independent pieces of ``piece`` ends: yields what :func:`merge_piece`
    returns for each."""
    total = len(a) + len(b)
    cuts = [diagonal(a, b, d) for d in range(0, total, piece)] + [(len(a), len(b))]
    for start, stop in zip(cuts, cuts[1:], strict=False):
        yield merge_piece(a, b, start, stop)


# -- the two tokenizers -----------------------------------------------------------
class Pair:
    """The byte-level tokenizer A and the piece tokenizer B of a worker."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        known = byte_bpe(path_a)
        self.path_a, self.plain_library = path_a, None
        self.ranked, self.lossless = known.fast, known.chunked
        back = {s: b for b, s in byte_symbols().items()}
        vocab = known.library.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = token.encode() if token in known.special else bytes(back[c] for c in token)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        p = self.pieces
        self.bytes_b = [bytes([int(p.id_to_piece(i)[1:-1], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode()
                        for i in range(p.get_piece_size())]
        self.length_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.length_b = np.array([len(t) for t in self.bytes_b], np.int64)
        size = max(len(self.bytes_a), len(self.bytes_b))
        marks = (b",", b"|", b";", b"")
        names = [str(i).encode() + m for i in range(size) for m in marks]
        self.names = np.frombuffer(b"".join(names), np.uint8)
        self.name_at = np.concatenate([[0], np.cumsum([len(n) for n in names])])

    def _ids_a(self, text: str) -> np.ndarray:
        if self.ranked is not None and PLAIN(text) and (len(text) <= LONG_CHUNK or max(map(len, text.split(" "))) <= LONG_CHUNK):
            return self.ranked.encode_to_numpy(text, disallowed_special=()).astype(np.int32)
        if self.plain_library is None:
            from tokenizers import Tokenizer

            self.plain_library = Tokenizer.from_file(self.path_a)
            self.plain_library.no_truncation()
            self.plain_library.no_padding()
            self.plain_library.encode_special_tokens = True
        return np.array(self.plain_library.encode(text, add_special_tokens=False).ids, np.int32)

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both; None if the text is empty or the tokens of one don't
        join to the text after a space."""
        if not text:
            return None
        raw = b" " + text.encode()
        b = self.pieces.encode(text)
        if b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return None
        a = self._ids_a(" " + text)
        # without a normalizer, tokens of all bytes join to the text
        if not self.lossless and b"".join(map(self.bytes_a.__getitem__, a.tolist())) != raw:
            return None
        return a, np.array(b, np.int32)

    def groups_text(self, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray) -> Iterator[bytes]:
        """``a1,a2|b1;a3|b2,b3`` in parts: ids of each group, which ends before
        place end_a of a and end_b of b."""
        start_a, start_b = np.concatenate([[0], end_a[:-1]]), np.concatenate([[0], end_b[:-1]])
        codes = np.empty(len(a) + len(b), np.int64)
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[end_a - 1], mark_b[end_b - 1], mark_b[-1] = 1, 2, 3
        codes[np.arange(len(a)) + np.repeat(start_b, end_a - start_a)] = a.astype(np.int64) * 4 + mark_a
        codes[np.arange(len(b)) + np.repeat(end_a, end_b - start_b)] = b.astype(np.int64) * 4 + mark_b
        for at in range(0, len(codes), 1 << 15):
            some = codes[at:at + (1 << 15)]
            start = self.name_at[some]
            length = self.name_at[some + 1] - start
            index = np.arange(int(length.sum())) + np.repeat(start - (np.cumsum(length) - length), length)
            yield self.names[index].tobytes()


_LOADED: dict[tuple[str, str], Pair] = {}


def pair(path_a: str, path_b: str) -> Pair:
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Pair(path_a, path_b)
    return _LOADED[path_a, path_b]


# -- blocks -----------------------------------------------------------------------
class _Stream:
    """The ends of a block's documents, one after another."""

    def __init__(self, both: Pair, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray):
        self.a, self.b = a, b
        self.docs = len(n_a)
        self.stop_a, self.stop_b = np.cumsum(n_a), np.cumsum(n_b)
        self.ends_a, self.ends_b = np.cumsum(both.length_a[a]), np.cumsum(both.length_b[b])

    def pieces(self, piece: int):
        """Per piece: links as (document, id of a, id of b), common ends as places."""
        for (i, j), common in merge_path(self.ends_a, self.ends_b, piece):
            yield np.searchsorted(self.stop_a, i, side="right"), self.a[i], self.b[j], common


def _encode_block(both: Pair, docs: list[tuple], number: int, piece: int) -> Iterator[pa.RecordBatch]:
    ids = [both.encode(text) for _, text in docs]
    n_a = np.array([0 if x is None else len(x[0]) for x in ids])
    n_b = np.array([0 if x is None else len(x[1]) for x in ids])
    a = np.concatenate([np.zeros(0, np.int32), *[x[0] for x in ids if x is not None]])
    b = np.concatenate([np.zeros(0, np.int32), *[x[1] for x in ids if x is not None]])
    stream = _Stream(both, a, b, n_a, n_b)
    width = len(both.bytes_b)
    size = len(both.bytes_a) * width
    keys, common_a, common_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for doc, x, y, (ca, cb) in stream.pieces(piece):
        keys.append(_distinct(doc * size + x.astype(np.int64) * width + y)[0])
        common_a.append(ca)
        common_b.append(cb)
    code, counts = _distinct(_distinct(np.concatenate(keys))[0] % size)  # documents that hold each pair
    data = pack_arrays(doc_id=np.array([d or 0 for d, _ in docs], np.int64), no_id=np.array([d is None for d, _ in docs], bool),
                       n_a=n_a, n_b=n_b, a=narrow(a), b=narrow(b), groups_a=narrow(np.diff(np.concatenate(common_a), prepend=-1)),
                       groups_b=narrow(np.diff(np.concatenate(common_b), prepend=-1)))
    yield from rows_of(number, ENCODED, data, a=(code // width).astype(np.int32), b=(code % width).astype(np.int32), n=counts.astype(np.int64))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and how often each occurs."""
    keys = np.sort(keys)
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    return keys[at], np.diff(at, append=len(keys))


def _valued(both: Pair, data: bytes, known: pa.Table, detail: bool, piece: int) -> Iterator[pa.RecordBatch]:
    x = unpack_arrays(data)
    width = len(both.bytes_b)
    stream = _Stream(both, x["a"], x["b"], x["n_a"], x["n_b"])
    code = known["a"].to_numpy().astype(np.int64) * width + known["b"].to_numpy()
    order = np.argsort(code)
    code, count, best = code[order], known["count"].to_numpy()[order], known["best"].to_numpy(zero_copy_only=False)[order]
    docs = stream.docs
    n_links, n_best, count_sum = (np.zeros(docs, np.int64) for _ in range(3))
    for doc, a, b, _ in stream.pieces(piece):
        at = np.searchsorted(code, a.astype(np.int64) * width + b)
        n_links += np.bincount(doc, minlength=docs)
        n_best += np.bincount(doc[best[at]], minlength=docs)
        np.add.at(count_sum, doc, count[at])
    end_a, end_b = np.cumsum(x["groups_a"], dtype=np.int64), np.cumsum(x["groups_b"], dtype=np.int64)
    group_stop = np.searchsorted(end_a, stream.stop_a, side="right")
    rows = []
    for k in range(docs):
        a0, b0, g0 = (stream.stop_a[k - 1], stream.stop_b[k - 1], group_stop[k - 1]) if k else (0, 0, 0)
        a1, b1, g1 = stream.stop_a[k], stream.stop_b[k], group_stop[k]
        a, b, ga, gb, sha = x["a"][a0:a1], x["b"][b0:b1], end_a[g0:g1] - a0, end_b[g0:g1] - b0, ""
        if len(a):
            digest = hashlib.sha256()
            for part in both.groups_text(a, b, ga, gb):
                digest.update(part)
            sha = digest.hexdigest()
        rows.append((None if x["no_id"][k] else int(x["doc_id"][k]), len(a), len(b), len(ga), int(n_links[k]), int(n_best[k]), int(count_sum[k]), sha,
                     *((a, b, ga.astype(np.int32), gb.astype(np.int32)) if detail else (None,) * 4)))
        if len(rows) >= 1024 or detail:
            yield _rows(rows)
            rows = []
    if rows:
        yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


def encoded(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path_a: str, path_b: str, piece: int = PIECE,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of documents (block, data; a, b, n null) and their linked id
    pairs with the block's documents that hold them (block, a, b, n)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, number, held, size = pair(path_a, path_b), Numbers(), [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.append((doc, text.as_py()))
                size += len(held[-1][1] or "")
                if size >= block_bytes or len(held) >= BLOCK_DOCS:
                    yield from _encode_block(both, held, number(), piece)
                    held, size = [], 0
        if held:
            yield from _encode_block(both, held, number(), piece)

    return (docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
            .mapInArrow(run, "block bigint, data binary, a int, b int, n bigint"))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """Of each linked pair of ids a, b: count (documents that hold it) and
    best (no other pair of the same a has a higher count)."""
    counts = blocks.where("n is not null").groupBy("a", "b").agg(F.sum("n").alias("count"))
    # one group holds at most as many rows as tokenizer B has ids
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("a")))


def align(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None,
          piece: int = PIECE, block_bytes: int = BLOCK_BYTES, detail: bool = True) -> DataFrame:
    """Align two tokenizers' tokens of every document.

    Returns doc_id, n_a, n_b (tokens), n_groups, n_links (overlapping pairs of
    tokens), n_best (links whose pair has the highest count among all pairs of
    its a, ties included), count_sum (of the links' counts), groups_sha256, and
    with ``detail`` a_ids, b_ids, a_groups, b_groups (tokens up to each group's
    end; else null).

    Texts that are null, empty, or that one tokenizer changes have no tokens:
    zeros, an empty sha. Null ids and repeated rows stay (each row is a document);
    further columns aren't read. An empty table gives no rows. The result is
    materialised."""
    spark = docs.sparkSession
    prepare(spark)
    path_a, path_b = path_a or vocabulary("byte_bpe_50k.json"), path_b or vocabulary("piece_bpe_32k.model")
    folder = scratch_path(spark, "alignment")
    try:
        encoded(docs, id_col=id_col, text_col=text_col, path_a=path_a, path_b=path_b, piece=piece, block_bytes=block_bytes).write.parquet(folder)
        blocks = spark.read.parquet(folder)
        known = blocks.where("n is not null").select("block", "a", "b").join(pair_counts(blocks), ["a", "b"])
        empty = F.lit(None)
        packed = blocks.where("data is not null").select("block", "data", *[empty.cast(t).alias(c) for c, t in
                                                                          (("a", "int"), ("b", "int"), ("count", "long"), ("best", "boolean"))])
        stream = by_block(packed.unionAll(known.select("block", empty.cast("binary").alias("data"), "a", "b", "count", "best")))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            both = pair(path_a, path_b)
            for _, data, rows in each_block(batches):
                yield from _valued(both, data, rows, detail, piece)

        return checkpointed(stream.mapInArrow(run, ALIGNED))
    finally:
        remove_path(spark, folder)


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
