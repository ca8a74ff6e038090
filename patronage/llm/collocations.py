"""Phrase collocations by set-oriented mining (SETM).

The occurrence relation of phrases of length k, (place, phrase), is kept sorted
by place and stored. Each length takes three steps: the relation is merge-joined
with itself on adjacent places of the same piece, which gives the occurrences
of phrases one word longer; these are grouped and counted; and occurrences of
groups that aren't frequent are dropped by a semi-join, before the next
length is made from what is left.

Occurrences stay with their block of documents. A block numbers the phrases it
holds, so what Spark shuffles, counts and joins is one row per phrase and
block, and the semi-join comes back to a block as the identifiers of its
frequent phrases. A piece's places follow each other, and one place is left out
after it, so that adjacent places are always of one piece.

A phrase of k words is made of two of k - 1 words that overlap in all words but
the first and the last. It is known by these two, and inherits from them the
counts of all its beginnings and ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.blocks import CODE_BITS, Numbers, by_block, each_block, pack_arrays, rows_of, unpack_arrays
from patronage.llm.common import checkpointed, prepare, remove_path, scratch_path, short_lived_shuffles
from patronage.operators.rank import number_rows

NO_LANGUAGE = "und"
LEAST = 10             # occurrences of a candidate
LONGEST = 3            # words
COVERED = 50           # per cent of a phrase's occurrences that lie in one longer phrase
SCALE = 1_000_000
BLOCK_WORDS = 1 << 19
_BREAKS = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\x09", b"\n" * 10 + b" ")
WORDS = pa.schema([("block", pa.int64()), ("data", pa.binary()), ("code", pa.int32()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
PHRASES = pa.schema([("block", pa.int64()), ("data", pa.binary()), ("code", pa.int32()), ("left", pa.int64()), ("right", pa.int64()), ("n", pa.int64())])


_BREAK, _NOTHING = -1, -2  # codes of a piece's end and of the empty string between two spaces


class _Codes(dict):
    """Numbers of the words of one language in a block."""

    def __init__(self, names: list[bytes], owners: list[int], lang: str, number: int):
        super().__init__({b"\n": _BREAK, b"": _NOTHING})
        self.names, self.owners, self.lang, self.number, self.total = names, owners, lang, number, 0

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self.names)
        self.names.append(word)
        self.owners.append(self.number)
        return code


class _Block:
    """The first relation of a block under construction."""

    def __init__(self):
        self.names: list[bytes] = []
        self.owners: list[int] = []  # a word's language
        self.codes: dict[str, _Codes] = {}
        self.parts: list[np.ndarray] = []
        self.words = 0

    def add(self, text: str, lang: str) -> None:
        """A text's words. Its first word never follows the last one of the text before."""
        codes = self.codes.get(lang)
        if codes is None:
            codes = self.codes[lang] = _Codes(self.names, self.owners, lang, len(self.codes))
        tokens = text.encode().lower().translate(_BREAKS).replace(b"\n", b" \n ").split(b" ")
        tokens.append(b"\n")
        part = np.fromiter(map(codes.__getitem__, tokens), np.int32, len(tokens))
        words = int((part >= 0).sum())
        if words:
            self.parts.append(part[part != _NOTHING])
            self.words += words
            codes.total += words

    def relation(self) -> tuple[np.ndarray, np.ndarray]:
        """place (ascending) and code of every occurrence; a piece's end takes a place too."""
        codes = np.concatenate(self.parts)
        place = np.flatnonzero(codes >= 0)
        return place, codes[place]


def merge_join(place: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The relation joined with itself on adjacent places: place of the left
    row, left item, right item. Places are ascending and distinct, so a row's
    only partner is the next row."""
    hit = np.flatnonzero(place[1:] == place[:-1] + 1)
    return place[hit], item[hit], item[hit + 1]


def pack_relation(place: np.ndarray, item: np.ndarray) -> bytes:
    """A sorted relation: the places as steps from one to the next, and the items."""
    return pack_arrays(steps=np.diff(place, prepend=0).astype(np.int32), item=item.astype(np.int32))


def _first_pass(docs: DataFrame, text_col: str, lang_col: str, block_words: int) -> DataFrame:
    """Of each block: its packed relation, its words (code, lang, word, n), and
    for each language the number of all words (code and word are null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = Numbers(), _Block()

        def done():
            place, code = block.relation()
            counts, totals = np.bincount(code, minlength=len(block.names)), list(block.codes.values())
            codes = pa.concat_arrays([pa.array(np.arange(len(counts), dtype=np.int32)), pa.nulls(len(totals), pa.int32())])
            owners = pa.array(np.array(block.owners + [c.number for c in totals], np.int32))
            langs = pa.DictionaryArray.from_arrays(owners, pa.array([c.lang for c in totals], pa.string())).cast(pa.string())
            words = pa.concat_arrays([pa.array(block.names, pa.string()), pa.nulls(len(totals), pa.string())])
            yield from rows_of(number(), WORDS, pack_relation(place, code), code=codes, lang=langs, word=words,
                               n=np.append(counts, [c.total for c in totals]))

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                block.add(text.as_py() or "", lang)
                if block.words >= block_words:
                    yield from done()
                    block = _Block()
        if block.words:
            yield from done()

    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE))
    return (docs.select(F.col(text_col).cast("string").alias("text"), lang.alias("lang"))
            .mapInArrow(run, "block bigint, data binary, code int, lang string, word string, n bigint"))


def _longer(rows: DataFrame, last: bool) -> DataFrame:
    """Occurrences of phrases one word longer, from the stored relation and the
    identifiers of its frequent phrases (see :func:`_frequent`); occurrences of
    others are dropped first. The ``last`` relation isn't packed: nothing is made of it."""
    null = F.lit(None)
    packed = rows.where("data is not null").select("block", "data", null.cast("int").alias("code"), null.cast("long").alias("id"))
    known = rows.where("id is not null").select("block", null.cast("binary").alias("data"), "code", "id")
    stream = by_block(packed.unionAll(known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, data, found in each_block(batches):
            if not found.num_rows:
                continue
            x = unpack_arrays(data)
            place, item = np.cumsum(x["steps"], dtype=np.int64), x["item"]
            del x
            ids, codes = found["id"].to_numpy(), found["code"].to_numpy()
            dense = np.full(int(item.max()) + 1, -1, np.int64)
            dense[codes] = np.arange(len(ids))
            item = dense[item]
            place, item = place[item >= 0], item[item >= 0]  # the semi-join
            place, left, right = merge_join(place, item)
            if not len(place):
                continue
            pairs, code, counts = np.unique(left * len(ids) + right, return_inverse=True, return_counts=True)
            del item, left, right
            packed = None if last else pack_relation(place, code.astype(np.int32))
            yield from rows_of(block, PHRASES, packed, code=np.arange(len(pairs), dtype=np.int32),
                               left=ids[pairs // len(ids)], right=ids[pairs % len(ids)], n=counts)

    return stream.mapInArrow(run, "block bigint, data binary, code int, left bigint, right bigint, n bigint")


def _stored(df: DataFrame, folders: list[str], name: str) -> DataFrame:
    """Write a table in the scratch folder and read it."""
    spark = df.sparkSession
    folders.append(scratch_path(spark, name))
    df.write.parquet(folders[-1])
    return spark.read.parquet(folders[-1])


def _frequent(rows: DataFrame, key: list[str], least: int) -> DataFrame:
    """Group and count: of a block's phrases (block, code, key, n) those whose
    group has at least ``least`` occurrences, with id (the smallest block and code of
    the group, one number). The row of this block and code, the group's first, has f
    (the occurrences) and the key too. Packed rows pass through, and rows without a code with f.

    One shuffle by the key does both the counting and the semi-join. A group has one
    row for each block that holds it."""
    own = F.shiftleft("block", CODE_BITS).bitwiseOR(F.col("code").cast("long"))
    alike = Window.partitionBy(*key, "apart")
    # no more is shuffled than the key and one number that holds block and code
    slim = rows.select("data", *key, "n", own.alias("own"), F.when(F.col("data").isNotNull(), F.col("block")).alias("apart"))
    grouped = slim.select("*", F.sum("n").over(alike).alias("f"), F.min("own").over(alike).alias("id"))
    shown = F.col("own").isNull() | (F.col("own") == F.col("id"))
    return grouped.where((F.col("f") >= least) | F.col("own").isNull()).select(
        F.coalesce("apart", F.shiftright("own", CODE_BITS)).alias("block"), "data",
        F.col("own").bitwiseAND((1 << CODE_BITS) - 1).cast("int").alias("code"), "id",
        *[F.when(shown, F.col(c)).alias(c) for c in (*key, "f")])


def ratio(a: Column, left: Column, right: Column, scale: int = SCALE) -> Column:
    """floor(scale * a * a / (left * right)) in exact decimals (counts below 10^15)."""
    a, left, right = (c.cast("decimal(15,0)") for c in (a, left, right))
    return F.call_function("div", F.lit(scale).cast("decimal(7,0)") * (a * a), left * right)


def phrases(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
            block_words: int = BLOCK_WORDS, folders: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """The frequent phrases of each length (index 0: words), and the number of
    words of each language. Of a phrase: id, lang, phrase, last (its last
    word), f, left, right (ids of its first and last k - 1 words), heads, tails (counts of
    its first and last 1, 2, ... words). ``folders`` collects the scratch folders used."""
    counted = _stored(_frequent(_first_pass(docs, text_col, lang_col, block_words), ["word", "lang"], least), folders, "collocations-1")
    first = F.col("id").isNotNull() & F.col("f").isNotNull()  # one row of a group
    words = counted.where(first).select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f",
                                        F.array("f").alias("heads"), F.array("f").alias("tails"))
    sizes = counted.where("code is null and data is null").groupBy("lang").agg(F.max("f").alias("n"))
    out = [words]
    for k in range(2, longest + 1):
        longer = _longer(counted, last=k == longest)
        if k < longest:
            counted = _stored(_frequent(longer, ["left", "right"], least), folders, f"collocations-{k}")
            groups = counted.where(first).select("id", "left", "right", "f")
        else:  # nothing is made of these: they are only counted
            own = F.shiftleft("block", CODE_BITS).bitwiseOR(F.col("code").cast("long"))
            groups = (longer.groupBy("left", "right").agg(F.sum("n").alias("f"), F.min(own).alias("id")).where(F.col("f") >= least))
        before = out[-1].select(F.col("id").alias("left"), "lang", F.col("phrase").alias("begin"), F.col("heads").alias("before"))
        after = out[-1].select(F.col("id").alias("right"), "last", F.col("tails").alias("after"))
        made = groups.join(before, "left").join(after, "right").select(
            "id", "lang", F.concat_ws(" ", "begin", "last").alias("phrase"), "last", "f", "left", "right",
            F.concat("before", F.array("f")).alias("heads"), F.concat("after", F.array("f")).alias("tails"))
        out.append(_stored(made, folders, "collocations-groups"))
    return out, sizes


def mine(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
         covered: int = COVERED, top: int | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Collocations of 2 to ``longest`` words per language.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends,
    and these into words at spaces and tabs. Of each phrase with at least
    ``least`` occurrences: lang, rank, phrase, a (its occurrences within pieces), l, r
    (those of the two parts of its lowest-scoring cut), n (all words of the
    language), score floor(10^6 a a / (l r)). A phrase is left out if a longer
    one that holds it has at least ``covered`` per cent of its occurrences.
    ``rank`` orders a language by score, a (descending) and phrase; with ``top``
    only so many per language are returned (a report).

    Null and empty texts have no words, a null language counts as ``und``,
    repeated rows are documents of their own, ids and further columns aren't
    read; an empty table gives no rows. Counts are exact up to 10^15. The
    result is materialised."""
    spark = docs.sparkSession
    prepare(spark)
    if longest < 2:
        raise ValueError("collocations have two words at least")
    folders: list[str] = []
    with short_lived_shuffles(spark):
        try:
            return _mined(docs, text_col, lang_col, least, longest, covered, top, block_words, folders)
        finally:
            for folder in folders:
                remove_path(spark, folder)


def _mined(docs: DataFrame, text_col: str, lang_col: str, least: int, longest: int, covered: int, top: int | None, block_words: int,
           folders: list[str]) -> DataFrame:
    spark = docs.sparkSession
    levels, sizes = phrases(docs, text_col=text_col, lang_col=lang_col, least=least, longest=longest, block_words=block_words, folders=folders)
    kept = []
    for k in range(2, longest + 1):
        group = levels[k - 1]
        cuts = [F.struct(ratio(F.col("f"), F.col("heads")[i - 1], F.col("tails")[k - i - 1]).alias("score"), F.lit(i).alias("cut"),
                         F.col("heads")[i - 1].alias("l"), F.col("tails")[k - i - 1].alias("r")) for i in range(1, k)]
        scored = group.withColumn("best", F.array_min(F.array(*cuts)))
        if k < longest:
            # whatever longer phrase holds this one, one that is longer by one word has as many occurrences
            holders = (levels[k].select(F.explode(F.array("left", "right")).alias("id"), "f")
                       .groupBy("id").agg(F.max("f").alias("holder")))
            scored = scored.join(holders, "id", "left").where(F.col("holder").isNull() | (F.col("holder") * 100 < F.col("f") * covered))
        kept.append(scored.select("lang", "phrase", F.col("f").alias("a"), "best.l", "best.r", "best.score"))
    rows = kept[0]
    for more in kept[1:]:
        rows = rows.unionAll(more)
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    if top is not None:
        # the first ones of every share of a language, then of the language
        shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
        in_share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(shares))).orderBy(*order)
        rows = rows.withColumn("nth", F.row_number().over(in_share)).where(F.col("nth") <= top).drop("nth")
        ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    else:
        numbered = _stored(number_rows(rows, [F.col("lang"), order[0], order[1], F.col("phrase")], "nth"), folders, "collocations-ranks")
        starts = numbered.groupBy("lang").agg(F.min("nth").alias("start"))
        ranked = numbered.join(starts, "lang").withColumn("rank", F.col("nth") - F.col("start") + 1)
    return checkpointed(ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
