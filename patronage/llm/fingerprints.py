"""Document fingerprints: SimHash by weighted votes, and a search for all
fingerprints within a Hamming radius. DataFrame functions only.

A term is a word with the word after it, its weight the length of the word.
Each term's hash votes for the signs of the 128 fingerprint bits. The votes
for two bit positions are summed at once, in the halves of a 64-bit number;
sums of a document stay under 2^32 as its length does.

The search cuts fingerprints into blocks. If two differ in at most r of b
blocks' bits, b - r blocks are equal; so for each choice of b - r blocks there is
a table by those blocks, permuted to the front. Equal entries are candidates,
and their whole distance is checked.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.common import checkpointed, prepare, unsigned

BITS = 128
_PAIR = 0x0000000100000001


def votes(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Fingerprints of texts: keys, hi, lo (two bigints of 64 bits each).
    ``keys`` must tell the rows apart; texts without a word have zeros."""
    words = texts.select(*keys, F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "").alias("words"))
    terms = words.select(*keys, F.inline_outer(F.expr(
        "transform(words, (w, i) -> named_struct('hash', xxhash64(w, get(words, i + 1)), 'weight', length(w)))")))
    terms = terms.select(*keys, F.col("weight").cast("long"), F.col("hash").alias("h0"), F.xxhash64("hash").alias("h1"))
    sums = [F.expr(f"sum((shiftrightunsigned({h}, {j}) & {_PAIR}L) * weight)").alias(f"{h}_{j}")
            for h in ("h0", "h1") for j in range(32)]
    summed = terms.groupBy(*keys).agg(F.sum("weight").alias("total"), *sums)
    checked = F.expr(f"if(total >= {1 << 32}L, raise_error('a text is too long for its votes'), 0L)")

    def half(h: str) -> Column:
        bits = [f"if(({h}_{j} & {0xFFFFFFFF}L) * 2 > total, shiftleft(1L, {j}), 0L)" for j in range(32)]
        bits += [f"if(shiftrightunsigned({h}_{j}, 32) * 2 > total, shiftleft(1L, {j + 32}), 0L)" for j in range(32)]
        return F.expr(" | ".join(bits))

    return summed.select(*keys, half("h0").bitwiseOR(checked).alias("hi"), half("h1").alias("lo"))


def likeness(hi: Column, lo: Column, other_hi: Column, other_lo: Column) -> Column:
    """Share of equal bits."""
    return 1 - (F.bit_count(hi.bitwiseXOR(other_hi)) + F.bit_count(lo.bitwiseXOR(other_lo))) / F.lit(float(BITS))


def successors(ids: DataFrame, partitions: int | None = None) -> DataFrame:
    """``ids``: null_id, id (distinct), most. For each, the id after it in
    ascending order (after the last: the first) and the ``most`` of the id
    before it: null_id, id, next_null, next_id, before_null, before_id, before_most.

    Ranges of ids are ordered apart; their ends (a row per range) are joined up.
    """
    width = partitions or int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = checkpointed(ids.withColumn("order_null", ~F.col("null_id")).repartitionByRange(width, "order_null", "id")
                          .withColumn("range", F.spark_partition_id()))
    one = F.struct("null_id", "id", "most")
    order = F.struct("order_null", "id")
    ends = ranged.groupBy("range").agg(F.min_by(one, order).alias("low"), F.max_by(one, order).alias("high"))
    across, whole = Window.orderBy("range"), Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("range", F.coalesce(F.lead("low").over(across), F.first("low").over(whole)).alias("after"),
                       F.coalesce(F.lag("high").over(across), F.last("high").over(whole)).alias("ahead"))
    inside = Window.partitionBy("range").orderBy("order_null", "id")
    out = (ranged.withColumn("n", F.lead(one).over(inside)).withColumn("p", F.lag(one).over(inside))
           .join(ends, "range").withColumn("n", F.coalesce("n", "after")).withColumn("p", F.coalesce("p", "ahead")))
    return out.select("null_id", "id", F.col("n.null_id").alias("next_null"), F.col("n.id").alias("next_id"),
                      F.col("p.null_id").alias("before_null"), F.col("p.id").alias("before_id"), F.col("p.most").alias("before_most"))


def edited(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with its edited text: the last floor(n/2) code points
    replaced by the first as many (or all) of the next document's.

    Returns null_id, id, text, edited, next_null, next_id; partitioned by
    (null_id, id). A null text counts as empty. Null ids count as one id before
    all others. If rows share an id, each is a document, and the one whose text
    comes first stands for the id as a next document.
    """
    rows = docs.select(F.col(id_col).isNull().alias("null_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ids = rows.groupBy("null_id", "id").agg(F.max(F.length("text")).alias("most"))
    order = checkpointed(successors(ids))
    ordered = rows.join(order.hint("merge"), ["null_id", "id"])
    ordered = ordered.withColumn("nth", F.row_number().over(Window.partitionBy("null_id", "id").orderBy("text")))
    lent = (ordered.where("nth = 1")
            .select(F.col("before_null").alias("null_id"), F.col("before_id").alias("id"),
                    F.expr("substring(text, 1, cast(before_most div 2 as int))").alias("lent")))
    return ordered.join(lent.hint("merge"), ["null_id", "id"]).select(
        "null_id", "id", "nth", "text", "next_null", "next_id",
        F.expr("concat(substring(text, 1, cast(length(text) - length(text) div 2 as int)), "
               "substring(lent, 1, cast(length(text) div 2 as int)))").alias("edited"))


def fingerprint_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of all documents and of their edited texts: doc_id,
    n_chars, edited_sha256, hi, lo, edited_hi, edited_lo, near_edited,
    near_next. One row per input row; further columns aren't read. Cases of
    nulls and shared ids as in :func:`edited`. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    rows = edited(docs, id_col=id_col, text_col=text_col)
    row = ["null_id", "id", "nth", "next_null", "next_id", "n_chars", "sha"]
    both = rows.select(*row[:5], F.length("text").cast("long").alias("n_chars"),
                       F.unhex(F.sha2(F.col("edited").cast("binary"), 256)).alias("sha"),
                       F.inline(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("words_of")),
                                        F.struct(F.lit(1).alias("kind"), F.col("edited").alias("words_of")))))
    found = votes(both, [*row, "kind"], "words_of")
    of = lambda kind, half: F.max(F.when(F.col("kind") == kind, F.col(half)))
    found = checkpointed(found.groupBy(*row).agg(of(0, "hi").alias("hi"), of(0, "lo").alias("lo"),
                                                 of(1, "hi").alias("edited_hi"), of(1, "lo").alias("edited_lo")))
    following = found.where("nth = 1").select(F.col("null_id").alias("next_null"), F.col("id").alias("next_id"),
                                              F.col("hi").alias("next_hi"), F.col("lo").alias("next_lo"))
    return found.join(following, ["next_null", "next_id"]).select(
        F.when(~F.col("null_id"), F.col("id")).alias("doc_id"), "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"),
        "hi", "lo", "edited_hi", "edited_lo",
        likeness(F.col("hi"), F.col("lo"), F.col("edited_hi"), F.col("edited_lo")).alias("near_edited"),
        likeness(F.col("hi"), F.col("lo"), F.col("next_hi"), F.col("next_lo")).alias("near_next"))


def digest(rows: DataFrame) -> DataFrame:
    shown = lambda a, b: F.concat(unsigned(F.col(a)), unsigned(F.col(b)))
    return rows.select("doc_id", "n_chars", "edited_sha256", shown("hi", "lo").alias("fingerprint"),
                       shown("edited_hi", "edited_lo").alias("edited_fingerprint"), "near_edited", "near_next")


def near(queries: DataFrame, table: DataFrame, radius: int, blocks: int | None = None) -> DataFrame:
    """All (query, fingerprint) within ``radius`` bits by permuted block tables.

    Both frames: hi, lo, distinct. Returns hi, lo of the query, other_hi,
    other_lo, distance. ``blocks`` (default radius + 2) are contiguous bits of
    the 128; there is one table for each choice of blocks - radius of them.
    """
    blocks = blocks or radius + 2
    if not radius < blocks <= BITS:
        raise ValueError("more blocks than the radius are needed")
    edges = [BITS * i // blocks for i in range(blocks + 1)]

    def masks(chosen) -> tuple[int, int]:
        whole = sum(1 << bit for b in chosen for bit in range(edges[b], edges[b + 1]))
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        return signed(whole >> 64), signed(whole & (1 << 64) - 1)

    entries = F.array(*[F.struct(F.lit(i).alias("table"), F.col("hi").bitwiseAND(F.lit(m[0])).alias("key_hi"),
                                 F.col("lo").bitwiseAND(F.lit(m[1])).alias("key_lo"))
                        for i, m in enumerate(map(masks, itertools.combinations(range(blocks), blocks - radius)))])
    asked = queries.select("hi", "lo", F.inline(entries))
    kept = table.select("hi", "lo", F.inline(entries)).withColumnsRenamed({"hi": "other_hi", "lo": "other_lo"})
    distance = F.bit_count(F.col("hi").bitwiseXOR(F.col("other_hi"))) + F.bit_count(F.col("lo").bitwiseXOR(F.col("other_lo")))
    return (asked.join(kept, ["table", "key_hi", "key_lo"]).withColumn("distance", distance)
            .where(F.col("distance") <= radius).select("hi", "lo", "other_hi", "other_lo", "distance").distinct())
