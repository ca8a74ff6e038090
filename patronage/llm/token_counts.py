"""Token counts: rollups by source, language and tokenizer version, kept up
to date by signed changes.

A change inserts a document's count, deletes it, or revises it (the old count
goes, the new one comes, perhaps under another key). Totals are sums, so a
batch of changes is reduced to one signed row per key, and the rollup is the
totals of earlier batches plus the batches since. Documents are never counted again.

A batch is a folder of the rollup. It counts once Spark's committer has marked
it complete; a batch committed before is left as it is, so a batch may be sent
again after any failure. :func:`fold` adds the batches at hand to the stored totals, under
a manifest that names them: from then on they count as part of those, and a reader
opens the totals and what came after, however many batches there ever were.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from patronage.llm.byte_bpe import ID_TYPE, byte_bpe, vocabulary
from patronage.llm.common import checkpointed, prepare, remove_path, scratch_path
from patronage.operators.manifest import Conflict, Manifests

KEYS = ["source", "lang", "tokenizer"]
TOTALS = "source string, lang string, tokenizer string, documents bigint, tokens bigint"


def insert(source: Column, lang: Column, tokenizer: Column, tokens: Column) -> Column:
    """Signed rows of a new count."""
    return F.array(_signed(source, lang, tokenizer, tokens, 1))


def delete(source: Column, lang: Column, tokenizer: Column, tokens: Column) -> Column:
    """Signed rows that take a count back."""
    return F.array(_signed(source, lang, tokenizer, tokens, -1))


def revise(old: tuple[Column, ...], new: tuple[Column, ...]) -> Column:
    """Signed rows that replace a count; old and new are (source, lang, tokenizer, tokens)."""
    return F.array(_signed(*old, -1), _signed(*new, 1))


def _signed(source: Column, lang: Column, tokenizer: Column, tokens: Column, sign: int) -> Column:
    return F.struct(source.cast("string").alias("source"), lang.cast("string").alias("lang"), tokenizer.cast("string").alias("tokenizer"),
                    F.lit(sign).cast("long").alias("documents"), (F.coalesce(tokens.cast("long"), F.lit(0)) * sign).alias("tokens"))


def _committed(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def commit(rows: DataFrame, changes: Column, rollup: str, batch: str) -> bool:
    """Add a batch to the rollup folder: ``changes`` gives each row's signed
    rows. Returns whether the batch was new. Null sources and languages are
    keys of their own; a null count counts as 0."""
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError("a batch name has letters, digits, '_', '.' and '-' only")
    spark, path = rows.sparkSession, f"{rollup.rstrip('/')}/batch-{batch}"
    if batch in _folded(spark, rollup)["batches"] or _committed(spark, path):
        return False
    signed = rows.select(F.inline(changes))
    delta = signed.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    delta.coalesce(1).write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(path)
    return True


def _manifests(spark: SparkSession, rollup: str) -> Manifests:
    return Manifests(spark, f"{rollup.rstrip('/')}/_totals")


def _folded(spark: SparkSession, rollup: str) -> dict:
    """The newest stored totals: their folder and the batches in them."""
    return _manifests(spark, rollup).latest()[1] or {"folder": None, "batches": []}


def _since(spark: SparkSession, rollup: str, folded: dict) -> list[str]:
    """Names of the committed batches that aren't in the totals."""
    root = spark._jvm.org.apache.hadoop.fs.Path(rollup)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in store.listStatus(root)] if store.exists(root) else []
    known = set(folded["batches"])
    found = [n.removeprefix("batch-") for n in names if n.startswith("batch-")]
    return sorted(n for n in found if n not in known and _committed(spark, f"{rollup.rstrip('/')}/batch-{n}"))


def _sum(spark: SparkSession, rollup: str, folded: dict, batches: list[str]) -> DataFrame:
    folders = [*([folded["folder"]] if folded["folder"] else []), *[f"batch-{b}" for b in batches]]
    if not folders:
        return spark.createDataFrame([], TOTALS)
    return (spark.read.schema(TOTALS).parquet(*[f"{rollup.rstrip('/')}/{f}" for f in folders]).groupBy(*KEYS)
            .agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).where("documents <> 0 or tokens <> 0"))


def totals(spark: SparkSession, rollup: str) -> DataFrame:
    """The rollup: source, lang, tokenizer, documents, tokens; keys without
    documents or tokens left are gone. Unfinished batches don't count."""
    folded = _folded(spark, rollup)
    return _sum(spark, rollup, folded, _since(spark, rollup, folded))


def fold(spark: SparkSession, rollup: str) -> list[str]:
    """Add the committed batches to the stored totals; returns their names. A run that fails
    leaves the totals as they are; of two at once the later one changes nothing. The
    folders of batches that the totals before these held already are deleted (readers of those
    totals don't open them any more), and their names are kept, so that none counts twice."""
    number, before = _manifests(spark, rollup).latest()
    before = before or {"folder": None, "batches": []}
    new = _since(spark, rollup, before)
    if not new:
        return []
    folder = f"totals-{uuid.uuid4().hex}"
    _sum(spark, rollup, before, new).coalesce(1).write.parquet(f"{rollup.rstrip('/')}/{folder}")
    try:
        _manifests(spark, rollup).commit(number + 1, {"folder": folder, "batches": [*before["batches"], *new]})
    except Conflict:
        remove_path(spark, f"{rollup.rstrip('/')}/{folder}")
        return []
    for old in before["batches"]:
        remove_path(spark, f"{rollup.rstrip('/')}/batch-{old}")
    return new


def with_tokens(docs: DataFrame, tokenizer: str, *, text_col: str = "text", out_col: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of each whole text (null: 0) under a tokenizer
    version: ``words-1``, ``words-2``, or a byte-level vocabulary file of the public
    tokenizers, by its name without ending (``byte_bpe_50k``). A column named ``out_col`` is replaced."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    if tokenizer in VERSIONS:
        return docs.withColumn(out_col, VERSIONS[tokenizer](text).cast("long"))
    prepare(docs.sparkSession)
    path, kept = vocabulary(f"{tokenizer}.json"), [c for c in docs.columns if c != out_col]
    frame = docs.select(*[f"`{c}`" for c in kept], text.alias("__text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(path)
        for batch in batches:
            counts = pa.array([len(encoder.encode(t)) // ID_TYPE.itemsize for t in batch["__text"].to_pylist()], pa.int64())
            columns = [batch[c] for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, counts], names=[*kept, out_col])

    schema = StructType([*[f for f in frame.schema.fields if f.name != "__text"], StructField(out_col, LongType())])
    return frame.mapInArrow(count, schema)


def words(text: Column) -> Column:
    """Version ``words-1``: runs of characters other than white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def words_and_stops(text: Column) -> Column:
    """Version ``words-2``: as words-1, and each of .,;:!? counts too."""
    return words(text) + F.regexp_count(text, F.lit("[.,;:!?]"))


VERSIONS = {"words-1": words, "words-2": words_and_stops}


def corpus_history(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   source_col: str = "source", revised_lang: str = "en") -> DataFrame:
    """Token counts of a corpus after three batches: all documents come in
    under words-1; of equal texts all but the one of smallest id go; what is
    left in ``revised_lang`` is counted again under words-2. Each batch is sent
    twice, the second time after the totals hold it. Null texts count as empty, null ids as the largest."""
    spark = docs.sparkSession
    prepare(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = checkpointed(docs.select(
        F.struct(F.col(id_col).isNull().alias("null_id"), F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row")).alias("row"),
        F.col(source_col).cast("string").alias("source"), F.col(lang_col).cast("string").alias("lang"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("hash"), words(text).alias("n1"), words_and_stops(text).alias("n2")))
    first = checkpointed(rows.groupBy("hash").agg(F.min("row").alias("kept")))  # apart, so that the join can split a hot text
    judged = checkpointed(rows.join(first, "hash").select("source", "lang", "n1", "n2", (F.col("row") == F.col("kept")).alias("kept")))
    one = F.col("source"), F.col("lang"), F.lit("words-1"), F.col("n1")
    two = F.col("source"), F.col("lang"), F.lit("words-2"), F.col("n2")
    rollup = scratch_path(spark, "token-counts")
    for _ in range(2):
        commit(judged, insert(*one), rollup, "1-load")
        commit(judged.where("not kept"), delete(*one), rollup, "2-equal-texts")
        commit(judged.where(F.col("kept") & (F.col("lang") == revised_lang)), revise(one, two), rollup, "3-words-2")
        fold(spark, rollup)
    out = checkpointed(totals(spark, rollup))
    remove_path(spark, rollup)
    return out
