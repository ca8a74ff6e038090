"""An index of the keys in stored files: per file the least and greatest key and a
Bloom filter, so that keys are looked up in the few files that may hold them.

The filter is blocked: a key's hash picks one segment of 32,768 bits and sets
``PROBES`` bits of it, so a key meets one row of the index per file. Segments are
``bitmap_construct_agg`` bitmaps, about 16 bits a key. Files of a table that is bucketed by
the key only meet keys of their own bucket.

An index only says "may hold" or "doesn't hold"; :func:`holders` is followed by reading
the files it names, which makes every answer exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENT = 32_768   # bits of one bitmap
KEYS_A_SEGMENT = 2_048  # 16 bits a key
PROBES = 4
COLUMNS = ("file", "bucket", "segments", "segment", "least", "greatest", "bits")


def _bucket(key: Column, buckets: int) -> Column:
    """The number of the bucket that Spark stores a key in."""
    return F.pmod(F.hash(key), F.lit(buckets))


def _segment(key: Column, segments: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), segments)


def _probe(key: Column, i: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(i + 1)), F.lit(SEGMENT))


def build(rows: DataFrame, key: str, buckets: int = 1) -> DataFrame:
    """The index of stored rows: ``rows`` has a column ``file`` (its name) beside the
    key. A file's keys all lie in one of ``buckets`` buckets. NULL keys aren't
    indexed. One row per file and segment in use; a key that many rows share is
    reduced to one row a task first."""
    keys = rows.where(F.col(key).isNotNull()).groupBy("file", F.col(key).alias("key")).agg(F.lit(1).alias("one"))
    of_file = keys.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("least"), F.max("key").alias("greatest"))
    # a power of two, so that all files together have few different numbers of segments
    size = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("n") / KEYS_A_SEGMENT)))).cast("long")
    bits = (keys.join(of_file.select("file", size.alias("segments"), "least", "greatest"), "file")
            .withColumn("bucket", _bucket(F.col("key"), buckets)).withColumn("segment", _segment(F.col("key"), F.col("segments")))
            .withColumn("bit", F.explode(F.array(*[_probe(F.col("key"), i) for i in range(PROBES)]))))
    return (bits.groupBy("file", "bucket", "segments", "segment", "least", "greatest")
            .agg(F.bitmap_construct_agg("bit").alias("bits")).select(*COLUMNS))


def _is_set(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def holders(index: DataFrame, keys: DataFrame, buckets: int = 1) -> DataFrame:
    """file, key: the files that may hold each key of ``keys`` (column ``key``,
    distinct; NULLs are held by no file). A file that holds a key is always among them."""
    sizes = [r["segments"] for r in index.select("segments").distinct().collect()]  # powers of two: at most 63
    if not sizes:
        return keys.select(F.lit("").alias("file"), "key").limit(0)
    asked = (keys.where(F.col("key").isNotNull())
             .withColumn("segments", F.explode(F.array(*[F.lit(s).cast("long") for s in sizes])))
             .withColumn("bucket", _bucket(F.col("key"), buckets)).withColumn("segment", _segment(F.col("key"), F.col("segments"))))
    met = asked.join(index, ["bucket", "segments", "segment"]).where("key BETWEEN least AND greatest")
    for i in range(PROBES):
        met = met.where(_is_set(F.col("bits"), _probe(F.col("key"), i)))
    return met.select("file", "key")
