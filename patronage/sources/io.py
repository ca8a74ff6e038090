"""Sources and sinks: raw CSV ingest, staging load, table writes, CSV
exports and JDBC. Connection options always come from the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.functions.keys import normalize_key
from patronage.operators.rank import checkpointed, number_rows
from patronage.sources.csv_records import read_records

RAW_CSV_SCHEMA = T.StructType([
    T.StructField("InvoiceNo", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.IntegerType()),
    T.StructField("InvoiceDate", T.StringType()),
    T.StructField("UnitPrice", T.DecimalType(10, 4)),
    T.StructField("CustomerID", T.StringType()),
    T.StructField("Country", T.StringType()),
])

MASTER_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("first_purchase_date", T.DateType()),
    T.StructField("last_purchase_date", T.DateType()),
    T.StructField("rfm_segment", T.StringType()),
    T.StructField("r_score", T.IntegerType()),
    T.StructField("f_score", T.IntegerType()),
    T.StructField("m_score", T.IntegerType()),
    T.StructField("rfm_score", T.IntegerType()),
    T.StructField("recency_days", T.IntegerType()),
    T.StructField("frequency", T.IntegerType()),
    T.StructField("monetary", T.DecimalType(18, 2)),
    T.StructField("avg_order_value", T.DoubleType()),
    T.StructField("purchase_freq_monthly", T.DoubleType()),
    T.StructField("gross_margin_pct", T.DoubleType()),
    T.StructField("churn_rate", T.DoubleType()),
    T.StructField("clv_12m", T.DoubleType()),
    T.StructField("clv_36m", T.DoubleType()),
    T.StructField("clv_segment", T.StringType()),
])


#: Quotes are doubled inside quoted fields, as other writers and readers of CSV do it.
QUOTING = {"quote": '"', "escape": '"'}
SPLITS = 200_000  # input splits up to which their counts are broadcast


def read_raw_csv(spark: SparkSession, path: str, timestamp_format: str = "M/d/yyyy H:mm",
                 encoding: str = "ISO-8859-1", normalize_keys: bool = False, multi_line: bool = False) -> DataFrame:
    """S-01: raw invoice-line CSV with an explicit schema. Codes stay strings;
    unparseable timestamps become NULL instead of failing the job, and a row
    with a bad number keeps its text in ``_corrupt_record`` (NULL for good rows),
    so that it can be told from a row whose number is missing. Quotes inside a quoted
    field are doubled, a backslash is itself. Fields that hold line ends need
    ``multi_line``: files are still split, at the price of a first job that reads them all, and
    the result has a further column ``_seq``, their order (:mod:`patronage.sources.csv_records`).
    ``normalize_keys`` trims and upper-cases StockCode (case-insensitive keys)."""
    schema = T.StructType([*RAW_CSV_SCHEMA.fields, T.StructField("_corrupt_record", T.StringType())])
    options = {**QUOTING, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    if multi_line:
        # line ends inside a field stay as they are
        fields = F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), {**options, "multiLine": "true"})
        df = read_records(spark, path, encoding).select(fields.alias("_row"), "_seq").select("_row.*", "_seq")
    else:
        df = spark.read.schema(schema).options(header=True, encoding=encoding, **options).csv(path)
    ts = F.try_to_timestamp(F.col("InvoiceDate"), F.lit(timestamp_format)).cast("timestamp_ntz")
    df = df.withColumn("InvoiceDate", ts)
    if normalize_keys:
        df = df.withColumn("StockCode", normalize_key("StockCode"))
    return df


def with_file_order(df: DataFrame) -> DataFrame:
    """Add ``_seq``: a key that orders rows as they appear in their files
    (file path, split offset, position within the split)."""
    return df.withColumn("_seq", F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id()))


def stage_raw(df: DataFrame) -> DataFrame:
    """S-02: consecutive surrogate ``id`` from 1.

    Rows as read from files are numbered where they are, in file order (path,
    split offset, place in the split): the rows of each input split are counted, a
    running sum over the splits (one number each) gives the ids before a split, and a
    row adds its place in it. No row is shuffled, and a task that runs again gives
    its rows the same ids. Rows with a ``_seq`` are numbered in its order; without a shuffle, too,
    if it holds places in splits, as that of CSV records does."""
    if "_seq" in df.columns and df.schema["_seq"].dataType.names == ["file", "block", "place"]:
        splits = checkpointed(df.groupBy("_seq.file", "_seq.block").agg((F.max("_seq.place") + 1).alias("_rows")))
        earlier = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
        starts = splits.select(F.struct("file", "block").alias("_split"), (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) + 1).alias("_start"))
        if splits.count() <= SPLITS:
            starts = F.broadcast(starts)
        placed = df.withColumn("_split", F.struct("_seq.file", "_seq.block")).join(starts, "_split")
        return placed.select((F.col("_start") + F.col("_seq.place")).alias("id"), *[c for c in df.columns if c != "_seq"])
    if "_seq" in df.columns:
        return number_rows(checkpointed(df), [F.col("_seq")], "id").select("id", *[c for c in df.columns if c != "_seq"])
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_at"))
    splits = checkpointed(placed.groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")))
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    starts = splits.select("_file", "_block", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_start"))
    if splits.count() <= SPLITS:
        starts = F.broadcast(starts)
    return placed.join(starts, ["_file", "_block"]).select((F.col("_at") + F.col("_start")).alias("id"), *df.columns)


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] | None = None) -> None:
    """S-05 / S-06: append or replace a Parquet table (optionally partitioned,
    e.g. facts by invoice month for partition pruning)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def export_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None,
               single_file: bool = False) -> None:
    """S-07: CSV export with header and a fixed column order. ``single_file``
    is for bounded summary tables only; facts are written multi-part."""
    out = df.select(*columns) if columns else df
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).options(**QUOTING, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def read_master_csv(spark: SparkSession, path: str) -> DataFrame:
    """S-04: the customer master export, read back with its explicit schema."""
    return spark.read.schema(MASTER_SCHEMA).option("header", True).options(**QUOTING).csv(path)


def read_jdbc(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, properties: dict | None = None) -> DataFrame:
    """S-03: table scan over JDBC, split into parallel range reads when a
    numeric partition column is given."""
    props = dict(properties or {})
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, table, properties=props)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 5000,
               properties: dict | None = None) -> None:
    """S-05: chunked multi-row inserts over JDBC (one connection per task)."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batchsize))
    df.write.mode(mode).jdbc(url, table, properties=props)
