"""The star schema as stored by the load jobs: lines beside their invoices.

``orders`` and ``order_items`` have the same layout: a folder per load, in it one per
invoice month, in it one file per bucket of invoices. Both have the same
number of buckets by the hash of ``invoice_no``, so they join, and lines are summed per
invoice, where they lie. The bucket columns are declared in the session's
catalog (a path alone doesn't tell them): :class:`StarStore` does it on reading.

``customers`` and ``products`` are small beside the lines and depend on all
loads; each load stores additive parts, from which the tables of all loads are
written anew. Beside the orders lies an index of their invoices
(:mod:`patronage.operators.key_index`), so a load meets the stored headers of its own invoices by
reading the few files that may hold them. A load counts once the manifest names it; the manifest is the last thing
written. Loads have an id: one that is there already isn't loaded again.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from patronage.operators import key_index
from patronage.operators.manifest import Manifests, path_of

FACTS = ("orders", "order_items")
PARTITIONS = ("load", "invoice_month")


class StarStore:
    """The stored tables under ``root`` (a folder that driver and executors share)."""

    def __init__(self, spark: SparkSession, root: str, database: str = "default"):
        self.spark, self.root, self.database = spark, root.rstrip("/"), database
        self.manifests = Manifests(spark, f"{self.root}/_loads")

    def manifest(self) -> tuple[int, dict]:
        number, found = self.manifests.latest()
        return number, found or {"loads": [], "buckets": 0, "items": 0, "tables": {}, "schemas": {}}

    # -- facts ------------------------------------------------------------------
    def write_fact(self, name: str, rows: DataFrame, load: str, buckets: int) -> dict:
        """Write one load's rows (with ``invoice_month``): one task, and in each
        month one file, per bucket. Returns the schema, for the manifest."""
        table = f"{self.database}.patronage_write_{uuid.uuid4().hex}"
        try:
            # repartition deals rows by the hash that buckets are made by
            # (creating a table replaces what lies in its folder: it is the load's own, new one)
            (rows.repartition(buckets, "invoice_no").write.format("parquet")
             .bucketBy(buckets, "invoice_no").sortBy("invoice_no").partitionBy("invoice_month")
             .option("path", f"{self.root}/{name}/load={load}").saveAsTable(table))
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # the declaration only: the table is external
        return json.loads(rows.drop("invoice_month").schema.json())

    def fact(self, name: str) -> DataFrame:
        """All committed loads of ``orders`` or ``order_items`` as a bucketed scan."""
        _, manifest = self.manifest()
        if not manifest["loads"]:
            raise ValueError(f"nothing is loaded at {self.root}")
        loads = [x["folder"] for x in manifest["loads"]]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(manifest["schemas"][name]).fields)
        table = f"{self.database}.patronage_{name}_{hashlib.sha256(self.root.encode()).hexdigest()[:16]}"
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        place = path_of(self.spark, f"{self.root}/{name}")
        self.spark.sql(f"CREATE TABLE {table} ({columns}, load string, invoice_month string) USING parquet PARTITIONED BY ({', '.join(PARTITIONS)}) "
                       f"CLUSTERED BY (invoice_no) SORTED BY (invoice_no) INTO {manifest['buckets']} BUCKETS "
                       f"LOCATION '{place[0].makeQualified(place[1]).toString()}'")
        self.spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        return self.spark.table(table).where(F.col("load").isin(loads)).drop("load")

    # -- stored invoices -------------------------------------------------------------
    def write_index(self, load: str, buckets: int) -> None:
        """Index the invoices of a load's headers, once they are written."""
        place = f"{self.root}/orders/load={load}"
        fs, p = path_of(self.spark, place)
        if not any(s.isDirectory() for s in fs.listStatus(p)):  # a load without new headers has no file
            return
        stored = self.spark.read.parquet(place).select(
            "invoice_no", F.substring_index(F.col("_metadata.file_path"), f"/load={load}/", -1).alias("file"))
        self.write_parts("orders_index", key_index.build(stored, "invoice_no", buckets), load)

    def order_files(self, invoices: DataFrame) -> list[str]:
        """The files of committed headers that may hold some of ``invoices``
        (column ``invoice_no``): at most as many as are stored."""
        _, manifest = self.manifest()
        keys = invoices.select(F.col("invoice_no").alias("key")).distinct()
        files = []
        for load in manifest["loads"]:
            place = f"{self.root}/orders/load={load['folder']}"
            fs, index = path_of(self.spark, f"{self.root}/orders_index/load={load['folder']}")
            if fs.exists(index):
                held = key_index.holders(self.spark.read.parquet(index.toString()), keys, manifest["buckets"])
                files += [f"{place}/{r['file']}" for r in held.select("file").distinct().collect()]
            elif not load.get("indexed"):  # stored before there were indexes
                files.append(place)
        return files

    def headers_of(self, invoices: DataFrame) -> DataFrame:
        """The committed headers of ``invoices`` (column ``invoice_no``, NULLs match
        none), read from the files that may hold them only."""
        _, manifest = self.manifest()
        schema = StructType.fromJson(manifest["schemas"]["orders"])
        files = self.order_files(invoices)
        if not files:
            return self.spark.createDataFrame([], schema)
        keys = invoices.select("invoice_no").distinct()
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*files).join(keys, "invoice_no", "left_semi")

    # -- small tables ---------------------------------------------------------------
    def write_parts(self, name: str, rows: DataFrame, load: str) -> None:
        rows.write.parquet(f"{self.root}/{name}/load={load}")

    def parts(self, name: str, loads: list[str]) -> DataFrame:
        """The parts of some loads; ``load`` is the loads' place in the list."""
        out = None
        for i, load in enumerate(loads):
            one = self.spark.read.parquet(f"{self.root}/{name}/load={load}").withColumn("load", F.lit(i))
            out = one if out is None else out.unionByName(one)
        return out

    def write_table(self, name: str, rows: DataFrame) -> str:
        """Write a table as a new version; the folder below the root."""
        folder = f"{name}/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{folder}")
        return folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{self.manifest()[1]['tables'][name]}")
