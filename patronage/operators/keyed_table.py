"""A Parquet table with a primary key: merges rewrite only the buckets they touch.

Rows are dealt into a fixed number of buckets by the hash of their key. A version
of the table is a manifest that names the folder of each bucket. A merge
reads the buckets that hold updated keys, writes them anew, and commits a
manifest that refers to the new folders and, for all other buckets, to the old
ones. Nothing is overwritten: readers of an older version go on, and a run that
fails leaves at most folders that no manifest names (:meth:`KeyedTable.vacuum`).

Two writers can't both commit a version. The one that is late takes the other's
version as its base: if that changed none of its buckets, its files stand and only the
manifest is written again, otherwise the merge is repeated.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from patronage.operators.manifest import Conflict, Manifests, delete, path_of
from patronage.operators.rank import checkpointed
from patronage.operators.upsert import last_per_key, require_unique

BUCKETS = 64   # of a new table
ATTEMPTS = 10  # of a commit


class KeyedTable:
    """The table under ``root`` (a folder that driver and executors share)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.manifests = Manifests(spark, f"{self.root}/_versions")

    # -- reading --------------------------------------------------------------
    @property
    def version(self) -> int:
        """The newest version; 0 if the table doesn't exist."""
        return max(self.manifests.numbers(), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version (default: the newest)."""
        manifest = self.manifests.read(version) if version else self.manifests.latest()[1]
        if manifest is None:
            raise ValueError(f"no table at {self.root}")
        return self._rows(manifest, manifest["buckets"])

    def folders(self, version: int | None = None) -> dict[int, str]:
        """Folder of each bucket that has rows."""
        manifest = self.manifests.read(version) if version else self.manifests.latest()[1]
        return {int(b): f"{self.root}/{p}" for b, p in manifest["buckets"].items()} if manifest else {}

    def _rows(self, manifest: dict, buckets: Iterable[str]) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        paths = sorted(f"{self.root}/{manifest['buckets'][b]}" for b in buckets)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # -- writing --------------------------------------------------------------
    def replace(self, rows: DataFrame, key: Sequence[str], *, order: Sequence[str] = (), buckets: int = BUCKETS,
                batch: tuple[str, int] | None = None) -> int:
        """Make ``rows`` the whole table, as a new version of the same root.
        ``order``: columns that say which of two rows of a key is newer."""
        rows = self._checked(rows, list(key), list(order), "the table")
        for _ in range(ATTEMPTS):
            number, old = self.manifests.latest()
            if old and self._seen(old, batch):
                return number
            made = self._write(rows, list(key), buckets)
            new = {"schema": json.loads(rows.schema.json()), "key": list(key), "order": list(order), "count": buckets, "buckets": made,
                   "batches": {**(old or {}).get("batches", {}), **({batch[0]: batch[1]} if batch else {})}}
            try:
                self.manifests.commit(number + 1, new)
                return number + 1
            except Conflict:
                continue
        raise Conflict(f"{self.root}: other writers were faster {ATTEMPTS} times")

    def merge(self, updates: DataFrame, key: Sequence[str], *, update_cols: Sequence[str] | None = None, order: Sequence[str] = (),
              buckets: int = BUCKETS, batch: tuple[str, int] | None = None) -> int:
        """Upsert ``updates`` by ``key``; returns the version that holds them.

        A matching row takes ``update_cols`` (default: all columns of the
        updates) and keeps its other columns; a new key is inserted (columns it lacks are
        NULL). With ``order``, of several updates of a key the last counts, and an
        update older than the stored row doesn't change it; without it, several
        updates of a key are an error. NULL keys are an error.

        ``batch`` (source, number): numbers of a source ascend; a batch that
        isn't beyond the last one merged is skipped, so it may be sent again.
        The first merge creates the table."""
        key, order = list(key), list(order)
        updates = self._checked(updates, key, order, "the update")
        written: dict | None = None
        for _ in range(ATTEMPTS):
            number, base = self.manifests.latest()
            if base is None:
                return self.replace(updates, key, order=order, buckets=buckets, batch=batch)
            if self._seen(base, batch):
                return number
            if base["key"] != key:
                raise ValueError(f"the table's key is {base['key']}")
            if written is None or any(base["buckets"].get(b) != written["from"].get(b) for b in written["touched"]) \
                    or base["schema"] != written["schema"] or base["count"] != written["count"]:
                written = self._merge_buckets(base, updates, update_cols, order)
            new = {**base, "order": order or base["order"], "buckets": {**base["buckets"], **written["made"]},
                   "batches": {**base["batches"], **({batch[0]: batch[1]} if batch else {})}}
            try:
                self.manifests.commit(number + 1, new)
                return number + 1
            except Conflict:
                continue
        raise Conflict(f"{self.root}: other writers were faster {ATTEMPTS} times")

    def _merge_buckets(self, base: dict, updates: DataFrame, update_cols: Sequence[str] | None, order: list[str]) -> dict:
        schema, key, count = StructType.fromJson(base["schema"]), base["key"], base["count"]
        cols = [c for c in (update_cols or updates.columns) if c not in key]
        unknown = [c for c in cols if c not in schema.names]
        if unknown:
            raise ValueError(f"the table has no columns {unknown}")
        typed = updates.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in dict.fromkeys([*key, *cols, *[c for c in order if c in updates.columns]])])
        touched = sorted(r[0] for r in typed.select(_bucket(key, count)).distinct().collect())  # at most ``count``
        known = [str(b) for b in touched if str(b) in base["buckets"]]
        merged = _merged(self._rows(base, known), typed, key, cols, [c for c in order or base["order"] if c in typed.columns])
        return {"made": self._write(merged, key, count), "touched": [str(b) for b in touched], "from": dict(base["buckets"]),
                "schema": base["schema"], "count": count}

    def _checked(self, rows: DataFrame, key: list[str], order: list[str], what: str) -> DataFrame:
        """The rows, materialised once, with one row per key and no NULL in it."""
        rows = checkpointed(last_per_key(rows, key, order) if order else rows)
        null = F.lit(False)
        for c in key:
            null = null | F.col(c).isNull()
        if rows.where(null).limit(1).count():
            raise ValueError(f"{what} has rows whose key {key} is NULL")
        if not order:
            require_unique(rows, key, what)
        return rows

    @staticmethod
    def _seen(manifest: dict, batch: tuple[str, int] | None) -> bool:
        return batch is not None and manifest["batches"].get(batch[0], -1) >= batch[1]

    def _write(self, rows: DataFrame, key: list[str], count: int) -> dict[str, str]:
        """Write rows by bucket under a new folder; bucket -> folder below the root."""
        folder = f"data/{uuid.uuid4().hex}"
        (rows.withColumn("_bucket", _bucket(key, count)).repartition("_bucket").sortWithinPartitions("_bucket", *key)
         .write.partitionBy("_bucket").parquet(f"{self.root}/{folder}"))
        fs, p = path_of(self.spark, f"{self.root}/{folder}")
        names = (s.getPath().getName() for s in fs.listStatus(p))
        return {n.partition("=")[2]: f"{folder}/{n}" for n in names if n.startswith("_bucket=")}

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete versions older than the newest ``keep`` and every data folder that
        none of those names: also what failed or late runs left. Run it while nobody
        merges. Returns the deleted data folders."""
        numbers = self.manifests.numbers()
        used = {p for n in numbers[-keep:] for p in self.manifests.read(n)["buckets"].values()}
        for n in numbers[:-keep]:
            self.manifests.forget(n)
        fs, data = path_of(self.spark, f"{self.root}/data")
        gone = []
        for run in fs.listStatus(data) if fs.exists(data) else []:
            run_name = f"data/{run.getPath().getName()}"
            for s in fs.listStatus(run.getPath()):
                name = f"{run_name}/{s.getPath().getName()}"
                if s.isDirectory() and name not in used:
                    delete(self.spark, f"{self.root}/{name}")
                    gone.append(name)
            if not any(u.startswith(f"{run_name}/") for u in used):
                delete(self.spark, f"{self.root}/{run_name}")
        return gone


def _bucket(key: Sequence[str], count: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(count)).cast("int")


def _merged(target: DataFrame, updates: DataFrame, key: list[str], cols: list[str], order: list[str]) -> DataFrame:
    """Full outer join by key; an update that is older than the stored row by
    ``order`` (NULL is oldest) leaves it as it is."""
    u = updates.select(*[F.col(c).alias(f"_u_{c}") if c not in key else F.col(c) for c in updates.columns], F.lit(True).alias("_hit"))
    t = target.withColumn("_old", F.lit(True))
    joined = t.join(u, key, "full_outer")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    if order:
        # row by row, NULL before every value, as struct comparison has it
        newer = F.struct(*[F.col(f"_u_{c}") for c in order]) >= F.struct(*[F.col(c) for c in order])
        hit = hit & (F.col("_old").isNull() | newer)
    return joined.select(*[F.col(c) if c in key or c not in cols else F.when(hit, F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c)
                           for c in target.columns])
