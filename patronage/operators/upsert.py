"""Upsert by primary key (``INSERT ... ON DUPLICATE KEY UPDATE``) of one
DataFrame into another. :mod:`patronage.operators.keyed_table` stores such a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_per_key(updates: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``order`` (ties: the largest row)."""
    rest = [c for c in updates.columns if c not in key]
    last = updates.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order, *rest)).alias("_last"))
    return last.select(*[F.col(c) if c in key else F.col(f"_last.{c}").alias(c) for c in updates.columns])


def require_unique(df: DataFrame, key: Sequence[str], what: str) -> None:
    """Raise if a key has several rows."""
    several = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").limit(1).collect()
    if several:
        raise ValueError(f"{what} has several rows for key {[several[0][k] for k in key]}; give an order to keep the last")


def upsert(target: DataFrame, updates: DataFrame, key: Sequence[str],
           update_cols: Sequence[str] | None = None) -> DataFrame:
    """Merge ``updates`` into ``target`` on ``key``.

    Matching rows take the ``update_cols`` from ``updates`` and keep every
    other column; unmatched update rows are inserted (columns they lack are
    NULL); unmatched target rows are kept. Both sides must be unique on key
    (:func:`last_per_key` makes updates so, a keyed table checks it).
    One full outer join on the key (a shuffle of both sides by key).
    """
    key = list(key)
    if update_cols is None:
        update_cols = [c for c in updates.columns if c not in key]
    u = updates.select(*key, *update_cols, F.lit(True).alias("_hit"))
    t = target.alias("t")
    merged = t.join(u.alias("u"), key, "full_outer")
    cols = []
    for c in target.columns:
        if c in key:
            cols.append(F.col(c))
        elif c in update_cols:
            cols.append(F.when(F.col("_hit"), F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            cols.append(F.col(f"t.{c}").alias(c))
    return merged.select(*cols)
