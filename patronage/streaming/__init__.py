"""Streaming.

The source system is batch-only (full reloads and key upserts), so there is
no streaming operator to reproduce. The one incremental hook is the key
upsert (S-08), which takes a plain DataFrame and therefore also runs per
micro-batch: :func:`upsert_each_batch` wires it into ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from patronage.operators.keyed_table import KeyedTable


def upsert_each_batch(root: str, key: Sequence[str],
                      transform: Callable[[DataFrame], DataFrame] | None = None,
                      order: Sequence[str] | None = None, source: str = "stream"):
    """``foreachBatch`` function: optionally transform the micro-batch, then
    merge it into the keyed table at ``root``. If a key may come several
    times, ``order`` keeps the last of its rows, within a micro-batch and over all of them.
    The number of the last micro-batch of ``source`` is committed with the data, so
    one that Spark runs again after a failure changes nothing."""
    def run(batch: DataFrame, batch_id: int) -> None:
        data = transform(batch) if transform else batch
        KeyedTable(data.sparkSession, root).merge(data, key, order=order or (), batch=(source, batch_id))
    return run
