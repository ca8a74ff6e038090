"""Sharding: byte-balanced shards of indivisible groups by Karmarkar-Karp
differencing.

A group is all rows of equal text; it never leaves its shard. Each partial
partition is a tuple of loads, one per shard. The method repeatedly takes the
two partial partitions of largest spread and adds them in opposite order, so
that large loads meet small ones.

One heap over all groups would be one task, so it is done in two steps. The
``groups_per_bucket`` largest groups are differenced alone. All others are
dealt by hash into buckets of about as many, and each bucket is differenced in
its own task, together with one more partial partition: the first step's
loads, scaled to the bucket's share of all that is left. So each bucket fills
up its part of what the large groups left uneven, and the buckets' results
add up shard by shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.common import checkpointed, prepare

GROUPS_PER_BUCKET = 4_000  # also bounds what the driver holds; and a quarter of the rows that one task numbers


def difference(parts: Iterable[Sequence[int]], shards: int) -> tuple[list[int], list[list[int]]]:
    """Combine partial partitions into one.

    ``parts`` are tuples of at most ``shards`` loads. Returns the final loads
    (descending) and, for each part, the final slot of each of its loads.
    """
    parts = [list(p) for p in parts]
    parent: list[int] = []  # of each node, the node that it was added to
    heap = []
    leaves = []
    for i, loads in enumerate(parts):
        nodes = list(range(len(parent), len(parent) + len(loads)))
        parent.extend(nodes)
        leaves.append(nodes)
        slots = sorted(zip(loads, nodes, strict=True), reverse=True)[:shards]
        spread = slots[0][0] - (slots[-1][0] if len(slots) == shards else 0) if slots else 0
        heapq.heappush(heap, (-spread, i, slots))
    order = len(parts)
    while len(heap) > 1:
        one, two = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(one) < len(two):
            one, two = two, one
        # ``one`` by descending load, ``two`` by ascending, padded with empty loads at its head
        made, gap = one[:shards], max(0, shards - len(two))
        for j in range(len(two)):
            load, node = two[len(two) - 1 - j]
            at = gap + j
            if at < len(made):
                parent[node] = made[at][1]
                made[at] = (made[at][0] + load, made[at][1])
            else:
                made.append((load, node))
        made.sort(reverse=True)
        spread = made[0][0] - (made[-1][0] if len(made) == shards else 0)
        heapq.heappush(heap, (-spread, order, made))
        order += 1
    final = heap[0][2] if heap else []
    slot = {node: k for k, (_, node) in enumerate(final)}

    def root(node: int) -> int:
        path = []
        while parent[node] != node:
            path.append(node)
            node = parent[node]
        for p in path:
            parent[p] = node
        return node

    where = [[slot[root(n)] for n in nodes] for nodes in leaves]
    return [load for load, _ in final] + [0] * (shards - len(final)), where


def balance(groups: DataFrame, shards: int, *, groups_per_bucket: int = GROUPS_PER_BUCKET) -> DataFrame:
    """Shard of each group. ``groups``: key bigint (unique), load bigint >= 0.
    Returns key, shard; loads are near equal unless single groups are larger
    than a shard's share."""
    spark = groups.sparkSession
    large = groups.orderBy(F.desc("load"), "key").limit(groups_per_bucket).collect()
    loads, where = difference([[r["load"]] for r in large], shards)
    first = spark.createDataFrame([(r["key"], w[0]) for r, w in zip(large, where, strict=True)], "key bigint, shard int")
    rest = groups.join(F.broadcast(first), "key", "left_anti")  # groups_per_bucket rows
    left = rest.agg(F.count(F.lit(1)).alias("n"), F.sum("load").alias("load")).first()
    buckets, total = max(1, -(-left["n"] // groups_per_bucket)), left["load"] or 0

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key")
        items = frame["load"].tolist()
        share = [x * sum(items) // max(1, total) for x in loads]
        _, where = difference([share, *([x] for x in items)], shards)
        shard_of = {slot: s for s, slot in enumerate(where[0])}
        return pd.DataFrame({"key": frame["key"].to_numpy(), "shard": np.array([shard_of[w[0]] for w in where[1:]], np.int32)})

    dealt = rest.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInPandas(run, "key bigint, shard int").unionAll(first)


def shard(docs: DataFrame, shards: int = 40, *, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16,
          groups_per_bucket: int = GROUPS_PER_BUCKET) -> DataFrame:
    """Put every row into one of ``shards`` shards of near equal bytes.

    Returns doc_id, size (UTF-8 bytes of the text plus ``overhead``),
    text_crc32, shard, slot (gapless from 0 within a shard, by rows).

    Rows of equal text (a null text counts as empty) stay together. Null ids
    are kept. Repeated rows have a slot each. Further columns aren't read. An
    empty table gives no rows. The text itself is never shuffled: only its
    64-bit hash, length and crc.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.octet_length(text).cast("long") + overhead).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"))
    # Texts whose 64-bit hashes clash are one group, which keeps both whole.
    rows = checkpointed(rows)
    sums = checkpointed(rows.groupBy("key").agg(F.sum("size").alias("load")))
    placed = balance(sums, shards, groups_per_bucket=groups_per_bucket)
    out = checkpointed(rows.join(placed, "key").drop("key"))
    return _numbered(out, groups_per_bucket)


def _numbered(rows: DataFrame, per_block: int) -> DataFrame:
    """Number the rows of each shard: rows are dealt into small blocks, each
    block is numbered alone and starts after the shard's earlier blocks."""
    blocks = max(1, -(-rows.count() // (per_block * 4)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(blocks)))
    counts = rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("slot", F.row_number().over(inside) - 1).join(starts, ["shard", "block"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("slot") + F.col("first")).alias("slot")))


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))
