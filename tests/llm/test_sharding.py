import random
import zlib
from collections import Counter, defaultdict

import pytest

from patronage.llm import sharding


def test_difference_keeps_every_load():
    rng = random.Random(4)
    for _ in range(30):
        k = rng.randint(1, 7)
        parts = [[rng.randint(0, 100) for _ in range(rng.randint(1, k))] for _ in range(rng.randint(0, 40))]
        loads, where = sharding.difference(parts, k)
        sums = [0] * k
        for p, w in zip(parts, where, strict=True):
            assert len(set(w)) == len(p)  # loads of one tuple stay apart
            for load, slot in zip(p, w, strict=True):
                sums[slot] += load
        assert sums == loads and len(loads) == k


def test_difference_is_the_known_two_way_result():
    # Karmarkar and Karp's example: 8, 7, 6, 5, 4 leaves a difference of 2
    loads, _ = sharding.difference([[8], [7], [6], [5], [4]], 2)
    assert loads == [16, 14]


@pytest.mark.parametrize("per_bucket", [4000, 40])
def test_balance_over_buckets(spark, per_bucket):
    rng = random.Random(per_bucket)
    loads = {i: int(rng.paretovariate(1.5) * 50) for i in range(300)}
    got = {r["key"]: r["shard"] for r in sharding.balance(spark.createDataFrame(list(loads.items()), "key bigint, load bigint"), 8,
                                                          groups_per_bucket=per_bucket).collect()}
    sums = [sum(loads[k] for k in loads if got[k] == s) for s in range(8)]
    share = sum(loads.values()) / 8
    assert set(got) == set(loads) and max(sums) <= max(share, *loads.values()) * 1.05


def test_shards_of_edge_rows(edge_docs, edge_rows, no_docs):
    rows = sharding.digest(sharding.shard(edge_docs, 4)).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in edge_rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    slots, of = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        of[r["text_crc32"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(s) == 1 for s in of.values())
    assert sharding.shard(no_docs, 4).count() == 0


def test_hot_group_and_small_blocks(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i} " * (i % 17)) for i in range(600)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id bigint, text string"), 5, groups_per_bucket=40).collect()
    texts, slots = dict(rows), defaultdict(list)
    assert len({r["shard"] for r in got if texts[r["doc_id"]] == "hot"}) == 1
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [sum(r["size"] for r in got if r["shard"] == s) for s in range(5)]
    assert max(sizes) - min(sizes) < 0.02 * sum(sizes)
