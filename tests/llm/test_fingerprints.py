import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from patronage.llm import fingerprints, simhash_dedup
from patronage.llm.components import components


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_fingerprints(edge_docs, edge_rows):
    got = Counter((r["doc_id"], r["fp"]) for r in simhash_dedup.fingerprints(edge_docs).collect())
    assert got == Counter((i, signed(plain_simhash(t))) for i, t, *_ in edge_rows)


def near_fingerprints(seed, n=150):
    """Clusters of fingerprints a few bits from each other, and loners."""
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 30])):
            x = base
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            out.append(x)
    return out


def plain_components(fps, bits=3):
    least = list(range(len(fps)))
    while True:
        new = [min(least[j] for j, y in enumerate(fps) if (x ^ y).bit_count() <= bits) for x in fps]
        new = [min(a, b) for a, b in zip(new, least, strict=True)]
        if new == least:
            return least
        least = new


@pytest.mark.parametrize("block,segments,bits", [(1024, 2, 3), (4, 2, 3), (8, 4, 3), (1024, 1, 1), (4, 2, 4)])
def test_links_connect_what_pairs_connect(spark, block, segments, bits):
    fps = sorted(set(near_fingerprints(block + segments)))
    nodes = spark.createDataFrame([(signed(x),) for x in fps], "fp bigint")
    roots = {r["node"]: r["root"] for r in components(simhash_dedup.links(nodes, max_bits=bits, segments=segments, block=block)).collect()}
    got = [roots.get(signed(x), signed(x)) for x in fps]
    want = plain_components(fps, bits)
    assert len(set(got)) == len(set(want)) and len(set(zip(got, want, strict=True))) == len(set(want))


def test_work_of_one_hot_value_follows_near_pairs(spark):
    """3,000 fingerprints of one lower half, a few of them near: what is compared
    is a small part of all pairs, and all links are found."""
    rng = random.Random(5)
    low, fps = 0x1234abcd, set()
    while len(fps) < 2900:
        fps.add(rng.getrandbits(32) << 32 | low)
    for x in list(fps)[:100]:
        fps.add(x ^ 1 << rng.randrange(32, 64) ^ 1 << rng.randrange(32, 64) ^ 1 << rng.randrange(64))
    fps = sorted(fps)
    nodes = spark.createDataFrame([(signed(x),) for x in fps], "fp bigint")
    members = nodes.select(F.lit(0).alias("seg"), F.lit(low).cast("long").alias("value"), "fp")
    pairs = spark.createDataFrame([(0, low, low)], "seg int, value bigint, other bigint")
    keyed = simhash_dedup._members_of_tables(members, pairs.select("seg", "value"), 2, 3)
    compared = simhash_dedup._blocks(keyed, pairs, 64).agg(F.sum(F.size("left") * F.size("right"))).first()[0]
    assert compared < len(fps) ** 2 / 50
    for block in (64, 1024):
        roots = {r["node"]: r["root"] for r in components(simhash_dedup.links(nodes, block=block)).collect()}
        got = [roots.get(signed(x), signed(x)) for x in fps]
        near = np.array(fps, np.uint64)
        want = {frozenset(map(int, near[np.bitwise_count(near ^ x) <= 3])) for x in near}
        label = dict(zip(fps, got, strict=True))
        assert all(len({label[y] for y in group}) == 1 for group in want)
        sizes = Counter(got)
        assert sum(n > 1 for n in sizes.values()) >= 90 and max(sizes.values()) < 20


def test_near_duplicates_of_edge_rows(edge_docs, edge_rows, no_docs):
    rows = simhash_dedup.near_duplicates(edge_docs).collect()
    assert len(rows) == len(edge_rows)
    by = {r["doc_id"]: r["component_id"] for r in rows}
    assert by[5] == 0 and by[1] == by[2] == by[3] == 1 and by[None] is None and by[7] == 7
    assert simhash_dedup.near_duplicates(no_docs).count() == 0


def test_keep_one(edge_docs, no_docs):
    kept = simhash_dedup.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert max(ids.values()) == 1 and 5 not in ids and 2 not in ids and {0, 1, None, 7} <= set(ids)
    assert simhash_dedup.keep_one(no_docs).count() == 0


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    links += [(7, 7), (300, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    least = {x: x for e in links for x in e}
    for _ in range(100):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert got == {x: r for x, r in least.items() if x != r}


def test_edited_texts_and_likeness(edge_docs, edge_rows, no_docs):
    got = fingerprints.digest(fingerprints.fingerprint_documents(edge_docs)).collect()
    assert len(got) == len(edge_rows) and fingerprints.fingerprint_documents(no_docs).count() == 0
    order = sorted(edge_rows, key=lambda r: (r[0] is not None, r[0] or 0))
    by_id = {}
    for r in order:
        by_id.setdefault(r[0], r[1] or "")
    ids = list(by_id)
    want = Counter()
    for r in order:
        text, following = r[1] or "", by_id[ids[(ids.index(r[0]) + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        want[r[0], len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    by = {r["doc_id"]: r for r in got}
    assert by[0]["fingerprint"] == by[5]["fingerprint"] and len(by[0]["fingerprint"]) == 32
    assert by[1]["near_next"] == 1.0 and by[7]["near_edited"] > by[7]["near_next"] and all(0 <= r["near_next"] <= 1 for r in got)


def test_votes_are_weighted(spark):
    docs = spark.createDataFrame([(1, "aa bbbb c"), (2, "aa bbbb c"), (3, "\t")], "id bigint, text string")
    got = {r["id"]: (r["hi"], r["lo"]) for r in fingerprints.votes(docs, ["id"]).collect()}
    row = spark.sql("select xxhash64('aa', 'bbbb') a, xxhash64('bbbb', 'c') b, xxhash64('c', null) c").first()
    lows = spark.sql(f"select xxhash64({row['a']}L) a, xxhash64({row['b']}L) b, xxhash64({row['c']}L) c").first()
    for half, hashes in ((0, row), (1, lows)):
        want = sum(1 << j for j in range(64) if sum(w * (1 if hashes[n] >> j & 1 else -1) for n, w in (("a", 2), ("b", 4), ("c", 1))) > 0)
        assert got[1][half] == signed(want)
    assert got[1] == got[2] and got[3] == (0, 0)


@pytest.mark.parametrize("radius,blocks", [(0, None), (2, None), (3, 6)])
def test_block_tables_find_all(spark, radius, blocks):
    rng = random.Random(radius)
    table = [rng.getrandbits(128) for _ in range(60)]
    queries = []
    for x in table[:30]:
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randrange(128)
        queries.append(x)
    frame = lambda xs: spark.createDataFrame([(signed(x >> 64), signed(x & (1 << 64) - 1)) for x in sorted(set(xs))], "hi bigint, lo bigint")
    got = {(r["hi"], r["lo"], r["other_hi"], r["other_lo"], r["distance"]) for r in fingerprints.near(frame(queries), frame(table), radius, blocks).collect()}
    halves = lambda x: (signed(x >> 64), signed(x & (1 << 64) - 1))
    assert got == {(*halves(q), *halves(t), (q ^ t).bit_count()) for q in queries for t in table if (q ^ t).bit_count() <= radius}


def test_successors_do_not_need_dense_ids(spark):
    rng = random.Random(2)
    ids = sorted(rng.sample(range(-10**12, 10**12), 100))
    df = spark.createDataFrame([(False, i, k) for k, i in enumerate(ids)] + [(True, 0, 1000)], "null_id boolean, id bigint, most int")
    got = {(r["null_id"], r["id"]): r for r in fingerprints.successors(df, 7).collect()}
    row = [(True, 0, 1000)] + [(False, i, k) for k, i in enumerate(ids)]
    for k, (null, i, _) in enumerate(row):
        r, after, ahead = got[null, i], row[(k + 1) % len(row)], row[k - 1]
        assert (r["next_null"], r["next_id"]) == after[:2] and (r["before_null"], r["before_id"], r["before_most"]) == ahead


def test_native(spark, edge_docs):
    plan = fingerprints.fingerprint_documents(edge_docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
